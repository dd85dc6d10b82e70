"""Language identification against brute force over whole tables."""

import collections
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import langid, queries

SF = "/root/testdata/sf0.001"
SIZE = 400


def grams(text):
    """Counter of n-grams as tuples of code points; non-letters are one 1."""
    s = []
    for c in text or "":
        low = c.lower()
        p = (ord(low) if len(low) == 1 else ord(c)) if c.isalpha() else 1
        if p != 1 or not s or s[-1] != 1:
            s.append(p)
    out = collections.Counter()
    for n in (1, 2, 3):
        out.update(g for g in (tuple(s[i:i + n]) for i in range(len(s) - n + 1)) if g != (1,))
    return out


def place(g):
    return sum(p << 21 * (len(g) - 1 - i) for i, p in enumerate(g))


def top(counts):
    return sorted(counts, key=lambda g: (-counts[g], place(g)))[:SIZE]


def brute(train, rows):
    total = collections.defaultdict(collections.Counter)
    for text, lang in train:
        if lang is not None:
            total[lang].update(grams(text))
    ranks = {k: {g: r for r, g in enumerate(top(c))} for k, c in total.items()}
    out = {}
    for i, text in rows:
        own = top(grams(text))
        if not any(c.isalpha() for c in text or ""):
            out[i] = ("und", 0.0)
            continue
        dist = {k: sum(abs(r[g] - n) if g in r else SIZE for n, g in enumerate(own)) for k, r in ranks.items()}
        best = min(sorted(dist), key=dist.get)
        out[i] = (best, 1 - dist[best] / (len(own) * SIZE))
    return out


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        assert r["lang_pred"] == want[r["doc_id"]][0], r
        assert r["score"] == pytest.approx(want[r["doc_id"]][1])


def test_registered_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = lambda r: zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
    got = queries.op7_langid(spark, SF).collect()
    check(got, brute([(r["text"], r["lang"]) for r in rows if not held(r)],
                     [(r["doc_id"], r["text"]) for r in rows]))
    assert {r["doc_id"] for r in got if r["held_out"]} == {r["doc_id"] for r in rows if held(r)}


def test_scripts_and_odd_texts(spark):
    train = [("the cat sat on the mat", "en"), ("кошка сидит на окне", "ru"), ("𐐨𐐩𐐪 𐐨𐐩𐐪", "ds"),
             ("𠀁𠀂𠀃", "zh"), (None, "en"), ("no language", None), ("", "nn")]
    rows = list(enumerate(["The mat", "Окно", "𐐀𐐁𐐂", "𠀁", "\U00010001", "\U00020001", None, "", " 12 !?", "İstanbul ß ŉ",
                           "a\x00b\x01c", "漢字かな交じり文", "한국어 텍스트", "mixed кошка 𐐨 mat"]))
    t = spark.createDataFrame(train, "text string, lang string")
    d = spark.createDataFrame(rows, "doc_id int, text string").withColumn("lang", F.lit("x"))
    got = langid.predict(d, langid.learn(t)).collect()
    check(got, brute(train, rows))
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    # letters beyond the basic plane are letters
    assert by[2] == "ds" and by[3] == "zh" and by[4] != "und" and by[5] != "und"
    assert [by[i] for i in (6, 7, 8)] == ["und"] * 3


def test_counts_are_not_capped(spark):
    """A letter that occurs more than 2^20 times still outranks one that
    occurs half as often."""
    prof = {"x": ["e", "a"], "y": ["a", "e"]}
    prof = {k: langid.np.array([ord(c) for c in v], langid.np.uint64) for k, v in prof.items()}
    for n in (2_000, 2_400_000):
        text = "e" * n + "a" * (n // 2)
        d = spark.createDataFrame([(1, text)], "doc_id int, text string")
        r = langid.predict(d, prof).first()
        assert r["lang_pred"] == "x"
    assert langid.Ranker(prof, 400).judge(langid_column(text))[0] == ["x"]


def langid_column(*texts):
    import pyarrow as pa
    return pa.array(texts)


def test_many_scripts_in_one_text():
    """More distinct letters than fit in 16 bits, in one text and over rows."""
    letters = "".join(chr(p) for p in range(0x4E00, 0x9FFF)) + "".join(chr(p) for p in range(0x20000, 0x2A6DF)) \
        + "".join(chr(p) for p in range(0xAC00, 0xD7A3)) + "".join(chr(p) for p in range(0x30000, 0x3134A))
    for texts in ([letters], [letters[i::7] for i in range(7)] + ["abc"]):
        data = "".join(texts).encode()
        offs = langid.np.cumsum([0] + [len(t.encode()) for t in texts])
        row, g, n = langid.ngram_counts(langid.np.frombuffer(data, langid.np.uint8), offs)
        got = dict(zip(zip(row.tolist(), g.tolist()), n.tolist()))
        want = {(i, place(k)): c for i, t in enumerate(texts) for k, c in grams(t).items()}
        assert got == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id int, text string, lang string")
    assert langid.learn(none) == {} and langid.predict(none, {}).count() == 0
    some = spark.createDataFrame([(1, "a word", None)], "doc_id int, text string, lang string")
    assert langid.predict(some, langid.learn(some)).first()["lang_pred"] == "und"
