"""Spelling variants against brute force, and edge cases."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import queries, spelling

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_words(rows, min_chars=7, min_count=2, damage=31):
    n = collections.Counter()
    for i, x in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", x or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if damage and h % damage == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= min_chars:
                n[w] += 1
    return {w: k for w, k in n.items() if k >= min_count}


def brute(n, factor=10):
    """All single edits of every word, looked up; then the forms followed."""
    letters = sorted({c for w in n for c in w})
    near = {}
    for w in n:
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        made = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters}
        made |= {a + c + b[1:] for a, b in cuts if b for c in letters}
        near[w] = {v for v in made if v in n and v != w}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def table(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n bigint")


def test_registered_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = rows_of(queries.op12_spelling(spark, SF))
    assert got == brute(count_words(docs))
    assert sum(f is not None for _, f, *_ in got) > 5


@pytest.mark.parametrize("tile", [1, 3, 512])
def test_random_words(spark, tile):
    """Words over few letters: long groups, chains, ties; small tiles halve the
    segments down to one place."""
    r = random.Random(3)
    n = {}
    for _ in range(900):
        n["".join(r.choice("abé") for _ in range(r.randint(1, 9)))] = r.choice([2, 2, 20, 200, 2000])
    assert rows_of(spelling.variants(table(spark, n), tile=tile)) == brute(n)


def test_hot_prefix(spark):
    """Most words share all but their end: halved until the groups are small."""
    r = random.Random(5)
    n = {"commonprefix" + "".join(r.choice("abcdef") for _ in range(5)): r.choice([2, 30]) for _ in range(1500)}
    n |= {"x" * k: 10 ** (k - 6) + 1 for k in range(7, 12)}
    assert rows_of(spelling.variants(table(spark, n), tile=16)) == brute(n)


def test_word_counts(spark):
    docs = [(1, None), (2, ""), (None, "Letters LETTERS letters"), (3, "Éclairs ÉCLAIRS éclairs"),
            (4, "seven77seven sevenseven中sevenseven \U00010400sevenseven"), (4, "letters"), (4, "letters"),
            (5, "z" * 100_000 + " " + "z" * 100_000), (6, "sixsix sixsix"), (7, "×÷×÷×÷× " * 2)]
    f = spark.createDataFrame([(i, x, 1) for i, x in docs], "doc_id bigint, text string, run int")
    for damage in (None, 31, 1, 2):
        got = {r["word"]: r["n"] for r in spelling.word_counts(f, damage=damage).collect()}
        assert got == count_words(docs, damage=damage)


def test_long_words_and_empty_table(spark):
    n = {"z" * 50_000: 2, "z" * 50_001: 20, "z" * 25_000 + "y" + "z" * 25_000: 200, "abcdefg": 2}
    got = {r["word"]: (r["form"], r["root"], r["n_near"]) for r in spelling.variants(table(spark, n)).collect()}
    z, z1, y = list(n)[:3]
    assert got == {z: (y, y, 2), z1: (y, y, 2), y: (None, y, 2), "abcdefg": (None, "abcdefg", 0)}
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    words = spelling.word_counts(empty)
    assert words.count() == 0 and spelling.variants(words).count() == 0
