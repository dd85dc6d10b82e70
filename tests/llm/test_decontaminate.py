"""Benchmark decontamination: brute force on random texts, shared phrases, hot rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else set()


def brute(docs, items, width=5, pct=80):
    held = {}
    out = set()
    for i, text in items:
        n_words = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        if i is None or not n_words:
            continue
        w = min(width, n_words)
        want = shingles(text, w)
        for d, t in docs:
            if d is None:
                continue
            held.setdefault((d, w), set())
        mine = {}
        for d, t in docs:
            if d is not None:
                mine.setdefault(d, set()).update(shingles(t, w))
        for d, s in mine.items():
            both = len(want & s)
            if both * 100 >= len(want) * pct:
                out.add((d, i, len(want), both))
    return out


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return {tuple(r)[:4] for r in decontaminate.find_items(d.repartition(3), i, **kw).collect()}


@pytest.mark.parametrize("kw", [{}, {"broadcast_rows": 0}])
def test_against_brute_force(spark, kw):
    r = random.Random(6)
    word = lambda: r.choice("abcdefghij") + r.choice("xyz")
    items = [(i, " ".join(word() for _ in range(r.choice([1, 2, 4, 5, 6, 9, 30, 60])))) for i in range(40)]
    items += [(50, None), (51, ""), (None, "a b c d e f"), (52, items[7][1].upper())]
    docs = [(None, items[3][1]), (900, None), (901, "")]
    for i in range(120):
        t = [word() for _ in range(r.randrange(0, 40))]
        for _ in range(r.randrange(0, 3)):
            x = r.choice(items[:40])[1].split()
            if len(x) > 6:
                for _ in range(r.randrange(0, 3)):
                    x[r.randrange(len(x))] = word()
            t[r.randrange(len(t) + 1):0] = x
        docs.append((i // 2 if i < 20 else i, " ".join(t)))
    want = brute(docs, items)
    assert found(spark, docs, items, **kw) == want and len(want) > 30


def test_a_phrase_shared_by_many_makes_no_candidates(spark, monkeypatch):
    """400 items and 1,000 documents share one phrase and nothing else: the
    stored tables stay in proportion to the documents."""
    phrase = "which of the following is"
    items = [(i, f"{phrase} " + " ".join(f"w{i}x{j}" for j in range(12))) for i in range(400)]
    docs = [(i, f"{phrase} " + " ".join(f"d{i}x{j}" for j in range(20))) for i in range(1000)]
    docs.append((2000, "before " + items[7][1] + " after"))
    stored, stash = {}, decontaminate.stash
    monkeypatch.setattr(decontaminate, "stash", lambda df, name: stored.setdefault(name, stash(df, name)))
    assert found(spark, docs, items) == {(2000, 7, 13, 13)}
    assert stored["bench-hits"].count() < 1100
    assert stored["bench-candidates"].count() == stored["bench-near"].count() == 1


def test_clashing_columns_and_long_text(spark):
    item = " ".join(f"item{i}" for i in range(8))
    d = spark.createDataFrame([(1, "x " * 200_000 + item), (2, "none")], "doc_id bigint, text string")
    wide = d.select("*", *[F.lit(1).alias(c) for c in ("item_id", "h", "ws", "n", "shingle", "least")])
    i = spark.createDataFrame([(5, item, 1, 2)], "item_id bigint, text string, doc_id int, w int")
    got = decontaminate.find_items(wide, i)
    assert got.columns == ["doc_id", "item_id", "n_item", "n_shared", "containment"]
    assert [tuple(r) for r in got.collect()] == [(1, 5, 4, 4, 1.0)]
