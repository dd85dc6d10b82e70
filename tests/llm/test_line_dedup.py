"""Line dedup against brute force, and its edge cases."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import linededup, queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars=20, min_docs=3):
    """Counter of (id, n_lines, n_dropped, kept text)."""
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(LOWER)
    order = lambda i: (i is not None, i or 0)
    docs = collections.defaultdict(set)
    for i, x in rows:
        for line in (x or "").split("\n"):
            if len(key(line)) >= min_chars:
                docs[key(line)].add(i)
    out = collections.Counter()
    for i, x in rows:
        lines = (x or "").split("\n")
        kept = [a for a in lines if len(docs.get(key(a), ())) < min_docs
                or order(i) == max(map(order, docs[key(a)]))]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def run(frame, **kw):
    got = linededup.dedup_lines(frame, **kw)
    return collections.Counter(tuple(r) for r in got.select(
        "doc_id", "n_lines", "n_dropped", "kept_text").collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = collections.Counter()
    for (i, n, d, x), k in brute(rows).items():
        want[i, n, d, hashlib.sha256(x.encode()).hexdigest()] += k
    got = collections.Counter(tuple(r) for r in queries.op11_line_dedup(spark, SF).collect())
    assert got == want and sum(d for _, _, d, _ in got) > 50


def test_cases(spark):
    long = "The same long line of words"
    rows = [(1, long), (2, f"  {long.upper()}\t\r\nown\n{long}"), (3, f"{long}\n{long}\n"), (4, None), (5, ""),
            (6, "\n\n"), (None, f"a\n{long}"), (None, long), (3, f"other\n{long}"), (1, long),
            (7, "x" * 19), (8, "x" * 19), (9, "x" * 19), (10, " " + "É" * 20), (11, "É" * 20),
            (12, "é" * 20), (13, "É" * 20 + "\nrest"), (14, "Two documents hold this one"),
            (15, "two documents hold this one"), (14, "two documents hold this one")]
    got = run(frame(spark, rows))
    assert got == brute(rows)
    assert got[None, 2, 1, "a"] == 1 and got[3, 3, 0, f"{long}\n{long}\n"] == 1
    assert got[10, 1, 1, ""] == 1 and got[12, 1, 0, "é" * 20] == 1


@pytest.mark.parametrize("hot", [0, 4000])
def test_random_and_hot_lines(spark, hot):
    """A line held by a third of all documents is judged apart; same result."""
    r = random.Random(7)
    pool = [f"shared line number {i} {'abc' * (i % 3)}" for i in range(60)]
    rows = []
    for i in range(300):
        rows.append((r.randrange(250), "\n".join(r.choice(pool + ["", "short", f"unique {i} in this text"])
                                                 for _ in range(r.randrange(8)))))
    rows += [(1000 + i, f"the very same line everywhere\nno {i}") for i in range(hot)]
    assert run(frame(spark, rows).repartition(5)) == brute(rows)


def test_long_text_and_bitmap(spark):
    rows = [(i, "\n".join(f"line {j % 977} of the long text" if (j + i) % 3 else f"own {i} {j}"
                          for j in range(30_000))) for i in range(3)]
    f = frame(spark, rows)
    assert run(f) == brute(rows)
    bits = linededup.keep_bitmaps(f).collect()
    assert {b["id"] for b in bits} == {0, 1}
    for b in bits:
        assert sum(n for _, n in b["keep_runs"]) + b["n_dropped"] == b["n_lines"] == 30_000


def test_empty_table_and_clashing_columns(spark):
    assert linededup.dedup_lines(frame(spark, [])).count() == 0
    rows = [(i, "the same long line of words\nx") for i in range(4)]
    wide = frame(spark, rows).select("*", *[F.lit(5).alias(c) for c in (
        "t", "pos", "h1", "id", "n", "line", "key", "n_dropped", "keep_runs", "__id2")])
    got = linededup.dedup_lines(wide)
    assert got.columns == ["doc_id", "text", "t", "pos", "h1", "id", "n", "line", "key", "__id2",
                           "n_lines", "n_dropped", "keep_runs", "kept_text"]
    assert sorted((r["doc_id"], r["n_dropped"], r["t"]) for r in got.collect()) == [
        (0, 1, 5), (1, 1, 5), (2, 1, 5), (3, 0, 5)]
