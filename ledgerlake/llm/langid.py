"""Language identification by rank-order profiles of character n-grams.

A language's profile is its ``size`` most frequent n-grams (one to three
characters, letters lower-cased, every other run one blank), counted over all
its training texts. A document's own profile of the same size is compared by
out-of-place distance: the sum over the document's n-grams of how far their
ranks lie apart, ``size`` for an n-gram the language's profile lacks. The
language at the least distance wins; equal distances go to the first name.

Score: 1 - distance / largest possible distance.

Defined results: null texts and texts without a letter are ``und`` with score
0; rows repeating an id are judged row by row; without any training text all
are ``und``; an empty table gives an empty result; other columns are ignored.
Counts and code points are exact, whatever a text's length or script.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import small_batches, text_chunks

GAP = 1  # the code of a run of non-letters; no letter has it
BITS = 21  # of a code point; an n-gram is up to three of them
_LOWER: dict[int, int] = {}


def _code(point: int) -> int:
    """A letter's lower-cased code point (its own where that is no single one),
    GAP for anything else."""
    if point not in _LOWER:
        c = chr(point)
        low = c.lower()
        _LOWER[point] = (ord(low) if len(low) == 1 else point) if c.isalpha() else GAP
    return _LOWER[point]


def _dense(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, codes): each character's code is codes[place]; codes ascend."""
    there = np.zeros(0x110000, bool)
    there[points] = True
    found = np.flatnonzero(there)
    codes, at = np.unique(np.array([_code(p) for p in found.tolist()], np.uint64), return_inverse=True)
    place = np.zeros(0x110000, np.uint32)
    place[found] = at
    return place[points].astype(np.uint64), codes


def ngram_counts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, n-gram, count) arrays of a chunk, sorted by row and n-gram."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    at = lead[offs]
    place, codes = _dense(points)
    # n-grams are sorted as places from 1 on, few bits each, below their row
    bits = int(len(codes)).bit_length()
    block = 1 << (63 - 3 * bits)
    parts = []
    for a in range(0, len(at) - 1, block):
        o = at[a:a + block + 1]
        row, key, n = _counts(place[o[0]:o[-1]] + np.uint64(1), o - o[0],
                              1 + int(np.searchsorted(codes, GAP)) if GAP in codes else 0, bits)
        parts.append((row + np.uint64(a), key, n))
    row, key, n = (np.concatenate(x) for x in zip(*parts)) if parts else (
        np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    known = np.r_[np.uint64(0), codes]
    low = np.uint64((1 << bits) - 1)
    gram = np.zeros(len(key), np.uint64)
    for i in (2, 1, 0):
        gram = (gram << np.uint64(BITS)) | known[((key >> np.uint64(bits * i)) & low).astype(np.int64)]
    return row, gram, n


def _counts(c: np.ndarray, at: np.ndarray, gap_code: int, bits: int):
    """Distinct (row, packed n-gram) pairs and their counts, sorted."""
    row = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at))
    gap = c == gap_code
    keep = np.ones(len(c), bool)
    if len(c) > 1:
        keep[1:] = ~(gap[1:] & gap[:-1] & (row[1:] == row[:-1]))
    c, row, gap = c[keep], row[keep], gap[keep]
    one, two, three = (np.uint64(bits * i) for i in (1, 2, 3))
    tag = row << three
    keys = [(tag | c)[~gap]]
    if len(c) > 1:
        ok = row[1:] == row[:-1]
        keys.append((tag[1:] | (c[:-1] << one) | c[1:])[ok])
    if len(c) > 2:
        ok = row[2:] == row[:-2]
        keys.append((tag[2:] | (c[:-2] << two) | (c[1:-1] << one) | c[2:])[ok])
    key = np.sort(np.concatenate(keys))
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    return key >> three, key & np.uint64((1 << (3 * bits)) - 1), count


def learn(train: DataFrame, text_col: str = "text", lang_col: str = "lang",
          size: int = 400) -> dict[str, np.ndarray]:
    """{language: n-grams by falling frequency} over all rows with a language."""
    small_batches(train.sparkSession)
    rows = train.filter(train[lang_col].isNotNull()).select(
        train[lang_col].cast("string").alias("l"), train[text_col].alias("t"))

    def run(batches):
        import pyarrow as pa
        held: dict[str, dict[int, int]] = {}

        def out():
            for lang, d in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(d), pa.string()), pa.array(list(d), pa.int64()),
                     pa.array(list(d.values()), pa.int64())], names=["l", "g", "n"])
            held.clear()

        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            for lang in sorted(set(langs.tolist())):
                own = b.column(1).filter(pa.array(langs == lang))
                d = held.setdefault(lang, {})
                for _, data, offs in text_chunks(own):
                    for g, n in _together(data, offs):
                        d[g] = d.get(g, 0) + n
            if sum(map(len, held.values())) > 1_000_000:
                yield from out()
        yield from out()

    counts = (rows.mapInArrow(run, "l string, g bigint, n bigint")
              .groupBy("l", "g").agg(F.sum("n").alias("n")))
    w = Window.partitionBy("l").orderBy(F.desc("n"), "g")
    top = counts.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= size)
    profiles: dict[str, list] = {}
    for r in sorted(top.collect(), key=lambda r: (r["l"], r["r"])):
        profiles.setdefault(r["l"], []).append(r["g"])
    return {k: np.array(v, np.uint64) for k, v in profiles.items()}


def _together(data, offs):
    """(n-gram, count) over all rows of a chunk."""
    _, g, n = ngram_counts(data, offs)
    order = np.argsort(g, kind="stable")
    g, n = g[order], n[order]
    if len(g):
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        return zip(g[first].tolist(), np.add.reduceat(n, first).tolist())
    return ()


class Ranker:
    """Out-of-place distances to all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.langs, self.size = sorted(profiles), size
        known = [profiles[k] for k in self.langs]
        self.grams = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        for j, p in enumerate(known):
            self.ranks[np.searchsorted(self.grams, p), j] = np.arange(len(p))

    def judge(self, column) -> tuple[list[str], np.ndarray]:
        names, scores = [], []
        for _, data, offs in text_chunks(column):
            n = len(offs) - 1
            if not self.langs or not len(data):
                names += ["und"] * n
                scores.append(np.zeros(n))
                continue
            for a in range(0, n, 4096):
                o = offs[a:a + 4097]
                got = self._rows(data[o[0]:o[-1]], o - o[0])
                names += got[0]
                scores.append(got[1])
        return names, np.concatenate(scores) if scores else np.zeros(0)

    def _rows(self, data, offs):
        n = len(offs) - 1
        row, g, count = ngram_counts(data, offs)
        letters = np.zeros(n, np.int64)
        single = g >> np.uint64(BITS) == 0
        np.add.at(letters, row[single].astype(np.int64), count[single])
        # by row, falling count, n-gram (the order they come in breaks ties)
        top = np.uint64((1 << 20) - 1)
        if len(count) and count.max() > top:
            order = np.lexsort((np.arange(len(g)), -count, row))
        else:  # the same order as one number: 12 bits of row, 20 of count, 32 of place
            key = np.sort((row << np.uint64(52)) | ((top - count.astype(np.uint64)) << np.uint64(32))
                          | np.arange(len(g), dtype=np.uint64))
            order = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        row, g = row[order].astype(np.int64), g[order]
        begin = np.searchsorted(row, np.arange(n))
        rank = np.arange(len(g)) - begin[row] if len(g) else np.zeros(0, np.int64)
        use = rank < self.size
        row, g, rank = row[use], g[use], rank[use]
        at = np.searchsorted(self.grams, g)
        miss = (at >= len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != g)
        theirs = self.ranks[np.where(miss, len(self.grams), at)]
        apart = np.where(theirs < 0, self.size, np.abs(theirs - rank[:, None]))
        dist = np.stack([np.bincount(row, apart[:, j], n) for j in range(len(self.langs))], axis=1)
        best = dist.argmin(axis=1)
        most = np.maximum(np.bincount(row, minlength=n) * float(self.size), 1)
        score = np.where(letters > 0, 1 - dist[np.arange(n), best] / most, 0.0)
        return ([self.langs[b] if m else "und" for b, m in zip(best, letters > 0)],
                np.clip(score, 0, 1))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], id_col: str = "doc_id",
            text_col: str = "text", size: int = 400) -> DataFrame:
    """(id_col, lang_pred, score) for every row. ``profiles``: of ``learn``; as
    many n-grams as languages times ``size``, sent along with the tasks."""
    ranker, kind = Ranker(profiles, size), dict(docs.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa
        for b in batches:
            names, scores = ranker.judge(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(names, pa.string()), pa.array(scores)],
                names=[id_col, "lang_pred", "score"])

    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double")
