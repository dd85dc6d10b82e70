"""Quality classifier on document statistics.

Statistics of the text (sizes, character classes, repetition) go through
random Fourier features, which approximate a Gaussian kernel; ridge
regression on them is fitted from normal equations that tasks sum over their
rows; an isotonic curve over score bins turns the fitted value into a
probability. Text is read once for the statistics; the rest works on those.

What reaches the driver has a fixed size: moments of the statistics, one
(features x features) matrix, and one row per score bin. All labelled rows
are used.

Defined results: null and empty texts have zero statistics and get a score
like any other; labels are averaged per id first (ties count as 1), null
labels and ids are left out; documents that repeat an id are scored row by
row; with no labelled row, or a single class, every score is the class share
(0.5 without any); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import small_batches, stash, text_chunks, word_hashes

STATS = ("log_bytes", "log_words", "word_bytes", "upper", "high", "digit", "bang", "bar",
         "symbol", "stop", "other_punct", "line", "distinct", "top_word", "same_next",
         "distinct_pairs", "line_words", "ended")
_CLASSES = {"upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "bang": "!?",
            "bar": "|<>{}[]\\/=_~^", "symbol": "#$%&*@+", "stop": ".,", "other_punct": ";:'\"()-",
            "line": "\n"}


def _flags() -> dict[str, np.ndarray]:
    out = {}
    for name, chars in _CLASSES.items():
        lut = np.zeros(256, np.uint8)
        lut[[ord(c) for c in chars]] = 1
        out[name] = lut
    high = np.zeros(256, np.uint8)
    high[0xC0:] = 1
    out["high"] = high
    return out


def statistics(column):
    """Statistics of an Arrow string column: array (rows, len(STATS))."""
    luts, parts = _flags(), []
    for _, data, offs in text_chunks(column):
        n = len(offs) - 1
        x = np.zeros((n, len(STATS)))
        size = np.diff(offs).astype(float)
        if len(data) == 0:
            parts.append(x)
            continue
        some = np.maximum(size, 1)
        col = {}
        for name, lut in luts.items():
            padded = np.concatenate([lut[data], np.zeros(1, np.uint8)])
            got = np.add.reduceat(padded, offs[:-1], dtype=np.int64).astype(float)
            col[name] = np.where(size > 0, got, 0)
        h, at = word_hashes(data, offs)
        n_words = np.diff(at).astype(float)
        words = np.maximum(n_words, 1)
        same = np.zeros(len(h) + 1)
        if len(h) > 1:
            same[1:-1] = h[1:] == h[:-1]
        pair = h.copy()
        if len(h) > 1:
            pair[:-1] = h[:-1] * np.uint64(31) + h[1:] * np.uint64(0x9E3779B97F4A7C15)
        distinct, top, pairs, ran = (np.zeros(n) for _ in range(4))
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
            if b > a:
                s = np.sort(h[a:b])
                edge = np.flatnonzero(s[1:] != s[:-1])
                runs = np.diff(np.concatenate([[-1], edge, [b - a - 1]]))
                distinct[i], top[i] = len(runs), runs.max()
                ran[i] = same[a + 1:b].sum()
                if b - a > 1:
                    q = np.sort(pair[a:b - 1])
                    pairs[i] = 1 + np.count_nonzero(q[1:] != q[:-1])
        last = data[np.maximum(offs[1:] - 1, 0)]
        values = {
            "log_bytes": np.log1p(size), "log_words": np.log1p(n_words),
            "word_bytes": size / words, "distinct": distinct / words, "top_word": top / words,
            "same_next": ran / words, "distinct_pairs": pairs / np.maximum(n_words - 1, 1),
            "line_words": np.log1p(n_words / (col["line"] + 1)),
            "ended": (size > 0) & np.isin(last, [ord(c) for c in ".!?"]),
        }
        for j, name in enumerate(STATS):
            x[:, j] = values[name] if name in values else col[name] / (
                words if name in ("bang", "bar", "symbol", "stop", "other_punct", "line") else some)
        parts.append(x)
    return np.concatenate(parts) if parts else np.zeros((0, len(STATS)))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, stats array<double>) for every row of ``docs``."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa
        for b in batches:
            x = statistics(b.column(1))
            flat = pa.array(x.ravel())
            offs = pa.array(np.arange(0, x.size + 1, len(STATS), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(offs, flat)], names=[id_col, "stats"])

    small_batches(docs.sparkSession)
    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, stats array<double>")


@dataclass
class QualityModel:
    """Everything a task needs to score statistics."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    phase: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.cos(z @ self.w + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([f, z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1)


def isotonic(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Non-decreasing fit to ``ones / total`` by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for n, y in zip(total.tolist(), ones.tolist()):
        blocks.append([n, y, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, y2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + y2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), y / n) for n, y, k in blocks])


def fit(train: DataFrame, n_features: int = 256, ridge: float = 1e-4, width: float = 1.0,
        bins: int = 1000, seed: int = 11) -> QualityModel:
    """Fit from rows (stats array<double>, y double in 0..1)."""
    k = len(STATS)
    train = stash(train.select("stats", F.col("y").cast("double").alias("y")), "quality-train")
    cols = [F.col("stats")[i] for i in range(k)]
    m = train.agg(F.count(F.lit(1)), F.avg("y"), *[F.avg(c) for c in cols],
                  *[F.stddev_pop(c) for c in cols]).first()
    n, share = m[0], m[1]
    mean = np.array([v or 0.0 for v in m[2:2 + k]])
    scale = np.array([v if v and v > 1e-9 else 1.0 for v in m[2 + k:]])
    rng = np.random.default_rng(seed)
    w = rng.normal(size=(k, n_features)) * width / np.sqrt(k)
    phase = rng.uniform(0, 2 * np.pi, n_features)
    empty = np.zeros(n_features + k + 1)
    model = QualityModel(mean, scale, w, phase, empty, np.array([0.0, 1.0]),
                         np.array([0.5, 0.5]) if not n else np.array([share, share]))
    if not n or share in (0.0, 1.0):
        return model
    d = len(empty)

    def sums(batches):
        import pandas as pd
        acc = np.zeros((d, d + 1))
        for b in batches:
            if len(b):
                f = model.features(np.stack(b["stats"].to_numpy()))
                acc[:, :d] += f.T @ f
                acc[:, d] += f.T @ b["y"].to_numpy()
        yield pd.DataFrame({"i": np.arange(d, dtype=np.int32), "row": list(acc)})

    def add(pdf):
        import pandas as pd
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "row": [np.sum(np.stack(pdf["row"]), axis=0)]})

    shape = "i int, row array<double>"
    rows = train.mapInPandas(sums, shape).groupBy("i").applyInPandas(add, shape).collect()
    eq = np.stack([r["row"] for r in sorted(rows, key=lambda r: r["i"])])
    model.beta = np.linalg.solve(eq[:, :d] + ridge * n * np.eye(d), eq[:, d])

    def binned(batches):
        import pandas as pd
        for b in batches:
            if len(b):
                v = model.raw(np.stack(b["stats"].to_numpy()))
                yield pd.DataFrame({"bin": np.clip(np.floor(v * bins), -bins, 2 * bins)
                                    .astype(np.int32), "v": v, "y": b["y"]})

    curve = (train.mapInPandas(binned, "bin int, v double, y double").groupBy("bin")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), F.avg("v").alias("v"))
             .orderBy("bin").collect())
    total, ones = (np.array([float(r[c]) for r in curve]) for c in ("n", "y"))
    model.knots = np.array([r["v"] for r in curve])
    # a thousandth of the line through the blocks keeps scores inside one apart
    model.levels = 0.999 * isotonic(total, ones) + 0.001 * np.clip(model.knots, 0, 1)
    return model


def labelled(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             label_col: str = "quality") -> DataFrame:
    """Rows (stats, y) of the documents that have a label."""
    y = (labels.filter(labels[label_col].isNotNull() & labels[id_col].isNotNull())
         .groupBy(labels[id_col].alias("__id"))
         .agg(F.when(F.avg(labels[label_col]) >= 0.5, 1.0).otherwise(0.0).alias("y")))
    return stats.join(y, stats[id_col] == y["__id"]).select("stats", "y")


def score(stats: DataFrame, model: QualityModel, id_col: str = "doc_id") -> DataFrame:
    """(id_col, score) for rows of ``with_statistics``."""
    kind = dict(stats.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa
        for b in batches:
            x = np.asarray(b.column(1).flatten()).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))],
                                             names=[id_col, "score"])

    return stats.select(id_col, "stats").mapInArrow(run, f"`{id_col}` {kind}, score double")


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text",
              least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more, all columns."""
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(model.score(statistics(b.column(at))) >= least))

    return docs.mapInArrow(run, docs.schema)
