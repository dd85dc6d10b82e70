"""Embedding near-duplicates: subspace pigeonhole join.

Two vectors of one label link when their cosine is at least ``least``. For
unit vectors that is a squared distance of at most ``2 - 2 * least``. A fixed
random rotation spreads the distance over all axes; the axes are split into
blocks of about ``block`` axes, and each block gets a share of the squared
distance in proportion to its axes. A linked pair is within its share in one
block at least, so range joins over the blocks lose no pair.

The range join of a block lays a grid over its first axes (more axes for more
vectors, so cells keep their size; 0 for few). A vector is at home in one cell
and a guest in lower cells within reach. Cells holding over ``cell_rows``
vectors are split into chunk pairs. A task compares its vectors in numpy,
checks each candidate's cosine in double precision, and counts a pair only in
the first block that finds it, so pairs are never listed or made distinct:
tasks return link counts and a spanning forest.

Equal vectors of a label (equal up to a power of two) are one class, compared
once and counted by its size.

Defined results: null, empty and zero vectors, vectors with null or non-finite
parts, and vectors with a null label link with nothing; vectors of different
length don't link; rows that repeat an id are rows of their own and one vertex
of the components; a row without an id counts as a vector, links its
neighbours only by way of rows that have ids, and gets a null component; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, stash


def _rotation(dim: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng((seed, dim)).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _blocks(dim: int, block: int) -> list[np.ndarray]:
    return np.array_split(np.arange(dim), max(1, round(dim / block)))


def _budgets(dim: int, blocks, least: float) -> np.ndarray:
    return np.array([(2 - 2 * least) * len(b) / dim * (1 + 1e-7) + 1e-12 for b in blocks])


def keyed(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, dim, key, v): v the vector as float64 bytes, scaled by a power
    of two, null when the row can't link."""
    def run(batches):
        import pandas as pd
        for b in batches:
            raw, keys, dims = [], [], []
            for x, lab in zip(b["v"], b["label"]):
                a = None
                if x is not None and lab is not None and lab == lab:
                    try:
                        a = np.asarray(x, dtype=np.float64) + 0.0
                    except (TypeError, ValueError):  # a null part
                        a = None
                if a is None or not len(a) or not np.isfinite(a).all() or not a.any():
                    raw.append(None), keys.append(None), dims.append(0)
                else:
                    # a power of two brings the largest part near 1: no square
                    # overflows or vanishes, and the direction is the same
                    a = np.ldexp(a, -int(np.frexp(np.abs(a).max())[1])) + 0.0
                    raw.append(a.tobytes()), dims.append(len(a))
                    keys.append(hashlib.blake2b(raw[-1], digest_size=16).digest())
            yield pd.DataFrame({"id": b["id"], "label": b["label"], "dim": dims, "key": keys, "v": raw})

    rows = vectors.select(vectors[id_col].cast("bigint").alias("id"),
                          vectors[label_col].cast("string").alias("label"),
                          vectors[vec_col].alias("v"))
    return rows.mapInPandas(run, "id bigint, label string, dim int, key binary, v binary")


def _spread(axes: int, block: int, least: float, seed: int, vectors: bool):
    """Task code: every vector to the cells of each block (home and guest)."""
    def run(batches):
        import pandas as pd
        for b in batches:
            if not len(b):
                continue
            for dim, part in b.groupby("dim"):
                dim = int(dim)
                v = np.frombuffer(b"".join(part["v"]), np.float64).reshape(-1, dim)
                u = v / np.linalg.norm(v, axis=1)[:, None]
                x = u @ _rotation(dim, seed)
                blocks = _blocks(dim, block)
                for k, (own, r2) in enumerate(zip(blocks, _budgets(dim, blocks, least))):
                    r = math.sqrt(r2) * (1 + 1e-9)
                    g = x[:, own[:axes]]
                    width = 2.5 * r
                    home = np.floor(g / width).astype(np.int64)
                    reach = [(np.floor((g - r) / width).astype(np.int64) - home),
                             (np.floor((g + r) / width).astype(np.int64) - home)]
                    zero = (0,) * g.shape[1]
                    for step in itertools.product((-1, 0, 1), repeat=g.shape[1]):
                        if step > zero:
                            continue  # guests only in lower cells
                        s = np.array(step, np.int64)
                        in_reach = np.ones(len(g), bool)
                        for a, d in enumerate(step):
                            if d:
                                in_reach &= (reach[0] if d < 0 else reach[1])[:, a] == d
                        at = np.flatnonzero(in_reach)
                        if not len(at):
                            continue
                        cell = [",".join(map(str, c)) for c in (home[at] + s).tolist()]
                        out = {"label": part["label"].to_numpy()[at], "dim": dim, "block": k,
                               "cell": cell, "home": step == zero,
                               "key": part["key"].to_numpy()[at]}
                        if vectors:
                            out |= {c: part[c].to_numpy()[at] for c in ("rep", "mult", "v")}
                        yield pd.DataFrame(out)
    return run


def _compare(block: int, least: float, seed: int):
    """Task code: link counts and a spanning forest of one cell (or chunk pair)."""
    def run(pdf):
        import pandas as pd
        k, dim = int(pdf["block"].iloc[0]), int(pdf["dim"].iloc[0])
        same = bool((pdf["lo"] == pdf["hi"]).iloc[0])
        pdf = pdf.sort_values("key", kind="stable").reset_index(drop=True)
        v = np.frombuffer(b"".join(pdf["v"]), np.float64).reshape(-1, dim)
        norm = np.linalg.norm(v, axis=1)
        x = (v / norm[:, None]) @ _rotation(dim, seed)
        blocks = _blocks(dim, block)
        limit = _budgets(dim, blocks, least)
        own = x[:, blocks[k]]
        sq = (own * own).sum(axis=1)
        home, mult = pdf["home"].to_numpy(bool), pdf["mult"].to_numpy(np.int64)
        chunk, rep = pdf["chunk"].to_numpy(), pdf["rep"].to_numpy()
        m = len(pdf)
        links, label, edges = np.zeros(m, np.int64), np.arange(m), []
        begin = np.array([b[0] for b in blocks])
        for a in range(0, m, 512):
            z = min(a + 512, m)
            d2 = sq[a:z, None] + sq[None, a:] - 2 * own[a:z] @ own[a:].T
            i, j = np.nonzero(d2 <= limit[k] + 1e-9)
            i, j = i + a, j + a
            ok = (j > i) & (home[i] | home[j])
            if not same:
                ok &= chunk[i] != chunk[j]
            i, j = i[ok], j[ok]
            for s in range(0, len(i), 50_000):
                p, q = i[s:s + 50_000], j[s:s + 50_000]
                far = np.add.reduceat((x[p] - x[q]) ** 2, begin, axis=1) <= limit
                hit = (far.argmax(axis=1) == k) & far[:, k]
                hit &= (v[p] * v[q]).sum(axis=1) / (norm[p] * norm[q]) >= least
                p, q = p[hit], q[hit]
                np.add.at(links, p, mult[q])
                np.add.at(links, q, mult[p])
                # only pairs of two trees so far need a step
                while len(p):
                    open_ = np.flatnonzero(label[p] != label[q])
                    if not len(open_):
                        break
                    p, q = p[open_], q[open_]
                    c, e = p[0], q[0]
                    edges.append((rep[c], rep[e]))
                    label[label == label[e]] = label[c]
        got = np.flatnonzero(links)
        out = pd.DataFrame({"label": pdf["label"].to_numpy()[got], "key": pdf["key"].to_numpy()[got],
                            "n": links[got]})
        out = out.assign(a=pd.array([None] * len(out), dtype="Int64"),
                         b=pd.array([None] * len(out), dtype="Int64"))
        tree = [(a, b) for a, b in edges if a == a and b == b and a is not None and b is not None]
        forest = pd.DataFrame({"label": [None] * len(tree), "key": [None] * len(tree),
                               "n": np.zeros(len(tree), np.int64),
                               "a": pd.array([int(t[0]) for t in tree], dtype="Int64"),
                               "b": pd.array([int(t[1]) for t in tree], dtype="Int64")})
        return pd.concat([out, forest], ignore_index=True)
    return run


def _same_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes of each id that comes with several vectors."""
    one = F.struct("label", "key")
    several = (rows.filter("v IS NOT NULL AND id IS NOT NULL").groupBy(F.col("id").alias("i"))
               .agg(F.min(one).alias("lo"), F.max(one).alias("hi")).filter("lo != hi").select("i"))
    of = (rows.filter("v IS NOT NULL").join(several, F.col("id") == F.col("i"), "left_semi")
          .select("id", F.col("label").alias("l"), F.col("key").alias("k")).distinct())
    of = of.join(classes.select("label", "key", "rep"), (F.col("l") == F.col("label")) & (F.col("k") == F.col("key")))
    # every class has an id here, so its number is one, and meets the id itself
    return of.filter("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", least: float = 0.98, block: int = 8,
                    cell_rows: int = 2000, seed: int = 5) -> DataFrame:
    """(id_col, n_links, component_id, kept): one row per input row."""
    rows = stash(keyed(vectors, id_col, vec_col, label_col), "vectors")
    good = rows.filter("v IS NOT NULL")
    classes = stash(good.groupBy("label", "dim", "key").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"), F.first("v").alias("v")),
        "vector-classes")
    most = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    # three grid steps an axis divide a label's vectors about threefold
    axes = max(0, math.ceil(math.log(max(most / cell_rows, 1)) / math.log(3)))
    axes = min(axes, block - 1)
    place = "label string, dim int, block int, cell string, home boolean, key binary"
    cell = ["label", "dim", "block", "cell"]
    sizes = (classes.select("label", "dim", "key", "v")
             .mapInPandas(_spread(axes, block, least, seed, False), place)
             .groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.max(F.col("home").cast("int")).alias("h"))
             .filter("n > 1 AND h = 1")
             .select(*[F.col(c).alias(f"s_{c}") for c in cell],
                     F.ceil(F.col("n") / cell_rows).cast("int").alias("chunks")))
    spread = (classes.mapInPandas(_spread(axes, block, least, seed, True),
                                  place + ", rep bigint, mult bigint, v binary")
              .join(stash(sizes, "vector-cells"), [F.col(c) == F.col(f"s_{c}") for c in cell]))
    spread = (spread.withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .withColumns({"lo": F.least("chunk", "other"), "hi": F.greatest("chunk", "other")})
              .drop("other", "chunks", *[f"s_{c}" for c in cell]))
    found = stash(spread.groupBy(*cell, "lo", "hi").applyInPandas(
        _compare(block, least, seed), "label string, key binary, n bigint, a bigint, b bigint"),
        "vector-links")
    links = (found.filter("a IS NULL").groupBy(F.col("label").alias("l_label"),
                                               F.col("key").alias("l_key"))
             .agg(F.sum("n").alias("n")))
    parts = components(found.filter("a IS NOT NULL").select("a", "b").unionAll(_same_id(rows, classes)),
                       "vector-components")
    info = (classes.select("label", "key", "rep", "mult")
            .join(links, (F.col("label") == F.col("l_label")) & (F.col("key") == F.col("l_key")), "left")
            .join(parts, F.col("rep") == F.col("v"), "left")
            .select(F.col("label").alias("c_label"), F.col("key").alias("c_key"),
                    (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                    F.coalesce("component", "rep").alias("comp")))
    out = rows.select("id", "label", "key").join(
        info, (F.col("label") == F.col("c_label")) & (F.col("key") == F.col("c_key")), "left")
    comp = F.when(F.col("id").isNotNull(), F.coalesce("comp", "id"))
    return out.select(F.col("id").alias(id_col),
                      F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(False)).alias("kept"))
