"""Embedding near-duplicates: extreme norms, repeated and missing ids, clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import queries, vectors

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, least=0.98):
    """{row index: links}, and the components of ids."""
    ok = []
    for _, v, lab in rows:
        a = None if v is None or None in v else np.array(v, float)
        good = lab is not None and a is not None and len(a) and np.isfinite(a).all() and a.any()
        ok.append(a / np.abs(a).max() if good else None)
    n = len(rows)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if ok[i] is not None and ok[j] is not None and rows[i][2] == rows[j][2] and len(ok[i]) == len(ok[j]):
                c = ok[i] @ ok[j] / np.sqrt((ok[i] @ ok[i]) * (ok[j] @ ok[j]))
                link[i, j] = link[j, i] = c >= least
    comp = {r[0]: r[0] for r in rows if r[0] is not None}
    for _ in range(n):
        for i, j in zip(*np.nonzero(link)):
            a, b = rows[i][0], rows[j][0]
            if a is not None and b is not None:
                comp[a] = comp[b] = min(comp[a], comp[b])
    return link.sum(axis=1), comp


def check(spark, rows, **kw):
    got = vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA), **kw).collect()
    n_links, comp = brute(rows)
    want = sorted((r[0] is None, r[0] or 0, int(k), comp.get(r[0])) for r, k in zip(rows, n_links))
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in got) == want
    return n_links


@pytest.mark.parametrize("cell_rows", [2000, 4])
def test_extreme_norms(spark, cell_rows):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(8, 12))
    rows = []
    for i, b in enumerate(base):
        for j, s in enumerate((1.0, 1e200, 1e-200, 1e300, 1e-300)):
            rows.append((10 * i + j, [float(x) for x in (b + rng.normal(scale=0.03, size=12)) * s], 1))
    rows += [(900, [1e308] * 12, 1), (901, [1.7e308] * 12, 1), (902, [1e-320] * 12, 1), (903, [-1.0] * 12, 1),
             (904, [0.0] * 12, 1)]
    n = check(spark, rows, cell_rows=cell_rows)
    assert n[:40].min() >= 1 and n[40] == 2


def test_repeated_and_missing_ids(spark):
    a, b, c = [1.0, 0.0, 0.1], [0.0, 1.0, 0.1], [0.0, 0.1, 1.0]
    check(spark, [(5, a, 1), (5, b, 1), (3, a, 1), (7, b, 1), (None, c, 1), (None, c, 1), (2, c, 2), (9, c, 1),
                  (5, a, 1), (None, None, None), (8, None, 1)])


def test_clashing_columns(spark):
    d = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)
    wide = d.select("*", *[F.lit(3).alias(x) for x in ("id", "v", "key", "n_links", "kept", "dim")])
    got = sorted(tuple(r) for r in vectors.near_duplicates(wide).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False)]


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    labels, vec = np.array([r[2] for r in rows]), np.array([r[1] for r in rows], float)
    u = vec / np.linalg.norm(vec, axis=1)[:, None]
    link = (u @ u.T >= 0.98) & (labels[:, None] == labels[None])
    comp = np.arange(len(rows))
    for _ in rows:
        new = np.array([comp[x].min() for x in link])
        if (new == comp).all():
            break
        comp = new
    ids = np.array([r[0] for r in rows])
    least = {c: ids[comp == c].min() for c in set(comp.tolist())}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in
           queries.op4_vectors(spark, "/root/testdata/sf0.001").collect()}
    assert got == {int(i): (int(link[k].sum() - 1), int(least[comp[k]])) for k, i in enumerate(ids)}
