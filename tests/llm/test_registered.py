"""The registered queries of the fitted operators over whole tables."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import katz, mixing, queries

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def good_turing(types_by_count, top=5):
    """Katz' ratios d(1..top) from Counter(count -> types), stated on its own."""
    n = [types_by_count.get(r, 0) for r in range(1, top + 2)]
    if not n[0]:
        return [1.0] * top
    tail = (top + 1) * n[top] / n[0]
    out = []
    for r in range(1, top + 1):
        d = 1.0
        if n[r - 1] and tail < 1:
            star = (r + 1) * n[r] / n[r - 1]
            x = (star / r - tail) / (1 - tail)
            d = x if 0 < x < 1 else 1.0
        out.append(d)
    return out


def katz_scores(rows):
    """Every token scored by the definition, over dicts."""
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(LOWER)) + [""] for i, x in rows}
    train = [w for i, w in words.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    one, two = collections.Counter(), collections.defaultdict(collections.Counter)
    for w in train:
        one.update(w)
        for h, x in zip([None, *w], w):
            two[h][x] += 1
    total = sum(one.values())
    d1 = good_turing(collections.Counter(one.values()))
    d2 = good_turing(collections.Counter(c for s in two.values() for c in s.values()))
    cut = lambda c, d: c * (d[c - 1] if c <= 5 else 1.0)
    unknown = 1 - sum(cut(c, d1) for c in one.values()) / total
    assert unknown > 0
    p1 = lambda x: cut(one[x], d1) / total if one[x] else unknown
    alpha = {}
    out = {}
    for i, w in words.items():
        score = 0.0
        for h, x in zip([None, *w], w):
            seen = two.get(h)
            if seen and seen[x]:
                score += math.log10(cut(seen[x], d2) / sum(seen.values()))
                continue
            if seen and h not in alpha:
                seen = +seen
                left = 1 - sum(cut(c, d2) for c in seen.values()) / sum(seen.values())
                alpha[h] = left / (1 - sum(map(p1, seen)))
            # a history with nothing left: the floor of an unknown word
            score += math.log10(max(alpha[h] if seen else 1.0, max(unknown, 1e-12) / total) * p1(x))
        base = sum(math.log10((one[x] + 1) / (total + len(one) + 1)) for x in w)
        out[i] = (len(w), sum(one[x] > 0 for x in w), total, base, score)
    return out


def test_op8_katz(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    want = katz_scores(rows)
    got = queries.op8_katz(spark, SMALL).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert r["base_score"] == pytest.approx(w[3]) and r["score"] == pytest.approx(w[4])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)


@pytest.mark.parametrize("common", [0, 1, 37])
def test_common_words_change_no_score(spark, common):
    """Few or no common words: the joins do the rest."""
    d = table(spark, SMALL, "documents").filter("doc_id < 40").select("doc_id", "text")
    whole = {r["doc_id"]: r["score"] for r in katz.score_documents(d).collect()}
    few = {r["doc_id"]: r["score"] for r in katz.score_documents(d, common=common).collect()}
    assert few == pytest.approx(whole)


def test_op5_mixing(spark):
    """Expected token totals, recomputed from the rows, meet the targets; no
    rates within the bounds come nearer (they meet them)."""
    got = queries.op5_mixing(spark, MIDDLE).toPandas()
    docs = table(spark, MIDDLE, "documents").toPandas().set_index("doc_id")
    assert sorted(got["doc_id"]) == sorted(docs.index)
    tokens = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs["text"].items()}
    assert (got["tokens"] == got["doc_id"].map(tokens)).all()
    p = got[[f"p_{d}" for d in sorted(queries.MIX_WEIGHTS)]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1) and got["rate"].between(0, 4).all()
    share = (got["tokens"] * got["rate"]).to_numpy() @ p / got["tokens"].sum()
    assert share == pytest.approx([queries.MIX_WEIGHTS[d] for d in sorted(queries.MIX_WEIGHTS)], abs=2e-3)
    assert (got["copies"] - got["rate"]).between(-1, 1).all()
    # posteriors follow the labels
    labels = table(spark, MIDDLE, "labels").toPandas()
    both = got.merge(labels, on="doc_id")
    bad = (both["toxic"] == 1) | (both["quality"] == 0)
    assert ((both["p_clean"] < 0.5) == bad).mean() > 0.9


def test_mixing_samples_without_gathering(spark):
    """More labels than the sample: about as many rows, from both domains, and
    targets out of reach are reported."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 4 = 0 THEN concat('bad word ', id) "
                                        "ELSE concat('good text ', id) END AS text")
    labels = docs.selectExpr("doc_id", "CASE WHEN doc_id % 4 = 0 THEN 'bad' ELSE 'good' END AS domain")
    model = mixing.learn_domains(docs, labels, sample=500)
    members = mixing.memberships(docs, model).cache()
    p = np.stack(members.toPandas().sort_values("doc_id")["posterior"])
    assert ((p[:, model.domains.index("bad")] > 0.5) == (np.arange(4000) % 4 == 0)).all()
    mixing.fit_rates(members, model, {"good": 0.9, "bad": 0.1})
    assert max(map(abs, model.missed.values())) < 1e-3
    mixing.fit_rates(members, model, {"good": 0.1, "bad": 0.9}, max_rate=1.0)
    assert model.missed["bad"] == pytest.approx(0.25 - 0.9, abs=0.02)
    members.unpersist()


def test_op6_quality(spark):
    got = queries.op6_quality(spark, MIDDLE).toPandas()
    assert len(got) == table(spark, MIDDLE, "documents").count() and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.5)).all()
    crc = got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)
    assert (got["held_out"] == crc).all()
    both = got.merge(table(spark, MIDDLE, "labels").toPandas(), on="doc_id")
    held = both[both["held_out"]]
    assert len(held) > 20 and (held["predicted"] == held["quality"]).mean() > 0.9
    # labels of held-out rows play no part
    labels = table(spark, MIDDLE, "labels")
    seen = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    from ledgerlake.llm import quality
    stats = quality.with_statistics(table(spark, MIDDLE, "documents"))
    train = quality.labelled(stats.filter(seen), labels.filter(seen))
    again = quality.score(stats, quality.fit(train)).toPandas().set_index("doc_id")["score"]
    assert np.allclose(got.set_index("doc_id")["score"], again.loc[got["doc_id"]], atol=1e-6)


def test_domains_by_the_beginning_of_words(spark):
    """What marks a domain may be a family of words, each of them rare, and
    words that always come with it; separable labels make no wild weights."""
    rows = [(i, f"calm text {i} of the plain kind" if i % 4 else f"calm text {i} has vilest{i}x and also nastie{i}y")
            for i in range(1600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = docs.selectExpr("doc_id", "CASE WHEN doc_id % 4 = 0 THEN 'bad' ELSE 'good' END AS domain")
    model = mixing.learn_domains(docs, labels.filter("doc_id < 800"))
    out = mixing.memberships(docs, model).toPandas().set_index("doc_id")
    p = np.stack(out["posterior"].loc[range(1600)])[:, model.domains.index("bad")]
    assert ((p > 0.5) == (np.arange(1600) % 4 == 0)).all()
    assert np.isfinite(model.weight).all() and np.abs(model.weight).max() < 50
    many = labels.selectExpr("doc_id", "concat('d', doc_id % 40) AS domain")  # more domains than features
    assert len(mixing.learn_domains(docs, many, n_features=40).domains) == 40
