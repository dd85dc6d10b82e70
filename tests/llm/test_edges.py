"""Empty tables, nulls, ties, repeated rows and clashing columns, operator by operator."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard, katz, langid, mixing, quality, queries, sharding, urlrules, warc

DOCS = "doc_id bigint, text string"


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def clash(df, *names):
    return df.select("*", *[F.lit(9).alias(c) for c in names])


def test_warc_empty_and_clashing(spark):
    schema = "page_id bigint, url string, html string"
    root = warc.write_archive(spark.createDataFrame([], schema))
    assert warc.read_archive(spark, root).count() == 0
    rows = spark.createDataFrame([(1, "u", "x" * 1000), (2, "u", "x" * 1000), (2, "u", "x" * 1000)], schema)
    root = warc.write_archive(clash(rows, "id", "payload", "key", "digest", "n", "leader", "header", "k"))
    got = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in warc.read_archive(spark, root).collect())
    assert got == [(1, "revisit", 2), (2, "response", None), (2, "response", None)]


def test_url_rules_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "http://a.net/es/x"), (1, "http://a.net/es/x"), (None, "http://a.org/")],
                                 "page_id bigint, url string")
    wide = clash(rows, "host", "path", "rule", "verdict", "items", "hit", "u", "given", "scope", "token")
    got = urlrules.judge(wide, queries.URL_RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "mined_confidence"]
    assert sorted(((r["page_id"] or 0), r["rule"], r["verdict"]) for r in got.collect()) == [
        (0, None, "allow"), (1, "net/es/", "block"), (1, "net/es/", "block")]


def test_one_rule_per_posting(spark):
    """A token that all sets share finds no rule that has a rarer one; a rule
    with a token that no set has fires nowhere."""
    sets = spark.createDataFrame([([f"all", f"t{i}"],) for i in range(50)], "items array<string>")
    rules = spark.createDataFrame([(1, ["all"], "allow", 0.9), (2, ["all", "t3"], "block", 1.0),
                                   (3, ["all", "none"], "block", 1.0), (4, ["t3", "t4"], "block", 1.0)],
                                  "rule_id bigint, tokens array<string>, verdict string, confidence double")
    got = {(r["items"][1], r["rule_id"]) for r in urlrules._met(sets, rules).collect()}
    assert got == {(f"t{i}", 1) for i in range(50)} | {("t3", 2)}


def test_quality_empty_and_ties(spark):
    good = [(i, f"A plain sentence number {i} about the river, told well. It goes on.") for i in range(40)]
    bad = [(100 + i, f"$$$ BUY!!! {i} CLICK >>> NOW %%%") for i in range(40)]
    rows = docs(spark, good + bad)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad]
                                   + [(0, 0), (None, 1), (1, None)], "doc_id bigint, quality int")
    stats = quality.with_statistics(rows)
    model = quality.fit(quality.labelled(stats, labels), n_features=16)
    odd = docs(spark, [(1, None), (2, ""), (None, "text"), (4, "text"), (4, "text"), (5, "word " * 200_000)])
    got = quality.score(quality.with_statistics(clash(odd, "stats", "score", "bin", "quality")), model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1
    assert quality.score(quality.with_statistics(docs(spark, [])), model).count() == 0
    assert quality.keep_good(docs(spark, []), model).count() == 0
    # one label only, or none at all: every score is defined
    for some in (labels.filter("quality = 1"), labels.limit(0)):
        flat = quality.fit(quality.labelled(stats, some), n_features=16)
        assert all(0 <= r["score"] <= 1 for r in quality.score(stats, flat).collect())
    # equal texts under both labels
    tie = docs(spark, [(i, "the same text") for i in range(10)])
    both = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id bigint, quality int")
    st = quality.with_statistics(tie)
    scores = {r["score"] for r in quality.score(st, quality.fit(quality.labelled(st, both), n_features=4)).collect()}
    assert len(scores) == 1 and scores.pop() == pytest.approx(0.5, abs=0.05)


def test_mixing_empty_documents_and_null_ids(spark):
    rows = [(i, f"good plain text {i}") for i in range(60)] + [(100 + i, f"vile nasty text {i}") for i in range(60)]
    odd = [(None, "good plain text"), (None, "vile nasty text"), (500, None), (501, ""), (502, " \n"), (0, rows[0][1])]
    d = docs(spark, rows + odd)
    labels = spark.createDataFrame([(i, "good" if i < 100 else "bad") for i, _ in rows] + [(None, "bad"), (7, None)],
                                   "doc_id bigint, domain string")
    model = mixing.learn_domains(d, labels)
    members = mixing.memberships(clash(d, "domain", "tokens", "posterior", "rate"), model)
    mixing.fit_rates(members, model, {"good": 0.9, "bad": 0.1})
    out = mixing.rated(members, model).toPandas()
    assert len(out) == len(rows) + len(odd)
    empty = out[out["doc_id"].isin([500, 501, 502])]
    assert (empty["tokens"] == 0).all() and empty["rate"].nunique() == 1
    p = np.stack(out["posterior"])
    share = (out["tokens"] * out["rate"]).to_numpy() @ p / out["tokens"].sum()
    assert share[model.domains.index("good")] == pytest.approx(0.9, abs=0.01)
    assert mixing.rated(mixing.memberships(docs(spark, []), model), model).count() == 0
    mixing.fit_rates(mixing.memberships(docs(spark, []), model), model, {"good": 1.0})
    assert mixing.apply_rates(docs(spark, []), model).count() == 0


def test_jaccard_and_others_with_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = clash(docs(spark, [(2, text), (1, text), (3, "other words"), (None, text)]),
                 "id", "n", "t", "s1", "s2", "rep", "h", "tile", "lang", "component_id")
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in
                 jaccard.similar_documents(rows).collect())
    assert got == [(0, 27, None), (1, 27, 1), (2, 27, 1), (3, 1, 3)]
    assert jaccard.similar_documents(docs(spark, [])).count() == 0
    assert sorted(r["doc_id"] for r in jaccard.first_copies(rows).collect()) == [1, 3]
    assert katz.score_documents(rows).count() == 4
    assert langid.predict(rows, langid.learn(rows.withColumn("lang", F.lit("en")))).count() == 4
    assert sharding.kd_shards(rows, ["n", "lang"], n_shards=2).count() == 4
