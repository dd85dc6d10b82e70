"""Every operator against brute force on small tables, and its edge cases."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import (decontaminate, jaccard, katz, langid, mixing, quality, queries,
                            sharding, urlrules, vectors, warc)
from ledgerlake.llm.common import components
from ledgerlake.llm.oracles import ORACLES

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# nulls, empty and blank texts, repeated rows, a clashing column, long text
ODD = [(1, None, 1), (2, "", 2), (3, " \n\t", 3), (4, "one two", 4), (4, "one two", 4),
       (None, "one two three four five six", 5), (6, "One TWO three four five six", 6),
       (7, "word " * 30_000, 7), (8, "ñé ü 漢字 😀", 8)]
ODD_SCHEMA = "doc_id bigint, text string, score int"


def words(x):
    return re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(LOWER))


def odd(spark):
    return spark.createDataFrame(ODD, ODD_SCHEMA)


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def shingle_set(x, k):
    w = words(x)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = db.execute(f"select {', '.join(got.columns)} from ({ORACLES[name]})").fetchall()
    assert want and collections.Counter(want) == collections.Counter(tuple(r) for r in got.collect())


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(1, 20)] + [(30, 31), (31, 30)], "a bigint, b bigint")
    got = {r["v"]: r["component"] for r in components(e).collect()}
    assert got == {**{i: 1 for i in range(1, 21)}, 30: 30, 31: 30}


@pytest.mark.parametrize("percent,width", [(85, 4), (80, 5)])
def test_jaccard(spark, percent, width):
    near = [(1000 + i, " ".join(f"w{j}" for j in range(90) if j not in (i, i + 9)) + f" x{i}", 0)
            for i in range(0, 60, 3)]
    d = docs(spark).select("doc_id", "text", F.lit(0).alias("score")).unionAll(
        spark.createDataFrame(near, ODD_SCHEMA))
    rows = [(r["doc_id"], shingle_set(r["text"], width)) for r in d.collect()]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, (i, s) in enumerate(rows):
        for j, t in rows[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    got = jaccard.similar_documents(d, width=width, percent=percent, chunk_rows=4).collect()
    assert {(r[0], r[1], r[2]) for r in got} == {(i, len(s), find(i)) for i, s in rows}


def test_jaccard_odd(spark):
    got = collections.Counter(tuple(r) for r in jaccard.similar_documents(odd(spark)).collect())
    assert got == collections.Counter([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4),
                                       (None, 3, None), (6, 3, 6), (7, 1, 7), (8, 1, 8)])
    assert jaccard.similar_documents(odd(spark).limit(0)).count() == 0


def test_jaccard_repeated_ids(spark):
    """An id with two texts is one vertex; the links of both texts count."""
    text = lambda a: " ".join(f"{a}{j}" for j in range(60))
    rows = []
    for k in range(8):  # id 10k + 5: a near copy of 10k + 6 and one of 10k + 7
        a, b = text(f"a{k}x"), text(f"b{k}x")
        rows += [(10 * k + 5, a, 0), (10 * k + 5, b, 0), (10 * k + 6, a + " end", 0), (10 * k + 7, b + " end", 0)]
    got = jaccard.similar_documents(spark.createDataFrame(rows, ODD_SCHEMA)).collect()
    assert len(got) == 32 and {(r[0], r[2]) for r in got} == {
        (10 * k + i, 10 * k + 5) for k in range(8) for i in (5, 6, 7)}


def test_decontaminate_odd(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (4, "two THREE four five six")],
                                  "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(odd(spark), items).collect()}
    assert got == {(4, 3), (6, 3), (6, 4)}
    assert decontaminate.find_items(odd(spark), items.limit(0)).count() == 0


def test_shards(spark):
    got = queries.op3_shard(spark, SF).toPandas()
    text = {r["doc_id"]: r["text"] for r in docs(spark).collect()}
    assert len(got) == len(text) and set(got["shard"]) <= set(range(40))
    for r in got.itertuples():
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    for _, s in got.groupby("shard"):
        assert sorted(s["slot"]) == list(range(len(s)))
    out = sharding.kd_shards(odd(spark), ["score"], n_shards=3).toPandas()
    assert len(out) == len(ODD) and set(out["shard"]) <= {0, 1, 2}
    assert sharding.kd_shards(odd(spark).limit(0), ["score"], n_shards=3).count() == 0
    even = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"),
                                    (F.col("id") % 7).alias("score"))
    sizes = sharding.kd_shards(even, ["score"], n_shards=5).groupBy("shard").agg(
        F.sum("size").alias("b")).toPandas()["b"]
    assert len(sizes) == 5 and sizes.max() < 1.03 * sizes.min()


def test_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    v = np.vstack([base, base[:20] + rng.normal(scale=0.05, size=(20, 16)), base[:5], 3 * base[5:8]])
    rows = [(i, [float(x) for x in r], i % 2) for i, r in enumerate(v)]
    rows += [(100, None, 0), (101, [0.0] * 16, 0), (102, [1.0, float("nan")], 0),
             (103, [1.0, None], 0), (104, rows[0][1], None), (105, [], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    u = v / np.linalg.norm(v, axis=1)[:, None]
    link = (u @ u.T >= 0.98) & (np.arange(len(v))[:, None] % 2 == np.arange(len(v))[None] % 2)
    for cell_rows in (2000, 3):
        got = {r["vec_id"]: r for r in vectors.near_duplicates(df, cell_rows=cell_rows).collect()}
        assert len(got) == len(rows)
        comp = list(range(len(v)))
        for _ in v:
            comp = [min(comp[j] for j in np.flatnonzero(link[i])) for i in range(len(v))]
        for i in range(len(v)):
            assert (got[i]["n_links"], got[i]["component_id"]) == (link[i].sum() - 1, comp[i])
            assert got[i]["kept"] == (comp[i] == i)
        for i in range(100, 106):
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_quality(spark):
    stats = quality.with_statistics(odd(spark).unionAll(docs(spark).select(
        "doc_id", "text", F.lit(0).alias("score"))))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = quality.labelled(quality.with_statistics(full.filter("doc_id % 2 = 0")), labels)
    model = quality.fit(train, n_features=64)
    held = quality.score(quality.with_statistics(full.filter("doc_id % 2 = 1")), model).join(
        labels, "doc_id").toPandas()
    assert (held["score"].ge(0.5) == held["quality"].eq(1)).mean() > 0.95
    out = quality.score(stats, model).toPandas()
    assert out["score"].between(0, 1).all() and len(out) == len(ODD) + docs(spark).count()
    empty = quality.fit(train.limit(0))
    assert quality.score(quality.with_statistics(odd(spark)), empty).toPandas()["score"].eq(0.5).all()
    assert list(quality.isotonic(np.array([1.0, 1, 2]), np.array([1.0, 0, 2]))) == [0.5, 0.5, 1]


def test_langid(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prof = langid.learn(d.filter("doc_id % 2 = 0"))
    got = langid.predict(d.filter("doc_id % 2 = 1"), prof).join(d, "doc_id").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.95
    # one text by hand: ranks of its n-grams against each profile
    text = d.filter("doc_id = 1").first()["text"]
    grams = collections.Counter()
    s = re.sub("[^a-zà-ÿœß]+", "\x01", text.lower())
    for n in (1, 2, 3):
        grams.update(x for x in (s[i:i + n] for i in range(len(s) - n + 1)) if x.strip("\x01"))
    code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    top = sorted(grams, key=lambda g: (-grams[g], code(g)))[:400]
    dist = {k: sum(abs({int(x): r for r, x in enumerate(p)}.get(code(g), i + 400) - i)
                   for i, g in enumerate(top)) for k, p in prof.items()}
    row = got[got["doc_id"] == 1].iloc[0]
    assert row["lang_pred"] == min(sorted(dist), key=dist.get)
    assert row["score_x" if "score_x" in got else "score"] == pytest.approx(
        1 - min(dist.values()) / (len(top) * 400))
    out = {r["doc_id"]: r for r in langid.predict(odd(spark), prof).collect()}
    assert [out[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert langid.predict(odd(spark), {}).filter("lang_pred != 'und'").count() == 0


def _katz(rows, rest=2):
    toks = [(i, words(x) + ["\0"]) for i, x in rows]
    train = [t for i, t in toks if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != rest]
    uni, big = collections.Counter(), collections.defaultdict(collections.Counter)
    for t in train:
        uni.update(t)
        for h, w in zip(["\1"] + t, t):
            big[h][w] += 1
    n = sum(uni.values())
    ratio = lambda cc: katz.discounts([cc.get(r, 0) for r in range(1, 7)], 5)
    cu = collections.Counter(uni.values())
    first = katz.Unigrams(n, [float(cu.get(r, 0)) for r in range(1, 7)], 5)
    d = ratio(collections.Counter(c for b in big.values() for c in b.values()))
    cut = lambda c: c * (d[c - 1] if c <= 5 else 1)
    p1 = lambda w: float(first.p(np.array([uni[w]]))[0])
    for i, t in toks:
        score = 0.0
        for h, w in zip(["\1"] + t, t):
            b, ch = big.get(h), sum(big[h].values()) if h in big else 0
            if b and w in b:
                score += math.log10(cut(b[w]) / ch)
            else:
                alpha = (1 - sum(cut(c) for c in b.values()) / ch) / (1 - sum(map(p1, b))) if b else 1
                score += math.log10(max(alpha, max(first.unknown, 1e-12) / n) * p1(w))
        base = sum(math.log10((uni[w] + 1) / (n + len(uni) + 1)) for w in t)
        yield i, len(t), sum(uni[w] > 0 for w in t), n, base, score


def test_katz(spark):
    d = docs(spark).select("doc_id", "text")
    want = {r[0]: r for r in _katz([(r[0], r[1]) for r in d.collect()])}
    # few common words and small parts: the joins and the split histories work
    for kw in ({}, {"common": 50, "part_rows": 4000, "batch_tokens": 5000}):
        for r in katz.score_documents(d, **kw).collect():
            w = want[r["doc_id"]]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[1:4]
            assert (r["base_score"], r["score"]) == (pytest.approx(w[4]), pytest.approx(w[5]))
    got = katz.score_documents(odd(spark))
    assert got.count() == len(ODD) and got.filter("doc_id = 1").first()["n_tokens"] == 1
    assert katz.score_documents(odd(spark).limit(0)).count() == 0


def test_katz_without_singletons(spark):
    """No word occurs once in training: a new held-out word still has a price."""
    rows = [(i, "red green blue red green") for i in range(12)]
    held = next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows += [(held, "red unheard blue"), (held, "red green blue")]
    got = katz.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    new, old = sorted(r["score"] for r in got if r["doc_id"] == held)
    assert new < old - 1
    want = sorted(w[5] for w in _katz(rows) if w[0] == held)
    assert [new, old] == pytest.approx(want) and all(map(math.isfinite, want))
    u = katz.Unigrams(60, [0.0, 0, 0, 0, 0, 0], 5)
    assert u.unknown == pytest.approx(1 / 61) and u.p(np.array([24, 24, 12, 0])).sum() == pytest.approx(1)


def test_mixing(spark):
    full = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], "good") for r in full.select("doc_id").filter("doc_id % 2 = 0").collect()]
    marked = full.withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" zzbad")))
                             .otherwise(F.col("text")))
    labels = spark.createDataFrame([(i, "bad" if i % 5 == 0 else g) for i, g in rows],
                                   "doc_id bigint, domain string")
    model = mixing.learn_domains(marked, labels)
    members = mixing.memberships(marked, model)
    mixing.fit_rates(members, model, {"good": 0.95, "bad": 0.05})
    out = mixing.rated(members, model).toPandas()
    p = np.stack(out["posterior"])
    bad = model.domains.index("bad")
    assert ((p[:, bad] > 0.5) == (out["doc_id"] % 5 == 0)).all()
    share = (out["tokens"].to_numpy() * out["rate"].to_numpy()) @ p / out["tokens"].sum()
    assert share[bad] == pytest.approx(0.05, abs=1e-3) and out["rate"].min() >= 0
    kept = mixing.apply_rates(marked, model)
    assert kept.columns == full.columns and kept.count() == out["copies"].sum()
    assert mixing.memberships(odd(spark), model).count() == len(ODD)
    assert mixing.learn_domains(marked, labels.limit(0)).domains == ["all"]


def test_warc(spark):
    big = "x" * 1000
    rows = [(1, "http://a/\r\nb", big), (2, None, big), (3, "u", "small"), (4, "u", "small"),
            (5, "u", None), (None, "u", big)]
    root = warc.write_archive(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    got = {r["page_id"]: r for r in warc.read_archive(spark, root).collect()}
    kind = {i: (got[i]["record_type"], got[i]["refers_to"]) for i in got}
    assert kind == {1: ("revisit", 2), 2: ("response", None), 3: ("response", None),
                    4: ("response", None), 5: ("response", None), None: ("revisit", 2)}
    assert got[1]["payload"] == big.encode() and got[5]["payload_bytes"] == 0
    assert got[2]["record"].endswith(big.encode() + b"\r\n\r\n") and got[1]["url"] == "http://a/%0D%0Ab"
    assert spark.read.parquet(f"{root}/payloads").count() == 3


def test_warc_digest_of_url(spark):
    df = spark.createDataFrame([(1, "http://a/?d=sha1:beef", "text")], "page_id bigint, url string, html string")
    row = warc.read_archive(spark, warc.write_archive(df)).first()
    assert row["payload_digest"] == hashlib.sha1(b"text").hexdigest() and row["url"].endswith("sha1:beef")


def test_url_rules(spark):
    urls = ["http://Example.com/en/x", "https://www.example.com/en/", "http://a.com", "http://a.net/es/1?q#f",
            "nothing", None, "ftp://b.com/z#?/", "http://xcom/a", "http://www.example.com/fr/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
           for r in urlrules.judge(df, queries.URL_RULES).collect()}
    assert got == {0: ("example.com", "/en/x", "example.com/en/", "block"),
                   1: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
                   2: ("a.com", "", None, "allow"), 3: ("a.net", "/es/1", "net/es/", "block"),
                   4: ("", "", None, "allow"), 5: ("", "", None, "allow"),
                   6: ("b.com", "/z", "com/", "allow"), 7: ("xcom", "/a", None, "allow"),
                   8: ("www.example.com", "/fr/", "com/", "allow")}
    seen = [(f"http://s{i % 3}.bad.org/{i}", "block") for i in range(60)]
    seen += [(f"http://s{i % 3}.good.org/{i}", "allow") for i in range(60)]
    mined = urlrules.judge(spark.createDataFrame([(1, "http://new.bad.org/1"), (2, "http://new.good.org/1")],
                                                 "page_id int, url string"), queries.URL_RULES,
                           labels=spark.createDataFrame(seen, "url string, verdict string"))
    assert {r["page_id"]: r["verdict"] for r in mined.collect()} == {1: "block", 2: "allow"}
    assert urlrules.judge(df.limit(0), queries.URL_RULES).count() == 0


def test_url_rules_registered(spark, tmp_path):
    urls = [f"http://{s}casino.example.{d}/{i}" for i in range(40) for s in ("", "m.")
            for d in ("com/en", "net/es", "net/fr")]
    urls += [f"http://h{i % 8}.example.com/{f}/{i}" for i in range(80) for f in ("en", "de", "es", "fr")]
    urls += [f"http://n{i % 2}.example.net/{f}/{i}" for i in range(80) for f in ("es", "en")]
    asked = {"http://casino.example.org/en/x": "block", "http://m.casino.example.net/en/x": "block",
             # neither /en/ nor .net nor a host of .net alone is a reason
             "http://new.example.org/en/x": "allow", "http://n0.example.net/en/x": "allow",
             "http://h1.example.org/en/x": "allow", "http://new.example.net/de/x": "allow",
             "http://new.example.net/about": "allow"}
    spark.createDataFrame(list(enumerate([*urls, *asked])), "page_id bigint, url string") \
        .write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r["verdict"] for r in queries.op10_url_rules(spark, str(tmp_path)).collect()}
    assert [got[len(urls) + i] for i in range(len(asked))] == list(asked.values())


def test_url_rules_deep(spark):
    """What decides may stand in a deeper folder, the last segment or a query value."""
    bad = ("a/b/casino/{}", "a/b/c/d/e/casino/{}", "a/big-Casino-{}.html", "a/{}?go=casino")
    good = ("a/b/garden/{}", "a/b/c/d/e/garden/{}", "a/big-garden-{}.html", "a/{}?go=garden")
    seen = [(f"http://h{i % 7}.org/" + x.format(i), v) for i in range(42)
            for xs, v in ((bad, "block"), (good, "allow")) for x in xs]
    asked = [(i, "http://new.org/" + x.format(99)) for i, x in enumerate((*bad, *good))]
    got = urlrules.judge(spark.createDataFrame(asked, "page_id int, url string"), queries.URL_RULES,
                         labels=spark.createDataFrame(seen, "url string, verdict string"))
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == {
        i: "block" if i < 4 else "allow" for i in range(8)}


def test_pipeline_toxic(spark, tmp_path):
    import corpus_pipeline

    # 12 toxic documents, 1 % of the tokens
    rows = [(i, f"the old house near the river number {i} stands in fog"
             + (" zzbad zzworse" if i % 100 == 0 else "")) for i in range(1200)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    d.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 100 == 0).cast("int").alias("toxic")) \
        .write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.mixing_stage(spark, d, str(tmp_path)).collect()}
    assert kept == {i for i in range(1200) if i % 100}


def test_pipeline_rows(spark, tmp_path):
    """Null ids and repeated rows are deduplicated, decontaminated and mixed like others."""
    import corpus_pipeline

    text = lambda a, n=40: " ".join(f"{a}{j}" for j in range(n))
    leak = text("bench", 12)
    rows = [(1, text("a")), (1, text("a")), (2, text("a")), (None, text("a")), (None, text("a") + " more"),
            (None, text("b")), (None, text("b")), (3, text("c")), (3, text("d")), (4, text("e") + " tail"),
            (None, text("e")), (5, ""), (5, ""), (6, "")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in corpus_pipeline.dedup_stage(spark, d, str(tmp_path)).collect()]
    assert collections.Counter(got) == collections.Counter(
        [(1, text("a")), (None, text("b")), (3, text("c")), (3, text("d")), (4, text("e") + " tail"), (5, ""), (6, "")])
    spark.createDataFrame([(1, leak)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    d = spark.createDataFrame([(None, "x " + leak), (None, text("f")), (7, leak), (7, text("g")), (None, None)],
                              "doc_id bigint, text string")
    got = [tuple(r) for r in corpus_pipeline.decontaminate_stage(spark, d, str(tmp_path)).collect()]
    assert collections.Counter(got) == collections.Counter([(None, text("f")), (7, text("g")), (None, None)])
    model = mixing.DomainModel(["all"], np.zeros(1), np.zeros(0, np.uint64), np.zeros((0, 1)), steps=[np.array([0.5])])
    d = spark.range(400).select(F.lit(None).cast("bigint").alias("doc_id"),
                                F.concat(F.lit("text "), F.col("id")).alias("text"))
    assert 150 < mixing.apply_rates(d, model).count() < 250


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF).toPandas()
    before = docs(spark).toPandas()
    assert len(out) and out["doc_id"].is_unique and set(out["doc_id"]) <= set(before["doc_id"])
    item = {r["item_id"]: shingle_set(r["text"], 5) for r in
            spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    sets = {i: shingle_set(t, 5) for i, t in zip(before["doc_id"], before["text"]) if i in set(out["doc_id"])}
    for s in sets.values():
        assert not any(len(s & t) >= 0.8 * len(t) for t in item.values())
    kept = list(sets.values())
    assert not any(s and t and len(s & t) >= 0.8 * len(s | t)
                   for a, s in enumerate(kept) for t in kept[:a])
