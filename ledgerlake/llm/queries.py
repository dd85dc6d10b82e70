"""The registered queries of the operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (alignment, decontaminate, jaccard, katz, langid, linededup, mixing, quality, sharding,
                            spelling, urlrules, vectors, warc)
from ledgerlake.llm.common import fold, stash

# (host, path, verdict) of the url contract
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark, sf_dir):
    """Benchmark items found in documents, 5-word shingles, containment 0.8."""
    return decontaminate.find_items(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "benchmark"))


def op2_jaccard(spark, sf_dir):
    """Components of documents linked at Jaccard 0.85 on 4-word shingles."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), width=4, percent=85)


def op3_shard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = sharding.kd_shards(docs, ["lang", "n_chars"], n_shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op4_vectors(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


# Shares of the tokens that the mix should hold of each labelled domain.
MIX_WEIGHTS = {"clean": 0.9, "low": 0.05, "toxic": 0.05}


def op5_mixing(spark, sf_dir):
    """Rates whose expected domain totals meet MIX_WEIGHTS, for every document."""
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(
        F.col("quality") == 1, "clean")
    model = mixing.learn_domains(docs, labels.select("doc_id", domain.alias("domain")))
    members = stash(mixing.memberships(docs, model), "mix-members")
    mixing.fit_rates(members, model, MIX_WEIGHTS)
    out = mixing.rated(members, model)
    return out.select("doc_id", "tokens", *[F.col("posterior")[i].alias(f"p_{d}")
                                            for i, d in enumerate(model.domains)], "rate", "copies")


def op6_quality(spark, sf_dir):
    stats = quality.with_statistics(table(spark, sf_dir, "documents"))
    stats = stash(stats, "quality-stats").withColumn("held_out", fold(F.col("doc_id"), 3) == 1)
    train = quality.labelled(stats.filter("NOT held_out"), table(spark, sf_dir, "labels"))
    scored = quality.score(stats, quality.fit(train))
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn(docs.filter(fold(F.col("doc_id"), 3) != 1))
    return langid.predict(docs, profiles).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_katz(spark, sf_dir):
    return katz.score_documents(table(spark, sf_dir, "documents"))


def op9_warc(spark, sf_dir):
    root = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.read_archive(spark, root).select("page_id", "payload_bytes", "payload_digest",
                                                 "record_type", "refers_to")


def op10_url_rules(spark, sf_dir):
    return urlrules.judge(table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


def op11_line_dedup(spark, sf_dir):
    """Documents without the long lines that documents of larger ids repeat."""
    out = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op12_spelling(spark, sf_dir):
    """Words of 7 letters or more, seen twice or more, and the forms they vary."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"), min_chars=7, min_count=2, damage=31)
    return spelling.variants(stash(words, "spelling-words"), factor=10)


def op13_alignment(spark, sf_dir):
    """Token links between two tokenizers, scored by how many documents hold them."""
    return alignment.align_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_jaccard": op2_jaccard,
    "op3_shard": op3_shard,
    "op4_vectors": op4_vectors,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_langid": op7_langid,
    "op8_katz": op8_katz,
    "op9_warc": op9_warc,
    "op10_url_rules": op10_url_rules,
    "op11_line_dedup": op11_line_dedup,
    "op12_spelling": op12_spelling,
    "op13_alignment": op13_alignment,
}
