"""Line dedup: a long line found in several documents stays in one of them.

A line's key is the line without white space at both ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points found in at least ``min_docs``
documents lose their lines everywhere but in the document with the largest id.

How: every long line becomes a row (128-bit hash, document, position), written
once. The rows are range-partitioned by hash, sorted inside a partition by
hash, document (largest first) and position, and streamed: the first document
of a hash holds the occurrence that stays. A hash with more rows than a quarter
of a mean partition would sit in one task; such hashes, fewer than four a
partition, are found by a count that is combined before it travels, judged by
a grouped maximum, and their rows never move. What comes back for a document
is not text but a bitmap of its lines, run-length coded: the kept runs
(start, n) in order. ``apply_bitmaps`` joins it to the texts.

Defined results: a null or empty text is one empty line. Documents are known
by id: rows that repeat an id are one document, rows without an id are one
document whose id is below all others. Rows that repeat id and text share a
bitmap. Lines that repeat inside the document that keeps them all stay. An
empty table gives no bitmaps; columns other than id and text play no part in
``keep_bitmaps`` and pass through ``apply_bitmaps``, where a column called
``n_lines``, ``n_dropped``, ``keep_runs`` or ``kept_text`` is replaced.
Keys are compared by two 64-bit hashes, texts of one id by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import LOWER, SEPARATORS, UPPER, stash

OUTPUT = ("n_lines", "n_dropped", "keep_runs", "kept_text")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20) -> DataFrame:
    """One row per long line: id, t (hash of the text), n (lines of the text),
    pos, h1, h2 (hashes of the key)."""
    rows = docs.select(docs[id_col].alias("id"), _text_hash(docs[text_col]).alias("t"),
                       _lines(docs[text_col]).alias("lines"))
    rows = rows.select("id", "t", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line"))
    rows = rows.select("id", "t", "n", "pos", F.btrim("line", F.lit(SEPARATORS)).alias("key"))
    rows = rows.filter(F.char_length("key") >= min_chars)
    # lower() changes A-Z alone where all characters are ASCII, and is quicker
    key = F.when(F.char_length("key") == F.octet_length("key"), F.lower("key")).otherwise(
        F.translate("key", UPPER, LOWER))
    return rows.select("id", "t", "n", "pos", F.xxhash64(key).alias("h1"),
                       F.xxhash64(F.lit(min_chars), key).alias("h2"))


def dropped_lines(lines: DataFrame, min_docs: int = 3) -> DataFrame:
    """(id, t, n, pos) of the lines that go; ``lines`` is a stored table of
    ``line_hashes``."""
    spark = lines.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_hash = lines.groupBy("h1").agg(F.count(F.lit(1)).alias("rows"))
    per_hash = stash(per_hash, "line-counts")
    total = per_hash.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    # fewer than 4 * parts hashes can be above this: the broadcast's bound
    hot = per_hash.filter(F.col("rows") > max(1000, total // (4 * parts))).select("h1")

    cold = lines.join(F.broadcast(hot), "h1", "left_anti")
    newest = F.col("id").desc_nulls_last()
    cold = cold.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", newest, "t", "pos")
    same = Window.partitionBy("h1", "h2")
    cold = cold.select("*", F.dense_rank().over(same.orderBy(newest)).alias("nth"))
    cold = cold.select("*", F.max("nth").over(same).alias("n_docs"))
    gone = cold.filter((F.col("n_docs") >= min_docs) & (F.col("nth") > 1))

    often = lines.join(F.broadcast(hot), "h1")
    keeper = (often.select("h1", "h2", "id").distinct().groupBy("h1", "h2")
              .agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last")))
    keeper = stash(keeper.filter(F.col("n_docs") >= min_docs), "line-keepers")
    # no more rows than hot hashes (two keys of one 64-bit h1 aside)
    often = often.join(F.broadcast(keeper), ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("last")))
    cols = ["id", "t", "n", "pos"]
    return gone.select(cols).unionAll(often.select(cols))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Bitmaps of the documents that lose lines: id, t, n_lines, n_dropped,
    keep_runs (array of (start, n): the kept lines as runs, from 0).

    A bitmap is gathered from positions of one text, no more than it has lines.
    """
    lines = stash(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    per_doc = dropped_lines(lines, min_docs).groupBy("id", "t").agg(
        F.any_value("n").alias("n_lines"), F.sort_array(F.collect_set("pos")).alias("gone"))
    before = F.concat(F.array(F.lit(-1)), F.col("gone"))
    after = F.concat(F.col("gone"), F.array(F.col("n_lines")))
    runs = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("n")))
    return per_doc.select("id", "t", "n_lines", F.size("gone").alias("n_dropped"),
                          F.filter(runs, lambda r: r["n"] > 0).alias("keep_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``docs`` with n_lines (before dropping), n_dropped, keep_runs (null:
    all lines stay) and kept_text (the kept lines joined by \\n)."""
    own = [c for c in docs.columns if c.lower() not in OUTPUT]
    b = bitmaps.select(F.col("id").alias("__id"), F.col("t").alias("__t"), F.col("n_dropped"), "keep_runs")
    d = docs.select(*own, _text_hash(docs[text_col]).alias("__h"))
    both = d.join(b, d[id_col].eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__t")), "left")
    both = both.withColumn("__lines", _lines(F.col(text_col)))
    kept = F.array_join(F.transform("keep_runs", lambda r: F.array_join(
        F.slice("__lines", r["start"] + 1, r["n"]), "\n")), "\n")
    return both.select(
        *own, F.size("__lines").cast("bigint").alias("n_lines"),
        F.coalesce(F.col("n_dropped"), F.lit(0)).cast("bigint").alias("n_dropped"), "keep_runs",
        F.when(F.col("keep_runs").isNull(), F.coalesce(F.col(text_col), F.lit("")))
        .otherwise(kept).alias("kept_text"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Both steps: see ``apply_bitmaps``."""
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars, min_docs),
                         id_col, text_col)
