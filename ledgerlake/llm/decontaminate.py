"""Find benchmark items inside documents: size-partitioned MinHash containment.

An item is its set of distinct ``width``-word shingles (an item of fewer words
is one shingle of them all, searched at that width). A document holds an item
when it has at least ``threshold`` of the item's shingles.

One pass over the documents keeps which of all items' shingle hashes each
document holds: rows in proportion to the text, however many items share a
shingle. Items are partitioned by size class (powers of two of their shingle
count). Each class has its own sketch length: one more than the number of
shingles a document may lack at the largest size of the class. A sketch takes
an item's least shingles by (documents that hold it, hash), so a phrase common
to many documents and items is in a sketch only where an item has nothing
rarer. A document that holds the item lacks few enough shingles that a known
number of the sketch must be among its own (``least``), so the search loses
nothing however long the document is. Documents that reach that number are
candidates; their shared shingles are counted by hash, and what passes is
verified on word sequences.

Only DataFrame functions run. The table of item hashes is broadcast only while
its rows stay under ``broadcast_rows``; beyond that the join shuffles both sides.

Defined results: null or wordless items and documents match nothing, nor do
those without an id; equal
items match alike, each under its own id; rows repeating an id are one
document (or item) whose sets are united; an empty table on either side gives
no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stash, words


def shingles(ws: Column, width: int) -> Column:
    """The ``width``-word sequences of a word array, as text, in order."""
    n = F.size(ws) - F.lit(width - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                     lambda i: F.array_join(F.slice(ws, i, width), " "))) \
        .otherwise(F.array().cast("array<string>"))


def _hashes(ws: Column, width: int) -> Column:
    """Hashes of the shingles: from word hashes, so no text is built per shingle."""
    n = F.size(ws) - F.lit(width - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                                     lambda i: F.xxhash64(F.slice(ws, i, width))))


def item_sets(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(item_id, w, need_total, shingle): one row per distinct shingle of an item."""
    ws = (items.select(items[id_col].alias("item_id"), words(items[text_col]).alias("ws"))
          .filter(F.size("ws") > 0).withColumn("w", F.least(F.size("ws"), F.lit(width))))
    per = None
    for k in range(1, width + 1):
        part = ws.filter(F.col("w") == k).select("item_id", "w",
                                                 F.explode(shingles(F.col("ws"), k)).alias("shingle"),
                                                 )
        per = part if per is None else per.unionAll(part)
    return per.distinct()


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", width: int = 5,
               threshold: float = 0.8, broadcast_rows: int = 2_000_000) -> DataFrame:
    """(id_col, item_id, n_item, n_shared, containment) for each item found."""
    hashed = F.xxhash64(F.split("shingle", " "))
    sets = item_sets(items, item_id, item_text, width).filter("item_id IS NOT NULL").withColumn("h", hashed)
    sets = stash(sets, "bench-shingles")
    schema = f"`{id_col}` {dict(docs.dtypes)[id_col]}, item_id {dict(items.dtypes)[item_id]}, " \
             "n_item bigint, n_shared bigint, containment double"
    widths = sorted(r["w"] for r in sets.select("w").distinct().collect())  # at most ``width``
    if not widths:
        return docs.sparkSession.createDataFrame([], schema)
    # 100ths keep the share exact in integers
    pct = round(threshold * 100)

    # which item shingles each document holds
    base = (docs.select(docs[id_col].alias("doc_id"), words(docs[text_col]).alias("ws"))
            .filter("doc_id IS NOT NULL"))
    own = sets.select(F.col("h").alias("item_h")).distinct()
    n_own = own.count()
    own = F.broadcast(own) if n_own <= broadcast_rows else own
    all_hashes = F.concat(*[F.coalesce(_hashes(F.col("ws"), w), F.array().cast("array<bigint>"))
                            for w in widths])
    hits = stash(base.select("doc_id", F.explode(F.array_distinct(all_hashes)).alias("h"))
                 .join(own, F.col("h") == F.col("item_h"), "left_semi").distinct(), "bench-hits")

    # sketches: the rarest shingles of each item
    held_by = hits.groupBy(F.col("h").alias("f_h")).agg(F.count(F.lit(1)).alias("df"))
    ranked = sets.join(held_by, F.col("h") == F.col("f_h"), "left").select(
        "item_id", "w", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h").alias("s"))
    sizes = ranked.groupBy("item_id", "w").agg(F.count(F.lit(1)).alias("n"),
                                               F.array_sort(F.collect_list("s")).alias("hs"))
    # size class [2^c, 2^(c+1)): sketch length from the largest size in it
    top = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n").cast("double"))) + 1) - 1
    keep = F.least(F.floor(top * F.lit(100 - pct) / 100).cast("int") + 1, F.size("hs"))
    lack = F.floor(F.col("n") * (100 - pct) / 100).cast("int")
    sizes = stash(sizes.select("item_id", "w", "n", F.slice("hs", F.lit(1), keep).alias("hs"),
                               (keep - lack).alias("least")), "bench-items")
    sketch = sizes.select("item_id", "w", "n", "least", F.explode("hs.h").alias("s_h"))
    found = (hits.join(sketch, F.col("h") == F.col("s_h")).groupBy("doc_id", "item_id", "w", "n")
             .agg(F.count(F.lit(1)).alias("hit"), F.first("least").alias("least"))
             .filter("hit >= least"))
    found = stash(found.select("doc_id", "item_id", "w", "n"), "bench-candidates")

    # the candidates' shared shingles, by hash
    enough = F.col("shared") * 100 >= F.col("n") * pct
    theirs = sets.select(F.col("item_id").alias("t_item"), F.col("w").alias("t_w"),
                         F.col("h").alias("t_h"), "shingle")
    wanted = found.join(theirs, (F.col("item_id") == F.col("t_item")) & (F.col("w") == F.col("t_w")))
    mine = hits.select(F.col("doc_id").alias("m_doc"), F.col("h").alias("m_h"))
    near = (wanted.join(mine, (F.col("doc_id") == F.col("m_doc")) & (F.col("t_h") == F.col("m_h")), "left_semi")
            .groupBy("doc_id", "item_id", "w", "n").agg(F.count(F.lit(1)).alias("shared")).filter(enough))
    near = stash(near.drop("shared"), "bench-near")

    # and as text
    some = near.select(F.col("doc_id").alias("cand")).distinct()
    texts = base.join(some, F.col("doc_id") == F.col("cand"), "left_semi")
    sequences = F.concat(*[shingles(F.col("ws"), w) for w in widths])
    held = texts.select(F.col("doc_id").alias("h_doc"), F.explode(F.array_distinct(sequences)).alias("held"))
    if n_own <= broadcast_rows // 10:  # as texts they take some ten times the room
        known = sets.select(F.col("shingle").alias("known")).distinct()
        held = held.join(F.broadcast(known), F.col("held") == F.col("known"), "left_semi")
    asked = near.join(theirs, (F.col("item_id") == F.col("t_item")) & (F.col("w") == F.col("t_w")))
    return (asked.join(held.distinct(), (F.col("doc_id") == F.col("h_doc")) & (F.col("shingle") == F.col("held")))
            .groupBy("doc_id", "item_id", "w", "n").agg(F.count(F.lit(1)).alias("shared")).filter(enough)
            .select(F.col("doc_id").alias(id_col), "item_id", F.col("n").cast("bigint").alias("n_item"),
                    F.col("shared").cast("bigint").alias("n_shared"),
                    (F.col("shared") / F.col("n")).alias("containment")))
