"""K-d tree partitioning of documents into shards of nearly equal bytes.

The tree is cut level by level. Each node holding more than one shard picks
its widest metadata dimension (spread relative to the whole table) and is
cut where the weight before the cut is the share of its left shards: a
weighted median, or the nearest ratio for an odd number of shards. All nodes
of a level are cut together: one grouped histogram over (node, bin) narrows
the cut of every node until the bin at the cut is light enough, so a pass
returns one row per node to the driver whatever the size of the table.

Order inside a node is (dimension, text checksum, hash of the id, hash of a
stored row number): equal texts lie side by side and stay in one shard, unless
such a group weighs more than ``group_share`` of a shard; a heavier one is cut
by the hashes, between any two rows, also of one id or none.

Dimensions are read as 24-bit coordinates: numbers scaled between the table's
least and largest finite ones, other types by a hash (equal values have equal
places), null and NaN below all, infinities at the ends. Size is UTF-8 bytes of
the text plus ``overhead``.

What a level needs of its nodes (ranges, cuts, shards) is a table of a row a
node, sent as one value; the plan does not grow with the number of shards.

Defined results: null text has no bytes; null ids are placed like any other;
rows that repeat an id are rows of their own; an empty table gives an empty
result; input columns named like the result's are replaced by them. Only
DataFrame functions run.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import stash

COORD_BITS = 24
TOP = (1 << COORD_BITS) - 2
RESULT = ("size", "text_crc32", "shard", "slot")
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _node_table(spark, rows: list[tuple], names: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """A small table from one text value, however many rows it has."""
    text = json.dumps([dict(zip(names, r)) for r in rows])
    schema = ", ".join(f"{n}: {k}" for n, k in zip(names, kinds))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


def _coordinates(thin: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Add c0..ck: 24-bit coordinates of the columns ``dims``."""
    kinds = dict(thin.dtypes)
    numeric = [d for d in dims if kinds[d] in NUMBERS or kinds[d].startswith("decimal")]
    # halves, so that no difference overflows
    half = {d: F.col(d).cast("double") / 2 for d in numeric}
    ends = {}
    if numeric:
        finite = {d: F.when(F.abs(h) < float("inf"), h) for d, h in half.items()}  # NaN is above
        row = thin.agg(*[f(finite[d]).alias(f"{n}{i}") for i, d in enumerate(numeric)
                         for n, f in (("lo", F.min), ("hi", F.max))]).first()
        ends = {d: (row[f"lo{i}"], row[f"hi{i}"]) for i, d in enumerate(numeric)}
    cols = {}
    for i, d in enumerate(dims):
        if d in numeric:
            lo, hi = (0.0 if v is None else v for v in ends[d])
            scaled = (half[d] - F.lit(lo)) / F.lit(hi - lo if hi > lo else 1.0) * F.lit(float(TOP))
            inside = F.greatest(F.lit(0.0), F.least(F.lit(float(TOP)), scaled))
            c = F.when(half[d].isNotNull() & ~F.isnan(half[d]), F.floor(inside) + 1)
        else:
            c = F.pmod(F.xxhash64(F.col(d).cast("string")), F.lit(TOP)) + 1
        cols[f"c{i}"] = F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
    return thin.withColumns(cols)


def _cuts(rows: DataFrame, nodes: dict, leaf: float, tol: float, group_share: float,
          bins: int) -> dict:
    """The cut of every node: {node: (key, tie)}; a row is left of the cut when
    its (key, tie) is at most that. ``nodes``: {node: (dim, total, left share)}.

    Two phases per node: the key (coordinate and text checksum) narrows by
    histograms; when one key is too heavy, the id hash does.
    """
    spark = rows.sparkSession
    end_key, end_tie = (1 << (COORD_BITS + 32)) - 1, (1 << 62) - 1
    # state: phase, the open range, weight before it, and the key when fixed
    state = {n: {"phase": 0, "lo": 0, "hi": end_key, "before": 0.0, "key": None}
             for n in nodes}
    done: dict = {}
    while state:
        ranges = _node_table(
            spark, [(n, nodes[n][0], s["phase"], s["lo"], s["hi"], s["key"] or 0,
                     float(nodes[n][1] * nodes[n][2] - s["before"])) for n, s in state.items()],
            ("r_node", "dim", "phase", "lo", "hi", "fixed", "want"),
            ("int", "int", "int", "bigint", "bigint", "bigint", "double"))
        x = rows.join(F.broadcast(ranges), F.col("node") == F.col("r_node"))
        key = (F.element_at("coords", F.col("dim") + 1) * (1 << 32) + F.col("text_crc32"))
        x = x.withColumn("key", key).filter("phase = 0 OR key = fixed")
        x = x.withColumn("v", F.when(F.col("phase") == 0, F.col("key")).otherwise(F.col("tie")))
        x = x.filter("v >= lo AND v <= hi")
        x = x.withColumn("bin", F.expr(f"(v - lo) div ((hi - lo) div {bins} + 1)"))
        hist = x.groupBy("node", "bin", "want").agg(F.sum("size").cast("double").alias("w"),
                                                    F.min("v").alias("least"),
                                                    F.max("v").alias("most"))
        w = Window.partitionBy("node").orderBy("bin")
        hist = hist.withColumn("upto", F.sum("w").over(w)).withColumn(
            "prev", F.lag("most").over(w))
        hit = (hist.filter("upto >= want").groupBy("node")
               .agg(F.min_by(F.struct("w", "least", "most", "upto", "prev", "want"), "bin")
                    .alias("x")).select("node", "x.*"))
        found = {r["node"]: r for r in hit.collect()}
        for n in list(state):
            s, r = state[n], found.get(n)
            if r is None:  # nothing weighs that much: everything is left of the cut
                done[n] = (end_key, end_tie) if s["phase"] == 0 else (s["key"], end_tie)
                del state[n]
                continue
            light = tol * leaf
            one = r["least"] == r["most"]
            if r["w"] <= light or (one and (s["phase"] == 1 or r["w"] <= group_share * leaf)):
                # cut at the end of the bin or before it, whichever is nearer
                after = r["upto"] - r["want"] <= r["want"] - (r["upto"] - r["w"])
                v = r["most"] if after else r["least"] - 1
                done[n] = (v, end_tie) if s["phase"] == 0 else (s["key"], v)
                del state[n]
            elif one:
                state[n] = {"phase": 1, "lo": 0, "hi": end_tie, "key": r["least"],
                            "before": s["before"] + r["upto"] - r["w"]}
            else:
                state[n] = s | {"lo": r["least"], "hi": r["most"],
                                "before": s["before"] + r["upto"] - r["w"]}
    return done


def kd_shards(docs: DataFrame, dims: Sequence[str], n_shards: int | None = None,
              target_bytes: int | None = None, id_col: str = "doc_id", text_col: str = "text",
              overhead: int = 16, tolerance: float = 0.001, group_share: float = 0.05,
              bins: int = 2048, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (id_col, size, text_crc32, shard, slot) plus the columns ``keep``.

    Give ``n_shards``, or ``target_bytes`` for as many shards as that needs.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs[text_col], F.lit(""))
    size = F.octet_length(text).cast("bigint") + overhead
    named = [docs[d].alias(f"__d{i}") for i, d in enumerate(dims)]
    keep = [c for c in keep if c not in (id_col, *RESULT)]
    thin = docs.select(docs[id_col].alias(id_col), size.alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                       *named, *[docs[c].alias(f"__k_{c}") for c in keep],
                       F.monotonically_increasing_id().alias("__row"))
    thin = stash(thin, "shard-rows")
    own = [f"__d{i}" for i in range(len(dims))]
    thin = _coordinates(thin.withColumn("__size", F.log2(F.col("size").cast("double"))),
                        ["__size", *own])
    k = len(own) + 1
    # 40 bits of the id's hash, then 22 of the row's
    tie = (F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), F.lit(7)), 24) * (1 << 22)
           + F.shiftrightunsigned(F.xxhash64("__row"), 42))
    rows = thin.select(id_col, "size", "text_crc32", *[f"__k_{c}" for c in keep],
                       F.array(*[F.col(f"c{i}") for i in range(k)]).alias("coords"),
                       tie.alias("tie"), F.lit(0).alias("node"))
    rows = stash(rows, "shard-nodes")
    total, n_rows = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = float(total or 0)
    if n_shards is None:
        n_shards = max(1, math.ceil(total / target_bytes))
    leaf = total / n_shards if total else 1.0

    # node -> (first shard, shards); a node of one shard is a leaf
    tree = {0: (0, n_shards)}
    while any(m > 1 for _, m in tree.values()) and n_rows:
        spread = rows.groupBy("node").agg(F.sum("size").alias("w"), *[
            f(F.element_at("coords", i + 1)).alias(f"{n}{i}") for i in range(k)
            for n, f in (("lo", F.min), ("hi", F.max))])
        stats = {r["node"]: r for r in spread.collect()}
        nodes = {}
        for n, (_, m) in tree.items():
            if m > 1 and n in stats:
                r = stats[n]
                # equal spreads: the first dimension
                dim = max(range(k), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
                nodes[n] = (dim, float(r["w"]), (m // 2) / m)
        cuts = _cuts(rows, nodes, leaf, tolerance, group_share, bins)
        grown, moves = {}, []
        for n, (first, m) in tree.items():
            left = m // 2
            if m == 1:
                grown[2 * n] = (first, m)
            else:
                grown[2 * n], grown[2 * n + 1] = (first, left), (first + left, m - left)
            if n in cuts:
                moves.append((n, nodes[n][0], *cuts[n]))
        tree = grown
        # as many rows as the level has nodes, known from the number of shards
        table = _node_table(spark, moves or [(-1, 0, 0, 0)], ("m_node", "dim", "cut", "cut_tie"),
                         ("int", "int", "bigint", "bigint"))
        key = F.element_at("coords", F.col("dim") + 1) * (1 << 32) + F.col("text_crc32")
        right = ((key > F.col("cut")) | ((key == F.col("cut")) & (F.col("tie") > F.col("cut_tie"))))
        rows = stash(rows.join(F.broadcast(table), F.col("node") == F.col("m_node"), "left")
                     .withColumn("node", (F.col("node") * 2 + F.coalesce(right.cast("int"), F.lit(0)))
                                 .cast("int"))
                     .drop("m_node", "dim", "cut", "cut_tie"), "shard-nodes")
    leaves = _node_table(spark, [(n, first) for n, (first, _) in tree.items()],
                      ("l_node", "shard"), ("int", "int"))
    placed = (rows.join(F.broadcast(leaves), F.col("node") == F.col("l_node"))
              .select(id_col, "size", "text_crc32", "shard", "tie",
                      *[f"__k_{c}" for c in keep]))
    return _slots(placed, n_rows, id_col).select(
        id_col, "size", "text_crc32", "shard", "slot",
        *[F.col(f"__k_{c}").alias(c) for c in keep])


def _slots(placed: DataFrame, n_rows: int, id_col: str, per_block: int = 100_000) -> DataFrame:
    """Gapless numbers from 0 inside each shard. Rows are numbered inside
    hash blocks of about ``per_block`` rows, offset by the blocks before, so
    no task numbers a whole shard."""
    blocks = max(1, math.ceil(n_rows / per_block))
    placed = placed.withColumn("blk", F.pmod(F.xxhash64("tie", "text_crc32", "size"),
                                             F.lit(blocks)))
    counts = placed.groupBy("shard", "blk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("blk").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = counts.select(F.col("shard").alias("s"), F.col("blk").alias("b"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "blk").orderBy(F.col(id_col).asc_nulls_first(),
                                                        "text_crc32", "size")
    numbered = placed.withColumn("rn", F.row_number().over(inside))
    return (numbered.join(counts, (F.col("shard") == F.col("s")) & (F.col("blk") == F.col("b")))
            .withColumn("slot", (F.col("base") + F.col("rn") - 1).cast("bigint")))
