"""N-gram Jaccard join through a count-vector R-tree.

A document is its set of distinct ``width``-word shingles (a shorter one is a
single shingle of all its words). Two documents link when their Jaccard
similarity is at least ``percent`` / 100, decided in integers on the sets.

1. Equal sets become one class (128-bit set digest); classes are compared once.
2. Shingles are ordered by the load of the hash group they fall in, common
   groups last. Two linked sets share a shingle among the first
   ``n - ceil(percent * n / 100) + 1`` of either, so the postings of those
   leading shingles form tiles that together hold every linked pair. In the
   smaller set it is even among the first ``n - ceil(2 * percent * n /
   (100 + percent)) + 1``, its inner ones: an overlap reaches that part of
   twice the smaller size. Tiles without an inner shingle of a member are left
   out, tiles with the same members are one tile.
3. Members of a tile are first checked against its smallest member (one pair a
   member). Tiles that this puts into one component are done: a group of near
   copies costs its size, not its square.
4. In the other tiles everything outside the largest component meets all
   members, in chunks of ``chunk_rows``.

A task packs its points, the counts of shingles per hash group, into an
R-tree; the overlap of two boxes or points is bounded by the summed minima of
their coordinates. Only documents that the bound leaves with a partner are
read again for their sets, on which the pairs are verified; pairs already
connected are skipped, a pair that several tiles hold is compared in the first
of them, and the task returns a spanning forest.

Alone, boxes over counts of random text prune little but size: the counts of
unrelated documents lie close together. That is why the top level of the tree
is cut by leading shingles and the boxes work inside.

Hash-group loads are a table of fixed size, summed over all documents.

Defined results: null, empty and blank texts have an empty set and link with
nothing; rows that repeat an id are one vertex; rows without an id join in
comparisons only through equal texts that have one, and get a null component;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerlake.llm.common import components, mix, shingle_hashes, small_batches, stash, text_chunks, word_hashes

LOAD_BITS = 18  # hash groups whose loads order the shingles
SLICES = 64     # the load table travels in this many rows a task
GROUPS = 256    # coordinates of a point


def _sets(column, width):
    for first, data, offs in text_chunks(column):
        h, at = word_hashes(data, offs)
        yield first, shingle_hashes(h, at, width)


def _digest(s: np.ndarray) -> tuple[int, int]:
    if not len(s):
        return 0, 0
    a = mix(s).sum(dtype=np.uint64)
    b = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(a.view(np.int64)), int(b.view(np.int64))


def _point(s: np.ndarray) -> bytes:
    """Counts of shingles by hash group, a byte each where they fit, else four."""
    c = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=GROUPS)
    return c.astype(np.uint8 if c.max() < 256 else np.uint32).tobytes()


def _points(packed) -> np.ndarray:
    return np.stack([np.frombuffer(p, np.uint8 if len(p) == GROUPS else np.uint32)
                     for p in packed]).astype(np.int32)


def _profile(width):
    """Task code: digests of all documents, and the loads of the task."""
    def run(batches):
        import pyarrow as pa
        load = np.zeros(1 << LOAD_BITS, np.int64)
        names = ["id", "n", "s1", "s2", "point", "slice", "load"]
        for b in batches:
            n, s1, s2, points = [], [], [], []
            for _, sets in _sets(b.column(1), width):
                for s in sets:
                    x, y = _digest(s)
                    n.append(len(s)), s1.append(x), s2.append(y), points.append(_point(s))
                if sets:
                    at = np.concatenate(sets) & np.uint64((1 << LOAD_BITS) - 1)
                    load += np.bincount(at.astype(np.int64), minlength=1 << LOAD_BITS)
            k = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.array(points, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.list_(pa.int64()))],
                names=names)
        if load.any():
            z = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [z, z, z, z, pa.nulls(SLICES, pa.binary()), pa.array(range(SLICES), pa.int32()),
                 pa.array(list(load.reshape(SLICES, -1)), pa.list_(pa.int64()))], names=names)
    return run


def _levels(loads: DataFrame) -> np.ndarray:
    """Order levels of the hash groups: 0 for an ordinary load, rising with a
    load beyond chance. A table of 2**LOAD_BITS bytes."""
    def add(pdf):
        import pandas as pd
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1],
                             "load": [np.sum(np.stack(pdf["load"]), axis=0)]})

    rows = loads.groupBy("slice").applyInPandas(add, "slice int, load array<bigint>").collect()
    load = np.zeros((SLICES, (1 << LOAD_BITS) // SLICES))
    for r in rows:
        load[r["slice"]] = r["load"]
    load = load.ravel()
    usual = np.median(load)
    over = load - (usual + 6 * np.sqrt(usual + 1))
    return np.where(over > 0, 1 + np.log2(np.maximum(over, 1)), 0).astype(np.uint8)


def _postings(width, percent, level):
    """Task code: leading shingles of each distinct set of a task."""
    def run(batches):
        import pyarrow as pa
        seen: set = set()
        for b in batches:
            for _, sets in _sets(b.column(0), width):
                hs, s1, inner = [], [], []
                for s in sets:
                    n = len(s)
                    d = _digest(s)
                    if not n or d in seen:
                        continue
                    seen.add(d)
                    lead = n - (percent * n + 99) // 100 + 1
                    lv = level[(s & np.uint64((1 << LOAD_BITS) - 1)).astype(np.int64)]
                    if lv.any():
                        s = s[np.argsort(lv, kind="stable")]
                    short = n + 1 + -2 * percent * n // (100 + percent)
                    hs.append(s[:lead]), s1.append(np.full(lead, d[0]))
                    inner.append(np.arange(lead) < short)
                if hs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.concatenate(s1)),
                         pa.array(np.concatenate(inner))], names=["h", "s1", "inner"])
                if len(seen) > 1_000_000:
                    seen.clear()  # a set met again is a posting twice, no harm
    return run


def _full_sets(width):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            for _, sets in _sets(b.column(1), width):
                d = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in d], pa.int64()), pa.array([y for _, y in d], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=["f1", "f2", "shingles"])
    return run


def _with_digests(width, at):
    """Task code: the rows as they are and the digest of each set."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            d = [_digest(s) for _, sets in _sets(b.column(at), width) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([x for x, _ in d], pa.int64()), pa.array([y for _, y in d], pa.int64())],
                names=[*b.schema.names, "__s1", "__s2"])
    return run


class RTree:
    """Points packed by size into leaves of ``fan`` points and boxes over
    ``fan`` leaves. Each box holds its highest coordinates and its sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, fan: int = 16):
        self.points, self.sizes = points, sizes
        # similar points have similar sizes and a similar heaviest coordinate
        order = np.lexsort((points.argmax(axis=1), sizes))
        self.leaves = [order[i:i + fan] for i in range(0, len(order), fan)]
        self.high = np.stack([points[x].max(axis=0) for x in self.leaves])
        self.low_n = np.array([sizes[x].min() for x in self.leaves])
        self.high_n = np.array([sizes[x].max() for x in self.leaves])
        cut = range(0, len(self.leaves), fan)
        self.nodes = [np.arange(i, min(i + fan, len(self.leaves))) for i in cut]
        self.node_high = np.stack([self.high[x].max(axis=0) for x in self.nodes])
        self.node_n = np.array([[self.low_n[x].min(), self.high_n[x].max()] for x in self.nodes])

    def near(self, p: np.ndarray, n: int, percent: int) -> np.ndarray:
        """Indices whose overlap bound lets the similarity reach ``percent``."""
        def passes(high, low_n, high_n):
            shared = np.minimum(high, p).sum(axis=1)
            # |A & B| >= t / (1 + t) * (|A| + |B|), and sizes within t of one another
            ok = shared * (100 + percent) >= percent * (n + low_n)
            return ok & (100 * high_n >= percent * n) & (percent * low_n <= 100 * n)

        nodes = np.flatnonzero(passes(self.node_high, self.node_n[:, 0], self.node_n[:, 1]))
        if not len(nodes):
            return nodes
        leaves = np.concatenate([self.nodes[i] for i in nodes])
        leaves = leaves[passes(self.high[leaves], self.low_n[leaves], self.high_n[leaves])]
        if not len(leaves):
            return leaves
        at = np.concatenate([self.leaves[i] for i in leaves])
        size = self.sizes[at]
        return at[passes(self.points[at], size, size)]


def _elsewhere(tile: int, leads) -> np.ndarray | None:
    """Members x earlier tiles they are in: two members that share one are
    compared there."""
    ids = np.unique(np.concatenate([np.asarray(x, np.int64) for x in leads]))
    ids = ids[ids < tile]
    if not len(ids):
        return None
    out = np.zeros((len(leads), len(ids)), np.float32)
    for i, x in enumerate(leads):
        x = np.asarray(x, np.int64)
        out[i, np.searchsorted(ids, x[x < tile])] = 1
    return out


def _partners(tree, right, points, sizes, comp, met, i, percent):
    j = right[tree.near(points[i], sizes[i], percent)]
    j = j[comp[j] != comp[i]]
    if met is not None and len(j):
        j = j[(met[j] @ met[i]) == 0]
    return j


def _bound(percent):
    """Task code: of the members of each task in a bucket, those that the
    R-tree's bound leaves with a partner in another component. ``side``: 1
    left, 2 right, 0 both; left points meet right ones."""
    def run(pdf):
        kept = []
        for _, t in pdf.groupby(["tile", "part"], sort=False):
            points = _points(t["point"])
            sizes = points.sum(axis=1)
            comp, side = t["comp"].to_numpy(), t["side"].to_numpy()
            right = np.flatnonzero(side != 1)
            if len(t) < 2 or not len(right):
                continue
            tree = RTree(points[right], sizes[right])
            met = _elsewhere(int(t["tile"].iloc[0]), t["lead"].tolist())
            use = np.zeros(len(t), bool)
            for i in np.flatnonzero(side != 2):
                j = _partners(tree, right, points, sizes, comp, met, i, percent)
                use[j] = True
                use[i] |= len(j) > 0
            kept.append(t[use])
        import pandas as pd
        out = pd.concat(kept) if kept else pdf.iloc[:0]
        return out[["tile", "part", "rep", "side", "comp", "lead"]]
    return run


def _verify(percent):
    """Task code: forests of the tasks in a bucket, pairs checked on the sets."""
    def run(pdf):
        import pandas as pd
        edges = []
        for _, t in pdf.groupby(["tile", "part"], sort=False):
            sets = [np.frombuffer(x, np.uint64) for x in t["shingles"]]
            points = _points([_point(s) for s in sets])
            sizes = points.sum(axis=1)
            rep, comp, side = t["rep"].to_numpy(), t["comp"].to_numpy().copy(), t["side"].to_numpy()
            right = np.flatnonzero(side != 1)
            if not len(right):
                continue
            tree = RTree(points[right], sizes[right])
            met = _elsewhere(int(t["tile"].iloc[0]), t["lead"].tolist())
            for i in np.flatnonzero(side != 2):
                for j in _partners(tree, right, points, sizes, comp, met, i, percent).tolist():
                    if comp[i] == comp[j]:
                        continue
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                        edges.append((rep[i], rep[j]))
                        comp[comp == comp[j]] = comp[i]
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")
    return run


def _linked(base: DataFrame, width: int, percent: int, chunk_rows: int, bucket_rows: int,
            broadcast_ids: int, by_id: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows (id, t): the rows (id, n, s1, s2), the classes (s1, s2, n, rep,
    least) of equal sets with a number and their least id, and the components
    (v, component) of class numbers. ``by_id`` leaves out classes without an id
    and joins classes that share one."""
    small_batches(base.sparkSession)
    prof = stash(base.mapInArrow(
        _profile(width), "id bigint, n bigint, s1 bigint, s2 bigint, point binary, slice int, "
        "load array<bigint>"),
        "jaccard-sets")
    sets = prof.filter("slice IS NULL").select("id", "n", "s1", "s2", "point")
    level = _levels(prof.filter("slice IS NOT NULL").select("slice", "load"))
    named = sets.filter("id IS NOT NULL") if by_id else sets
    # an id may come with several sets: classes have numbers of their own
    classes = stash(named.filter("n > 0").groupBy("s1", "s2", "n")
                    .agg(F.min("id").alias("least"), F.min("point").alias("point"))
                    .withColumn("rep", F.monotonically_increasing_id()), "jaccard-classes")

    post = stash(base.select("t").mapInArrow(_postings(width, percent, level),
                                             "h bigint, s1 bigint, inner boolean"), "jaccard-postings")
    live = post.groupBy("h").agg(F.min("s1").alias("x"), F.max("s1").alias("y"),
                                 F.max("inner").alias("inner")).filter("x < y AND inner")
    post = post.select("h", "s1")
    # classes that share half a digest all join the tile, which does no harm
    keys = classes.select(F.col("s1").alias("c1"), "rep")
    tiles = (post.join(live.select(F.col("h").alias("lh")), F.col("h") == F.col("lh"), "left_semi")
             .distinct().join(keys, F.col("s1") == F.col("c1"))
             .select("h", "rep").distinct())
    tiles = stash(tiles, "jaccard-live")
    # one tile for each distinct list of members
    sig = tiles.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("hub"),
                                 F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("x"),
                                 F.sum(F.xxhash64("rep", F.lit(1)).cast("decimal(38,0)")).alias("y"))
    one = (sig.filter("m > 1").groupBy("m", "hub", "x", "y").agg(F.min("h").alias("tile")))
    tiles = stash(tiles.join(one, F.col("h") == F.col("tile")).select("tile", "m", "hub", "rep"),
                  "jaccard-tiles")

    points = classes.select(F.col("rep").alias("p_rep"), "point")

    def bucketed(tasks: DataFrame, n: int) -> DataFrame:
        return tasks.withColumn("bucket", F.pmod(F.xxhash64("tile", "part"),
                                                 F.lit(max(1, n // bucket_rows))))

    def compare(tasks: DataFrame) -> DataFrame:
        """Edges (a, b): the bound first, then the sets of what it leaves."""
        tasks = stash(tasks, "jaccard-tasks")
        left = stash(bucketed(tasks, tasks.count()).join(points, F.col("rep") == F.col("p_rep"))
                     .drop("p_rep").groupBy("bucket").applyInPandas(
                         _bound(percent), "tile bigint, part string, rep bigint, side int, comp bigint, "
                         "lead array<bigint>"),
                     "jaccard-left")
        want = left.select(F.col("rep").alias("r")).distinct()
        want = stash(want.join(classes.select("rep", "least", "s1", "s2"), F.col("r") == F.col("rep"))
                     .drop("rep"), "jaccard-wanted")
        few = want.count() <= broadcast_ids  # else both sides are shuffled
        near = (lambda x: F.broadcast(x)) if few else (lambda x: x)
        ids = near(want.select("least").distinct())
        picked = base.join(ids, F.col("id") == F.col("least"), "left_semi")
        if not want.filter("least IS NULL").isEmpty():
            picked = picked.unionAll(base.filter("id IS NULL"))
        full = (picked.mapInArrow(_full_sets(width), "f1 bigint, f2 bigint, shingles binary")
                .join(near(want.drop("least")), (F.col("f1") == F.col("s1")) & (F.col("f2") == F.col("s2")))
                .groupBy("r").agg(F.min("shingles").alias("shingles")))
        return (bucketed(left, left.count()).join(full, F.col("rep") == F.col("r")).drop("r")
                .groupBy("bucket").applyInPandas(_verify(percent), "a bigint, b bigint"))

    # first pass: every member against the smallest of its tile
    pairs = tiles.select("hub", "rep").distinct().filter("hub != rep")
    chunk = F.pmod(F.xxhash64("rep"), F.ceil(F.col("k") / chunk_rows))
    width_of = pairs.groupBy(F.col("hub").alias("w_hub")).agg(F.count(F.lit(1)).alias("k"))
    spokes = pairs.join(width_of, F.col("hub") == F.col("w_hub")).select(
        F.col("hub").alias("tile"), chunk.cast("string").alias("part"), "rep")
    hubs = spokes.select("tile", "part").distinct().select(
        "tile", "part", F.col("tile").alias("rep"), F.lit(1).alias("side"))
    none = F.array().cast("array<bigint>")
    first = stash(compare(spokes.withColumn("side", F.lit(2)).select("tile", "part", "rep", "side")
                          .unionAll(hubs).withColumns({"comp": F.col("rep"), "lead": none})), "jaccard-edges")
    if by_id:
        first = first.unionAll(_same_id(sets, classes))
    parts = components(first, "jaccard-components")

    # second pass: tiles still in several components
    named = tiles.join(parts.select(F.col("v").alias("p"), "component"), F.col("rep") == F.col("p"),
                       "left").select("tile", "rep", F.coalesce("component", "rep").alias("comp"))
    named = stash(named, "jaccard-named")
    per = named.groupBy("tile", "comp").agg(F.count(F.lit(1)).alias("k"))
    top = per.groupBy(F.col("tile").alias("t")).agg(
        F.sum("k").alias("m"), F.max(F.struct("k", "comp")).alias("big")).select(
        "t", "m", F.col("big.comp").alias("main"), (F.col("m") - F.col("big.k")).alias("rest"))
    open_ = named.join(top.filter("rest > 0"), F.col("tile") == F.col("t"))
    both = open_.select(
        "tile", "rep", "comp", (F.col("comp") != F.col("main")).alias("odd"),
        F.ceil(F.col("rest") / chunk_rows).cast("int").alias("lefts"),
        F.ceil(F.col("m") / chunk_rows).cast("int").alias("rights"))
    mine_l, mine_r = (F.pmod(F.xxhash64("rep", F.lit(s)), F.col(c)).cast("int")
                      for s, c in ((3, "lefts"), (5, "rights")))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = both.filter("odd").withColumn("l", mine_l).withColumn("r", every("rights"))
    right = both.withColumn("r", mine_r).withColumn("l", every("lefts"))
    tasks = (left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(2)))
             .groupBy("tile", "l", "r", "rep", "comp").agg(F.sum("side").alias("s"))
             .select("tile", F.concat_ws("-", "l", "r").alias("part"), "rep",
                     F.when(F.col("s") == 3, 0).otherwise(F.col("s")).cast("int").alias("side"), "comp"))
    # a pair in several tiles is compared in the first of them
    leads = (both.select("rep", "tile").distinct().groupBy(F.col("rep").alias("l_rep"))
             .agg(F.collect_list("tile").alias("lead")))
    second = compare(tasks.join(leads, F.col("rep") == F.col("l_rep")).drop("l_rep"))
    parts = components(first.unionAll(second), "jaccard-components")

    return sets, classes, parts


def _same_id(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes of each id that comes with several."""
    one = F.struct("s1", "s2")
    several = (sets.filter("n > 0 AND id IS NOT NULL").groupBy(F.col("id").alias("i"))
               .agg(F.min(one).alias("lo"), F.max(one).alias("hi")).filter("lo != hi"))
    several = stash(several, "jaccard-several")
    other = sets.filter("n > 0").join(several, F.col("id") == F.col("i")).select(
        F.col("lo.s1").alias("l1"), F.col("lo.s2").alias("l2"), "s1", "s2").distinct()
    number = lambda c: classes.select(F.col("s1").alias("x"), F.col("s2").alias("y"), F.col("rep").alias(c))
    return stash(other.join(number("a"), (F.col("l1") == F.col("x")) & (F.col("l2") == F.col("y"))).drop("x", "y")
                 .join(number("b"), (F.col("s1") == F.col("x")) & (F.col("s2") == F.col("y")))
                 .filter("a != b").select("a", "b"), "jaccard-edges")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      width: int = 4, percent: int = 85, chunk_rows: int = 256,
                      bucket_rows: int = 2000, broadcast_ids: int = 1_000_000) -> DataFrame:
    """(id_col, n_shingles, component_id) for every row of ``docs``."""
    base = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("t"))
    sets, classes, parts = _linked(base, width, percent, chunk_rows, bucket_rows, broadcast_ids, True)
    # components go by their least id
    parts = parts.join(classes.select("rep", "least"), F.col("v") == F.col("rep")).drop("rep")
    label = parts.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("label"))
    label = stash(parts.join(label, F.col("component") == F.col("c")).select("v", "label"), "jaccard-labels")
    best = classes.join(label, F.col("rep") == F.col("v"), "left").select(
        F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.coalesce("label", "least").alias("comp"))
    out = sets.join(best, (F.col("n") > 0) & (F.col("s1") == F.col("c1"))
                    & (F.col("s2") == F.col("c2")), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNotNull(), F.coalesce("comp", "id")).alias("component_id"))


def first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = 4, percent: int = 85, chunk_rows: int = 256,
                 bucket_rows: int = 2000, broadcast_ids: int = 1_000_000) -> DataFrame:
    """One row of ``docs`` for each component, all columns: that of the least id
    (rows without one last). Decided per row: rows are told apart by id and set,
    rows alike in both are copies; texts without words stay once for each id."""
    base = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("t"))
    sets, classes, parts = _linked(base, width, percent, chunk_rows, bucket_rows, broadcast_ids, False)
    keys = stash(sets.groupBy("id", "s1", "s2").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("rows")),
                 "jaccard-keys")
    comp = classes.join(parts, F.col("rep") == F.col("v"), "left").select(
        F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.coalesce("component", "rep").alias("comp"))
    named = stash(keys.filter("n > 0").join(comp, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")))
                  .select("id", "s1", "s2", "comp"), "jaccard-named")
    best = (named.groupBy(F.col("comp").alias("c"))
            .agg(F.min(F.struct(F.isnull("id").alias("no_id"), "id", "s1", "s2")).alias("best"),
                 F.count(F.lit(1)).alias("k")).filter("k > 1"))
    same = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("s1") == F.col("best.s1")) \
        & (F.col("s2") == F.col("best.s2"))
    key = ("id", "s1", "s2")
    lost = stash(named.join(best, F.col("comp") == F.col("c")).filter(~same).select(*key), "jaccard-lost")
    twice = keys.filter("rows > 1").select(*key)

    marked = docs.mapInArrow(_with_digests(width, docs.columns.index(text_col)),
                             StructType([*docs.schema.fields, StructField("__s1", LongType()),
                                         StructField("__s2", LongType())]))

    def of(other: DataFrame, left: DataFrame, an_id, s1: str, s2: str, how: str) -> DataFrame:
        other = other.select(*[F.col(c).alias(f"__o_{c}") for c in key])
        return left.join(other, an_id.eqNullSafe(F.col("__o_id")) & (F.col(s1) == F.col("__o_s1"))
                         & (F.col(s2) == F.col("__o_s2")), how)

    row_id = F.col(id_col).cast("bigint")
    once = of(lost.unionAll(twice), marked, row_id, "__s1", "__s2", "left_anti").drop("__s1", "__s2")
    twice = stash(of(lost, twice, F.col("id"), "s1", "s2", "left_anti"), "jaccard-twice")
    if twice.isEmpty():
        return once
    again = (of(twice, marked, row_id, "__s1", "__s2", "left_semi")
             .groupBy(row_id.alias("__id"), "__s1", "__s2")
             .agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*"))
    return once.unionByName(again)
