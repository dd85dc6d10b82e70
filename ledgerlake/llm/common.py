"""Helpers shared by the operators: durable hand-offs, components, text hashing."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# The characters that end a word; everything else belongs to one.
SEPARATORS = " \t\n\x0b\f\r"
MASK = (1 << 64) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none (tests in one process) a temporary
    folder is made and set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.startswith("local") and \
                not spark.sparkContext.master.startswith("local-cluster"):
            root = tempfile.mkdtemp(prefix="llm-shared-")
            spark.sparkContext.setCheckpointDir(root)  # the setting itself can't be changed
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage at a
    place that survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Let rows travel to Python tasks in batches of at most ``limit`` bytes (a
    row at least), whatever the length of their texts; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    value, unit = re.fullmatch(r"(-?\d+)([bkmgt]?)b?", spark.conf.get(name).lower()).groups()
    now = int(value) << 10 * "bkmgt".index(unit or "b")
    if now > limit or now <= 0:
        spark.conf.set(name, str(limit))


def words(text):
    """Column: the words of a text, A-Z lower-cased (null text: no words)."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def fold(doc_id, modulus: int):
    """Column: crc32 of the id as text, modulo ``modulus`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (v, component), component
    the smallest vertex reachable. Vertices without an edge don't appear.

    Alternating large-star / small-star contraction: each round is a grouped
    minimum (combined map-side, so a hub with a third of all edges is one row
    a task) and a join AQE may split. Rounds grow with the logarithm of the
    longest path; each is written to the shared folder. Edges point from the
    larger to the smaller vertex, so they are done once they form stars: no
    vertex has two edges out, or one out and one in.
    """
    e = (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
         .filter("a != b").distinct())
    e = stash(e, name)
    for _ in range(max_rounds):
        ends = e.select(F.col("a").alias("v"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionAll(
            e.select(F.col("b").alias("v"), F.lit(0).alias("o"), F.lit(1).alias("i")))
        of = ends.groupBy("v").agg(F.sum("o").alias("o"), F.max("i").alias("i"))
        if not of.agg(F.max(F.col("o") + F.when(F.col("o") > 0, F.col("i")).otherwise(0)) > 1).first()[0]:
            break
        # large star: larger neighbours of each vertex go to its smallest neighbour
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        star = (both.filter("b > a").join(least, F.col("a") == F.col("u"))
                .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct())
        # small star: smaller neighbours and the vertex itself go to its smallest neighbour
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        tied = star.join(least.withColumnRenamed("a", "u"), F.col("a") == F.col("u"))
        e = stash(tied.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
                  .unionAll(least.select("a", F.col("m").alias("b"))).distinct(), name)
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("v")).distinct().select("v", F.col("v").alias("component"))
    return e.select(F.col("a").alias("v"), F.col("b").alias("component")).unionAll(roots)


# --- numpy text hashing, run inside tasks on Arrow buffers ------------------

CHUNK = 1 << 18  # bytes of text hashed at once; its arrays take some 100 times that
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_POW: dict[str, np.ndarray] = {}
_FLAGS = np.zeros(256, bool)
_FLAGS[[ord(c) for c in SEPARATORS]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _POW or len(_POW["p"]) < n:
        size = max(n, CHUNK + 1)
        for key, base in (("p", _P), ("i", _PINV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POW[key] = np.cumprod(a, dtype=np.uint64)
    return _POW["p"], _POW["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (the splitmix finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(column, target: int = CHUNK):
    """Slices of an Arrow string column of about ``target`` bytes (one row at
    least): (first row, byte array, offsets from 0). Null rows are empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    bufs = column.buffers()
    offs = np.frombuffer(bufs[1], np.int64, count=n + 1 + column.offset)[column.offset:]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + target, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a chunk begin and end; no word crosses rows."""
    n = len(data)
    isw = ~_FLAGS[data]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = isw[:-1]
    starts = np.flatnonzero(isw & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = isw[1:]
    return starts, np.flatnonzero(isw & (~after | cut[1:])) + 1


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a chunk, and where each row's words begin
    (length rows + 1)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    starts, ends = word_bounds(data, offs)
    p, inv = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[data].astype(np.uint64) * p[:n], out=total[1:])
    h = (total[ends] - total[starts]) * inv[starts]
    h = mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return h, np.searchsorted(starts, offs)


def shingle_hashes(h: np.ndarray, at: np.ndarray, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``k``-word shingles; a row of
    fewer words has its whole sequence as one, a row without words none."""
    mult = np.array([pow(0xA24BAED4963EE407, j + 1, 1 << 64) for j in range(k)], np.uint64)
    m = len(h)
    full = np.zeros(max(m - k + 1, 0), np.uint64)
    for j in range(k):
        full += h[j:j + len(full)] * mult[j]
    full = mix(full)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            s = np.sort(full[a:b - k + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            out.append(mix((h[a:b] * mult[:b - a]).sum(dtype=np.uint64, keepdims=True)
                           + np.uint64(b - a)))
        else:
            out.append(full[:0])
    return out
