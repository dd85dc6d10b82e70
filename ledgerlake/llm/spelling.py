"""Spelling variants: words one edit apart, and the form each word varies.

Words are near if they differ by exactly one inserted, deleted or replaced
code point. A word's form is its near word of largest count (ties: smallest in
code-point order) where that count is at least ``factor`` times the word's own;
its root is where the forms end.

How: a word of length L takes part as the shorter or equal one of a pair
(m = L) and as the longer one (m = L - 1). The first difference of a near pair
lies at a place p of 0..m; the words agree before p and after it. The places
are cut into segments [lo, hi]; words that share m, what stands before lo and
what stands after hi meet in a group, and the pair is counted in the one
segment that holds its p. Groups of more than ``tile`` words are not compared:
their segment is halved and they are grouped anew, until they are small or the
segment is one place wide (then a group can't hold more than the alphabet
squared). So no group is cut, capped or paired up whole, and a prefix that a
third of all words share costs a few more rounds.

Groups are dealt by key and come sorted by length; the tiles are dense: the
words of a run of groups as a matrix of code points padded to one width, once
aligned left, once aligned right. Pairs of blocks that share a group are
compared place by place: common prefix plus common suffix reaching the longer length minus one, with lengths
that differ by one at most, is a single edit.

Defined results: null texts and texts without letters hold no words; a null id
counts as the empty id; repeated rows count again; words are compared in full,
whatever their length; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import LOWER, UPPER, stash

LETTERS = "[A-Za-z\\u00C0-\\u00FF]"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 7, min_count: int = 2, damage: int | None = 31) -> DataFrame:
    """(word, n): the distinct words of all texts and how often they occur.

    ``damage``: where it divides the crc32 of ``id:word``, the occurrence loses
    the code point at crc32 modulo its length (None: no occurrence does).
    """
    # shorter runs can't become words; the quantifiers take runs whole
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"{LETTERS}{{{max(min_chars, 1)},}}+"), F.lit(0))
    words = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"),
                        docs[text_col].alias("text")).select("id", F.explode(runs).alias("run"))
    words = words.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    if damage is not None:
        words = words.select("run", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")).alias("h"))
        at = (F.col("h") % F.char_length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + 2))
        words = words.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("run"))
    words = words.filter(F.char_length("run") >= min_chars)
    return (words.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_count))


def _keyed(rows: DataFrame) -> DataFrame:
    """The group key of (word, m, lo, hi): m, the segment, and hashes of what
    stands before and after it (the tiles compare the words themselves)."""
    ends = F.struct("m", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")),
                    F.when(F.col("hi") < F.col("m"), F.substr(
                        "word", F.char_length("word") - F.col("m") + F.col("hi") + 1)).otherwise(""))
    return rows.withColumn("key", F.xxhash64(ends))


def _segments(words: DataFrame, parts: int) -> DataFrame:
    """(word, n, m, lo, hi): both roles of every word, ``parts`` segments each."""
    size = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).filter("m >= 1")
    rows = rows.select("*", F.explode(F.array(*[F.lit(i) for i in range(parts)])).alias("i"))
    edge = lambda i: F.floor(F.col("m") * i / parts).cast("int")
    rows = rows.select("word", "n", "m", edge(F.col("i")).alias("lo"), edge(F.col("i") + 1).alias("hi"))
    return rows.filter("lo < hi")


def _small_groups(words: DataFrame, tile: int, parts: int = 3):
    """Yields (word, n, m, lo, hi, key) tables: the groups that can be compared."""
    rows = stash(_keyed(_segments(words, parts)), "spelling-groups")
    while True:
        sizes = stash(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
                      .filter("size > 1"), "spelling-sizes")
        # a key may hold many rows: AQE may split its side of this join
        rows = rows.join(sizes, "key")
        done = (F.col("size") <= tile) | (F.col("hi") - F.col("lo") <= 1)
        yield rows.filter(done).drop("size")
        if sizes.agg(F.max("size")).first()[0] is None:
            return
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.explode(F.array(F.struct("lo", mid.alias("hi")), F.struct(mid.alias("lo"), "hi")))
        wide = rows.filter(~done).select("word", "n", "m", halves.alias("s"))
        rows = stash(_keyed(wide.select("word", "n", "m", "s.lo", "s.hi")), "spelling-groups")
        if rows.isEmpty():
            return


def _matrix(rows: list[np.ndarray], sizes: np.ndarray, width: int, right: bool) -> np.ndarray:
    out = np.zeros((len(rows), width), rows[0].dtype)
    for i, (r, n) in enumerate(zip(rows, sizes)):
        if right:
            out[i, width - n:] = r
        else:
            out[i, :n] = r
    return out


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For all pairs of rows: how many leading places agree. Stops where no
    pair agrees any more."""
    alive = np.ones((len(a), len(b)), bool)
    out = np.zeros((len(a), len(b)), np.int32)
    for j in range(a.shape[1]):
        alive &= a[:, j, None] == b[None, :, j]
        if not alive.any():
            break
        out += alive
    return out


def _near_in_tile(words: list[str], group: np.ndarray, m: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                  block: int = 128, cells: int = 1 << 22):
    """Index pairs (i, j) of near words of one group each, by dense tiles.
    ``group`` numbers the groups in the order of the rows."""
    size = np.array([len(w) for w in words], np.int64)
    wide = max(map(max, words)) > "\xff"
    codes = [np.frombuffer(w.encode("utf-32-le" if wide else "latin-1"), np.uint32 if wide else np.uint8)
             for w in words]
    # blocks whose matrices take no more than ``cells`` places (one row at least)
    edges = [0]
    while edges[-1] < len(words):
        s = edges[-1]
        edges.append(min(len(words), s + int(max(1, min(block, cells // size[s:s + block].max())))))
    spans = list(zip(edges, edges[1:]))
    ii, jj = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, (s, e) in enumerate(spans):
        for t, u in spans[k:]:
            if group[t] > group[e - 1]:
                break  # no later block shares a group with this one
            n, n2 = size[s:e], size[t:u]
            width = int(max(n.max(), n2.max()))
            pre = _common(_matrix(codes[s:e], n, width, False), _matrix(codes[t:u], n2, width, False))
            suf = _common(_matrix(codes[s:e], n, width, True)[:, ::-1],
                          _matrix(codes[t:u], n2, width, True)[:, ::-1])
            longer = np.maximum(n[:, None], n2[None, :])
            shorter = np.minimum(n[:, None], n2[None, :])
            pre, suf = np.minimum(pre, shorter), np.minimum(suf, shorter)
            here = (group[s:e, None] == group[None, t:u]) & (longer - shorter <= 1)
            here &= (pre < longer) & (pre + suf >= longer - 1)
            # of the segments, the one that holds the first difference; a pair of
            # two longer words belongs to the groups of their own length
            ms, ls, hs = (x[s:e, None] for x in (m, lo, hi))
            here &= (shorter == ms) & (pre >= ls) & ((pre < hs) | ((hs == ms) & (pre == hs)))
            if s == t:
                here = np.triu(here, 1)
            i, j = np.nonzero(here)
            ii.append(i + s)
            jj.append(j + t)
    return np.concatenate(ii), np.concatenate(jj)


def _pairs(batches, rows: int = 1 << 15):
    """Near pairs, both ways, of rows whose groups come one after the other."""
    kept = None

    def compare(df):
        key = df["key"].to_numpy()
        group = np.cumsum(np.r_[False, key[1:] != key[:-1]])
        i, j = _near_in_tile(df["word"].tolist(), group, *(df[c].to_numpy() for c in ("m", "lo", "hi")))
        w, n = df["word"].to_numpy(), df["n"].to_numpy()
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        return pd.DataFrame({"word": w[a], "near": w[b], "near_n": n[b]})

    for df in batches:
        if kept is not None:
            df = pd.concat([kept, df], ignore_index=True)
        if not len(df):
            continue
        key = df["key"].to_numpy()
        ends = np.flatnonzero(key[1:] != key[:-1]) + 1  # where a group begins anew
        done = int(ends[-1]) if len(ends) else 0  # the last group may go on
        a = 0
        while a < done:
            b = int(ends[min(np.searchsorted(ends, a + rows), len(ends) - 1)])
            yield compare(df.iloc[a:b])
            a = b
        kept = df.iloc[done:]
    if kept is not None and len(kept):
        yield compare(kept)


def near_pairs(words: DataFrame, tile: int = 512) -> DataFrame:
    """(word, near, near_n): every near pair of the stored table ``words``
    (word, n), both ways, once."""
    out = None
    for rows in _small_groups(words, tile):
        dealt = rows.repartition("key").sortWithinPartitions("m", "key")
        found = stash(dealt.select("word", "n", "m", "lo", "hi", "key").mapInPandas(
            _pairs, "word string, near string, near_n bigint"), "spelling-pairs")
        out = found if out is None else out.unionAll(found)
    return out


def follow(links: DataFrame, longest: int) -> DataFrame:
    """(word, root) of the words in ``links`` (word, form): the last word of
    the forms. Paths double each round; none is longer than ``longest``."""
    to = stash(links.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(max(0, math.ceil(math.log2(max(1, longest))))):
        ahead = to.select(F.col("word").alias("w"), F.col("root").alias("r"))
        to = stash(to.join(ahead, F.col("root") == F.col("w"), "left")
                   .select("word", F.coalesce("r", "root").alias("root")), "spelling-roots")
    return to


def variants(words: DataFrame, factor: int = 10, tile: int = 512) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the stored table ``words``."""
    best = near_pairs(words, tile).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    best = best.select(F.col("word").alias("w"), "n_near", F.col("best.near").alias("near"),
                       (-F.col("best.minus")).alias("near_n"))
    linked = words.join(best, F.col("word") == F.col("w"), "left")
    close = F.col("near_n") >= F.col("n") * factor
    linked = stash(linked.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                 F.when(close, F.col("near")).alias("form"),
                                 F.when(close, F.col("near_n")).alias("form_n")), "spelling-forms")
    # counts grow by the factor with every step
    top = words.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    longest = max(1, math.floor(math.log(max(top, 1), factor)) + 1)
    roots = follow(linked.filter("form IS NOT NULL").select("word", "form"), longest)
    roots = roots.select(F.col("word").alias("w"), "root")
    return linked.join(roots, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
