"""Katz backoff language model over word bigrams, trained and applied in parts.

Tokens are words (A-Z lower-cased) and one end per document; a document's
first token follows a start mark. ``P(w | h)`` is the Good-Turing discounted
``d(r) * r / c(h)`` for a bigram seen r times (r up to ``top_discount`` is
discounted), else ``alpha(h) * P(w)`` with alpha normalised exactly over the
seen successors of h. ``P(w)`` backs off once more: Good-Turing discounted
unigram counts, and what they leave for one unknown-word event.

Nothing is broadcast that grows with the corpus beyond ``common`` words:

1. Tasks count their training tokens; the summed unigram table is written to
   the shared folder. It gives the sizes, the unigram discounts, and the
   ``common`` most frequent words, which tasks hold with their counts.
2. Every (document, bigram) goes to a part by the hash of its history (a
   history with more tokens than half a part goes to several by the next word
   too), packed column-wise. A part counts its training bigrams, so scores of
   seen bigrams are complete but for the discounts, which need all parts'
   counts of counts: a document keeps how many of its tokens have each r.
   Histories are also where each token meets its own count.
3. Bigrams never seen are scored by join: with the part's sums per history
   (for alpha) and with the unigram table. Successors outside the common words
   complete the sums by the same join.

Defined results: null and blank texts are one end token; rows repeating an id
are scored row by row; a null id is held out or not by the checksum of the
empty text; without training text every token is unknown and the score is the
base score; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import mix, small_batches, stash, text_chunks, word_hashes

START = np.uint64(0x51A7)
END = np.uint64(0xE4D)
SEEN = 6  # counts of counts needed for discounts up to 5


def _held(ids, modulus: int, rest: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % modulus == rest
                     for i in ids], bool)


def _count_unigrams(modulus, rest):
    def run(batches):
        import pyarrow as pa
        parts, size = [], 0

        def out():
            g = np.concatenate([p[0] for p in parts])
            n = np.concatenate([p[1] for p in parts])
            order = np.argsort(g)
            g, n = g[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            return pa.RecordBatch.from_arrays(
                [pa.array(g[first].view(np.int64)), pa.array(np.add.reduceat(n, first))],
                names=["w", "c"])

        for b in batches:
            train = ~_held(b.column(0).to_pylist(), modulus, rest)
            ends = int(train.sum())
            if ends:
                parts.append((np.array([END]), np.array([ends])))
            for first, data, offs in text_chunks(b.column(1)):
                h, at = word_hashes(data, offs)
                use = np.repeat(train[first:first + len(at) - 1], np.diff(at))
                if use.any():
                    parts.append(np.unique(h[use], return_counts=True))
                    size += len(parts[-1][0])
            if size > 1_000_000:
                yield out()
                parts, size = [], 0
        if parts:
            yield out()
    return run


def discounts(n: list[float], top: int) -> np.ndarray:
    """Good-Turing discount ratios d(1..top) from the numbers n(1..top+1) of
    types met that often, in Katz' form; 1 where the counts can't give one
    between 0 and 1."""
    d = np.ones(top)
    n1 = n[0]
    if n1 <= 0:
        return d
    cut = (top + 1) * n[top] / n1
    for r in range(1, top + 1):
        if n[r - 1] > 0 and cut < 1:
            x = ((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut)
            if 0 < x < 1:
                d[r - 1] = x
    return d


class Unigrams:
    """Unigram probabilities from counts: discounted, the rest for unknown words."""

    def __init__(self, total: float, counts_of_counts: list[float], top: int):
        self.total, self.top = max(total, 1.0), top
        d = discounts(counts_of_counts, top)
        if (d == 1).all() and total:
            d[0] = 1 - 1 / (total + 1)  # leave something for unknown words
        left = sum((1 - d[r - 1]) * r * counts_of_counts[r - 1] for r in range(1, top + 1))
        # where no word occurs once, all counts give a little for unknown words
        self.scale = total / (total + 1) if total and left <= 0 else 1.0
        self.d = d
        self.unknown = (left / self.total if left > 0 else 1 / (total + 1)) if total else 1.0

    def p(self, c: np.ndarray) -> np.ndarray:
        c = np.asarray(c)
        factor = np.where((c >= 1) & (c <= self.top), self.d[np.clip(c, 1, self.top) - 1], 1.0)
        return np.where(c > 0, self.scale * factor * c / self.total, self.unknown)

    def column(self, c):
        """The same as a DataFrame column."""
        out = F.when(c > self.top, F.lit(float(self.scale)) * c / self.total)
        for r in range(1, self.top + 1):
            out = out.when(c == r, F.lit(float(self.scale * self.d[r - 1] * r / self.total)))
        return out.otherwise(F.lit(float(self.unknown)))


_COLS = (("h", np.uint64), ("w", np.uint64), ("doc", np.uint16), ("n", np.uint16))


def _pack(h, w, doc, n) -> bytes:
    """Rows sorted by history: the histories once, then the rest column-wise."""
    import pyarrow as pa
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    run = np.diff(np.append(first, len(h))).astype(np.uint32)
    raw = b"".join([np.array([len(first), len(h)], np.int64).tobytes(), h[first].tobytes(),
                    run.tobytes(), w.tobytes(), doc.astype(np.uint16).tobytes(),
                    n.astype(np.uint16).tobytes()])
    return np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unpack(blob: bytes):
    import pyarrow as pa
    size = int(np.frombuffer(blob, np.int64, 1)[0])
    raw = pa.decompress(blob[8:], size, "zstd", asbytes=True)
    k, m = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16
    out = []
    for count, kind in ((k, np.uint64), (k, np.uint32), (m, np.uint64), (m, np.uint16), (m, np.uint16)):
        out.append(np.frombuffer(raw, kind, count, at))
        at += count * np.dtype(kind).itemsize
    h, run, w, doc, n = out
    return np.repeat(h, run), w, doc, n


def _pack_rows(idx, *cols) -> bytes:
    """The documents of a batch that a part met: u16 places, then columns."""
    import pyarrow as pa
    raw = idx.astype(np.uint16).tobytes() + b"".join(c.tobytes() for c in cols)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unpack_rows(blob: bytes, n_float: int, n_int: int):
    import pyarrow as pa
    size = int(np.frombuffer(blob, np.int64, 1)[0])
    raw = pa.decompress(blob[8:], size, "zstd", asbytes=True)
    m = size // (2 + 8 * n_float + 4 * n_int)
    idx = np.frombuffer(raw, np.uint16, m).astype(np.int64)
    out, at = [], 2 * m
    for kind, k in ((np.float64, n_float), (np.uint32, n_int)):
        for _ in range(k):
            out.append(np.frombuffer(raw, kind, m, at).astype(float))
            at += m * np.dtype(kind).itemsize
    return idx, np.stack(out, axis=1)


def part_of(h: np.ndarray, w: np.ndarray, parts: int, hot: np.ndarray, ways: np.ndarray) -> np.ndarray:
    """The part of each bigram; histories in ``hot`` (sorted) go to ``ways`` parts."""
    p = mix(h ^ np.uint64(0xC2B2AE3D)) % np.uint64(parts)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
        is_hot = hot[at] == h
        p = np.where(is_hot, (p + mix(w ^ np.uint64(0x27D4EB2F)) % ways[at]) % np.uint64(parts), p)
    return p.astype(np.int64)


def _spread(parts, hot, ways, batch_docs):
    """Task code: blobs of (document, bigram) rows per part and document batch."""
    def run(batches):
        import pyarrow as pa
        ids, held, got, size = [], [], [], 0

        from pyspark import TaskContext
        task, number = TaskContext.get().partitionId(), 0

        def out():
            h, w, doc = (np.concatenate(x) for x in zip(*got))
            order = np.lexsort((doc, w, h))
            h, w, doc = h[order], w[order], doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(h)))
            tokens = np.bincount(doc, minlength=len(ids)).astype(np.int32)
            h, w, doc = h[first], w[first], doc[first]
            big = np.flatnonzero(n > 65535)
            p = part_of(h, w, parts, hot, ways)
            if len(big):  # more than a count column holds: further rows
                more = [(i, min(65535, left)) for i in big.tolist()
                        for left in range(int(n[i]) - 65535, 0, -65535)]
                extra = np.array([m[0] for m in more], np.int64)
                h, w, doc, p = (np.concatenate([x, x[extra]]) for x in (h, w, doc, p))
                n = np.concatenate([np.minimum(n, 65535), [m[1] for m in more]])
                order = np.lexsort((w, h))
                h, w, doc, p, n = h[order], w[order], doc[order], p[order], n[order]
            order = np.argsort(p, kind="stable")
            bound = np.searchsorted(p[order], np.arange(parts + 1))
            names, blobs = [], []
            for k in range(parts):
                s = order[bound[k]:bound[k + 1]]
                if len(s):
                    names.append(k)
                    blobs.append(_pack(h[s], w[s], doc[s], n[s]))
            # the ids travel with the first blob of the batch
            none = np.array([i is None for i in ids])
            head = (np.array([0 if i is None else i for i in ids], np.int64).tobytes()
                    + tokens.tobytes() + np.packbits(none).tobytes())
            m = len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), pa.array([f"{task}-{number}"] * m), pa.array(blobs, pa.binary()),
                 pa.array([np.packbits(np.array(held)).tobytes()] * m, pa.binary()),
                 pa.array([head] + [None] * (m - 1), pa.binary()), pa.array([len(ids)] * m, pa.int32())],
                names=["part", "batch", "blob", "held", "head", "docs"])

        for b in batches:
            own = b.column(0).to_pylist()
            for first, data, offs in text_chunks(b.column(1)):
                h, at = word_hashes(data, offs)
                k = len(at) - 1
                # every row's words, each after the one before; the end after the last
                size_of = np.diff(at) + 1
                begin = np.concatenate([[0], np.cumsum(size_of)])
                nxt = np.full(begin[-1], END, np.uint64)
                row = np.repeat(np.arange(k), np.diff(at))
                nxt[np.arange(len(h)) + row] = h
                prev = np.empty_like(nxt)
                prev[1:] = nxt[:-1]
                prev[begin[:-1]] = START
                for s in range(0, k, 16384):
                    e = min(s + 16384, k)
                    if ids and len(ids) + e - s > 65535:
                        yield out()
                        number += 1
                        ids, held, got, size = [], [], [], 0
                    x = slice(begin[s], begin[e])
                    got.append((prev[x], nxt[x],
                                np.repeat(np.arange(s, e), size_of[s:e]) - s + len(ids)))
                    ids += own[first + s:first + e]
                    held += _held(own[first + s:first + e], *batch_docs[1:]).tolist()
                    size += begin[e] - begin[s]
                if size > batch_docs[0]:
                    yield out()
                    number += 1
                    ids, held, got, size = [], [], [], 0
        if ids:
            yield out()
    return run


def _score_part(model, top, hot, slices=8):
    """Task code of one part: kinds of rows out (see ``_OUT``)."""
    def score_slice(h, w, doc, n, train, table, met, coc, base, batches):
        order = np.lexsort((w, h))
        h, w, doc, n = h[order], w[order], doc[order], n[order]
        pair = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])]))
        c_pair = np.add.reduceat(n * train[doc], pair)
        reps = np.diff(np.append(pair, len(h)))
        r = np.repeat(c_pair, reps)
        ph, pw = h[pair], w[pair]
        hist = np.flatnonzero(np.concatenate([[True], ph[1:] != ph[:-1]]))
        c_hist = np.add.reduceat(c_pair, hist)
        per = np.diff(np.append(hist, len(pair)))
        names = ph[hist]
        if len(hot[0]):  # counts of histories that several parts share
            at = np.minimum(np.searchsorted(hot[0], names), len(hot[0]) - 1)
            c_hist = np.where(hot[0][at] == names, hot[1][at], c_hist)
        c_of = np.repeat(np.repeat(c_hist, per), reps)
        seen, size = r > 0, len(train)

        # per document: the fixed part, base score, known tokens, tokens by r
        table[0] += np.bincount(doc[seen], n[seen] * np.log10(r[seen] / c_of[seen]), size)
        word = h != START  # a word is the history of the token after it
        table[1] += np.bincount(doc[word], n[word] * np.log10((c_of[word] + 1) / model["base"]), size)
        table[2] += np.bincount(doc[word], n[word] * (c_of[word] > 0), size)
        for k in range(1, top + 1):
            table[2 + k] += np.bincount(doc[r == k], n[r == k], size)
        met[doc] = True
        coc += np.bincount(np.minimum(c_pair, top + 2), minlength=top + 3)[1:top + 2]

        # unseen bigrams, and the sums of their histories over seen successors
        gone = np.flatnonzero(~seen)
        if not len(gone):
            return []
        need = np.unique(h[gone])
        at = np.searchsorted(names, need)
        which = np.full(len(names), -1)
        which[at] = np.arange(len(need))
        of_pair = np.repeat(which, per)
        use = (of_pair >= 0) & (c_pair > 0)
        k, rr, ww = of_pair[use], c_pair[use], pw[use]
        stat = np.zeros((len(need), top + 2))
        for q in range(1, top + 1):
            stat[:, q - 1] = np.bincount(k, rr == q, len(need))
        stat[:, top] = np.bincount(k, rr * (rr > top), len(need))
        place = np.minimum(np.searchsorted(model["words"], ww), max(len(model["words"]) - 1, 0))
        common = (model["words"][place] == ww) if len(model["words"]) else np.zeros(len(ww), bool)
        stat[:, top + 1] = np.bincount(k[common], model["p"][place[common]], len(need))
        rows = [{"kind": 2, "h": need.view(np.int64), "n": c_hist[at], "x": stat.ravel()},
                {"kind": 3, "h": need[k[~common]].view(np.int64), "w": ww[~common].view(np.int64)}]
        which_batch = np.searchsorted(base, doc[gone], side="right") - 1
        for i, batch in enumerate(batches):
            s = gone[which_batch == i]
            if len(s):
                rows.append({"kind": 4, "batch": batch, "h": h[s].view(np.int64),
                             "w": w[s].view(np.int64), "n": n[s], "doc": doc[s] - base[i]})
        return rows

    def run(pdf):
        import pandas as pd
        blobs = [_unpack(b) for b in pdf["blob"]]
        held = [np.unpackbits(np.frombuffer(b, np.uint8)).astype(bool) for b in pdf["held"]]
        docs = pdf["docs"].tolist()
        base = np.concatenate([[0], np.cumsum(docs)])
        train = ~np.concatenate([x[:k] for x, k in zip(held, docs)])
        table = [np.zeros(int(base[-1])) for _ in range(3 + top)]
        met, coc, rows = np.zeros(int(base[-1]), bool), np.zeros(top + 1), []
        # histories in slices of their hash range: less memory at a time
        edges = [np.uint64((1 << 64) * k // slices) for k in range(slices)] + [None]
        for lo, hi in zip(edges, edges[1:]):
            cut = [(int(np.searchsorted(b[0], lo)),
                    len(b[0]) if hi is None else int(np.searchsorted(b[0], hi))) for b in blobs]
            h, w, doc, n = (np.concatenate([b[j][x:z] for b, (x, z) in zip(blobs, cut)])
                            for j in range(4))
            if len(h):
                doc = doc.astype(np.int64) + np.repeat(base[:-1], [z - x for x, z in cut])
                rows += score_slice(h, w, doc, n.astype(np.int64), train, table, met, coc, base,
                                    pdf["batch"])
        counts = [x.astype(np.uint32) for x in table[2:]]
        for i, batch in enumerate(pdf["batch"]):
            at = np.flatnonzero(met[base[i]:base[i + 1]])
            rows.append({"kind": 0, "batch": batch, "head": pdf["head"].iloc[i], "rows": _pack_rows(
                at, *(x[base[i] + at] for x in (*table[:2], *counts)))})
        rows.append({"kind": 1, "x": coc})
        out = {c: [x.get(c) for x in rows]
               for c in ("kind", "batch", "h", "w", "n", "doc", "x", "head", "rows")}
        return pd.DataFrame(out)
    return run


_OUT = ("kind int, batch string, h array<bigint>, w array<bigint>, n array<bigint>, "
        "doc array<int>, x array<double>, head binary, rows binary")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    modulus: int = 7, rest: int = 2, top_discount: int = 5,
                    common: int = 400_000, part_rows: int = 2_500_000,
                    batch_tokens: int = 1_000_000) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for every row; documents whose id's crc32 is ``rest`` modulo ``modulus``
    are held out of the counts."""
    spark, top = docs.sparkSession, top_discount
    small_batches(spark)
    base = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("t"))
    uni = stash(base.mapInArrow(_count_unigrams(modulus, rest), "w bigint, c bigint")
                .groupBy("w").agg(F.sum("c").alias("c")), "katz-unigrams")
    got = uni.agg(F.sum("c"), F.count(F.lit(1)), *[
        F.sum((F.col("c") == r).cast("bigint")) for r in range(1, top + 2)]).first()
    total, vocab = int(got[0] or 0), int(got[1] or 0)
    first = Unigrams(total, [float(v or 0) for v in got[2:]], top)
    end_count = uni.filter(F.col("w") == int(END)).agg(F.max("c")).first()[0] or 0

    rows = max(1, math.ceil(total * modulus / (modulus - 1)))
    parts = max(1, math.ceil(rows / part_rows))
    limit = max(1, part_rows // 2)
    heavy = uni.filter((F.col("c") > limit) & (F.col("w") != int(END))).select("w", "c").collect()
    hot_rows = sorted([(int(np.int64(r["w"]).view(np.uint64)), r["c"]) for r in heavy]
                      + ([(int(START), end_count)] if end_count > limit else []))
    hot = np.array([x[0] for x in hot_rows], np.uint64)
    hot_c = np.array([x[1] for x in hot_rows], np.int64)
    ways = np.maximum(np.ceil(hot_c / limit), 1).astype(np.uint64)

    # common words: whole classes of counts (64 to a power of two), most
    # frequent first, as many as stay within ``common`` words
    level = F.floor(F.log2(F.col("c").cast("double")) * 64)
    held_back, least = 0, 0
    for r in sorted(uni.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        if held_back + r["count"] > common:
            least = r["level"] + 1
            break
        held_back += r["count"]
    frequent = uni.filter(level >= least).toArrow()  # at most ``common`` rows
    words = frequent["w"].to_numpy().astype(np.int64).view(np.uint64)
    counts = frequent["c"].to_numpy().astype(np.int64)
    order = np.argsort(words)
    counts = counts[order]
    held = spark.sparkContext.broadcast({"base": float(total + vocab + 1), "words": words[order],
                                         "p": first.p(counts)})

    sent = base.mapInArrow(
        _spread(parts, hot, ways, (batch_tokens, modulus, rest)),
        "part int, batch string, blob binary, held binary, head binary, docs int")
    score_part = _score_part_with(held, top, (hot, hot_c))
    out = stash(sent.groupBy("part").applyInPandas(score_part, _OUT), "katz-scores")

    got = out.filter("kind = 1").agg(*[F.sum(F.col("x")[i]) for i in range(top + 1)]).first()
    d = discounts([float(v or 0) for v in got], top)

    # alpha of each history with unseen bigrams
    p_word = first.column(F.col("c"))
    k = top + 2
    stats = (out.filter("kind = 2").select(F.posexplode("h").alias("i", "h"), "n", "x")
             .select("h", F.col("n")[F.col("i")].alias("c"), F.slice(F.col("x"), F.col("i") * k + 1, k)
                     .alias("s")))
    stats = stats.groupBy("h").agg(F.max("c").alias("c"), *[F.sum(F.col("s")[i]).alias(f"s{i}")
                                                            for i in range(k)])
    rare = (out.filter("kind = 3").select(F.explode(F.arrays_zip("h", "w")).alias("z"))
            .select("z.h", F.col("z.w").alias("rw")).join(uni, F.col("rw") == F.col("w"))
            .groupBy(F.col("h").alias("rh")).agg(F.sum(p_word).alias("p_rare")))
    taken = sum(F.col(f"s{r - 1}") * float(r * d[r - 1]) for r in range(1, top + 1)) + F.col(f"s{top}")
    alpha = (stats.join(rare, F.col("h") == F.col("rh"), "left")
             .select(F.col("h").alias("ah"), F.when(F.col("c") > 0, (1 - taken / F.col("c")) / (
                 1 - F.col(f"s{top + 1}") - F.coalesce("p_rare", F.lit(0.0)))).otherwise(1.0)
                 .alias("alpha")))
    unseen = (out.filter("kind = 4").select("batch", F.explode(F.arrays_zip("h", "w", "n", "doc")).alias("z"))
              .select("batch", "z.h", F.col("z.w").alias("uw"), "z.n", "z.doc"))
    # a history whose every training bigram is beyond discounting has nothing
    # left for others; its unseen bigrams get the floor of an unknown word
    floor = F.lit(float(max(first.unknown, 1e-12) / max(total, 1)))
    backed = (unseen.join(uni, F.col("uw") == F.col("w"), "left")
              .join(alpha, F.col("h") == F.col("ah"))
              .withColumn("p", F.greatest(F.col("alpha"), floor) * first.column(F.coalesce("c", F.lit(0))))
              .groupBy(F.col("batch").alias("ub"), F.col("doc").alias("ud"))
              .agg(F.sum(F.col("n") * F.log10("p")).alias("backed")))

    names = [f"x{i}" for i in range(3 + top)]

    def add(pdf):
        import pandas as pd
        head = next(x for x in pdf["head"] if x is not None)
        k = len(head) * 8 // 97
        while 12 * k + (k + 7) // 8 < len(head):
            k += 1
        total = np.zeros((k, 3 + top))
        for x in pdf["rows"]:
            idx, cols = _unpack_rows(x, 2, 1 + top)
            total[idx] += cols
        none = np.unpackbits(np.frombuffer(head, np.uint8, offset=12 * k))[:k].astype(bool)
        ids = pd.array(np.frombuffer(head, np.int64, k), dtype="Int64")
        ids[none] = pd.NA
        res = pd.DataFrame(total, columns=names)
        return res.assign(batch=pdf["batch"].iloc[0], doc=np.arange(k, dtype=np.int32), id=ids,
                          tokens=np.frombuffer(head, np.int32, k, 8 * k).astype(np.int64))

    per_doc = (out.filter("kind = 0").select("batch", "head", "rows").groupBy("batch").applyInPandas(
        add, ", ".join(f"{x} double" for x in names)
        + ", batch string, doc int, id bigint, tokens bigint"))
    fixed = F.col("x0") + sum(F.col(f"x{2 + r}") * float(math.log10(d[r - 1]))
                              for r in range(1, top + 1))
    end_base = math.log10((end_count + 1) / (total + vocab + 1))
    out_rows = per_doc.join(backed, (F.col("batch") == F.col("ub")) & (F.col("doc") == F.col("ud")), "left")
    held_out = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))) % modulus == rest
    return out_rows.select(
        F.col("id").alias(id_col), held_out.alias("held_out"),
        F.col("tokens").alias("n_tokens"),
        (F.round("x2") + (1 if end_count else 0)).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("x1") + end_base).alias("base_score"),
        (fixed + F.coalesce("backed", F.lit(0.0))).alias("score"))


def _score_part_with(held, top, hot):
    """The part's task code with the common words from the broadcast."""
    def run(pdf):
        return _score_part(held.value, top, hot)(pdf)
    return run
