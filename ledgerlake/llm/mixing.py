"""Mix documents to target domain weights by soft membership.

A classifier learned from a labelled table gives every document a posterior
over the domains. Rates (how often a document is taken) are fitted so that
the expected token totals, sum of rate x tokens x posterior, come as near as
possible to the targets in least squares, with rates from 0 to ``max_rate``:
projected gradient steps from rate 1, each one pass that sums the totals over
the documents. A step moves a rate along the document's posterior, so its
state is the list of step vectors, as long as the passes and as wide as the
domains; tasks replay it. Nothing per document reaches the driver.

The classifier is logistic regression, one domain against the rest, scaled to
sum to 1. Its features are the presence of the ``n_features`` words and word
shapes whose counts differ most between domains, beyond chance. It learns from
about ``sample`` labelled documents a domain (all, where there are no more;
else the share of them with the least id hashes); tasks sum the Newton
equations over their rows. ``missed`` of the fitted model says how far the
expected shares stay from the targets.

Defined results: null or empty text has no tokens and the prior as posterior;
its rate is that of the prior. Labels that name several domains for an id
count once for each; null ids and domains are left out. Documents that repeat
an id are rated row by row. Without labels all documents form one domain. A
domain without a target weight gets weight 0; one without a labelled document
here is left out. An empty table gives an empty
result. Further columns are kept by ``apply_rates`` and ignored elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import _LOWER, mix, small_batches, stash, text_chunks, word_bounds, word_hashes

STEMS = (4, 6)  # bytes
_KIND = np.full(256, 3, np.uint64)  # letters beyond ASCII
_KIND[:128] = 64 + np.arange(128)   # signs stand for themselves
for _a, _b, _v in (("A", "Z", 1), ("a", "z", 3), ("0", "9", 2)):
    _KIND[ord(_a):ord(_b) + 1] = _v


def _tokens(data, offs):
    """Hashes of words, of word shapes (kinds of the first two and last three
    bytes) and of the beginnings of longer words (``STEMS`` bytes), and where
    each row's begin in the first two; a stem's row besides."""
    h, at = word_hashes(data, offs)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not len(h):
        return h, h, at, none
    s, e = word_bounds(data, offs)
    size, e = e - s, e - 1
    k = [_KIND[data[s]], _KIND[data[np.minimum(s + 1, e)]],
         _KIND[data[np.maximum(e - 2, s)]], _KIND[data[np.maximum(e - 1, s)]], _KIND[data[e]]]
    shape = np.zeros(len(s), np.uint64)
    for x in k:
        shape = shape * np.uint64(256) + x
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    stems, rows = [], []
    for n in STEMS:
        long = np.flatnonzero(size > n)
        x = np.full(len(long), n, np.uint64)
        for j in range(n):
            x = x * np.uint64(0x100000001B3) ^ _LOWER[data[s[long] + j]].astype(np.uint64)
        stems.append(mix(x + np.uint64(0x57E3)))
        rows.append(row[long])
    return h, mix(shape + np.uint64(0x1234567)), at, (np.concatenate(stems), np.concatenate(rows))


def _present(h, shape, at, stems):
    """Distinct tokens of each row."""
    order = np.argsort(stems[1], kind="stable")
    of = stems[0][order]
    cut = np.searchsorted(stems[1][order], np.arange(len(at)))
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        yield np.unique(np.concatenate([h[a:b], shape[a:b], of[cut[i]:cut[i + 1]]]))


@dataclass
class DomainModel:
    """Token weights (tokens sorted) and the steps of the fit."""

    domains: list[str]
    bias: np.ndarray
    grams: np.ndarray
    weight: np.ndarray  # tokens x domains, on the log odds
    max_rate: float = 1.0
    steps: list[np.ndarray] = field(default_factory=list)
    barred: list[int] = field(default_factory=list)  # domains that bar a document
    bar: float = 1.0
    missed: dict[str, float] = field(default_factory=dict)  # reached less target share

    def hits(self, h, shape, at, stems) -> tuple[np.ndarray, np.ndarray]:
        """(row, token) of the model's tokens present in each row."""
        if not len(self.grams) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        every = np.concatenate([h, shape, stems[0]])
        where = np.minimum(np.searchsorted(self.grams, every), len(self.grams) - 1)
        hit = self.grams[where] == every
        pair = np.unique(np.concatenate([row, row, stems[1]])[hit] * len(self.grams) + where[hit])
        return pair // len(self.grams), pair % len(self.grams)

    def posteriors(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(words, posteriors) of an Arrow string column."""
        words, post = [], []
        for _, data, offs in text_chunks(column):
            h, shape, at, stems = _tokens(data, offs)
            odds = np.tile(self.bias, (len(at) - 1, 1))
            row, tok = self.hits(h, shape, at, stems)
            for d in range(len(self.domains)):
                odds[:, d] += np.bincount(row, self.weight[tok, d], len(at) - 1)
            p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            words.append(np.diff(at))
            post.append(p / p.sum(axis=1, keepdims=True))
        if not words:
            return np.zeros(0, np.int64), np.zeros((0, len(self.domains)))
        return np.concatenate(words), np.concatenate(post)

    def rates(self, post: np.ndarray) -> np.ndarray:
        r = np.full(len(post), min(1.0, self.max_rate))
        for g in self.steps:
            r = np.clip(r - post @ g, 0.0, self.max_rate)
        if self.barred:
            r = np.where(post[:, self.barred].sum(axis=1) > self.bar, 0.0, r)
        return r


def learn_domains(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", domain_col: str = "domain", sample: int = 20_000,
                  n_features: int = 360, least_z: float = 6.0, passes: int = 15) -> DomainModel:
    """``labels``: rows (id_col, domain_col)."""
    small_batches(docs.sparkSession)
    named = (labels.filter(labels[id_col].isNotNull() & labels[domain_col].isNotNull())
             .select(labels[id_col].alias("l_id"), labels[domain_col].cast("string").alias("d"))
             .distinct())
    # only what is labelled and among these documents counts
    ids = docs.select(docs[id_col].alias("have")).distinct()
    named = stash(named.join(ids, F.col("l_id") == F.col("have"), "left_semi"), "mix-named")
    share = {r["d"]: r["count"] for r in named.groupBy("d").count().collect()}
    domains = sorted(share) or ["all"]
    prior = np.array([share.get(d, 1) for d in domains], float)
    prior = np.clip(prior / prior.sum(), 1e-6, 1 - 1e-6)
    model = DomainModel(domains, np.log(prior / (1 - prior)), np.zeros(0, np.uint64),
                        np.zeros((0, len(domains))))
    if len(domains) < 2:
        return model
    # a domain with more labels gives the share of them that makes ``sample``
    # rows: those with small id hashes, so no domain is sorted or gathered
    place = F.pmod(F.xxhash64("l_id"), F.lit(1 << 40))
    rare = [d for d in domains if share[d] <= sample]
    chosen = F.col("d").isin(rare)
    for d in domains:
        if share[d] > sample:
            chosen = chosen | ((F.col("d") == d) & (place < int((1 << 40) * sample / share[d])))
    some = stash(named.filter(chosen), "mix-labels")  # about sample x domains rows
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t")).join(
        F.broadcast(some), F.col("id") == F.col("l_id")).select("d", "t")

    def count(batches):
        import pyarrow as pa
        held: dict[str, list] = {}

        def out():
            for d, parts in held.items():
                g, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(g)), pa.array(g.view(np.int64)), pa.array(n)],
                    names=["d", "g", "n"])
            held.clear()

        for b in batches:
            names = b.column(0).to_pylist()
            for first, data, offs in text_chunks(b.column(1)):
                for i, u in enumerate(_present(*_tokens(data, offs))):
                    held.setdefault(names[first + i], []).append(u)
            if sum(sum(map(len, x)) for x in held.values()) > 4_000_000:
                yield from out()
        yield from out()

    docs_of = {r["d"]: r["count"] for r in rows.groupBy("d").count().collect()}
    total = sum(docs_of.values())
    counted = rows.mapInArrow(count, "d string, g bigint, n bigint")
    n_d = [docs_of.get(d, 0) for d in domains]
    wide = counted.groupBy("g").agg(F.sum("n").alias("n"), *[
        F.sum(F.when(F.col("d") == d, F.col("n")).otherwise(0)).alias(f"n{i}")
        for i, d in enumerate(domains)])
    # each domain's own words: more of them in it than chance would put there
    part = [min(max(n / max(total, 1), 1e-9), 1 - 1e-9) for n in n_d]
    wide = stash(wide.filter(F.col("n") >= 10).withColumns({
        f"z{i}": (F.col(f"n{i}") - F.col("n") * q) / F.sqrt(F.col("n") * (q * (1 - q)))
        for i, q in enumerate(part)}), "mix-tokens")
    top: set = set()
    for i in range(len(domains)):
        best = (wide.filter(F.col(f"z{i}") >= least_z).orderBy(F.desc(f"z{i}"), "g")
                .limit(n_features // len(domains)).select("g").collect())
        top |= {r["g"] for r in best}
    if not top:
        return model
    model.grams = np.sort(np.array(sorted(top), np.int64).view(np.uint64))
    _train(rows, model, total, passes)
    # the sample's shares of the domains give way to those of the whole table
    model.bias = model.bias + np.log(prior / (1 - prior)) - np.log(
        np.array(part) / (1 - np.array(part)))
    return model


def _train(rows: DataFrame, model: DomainModel, total: int, passes: int, ridge: float = 1e-4) -> None:
    """Newton steps of the logistic fits; sets bias and weight. A step that
    makes a domain's penalised loss worse is halved until it does not."""
    k, f = len(model.domains), len(model.grams) + 1
    place = {d: i for i, d in enumerate(model.domains)}

    def encode(batches):
        import pyarrow as pa
        for b in batches:
            y = np.array([place[d] for d in b.column(0).to_pylist()], np.int32)
            for first, data, offs in text_chunks(b.column(1)):
                row, tok = model.hits(*_tokens(data, offs))
                n = len(offs) - 1
                cut = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y[first:first + n]),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(tok.astype(np.int32)))],
                    names=["y", "x"])

    data = stash(rows.mapInArrow(encode, "y int, x array<int>"), "mix-train")
    beta = np.zeros((f, k))
    beta[-1] = model.bias

    def sums(batches):
        import pandas as pd
        acc, loss = np.zeros((k, f, f + 1)), np.zeros((k, f + 1))
        for b in batches:
            for s in range(0, b.num_rows, 4096):
                c = b.slice(s, 4096)
                x = np.zeros((c.num_rows, f))
                lists = c.column(1)
                row = np.repeat(np.arange(c.num_rows), np.asarray(lists.value_lengths()))
                x[row, np.asarray(lists.flatten())] = 1
                x[:, -1] = 1
                y = np.asarray(c.column(0))
                z = x @ beta
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                for d in range(k):
                    loss[d, 0] += (np.logaddexp(0, z[:, d]) - z[:, d] * (y == d)).sum()
                    acc[d, :, :f] += x.T @ (x * (p[:, d] * (1 - p[:, d]))[:, None])
                    acc[d, :, f] += x.T @ ((y == d) - p[:, d])
        import pyarrow as pa
        flat = np.vstack([acc.reshape(k * f, f + 1), loss])
        yield pa.RecordBatch.from_pandas(pd.DataFrame(
            {"i": np.arange(k * f + k, dtype=np.int32), "s": list(flat)}), preserve_index=False)

    def add(pdf):
        import pandas as pd
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "s": [np.sum(np.stack(pdf["s"]), axis=0)]})

    shape = "i int, s array<double>"
    held, low, step = beta.copy(), np.full(k, np.inf), np.zeros((f, k))
    for _ in range(passes):
        got = data.mapInArrow(sums, shape).groupBy("i").applyInPandas(add, shape).collect()
        flat = np.stack([r["s"] for r in sorted(got, key=lambda r: r["i"])])
        acc = flat[:k * f].reshape(k, f, f + 1)
        loss = flat[k * f:, 0] + ridge * total / 2 * (beta ** 2).sum(axis=0)
        new = beta.copy()
        for d in range(k):
            if loss[d] > low[d] * (1 + 1e-9):
                step[:, d] /= 2
            else:
                held[:, d], low[d] = beta[:, d], loss[d]
                h = acc[d, :, :f] + ridge * total * np.eye(f)
                step[:, d] = np.linalg.solve(h, acc[d, :, f] - ridge * total * beta[:, d])
            new[:, d] = held[:, d] + step[:, d]
        beta = new
        if np.abs(step).max() < 0.01:
            break
    beta = np.where(np.abs(step).max(axis=0) < 0.01, beta, held)  # the last step was not tried
    model.weight, model.bias = beta[:-1], beta[-1]


def memberships(docs: DataFrame, model: DomainModel, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(id_col, tokens, posterior array<double>) for every row."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa
        for b in batches:
            words, post = model.posteriors(b.column(1))
            offs = pa.array(np.arange(0, post.size + 1, post.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words, pa.int64()),
                 pa.ListArray.from_arrays(offs, pa.array(post.ravel()))],
                names=[id_col, "tokens", "posterior"])

    return docs.select(docs[id_col].alias(id_col), docs[text_col].alias("__t")).mapInArrow(
        run, f"`{id_col}` {kind}, tokens bigint, posterior array<double>")


def fit_rates(members: DataFrame, model: DomainModel, weights: dict[str, float],
              total_tokens: float | None = None, max_rate: float = 4.0, passes: int = 30,
              close: float = 1e-4, bar: float | None = None) -> DomainModel:
    """Set the model's steps so that rates meet the targets ``weights`` (shares
    of ``total_tokens``; by default as many as there are); ``model.missed`` is
    what the best of the passes leaves of them. With ``bar``, a
    document whose posterior of the domains without weight is above it gets
    rate 0, however rare such documents are."""
    model.max_rate, model.steps, model.missed = max_rate, [], {}
    k = len(model.domains)
    target = np.array([float(weights.get(d, 0.0)) for d in model.domains])
    model.barred = [] if bar is None else np.flatnonzero(target == 0).tolist()
    model.bar = 1.0 if bar is None else bar
    target = target / target.sum() if target.sum() else np.full(k, 1 / k)

    def sums(batches):
        import pandas as pd
        acc = np.zeros(k + 1 + k * k)
        for b in batches:
            if len(b):
                p = np.stack(b["posterior"].to_numpy())
                t = b["tokens"].to_numpy(float)
                r = model.rates(p)
                free = t * ((r > 0) & (r < model.max_rate))
                acc[:k] += (t * r) @ p
                acc[k] += t.sum()
                acc[k + 1:] += (p.T @ (p * free[:, None])).ravel()
        yield pd.DataFrame({"s": [acc]})

    slim = members.select("tokens", "posterior")
    best = None
    for _ in range(passes):
        got = slim.mapInPandas(sums, "s array<double>").agg(
            *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(k + 1 + k * k)]).first()
        s = np.array([v or 0.0 for v in got])
        size = s[k]
        if not size:
            break
        want = target * (total_tokens or size)
        off = (s[:k] - want) / size
        if best is None or np.abs(off).sum() < best[0] - close / 10:
            best = (np.abs(off).sum(), list(model.steps))
            model.missed = dict(zip(model.domains, off.tolist()))
        elif len(model.steps) > len(best[1]) + 5:
            break
        if np.abs(off).max() < close:
            break
        # the curvature over the rates that can still move shapes the step
        m = s[k + 1:].reshape(k, k) / size
        step = np.linalg.solve(m + 1e-3 * np.eye(k), off)
        model.steps = [*model.steps, step]
    if best:
        model.steps = best[1]
    return model


def copies(rate: np.ndarray, ids) -> np.ndarray:
    """Whole copies: the rate rounded up with the chance of its fraction, by a
    hash of the id."""
    raw = np.array([hash_id(i) for i in ids], np.uint64)
    u = (mix(raw) >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.floor(rate + u).astype(np.int64)


def hash_id(i) -> int:
    import zlib
    if isinstance(i, (int, np.integer)):
        return int(i) & ((1 << 64) - 1)
    return zlib.crc32(str(i).encode())


def rated(members: DataFrame, model: DomainModel, id_col: str = "doc_id") -> DataFrame:
    """(id_col, tokens, posterior, rate, copies)."""
    kind = dict(members.dtypes)[id_col]

    def run(batches):
        import pyarrow as pa
        k = len(model.domains)
        for b in batches:
            post = np.asarray(b.column(2).flatten()).reshape(-1, k)
            r = model.rates(post)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(r),
                 pa.array(copies(r, b.column(0).to_pylist()))],
                names=[id_col, "tokens", "posterior", "rate", "copies"])

    return members.select(id_col, "tokens", "posterior").mapInArrow(
        run, f"`{id_col}` {kind}, tokens bigint, posterior array<double>, rate double, copies bigint")


def apply_rates(docs: DataFrame, model: DomainModel, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as its rate says, all columns."""
    at, ids = docs.columns.index(text_col), docs.columns.index(id_col)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                _, post = model.posteriors(b.column(at))
                # a row without an id is drawn by its text
                names = [t or "" if i is None else i for i, t in
                         zip(b.column(ids).to_pylist(), b.column(at).to_pylist())] \
                    if b.column(ids).null_count else b.column(ids).to_pylist()
                n = copies(model.rates(post), names)
                yield b.take(pa.array(np.repeat(np.arange(b.num_rows), n)))

    return docs.mapInArrow(run, docs.schema)
