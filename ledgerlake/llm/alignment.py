"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same text.

Tokenizer A is a byte-level BPE (a ``tokenizers`` JSON file), B a sentencepiece
model that puts a space before every text; so A reads space + text, and both
cover the same bytes. Byte offsets where tokens of both end cut the two
sequences into groups; every A token of a group is linked with every B token.
A pair of ids counts the documents (rows) that hold it linked; a link is best
if no pair of its A id counts more.

How: the shorter list of token ends drives a galloping search into the longer:
from its own share of the longer list each end steps 1, 2, 4, ... places until
it is bracketed, then a binary search ends it; all ends of a chunk of texts go
in step. Differences of the ranks of common ends are the groups' sizes. Tasks
gather their documents' distinct pairs into pieces of about ``piece_pairs``
and keep each piece's distinct id pairs once. Only those travel: they are
summed up over the corpus, joined with the sums, and go back to their piece.
A pair that every document holds is one row a piece, however many documents
there are; a document with more links than a piece spreads over several.

Defined results: texts that are null or empty, or whose joined A or B bytes
differ from space + text, have no tokens: zeros and an empty digest. Special
tokens' strings inside texts are plain text. Rows that repeat (or lack) an id
are documents of their own; an empty table gives an empty result; columns
other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import small_batches, stash

TOKENIZER_DIR = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
# The splitting pattern of byte-level BPE vocabularies of this kind (fixed value).
A_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

CODE_BITS = 40  # a pair of ids is one number below 2^40

DOC_FIELDS = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs")
PIECE = ("piece bigint, codes array<bigint>, docs array<int>, row array<bigint>, doc_id array<bigint>, "
         "n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
         "groups_sha256 array<string>, n_pairs array<bigint>, pairs binary")
RESULT = ("row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
          "groups_sha256 string, n_best bigint, count_sum bigint")


# --- tokenizers -------------------------------------------------------------

def _byte_chars() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 characters
    are themselves, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _pieces_model(folder: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{B_FILE}")


@dataclass
class Vocabulary:
    """Bytes of every token id, and its decimal text, as flat arrays."""
    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray
    digits: np.ndarray
    digit_start: np.ndarray
    digit_size: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        def pack(parts):
            size = np.array([len(p) for p in parts], np.int64)
            return np.frombuffer(b"".join(parts) or b"\0", np.uint8), np.cumsum(size) - size, size
        return cls(*pack(tokens), *pack([b"%d," % i for i in range(len(tokens))]))


class Tokenizers:
    """Both tokenizers of a folder; made once a task."""

    def __init__(self, folder: str):
        import json

        import tiktoken

        self.folder, self.reference = folder, None
        # A: the file's own vocabulary; ids are merge ranks
        with open(f"{folder}/{A_FILE}", encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        chars = _byte_chars()
        a = {i: bytes(chars[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("a", pat_str=A_PATTERN, special_tokens={},
                                      mergeable_ranks={b: i for i, b in a.items()})
        self.a = Vocabulary.of([a.get(i, b"") for i in range(max([*a, *special.values()]) + 1)])
        # B: pieces; U+2581 stands for a space, byte pieces for their byte
        self.sp = _pieces_model(folder)
        self.n_b = self.sp.get_piece_size()
        self.b = Vocabulary.of([
            bytes([int(self.sp.id_to_piece(i)[3:5], 16)]) if self.sp.is_byte(i)
            else self.sp.id_to_piece(i).replace("\u2581", " ").encode() for i in range(self.n_b)])

    def encode_a(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # its pattern engine gives up on some very long runs by a panic
            return self.encode_reference(text)

    def encode_reference(self, text: str) -> list[int]:
        """The same ids from the library the file is made for; slower."""
        if self.reference is None:
            from tokenizers import Tokenizer

            self.reference = Tokenizer.from_file(f"{self.folder}/{A_FILE}")
            self.reference.encode_special_tokens = True
        return self.reference.encode(text, add_special_tokens=False).ids

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1)


# --- alignment of a chunk of texts ------------------------------------------

def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[0], ..., start[0] + size[0] - 1, start[1], ..."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - size), size) + np.arange(total)


def gallop(values: np.ndarray, into: np.ndarray, lo: np.ndarray, hi: np.ndarray,
           guess: np.ndarray) -> np.ndarray:
    """For each value the first index in [lo, hi) whose entry is not below it.

    ``into`` ascends inside every [lo, hi) and its last entry there is not
    below the value. From ``guess`` steps double until the answer is
    bracketed, then the bracket is halved.
    """
    below = into[guess] < values
    # into[left] < value (or left = lo - 1), into[right] >= value
    left = np.where(below, guess, lo - 1)
    right = np.where(below, hi - 1, guess)
    step = 1
    at, live, up = guess.copy(), np.arange(len(values)), below
    while len(live):
        probe = np.where(up, np.minimum(at[live] + step, right[live]), np.maximum(at[live] - step, left[live]))
        inside = np.where(up, probe < right[live], probe > left[live])
        small = np.zeros(len(live), bool)
        small[inside] = into[probe[inside]] < values[live[inside]]
        grows = inside & small
        left[live[grows]] = probe[grows]
        falls = inside & ~small
        right[live[falls]] = probe[falls]
        at[live] = probe
        on = np.where(up, grows, falls)
        live, up = live[on], up[on]
        step *= 2
    live = np.flatnonzero(right - left > 1)
    while len(live):
        mid = (left[live] + right[live]) >> 1
        small = into[mid] < values[live]
        left[live[small]] = mid[small]
        right[live[~small]] = mid[~small]
        live = live[right[live] - left[live] > 1]
    return right


def common_ends(ends_a: np.ndarray, at_a: np.ndarray, ends_b: np.ndarray,
                at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ends that both lists hold, document by document
    (document d has ends_a[at_a[d]:at_a[d + 1]]; none is empty and both lists
    of a document end alike)."""
    na, nb = np.diff(at_a), np.diff(at_b)
    hit_a, hit_b = [], []
    for a_drives in (True, False):
        docs = np.flatnonzero(na <= nb if a_drives else na > nb)
        (mine, at, n), (other, to, m) = ((ends_a, at_a, na), (ends_b, at_b, nb)) if a_drives else (
            (ends_b, at_b, nb), (ends_a, at_a, na))
        drive = _spread(at[docs], n[docs])
        lo, hi = np.repeat(to[docs], n[docs]), np.repeat(to[docs] + m[docs], n[docs])
        nth = drive - np.repeat(at[docs], n[docs])
        guess = lo + nth * np.repeat(m[docs], n[docs]) // np.repeat(n[docs], n[docs])
        found = gallop(mine[drive], other, lo, hi, guess)
        same = other[found] == mine[drive]
        one, two = drive[same], found[same]
        hit_a.append(one if a_drives else two)
        hit_b.append(two if a_drives else one)
    hit_a, hit_b = np.concatenate(hit_a), np.concatenate(hit_b)
    order = np.argsort(hit_a, kind="stable")
    return hit_a[order], hit_b[order]


@dataclass
class Aligned:
    """A chunk of documents that have tokens: ids of all of them one after the
    other, where each document's begin, and the last token of every group."""
    a: np.ndarray
    at_a: np.ndarray
    b: np.ndarray
    at_b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray
    at_g: np.ndarray

    @property
    def size_a(self):
        return np.diff(self.last_a, prepend=-1)

    @property
    def size_b(self):
        return np.diff(self.last_b, prepend=-1)


def _joined(ids: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    return vocabulary.flat[_spread(vocabulary.start[ids], vocabulary.size[ids])]


def _covers(ids: np.ndarray, at: np.ndarray, voc: Vocabulary, data: np.ndarray, at_d: np.ndarray) -> np.ndarray:
    """Per document: do its tokens' bytes spell data[at_d[d]:at_d[d + 1]]?"""
    size = np.r_[0, np.cumsum(voc.size[ids])][at]
    fits = np.diff(size) == np.diff(at_d)
    made = _joined(ids, voc)
    for d in np.flatnonzero(fits):
        fits[d] = np.array_equal(made[size[d]:size[d + 1]], data[at_d[d]:at_d[d + 1]])
    return fits


def align(texts: list[str], tok: Tokenizers) -> tuple[np.ndarray, Aligned | None]:
    """(which texts have tokens, their alignment); no text is empty."""
    full = [" " + t for t in texts]
    a = [np.array(tok.encode_a(t), np.int64) for t in full]
    b = [np.array(x, np.int64) for x in tok.encode_b(texts)]
    raw = [t.encode() for t in full]
    offsets = lambda parts: np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int64)
    data, at_d = np.frombuffer(b"".join(raw), np.uint8), offsets(raw)
    ok = (_covers(np.concatenate(a), offsets(a), tok.a, data, at_d)
          & _covers(np.concatenate(b), offsets(b), tok.b, data, at_d))
    a = [x for x, k in zip(a, ok) if k]
    b = [x for x, k in zip(b, ok) if k]
    if not a:
        return ok, None
    at_a, at_b = offsets(a), offsets(b)
    a, b = np.concatenate(a), np.concatenate(b)
    ends = []
    for ids, at, voc in ((a, at_a, tok.a), (b, at_b, tok.b)):
        e = np.cumsum(voc.size[ids])
        ends.append(e - np.repeat(np.r_[0, e][at[:-1]], np.diff(at)))
    last_a, last_b = common_ends(ends[0], at_a, ends[1], at_b)
    return ok, Aligned(a, at_a, b, at_b, last_a, last_b, np.searchsorted(last_a, at_a))


def digests(x: Aligned, tok: Tokenizers) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per document."""
    size_a, size_b = x.size_a, x.size_b
    n = len(x.a) + len(x.b)
    # a token's place in the written order: groups in order, A before B
    place_a = np.arange(len(x.a)) + np.repeat(x.last_b - size_b + 1, size_a)
    place_b = np.arange(len(x.b)) + np.repeat(x.last_a + 1, size_b)
    start, size = np.empty(n, np.int64), np.empty(n, np.int64)
    shift = len(tok.a.digits)
    start[place_a], size[place_a] = tok.a.digit_start[x.a], tok.a.digit_size[x.a]
    start[place_b], size[place_b] = tok.b.digit_start[x.b] + shift, tok.b.digit_size[x.b]
    out = np.concatenate([tok.a.digits, tok.b.digits])[_spread(start, size)]
    ends = np.cumsum(size)
    out[ends[place_a[x.last_a]] - 1] = ord("|")
    out[ends[place_b[x.last_b]] - 1] = ord(";")
    cut = np.r_[0, ends][x.at_a + x.at_b].tolist()
    return [hashlib.sha256(out[i:j - 1].tobytes()).hexdigest() for i, j in zip(cut, cut[1:])]


def _sum_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def links(x: Aligned, n_b: int, room: int = 1 << 22):
    """Yields (document, pair codes, links of each): every distinct pair of a
    document once, its codes a * n_b + b ascending over all that is yielded
    for a document. A document with more than ``room`` links comes in parts."""
    size_a, size_b = x.size_a, x.size_b
    many = size_a * size_b
    total = np.r_[0, np.cumsum(many)][x.at_g]
    d = 0
    while d < len(x.at_g) - 1:
        e = max(d + 1, int(np.searchsorted(total, total[d] + room, side="right")) - 1)
        g0, g1 = x.at_g[d], x.at_g[e]
        if total[e] - total[d] > room:
            yield from ((d, *part) for part in _long_links(x, g0, g1, n_b, room))
            d = e
            continue
        group = np.repeat(np.arange(g0, g1), many[g0:g1])
        nth = _spread(np.zeros(g1 - g0, np.int64), many[g0:g1])
        a = x.a[(x.last_a - size_a + 1)[group] + nth // size_b[group]]
        b = x.b[(x.last_b - size_b + 1)[group] + nth % size_b[group]]
        doc = np.searchsorted(x.at_g[d:e + 1], group, side="right") - 1
        keys, n = np.unique((doc << CODE_BITS) | (a * n_b + b), return_counts=True)
        at = np.searchsorted(keys >> CODE_BITS, np.arange(e - d + 1))
        codes = keys & ((1 << CODE_BITS) - 1)
        for i in range(e - d):
            yield d + i, codes[at[i]:at[i + 1]], n[at[i]:at[i + 1]]
        d = e


def _long_links(x: Aligned, g0: int, g1: int, n_b: int, room: int):
    """One document's pairs in parts: ids that repeat inside a group are
    counted first, then A ids go in order, so no pair is in two parts."""
    sa, sb = x.size_a[g0:g1], x.size_b[g0:g1]
    a0, b0 = x.last_a[g0] - sa[0] + 1, x.last_b[g0] - sb[0] + 1
    group = np.arange(g1 - g0)
    ka, ca = np.unique((x.a[a0:x.last_a[g1 - 1] + 1] << 32) | np.repeat(group, sa), return_counts=True)
    kb, cb = np.unique((np.repeat(group, sb) << 32) | x.b[b0:x.last_b[g1 - 1] + 1], return_counts=True)
    at_b = np.searchsorted(kb >> 32, np.arange(g1 - g0 + 1))
    grp = ka & 0xFFFFFFFF
    per = np.diff(at_b)[grp]
    upto = np.r_[0, np.cumsum(per)]
    held, i = (np.zeros(0, np.int64), np.zeros(0, np.int64)), 0
    while i < len(ka):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + room, side="right")) - 1)
        to = _spread(at_b[grp[i:j]], per[i:j])
        codes = np.repeat((ka[i:j] >> 32) * n_b, per[i:j]) + (kb[to] & 0xFFFFFFFF)
        codes, n = _sum_up(np.r_[held[0], codes], np.r_[held[1], np.repeat(ca[i:j], per[i:j]) * cb[to]])
        # the last A id may go on
        done = int(np.searchsorted(codes, (ka[j - 1] >> 32) * n_b)) if j < len(ka) else len(codes)
        if done:
            yield codes[:done], n[:done]
        held, i = (codes[done:], n[done:]), j


# --- pieces -----------------------------------------------------------------

def _pack(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(distinct codes, documents of each, the pairs as places among the
    distinct codes and link counts, compressed)."""
    distinct, place = np.unique(codes, return_inverse=True)
    docs = np.bincount(place, minlength=len(distinct))
    body = np.concatenate([np.diff(place, prepend=0).astype(np.int32), n.astype(np.int32)])
    return distinct, docs, pa.compress(body.tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes, pairs: int) -> tuple[np.ndarray, np.ndarray]:
    body = np.frombuffer(pa.decompress(blob, 8 * pairs, codec="zstd", asbytes=True), np.int32)
    return np.cumsum(body[:pairs], dtype=np.int64), body[pairs:].astype(np.int64)


class _Piece:
    """Documents' facts and pairs gathered for one row of PIECE."""

    def __init__(self):
        self.docs, self.codes, self.marks, self.pairs = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

    def add(self, facts: tuple, codes=(), n=()):
        self.docs.append((*facts, len(codes)))
        if len(codes):
            self.codes.append(codes)
            self.marks.append(n)
            self.pairs += len(codes)

    def batch(self, number: int) -> pa.RecordBatch:
        distinct, held, blob = _pack(np.concatenate(self.codes), np.concatenate(self.marks))
        row = {"piece": number, "codes": distinct, "docs": held.astype(np.int32), "pairs": blob}
        row |= {f: list(c) for f, c in zip(DOC_FIELDS, zip(*self.docs))}
        return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _PIECE_SCHEMA],
                                          schema=_PIECE_SCHEMA)


def _facts_and_pairs(ids: list, texts: list, first_row: int, tok: Tokenizers):
    """Yields (facts, codes, links of each) of a chunk of documents; facts are
    None after the first part of a document that comes in parts."""
    live = [i for i, t in enumerate(texts) if t]
    ok, x = align([texts[i] for i in live], tok) if live else ((), None)
    with_tokens = [i for i, k in zip(live, ok) if k]
    for i in sorted(set(range(len(ids))) - set(with_tokens)):
        yield (first_row + i, ids[i], 0, 0, 0, 0, ""), (), ()
    if x is None:
        return
    n_a, n_b, n_groups = (np.diff(at).tolist() for at in (x.at_a, x.at_b, x.at_g))
    n_links = np.diff(np.r_[0, np.cumsum(x.size_a * x.size_b)][x.at_g]).tolist()
    sums, last = digests(x, tok), -1
    for d, codes, n in links(x, tok.n_b):
        own = (n_a[d], n_b[d], n_groups[d], n_links[d], sums[d]) if d != last else (None,) * 5
        yield (first_row + with_tokens[d], ids[with_tokens[d]], *own), codes, n
        last = d


def _pieces(batches, folder: str, piece_pairs: int, chunk_chars: int = 1 << 20):
    """Arrow batches of (id, text) to rows of PIECE."""
    from pyspark import TaskContext

    tok = Tokenizers(folder)
    row = number = TaskContext.get().partitionId() << 36
    piece = _Piece()
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        i = 0
        while i < len(ids):
            part, size = [], 0
            while i + len(part) < len(ids) and (not part or size < chunk_chars):
                part.append(texts[i + len(part)].as_py())
                size += len(part[-1] or "")
            for facts, codes, n in _facts_and_pairs(ids[i:i + len(part)], part, row, tok):
                piece.add(facts, codes, n)
                if piece.pairs >= piece_pairs or len(piece.docs) >= piece_pairs:
                    yield piece.batch(number)
                    piece, number = _Piece(), number + 1
            i += len(part)
            row += len(part)
    if piece.docs:
        yield piece.batch(number)


_PIECE_SCHEMA = pa.schema([
    ("piece", pa.int64()), ("codes", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())),
    ("row", pa.list_(pa.int64())), ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())),
    ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())),
    ("groups_sha256", pa.list_(pa.string())), ("n_pairs", pa.list_(pa.int64())), ("pairs", pa.binary())])
_RESULT_SCHEMA = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()),
    ("n_best", pa.int64()), ("count_sum", pa.int64())])


def _score(left: pa.Table, right: pa.Table) -> pa.Table:
    """A piece (one row) with the corpus-wide counts of its distinct pairs."""
    row = {f: left.column(f).combine_chunks() for f in left.column_names}
    docs = {f: row[f].flatten() for f in DOC_FIELDS}
    sizes = docs["n_pairs"].to_numpy()
    place, n = _unpack(row["pairs"][0].as_py(), int(sizes.sum()))
    order = np.argsort(right.column("code").to_numpy())
    held = right.column("n").to_numpy()[order]
    best = right.column("best").to_numpy()[order]
    at = np.r_[0, np.cumsum(sizes)]
    per_doc = lambda v: np.diff(np.r_[0, np.cumsum(v, dtype=np.int64)][at])
    out = {**docs, "n_best": per_doc(best[place] * n), "count_sum": per_doc(held[place] * n)}
    columns = [v.cast(f.type) if isinstance(v := out[f.name], pa.Array) else pa.array(v, f.type)
               for f in _RESULT_SCHEMA]
    return pa.table(columns, schema=_RESULT_SCHEMA)


def pair_counts(pieces: DataFrame, n_b: int) -> DataFrame:
    """(code, n, best): documents that hold each pair linked, and whether no
    pair of the same A id counts more."""
    held = pieces.select(F.inline(F.arrays_zip("codes", "docs")))
    counts = stash(held.groupBy(F.col("codes").alias("code")).agg(F.sum("docs").alias("n")), "align-counts")
    a = F.floor(F.col("code") / n_b).cast("bigint")
    # one row an id of A: bounded by its vocabulary
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))
    return counts.join(F.broadcast(top), a == F.col("a")).select(
        "code", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    folder: str = TOKENIZER_DIR, piece_pairs: int = 1 << 20) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    small_batches(docs.sparkSession)
    thin = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))
    pieces = stash(thin.mapInArrow(partial(_pieces, folder=folder, piece_pairs=piece_pairs), PIECE),
                   "align-pieces")
    n_b = _pieces_model(folder).get_piece_size()
    counts = pair_counts(pieces, n_b)
    wanted = pieces.select(F.col("piece").alias("of"), F.explode("codes").alias("c"))
    found = wanted.join(counts, F.col("c") == F.col("code")).select("of", "code", "n", "best")
    left = pieces.select("piece", *DOC_FIELDS, "pairs")
    scored = left.groupBy("piece").cogroup(found.groupBy("of")).applyInArrow(_score, RESULT)
    # a document may be spread over pieces; the first states its facts
    first = [F.max(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
    return scored.groupBy("row", "doc_id").agg(
        *first, F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
