"""Cross-tokenizer alignment against brute force, and edge cases."""

import bisect
import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import alignment, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{alignment.TOKENIZER_DIR}/{alignment.A_FILE}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZER_DIR}/{alignment.B_FILE}")
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(x): x for x in own} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in own)}
    names = {i: t for t, i in a.get_vocab().items()}

    def spell_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def encode(x):
        """[(id, bytes)] of both."""
        ia = a.encode(" " + x, add_special_tokens=False).ids
        return ([(i, bytes(char[c] for c in names[i])) for i in ia], [(i, spell_b(i)) for i in b.encode(x)])
    return encode


def brute(rows, encode):
    facts, held = [], []
    for i, x in rows:
        a, b = encode(x) if x else ([], [])
        want = (" " + x).encode() if x else b""
        if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
            a = b = []
        ends = lambda ts: list(np.cumsum([len(t) for _, t in ts])) if ts else []
        common = sorted(set(ends(a)) & set(ends(b)))
        groups, links = [], collections.Counter()
        member = lambda ts: [bisect.bisect_left(common, e) for e in ends(ts)]
        of_a, of_b = collections.defaultdict(list), collections.defaultdict(list)
        for ts, of in ((a, of_a), (b, of_b)):
            for (t, _), g in zip(ts, member(ts)):
                of[g].append(t)
        for g in range(len(common)):
            ga, gb = of_a[g], of_b[g]
            groups.append(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}")
            for s in ga:
                for t in gb:
                    links[s, t] += 1
        held.append(links)
        facts.append((i, len(a), len(b), len(groups), sum(links.values()),
                      hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    count = collections.Counter(p for links in held for p in links)
    top = {}
    for (s, _), n in count.items():
        top[s] = max(top.get(s, 0), n)
    return collections.Counter(
        (*f[:5], sum(k for p, k in links.items() if count[p] == top[p[0]]),
         sum(k * count[p] for p, k in links.items()), f[5]) for f, links in zip(facts, held))


def result(df):
    return collections.Counter(tuple(r) for r in df.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_registered_query(spark, coders):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert result(queries.op13_alignment(spark, SF)) == brute(rows, coders)


ODD = [(1, None), (2, ""), (3, " \n\t  "), (4, "one two"), (4, "one two"), (None, "one two three"), (5, "<|endoftext|> <s></s>"),
       (6, "▁ literal ▁▁"), (7, "ñé ü 漢字 😀 ‮\x00\x01"), (8, "<0x41> <unk>"), (9, "  lead   and trail  "),
       (10, "é ﬁ ½ ▁"), (11, "don't we'll I'M 123456 $$$ --- ..."), (12, "कि र्ल ไทย 한국어"),
       (13, "\r\n\r\n  　x"), (14, "aaaa" * 50 + " " * 40)]


@pytest.mark.parametrize("piece_pairs", [1, 7, 1 << 20])
def test_odd_texts(spark, coders, piece_pairs):
    """Few pairs a piece: every document in a piece of its own."""
    f = frame(spark, ODD).withColumn("row", F.lit(1)).withColumn("n_a", F.lit(2)).repartition(3)
    assert result(alignment.align_documents(f, piece_pairs=piece_pairs)) == brute(ODD, coders)


def test_empty_table(spark):
    assert alignment.align_documents(frame(spark, [])).count() == 0


def test_fast_ids_are_the_reference_ids(spark):
    tok = alignment.Tokenizers(alignment.TOKENIZER_DIR)
    texts = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    r = random.Random(1)
    texts += [x for _, x in ODD] + ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(1, 0xD800), 32, 10]))
                                            for _ in range(300)) for _ in range(50)]
    for x in texts:
        assert tok.encode_a(" " + (x or "")) == tok.encode_reference(" " + (x or ""))


def test_long_text(spark, coders):
    """Very long runs and texts; groups of many tokens are counted by id."""
    r = random.Random(2)
    rows = [(1, " " * 300_000), (2, "z" * 300_000), (3, "word " * 100_000),
            (4, "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(20_000)))]
    got = {t[0]: t for t in result(alignment.align_documents(frame(spark, rows)))}
    assert got[3][1:4] == (100_001, 100_001, 100_001) and got[3][4] == got[3][5] == 100_001
    for i, x in rows[:2]:
        a, b = coders(x)
        assert got[i][1:3] == (len(a), len(b))


def test_links_in_parts():
    """A document with more links than fit at once: the same pairs and counts."""
    r = np.random.default_rng(3)
    groups = [(int(r.integers(1, 30)), int(r.integers(1, 30))) for _ in range(200)] + [(300, 400), (1, 1)]
    size_a, size_b = (np.array(c) for c in zip(*groups))
    a, b = r.integers(0, 9, size_a.sum()), r.integers(0, 9, size_b.sum())
    last_a, last_b = np.cumsum(size_a) - 1, np.cumsum(size_b) - 1
    x = alignment.Aligned(a, np.array([0, len(a)]), b, np.array([0, len(b)]), last_a, last_b,
                          np.array([0, len(groups)]))
    whole = list(alignment.links(x, 100, room=1 << 30))
    assert len(whole) == 1
    for room in (1, 50, 3000):
        parts = list(alignment.links(x, 100, room=room))
        assert len(parts) > 1
        assert (np.concatenate([c for _, c, _ in parts]) == whole[0][1]).all()
        assert (np.concatenate([n for _, _, n in parts]) == whole[0][2]).all()


def test_gallop():
    r = np.random.default_rng(4)
    for _ in range(200):
        into = np.cumsum(r.integers(1, 9, r.integers(1, 80)))
        values = np.sort(r.integers(1, into[-1] + 1, r.integers(1, 60)))
        guess = r.integers(0, len(into), len(values))
        lo, hi = np.zeros(len(values), np.int64), np.full(len(values), len(into))
        assert (alignment.gallop(values, into, lo, hi, guess) == np.searchsorted(into, values)).all()
