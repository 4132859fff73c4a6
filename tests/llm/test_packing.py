import random
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candlewick.llm import packing
from candlewick.sources.tables import load
from tests.conftest import SF001
from tests.llm.common import AWKWARD, table, with_extras


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, pieces, ids_of, size):
    """Every piece is right and every sequence is full without gaps; the rows may repeat."""
    want = Counter()
    for doc_id, text in rows:
        ids = ids_of(text)
        first = len(ids) if len(ids) <= size else len(ids) % size or size
        cuts = [0] + list(range(first, len(ids) + 1, size))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == want
    seqs = {}
    for p in pieces:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for v in seqs.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= size
    return len(seqs)


def brute_bins(lengths, size):
    free = []
    for x in sorted(lengths, reverse=True):
        fits = [(f, i) for i, f in enumerate(free) if f >= x]
        if fits:
            free[min(fits)[1]] -= x
        else:
            free.append(size - x)
    return len(free), sorted(free)


def test_ids_equal_the_reference_tokenizer(reference):
    """The encoder of the text between added tokens (those: the next test)."""
    rnd = random.Random(1)
    texts = [t or "" for t in AWKWARD] + [" lead", "trail ", "a \n b", "a b \n", "<|endoftext x", "don't  we're"]
    texts += ["".join(rnd.choice(" \n\tab1.'s é\x1d") for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    tok = packing.ChunkTokenizer(keep=500)
    for i in range(0, len(texts), 97):
        ids, to = tok.encode(texts[i:i + 97])
        for t, a, b in zip(texts[i:i + 97], to, to[1:]):
            assert ids[a:b].tolist() == reference(t), t


def test_added_tokens_have_their_ids(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def ids_of(text):
        return t.encode(text or "", add_special_tokens=False).ids + [0]

    mark = "<|endoftext|>"
    assert ids_of(f"{mark} x") == [50256, 2124, 0]
    rnd = random.Random(3)
    bits = [mark, " ", "  ", "\n", "a", "don't", "<|", "|>", "endoftext", "é"]
    texts = [None, "", mark, mark * 2, f"{mark} x", f"a  {mark}", f"a {mark} b", mark[:-1], "plain text"]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(600)]
    rows = list(enumerate(texts))
    pieces = packing.pack(table(spark, rows), seq_len=16, rank_rows=97).collect()
    check(rows, pieces, ids_of, 16)


def test_plan_equals_best_fit_decreasing():
    rnd = random.Random(2)
    for size in (7, 16, 64):
        for _ in range(80):
            items = [rnd.randint(1, size) for _ in range(rnd.randint(0, 70))]
            plan, bins = packing.best_fit_decreasing(Counter(items), size)
            free = [size] * bins
            for length, lo, hi, first, per, offset in plan:
                for j in range(hi - lo):
                    assert size - free[first + j // per] == offset + j % per * length
                    free[first + j // per] -= length
            assert (bins, sorted(free)) == brute_bins(items, size)


def test_plan_stays_small():
    counts = dict(zip(range(1, 2049), np.random.default_rng(0).integers(1, 10**9, 2048).tolist()))
    plan, bins = packing.best_fit_decreasing(counts, 2048)
    assert len(plan) <= 4 * 2048 * 11
    assert bins >= sum(k * v for k, v in counts.items()) / 2048


def test_whole_table(spark, reference):
    docs = load(spark, SF001, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    pieces = packing.pack(docs).collect()
    assert check(rows, pieces, reference, 2048) == brute_bins([p.length for p in pieces], 2048)[0]


def test_awkward_rows_small_sequences_and_buckets(spark, reference):
    rows = list(enumerate(AWKWARD)) + [(None, "no id"), (None, None), (4, "a"), (4, "a")]
    rows += [(50, "<|endoftext|> x"), (51, "a<|endoftext|><|endoftext|>"), (52, "<|endoftext| >")]
    pieces = packing.pack(with_extras(table(spark, rows)), seq_len=16, rank_rows=7, with_ids=True).collect()
    assert check(rows, pieces, reference, 16) == brute_bins([p.length for p in pieces], 16)[0]
    assert all(len(p.ids) == 4 * p.length for p in pieces)


def test_empty_table(spark):
    assert packing.pack(table(spark, [])).count() == 0


def test_a_row_repeated_many_times_is_ranked_in_parts(spark):
    """Copies of one row fall into buckets of their own input partitions."""
    rows = [(1, "same words here")] * 300 + [(i, f"text {i}") for i in range(2, 60)]
    pieces = packing.tokenised_pieces(table(spark, rows).repartition(6), 64, packing.VOCABULARY, 0, False).checkpoint()
    _, hist = packing.ranked(pieces, 20)
    length = pieces.where("doc_id = 1").first().length
    of_copies = [r.n for r in hist.where(F.col("length") == length).collect()]
    assert sum(of_copies) >= 300 and max(of_copies) < 200
    out = packing.pack_pieces(pieces, 64, 20).collect()
    assert len(out) == len(rows) and len({(p.sequence_id, p.offset) for p in out}) == len(rows)
