"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Best-fit decreasing looks only at lengths, and pieces of one length are
interchangeable. So the corpus is reduced to a histogram of piece lengths (at
most ``seq_len`` counts, whatever the corpus), the packing runs on whole groups
of equal bins with a segment tree over remaining capacities, and its outcome is
a plan that maps (length, rank among pieces of that length) to (sequence,
offset). The result is the packing that best-fit decreasing gives over all
pieces at once, not per partition. The plan is broadcast: an interval of bins is
at least halved in free space each time it is used, so the plan has at most
about ``4 * seq_len * log2(seq_len)`` rows. Ranks are counted per (length, hash
bucket), so a length that many pieces share is dealt over many tasks.

Defined results: a null text is empty; an empty text is the end id alone (one
piece of length 1); an added token of the vocabulary's JSON tokenizer, written out in a
text, is that token's id; repeated rows are packed once each; ties in length are
ordered by (doc_id, piece, digest); a null doc_id is kept; an empty table packs
into nothing. Only ``doc_id`` and ``text`` are read. Texts are tokenised whole:
a text longer than a sequence is cut into full sequences, its first piece taking
the remainder.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import slices, text_buffer, tune

SEQ_LEN = 2048
END_ID = 0
RANK_ROWS = 500_000
#: Chunks whose ids a Python worker keeps.
CACHE_CHUNKS = 300_000
VOCABULARY = "byte_bpe_50k.tiktoken"

# ------------------------------------------------------------ tokenising

_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _added_tokens(path: str) -> dict[str, int]:
    """Added tokens of a JSON tokenizer file (none if there is no such file)."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens of {path} are not matched literally")
    return {a["content"]: a["id"] for a in added}


class ChunkTokenizer:
    """Byte-level BPE ids of whole texts, with the ids of frequent chunks kept.

    A blank between two non-space characters always starts a new pre-token, so
    a text is cut there and each chunk (with its leading blank) has its own ids.
    The vocabulary file holds the same merges, as ranks, as the JSON tokenizer
    of that name; the tests compare the ids of both. ``encode_added`` also takes
    the added tokens of the JSON file, where ``encode`` knows plain text only.
    """

    def __init__(self, vocabulary: str = VOCABULARY, end_id: int = END_ID, keep: int = CACHE_CHUNKS):
        import public_tokenizers
        import tiktoken
        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encode = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                         mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._added = _added_tokens(os.path.splitext(path)[0] + ".json")
        longest = sorted(self._added, key=len, reverse=True)
        self._cut_added = re.compile("(" + "|".join(map(re.escape, longest)) + ")")
        self._width = np.zeros(max(ranks.values()) + 1, np.int64)
        self._width[list(ranks.values())] = [len(k) for k in ranks]
        self._keep, self._end = keep, end_id
        self._reset()

    def _reset(self):
        self._known: dict[str, int] = {}
        self._flat, self._len = np.array([self._end], np.int32), np.ones(1, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 1

    def _put(self, ids: np.ndarray, lens: np.ndarray) -> int:
        self._new.append((ids, lens))
        self._size += len(lens)
        return self._size - len(lens)

    def _one(self, text: str) -> int:
        """Index of a text with blanks at its edges, or the first of its document."""
        key = "\0" + text
        if key not in self._known:
            ids = np.array(self._encode(text), np.int32)
            self._known[key] = self._put(ids, np.array([len(ids)]))
        return self._known[key]

    def _many(self, chunks: list[str]) -> None:
        """Learn chunks (each taken with a leading blank) in one call; the byte
        widths of the ids tell where each chunk ends."""
        texts = [" " + c for c in chunks]
        ids = np.array(self._encode("".join(texts)), np.int32)
        ends = np.cumsum([len(t.encode()) for t in texts])
        at = np.searchsorted(np.cumsum(self._width[ids]), ends) + 1
        first = self._put(ids, np.diff(at, prepend=0))
        self._known.update(zip(chunks, range(first, first + len(chunks))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by the end id; offsets)."""
        if len(self._known) > self._keep:
            self._reset()
        heads, tails, inner = [], [], []
        count = np.zeros(len(texts), np.int64)       # inner chunks of each text
        for k, t in enumerate(texts):
            if not t:
                heads.append(None)
                tails.append(None)
                continue
            parts = _CUT.split(t) if _SPACES.search(t) else t.split(" ")
            head = 1
            while head < len(parts) and not parts[head - 1]:
                head += 1
            first, rest, tail = " ".join(parts[:head]), parts[head:], None
            if rest and not rest[-1]:                # a blank at the end
                rest.pop()
                if rest:
                    tail = rest.pop() + " "
                else:
                    first += " "
            elif rest and rest[-1][-1].isspace():
                tail = rest.pop()
            heads.append(first)
            tails.append(tail)
            inner += rest
            count[k] = len(rest)
        new = list(set(inner).difference(self._known))
        if new:
            self._many(new)
        # every text: head, inner chunks, tail, end id (0)
        has_head = np.array([h is not None for h in heads], bool)
        has_tail = np.array([t is not None for t in tails], bool)
        n_chunks = has_head + count + has_tail + 1
        co = np.concatenate(([0], np.cumsum(n_chunks)))
        idx = np.zeros(int(co[-1]), np.int64)
        body = np.ones(len(idx), bool)
        body[co[1:] - 1] = False
        body[co[1:][has_tail] - 2] = False
        body[co[:-1][has_head]] = False
        idx[body] = np.fromiter(map(self._known.__getitem__, inner), np.int64, len(inner))
        idx[co[:-1][has_head]] = [self._one(h) for h in heads if h is not None]
        idx[co[1:][has_tail] - 2] = [self._one(" " + t) for t in tails if t is not None]
        if self._new:
            self._flat = np.concatenate([self._flat] + [a for a, _ in self._new])
            self._len = np.concatenate([self._len] + [n for _, n in self._new])
            self._new = []
        start = np.cumsum(self._len) - self._len
        n = self._len[idx]
        to = np.concatenate(([0], np.cumsum(n)))
        ids = self._flat[np.repeat(start[idx] - to[:-1], n) + np.arange(int(to[-1]))]
        return ids, to[co]

    def encode_added(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with the ids of added tokens: a text is split at them, and
        the end id of every part but the last gives way to the token behind it."""
        if not any(a in t for t in texts if t for a in self._added):
            return self.encode(texts)
        parts = [self._cut_added.split(t) if t else [t] for t in texts]
        ids, to = self.encode([p for row in parts for p in row[::2]])
        last = np.cumsum([len(row) // 2 + 1 for row in parts])
        inner = np.ones(len(to) - 1, bool)
        inner[last - 1] = False
        ids[to[1:][inner] - 1] = [self._added[p] for row in parts for p in row[1::2]]
        return ids, to[np.concatenate(([0], last))]


_TOKENIZERS: dict = {}


def _tokenizer(vocabulary: str, end_id: int) -> ChunkTokenizer:
    key = vocabulary, end_id
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = ChunkTokenizer(vocabulary, end_id)
    return _TOKENIZERS[key]


def tokenised_pieces(docs: DataFrame, seq_len: int = SEQ_LEN, vocabulary: str = VOCABULARY,
                     end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    tune(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        tok = _tokenizer(vocabulary, end_id)
        for b in batches:
            col = b.column(1)
            _, offs = text_buffer(col)
            for i, j in slices(offs):
                ids, to = tok.encode_added(col.slice(i, j - i).to_pylist())
                ids = ids.astype("<u4")
                n = np.diff(to)
                first = np.where(n % seq_len == 0, np.minimum(n, seq_len), n % seq_len)
                pieces = 1 + (n - first) // seq_len
                doc = np.repeat(np.arange(j - i), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * seq_len)
                length = np.where(piece == 0, first[doc], seq_len)
                at = to[doc] + start
                raw = [ids[a:e].tobytes() for a, e in zip(at.tolist(), (at + length).tolist())]
                cols = [b.column(0).take(pa.array(i + doc)), pa.array(piece.astype(np.int32)),
                        pa.array(start), pa.array(length),
                        pa.array([zlib.crc32(r) for r in raw], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(raw, pa.binary())] * with_ids, names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids binary" * with_ids)


# ------------------------------------------------------------ best fit

class CapacityTree:
    """Segment tree over free capacities: how many open bins have each one, and
    the tightest capacity that still holds a given length, in log time."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, free: int, bins: int) -> None:
        i = free + self.size
        while i:
            self.count[i] += bins
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """Smallest capacity >= need with an open bin."""
        i = need + self.size
        while not self.count[i]:
            while i & 1:                      # right child: the next leaf range is above
                i >>= 1
                if i <= 1:
                    return None
            i += 1
            if i >= 2 * self.size or i <= 1:
                return None
        while i < self.size:
            i *= 2
            if not self.count[i]:
                i += 1
        return i - self.size


def best_fit_decreasing(counts: dict[int, int], capacity: int):
    """Plan rows (length, rank from, rank to, first bin, pieces per bin, offset)
    and the number of bins, for ``counts`` pieces of each length."""
    tree, spans, plan, bins = CapacityTree(capacity), {}, [], 0

    def put(free, lo, n):
        if n and free:
            spans.setdefault(free, []).append((lo, n))
            tree.add(free, n)

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        while left:
            free = tree.tightest(length)
            if free is None:                       # open as many new bins as the rest needs
                free, lo = capacity, bins
                n = -(-left // (capacity // length))
                bins += n
            else:
                lo, n = spans[free].pop()
                tree.add(free, -n)
            per = free // length
            use = min(n, -(-left // per))
            placed = min(left, use * per)
            plan.append((length, rank, rank + placed, lo, per, capacity - free))
            full = placed // per
            put(free - per * length, lo, full)
            if placed % per:
                put(free - placed % per * length, lo + full, 1)
            put(free, lo + use, n - use)
            rank += placed
            left -= placed
    return plan, bins


def ranked(pieces: DataFrame, rank_rows: int = RANK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Pieces with their rank among those of the same length; histogram by bucket. The
    bucket also takes in the input partition of the (checkpointed) pieces, so copies of
    one row, however many, are not ranked in one task; equal pieces may swap places."""
    buckets = max(1, -(-pieces.count() // rank_rows))
    pieces = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.spark_partition_id()), F.lit(buckets)).cast("int"))
    hist = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = hist.select("length", "bucket", (F.sum("n").over(
        W.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    place = F.row_number().over(
        W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    out = pieces.withColumn("place", place).join(before, ["length", "bucket"])
    return out.withColumn("rank", F.col("place") - 1 + F.col("before")) \
              .drop("place", "before", "bucket"), hist


def pack_pieces(pieces: DataFrame, seq_len: int = SEQ_LEN, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Adds sequence_id and offset to pieces with a length of 1 to ``seq_len``."""
    with_rank, hist = ranked(pieces, rank_rows)
    counts = {r["length"]: r["n"] for r in hist.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = best_fit_decreasing(counts, seq_len)
    rows = np.array(sorted(plan), np.int64).reshape(-1, 6)
    shared = pieces.sparkSession.sparkContext.broadcast(rows)
    names = with_rank.columns

    def run(batches):
        plan = shared.value
        key = plan[:, 0] << 44 | plan[:, 1]
        for b in batches:
            length = b.column(names.index("length")).to_numpy().astype(np.int64)
            rank = b.column(names.index("rank")).to_numpy()
            row = plan[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            j = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                b.columns + [pa.array(row[:, 3] + j // row[:, 4]),
                             pa.array(row[:, 5] + j % row[:, 4] * length)],
                names + ["sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_rank.schema.fields)
    return with_rank.mapInArrow(run, schema + ", sequence_id long, offset long").drop("rank")


def pack(docs: DataFrame, seq_len: int = SEQ_LEN, vocabulary: str = VOCABULARY,
         end_id: int = END_ID, with_ids: bool = False, rank_rows: int = RANK_ROWS) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    from candlewick.session import checkpoint_root
    checkpoint_root(docs.sparkSession)
    pieces = tokenised_pieces(docs, seq_len, vocabulary, end_id, with_ids).checkpoint()
    return pack_pieces(pieces, seq_len, rank_rows)
