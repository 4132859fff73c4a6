"""SimHash near-duplicates by anchor-point covering.

A fingerprint is 64 bits: bit i is set when more than half of the document's
word shingles (repeats included) have bit i set in their XXH64. Two documents
link when their fingerprints differ in at most ``max_bits`` bits.

Search: the 64 bits are cut into three blocks of 22, 21 and 21 bits. Two
fingerprints within ``max_bits`` differ by at most ``t = max_bits // 3`` bits in
one block. The anchors of a block are the 4,096 words of the perfect binary
Golay code of length 23 (the block is padded with zeros): covering radius 3, so
every block value has exactly one home anchor within 3 bits. A fingerprint is
replicated to each anchor within 3 + t bits (at most six for t = 1), so that it
meets every near fingerprint at that one's home anchor. Only distinct
fingerprints travel. Each anchor compares its home rows with its replicas in
blocks and keeps a spanning set of links, never all pairs; an anchor with many
rows is dealt over a grid of (home part, replica part) cells.

Defined results: a null text is empty; a document without words has fingerprint
zero and links like any other; fewer words than a shingle make one shingle of
all words; repeated rows and ties share a fingerprint, hence a component; a null
doc_id gets a fingerprint and its component's id (null if no member has an id).
An empty table gives an empty result. Only ``doc_id`` and ``text`` are read, so
other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import LOWER, NON_SPACE, slices, text_buffer, tune, words
from candlewick.llm.graph import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Most rows of either side in one comparison cell.
CELL_ROWS = 20_000

_SHINGLES_AT_ONCE = 1 << 16
_BLOCKS = ((0, 22), (22, 21), (43, 21))
_GOLAY = 0xAE3  # generator polynomial x^11+x^9+x^7+x^6+x^5+x+1
_RADIUS = 3


# ------------------------------------------------------------ fingerprints

def _joined(raw: bytes, starts, ends, i: int, j: int) -> bytes:
    return b" ".join(raw[starts[k]:ends[k]] for k in range(i, j))


def _shingle_hashes(raw, starts, ends, first, last) -> np.ndarray:
    """XXH64 of the words first[i]..last[i] (inclusive) joined by one space.

    Words that are one byte apart are hashed in place: separators are blanks in
    ``raw``; the others are joined first."""
    wide = np.concatenate(([0], np.cumsum(starts[1:] != ends[:-1] + 1)))
    tight = wide[first] == wide[last]
    h, x = np.empty(len(first), np.uint64), xxhash.xxh64_intdigest
    h[tight] = np.fromiter((x(raw[s:e], SEED) for s, e in
                            zip(starts[first[tight]].tolist(), ends[last[tight]].tolist())),
                           np.uint64, int(tight.sum()))
    for k in np.flatnonzero(~tight):
        h[k] = x(_joined(raw, starts, ends, int(first[k]), int(last[k]) + 1), SEED)
    return h


def fingerprints(buf, offs, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprint (uint64) of each document of a slice."""
    starts, ends, wo = words(buf, offs, NON_SPACE)
    norm = LOWER[buf]
    norm[~NON_SPACE[buf]] = 0x20
    raw = norm.tobytes()
    n_words = np.diff(wo)
    n_sh = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    so = np.concatenate(([0], np.cumsum(n_sh)))
    ones = np.zeros((len(n_words), 64), np.int64)
    for a in range(0, int(so[-1]), _SHINGLES_AT_ONCE):
        idx = np.arange(a, min(a + _SHINGLES_AT_ONCE, int(so[-1])))
        doc = np.searchsorted(so, idx, side="right") - 1
        first = wo[doc] + idx - so[doc]
        last = first + np.minimum(shingle, n_words[doc]) - 1
        h = _shingle_hashes(raw, starts, ends, first, last)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.flatnonzero(np.diff(doc, prepend=-1))
        ones[doc[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    on = (2 * ones > n_sh[:, None]).astype(np.uint8)
    return np.packbits(on, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per document."""
    tune(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        for b in batches:
            buf, offs = text_buffer(b.column(1))
            out = [fingerprints(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], shingle)
                   for i, j in slices(offs)]
            fp = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))],
                                             ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, fp long")


# ------------------------------------------------------------ covering code

def _remainder(words23: np.ndarray) -> np.ndarray:
    r = words23.astype(np.int64)
    for bit in range(22, 10, -1):
        r = np.where(r >> bit & 1, r ^ (_GOLAY << (bit - 11)), r)
    return r


def covering_tables(extra: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each syndrome: the error pattern to the home anchor, and what to xor
    the home anchor with to get every anchor within radius + ``extra`` bits."""
    leader = np.zeros(2048, np.int64)
    bits = [1 << i for i in range(23)]
    pats = [0] + bits + [a | b for i, a in enumerate(bits) for b in bits[:i]] + [
        a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    pats = np.array(pats, np.int64)
    leader[_remainder(pats)] = pats
    data = np.arange(4096, dtype=np.int64) << 11
    code = data | _remainder(data)
    near = [code[np.bitwise_count(leader[s] ^ code) <= _RADIUS + extra] for s in range(2048)]
    return leader, near


def anchor_rows(fp: np.ndarray, max_bits: int = MAX_BITS):
    """(cell, fp, home): every anchor that each fingerprint is sent to."""
    leader, near = covering_tables(max_bits // len(_BLOCKS))
    count = np.array([len(x) for x in near])
    start = np.concatenate(([0], np.cumsum(count)))[:-1]
    flat = np.concatenate(near)
    out = []
    for k, (shift, width) in enumerate(_BLOCKS):
        v = (fp >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1)
        s = _remainder(v)
        home = v ^ leader[s]
        rep = count[s]
        at = np.repeat(start[s], rep) + np.arange(rep.sum()) - np.repeat(np.cumsum(rep) - rep, rep)
        delta = flat[at]
        anchor = np.repeat(home, rep) ^ delta
        out.append((k * 4096 + (anchor >> 11), np.repeat(fp, rep), delta == 0))
    return tuple(np.concatenate(x) for x in zip(*out))


# ------------------------------------------------------------ comparison

def _find(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def cell_links(home: np.ndarray, all_fp: np.ndarray, max_bits: int):
    """Spanning links among the fingerprints of one cell (home against all)."""
    nodes, at = np.unique(np.concatenate((home, all_fp)), return_inverse=True)
    h, a = np.unique(at[:len(home)]), np.unique(at[len(home):])
    parent = np.arange(len(nodes))
    step = max(1, (1 << 20) // max(1, len(a)))
    for i in range(0, len(h), step):
        close = np.bitwise_count(nodes[h[i:i + step], None] ^ nodes[None, a]) <= max_bits
        alone = np.isin(h[i:i + step], a)  # a home row meets itself unless a grid cell parts them
        for r in np.flatnonzero(close.sum(axis=1) > alone):
            me, other = h[i + r], a[close[r]]
            top = _find(parent, me)
            for u in np.unique(parent[other]):
                root = _find(parent, u)
                if root != top:
                    top, root = min(top, root), max(top, root)
                    parent[root] = top
            parent[other] = top
    root = np.array([_find(parent, i) for i in np.flatnonzero(parent != np.arange(len(nodes)))],
                    np.int64)
    moved = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[moved], nodes[root]


def _cells(fps: DataFrame, max_bits: int, split: dict) -> DataFrame:
    """(cell, part, fp, home) rows; a large cell becomes a grid of parts."""
    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            cell, f, home = anchor_rows(fp, max_bits)
            part = np.zeros(len(cell), np.int64)
            big = np.isin(cell, list(split)) if split else np.zeros(len(cell), bool)
            rows = [(cell[~big], part[~big], f[~big], home[~big], ~home[~big] | True)]
            for c in np.unique(cell[big]):
                hp, rp = split[int(c)]
                at = cell == c
                salt = (f[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
                for i in range(hp):
                    for j in range(rp):
                        as_home = home[at] & (salt % np.uint64(hp) == i)
                        as_all = salt % np.uint64(rp) == j
                        use = as_home | as_all
                        rows.append((np.full(use.sum(), c), np.full(use.sum(), i * rp + j),
                                     f[at][use], as_home[use], as_all[use]))
            c, p, f, h, r = (np.concatenate(x) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int32)), pa.array(p.astype(np.int32)),
                 pa.array(f.view(np.int64)), pa.array(h), pa.array(r)],
                ["cell", "part", "fp", "home", "replica"])

    return fps.select("fp").mapInArrow(run, "cell int, part int, fp long, home boolean, replica boolean")


def links(fps: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within ``max_bits`` bits
    of one another into the same components."""
    # at most 3 x 4,096 rows come back, whatever the input
    sizes = (_cells(fps, max_bits, {}).groupBy("cell")
             .agg(F.sum(F.col("home").cast("long")).alias("h"), F.count("*").alias("r"))
             .where(F.col("r") > cell_rows).collect())
    split = {r["cell"]: (-(-r["h"] // cell_rows) or 1, -(-r["r"] // cell_rows)) for r in sizes}
    cells = _cells(fps, max_bits, split)
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        # rows come sorted by (cell, part): only the current cell is held
        key, held = None, []

        def done():
            f, h, r = (np.concatenate(x) for x in zip(*held))
            a, b = cell_links(f[h].view(np.uint64), f[r].view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            c = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy()
            f = batch.column(2).to_numpy()
            h = batch.column(3).to_numpy(zero_copy_only=False)
            r = batch.column(4).to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.diff(c, prepend=c[0] - 1)).tolist() + [len(c)]
            for i, j in zip(cut, cut[1:]):
                if c[i] != key and held:
                    yield done()
                    held = []
                key = c[i]
                held.append((f[i:j], h[i:j], r[i:j]))
        if held:
            yield done()

    return (cells.repartition(parts, "cell", "part").sortWithinPartitions("cell", "part")
            .mapInArrow(run, "a long, b long"))


def _components_of(fps: DataFrame, max_bits: int, cell_rows: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of (doc_id, fp): root is
    the component's own key, component_id its smallest doc_id, which components may share."""
    ids = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    comp = components(links(ids.select("fp"), max_bits, cell_rows))
    rooted = ids.join(comp.withColumnRenamed("node", "fp"), "fp", "left") \
                .select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable
    over links, the document itself included."""
    fps = fingerprint(docs, shingle).checkpoint()
    by_fp = _components_of(fps, max_bits, cell_rows).select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def _digest(text):
    return F.coalesce(F.sha2(text, 256), F.lit(""))


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
             cell_rows: int = CELL_ROWS) -> DataFrame:
    """The documents, one of each component: the one with the smallest doc_id, or of
    several texts under that id (or under none, if no document of the component has an
    id) the smallest text. Rows are told apart by (doc_id, text): a doc_id may stand in
    several components, and rows that repeat both are copies and leave one row."""
    key = F.struct("doc_id", _digest("text").alias("digest"))
    named = fingerprint(docs.select(key.alias("doc_id"), "text"), shingle) \
        .select("doc_id.doc_id", "doc_id.digest", "fp").checkpoint()
    by_fp = _components_of(named.select("doc_id", "fp"), max_bits, cell_rows)
    first = named.join(by_fp, "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
        .groupBy("root", "doc_id", "digest").agg(F.count("*").alias("n")).checkpoint()
    # the row travels as one struct, so no column of its own can clash with the keys
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").alias("row_id"), _digest("text").alias("row_text"))

    def same(keys):
        return keyed["row_id"].eqNullSafe(keys["doc_id"]) & (keyed["row_text"] == keys["digest"])

    keep = first
    several = keep.groupBy("root").agg(F.count("*").alias("texts")).where("texts > 1").checkpoint()
    if not several.isEmpty():
        tied = keep.join(several, "root", "left_semi")
        texts = keyed.join(tied, same(tied)).groupBy("root").agg(_digest(F.min("row.text")).alias("digest"))
        keep = keep.join(several, "root", "left_anti").unionByName(
            tied.join(texts, ["root", "digest"], "left_semi")).checkpoint()
    kept = keyed.join(keep, same(keep), "left_semi")
    if not keep.where("n > 1").isEmpty():
        kept = kept.dropDuplicates(["row_id", "row_text"])
    return kept.select("row.*")
