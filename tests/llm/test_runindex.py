"""The run-length index against brute force over all windows."""

import hashlib
import random

import numpy as np
import zstandard

from candlewick.llm import runindex
from tests.llm.common import AWKWARD, texts, with_extras

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    """(doc_id, bytes, removed, runs, hash) of each row, by a table of all windows."""
    data = [(d, (t or "").encode()) for d, t in rows]
    least, here = {}, []
    key = lambda d: (d is not None, d or 0)
    for d, raw in data:
        first = {}
        for i in range(len(raw) - window + 1):
            w = raw[i:i + window]
            first.setdefault(w, i)
            if w not in least or key(d) < least[w]:
                least[w] = key(d)
        here.append(first)
    out = []
    for (d, raw), first in zip(data, here):
        gone = [False] * len(raw)
        for i in range(len(raw) - window + 1):
            w = raw[i:i + window]
            if least[w] < key(d) or first[w] < i:
                gone[i:i + window] = [True] * window
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"],
                    hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()), key=str)


def corpus(seed=1):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcdé \x00日") for _ in range(rnd.randint(0, 260))) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(60):                                    # copies, cuts and joins with edits
        t = rnd.choice(base)
        cut = rnd.randint(0, len(t))
        u = rnd.choice(base)
        t = t[cut:] + u[:rnd.randint(0, len(u))]
        if t and rnd.random() < 0.5:
            k = rnd.randrange(len(t))
            t = t[:k] + rnd.choice(["", "x", "yy"]) + t[k + 1:]
        rows.append((rnd.randint(-5, 200), t))
    rows += [(300 + i, t) for i, t in enumerate(AWKWARD)] + [(None, base[3]), (None, base[4] + base[4])]
    rows += [(400, base[5])] * 3 + [(400, base[6]), (401, "a" * 700), (402, "ab" * 400)]
    rows += [(500 + i, t) for i, t in enumerate(texts(40, "ab", 300, seed=4))]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, 100)
    assert sum(r[2] for r in want) > 5000
    assert rows_of(runindex.remove_repeats(df)) == want
    assert rows_of(runindex.remove_repeats(with_extras(df).repartition(7))) == want
    # small parts, and anchors that are hot and cut into single windows
    assert rows_of(runindex.remove_repeats(df.repartition(3), hot_rows=3, part_bytes=2000)) == want


def test_other_windows(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, SCHEMA)
    for window in (17, 40):
        assert rows_of(runindex.remove_repeats(df, window=window)) == brute(rows, window)


def test_empty_table(spark):
    assert runindex.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
    assert rows_of(runindex.remove_repeats(spark.createDataFrame([(1, None)], SCHEMA))) == brute([(1, None)], 100)


def test_one_group_with_many_unlike_segments(spark):
    """A line shared by all documents amid unlike contexts, copies of it, and edits."""
    rnd = random.Random(9)
    line = "this very common line of a licence stands in all documents of the whole table, word for word, always"
    rows = [(i, f"{rnd.random()} {line} {rnd.random()}" + (line[:rnd.randint(0, 100)] if i % 3 else "")) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, 100)
    assert rows_of(runindex.remove_repeats(df.repartition(4))) == want
    assert rows_of(runindex.remove_repeats(df.repartition(4), hot_rows=20)) == want


def test_matching_statistics_of_the_index():
    """Length and source of each position's match, against the sorted suffixes."""
    rnd = random.Random(3)
    parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 60))) for _ in range(12)] + [b"ababab" * 8] * 3
    t = np.frombuffer(b"".join(parts), np.uint8)
    to = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    index = runindex.RunIndex(t, to)
    suffixes = sorted((p[i:], int(a) + i) for p, a in zip(parts, to) for i in range(len(p)))
    length, source = index.statistics(np.arange(len(t)))
    assert index.runs < len(t)
    for (x, i), (y, j) in zip(suffixes, suffixes[1:]):
        same = 0
        while same < min(len(x), len(y)) and x[same] == y[same]:
            same += 1
        assert (length[j], source[j]) == (same, i)


def test_only_segments_that_may_share_a_window_are_indexed(monkeypatch):
    """Unlike texts around the same few words share anchors, but no window."""
    rnd = random.Random(5)
    some = lambda: "".join(rnd.choice("abcdefghij ") for _ in range(90))
    least = lambda x: int(runindex._gram_hash(*np.frombuffer(x.encode(), "<u8").reshape(-1, 1))[0])
    phrase = min((some()[:16] for _ in range(3000)), key=least)   # the anchor of most windows around it
    rows = [(i, some() + phrase + some()) for i in range(300)]
    rows += [(1000 + i, "z" + t[15:150 + i] + "z") for i, t in rows[:5]]
    raw = [t.encode() for _, t in rows]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in raw])))
    ids, indexed = np.array([d for d, _ in rows]), []

    class Counted(runindex.RunIndex):
        def __init__(self, t, to):
            indexed.append(len(to) - 1)
            super().__init__(t, to)

    monkeypatch.setattr(runindex, "RunIndex", Counted)
    none = np.zeros(0, np.uint64)
    blobs, settled = runindex._blobs(buf, offs, ids, ids, none, 1, 100)
    gone = {d: set() for d in ids.tolist()}
    for found in [settled, *runindex._part_spans([b for _, b in blobs], 100)]:
        for d, _, a, z in zip(*(x.tolist() for x in found)):
            gone[d] |= set(range(a, z))
    assert sorted((d, len(x)) for d, x in gone.items()) == sorted((r[0], r[2]) for r in brute(rows, 100))
    assert sum(map(len, gone.values())) > 500
    assert 10 <= sum(indexed) < 60
    g = runindex.anchors(buf, offs, 100)[0]
    assert runindex._repeated(g).sum() > 250       # so many share an anchor


def test_neighbourhoods_keep_all_equal_windows():
    """Whatever windows two segments share, both stay; any window, alone or not."""
    rnd = random.Random(8)
    for window in (17, 20, 100):
        for _ in range(60):
            anchor = bytes(rnd.choices(b"ab", k=runindex.GRAM))
            around = [bytes(rnd.choices(b"xy", k=window)) for _ in range(2)]
            lead, count, segments = [], [], []
            for _ in range(2):                     # an own piece of the same text, then noise
                reach = rnd.randint(0, window - runindex.GRAM), rnd.randint(0, window - runindex.GRAM)
                few = max(0, window - runindex.GRAM - sum(reach))
                left, right = reach[0] + few, reach[1]
                segments.append((around[0][window - left:] if left else b"") + anchor + around[1][:right])
                lead.append(left)
                count.append(len(segments[-1]) - window + 1)
            share = min(lead) + min(n + window - 1 - p - runindex.GRAM for n, p in zip(count, lead)) >= window - runindex.GRAM
            text = np.frombuffer(b"".join(segments), np.uint8)
            to = np.concatenate(([0], np.cumsum([len(x) for x in segments])[:-1]))
            kept = runindex._may_share(text, to, np.array(lead), np.array(count), np.arange(2), window)
            assert len(kept) == 2 or not share


def test_segments_travel_unchanged():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 40):
        didx = np.concatenate(([0], np.cumsum(rnd.integers(0, 2, n))))
        docs, ths = (rnd.integers(-1 << 63, (1 << 63) - 1, didx[-1] + 1) for _ in range(2))
        first, lead, count = rnd.integers(0, 1 << 31, n + 1), rnd.integers(0, 256, n + 1), rnd.integers(1, 86, n + 1)
        text = rnd.integers(0, 256, 500).astype(np.uint8)
        got = runindex._unpack(runindex._pack(docs, ths, didx, first, lead, count, text))
        for x, y in zip(got, (docs[didx], ths[didx], first, lead, count, text)):
            assert x.dtype == y.dtype and (x == y).all()


def test_spans_find_their_rows_by_id_and_hash(monkeypatch):
    """Also where the keys of different rows are equal; an id may stand for several texts."""
    spans = np.array([[1, 7, 0, 5], [1, 8, 2, 3], [2, 7, 4, 9], [1, 7, 6, 8], [-5, 0, 1, 2]]).T
    blob = zstandard.ZstdCompressor().compress(spans.astype("<i8").tobytes())
    doc, th = np.array([2, 1, 1, 3, 1, -5, 1]), np.array([7, 8, 9, 7, 7, 0, 7])
    want = [(0, 4, 9), (1, 2, 3), (4, 0, 5), (4, 6, 8), (5, 1, 2), (6, 0, 5), (6, 6, 8)]
    keys = runindex._row_keys
    for few in (keys, lambda d, t: keys(d, t) % np.uint64(2), lambda d, t: keys(d, t) * np.uint64(0)):
        monkeypatch.setattr(runindex, "_row_keys", few)
        assert sorted(zip(*(x.tolist() for x in runindex._Spans([blob]).of(doc, th)))) == want
        assert not len(runindex._Spans([]).of(doc, th)[0])


def test_ids_keep_their_type(spark):
    rows = [(i, f"{i % 3} " * 90) for i in range(12)] + [(None, "1 " * 80), (None, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    out = runindex.remove_repeats(df)
    assert dict(out.dtypes)["doc_id"] == "int"
    assert rows_of(out) == brute(rows, 100)


def test_large_groups_are_lengthened_in_their_part(monkeypatch):
    """Groups of any size give the same bytes, and no large text is indexed at once."""
    rnd = random.Random(12)
    line = "this passage stands in all documents of the table amid unlike contexts, word for word, and is quite long indeed"
    rows = [(i // 2, f"{rnd.random()}{line[rnd.randint(0, 9):]}{rnd.random()}{rnd.choice(['', line])}") for i in range(300)]
    rows += [(1000, rows[7][1]), (None, rows[8][1]), (None, rows[9][1])] + [(1001, rows[10][1])] * 2
    rows += [(d if d is None else 2000 + d, t) for d, t in corpus(3) if t]
    want = sorted(((r[0], r[1], r[2]) for r in brute(rows, 100)), key=str)
    raw = [t.encode() for _, t in rows]
    buf, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in raw])))
    ids = np.array([runindex._LOWEST if d is None else d for d, _ in rows])
    ths = np.array([int.from_bytes(hashlib.sha256(t).digest()[:7]) for t in raw])
    longest = []

    class Counted(runindex.RunIndex):
        def __init__(self, t, to):
            longest.append(len(t))
            super().__init__(t, to)

    monkeypatch.setattr(runindex, "RunIndex", Counted)
    for limit in (1 << 30, 3000, 0):
        for narrower in (runindex.NARROWER, (30, 7, 1), (1,)):
            monkeypatch.setattr(runindex, "GROUP_BYTES", limit)
            monkeypatch.setattr(runindex, "NARROWER", narrower)
            monkeypatch.setattr(runindex, "INDEX_BYTES", 2000)
            longest.clear()
            gone = {}
            for i in range(0, len(rows), 100):     # blobs of several slices meet
                j = min(i + 100, len(rows))
                blobs, settled = runindex._blobs(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], ids[i:j], ths[i:j],
                                                 np.zeros(0, np.uint64), 1, 100)
                gone.setdefault("blobs", []).extend(b for _, b in blobs)
                gone.setdefault("found", []).append(settled)
            marks = {}
            for found in [*gone["found"], *runindex._part_spans(gone["blobs"], 100)]:
                for d, h, a, z in zip(*(x.tolist() for x in found)):
                    marks.setdefault((d, h), set()).update(range(a, z))
            got = [(d, len(t), len(marks.get((int(i), int(h)), ()))) for (d, _), t, i, h in zip(rows, raw, ids, ths)]
            assert sorted(got, key=str) == want
            assert max(longest, default=0) <= 3000 or limit > 3000 and max(longest) > 9000
