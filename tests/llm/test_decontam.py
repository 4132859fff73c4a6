import hashlib

from pyspark.sql import functions as F

from candlewick.llm import decontam
from candlewick.sources.tables import load
from tests.conftest import SF001
from tests.llm.common import ALNUM, AWKWARD, low, table, texts, with_extras


def brute(docs, bench, window):
    items = [(i, ALNUM.findall(low(t))) for i, t in bench]
    wins = {}
    for i, w in items:
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w = ALNUM.findall(low(t))
        hit, found = [0] * len(w), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    found |= wins[tuple(w[k:k + n])]
                    hit[k:k + n] = [1] * n
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), sum(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out, key=str)


def longest(text, bench, window):
    x, best = ALNUM.findall(low(text)), 0
    for _, t in bench:
        t = ALNUM.findall(low(t))
        for a in range(len(t)):
            for b in range(len(x)):
                k = 0
                while a + k < len(t) and b + k < len(x) and t[a + k] == x[b + k]:
                    k += 1
                best = max(best, k if t and k >= min(window, len(t)) else 0)
    return best


def got(df):
    cols = ["doc_id", "n_words", "n_hit", F.size("items").cast("long"),
            decontam.items_digest(F.col("items")), "contaminated"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_whole_tables_against_brute_force(spark):
    docs, bench = load(spark, SF001, "documents"), load(spark, SF001, "benchmark")
    rows = [[tuple(r) for r in t.collect()] for t in (docs.select("doc_id", "text"), bench.select("item_id", "text"))]
    assert got(decontam.contamination(docs, bench)) == brute(*rows, 13)


def test_short_items_blocks_and_longest_match(spark):
    docs = list(enumerate(texts(120, "ab é", 60, 3))) + [(None, "a b"), (7, None), (7, "a a a a a a a")]
    items = list(enumerate(texts(14, "ab ", 24, 4))) + [(90, None), (None, "a b a b"), (91, "a " * 30), (91, "b")]
    d, b = table(spark, docs), table(spark, items, "item_id long, text string")
    want = brute(docs, items, 4)
    for blocks in (1 << 20, 40):
        found = decontam.contamination(d, b, window=4, block_bytes=blocks)
        assert got(found) == want
    for r, in zip(decontam.contamination(d, b, window=4, keep=("doc_id", "text")).collect()):
        assert r.longest == longest(r.text, items, 4)
        if r.longest:
            words = ALNUM.findall(low(r.text))
            assert ALNUM.findall(low(r.longest_text)) == words[r.longest_word:r.longest_word + r.longest]


def test_awkward_rows_keep_their_columns(spark):
    docs = with_extras(table(spark, list(enumerate(AWKWARD))))
    bench = table(spark, [(1, "same text here now")], "item_id long, text string")
    out = decontam.decontaminate(docs, bench)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert sorted(r.doc_id for r in out.collect()) == list(range(10))


def test_empty_tables(spark):
    none, some = table(spark, []), table(spark, [(1, "a")])
    bench = table(spark, [], "item_id long, text string")
    assert decontam.contamination(none, bench).count() == 0
    assert got(decontam.contamination(some, bench)) == brute([(1, "a")], [], 13)
