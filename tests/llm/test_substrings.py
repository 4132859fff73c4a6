import hashlib
from collections import Counter

from pyspark.sql import functions as F

from candlewick.llm import substrings
from candlewick.sources.tables import load
from tests.conftest import SF001
from tests.llm.common import AWKWARD, NON_SPACE, table, texts, with_extras


def brute(docs, window):
    words = [NON_SPACE.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = Counter()
    for (d, _), w in zip(docs, words):
        gone = [0] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [1] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def got(df, **params):
    out = substrings.remove_repeats(df, **params)
    return Counter(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect())


def test_whole_table_against_brute_force(spark):
    docs = load(spark, SF001, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(docs) == brute(rows, 35)


def test_small_windows_long_prefixes_and_tasks(spark):
    rows = [(None if i == 7 else i // 2, t) for i, t in enumerate(texts(60, "ab \n", 30, 5))]
    rows += list(enumerate(AWKWARD)) + [(1, "x y\tz\n é u v")] * 3
    docs = with_extras(table(spark, rows))
    want = brute(rows, 5)
    assert got(docs, window=5, prefix=2) == want
    assert got(docs, window=5, prefix=2, group_rows=2) == want      # lengthened prefixes
    assert got(docs, window=5, prefix=4, task_bytes=50) == want     # many subtrees


def test_first_min_is_the_leftmost_smallest():
    import numpy as np
    v = np.random.default_rng(0).integers(0, 4, 200)
    for width in (1, 2, 3, 7, 24):
        at = substrings._first_min(v, width)
        assert at.tolist() == [i + int(v[i:i + width].argmin()) for i in range(len(v) - width + 1)]


def test_drop_repeats_keeps_columns_and_clean_texts(spark):
    rows = [(1, "a b c d e  f"), (2, "x a b c d e y"), (3, "left  as\tit is"), (4, None)]
    docs = with_extras(table(spark, rows)).withColumn("n_chars", F.lit(99).cast("long"))
    out = substrings.drop_repeats(docs, window=5, prefix=2)
    assert out.dtypes == docs.dtypes
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {
        1: ("f", 1), 2: ("x y", 3), 3: ("left  as\tit is", 99), 4: (None, 99)}


def test_empty_table(spark):
    assert substrings.remove_repeats(table(spark, [])).count() == 0
