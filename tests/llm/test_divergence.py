"""The source divergence audit against a brute-force statement of its rules."""

import random
import re
from collections import Counter

from candlewick.llm import divergence
from tests.llm.common import AWKWARD, low, with_extras

LETTERS = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", LETTERS.findall(low(text))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if df[t] >= min_docs) for s in {d[1] for d in mine}}

        def p(c):
            n = sum(c.values())
            return {t: 1 + 10 ** 9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = p(sum(counts.values(), Counter()))
        for s in counts:
            mine_p = p(counts[s])
            pairs = [(o, sum(abs(mine_p[t] - p(counts[o])[t]) for t in kept)) for o in counts if o != s]
            terms = [(t, mine_p[t] - q[t]) for t in kept if counts[s][t] > 0 and mine_p[t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:limit])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(n=60, seed=3):
    rnd = random.Random(seed)
    words = ["Été", "the", "THE", "cat", "a1b", "ñu", "x", "zebra", "日本", "over-all"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9))), rnd.choice(["en", "fr", None, "a:b"]),
             rnd.choice(["web", "news", None, "é"])) for i in range(n)]
    return rows + [(100 + i, t, "en", "web") for i, t in enumerate(AWKWARD)] + [(None, "the cat", "en", "books")] * 2


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    for min_docs, top in ((2, 3), (8, 50)):
        want = brute(rows, min_docs, top)
        assert rows_of(divergence.audit(df, min_docs, top)) == want and want
    extra = with_extras(df).withColumn("tokens", df.text).withColumn("vec", df.text).withColumn("idx", df.doc_id)
    assert rows_of(divergence.audit(extra.repartition(5), 2, 3)) == brute(rows, 2, 3)


def test_no_kept_terms_and_empty_table(spark):
    rows = corpus(20)
    got = rows_of(divergence.audit(spark.createDataFrame(rows, SCHEMA), 1000))
    assert got == brute(rows, 1000, 50) and {r[4] for r in got} == {0}
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ties_are_ordered_by_utf8_and_large_counts_stay_exact(spark):
    rows = [(i, " ".join(["é", "z", "a", "日"] * (i % 3 + 1)), "en", s) for i in range(6) for s in ("p", "q", "r")]
    assert rows_of(divergence.audit(spark.createDataFrame(rows, SCHEMA), 2)) == brute(rows, 2, 50)
    big = spark.createDataFrame([(5 * 10 ** 13, 9 * 10 ** 14, 10 ** 7)], "n long, total long, v long")
    from pyspark.sql import functions as F
    got = big.select(divergence._p(F.col("n"), F.col("total"), F.col("v"))).first()[0]
    assert got == 1 + 10 ** 9 * (5 * 10 ** 13 + 5) // (9 * 10 ** 14 + 5 * 10 ** 7)
