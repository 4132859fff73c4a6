"""Plain-Python statements of the operators' rules."""

import random
import re

AWKWARD = [None, "", " ", "\n\t", "a", "A b", "x" * 5000, "word " * 3000, "é ü 日本 語", "\x00 \x1c odd",
           "same text here now", "same text here now", "SAME text here now"]


def texts(n, alphabet="ab ", size=40, seed=0):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, size))) for _ in range(n)]


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def with_extras(df):
    """The same rows with columns named like the operators' own."""
    from pyspark.sql import functions as F
    for name in ("score", "fp", "component_id", "n_words", "spans", "c0", "k0", "keep", "kept_text"):
        df = df.withColumn(name, F.lit(name))
    return df


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NON_SPACE = re.compile("[^\x20\x09-\x0D]+")


def smallest_reachable(ids, linked):
    """Component id of each id, for a symmetric predicate over positions."""
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(find(i), []).append(x)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return [least[find(i)] for i in range(len(ids))]
