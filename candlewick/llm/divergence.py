"""Source divergence audit: how the sources of a language differ in their terms.

Vectors. Terms are maximal runs of letters (A-Z lower-cased, every non-ASCII
character a letter). ``CountVectorizer`` with ``minDF`` and the largest integer as
``vocabSize`` keeps each term of at least ``min_docs`` documents of its language and
turns every document into an exact sparse vector. The vectorizers of all languages
are fitted in one pass: tokens are ``lang:term`` and a document has one language, so
``minDF`` counts within the language, whatever the number of languages. A document is
written in layers (the terms that occur once, twice, ...), so each term is handed to
the vectorizer once per document and its vector is the weighted sum of its layers. As always
with ``CountVectorizer`` the vocabulary (not the counts) passes through the driver;
it holds only terms of ``min_docs`` documents or more.

Sums. The vectors are summed per (lang, source) sparsely: exploded to indices, the
occurrences added up as longs, map-side and then per group, so a source with a third
of all rows shuffles one row per task and term.

Pairs. With p0 the probability of an absent term, the distance of two groups g, h is
V * |p0_g - p0_h|, plus for the terms of g the change |p_g - p0_h| - |p0_g - p0_h|
(from a histogram of p), likewise for h, plus a correction for the terms that both
have (an equi-join on the term). So only occurring counts are ever touched.

Defined results: null text, lang and source count as ''; a group or a language
without kept terms has distance 0 to the others and no ``term`` rows; a language
with one source has no ``pair`` rows; repeated rows count as often as they occur;
an empty table gives an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import LOWER, byte_class, slices, text_buffer, tune, words
from candlewick.session import checkpoint_root

MIN_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTH = 5
LETTER = byte_class([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
_MARK = ":"      # never part of a term; also the token that keeps a vocabulary from being empty
_MAX_INT = 2 ** 31 - 1


def token_layers(buf, offs, langs: pa.Array):
    """The ``lang:term`` tokens of a slice in layers: (document, times, tokens), a row
    for each document and number of occurrences, with the tokens that occur so often."""
    starts, ends, wo = words(buf, offs, LETTER)
    to = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    data = LOWER[buf[LETTER[buf]]]
    terms = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(to), pa.py_buffer(data)]) \
        .dictionary_encode()
    k = max(len(terms.dictionary), 1)
    doc = np.repeat(np.arange(len(wo) - 1), np.diff(wo))
    pair, times = np.unique(doc * k + terms.indices.to_numpy(), return_counts=True)
    doc, term = pair // k, pair % k
    order = np.lexsort((times, doc))
    doc, term, times = doc[order], term[order], times[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (times[1:] != times[:-1])
    new = np.flatnonzero(new)
    tokens = pc.binary_join_element_wise(langs.take(pa.array(doc)), terms.dictionary.take(pa.array(term)), _MARK)
    lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(doc)).astype(np.int32)), tokens)
    return doc[new], times[new], lists


def layers(docs: DataFrame) -> DataFrame:
    """(gid, times, tokens): a row for each document (of group ``gid``) and number of
    occurrences. A document's terms are dealt over its rows, each to exactly one."""
    tune(docs.sparkSession)

    def run(batches):
        for b in batches:
            buf, offs = text_buffer(b.column(2))
            for i, j in slices(offs):
                part = b.slice(i, j - i)
                doc, times, lists = token_layers(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(doc)), pa.array(times), lists],
                                                 ["gid", "times", "tokens"])

    return docs.select("gid", "lang", "text").mapInArrow(run, "gid long, times long, tokens array<string>")


def document_vectors(rows: DataFrame, min_docs: int = MIN_DOCS):
    """(vocabulary (idx, lang, term), rows (gid, times, vec)): the exact sparse vectors
    of all documents, as the sum of times * vec over a document's rows. A term is in one
    row of each document that has it, so ``minDF`` counts documents. ``min_docs`` rows
    that hold only the mark keep the fit from failing where no term qualifies; the mark
    is not a term."""
    spark = rows.sparkSession
    padding = spark.range(min_docs).select(F.array(F.lit(_MARK)).alias("tokens"))
    model = CountVectorizer(inputCol="tokens", outputCol="vec", minDF=float(min_docs), vocabSize=_MAX_INT) \
        .fit(rows.select("tokens").unionByName(padding))
    token = model.vocabulary
    listed = pa.table({"idx": pa.array(range(len(token)), pa.int32()), "token": pa.array(token, pa.string())})
    term = F.substring_index("token", _MARK, -1)
    vocabulary = spark.createDataFrame(listed).where(F.col("token") != _MARK).select(
        "idx", F.expr(f"left(token, length(token) - length(substring_index(token, '{_MARK}', -1)) - 1)").alias("lang"),
        term.alias("term"))
    return vocabulary, model.transform(rows).select("gid", "times", "vec")


def group_sums(vectors: DataFrame) -> DataFrame:
    """(gid, idx, n): the vectors of each group added up."""
    each = vectors.select("gid", "times", F.explode(F.unwrap_udt("vec")["indices"]).alias("idx"))
    return each.groupBy("gid", "idx").agg(F.sum("times").alias("n"))


def _p(count, total, v):
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * v)), exact; null without terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTH).cast("decimal(20,0)")
    low = F.nullif((total + SMOOTH * v).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.call_function("div", top, low) + 1


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): the distances of each group to the
    other sources of its language (``pair``, all) and its most over-represented
    terms against the language (``term``, the first ``top_terms``)."""
    spark = docs.sparkSession
    folder = f"{checkpoint_root(spark)}/divergence-{uuid.uuid4().hex}"
    named = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                        "text")
    named.select("lang", "source").distinct().withColumn("gid", F.monotonically_increasing_id()) \
        .write.parquet(f"{folder}/groups")
    ids = spark.read.parquet(f"{folder}/groups")
    layers(named.join(ids, ["lang", "source"])).write.parquet(f"{folder}/layers")   # read by fit and transform
    vocabulary, vectors = document_vectors(spark.read.parquet(f"{folder}/layers"), min_docs)
    sums = group_sums(vectors).checkpoint()
    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("v"))
    groups = (ids.join(sums.groupBy("gid").agg(F.sum("n").alias("total")), "gid", "left")
              .join(sizes, "lang", "left").na.fill(0, ["total", "v"])
              .withColumn("p0", _p(F.lit(0), F.col("total"), F.col("v"))).checkpoint())
    known = sums.join(groups, "gid").select(
        "gid", "lang", "source", "idx", "p0", _p(F.col("n"), F.col("total"), F.col("v")).alias("p"))

    # distances, by the groups' numbers
    a = groups.select("lang", "v", F.col("gid").alias("ga"), F.col("p0").alias("a0"))
    b = groups.select("lang", F.col("gid").alias("gb"), F.col("p0").alias("b0"))
    base = a.join(b, "lang").where("ga <> gb").select(
        "ga", "gb", F.coalesce(F.col("v") * F.abs(F.col("a0") - F.col("b0")), F.lit(0)).alias("f"))
    spread = known.groupBy("lang", F.col("gid").alias("ga"), F.col("p0").alias("a0"), "p").agg(F.count("*").alias("k"))
    own = spread.join(b, "lang").where("ga <> gb").select(
        "ga", "gb", (F.col("k") * (F.abs(F.col("p") - F.col("b0")) - F.abs(F.col("a0") - F.col("b0")))).alias("f"))
    own = own.groupBy("ga", "gb").agg(F.sum("f").alias("f"))
    x = known.select("idx", F.col("gid").alias("ga"), F.col("p").alias("pa"), F.col("p0").alias("a0"))
    y = known.select("idx", F.col("gid").alias("gb"), F.col("p").alias("pb"), F.col("p0").alias("b0"))
    both = x.join(y, "idx").where("ga < gb").select(
        "ga", "gb", (F.abs(F.col("pa") - F.col("pb")) - F.abs(F.col("pa") - F.col("b0"))
                     - F.abs(F.col("a0") - F.col("pb")) + F.abs(F.col("a0") - F.col("b0"))).alias("f"))
    both = both.groupBy("ga", "gb").agg(F.sum("f").alias("f"))
    turn = lambda d: d.select(F.col("gb").alias("ga"), F.col("ga").alias("gb"), "f")
    pairs = (base.unionByName(own).unionByName(turn(own)).unionByName(both).unionByName(turn(both))
             .groupBy("ga", "gb").agg(F.sum("f").alias("value"))
             .join(groups.select(F.col("gid").alias("ga"), "lang", "source"), "ga")
             .join(groups.select(F.col("gid").alias("gb"), F.col("source").alias("item")), "gb")
             .select("lang", "source", "item", "value", F.lit("pair").alias("part")))

    # over-represented terms
    whole = sums.groupBy("idx").agg(F.sum("n").alias("n")).join(vocabulary, "idx")
    totals = groups.groupBy("lang", "v").agg(F.sum("total").alias("total"))
    q = whole.join(totals, "lang").select(
        "idx", "term", _p(F.col("n"), F.col("total"), F.col("v")).alias("q"))
    more = known.join(q, "idx").where("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"), F.lit("term").alias("part"))

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).unionByName(
        more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms))
    return ranked.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")
