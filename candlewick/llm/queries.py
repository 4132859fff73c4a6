"""One query per operator: its production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.llm import (archives, decontam, divergence, packing, preferences, quality, repair, runindex,
                            sharding, simhash, substrings, toxicity, vectors)
from candlewick.llm.registry import load, query


@query("op8_simhash")
def op8(spark, sf_dir):
    """Near-duplicate components of ``documents`` by SimHash."""
    found = simhash.near_duplicates(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@query("op7_best_fit")
def op7(spark, sf_dir):
    """``documents`` packed into 2,048-token sequences by best-fit decreasing."""
    return packing.pack(load(spark, sf_dir, "documents").select("doc_id", "text"))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, CAST(least(13, len(w)) AS BIGINT) AS size FROM (SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT item_id, size, s, array_to_string(w[s:s + size - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS s FROM b)),
dw AS (SELECT r, size, p, array_to_string(w[p:p + size - 1], ' ') AS win FROM (
       SELECT r, w, size, unnest(range(1, CAST(len(w) AS BIGINT) - size + 2)) AS p
       FROM d CROSS JOIN (SELECT DISTINCT size FROM b))),
h AS (SELECT r, p, size, item_id, s FROM dw JOIN bw USING (size, win)),
hit AS (SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(range(p, p + size)) AS x FROM h) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY r),
runs AS (SELECT r, item_id, min(p) AS p, min(s) AS s, max(p + size) - min(p) AS length FROM (
    SELECT *, p - row_number() OVER (PARTITION BY r, item_id, size, s - p ORDER BY p) AS k FROM h)
  GROUP BY r, item_id, size, s - p, k),
best AS (SELECT r, max(length) AS length, arg_min(item_id, [-length, p, item_id, s]) AS item FROM runs GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(hit.n > 0 AND 20 * hit.n >= len(w), false) AS contaminated,
  CAST(coalesce(best.length, 0) AS BIGINT) AS longest_match, CAST(best.item AS VARCHAR) AS longest_item
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r) LEFT JOIN best USING (r)
"""


@query("op1_decontaminate", OP1_SQL)
def op1(spark, sf_dir):
    """Benchmark passages in ``documents``."""
    found = decontam.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        decontam.items_digest(F.col("items")).alias("items_sha256"), "contaminated",
        F.col("longest").cast("long").alias("longest_match"), "longest_item")


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS win
      FROM (SELECT *, unnest(range(1, CAST(len(w) AS BIGINT) - 33)) AS i FROM d)),
m AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY win) AS n FROM v) WHERE n > 1),
g AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 35 THEN 0 ELSE 1 END AS new FROM m),
s AS (SELECT r, min(i) AS a, max(i) + 34 AS z
      FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS k FROM g) GROUP BY r, k),
x AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT x.r, count(*) AS n, string_agg(word, ' ' ORDER BY x.i) AS kept FROM x
      WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.r = x.r AND x.i BETWEEN s.a AND s.z) GROUP BY x.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""


@query("op10_substrings", OP10_SQL)
def op10(spark, sf_dir):
    """``documents`` without the words of repeated 35-word windows."""
    found = substrings.remove_repeats(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op6_neighbour_vote")
def op6(spark, sf_dir):
    """Quality of every document by nearest-neighbour voting."""
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query("op3_factorization")
def op3(spark, sf_dir):
    """Toxicity of every document by a factorization machine."""
    return toxicity.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def _crc_table() -> list[int]:
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ 0xEDB88320 * (c & 1)
        out.append(c)
    return out


#: Checksums are folded byte by byte over the table of the CRC-32 polynomial.
OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key,
             coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
sums AS (SELECT r, xor(list_reduce(
    list_prepend(4294967295, list_transform(regexp_extract_all(h, '..'), lambda x: CAST('0x' || x AS BIGINT))),
    lambda a, b: xor(a >> 8, {_crc_table()}[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32 FROM d),
draws AS (SELECT r, s, -ln((CAST('0x' || md5(key || ':' || s)[1:13] AS BIGINT) + 0.5) / 4503599627370496.0) AS x
          FROM d, range(25) t(s)),
best AS (SELECT r, arg_min(s, x) FILTER (s < 24) AS shard, arg_min(s, x) AS grown_shard FROM draws GROUP BY r)
SELECT doc_id, CAST(strlen(text) + 8 AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law,
       CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(key), text_crc32, strlen(text)) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM d JOIN sums USING (r) JOIN best USING (r)
"""


@query("op5_rendezvous", OP5_SQL)
def op5(spark, sf_dir):
    """``documents`` in 24 shards by rendezvous hashing of doc_id."""
    placed = sharding.assign(load(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                         "grown_shard")


OP2_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns,
             sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS said FROM t GROUP BY conv_id),
r AS (SELECT *, list_transform(turns, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)) AS texts,
             list_max(list_filter(range(1, CAST(len(turns) AS BIGINT) + 1), lambda i: turns[i].role = 'assistant')) AS last
      FROM c),
g AS (SELECT sha256(texts[1]) AS opening, sha256(array_to_string(texts, '')) AS digest, said, last,
             min(conv_id) AS conv_id FROM r GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY opening ORDER BY digest) - 1 AS rank FROM g),
p AS (SELECT opening[1:16] || ':' || (rank // 2) AS pair_id, arg_max(conv_id, said * 1000000000 - rank) AS chosen_id,
             arg_min(conv_id, said * 1000000000 - rank) AS rejected_id
      FROM n GROUP BY opening, rank // 2 HAVING count(*) = 2),
w AS (SELECT *, (CAST('0x' || digest[1:8] AS BIGINT) * greatest(1, count(*) OVER () // 1000)) >> 32 AS ring
      FROM g WHERE last IS NOT NULL),
s AS (SELECT conv_id, coalesce(lead(conv_id) OVER o, first_value(conv_id) OVER o) AS other
      FROM w WINDOW o AS (PARTITION BY ring ORDER BY digest)),
b AS (SELECT pair_id, chosen_id, rejected_id, x.turns AS c_turns, y.turns AS r_turns
      FROM p JOIN r x ON x.conv_id = chosen_id JOIN r y ON y.conv_id = rejected_id
      UNION ALL
      SELECT 'swap:' || s.conv_id, s.conv_id, other, x.turns[1:x.last],
             list_append(x.turns[1:x.last - 1], y.turns[y.last])
      FROM s JOIN r x ON x.conv_id = s.conv_id JOIN r y ON y.conv_id = other
      WHERE x.turns[x.last].text <> y.turns[y.last].text),
k AS (SELECT *, coalesce(list_min(list_filter(range(1, CAST(least(len(c_turns), len(r_turns)) AS BIGINT) + 1),
                           lambda i: c_turns[i] <> r_turns[i])) - 1, least(len(c_turns), len(r_turns))) AS k FROM b),
u AS (SELECT pair_id, 'c' AS side, unnest(c_turns[k + 1:]) AS x, generate_subscripts(c_turns[k + 1:], 1) AS i FROM k
      UNION ALL
      SELECT pair_id, 'r', unnest(r_turns[k + 1:]), generate_subscripts(r_turns[k + 1:], 1) FROM k),
v AS (SELECT *, sum(length(x.role) + length(x.text) + 13) OVER (PARTITION BY pair_id, side ORDER BY i) AS upto FROM u),
m AS (SELECT pair_id, side, string_agg((upto - length(x.text) - 8) || '-' || upto, ',' ORDER BY i) AS mask
      FROM v WHERE x.role = 'assistant' GROUP BY ALL)
SELECT k.pair_id, chosen_id, rejected_id, CAST(k AS INTEGER) AS prompt_turns,
  array_to_string(list_transform(c_turns[1:k], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '') AS prompt,
  array_to_string(list_transform(c_turns[k + 1:], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '') AS chosen_completion,
  coalesce(mc.mask, '') AS chosen_mask,
  array_to_string(list_transform(r_turns[k + 1:], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '') AS rejected_completion,
  coalesce(mr.mask, '') AS rejected_mask
FROM k LEFT JOIN m mc ON mc.pair_id = k.pair_id AND mc.side = 'c'
       LEFT JOIN m mr ON mr.pair_id = k.pair_id AND mr.side = 'r'
"""


def _mask_text(column: str):
    return F.array_join(F.transform(column, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")


@query("op2_preferences", OP2_SQL)
def op2(spark, sf_dir):
    """Preference pairs of ``conversations`` that share their first turn."""
    return preferences.preference_pairs(load(spark, sf_dir, "conversations")) \
        .withColumn("chosen_mask", _mask_text("chosen_mask")) \
        .withColumn("rejected_mask", _mask_text("rejected_mask"))


OP9_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
    min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
g AS (SELECT page_id, html, first, list_transform(range(8), lambda i: CAST('0x' || h[5 * i + 1:5 * i + 5] AS BIGINT)) AS v
      FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, array_to_string(flatten(list_transform(v, lambda x:
    list_transform([15, 10, 5, 0], lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((x >> CAST(k AS BIGINT)) & 31) + 1]))), '')
    AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM g
"""


@query("op9_archives", OP9_SQL)
def op9(spark, sf_dir):
    """``pages`` through legacy archives into WARC files and back."""
    pages = load(spark, sf_dir, "pages")
    back = archives.archive_pages(pages, archives.shared_folder(spark))
    kind = pages.schema["page_id"].dataType
    return back.select(F.col("source").cast(kind).alias("page_id"), F.col("size").alias("payload_bytes"),
                       F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"),
                       F.col("refers_source").cast(kind).alias("refers_to"))


OP4_SQL = r"""
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS u FROM e
      WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u)
          WHERE list_inner_product(a.u, b.u) >= 0.9),
reach AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, low.component_id, low.component_id = e.vec_id AS kept
FROM e JOIN low ON low.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


@query("op4_pruned_graph", OP4_SQL)
def op4(spark, sf_dir):
    """Links and components of all ``embeddings`` at cosine 0.9."""
    return vectors.near_duplicates(load(spark, sf_dir, "embeddings"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
c AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n FROM g JOIN kept k ON k.lang = g.lang
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
p AS (SELECT *, 1 + (1000000000 * CAST(n + 5 AS HUGEINT))
        // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM c),
l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000 * CAST(n + 5 AS HUGEINT))
        // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM l),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
            coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value
          FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query("op12_divergence", OP12_SQL)
def op12(spark, sf_dir):
    """Distances of the sources of each language of ``documents``, and their terms."""
    return divergence.audit(load(spark, sf_dir, "documents"))


def _op11_step() -> tuple[str, str]:
    """SQL of the cheapest (cost, audit, text) after the inserts before a row, and of
    the row's own edits, per last role e (none), s, u, a."""
    def least(*xs):
        return "list_min([" + ", ".join(xs) + "])"

    def to(x, cost, letter, line, when="true"):
        text = f"{x}.o || {line}" if line else f"{x}.o"
        return f"CASE WHEN {x} IS NOT NULL AND {when} THEN {{'c': {x}.c + {cost}, 'w': {x}.w || '{letter}', 'o': {text}}} END"

    user, helper = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    u1 = least("u", *[to(x, 3, "I", user) for x in "esa"])
    gap = f"SELECT *, {least('a', to('u1', 3, 'I', helper))} AS a1 FROM (SELECT *, {u1} AS u1 FROM x)"

    def take(x, role, said):
        kept = f"NOT must AND left(role, 1) = '{role}'"
        return [to(x, "3 + late", "R", f"{said} || text", "NOT must"),
                to(x, "late", "K", "chr(10) || role || ':' || text", kept)]

    gone = {x: to(x, 4, "D", None) for x in ("e", "s", "u1", "a1")}
    edits = ", ".join([
        f"{gone['e']} AS e",
        least(gone["s"], to("e", "late", "K", "chr(10) || role || ':' || text", "NOT must AND left(role, 1) = 's'")) + " AS s",
        least(gone["u1"], *[c for x in ("e", "s", "a1") for c in take(x, "u", user)]) + " AS u",
        least(gone["a1"], *take("u1", "a", helper)) + " AS a"])
    return gap, edits


_GAP, _EDITS = _op11_step()
_PATH = "STRUCT(c INTEGER, w VARCHAR, o VARCHAR)"
OP11_SQL = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h
  FROM conversations),
d AS (SELECT * EXCLUDE h, xor(list_reduce(
    list_prepend(4294967295, list_transform(regexp_extract_all(h, '..'), lambda x: CAST('0x' || x AS BIGINT))),
    lambda a, b: xor(a >> 8, {_crc_table()}[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS d FROM k),
h AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, d,
    CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE d WHEN 0 THEN [] WHEN 3 THEN [0, 0] ELSE [0] END) AS copy FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen FROM h),
f AS (SELECT *, seen = '' AS blank,
    row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again,
    right(seen, 1) NOT IN ('.', '!', '?') AS cut,
    left(lag(role) OVER (PARTITION BY g ORDER BY i), 1) || left(role, 1) AS pair FROM o),
r AS (SELECT *, blank OR again AS must, CASE WHEN NOT blank AND NOT again AND cut THEN 3 ELSE 0 END AS late FROM f),
n AS (SELECT g, count(*) AS n, count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    count(*) FILTER (late = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM r GROUP BY g),
p AS (SELECT g, CAST(0 AS BIGINT) AS i, CAST({{'c': 0, 'w': '', 'o': ''}} AS {_PATH}) AS e, CAST(NULL AS {_PATH}) AS s,
    CAST(NULL AS {_PATH}) AS u, CAST(NULL AS {_PATH}) AS a FROM n
  UNION ALL
  SELECT g, i, {_EDITS} FROM (SELECT x.g, r.i, e, s, u1, a1, role, text, must, late
    FROM (SELECT * FROM ({_GAP.replace("FROM x)", "FROM p)")})) x JOIN r ON r.g = x.g AND r.i = x.i + 1)),
z AS (SELECT q.*, list_min([e, a1]) AS best, n.* EXCLUDE g FROM ({_GAP.replace("FROM x)", "FROM p)")}) q
  JOIN n ON n.g = q.g AND n.n = q.i),
c AS (SELECT DISTINCT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g FROM conversations)
SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.w, '') AS audit,
  sha256(coalesce(best.o[2:], '')) AS repaired_sha256
FROM c LEFT JOIN (SELECT cg.conv_id, z.* FROM z JOIN (SELECT DISTINCT g, conv_id FROM h) cg ON cg.g = z.g) y
  ON y.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op11_repair", OP11_SQL)
def op11(spark, sf_dir):
    """Damaged ``conversations`` and their cheapest repair."""
    return repair.repair(repair.damage(load(spark, sf_dir, "conversations")))


OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, md5(h[2 * i + 1:2 * i + 200]) AS w
      FROM (SELECT *, unnest(range(0, CAST(len(h) // 2 AS BIGINT) - 99)) AS i FROM d)),
m AS (SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY w) AS least,
        min(i) OVER (PARTITION BY w, r) AS first FROM w) WHERE least < doc_id OR first < i),
n AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM m),
s AS (SELECT r, min(i) AS a, max(i) + 100 AS z
      FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS k FROM n) GROUP BY r, k),
p AS (SELECT s.r, a, z, h[2 * lag(z, 1, 0) OVER (PARTITION BY s.r ORDER BY a) + 1:2 * a] AS piece
      FROM s JOIN d ON d.r = s.r),
c AS (SELECT r, sum(z - a) AS gone, count(*) AS spans, max(z) AS z, string_agg(piece, '' ORDER BY a) AS kept
      FROM p GROUP BY r)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
  coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, '') || h[2 * coalesce(z, 0) + 1:])) AS kept_sha256
FROM d LEFT JOIN c ON c.r = d.r
"""


@query("op13_run_index", OP13_SQL)
def op13(spark, sf_dir):
    """``documents`` without the bytes of repeated 100-byte strings."""
    found = runindex.remove_repeats(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
