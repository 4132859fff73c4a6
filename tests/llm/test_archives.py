import base64
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from candlewick.llm import archives
from candlewick.sources.tables import load
from tests.conftest import SF001


def brute(rows, least=0):
    first = {}
    for i, html in rows:
        b = (html or "").encode()
        if len(b) >= least and i is not None:
            first[b] = min(first.get(b, i), i)
    out = Counter()
    for i, html in rows:
        b = (html or "").encode()
        f = first.get(b, i) if len(b) >= least else i
        sha = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out[i, len(b), sha, "response" if f == i else "revisit", None if f == i else f] += 1
    return out


def got(back):
    return Counter(tuple(r) for r in back.select(
        F.col("source").cast("long"), "size", "digest", "type", F.col("refers_source").cast("long")).collect())


def test_whole_table_round_trip(spark):
    pages = load(spark, SF001, "pages")
    back = archives.archive_pages(pages, archives.shared_folder(spark)).cache()
    rows = {r.page_id: r for r in pages.collect()}
    assert got(back) == brute([(r.page_id, r.html) for r in rows.values()])
    for r in back.collect():
        page = rows[int(r.source)]
        assert r.url == page.url
        assert bytes(r.payload).decode() == (page.html if r.type == "response" else "")


def test_awkward_pages_many_files(spark):
    html = [None, "", "é\r\n\r\nWARC/1.1\r\n", "<x>", "same", "http://x 0.0.0.0 1 text/html 5\nabc"]
    rows = [(i, "http://a b/%d#x" % i if i % 7 else None, html[i % 6] if i % 11 else "long " * 9000)
            for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4) \
        .withColumn("digest", F.lit("x")).withColumn("source", F.lit("y"))
    for least in (0, 4):
        back = archives.archive_pages(df, archives.shared_folder(spark), file_bytes=300, revisit_bytes=least)
        assert got(back) == brute([(i, h) for i, _, h in rows], least)
    assert {r.url for r in back.select("url").collect()} >= {"-", "http://a%20b/1#x"}


def test_repeated_and_null_ids(spark):
    rows = [(1, "u", "p"), (1, "u", "p"), (None, "u", "p")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    back = archives.archive_pages(df, archives.shared_folder(spark)).collect()
    assert Counter(r.type for r in back) == Counter(response=1, revisit=2)
    assert {r.refers_source for r in back if r.type == "revisit"} == {"1"}
    assert [r.source for r in back if r.type == "response"] == ["1"]


def test_raw_bytes_and_both_versions(spark):
    payloads = [b"\xff\xfe\x00bin\n", b"", b"filedesc://x 1\n"]
    for version in (1, 2):
        data = archives.arc_file("n.arc", version, [("http://x/%d" % i, "2001", "a/b", p)
                                                    for i, p in enumerate(payloads)])
        assert [r[-1] for r in archives.parse_arc(data)] == payloads
        arcs = spark.createDataFrame([("n.arc", bytearray(data))], "name string, data binary")
        recs = archives.convert(arcs).withColumn("source", F.lit(None).cast("long"))
        path = f"{archives.shared_folder(spark)}/raw{version}"
        archives.write_warc(archives.with_revisits(recs), path, 2, "none" if version == 1 else "gzip")
        back = archives.read_warc(spark, path).collect()
        assert sorted(bytes(r.payload) for r in back) == sorted(payloads)
        assert {r.date for r in back} == {"2001-01-01T00:00:00Z"}
        assert {r.id for r in back} == {r.id for r in recs.collect()}


def test_wrong_lengths_are_refused():
    data = archives.arc_file("n.arc", 1, [("http://x", "2001", "a/b", b"abc")])
    for bad in (data[:-2], data.replace(b" 3\n", b" 9\n"), data.replace(b" 3\n", b" 2\n"), b"no archive\n"):
        with pytest.raises(ValueError):
            list(archives.parse_arc(bad))


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert archives.archive_pages(df, archives.shared_folder(spark)).count() == 0


def test_text_ids_of_any_spelling(spark):
    ids = ["a b", "x#y", "100% +1", "é日", "line\r\nend", "plain"]
    rows = [(i, "http://x", f"page {k % 3}") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "page_id string, url string, html string")
    back = {r.source: r for r in archives.archive_pages(df, archives.shared_folder(spark)).collect()}
    assert set(back) == set(ids)
    for k, i in enumerate(ids):
        least = min(j for n, j in enumerate(ids) if n % 3 == k % 3)
        assert (back[i].type, back[i].refers_source) == (("response", None) if i == least else ("revisit", least))


def test_files_are_bounded_by_bytes(spark, monkeypatch):
    """A run of large pages does not make a file of the usual number of records."""
    monkeypatch.setattr(archives, "LARGEST_FILE", 9000)
    rows = [(i, "u", f"{i} " + "x" * (4000 if i < 8 else 1)) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    root = archives.shared_folder(spark)
    back = archives.archive_pages(df, root)
    assert back.count() == 200
    files = [f.split(":", 1)[-1] for f in back.inputFiles()]
    per_file = spark.read.format("binaryFile").load(files).select("content").collect()
    assert max(len(list(archives.parse_warc(archives.plain(bytes(r.content))))) for r in per_file if r.content) == 1
