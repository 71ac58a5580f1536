import gzip
import hashlib
import random
from collections import Counter

import pytest

from profitlens.llm import warc
from profitlens.session import staged_path

PAGES = "page_id long, url string, html string, key string, digest string, size int, archive string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", "d", 1, "x") for r in rows], PAGES).repartition(3)


BIG = "<p>" + "é\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 60
ROWS = [
    (1, "http://b.example.com/x?q=1#top", BIG), (2, "http://a.example.com/", BIG), (9, "http://b.example.com/x?q=1", BIG), (9, "http://b.example.com/x?q=1", BIG),
    (3, None, "small"), (4, "http://a.example.com/", "small"), (5, "not a url\r\nX-Page: 1", None), (6, "http://[bad", ""), (None, "http://n.example.com", BIG),
    (7, "http://a.example.com:8080/y", "line\r\n\r\n"), (8, "https://a.example.com", BIG + "!"),
]


def expected(rows):
    result = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        largest = max(same) if len(data) >= 1000 and same and sum((h or "").encode() == data for _, _, h in rows) > 1 else None
        revisit = largest is not None and page != largest
        result.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", largest if revisit else None))
    return sorted(result, key=repr)


def answered(index):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in index), key=repr)


def test_odd_pages_round_trip(spark):
    index = warc.archive_and_index(pages(spark, ROWS), settings=warc.ArchiveSettings(archive_bytes=4_000, run_rows=3, range_rows=4))
    rows = index.orderBy("index_range", "index_position").collect()
    assert answered(rows) == expected(ROWS)
    order = [warc.order_key((r["url_key"], r["captured"], r["archive"], r["offset"])) for r in rows]
    assert order == sorted(order) and len(set(order)) == len(rows)


def test_pages(spark, data):
    table = spark.read.parquet(f"{data}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in table.collect()]
    assert answered(warc.archive_and_index(table).collect()) == expected(rows)


def test_hot_payload_and_url(spark):
    rows = [(i, "http://hot.example.com/", BIG if i % 3 else f"page {i}") for i in range(400)]
    index = warc.archive_and_index(pages(spark, rows), settings=warc.ArchiveSettings(run_rows=40, range_rows=50))
    assert answered(index.collect()) == expected(rows)
    assert index.select("index_range").distinct().count() > 4  # one URL, several ranges


def test_ranges_beyond_the_first_cuts_are_cut_again(spark):
    random.seed(3)
    rows = [(i, random.choice(["http://hot.example.com/", f"http://h{i % 30}.example.com/{i}", None]), BIG if i % 4 else None) for i in range(300)]
    settings = warc.ArchiveSettings(run_rows=25, range_rows=10, most_ranges=3)
    index = warc.archive_and_index(pages(spark, rows), settings=settings).orderBy("index_range", "index_position").collect()
    assert answered(index) == expected(rows)
    order = [warc.order_key((r["url_key"], r["captured"], r["archive"], r["offset"])) for r in index]
    assert order == sorted(order)
    sizes = Counter(r["index_range"] for r in index)
    assert len(sizes) > 10 and max(sizes.values()) < 60


def test_payloads_that_no_other_capture_has_are_not_shuffled(spark):
    rows = [(i, "http://a.example.com/", f"{i}" * 400 if i % 10 else BIG if i < 50 else None) for i in range(200)]
    captures = spark.createDataFrame([(i, u, h or "", None) for i, u, h in rows], "key long, url string, payload string, captured timestamp")
    decided = warc._decided(captures, warc.ArchiveSettings())
    assert decided.count() == 200 and decided.filter("refers is not null").count() == 4
    plan = decided._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" in plan


def test_empty_table(spark):
    assert warc.archive_and_index(pages(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(15))
def test_loser_tree_merges(seed):
    random.seed(seed)
    runs = [sorted((random.randint(0, 9), i, j) for j in range(random.randint(0, 8))) for i in range(random.randint(0, 9))]
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_damaged_payload_is_noticed(spark):
    path = staged_path(spark, "archive")
    warc.write_archives(pages(spark, [(1, "http://a.example.com", "hello")]), path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()
    content = b"".join(gzip.decompress(bytes(f["content"])) for f in files)
    assert len(list(warc.parse_archive("a", content))) == 1
    with pytest.raises(ValueError, match="payload"):
        list(warc.parse_archive("a", content.replace(b"hello", b"hellO")))


def test_url_key():
    assert warc.url_key("https://WWW.Example.com:443/a?b#c") == "com,example,www)/a?b"
    assert warc.url_key("http://example.com:81") == "com,example:81)/"
