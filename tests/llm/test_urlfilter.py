import random
import re

import pytest
from pyspark.sql import functions as F

from profitlens.llm import queries, urlfilter

SCHEMA = "page_id long, url string, host string, `key` string, best string, `a.b` string"


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "h", "k", "b", "x") for i, u in urls], SCHEMA).repartition(3)


def rule_frame(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def plain(urls, rules, default="allow"):
    """Each url against each rule."""
    low = str.maketrans(urlfilter.UPPER, urlfilter.LOWER)
    found = []
    for i, url in urls:
        host = path = ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            end = re.search(r"[/?#]|\Z", rest).start()
            host, path = rest[:end].translate(low), re.match(r"[^?#]*", rest[end:])[0]
        fitting = []
        for h, p, verdict in rules:
            if h is None or re.search("[/?#]", h):
                continue
            h, p = h.translate(low), p or ""
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                fitting.append((len(h + p), h.count("."), verdict == "block", h + p))
        best = max(fitting, default=None)
        found.append((i, host, path, best and best[3], default if best is None else "block" if best[2] else "allow"))
    return sorted(found, key=repr)


URLS = [
    (0, "https://Example.ORG/es/1?x#y"), (1, "http://a.b.example.org/en/12"), (2, None), (3, ""), (4, "example.org/es/"), (5, "://"),
    (6, "ftp://org"), (7, "x://notexample.org/es/"), (8, "https://example.org?/es/"), (8, "https://example.org?/es/"), (9, "a://b://c/d"),
    (None, "https://w.com/fr/é"), (10, "https://w.com/de/" + "x" * 50_000), (11, "https://w.com#/de/"), (12, "https://ÉXAMPLE.org/es/"),
    (13, "https://.org/x"), (14, "https://org./x"), (15, "HTTP://user@example.org:80/es/"), (16, "https://example.org/es\n/q"),
]
RULES = [
    ("org", "/", "allow"), ("Example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
    ("com", "/de/", "allow"), ("", "/x", "block"), (None, "/", "block"), ("b/c", "", "block"), ("c", None, "block"), ("com", "/de/", "block"),
]


def test_odd_urls(spark):
    found = urlfilter.judge(frame(spark, URLS), rule_frame(spark, RULES))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain(URLS, RULES)


@pytest.mark.parametrize("settings", [
    urlfilter.CascadeSettings(), urlfilter.CascadeSettings(filter_words=4, shapes_a_pass=2), urlfilter.CascadeSettings(default="block"),
])
def test_many_rules(spark, settings):
    random.seed(3)
    hosts = [".".join(random.choice("abcde") for _ in range(random.randint(1, 3))) for _ in range(60)]
    paths = ["/" + "".join(random.choice("xy/") for _ in range(random.randint(0, 3))) for _ in range(40)]
    urls = [(i, f"s://{random.choice(hosts)}{random.choice(paths)}{random.choice(['', '?q', 'x'])}") for i in range(300)]
    rules = [(random.choice(hosts), random.choice(paths), random.choice(["allow", "block"])) for _ in range(30)]
    found = urlfilter.judge(frame(spark, urls), rule_frame(spark, rules), settings=settings)
    assert sorted(map(tuple, found.collect()), key=repr) == plain(urls, rules, settings.default)


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(20_000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 40 == 0).alias("listed")).cache()
    levels = urlfilter.cascade(universe, 500, 19_500)
    assert len(levels) > 1  # one filter alone lets others through
    assert universe.filter(urlfilter.is_listed(levels, F.col("key")) != F.col("listed")).count() == 0
    assert sum(level.size for level in levels) * 64 < 40 * 500
    assert universe.filter(levels[0].holds(F.col("key"))).count() > 500


def test_no_rules_and_no_rows(spark):
    none = rule_frame(spark, [])
    assert {r["verdict"] for r in urlfilter.judge(frame(spark, URLS), none).collect()} == {"allow"}
    assert urlfilter.judge(frame(spark, []), rule_frame(spark, RULES)).count() == 0
    never = urlfilter.judge(frame(spark, URLS), rule_frame(spark, [("nowhere.example", "/", "block")]))
    assert never.filter("rule is not null").count() == 0


def test_main_path_needs_no_join_and_no_python(spark, data):
    plan = queries.op12_url_filter(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan
