import hashlib

import pytest

from profitlens.llm import sharding
from tests.llm.odd import LONG, documents, nothing


def bits(key, text):
    name = hashlib.md5(f"{'' if key is None else key}:{text or ''}".encode()).hexdigest()
    return f"{int(name[:15], 16):060b}"


def split(rows, limit, shard=""):
    """Splits as long as a bucket is too large and bits tell its rows apart."""
    if sum(r[1] for r in rows) <= limit or len({r[2] for r in rows}) == 1:
        return {(r[0], r[1]): shard for r in rows}
    found = {}
    for bit in "01":
        found |= split([r for r in rows if r[2][len(shard)] == bit], limit, shard + bit)
    return found


@pytest.mark.parametrize("limit", [1_000, 20_000, 100_000, 1 << 30])
def test_shallowest_prefix_that_fits(spark, data, limit):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r["doc_id"], len(r["text"].encode()), bits(r["doc_id"], r["text"])) for r in docs.collect()]
    found = {(r["doc_id"], r["n_bytes"]): r["shard"] for r in sharding.assign(docs, limit).collect()}
    assert found == split(rows, limit)


def test_equal_rows_are_cut_into_parts(spark):
    rows = [(1, "x" * 100, "en", "a")] * 50 + [(2, "y" * 30, "en", "a")] * 3 + [(None, f"text {i}", "en", "a") for i in range(40)]
    found = sharding.assign(documents(spark, rows), 250).collect()
    assert len(found) == len(rows)
    size = {}
    for r in found:
        place = (r["shard"], r["part"])
        size[place] = size.get(place, 0) + r["n_bytes"]
    assert max(size.values()) <= 250
    assert len({r["part"] for r in found if r["doc_id"] == 1}) == 25


def test_odd_rows(spark):
    docs = documents(spark)
    found = sharding.assign(docs, 60).collect()
    assert len(found) == docs.count()
    assert {r["n_bytes"] for r in found if r["doc_id"] in (2, 3)} == {0}
    long = [r for r in found if r["doc_id"] == 4]
    assert [r["n_bytes"] for r in long] == [len(LONG)] * 2 and {r["part"] for r in long} == {0, 1}


def test_empty_table(spark):
    assert sharding.assign(nothing(spark), 100).count() == 0


def test_no_python_runs(spark, data):
    plan = sharding.assign(spark.read.parquet(f"{data}/documents.parquet"), 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
