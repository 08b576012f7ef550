"""Keyed tables: results of the snapshot operators, and files of untouched buckets left alone."""

import os

import pytest

from brewlens.operators import keyed as KT
from brewlens.operators import upsert as U

ROWS = [(k, f"name {k}", float(k), None) for k in range(400)]
SCHEMA = "id long, name string, score double, tag string"


def files(path):
    return {(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{path}/data") for f in names
            if f.endswith(".parquet")}


def bucket_of(key):
    return int(os.path.basename(key[0]).split("=")[1])


def content(df):
    return sorted(map(tuple, df.select("id", "name", "score", "tag").collect()))


@pytest.fixture
def table(spark, tmp_path):
    return KT.KeyedTable.create(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "t"), ["id"], buckets=32)


def test_upsert_equals_the_snapshot_and_leaves_other_buckets(spark, table):
    upd = spark.createDataFrame([(3, "new 3", 0.5, "a"), (3, "newer 3", 0.7, "b"), (999, "fresh", 9.0, "c")], SCHEMA)
    before, stored = files(table.path), spark.createDataFrame(ROWS, SCHEMA)
    want = content(U.upsert(stored, upd, ["id"], ["name", "score"], ["score"]))
    touched = table.upsert_into(upd, ["name", "score"], ["score"])
    assert 1 <= len(touched) <= 2 and content(table.read()) == want
    after = files(table.path)
    for f, changed in before.items():
        if bucket_of(f) not in touched:
            assert after[f] == changed
    assert {f for f in after if bucket_of(f) not in touched} == {f for f in before if bucket_of(f) not in touched}
    # again, from another opening: nothing changes
    again = KT.KeyedTable(spark, table.path)
    assert again.buckets == 32 and again.keys == ["id"]
    again.upsert_into(upd, ["name", "score"], ["score"])
    assert content(again.read()) == want


def test_layout_outlives_the_session_settings(spark, table):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 3)
    try:
        other = KT.KeyedTable(spark, table.path)
        assert other.insert_ignore_into(spark.createDataFrame(ROWS, SCHEMA)) == 0
        assert other.read().count() == 400
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_insert_ignore_appends_only_new_keys(spark, table):
    batch = spark.createDataFrame([(5, "known", 0.0, None), (500, "b", 1.0, None), (500, "a", 0.0, None)], SCHEMA)
    before = files(table.path)
    assert table.insert_ignore_into(batch, ["score"]) == 1
    after = files(table.path)
    assert before.items() <= after.items() and len(after) == len(before) + 1
    assert (500, "a", 0.0, None) in content(table.read()) and (5, "name 5", 5.0, None) in content(table.read())
    assert table.insert_ignore_into(batch, ["score"]) == 0 and files(table.path) == after


def test_update_from_ignores_unknown_keys(spark, table):
    before = files(table.path)
    upd = spark.createDataFrame([(7, "t7"), (7000, "nobody")], "id long, tag string")
    touched = table.update_into(upd, ["tag"])
    assert len(touched) == 1 and table.read().where("tag = 't7'").count() == 1 and table.read().count() == 400
    assert sum(files(table.path).get(f) == t for f, t in before.items()) == len(before) - 1
    assert table.update_into(spark.createDataFrame([(9000, "x")], "id long, tag string"), ["tag"]) == []


def test_a_hot_key_in_the_batch_is_folded(spark, table):
    batch = spark.range(20_000).selectExpr("CASE WHEN id % 3 = 0 THEN 11 ELSE id END AS id", "concat('n', id) AS name",
                                           "double(id) AS score", "string(null) AS tag")
    table.upsert_into(batch, ["name", "score"], ["score"])
    got = {r["id"]: r["score"] for r in table.read().collect()}
    assert got[11] == 19_998.0 and len(got) == table.read().count()


def test_empty_batch_null_and_repeated_keys(spark, table):
    before = files(table.path)
    empty = spark.createDataFrame([], SCHEMA)
    assert table.upsert_into(empty, ["name"]) == [] and table.insert_ignore_into(empty) == 0 and files(table.path) == before
    with pytest.raises(ValueError, match="without a key"):
        table.upsert_into(spark.createDataFrame([(None, "x", 1.0, None)], SCHEMA), ["name"])
    with pytest.raises(ValueError, match="not unique"):
        KT.KeyedTable.create(spark.createDataFrame([ROWS[0], ROWS[0]], SCHEMA), table.path + "-twice", ["id"], 4)
    assert files(table.path) == before


def test_only_touched_buckets_are_read(spark, table):
    plan = table._stored([1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_bucket" in plan
