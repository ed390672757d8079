"""The skew-safe forms give the same rows as the plain ones."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from worklens.functions.times import hundredths
from worklens.operators.history import history_rollup, stage_visits
from worklens.operators.skew import (
    SLOTS, heavy_keys, hot_keys, ordered_history, skew_join, slotted,
)


@pytest.fixture(scope="module")
def events(spark):
    """One key owns a third of the rows; times tie, one is missing, minutes are crossed."""
    random.seed(7)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else f"k{random.randrange(120)}"
        moment = datetime(2026, 1, 1) + timedelta(seconds=random.randrange(0, 600) // 7 * 7)
        rows.append((f"{i:06d}", key, random.choice(["a", "b", None]), moment))
    rows.append(("900000", "hot", "c", None))
    return spark.createDataFrame(rows, "id string, key string, stage string, ts timestamp").cache()


def plain(df):
    w = Window.partitionBy("key").orderBy("ts", "id")
    return df.withColumns({
        "n": F.row_number().over(w).cast("bigint"), "next_stage": F.lead("stage").over(w),
        "next_ts": F.lead("ts").over(w), "prior": F.lag("stage").over(w),
    })


@pytest.mark.parametrize("hot_rows", [1, 5, 50, 10_000, None])
def test_ordered_history_equals_plain_window(events, hot_rows):
    ours = ordered_history(
        events, "key", ["ts", "id"], number="n",
        following={"next_stage": "stage", "next_ts": "ts"}, preceding={"prior": "stage"},
        hot_rows=hot_rows)
    expected = plain(events)
    columns = expected.columns
    assert sorted(map(repr, ours.select(columns).collect())) == sorted(
        map(repr, expected.collect()))


def agrees(ours, expected):
    assert sorted(map(repr, ours.select(expected.columns).collect())) == sorted(
        map(repr, expected.collect()))


def by_id(df, hot_rows):
    w = Window.partitionBy("key").orderBy("id")
    expected = df.withColumns(
        {"n": F.row_number().over(w).cast("bigint"), "prior": F.lag("stage").over(w)})
    agrees(ordered_history(df, "key", ["id"], number="n", preceding={"prior": "stage"},
                           hot_rows=hot_rows), expected)


@pytest.mark.parametrize("hot_rows", [1, 4, 100])
def test_history_by_id(events, hot_rows):
    by_id(events, hot_rows)


def largest_slot(df, order, hot_rows):
    sizes = [r["count"] for r in slotted(df, "key", order, hot_rows).where("key = 'hot'")
             .groupBy("_slot").count().collect()]
    return max(sizes), len(sizes)


def test_one_instant_and_unpadded_ids(spark):
    """A bulk import with one time, and ids whose length differs: slots stay within twice hot_rows."""
    n, hot_rows = 200_000, 5000
    df = spark.range(1, n + 1).select(
        F.concat(F.lit("EVT-"), (F.col("id") * F.when(F.col("id") % 3 == 0, 1).otherwise(971)))
        .alias("id"),
        F.when(F.col("id") % 5 == 0, F.concat(F.lit("k"), F.col("id") % 1000)).otherwise("hot")
        .alias("key"),
        F.when(F.col("id") % 7 == 0, "b").otherwise("a").alias("stage"),
        F.lit("2026-01-01 00:00:00").cast("timestamp").alias("ts")).cache()
    for order in (["ts", "id"], ["id"]):
        most, slots = largest_slot(df, order, hot_rows)
        assert most <= 2 * hot_rows and slots >= 32
    by_id(df, hot_rows)
    agrees(ordered_history(df, "key", ["ts", "id"], number="n",
                           following={"next_stage": "stage", "next_ts": "ts"},
                           preceding={"prior": "stage"}, hot_rows=hot_rows), plain(df))
    one_short = df.unionByName(spark.createDataFrame([("E", "hot", "a", None)], df.schema))
    assert largest_slot(one_short, ["id"], hot_rows)[0] <= 2 * hot_rows


def test_slots_are_bounded(spark):
    """A key of more than SLOTS parts: no more slots than that, in order."""
    df = spark.range(5000).select(
        F.lit("hot").alias("key"), F.col("id").cast("string").alias("id"), F.lit("a").alias("stage"))
    cut = slotted(df, "key", ["id"], 2)
    assert cut.select("_slot").distinct().count() == SLOTS
    ends = cut.groupBy("_slot").agg(F.min("id").alias("low"), F.max("id").alias("high")).orderBy(
        "_slot").collect()
    assert all(a["high"] < b["low"] for a, b in zip(ends, ends[1:]))
    by_id(df, 2)


def test_heavy_keys_of_several_columns(spark, events):
    """One aggregation finds each column's hot keys, NULL too, and its type; at most so many."""
    df = events.withColumn("code", F.when(F.col("key") == "hot", None).otherwise(
        F.length("id") + F.col("id").cast("int") % 2))
    found = heavy_keys(df, ["key", "code", "id"], 100)
    assert [tuple(r) for r in found["key"].collect()] == [("hot", 4)]
    assert {tuple(r) for r in found["code"].collect()} == {(None, 4), (6, 3), (7, 3)}
    assert found["code"].schema["_hot_key"].dataType == df.schema["code"].dataType
    assert found["id"] is None
    assert heavy_keys(df, ["code"], 100, most=1)["code"].collect()[0]["_hot_key"] is None


def test_plain_join_where_nothing_is_hot(spark, events):
    one = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, v int")
    text = skew_join(events, one, "key", "left", ["id"])._jdf.queryExecution().toString()
    assert "_salt" not in text and "_parts" not in text
    assert "_salt" in skew_join(events, one, "key", "left", ["id"], 100)._jdf.queryExecution().toString()


def test_hot_keys_are_counted(events):
    found = {r["_hot_key"]: r["_parts"] for r in hot_keys(events, "key", 100).collect()}
    assert found == {"hot": 4}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [3, 10_000])
def test_skew_join_equals_join(spark, events, how, hot_rows):
    with_nulls = events.withColumn("key", F.when(F.col("id") % 7 != 0, F.col("key")))
    one = events.select("key").distinct().where("key <> 'k5'").withColumn(
        "owner", F.concat(F.lit("o-"), "key"))
    expected = with_nulls.join(one, "key", how)
    ours = skew_join(with_nulls, one, "key", how, ["id"], hot_rows)
    assert sorted(map(repr, ours.select(expected.columns).collect())) == sorted(
        map(repr, expected.collect()))


def test_hot_history_gives_the_same_rollup(spark, events):
    moves = events.where("ts is not null").select(
        "id", F.col("key").alias("tarefa_id"),
        F.when(F.col("stage") == "a", "Fazendo").otherwise("Impedido").alias("etapa_nova"),
        F.lit("u").alias("usuario_id"), F.col("ts").alias("ocorrido_em"))
    ref = F.lit("2026-01-02").cast("date")
    results = [
        sorted(map(repr, history_rollup(stage_visits(moves, ref, hot_rows=n)).collect()))
        for n in (5, None)
    ]
    assert results[0] == results[1]


def test_hundredths_of_null(spark):
    assert spark.range(1).select(hundredths(F.lit(None).cast("bigint"))).first()[0] is None
