from __future__ import annotations

import datetime as dt
import random
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from inkwell.operators.dedup import first_copy
from inkwell.operators.joins import heavy_keys, lookup
from inkwell.operators.medians import exact_medians
from inkwell.operators.ordered import day_bucket, running, sessionise, slice_starts
from inkwell.operators.spine import as_of_counts, day_range
from tests.rows import DAY, SECOND
from tests.test_plans import plan


def _hits(spark, hot_share=0.4, n=4000):
    """Hits of many clients, one of which has a large share; some moments are equal."""
    chance = random.Random(7)
    rows = []
    for i in range(n):
        client = "hot" if chance.random() < hot_share else f"c{chance.randrange(200)}"
        at = chance.randrange(20 * 24 * 60) * 60 * SECOND
        value = chance.randrange(1000) if chance.random() < 0.3 else None
        rows.append((client, at, i, value))
    return spark.createDataFrame(rows, "client string, at long, id long, value long")


def test_running_equals_one_window_per_key(spark):
    hits = _hits(spark)
    order = ["at", "id"]
    whole = Window.partitionBy("client").orderBy(*order)
    up_to = whole.rowsBetween(Window.unboundedPreceding, 0)
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    expected = hits.select(
        "id",
        F.last("value", ignorenulls=True).over(before).alias("seen"),
        F.last("value", ignorenulls=True).over(up_to).alias("now"),
        F.sum(F.coalesce("value", F.lit(1))).over(up_to).alias("sum"),
    )
    value = F.col("value")
    actual = running(
        hits,
        ["client"],
        day_bucket("at"),
        order,
        latest_before={"seen": value},
        latest={"now": value},
        total={"sum": F.coalesce(value, F.lit(1))},
    ).select("id", "seen", "now", "sum")
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()
    assert actual.count() == hits.count()


def test_greatest_counts_rows_of_the_same_moment(spark):
    hits = _hits(spark)
    peers = Window.partitionBy("client").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    pair = F.when(F.col("value").isNotNull(), F.struct("at", "id", "value"))
    expected = hits.select("id", F.max(pair).over(peers).alias("best"))
    actual = running(hits, ["client"], day_bucket("at"), ["at"], greatest={"best": pair}).select("id", "best")
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()


def test_greatest_of_falling_values_is_carried(spark):
    falling = [("c", n * DAY + m * SECOND, 100 - 10 * n - m) for n in range(4) for m in range(3)]
    hits = spark.createDataFrame(falling + [("c", 5 * DAY, None)], "client string, at long, value long")
    best = running(hits, ["client"], day_bucket("at"), ["at"], greatest={"best": F.col("value")})
    assert {r.best for r in best.collect()} == {100}


def test_a_pause_of_exactly_the_gap_stays_in_the_session(spark):
    gap = 30 * 60 * SECOND
    times = [0, gap, 2 * gap + 1, 2 * gap + 2, DAY, DAY + gap]
    hits = spark.createDataFrame([("u", t) for t in times], "user string, at long")
    visits = sessionise(hits, "user", "at").orderBy("at").collect()
    assert [v.session_number for v in visits] == [1, 1, 2, 2, 3, 3]
    assert [v.session_first_micros for v in visits] == [0, 0, 2 * gap + 1, 2 * gap + 1, DAY, DAY]
    assert [v.opens_session for v in visits] == [True, False, True, False, True, False]


def test_first_copy_keeps_one_row_of_a_hot_identity(spark):
    rows = [("same", None, i) for i in range(500)] + [(f"k{i}", "x", i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, n string, i long").repartition(8)
    kept = first_copy(df, ["k", "n"], [F.col("i").asc()])
    assert kept.count() == 51
    assert kept.filter("k = 'same'").first().i == 0


def test_lookup_keeps_rows_without_a_key(spark):
    facts = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "id long, k string")
    table = spark.createDataFrame([("a", 10)], "k string, v long")
    found = lookup(facts, table, "k", ["id"])
    assert sorted(map(tuple, found.select("id", "k", "v").collect()), key=lambda r: r[0]) == [
        (1, "a", 10),
        (2, None, None),
        (3, "b", None),
        (4, None, None),
    ]


def test_lookup_without_broadcast_gives_the_same(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit(5)).alias("k"))
        table = spark.createDataFrame([(5, 10)], "k int, v long")
        found = lookup(facts, table, "k", ["id"])
        assert found.count() == 1000
        assert found.filter("v = 10").count() == 334
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_as_of_counts_can_fall_and_include_earlier_dates(spark):
    day = dt.date
    events = spark.createDataFrame([(day(2024, 1, 3),), (day(2024, 1, 6),)], "event_date_dt date")
    people = spark.createDataFrame(
        [
            (day(2023, 12, 1), day(2024, 1, 5)),
            (day(2024, 1, 4), None),
            (day(2024, 1, 9), None),
            (None, None),
        ],
        "start date, stop date",
    )
    counts = as_of_counts(day_range(events), people, {"started": F.col("start"), "stopped": F.col("stop")})
    assert [tuple(r) for r in counts.orderBy("as_of_date").collect()] == [
        (day(2024, 1, 3), 1, 0),
        (day(2024, 1, 4), 2, 0),
        (day(2024, 1, 5), 2, 1),
        (day(2024, 1, 6), 2, 1),
    ]


def _whole_visits(hits, gap):
    """Visits by one window per user."""
    order = Window.partitionBy("user").orderBy("at", "id")
    opens = F.coalesce(F.col("at") - F.lag("at").over(order) > gap, F.lit(True))
    marked = hits.withColumn("opens_session", opens)
    return marked.select(
        "id",
        F.last(F.when(F.col("opens_session"), F.col("at")), ignorenulls=True).over(order).alias("session_first_micros"),
        F.count_if("opens_session").over(order).alias("session_number"),
        "opens_session",
        F.last("value", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("seen"),
        F.sum("id").over(order).alias("sum"),
    )


def _crowded_day(spark, n=6000):
    """One user has 90 % of the rows of a day, half of them within a minute; others go over midnight."""
    chance = random.Random(3)
    rows = []
    for i in range(n):
        if chance.random() < 0.9:
            at = 5 * DAY + (chance.randrange(60) if chance.random() < 0.5 else chance.randrange(24 * 3600)) * SECOND
            rows.append(("hot", at, i, i if i % 7 == 0 else None))
        else:
            rows.append((f"u{i % 40}", 5 * DAY + chance.randrange(-7200, 30 * 3600) * SECOND, i, None))
    return spark.createDataFrame(rows, "user string, at long, id long, value long")


def test_crowded_days_are_cut_into_slices(spark):
    hits, gap = _crowded_day(spark), 90 * SECOND
    visits = sessionise(
        hits, "user", "at", gap_micros=gap, tie_breakers=["id"],
        latest_before={"seen": F.col("value")}, total={"sum": F.col("id")}, slice_rows=300,
    )
    actual, expected = visits.drop("user", "at", "value"), _whole_visits(hits, gap)
    actual = actual.select(*expected.columns)
    assert actual.exceptAll(expected).isEmpty() and expected.exceptAll(actual).isEmpty()
    # A slice is a group of the window, and so the most that one task has to take.
    tagged = hits.withColumn("_bucket", day_bucket("at"))
    starts = slice_starts(tagged, ["user"], "at", 300)
    (hot,) = starts.collect()
    cut = tagged.where("user = 'hot'").withColumn("s", F.size(F.filter(F.lit(hot["_starts"]), lambda x: x <= F.col("at"))))
    most = cut.where(F.col("_bucket") == hot["_bucket"]).groupBy("s").count().agg(F.max("count")).first()[0]
    assert hot["user"] == "hot" and most <= 2 * 300


def test_a_pause_over_midnight_and_over_slices(spark):
    gap = 30 * 60 * SECOND
    times = [DAY - 60 * SECOND, DAY + 60 * SECOND, DAY + gap + 61 * SECOND, *[2 * DAY + n * SECOND for n in range(50)]]
    hits = spark.createDataFrame([("u", t, i, None) for i, t in enumerate(times)], "user string, at long, id long, value long")
    expected = _whole_visits(hits, gap)
    for rows in (4, 1000):
        visits = sessionise(hits, "user", "at", gap_micros=gap, tie_breakers=["id"], slice_rows=rows)
        actual = visits.select("id", "session_first_micros", "session_number", "opens_session")
        assert actual.exceptAll(expected.select(*actual.columns)).isEmpty()
    assert sessionise(hits.limit(0), "user", "at").count() == 0


def test_running_values_read_and_shuffle_the_rows_once(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hits = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
            "user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), "event_type"
        ).where("user_id is not null")
        tree = plan(sessionise(hits, "user_id", "micros", tie_breakers=["event_id"])).split("\n\n")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(re.findall(r"Scan parquet", tree)) == 1
    assert len(re.findall(r"- Exchange|Exchange \(", tree)) <= 4


def test_frequent_keys_are_joined_apart(spark):
    """With broadcasts and adaptive execution off, a key with half of the facts meets its row in all tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id"))
        facts = spark.range(4000).select("id", key.cast("int").alias("k"))
        table = spark.range(3000).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
        heavy = heavy_keys(facts, "k")
        assert [r.k for r in heavy.collect()] == [7]
        found = lookup(facts, table, "k", ["id"], heavy)
        expected = facts.join(table, "k", "left").select("id", "k", "v")
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 4000 * 0.25
        by_bytes = lookup(
            facts.withColumn("k", F.col("k").cast("string").cast("binary")),
            table.withColumn("k", F.col("k").cast("string").cast("binary")), "k", ["id"],
        )
        assert by_bytes.where("v is not null").count() == expected.where("v is not null").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_exact_medians_of_any_column(spark):
    chance = random.Random(1)
    rows = [
        (chance.randrange(1_700_000_000_000_000, 1_800_000_000_000_000), chance.gauss(0, 1e-3), chance.choice([3, 3, 3, 8]), None)
        for _ in range(3001)
    ]
    rows += [(2**62, float("1e300"), None, None), (-(2**62), -1e300, 9, None), (5, 0.0, 9, None)]
    df = spark.createDataFrame(rows, "micros long, x double, few int, none long").repartition(4)
    names = df.columns
    for part in (df, df.limit(1), df.limit(2), df.limit(0), df.where("few = 3")):
        rows = part.collect()
        found = exact_medians(spark.createDataFrame(rows, df.schema), names).first()
        for name in names:
            values = sorted(r[name] for r in rows if r[name] is not None)
            middle = values[(len(values) - 1) // 2 : len(values) // 2 + 1]
            assert found[name] == (sum(map(float, middle)) / len(middle) if middle else None), name


def test_medians_group_only_by_bins(spark):
    """No task gathers values: each job of the search returns a thousand groups at most."""
    hits = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("x"))
    assert exact_medians(hits, ["x"]).first().x == hits.agg(F.percentile("x", 0.5)).first()[0]
