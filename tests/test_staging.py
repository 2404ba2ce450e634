from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import derived
from inkwell.config import EngineConfig, Parameter
from inkwell.functions.params import param
from inkwell.plans import staging
from inkwell.plans.sessions import session_days
from tests.rows import export, hit, micros, staged


def test_copies_with_reordered_parameters_are_one_hit(spark):
    first = hit("page_view", "2024-01-01T10:00:00", page_location="https://a.b/c")
    again = first | {"event_params": first["event_params"][::-1], "batch_ordering_id": 10**9}
    other = hit("page_view", "2024-01-01T10:00:00", page_location="https://a.b/d")
    kept = staging.base_events(export(spark, [again, first, other]), EngineConfig()).collect()
    assert sorted(r.page_location for r in kept) == ["https://a.b/c", "https://a.b/d"]
    assert 10**9 not in [r.batch_ordering_id for r in kept]


def test_copies_without_a_client_are_one_hit(spark):
    row = hit("scroll", "2024-01-01T10:00:00", client=None)
    assert staged(spark, [row, dict(row)]).count() == 1


def test_only_possible_copies_are_shuffled(spark):
    moments = [micros(f"2024-01-01T10:{n % 60:02d}:00") for n in range(120)]
    rows = [hit("scroll", at, client=f"c{n}", n=n) for n, at in enumerate(moments)]
    rows += [dict(rows[7]), rows[8] | {"event_params": rows[9]["event_params"]}]
    spread = export(spark, rows).repartition(4).withColumn("batch_event_index", F.spark_partition_id().cast("bigint"))
    base = staging.base_events(spread, EngineConfig())
    at = base.select("batch_ordering_id", "batch_event_index", F.spark_partition_id().alias("task")).collect()
    assert len(at) == 121
    stayed = [r for r in at if r.batch_ordering_id not in (rows[7]["batch_ordering_id"], rows[8]["batch_ordering_id"])]
    assert len(stayed) == 118 and all(r.task == r.batch_event_index for r in stayed)


def test_hits_of_one_moment_that_are_no_copies_stay_where_they_were_read(spark):
    rows = [hit("scroll", "2024-01-01T10:00:00", n=n) for n in range(80)]
    rows += [dict(rows[7])]
    spread = export(spark, rows).repartition(4).withColumn("batch_event_index", F.spark_partition_id().cast("bigint"))
    base = staging.base_events(spread, EngineConfig())
    at = base.select("batch_ordering_id", "batch_event_index", F.spark_partition_id().alias("task")).collect()
    stayed = [r for r in at if r.batch_ordering_id != rows[7]["batch_ordering_id"]]
    assert len(at) == 80 and len(stayed) == 79 and all(r.task == r.batch_event_index for r in stayed)


def test_rows_that_are_left_out_share_no_mark(spark):
    rows = spark.createDataFrame([(1, 1, True), (2, 1, True), (3, 1, False), (4, 2, False), (5, 3, True)], "id int, mark long, asked boolean")
    for most, shared in ((1, {1, 2}), (0, {1, 2, 5})):
        found = staging.with_shared_marks(rows, F.xxhash64("mark"), most, F.col("asked")).collect()
        assert len(found) == 5 and {r.id for r in found if r._shared} == shared


def test_with_too_many_marks_all_rows_share_theirs(spark):
    rows = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, None)], "id int, mark long")
    mark = F.xxhash64("mark")
    for most, shared in ((2, {1, 2, 3, 4}), (1, {1, 2, 3, 4, 5, 6})):
        found = staging.with_shared_marks(rows, mark, most).collect()
        assert len(found) == 6 and {r.id for r in found if r._shared} == shared


def test_start_date_and_names(spark):
    rows = [hit(" Page View ", "2024-01-02T00:00:00"), hit("page_view", "2024-01-01T00:00:00")]
    base = staging.base_events(export(spark, rows), EngineConfig(start_date="20240102", property_id=7))
    row = base.first()
    assert base.count() == 1
    # The flag compares the name as it was sent.
    assert (row.event_name, row.is_page_view, row.property_id) == ("page_view", 0, 7)


def test_keys_are_null_without_consent(spark):
    rows = staged(
        spark,
        [hit("scroll", "2024-01-01T10:00:00", client=None), hit("scroll", "2024-01-01T10:00:00", session=None)],
    )
    denied = rows.filter("user_pseudo_id is null").first()
    known = rows.filter("user_pseudo_id is not null").first()
    assert denied.client_key is None and denied.session_key is None and denied.session_partition_key is None
    assert denied.event_key is not None and denied.page_key is None
    # A missing session id counts as session 0 and still gives keys.
    assert known.session_id == 0 and known.session_partition_key.endswith("2024-01-01")
    keys = rows.select(F.md5(F.lit("c1s")).alias("k")).first().k
    assert known.client_key == keys


def test_exclusions_apply_after_the_path(spark):
    url = "https://www.a.b/p?id=1&x=2"
    row = staged(
        spark,
        [hit("page_view", "2024-01-01T10:00:00", page_location=url)],
        EngineConfig(query_parameter_exclusions=("id",)),
    ).first()
    assert row.page_location == "https://www.a.b/p&x=2" and row.original_page_location == url
    assert row.page_path == "/p" and row.page_hostname == "a.b" and row.page_query_string is None
    assert row.page_key == "2024-01-01https://www.a.b/p&x=2"


def test_custom_and_default_parameters(spark):
    config = EngineConfig(
        default_parameters=(Parameter("color"),),
        event_parameters={"quiz": (Parameter("score", "int", "points"),)},
    )
    rows = staged(spark, [hit("quiz", "2024-01-01T10:00:00", color="red", score=3), hit("scroll", "2024-01-01T10:00:00")])
    row = staging.custom_event(rows, "quiz", [], config).first()
    assert (row.color, row.points) == ("red", 3)
    assert staging.event_type(rows, "scroll", config).count() == 1


def test_conversions_decide_the_columns(spark):
    config = EngineConfig(conversion_events=("sign-up", "4th"))
    rows = staged(spark, [hit("sign-up", "2024-01-01T10:00:00"), hit("4th", "2024-01-01T10:00:01")])
    day = session_days(rows, config).first()
    assert (day["sign_up_count"], day["_4th_count"]) == (1, 1)


def test_hits_are_shuffled_once_to_be_sessionised(spark, tmp_path):
    """Rows and the states carried between them come from one exchange; pages are put together after it."""
    moments = [("2024-01-01 10:00:00", 7), ("2024-01-01 10:05:00", None), ("2024-01-01 10:09:00", 11), ("2024-01-02 10:00:00", 20)]
    rows = [(n, 3, at, "view", f'{{"k": {k}}}' if k is not None else "{}") for n, (at, k) in enumerate(moments, 1)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    documents = spark.range(100).withColumnRenamed("id", "doc_id")
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    hits = derived.user_hits(spark, str(tmp_path))
    seen = [(r.article, r.k, r.page_before and tuple(r.page_before)) for r in hits.orderBy("micros").collect()]
    assert seen == [(14, 7, None), (None, None, (14, 7)), (32, 11, (14, 7)), (48, 20, None)]
    hits.collect()
    assert "ReusedExchange" in hits._jdf.queryExecution().executedPlan().toString()
    pages = derived.events(spark, str(tmp_path)).where("event_name = 'page_view'").orderBy("event_timestamp")
    location, referrer = (param(F.col("event_params"), n) for n in ("page_location", "page_referrer"))
    at = derived.ARTICLE_PAGE
    assert [tuple(r) for r in pages.select(location, referrer).collect()] == [
        (f"{at}14", None), (None, f"{at}14"), (f"{at}32?utm_source=x&id=7#top", f"{at}14"), (f"{at}48?gclid=g20", None),
    ]
