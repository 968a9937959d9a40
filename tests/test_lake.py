"""Loads, sinks, the daily run and what is left after failures."""

from __future__ import annotations

import datetime
import time

import pytest
from pyspark.sql import functions as F

from orderloom.__main__ import main
from orderloom.context import RunContext
from orderloom.plans import daily, reports
from orderloom.sources import bronze, catalog
from orderloom.sources.jdbc import JdbcSource, Split
from orderloom.sources.lake import DAY, Lake, balanced
from orderloom.sources.watermarks import Watermarks
from orderloom.streaming.file_ingest import ingest_new_files
from parity import fixtures
from tests.conftest import SF_DIR

UTC = datetime.UTC


def run_on(day: str) -> RunContext:
    return RunContext(datetime.datetime.fromisoformat(f"{day}T02:00:00").replace(tzinfo=UTC), day)


def at(*parts: int) -> datetime.datetime:
    return datetime.datetime(*parts, tzinfo=UTC)


def orders(spark, *rows):
    return spark.createDataFrame(
        [(i, ts and datetime.datetime.fromisoformat(ts)) for i, ts in rows],
        "LineItem_ID bigint, Creation_Time_UTC timestamp",
    )


def load(lake, marks, source, day):
    return bronze.incremental_load(lake, marks, source, "order_items", "creation_time_utc", run_on(day))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def marks(spark, tmp_path):
    return Watermarks(spark, str(tmp_path / "marks"))


def test_two_loads_then_an_empty_one(spark, lake, marks):
    first = [(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00"), (3, None)]
    result = load(lake, marks, orders(spark, *first), "2024-01-03")
    assert result.rows == 2 and marks.get("order_items") == at(2024, 1, 2, 10)
    late = (4, "2024-01-02 09:00:00")
    second = [*first, late, (5, "2024-01-02 11:00:00"), (6, "2024-01-04 00:00:00")]
    result = load(lake, marks, orders(spark, *second), "2024-01-05")
    assert result.rows == 2
    result = load(lake, marks, orders(spark, *second), "2024-01-06")
    assert result.rows == 0 and marks.get("order_items") == at(2024, 1, 4)
    stored = lake.bronze("order_items")
    assert sorted(r["lineitem_id"] for r in stored.collect()) == [1, 2, 5, 6]
    assert {r["pipeline_run_date"] for r in stored.collect()} == {"2024-01-03", "2024-01-05"}
    assert {(r["year"], r["month"], r["day"]) for r in stored.collect()} == {(2024, 1, 1), (2024, 1, 2), (2024, 1, 4)}


def test_failed_check_leaves_the_mark(spark, lake, marks, monkeypatch):
    load(lake, marks, orders(spark, (1, "2024-01-01 10:00:00")), "2024-01-02")
    more = orders(spark, (1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00"))
    with monkeypatch.context() as patched:
        patched.setattr(Lake, "count_run_rows", lambda *_: 0)
        with pytest.raises(bronze.WriteValidationError):
            load(lake, marks, more, "2024-01-03")
    assert marks.get("order_items") == at(2024, 1, 1, 10)
    assert load(lake, marks, more, "2024-01-04").rows == 1
    assert marks.get("order_items") == at(2024, 1, 2, 10)


def test_marks_do_not_move_back(marks):
    marks.advance("t", at(2024, 1, 2))
    with pytest.raises(ValueError):
        marks.advance("t", at(2024, 1, 1))
    assert marks.get("other") is None


def test_marks_hold_in_any_local_time_zone(spark, lake, marks, monkeypatch):
    source = orders(spark, (1, "2024-01-01 10:00:00")).withColumn(
        "Creation_Time_UTC", F.col("Creation_Time_UTC").cast("timestamp_ntz")
    )
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        assert load(lake, marks, source, "2024-01-02").rows == 1
        assert marks.get("order_items") == at(2024, 1, 1, 10)
        later = source.union(source.selectExpr("2L", "Creation_Time_UTC + INTERVAL 1 MINUTE"))
        assert load(lake, marks, later, "2024-01-03").rows == 1
        assert load(lake, marks, later, "2024-01-04").rows == 0
    finally:
        monkeypatch.undo()
        time.tzset()


def test_predicate_reaches_the_source(spark, tmp_path):
    orders(spark, (1, "2024-01-01 10:00:00")).write.parquet(str(tmp_path / "src"))
    batch = bronze.incremental_batch(
        spark.read.parquet(str(tmp_path / "src")),
        "creation_time_utc",
        F.lit(datetime.datetime(2024, 1, 1)),
    )
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(Creation_Time_UTC" in plan


def test_jdbc_options():
    source = JdbcSource("jdbc:example:db", "example.Driver", "user", "secret")
    options = source.options("dbo.order_items", Split("lineitem_id", "0", "100", 8))
    assert options["numPartitions"] == "8" and options["fetchsize"] == "1000"
    assert "partitionColumn" not in source.options("dbo.date_dim")


def sources(spark, until=None):
    items = fixtures.raw_order_items(spark, SF_DIR).filter("creation_time_utc >= TIMESTAMP_NTZ '2001-06-01'")
    if until:
        items = items.filter(F.col("creation_time_utc") <= F.lit(until).cast("timestamp_ntz"))
    return {
        "order_items": items.drop("tie", "ingestion_ts"),
        "order_item_options": fixtures.raw_options(spark, SF_DIR).drop("tie", "ingestion_ts"),
        "date_dim": fixtures.raw_date_dim(spark, SF_DIR),
    }


def test_daily_runs_keep_snapshots_and_repeat_exactly(spark, lake, marks):
    daily.run_daily(lake, marks, sources(spark, "2001-06-30"), run_on("2001-07-01"))
    daily.run_daily(lake, marks, sources(spark), run_on("2001-12-31"))
    assert {r[0] for r in lake.gold("clv").select("snapshot_date").distinct().collect()} == {
        "2001-07-01",
        "2001-12-31",
    }
    latest = lake.latest("clv")
    assert {r[0] for r in latest.select("snapshot_date").distinct().collect()} == {"2001-12-31"}
    assert lake.latest("clv", "2001-07-01").count() == lake.gold("clv").count() - latest.count()
    customers = lake.silver("order_items").filter("user_id IS NOT NULL").select("user_id").distinct().count()
    assert reports.distinct_customers(latest).first()[0] == latest.count() == customers

    before = sorted(map(str, lake.gold("rfm").collect()))
    periods = sorted(map(str, lake.gold("sales_trends_monthly").collect()))
    daily.run_gold(lake, run_on("2001-12-31"))
    assert sorted(map(str, lake.gold("rfm").collect())) == before
    assert sorted(map(str, lake.gold("sales_trends_monthly").collect())) == periods
    for table in daily.gold_tables(lake, run_on("2001-12-31")):
        assert lake.latest(table).count() > 0

    silver = lake.silver("order_items")
    assert silver.count() == silver.select("lineitem_id").distinct().count()
    rejected = lake.rejected("order_items")
    assert {r[0] for r in rejected.select("dq_flag").distinct().collect()} <= {"NULL_LINEITEM_ID", "NULL_ORDER_ID"}
    assert len(spark.read.parquet(lake.path("silver", "date_dim")).inputFiles()) == 1

    name = catalog.register(lake, "gold", "clv", "lake_test_gold")
    assert spark.table(name).count() == lake.gold("clv").count()
    name = catalog.register(lake, "silver", "order_items", "lake_test_silver")
    assert spark.table(name).count() == silver.count()
    assert spark.table(catalog.register(lake, "silver", "date_dim", "lake_test_silver")).count() > 0


def test_one_failing_table_does_not_stop_the_others(lake, marks, spark):
    given = sources(spark, "2001-06-10")
    given["date_dim"] = given["date_dim"].withColumn("boom", F.raise_error(F.lit("broken source")))
    with pytest.raises(daily.StageFailed) as failure:
        daily.run_bronze(lake, marks, given, run_on("2001-07-01"))
    assert list(failure.value.errors) == ["date_dim"]
    assert lake.bronze("order_items").count() > 0 and lake.bronze("order_item_options").count() > 0


def test_vanished_days_stay_unless_rebuilt(spark, lake):
    from tests.test_silver import items

    from orderloom.plans import silver

    run = run_on("2024-02-01")
    two = run.stamp_silver(
        silver.order_items(items(spark, {}, {"lineitem_id": 11, "creation_time_utc": "2024-01-05 00:00:00"}))
    )
    one = run.stamp_silver(silver.order_items(items(spark, {"item_price": "9"})))
    lake.write_silver_days(two, "order_items")
    lake.write_silver_days(one, "order_items")
    assert sorted(str(r["item_price"]) for r in lake.silver("order_items").collect()) == ["2.50", "9.00"]
    undated = run.stamp_silver(silver.order_items(items(spark, {"creation_time_utc": None, "lineitem_id": 12})))
    lake.write_silver_days(undated, "order_items")
    assert lake.silver("order_items").filter("year IS NULL").count() == 1
    lake.write_silver_days(one, "order_items", rebuild=True)
    assert [str(r["item_price"]) for r in lake.silver("order_items").collect()] == ["9.00"]


def test_partitioned_writes_are_rebalanced(spark):
    rows = orders(spark, (1, "2024-01-01 10:00:00")).selectExpr("*", "2024 year", "1 month", "1 day")
    assert "REBALANCE_PARTITIONS_BY_COL" in balanced(rows, *DAY)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_NONE" in balanced(rows)._jdf.queryExecution().executedPlan().toString()


def test_file_stream_loads_each_file_once(spark, lake, tmp_path):
    folder, state = str(tmp_path / "in"), str(tmp_path / "state")
    first = orders(spark, (1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00"))
    first.write.mode("append").parquet(folder)

    def ingest(day):
        ingest_new_files(lake, folder, first.schema, "order_items", "creation_time_utc", state, run_on(day))

    ingest("2024-01-03")
    orders(spark, (3, "2024-01-04 10:00:00")).write.mode("append").parquet(folder)
    ingest("2024-01-05")
    ingest("2024-01-06")
    stored = {r["lineitem_id"]: r["pipeline_run_date"] for r in lake.bronze("order_items").collect()}
    assert stored == {1: "2024-01-03", 2: "2024-01-03", 3: "2024-01-05"}


def test_command_line_runs_the_day(spark, lake, marks, tmp_path):
    folder = tmp_path / "src"
    for name, table in sources(spark, "2001-06-05").items():
        table.write.parquet(str(folder / name))
    main(["daily", "--lake", lake.root, "--source", str(folder)])
    main(["register", "--lake", lake.root, "--database", "cli_test"])
    assert spark.table("cli_test_gold.rfm").count() == lake.latest("rfm").count() > 0
    assert spark.table("cli_test_bronze.order_items").count() == lake.bronze("order_items").count() > 0
    profile = {(r["table_name"], r["column_name"]): r for r in lake.quality("dq_profile").collect()}
    items = lake.silver("order_items")
    assert profile["order_items", "user_id"]["null_count"] == items.filter("user_id IS NULL").count()
    flags = lake.quality("dq_flag_distribution").filter("table_name = 'order_items'")
    assert sum(r["rows"] for r in flags.collect()) == items.count()


def bronze_items(spark, run, *changes):
    """Bronze line items of one run: changes to a literal item."""
    from tests.test_silver import items

    rows = items(spark, *changes).withColumn("creation_time_utc", F.to_timestamp("creation_time_utc"))
    day = F.col("creation_time_utc")
    days = {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    return run.stamp_bronze(rows).withColumns(days)


def merge(lake, spark, day, *changes):
    run = run_on(day)
    lake.append_days(bronze_items(spark, run, *changes), "order_items")
    daily.silver_items_step(lake, run)


def lines(lake):
    return sorted((r["lineitem_id"], str(r["order_date"]), str(r["item_price"])) for r in lake.silver("order_items").collect())


def test_a_moved_line_item_appears_once(spark, lake):
    moved = {"lineitem_id": 11, "creation_time_utc": "2024-01-05 00:00:00"}
    merge(lake, spark, "2024-01-06", {}, moved, {"lineitem_id": None})
    merge(lake, spark, "2024-01-10", moved | {"creation_time_utc": "2024-01-09 00:00:00", "item_price": "7"})
    expected = [(10, "2024-01-02", "2.50"), (11, "2024-01-09", "7.00")]
    assert lines(lake) == expected
    daily.silver_items_step(lake, run_on("2024-01-10"))  # again: nothing changes
    assert lines(lake) == expected
    files, place = lake._place(f"{lake.path('silver', 'order_items')}/year=2024/month=1/day=5")
    assert not files.exists(place)
    rejected = lake.rejected("order_items").collect()
    assert [(r["run_date"].isoformat(), r["dq_flag"]) for r in rejected] == [("2024-01-06", "NULL_LINEITEM_ID")]


def test_incremental_merges_equal_a_full_rebuild(spark, lake):
    import random

    rng = random.Random(3)
    for day in ("2024-03-01", "2024-03-02", "2024-03-03"):
        keys = rng.sample(range(20), 8)
        stamps = [f"2024-02-{rng.randint(1, 4):02d} 00:00:00" for _ in keys]
        merge(lake, spark, day, *({"lineitem_id": k, "creation_time_utc": t, "item_price": str(k + rng.random())} for k, t in zip(keys, stamps)))
    merged = lines(lake)
    from orderloom.plans import silver

    rebuilt = silver.order_items(lake.bronze("order_items")).select("lineitem_id", "order_date", "item_price").collect()
    assert merged == sorted((r[0], str(r[1]), str(r[2])) for r in rebuilt)


def test_a_retry_with_the_same_clock_passes(spark, lake, marks, monkeypatch):
    load(lake, marks, orders(spark, (1, "2024-01-01 10:00:00")), "2024-01-02")
    more = orders(spark, (1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00"))
    with monkeypatch.context() as patched:
        patched.setattr(Lake, "count_run_rows", lambda *_: 0)
        with pytest.raises(bronze.WriteValidationError):
            load(lake, marks, more, "2024-01-03")
    assert load(lake, marks, more, "2024-01-03").rows == 1
    assert marks.get("order_items") == at(2024, 1, 2, 10)


def test_a_text_mark_is_refused(spark, lake, marks):
    text = orders(spark, (1, "2024-01-01 10:00:00")).withColumn("Creation_Time_UTC", F.lit("2024-01-01T10:00:00"))
    with pytest.raises(TypeError):
        load(lake, marks, text, "2024-01-02")


def test_the_password_is_not_shown_and_bounds_are_asked_for():
    assert "secret" not in repr(JdbcSource("jdbc:example:db", "example.Driver", "user", "secret"))
    assert Split.bounds_query("dbo.t", "id") == "(SELECT MIN(id) AS lower_bound, MAX(id) AS upper_bound FROM dbo.t) bounds"


def test_the_newest_snapshot_is_read_by_its_partition(spark, lake):
    for day in ("2024-01-02", "2024-01-10", "2024-01-03"):
        spark.range(1).selectExpr(f"'{day}' AS snapshot_date", "id AS user_id").write.partitionBy("snapshot_date").mode(
            "append"
        ).parquet(lake.path("gold", "clv"))
    latest = lake.latest("clv")
    assert [str(r["snapshot_date"]) for r in latest.select("snapshot_date").collect()] == ["2024-01-10"]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: []" not in plan
