"""Published states, late loads, and tables kept up by changed orders."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import quality
from orderloom.operators.changes import differing, differing_by, newest_generation, replaced
from orderloom.operators.order_facts import option_totals, order_facts, priced_items
from orderloom.plans import daily, discount, silver
from orderloom.schemas import SILVER, struct
from orderloom.sources import catalog
from orderloom.sources.jdbc import Ranges
from orderloom.sources import lake as lake_module
from orderloom.sources.lake import Lake
from orderloom.sources.published import ConcurrentWrite, Published, State
from tests.test_lake import bronze_items, lines, merge, run_on
from tests.test_silver import options as raw_options


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


class Crash(RuntimeError):
    pass


def dying(patch):
    """The next publication fails after its files are written."""

    def publish(*_):
        raise Crash

    patch.setattr(Published, "publish", publish)


def append(lake, spark, day, *changes):
    lake.append_days(bronze_items(spark, run_on(day), *changes), "order_items")


# --- all or nothing ----------------------------------------------------------------------------


def test_a_merge_that_dies_leaves_the_old_table_and_a_repeat_ends_right(spark, lake, monkeypatch):
    moved = {"lineitem_id": 11, "creation_time_utc": "2024-01-05 00:00:00"}
    merge(lake, spark, "2024-01-06", {}, moved)
    before = lines(lake)
    append(lake, spark, "2024-01-10", moved | {"creation_time_utc": "2024-01-09 00:00:00"}, {"lineitem_id": None})
    with monkeypatch.context() as patch:
        dying(patch)
        with pytest.raises(Crash):
            daily.silver_items_step(lake, run_on("2024-01-10"))
        assert lines(lake) == before and lake.rejected("order_items").count() == 0
    daily.silver_items_step(lake, run_on("2024-01-10"))
    assert lines(lake) == [(10, "2024-01-02", "2.50"), (11, "2024-01-09", "2.50")]
    assert lake.rejected("order_items").count() == 1


def test_a_snapshot_that_dies_leaves_the_others(spark, lake, monkeypatch):
    empty = discount.discount_order_summary(spark.createDataFrame([], struct(SILVER["order_facts"])))
    values = [f"CAST({'discount_label' if c == 'discount_label' else 'NULL'} AS {t}) AS {c}" for c, t in empty.dtypes]
    rows = lambda label: spark.createDataFrame([(label,)], "discount_label string").selectExpr(*values)
    first, second = run_on("2024-01-01"), run_on("2024-01-02")
    lake.write_gold(rows("a"), "discount_order_summary", first)
    with monkeypatch.context() as patch:
        dying(patch)
        with pytest.raises(Crash):
            lake.write_gold(rows("b"), "discount_order_summary", first)
    assert [r["discount_label"] for r in lake.gold("discount_order_summary").collect()] == ["a"]
    lake.write_gold(rows("c"), "discount_order_summary", second)
    lake.write_gold(rows("d"), "discount_order_summary", first)
    found = {str(r["snapshot_date"]): r["discount_label"] for r in lake.gold("discount_order_summary").collect()}
    assert found == {"2024-01-01": "d", "2024-01-02": "c"}
    assert [r["discount_label"] for r in lake.latest("discount_order_summary").collect()] == ["c"]


def test_old_folders_go_and_the_last_state_stays_readable(spark, tmp_path):
    table = Published(spark, str(tmp_path / "t"), ("p",))
    schema = spark.createDataFrame([], "v int, p string").schema
    say = lambda *rows: spark.createDataFrame(rows, schema).coalesce(1)
    table.replace_partitions(say((1, "a"), (1, "b")), {"n": 1})
    table.stage(say((9, "z")))  # a write that died
    held = table.read(schema)
    table.replace_partitions(say((2, "b")))
    assert sorted(map(tuple, held.collect())) == [(1, "a"), (1, "b")]
    for v in (3, 4):
        table.replace_partitions(say((v, "b")))
    assert sorted(map(tuple, table.read(schema).collect())) == [(1, "a"), (4, "b")] and table.state().notes == {"n": 1}
    assert sorted(map(tuple, table.read(schema, table.state(4).folders).collect())) == [(1, "a"), (3, "b")]
    left = sorted(p.name for p in (tmp_path / "t").iterdir())
    assert left == ["_pointers", "version=1", "version=4", "version=5"] and table.state(1) is None
    assert not (tmp_path / "t" / "version=1" / "p=b").exists()
    with pytest.raises(ConcurrentWrite):
        table.publish(5, [], {})
    assert table.replace(say()).folders == () and table.read(schema).count() == 0


def test_folders_without_a_pointer_are_the_first_state(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (1, "b")], "v int, p string")
    rows.write.partitionBy("p").parquet(root)
    table = Published(spark, root, ("p",))
    table.replace_partitions(spark.createDataFrame([(2, "b")], "v int, p string"))
    assert sorted(map(tuple, table.read(rows.schema).collect())) == [(1, "a"), (2, "b")]


# --- no load is lost ---------------------------------------------------------------------------


def test_a_load_that_commits_late_is_merged(spark, lake):
    say = lambda key, price="1": {"lineitem_id": key, "item_price": price}
    append(lake, spark, "2024-03-01", say(11), say(44, "1"))
    daily.silver_items_step(lake, run_on("2024-03-01"))
    append(lake, spark, "2024-03-03", say(33), say(44, "3"))
    daily.silver_items_step(lake, run_on("2024-03-03"))
    append(lake, spark, "2024-03-02", say(22), say(44, "2"), say(None))
    daily.silver_items_step(lake, run_on("2024-03-04"))
    assert [(k, p) for k, _, p in lines(lake)] == [(11, "1.00"), (22, "1.00"), (33, "1.00"), (44, "3.00")]
    assert [str(r["run_date"]) for r in lake.rejected("order_items").collect()] == ["2024-03-02"]
    append(lake, spark, "2024-03-02", say(55))  # a retry adds to a load that was merged
    daily.silver_items_step(lake, run_on("2024-03-05"))
    version = lake.published("silver", "order_items").state().version
    assert [k for k, *_ in lines(lake)] == [11, 22, 33, 44, 55]
    daily.silver_items_step(lake, run_on("2024-03-06"))
    assert lake.published("silver", "order_items").state().version == version


# --- changed orders ----------------------------------------------------------------------------


def same(found, expected):
    columns = sorted(expected.columns)
    assert sorted(map(str, found.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))


def rebuilt(lake):
    priced = priced_items(lake.silver("order_items"), lake.silver("order_item_options"))
    return priced, order_facts(priced)


def load_options(lake, spark, day, *changes):
    run = run_on(day)
    lake.replace_bronze(run.stamp_bronze(raw_options(spark, *changes)), "order_item_options")
    daily.silver_options_step(lake, run)


@pytest.mark.parametrize(("share", "seed"), [(100.0, 1), (0.25, 2)])
def test_incremental_runs_equal_a_rebuild(spark, lake, monkeypatch, share, seed):
    monkeypatch.setattr(lake_module, "LARGEST_SHARE", share)
    rng = random.Random(seed)
    prices = {k: "-1" if k % 4 == 0 else str(k) for k in range(30)}
    days = [f"2024-03-{d:02d}" for d in (2, 1, 4, 3)]  # loads commit in any order
    for step, day in enumerate(days):
        keys = rng.sample(range(30), 12 if step == 0 else 4)
        append(
            lake,
            spark,
            day,
            *({"lineitem_id": k, "order_id": rng.choice([k // 3, 99]), "item_price": str(k + step), "creation_time_utc": f"2024-02-0{rng.randint(1, 4)} 00:00:00"} for k in keys),
        )
        daily.silver_items_step(lake, run_on("2024-03-09"))
        prices[rng.randrange(30)] = str(step)
        load_options(lake, spark, day, *({"lineitem_id": k, "order_id": k // 3, "option_price": p} for k, p in prices.items()))
        if step == 2:  # dies between the two tables
            daily.pricing_step(lake)
            continue
        daily.pricing_step(lake)
        daily.order_facts_step(lake)
        priced, facts = rebuilt(lake)
        same(lake.silver("priced_items"), priced)
        same(lake.silver("order_facts"), facts)
    if share > 1:
        assert len(lake.published("silver", "priced_items").state().folders) > 2
    name = catalog.register(lake, "silver", "order_facts", f"facts_{seed}")
    same(spark.table(name), facts)


def test_only_changed_orders_are_written(spark, lake, monkeypatch):
    append(lake, spark, "2024-03-01", *({"lineitem_id": k, "order_id": k // 4} for k in range(80)))
    daily.silver_items_step(lake, run_on("2024-03-01"))
    load_options(lake, spark, "2024-03-01", *({"lineitem_id": k, "order_id": k // 4} for k in range(80)))
    daily.pricing_step(lake)
    daily.order_facts_step(lake)
    first = lake.published("silver", "priced_items").state()
    # One line gets another price, another goes to an order of its own, and with it the last line of order 19 but three.
    append(lake, spark, "2024-03-02", {"lineitem_id": 0, "order_id": 0, "item_price": "9"}, {"lineitem_id": 79, "order_id": 500})
    daily.silver_items_step(lake, run_on("2024-03-02"))
    load_options(lake, spark, "2024-03-02", *({"lineitem_id": k, "order_id": k // 4} for k in range(80)))
    daily.pricing_step(lake)
    daily.order_facts_step(lake)
    for table, rows in (("priced_items", 4 + 3 + 1), ("order_facts", 3)):
        counts = lake.published("silver", table).state().notes["rows"]
        assert list(counts.values())[1:] == [rows]
    assert lake.published("silver", "priced_items").state().folders[0] == first.folders[0]
    priced, facts = rebuilt(lake)
    same(lake.silver("priced_items"), priced)
    same(lake.silver("order_facts"), facts)
    version = {t: lake.published("silver", t).state().version for t in ("priced_items", "order_facts")}
    daily.pricing_step(lake)  # nothing has changed
    daily.order_facts_step(lake)
    assert version == {t: lake.published("silver", t).state().version for t in version}


def test_keys_whose_rows_differ(spark):
    say = lambda *rows: spark.createDataFrame(rows, "k int, v string")
    before, after = say((1, "a"), (1, "a"), (2, None), (3, "c"), (None, "n")), say((1, "a"), (2, None), (4, "d"), (None, "m"))
    assert {r[0] for r in differing(before, after, "k").collect()} == {1, 3, 4, None}
    one, two = (spark.createDataFrame(rows, "k int, u int, v string") for rows in ([(1, 1, "a"), (1, 2, None), (2, 3, None), (3, 4, "x")], [(1, 1, "a"), (1, 2, None), (2, 3, ""), (4, 4, "x")]))
    assert {r[0] for r in differing_by(one, two, ("k", "u"), "k").collect()} == {2, 3, 4}
    touched = say((3, ""), (4, "")).select("k")
    assert sorted(map(str, replaced(before, after.filter("k = 4"), touched, "k").collect())) == sorted(
        map(str, say((1, "a"), (1, "a"), (2, None), (None, "n"), (4, "d")).collect())
    )


def test_newest_generation_wins_and_deleted_keys_go(spark):
    rows = spark.createDataFrame(
        [(1, "a", 1, None), (1, "b", 1, None), (2, "c", 1, None), (3, "d", 1, None), (1, "e", 2, False), (2, None, 2, True), (2, "f", 3, False), (1, None, 4, True)],
        "k int, v string, g int, gone boolean",
    )
    live = newest_generation(rows, "k", "g", 1, "gone")
    assert sorted((r["k"], r["v"]) for r in live.collect()) == [(2, "f"), (3, "d")]


def test_discount_plans_read_the_facts_once(spark):
    table = spark.createDataFrame([], struct(SILVER["order_facts"]))
    for build in (discount.discount_order_summary, discount.discount_customer_behaviour):
        plan = build(table)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan


# --- catalog -----------------------------------------------------------------------------------


def test_a_new_day_takes_few_statements(spark, lake, monkeypatch):
    for day in range(1, 7):
        append(lake, spark, f"2024-02-0{day}", {"lineitem_id": day, "creation_time_utc": f"2024-01-0{day} 00:00:00"})
    daily.silver_items_step(lake, run_on("2024-02-06"))
    counted = []
    run = catalog._Entry.sql
    monkeypatch.setattr(catalog._Entry, "sql", lambda self, statement: (counted.append(statement), run(self, statement))[1])

    def registered(layer):
        counted.clear()
        name = catalog.register(lake, layer, "order_items", f"few_{layer}")
        assert spark.table(name).count() == (lake.bronze if layer == "bronze" else lake.silver)("order_items").count()
        return [s for s in counted if not s.startswith("SHOW")]

    for layer in ("bronze", "silver"):
        registered(layer)
        assert [s for s in registered(layer) if "TBLPROPERTIES" not in s] == []
    append(lake, spark, "2024-02-07", {"lineitem_id": 7, "creation_time_utc": "2024-01-07 00:00:00"}, {"lineitem_id": 1, "creation_time_utc": "2024-01-02 00:00:00"})
    daily.silver_items_step(lake, run_on("2024-02-07"))
    assert len(registered("bronze")) == 1
    done = registered("silver")  # day 1 ends, day 2 is written again, day 7 is new, and the version is noted
    assert sorted(s.split("`")[4].split()[0] for s in done) == ["ADD", "DROP", "PARTITION", "SET"]
    assert State().parts() == {}


# --- quality counts ----------------------------------------------------------------------------


def test_quality_counts_of_the_writes_equal_those_of_a_scan(spark, lake, monkeypatch):
    rng = random.Random(7)
    for step, day in enumerate(("2024-03-01", "2024-03-02", "2024-03-03")):
        changes = [
            {"lineitem_id": k, "user_id": rng.choice([None, 1]), "item_price": rng.choice([None, "-1", "2"]), "creation_time_utc": rng.choice([None, f"2024-02-0{rng.randint(1, 4)} 00:00:00"])}
            for k in rng.sample(range(20), 9)
        ]
        append(lake, spark, day, *changes)
        daily.silver_items_step(lake, run_on(day))
        load_options(lake, spark, day, *({"lineitem_id": k, "option_price": rng.choice([None, "1"])} for k in range(5 + step)))
    scanned = {}
    for name in quality.RULES:
        table = lake.silver(name)
        scanned[name] = [sorted(map(tuple, build(table).collect())) for build in (quality.null_profile, quality.flag_distribution)]
    for build in ("null_profile", "flag_distribution"):
        monkeypatch.setattr(quality, build, lambda _: None)  # no table may be scanned for them
    daily.quality_step(lake, run_on("2024-03-03"))
    for name in quality.RULES:
        for table, expected in zip(("dq_profile", "dq_flag_distribution"), scanned[name]):
            stored = lake.quality(table).filter(F.col("table_name") == name).drop("table_name", "run_date")
            assert sorted(map(tuple, stored.collect())) == expected


# --- database reads ----------------------------------------------------------------------------


def test_ranges_hold_equal_shares_of_a_skewed_column(duck):
    duck.execute("CREATE TABLE skewed AS SELECT CAST(pow(i, 4) AS BIGINT) AS id, i % 7 AS other FROM range(1, 5001) t(i)")
    duck.execute("INSERT INTO skewed SELECT NULL, 1 FROM range(50)")
    for above in (None, "other < 3"):
        lows = duck.execute(f"SELECT low FROM {Ranges.edges_query('skewed', 'id', 16, above)}").fetchall()
        ranges = Ranges.of("id", (r[0] for r in lows))
        counts = [duck.execute(f"SELECT COUNT(*) FROM skewed WHERE {p}").fetchone()[0] for p in ranges.predicates(above)]
        total = duck.execute(f"SELECT COUNT(*) FROM skewed WHERE {above or '1 = 1'}").fetchone()[0]
        assert len(counts) == 16 and sum(counts) == total and max(counts) <= 2 * total / 16
    assert Ranges.of("id", [3, 3, 3]).predicates() == ["1 = 1"] and Ranges.of("id", []).predicates("x > 1") == ["(1 = 1) AND (x > 1)"]
    assert Ranges.of("d", [datetime.date(2024, 1, 1), datetime.date(2024, 2, 1)]).predicates() == ["d < '2024-02-01' OR d IS NULL", "d >= '2024-02-01'"]
    assert Ranges.of("s", ["a", "o'b"]).predicates()[1] == "s >= 'o''b'"


def test_the_database_is_asked_above_the_mark():
    from orderloom.__main__ import _above

    mark = datetime.datetime(2024, 1, 2, 3, 4, 5, tzinfo=datetime.UTC)
    assert _above(mark) == "creation_time_utc > '2024-01-02 03:04:05.000000'" and _above(None) is None


# --- buckets -----------------------------------------------------------------------------------


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_options_and_facts_are_read_in_their_buckets(spark, lake):
    for day, price in (("2024-03-01", "1"), ("2024-03-02", "2")):
        append(lake, spark, day, *({"lineitem_id": k, "order_id": k // 4, "item_price": price} for k in range(40)))
        daily.silver_items_step(lake, run_on(day))
        load_options(lake, spark, day, *({"lineitem_id": k, "order_id": k // 4, "option_price": price if k < 9 else "1"} for k in range(40)))
        daily.pricing_step(lake)
        daily.order_facts_step(lake)
    table = lake.published("silver", "order_item_options")
    now, old = table.state(), table.state(table._pointers()[-2])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before, after = (option_totals(lake.silver("order_item_options", state)) for state in (old, now))
        assert exchanges(after) == 0
        changed = differing_by(before, after, ("order_id", "lineitem_id"), "order_id")  # one for the distinct ids of what differs, none for the comparison
        assert exchanges(changed) == 1 and {r[0] for r in changed.collect()} == {0, 1, 2}
        items = lake.silver("order_items")
        assert exchanges(priced_items(items, lake.silver("order_item_options"))) == 1  # of the items, which lie by day
        orders = lake.silver("order_facts").groupBy("order_id", "restaurant_id", "order_date").agg(F.sum("gross"))
        assert exchanges(orders) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("orderloom_")]
    same(lake.silver("order_facts"), rebuilt(lake)[1])


# --- shared folder -----------------------------------------------------------------------------


def test_a_cluster_needs_a_shared_folder_by_name():
    from types import SimpleNamespace

    from orderloom.context import shared_folder

    def session(master, **settings):
        conf = SimpleNamespace(get=lambda key, *default: settings.get(key, default[0] if default else "/w"))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("local[8]")) == "/w/_checkpoints"
    assert shared_folder(session("yarn", **{"spark.checkpoint.dir": "hdfs:///c"})) == "hdfs:///c"
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn"))
