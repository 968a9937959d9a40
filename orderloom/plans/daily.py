"""The daily run: Bronze loads, Silver tables, order facts, Gold tables.

Each stage reads tables the stage before it wrote, so a lost executor or a
failed table costs at most that table. Tables of a stage do not depend on each
other: they are submitted together and a failure in one does not stop the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.context import RunContext, cut_lineage
from orderloom.operators import quality
from orderloom.operators.changes import differing, differing_by, newest_generation
from orderloom.operators.order_facts import option_totals, order_facts, priced_items, priced_columns
from orderloom.plans import churn, clv, discount, location, loyalty, rfm, sales, silver
from orderloom.sources.bronze import full_load, incremental_load
from orderloom.sources.lake import BUCKETED, DELETED, Lake, day_part
from orderloom.sources.published import VERSION, State
from orderloom.sources.watermarks import Watermarks

Step = Callable[[], object]

#: What pricing reads: Silver table -> the part of it that a price depends on.
PRICED_FROM: dict[str, Callable[[DataFrame], DataFrame]] = {
    "order_items": priced_columns,
    "order_item_options": option_totals,
}
SILVER_TABLES = ("order_items", "order_item_options", "date_dim", "priced_items", "order_facts")


class StageFailed(RuntimeError):
    """Some tables of a stage failed; ``errors`` maps each to its exception."""

    def __init__(self, stage: str, errors: Mapping[str, Exception]):
        super().__init__(f"{stage}: " + "; ".join(f"{name}: {error}" for name, error in errors.items()))
        self.errors = errors


def _run_stage(stage: str, steps: Mapping[str, Step]) -> dict[str, object]:
    """Submit independent jobs to the one Spark application and wait for all of them."""
    errors: dict[str, Exception] = {}
    results: dict[str, object] = {}
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        pending = {name: pool.submit(step) for name, step in steps.items()}
    for name, future in pending.items():
        error = future.exception()
        if error is None:
            results[name] = future.result()
        else:
            errors[name] = error
    if errors:
        raise StageFailed(stage, errors)
    return results


def run_bronze(lake: Lake, marks: Watermarks, sources: Mapping[str, DataFrame], run: RunContext) -> dict:
    return _run_stage(
        "bronze",
        {
            "order_items": lambda: incremental_load(
                lake, marks, sources["order_items"], "order_items", "creation_time_utc", run
            ),
            "order_item_options": lambda: full_load(
                lake, sources["order_item_options"], "order_item_options", run
            ),
            "date_dim": lambda: full_load(lake, sources["date_dim"], "date_dim", run),
        },
    )


def silver_items_step(lake: Lake, run: RunContext) -> None:
    """Merges the Bronze loads that are not in Silver yet; the first time, all of them.

    Which loads are in, and how many rows each had, is published with the table, so a load that commits late, or
    grows by a retry, is merged by the next run whatever its clock reading. A record of a later load is newer: where a
    load arrives behind a later one, its line items are judged by their records of all loads. Only the days that
    the arrived line items had or have are rewritten.
    """
    raw = lake.bronze("order_items")
    state = lake.published("silver", "order_items").state()
    merged = state.notes.get("loads", {}) if state else {}
    found = raw.groupBy("pipeline_run_ts", "pipeline_run_date").agg(F.count(F.lit(1)).alias("rows")).collect()  # one a load
    pending = {r["pipeline_run_ts"]: r["pipeline_run_date"] for r in found if merged.get(r["pipeline_run_ts"]) != r["rows"]}
    notes = {"loads": {r["pipeline_run_ts"]: r["rows"] for r in found}}
    if state and not pending:
        return
    dated = raw.filter(F.col("pipeline_run_date").isin({*pending.values()}))
    lake.write_rejected(silver.rejected_order_items(dated), "order_items")
    arrived = raw.filter(F.col("pipeline_run_ts").isin([*pending]))
    if any(stamp > min(pending) for stamp in merged):
        arrived = raw.join(arrived.select("lineitem_id").distinct(), "lineitem_id", "left_semi")
    items = run.stamp_silver(silver.order_items(arrived))
    if state is None:
        lake.write_silver_days(items, "order_items", notes=notes)
    else:
        lake.merge_silver_days(items, "order_items", "lineitem_id", notes)


def silver_options_step(lake: Lake, run: RunContext) -> None:
    raw = lake.bronze("order_item_options")
    lake.write_rejected(silver.rejected_options(raw), "order_item_options")
    lake.write_silver(run.stamp_silver(silver.order_item_options(raw)), "order_item_options")


def silver_calendar_step(lake: Lake, run: RunContext) -> None:
    calendar = run.stamp_silver(silver.date_dim(lake.bronze("date_dim")))
    lake.write_silver_single_file(calendar, "date_dim")


def run_silver(lake: Lake, run: RunContext) -> None:
    """The three Silver tables, then the two tables built from them.

    Pricing joins the two largest tables; storing its result means no Gold table
    has to join them again. Both are kept up by orders: only those that changed are computed and written.
    """
    _run_stage(
        "silver",
        {
            "order_items": lambda: silver_items_step(lake, run),
            "order_item_options": lambda: silver_options_step(lake, run),
            "date_dim": lambda: silver_calendar_step(lake, run),
        },
    )
    quality_step(lake, run)
    pricing_step(lake)
    order_facts_step(lake)


def quality_step(lake: Lake, run: RunContext) -> None:
    """Null counts by column and rows by flag of the flagged Silver tables, kept for each run.

    The counts were gathered as the tables were written and are published with them; a table is scanned only where they are not.
    """
    profiles, flags = [], []
    for name in quality.RULES:
        counts = lake.published("silver", name).state().notes.get("quality")
        if counts:
            found = quality.tables_of(lake.spark, counts, [column for column, _ in schemas.SILVER[name]])
        else:
            table = lake.silver(name)
            found = (quality.null_profile(table), quality.flag_distribution(table))
        for tables, df in zip((profiles, flags), found):
            tables.append(df.select(F.lit(name).alias("table_name"), "*"))
    lake.write_quality(reduce(DataFrame.unionByName, profiles), "dq_profile", run)
    lake.write_quality(reduce(DataFrame.unionByName, flags), "dq_flag_distribution", run)


def pricing_step(lake: Lake, rebuild: bool = False) -> None:
    """Prices the lines of orders whose line items or options have changed since the last pricing.

    What the stored table was built from is published with it. Where that state is no longer kept, or with
    ``rebuild``, all lines are priced.
    """
    now = {table: lake.published("silver", table).state() for table in PRICED_FROM}
    built_from = {table: state.version for table, state in now.items()}
    notes = {"from": built_from}
    stored = lake.published("silver", "priced_items").state()
    touched = None if rebuild or stored is None else changed_orders(lake, stored.notes["from"], now)
    items, options = (lake.silver(table, now[table]) for table in PRICED_FROM)
    if touched is None:
        lake.write_silver(priced_items(items, options), "priced_items", notes)
        return
    touched = cut_lineage(touched)
    if touched.isEmpty():
        if stored.notes["from"] != built_from:
            lake.note("priced_items", notes)
        return
    items = items_of_orders(lake, touched, stored.notes["from"]["order_items"], now["order_items"])
    options = options.join(touched, "order_id", "left_semi")
    lake.write_changed(priced_items(items, options), touched, "priced_items", notes)


def changed_orders(lake: Lake, since: Mapping[str, int], now: Mapping[str, State]) -> DataFrame | None:
    """Ids of orders whose priced columns differ between two states of the Silver tables; None if the older is gone.

    Of the line items, only the days written since are compared. Options are loaded in full every day, so their totals are.
    """
    parts = []
    for table, view in PRICED_FROM.items():
        target, old = lake.published("silver", table), lake.published("silver", table).state(since[table])
        if old is None:
            return None
        if old.version == now[table].version:
            continue
        if table in BUCKETED:  # loaded in full: both states are read in their buckets, and compared where they lie
            sides = (view(lake.silver(table, state)) for state in (old, now[table]))
            parts.append(differing_by(*sides, BUCKETED[table], "order_id"))
        else:
            schema = schemas.struct(schemas.SILVER[table], lake.id_type)
            sides = (set(old.folders) - set(now[table].folders), set(now[table].folders) - set(old.folders))
            parts.append(differing(*(view(target.read(schema, sorted(side))) for side in sides), "order_id"))
    if not parts:
        return lake.silver("order_items", now["order_items"]).select("order_id").limit(0)
    return reduce(DataFrame.unionByName, parts).distinct()


def items_of_orders(lake: Lake, touched: DataFrame, since: int, now: State) -> DataFrame:
    """All line items of the touched orders, read from the days written since and those the orders had lines on before."""
    known = lake.silver("priced_items").join(touched, "order_id", "left_semi").select("order_date").distinct()
    days = known.select(F.year("order_date"), F.month("order_date"), F.dayofmonth("order_date")).collect()  # bounded by the calendar
    target = lake.published("silver", "order_items")
    folders = set(now.folders) - set(target.state(since).folders)
    folders |= {folder for folder in (now.parts().get(day_part(*day)) for day in days) if folder}
    schema = schemas.struct(schemas.SILVER["order_items"], lake.id_type)
    return target.read(schema, sorted(folders)).join(touched, "order_id", "left_semi")


def order_facts_step(lake: Lake, rebuild: bool = False) -> None:
    """Sums up the orders that pricing has written since the last time; all of them where it wrote a new base."""
    priced, facts = lake.published("silver", "priced_items"), lake.published("silver", "order_facts").state()
    now = priced.state()
    notes = {"from": {"priced_items": now.version}}
    old = priced.state(facts.notes["from"]["priced_items"]) if facts and not rebuild else None
    if old is None or not set(old.folders) <= set(now.folders):
        lake.write_silver(order_facts(lake.silver("priced_items", now)), "order_facts", notes)
        return
    since = sorted(set(now.folders) - set(old.folders))
    if not since:
        if old.version != now.version:
            lake.note("order_facts", notes)
        return
    schema = schemas.struct(schemas.SILVER["priced_items"], lake.id_type).add(DELETED, "boolean")
    rows = priced.read(schema, since, versions=True)
    live = newest_generation(rows, "order_id", VERSION, 0, DELETED)
    lake.write_changed(order_facts(live), rows.select("order_id").distinct(), "order_facts", notes)


def gold_tables(lake: Lake, run: RunContext) -> dict[str, Callable[[], DataFrame]]:
    """Every Gold table as a function of the stored Silver tables."""
    facts, lines, calendar = lake.silver("order_facts"), lake.silver("priced_items"), lake.silver("date_dim")
    as_of = F.lit(run.snapshot_date).cast("date")
    return {
        "clv": lambda: clv.clv(facts, as_of),
        "rfm": lambda: rfm.rfm(facts),
        "churn_indicators": lambda: churn.churn_indicators(facts),
        "sales_trends_daily": lambda: sales.sales_daily(facts, calendar),
        "sales_trends_weekly": lambda: sales.sales_weekly(facts, calendar),
        "sales_trends_monthly": lambda: sales.sales_monthly(facts, calendar),
        "location_performance": lambda: location.location_performance(facts, lines),
        "location_monthly_performance": lambda: location.location_monthly(facts),
        "location_top_items": lambda: location.location_top_items(lines),
        "loyalty_summary": lambda: loyalty.loyalty_summary(facts, lines),
        "loyalty_by_category": lambda: loyalty.loyalty_by_category(lines),
        "loyalty_monthly_trend": lambda: loyalty.loyalty_monthly(facts),
        "discount_order_summary": lambda: discount.discount_order_summary(facts),
        "discount_by_category": lambda: discount.discount_by_category(lines),
        "discount_customer_behaviour": lambda: discount.discount_customer_behaviour(facts),
    }


def run_gold(lake: Lake, run: RunContext) -> None:
    def writer(table: str, build: Callable[[], DataFrame]) -> Step:
        return lambda: lake.write_gold(build(), table, run)

    tables = gold_tables(lake, run)
    _run_stage("gold", {table: writer(table, build) for table, build in tables.items()})


def run_daily(lake: Lake, marks: Watermarks, sources: Mapping[str, DataFrame], run: RunContext) -> None:
    """Bronze, then Silver once all of Bronze succeeded, then Gold once all of Silver did."""
    run_bronze(lake, marks, sources, run)
    run_silver(lake, run)
    run_gold(lake, run)
