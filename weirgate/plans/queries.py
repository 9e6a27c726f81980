"""The registered queries: each operator run over whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.functions import add_month, file_name_to_iso, iso_text, moment, month_start, parse_iso, safe_file_name
from weirgate.operators.dedup import append_union, dedup_keys, dedup_rows
from weirgate.operators.membership import anti_join_dimension, semi_join_dimension
from weirgate.operators.months import collect_listed, in_window, month_delta, month_windows, scan_months
from weirgate.operators.ordinals import add_place, capped_scan, round_robin_shards
from weirgate.operators.rules import (
    CHECKS,
    Rule,
    between,
    evaluate,
    in_dimension,
    in_set,
    matches_regex,
    not_null,
    parses_as,
)
from weirgate.operators.schema import (
    cast_failures,
    cast_schema,
    derive_datetime,
    project_columns,
    warehouse_projection,
)
from weirgate.operators.split import (
    BAD,
    GOOD,
    LIMBO,
    NullPolicy,
    Quarantine,
    bad_rows,
    good_rows,
    quarantine,
    read_quarantine,
)
from weirgate.operators.summary import unexpected_samples, validation_gate, validation_summary
from weirgate.operators.upsert import KeyedTable, insert_new, merge_batches, new_rows, read_table, stage_new
from weirgate.plans.bronze import land_missing_months
from weirgate.plans.feed import Places
from weirgate.plans.ridership import RIDERSHIP
from weirgate.plans.silver import load_batch, load_worklist, prepare_batch, store
from weirgate.plans.status import read_status
from weirgate.plans.views import DIRTY_EVENTS, TEXT_EVENTS, raw_events, raw_orders, stations, table, view
from weirgate.plans.warehouse import merge_warehouse, read_warehouse
from weirgate.session import scratch_path
from weirgate.sources import (
    MONTH_FILE,
    land_by_month,
    landed_files,
    landed_months,
    landing_inventory,
    month_file_names,
    read_dimension,
    read_json_pages,
    read_landed_columns,
    read_landed_months,
    read_worklist,
    source_months,
    write_worklist,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPLIT_DAY = datetime(1998, 1, 1)
LINE_KEYS = ("l_orderkey", "l_linenumber")


def query(name: str) -> Callable[[Query], Query]:
    """Register a function under a name."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


# --- months, names, scans ---------------------------------------------------------------------------


@query("source_month_inventory")
def source_month_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_months(table(spark, sf_dir, "orders"), F.col("o_orderdate"))


@query("landing_inventory")
def landing_inventory_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "landing")
    land_by_month(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("o_orderdate"), root)
    return landing_inventory(spark, root).orderBy("iso_time")


@query("month_delta")
def month_delta_shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = source_months(table(spark, sf_dir, "lineitem"), F.col("l_shipdate"))
    return month_delta(shipped, source_months(table(spark, sf_dir, "orders"), F.col("o_orderdate")))


@query("month_windows")
def month_windows_shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_windows(source_months(table(spark, sf_dir, "lineitem"), F.col("l_shipdate")))


@query("increment_month")
def increment_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", add_month(F.col("o_orderdate")).alias("next_month")
    )


@query("month_range_scan")
def month_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.where(in_window(F.col("ts"), datetime(2024, 1, 10), datetime(2024, 1, 20)))


@query("limited_scan")
def limited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = add_place(table(spark, sf_dir, "orders"))
    return capped_scan(orders, month_start(F.col("o_orderdate")), ["o_orderdate", "o_orderkey"], 100, "copy_id")


@query("worklist_scan")
def worklist_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "worklist")
    write_worklist(month_delta_shipped(spark, sf_dir), path)
    return scan_months(table(spark, sf_dir, "lineitem"), F.col("l_shipdate"), read_worklist(spark, path))


@query("multi_file_scan")
def multi_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, orders = scratch_path(spark, "landing"), table(spark, sf_dir, "orders")
    land_by_month(orders, F.col("o_orderdate"), root)
    listed = source_months(table(spark, sf_dir, "lineitem"), F.col("l_shipdate"))
    landed = landing_inventory(spark, root).select(parse_iso(F.col("iso_time")).alias("month"))
    return read_landed_months(spark, root, collect_listed(listed.join(landed, "month", "left_semi")))


@query("multi_file_scan_flat")
def multi_file_scan_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months landed as single files beside months landed as directories, all found by the inventory."""
    root, orders = scratch_path(spark, "landing"), table(spark, sf_dir, "orders")
    month, early = month_start(F.col("o_orderdate")), F.col("o_orderdate") < moment(datetime(1995, 3, 1))
    land_by_month(orders.where(~early), F.col("o_orderdate"), root)
    for at in collect_listed(orders.where(early).select(month.alias("month")).distinct()):
        # A flat layout has one file a month, written below the name of the file itself.
        orders.where(month == moment(at)).coalesce(1).write.parquet(f"{root}/{month_file_names([at])[0]}")
    found = landed_files(spark, root).select(parse_iso("iso_time").alias("month"), "flat").collect()
    months, flat = [r["month"] for r in found], [r["month"] for r in found if r["flat"]]
    return read_landed_months(spark, root, months, flat=flat)


@query("multi_file_scan_drift")
def multi_file_scan_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months landed in three forms, by the year: as they are, as text with one column more, and turned round with other types."""
    root, orders, day = scratch_path(spark, "landing"), table(spark, sf_dir, "orders"), F.col("o_orderdate")
    form = F.year(day) % 3
    land_by_month(orders.where(form == 0), day, root)
    text = orders.select(*[iso_text(day).alias(c) if c == "o_orderdate" else F.col(c).cast("string") for c in orders.columns], F.lit("x").alias("later"))
    land_by_month(text.where(F.year(F.col("o_orderdate").try_cast("timestamp_ntz")) % 3 == 1), F.col("o_orderdate"), root)
    turned = orders.select(*reversed(orders.columns)).withColumn("o_custkey", F.col("o_custkey").cast("decimal(20,0)"))
    land_by_month(turned.where(form == 2), day, root)
    listed = collect_listed(landed_months(spark, root))
    return read_landed_columns(spark, root, listed, ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"])


@query("landing_changed_months")
def landing_changed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two looks at a source that gains rows, some without a time: rows by month, and how often each month was landed."""
    places, raw = Places.below(scratch_path(spark, "feed")), raw_orders(spark, sf_dir)
    some = F.expr("cast(transfers as int) % 50 = 7")
    raw = raw.withColumn("transit_timestamp", F.when(some, "someday").otherwise(F.col("transit_timestamp")))
    early = raw.where("cast(ridership as double) % 97 <> 0")
    land_missing_months(spark, early, RIDERSHIP, places, changed=True)
    land_missing_months(spark, raw, RIDERSHIP, places, changed=True)
    rows = read_landed_months(spark, places.landing, collect_listed(landed_months(spark, places.landing, undated=True)))
    counted = rows.groupBy(month_start(RIDERSHIP.time()).alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))
    noted = read_status(spark, places.status).where("stage = 'landing'").groupBy("month").agg(F.count(F.lit(1)).alias("n_landings"))
    noted = noted.select(F.col("month").alias("at"), "n_landings")
    return counted.join(noted, F.col("month").eqNullSafe(F.col("at"))).select("month", "n_rows", "n_landings")


@query("landed_rows_accounted")
def landed_rows_accounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows landed by month and without one, against the rows of a source with unparsable times."""
    places, raw = Places.below(scratch_path(spark, "feed")), raw_events(spark, sf_dir)
    land_missing_months(spark, raw, RIDERSHIP, places)
    rows = read_landed_months(spark, places.landing, collect_listed(landed_months(spark, places.landing, undated=True)))
    return rows.groupBy(month_start(RIDERSHIP.time()).alias("month")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("json_ingest")
def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, path = table(spark, sf_dir, "events"), scratch_path(spark, "pages")
    events.select([F.col(c).cast("string") for c in events.columns]).write.json(path)
    types = {f.name: f.dataType.simpleString() for f in events.schema.fields}
    return cast_schema(read_json_pages(spark, path, list(types)), types)


@query("dimension_scan")
def dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dimension")
    named = F.concat(F.col("n_name"), F.lit(' (a, "b")'), F.col("n_regionkey").cast("string"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", named.alias("n_label"))
    nation.write.option("header", True).option("escape", '"').csv(path)
    return read_dimension(spark, path, "n_nationkey int, n_label string")


@query("land_by_month")
def land_by_month_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "landing")
    land_by_month(table(spark, sf_dir, "orders"), F.col("o_orderdate"), root)
    return (
        spark.read.parquet(root)
        .groupBy(MONTH_FILE)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))
    )


@query("safe_file_name")
def safe_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", safe_file_name(F.col("ts")).alias("file_name"))


@query("parse_file_name")
def parse_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = file_name_to_iso(F.concat(F.lit("landing/"), F.col("file_name")))
    return safe_file_names(spark, sf_dir).select("event_id", iso.alias("iso_time"), parse_iso(iso).alias("ts_millis"))


# --- projection, casts, dedup -----------------------------------------------------------------------


@query("project_columns")
def project_columns_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_shipdate", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"]
    return project_columns(table(spark, sf_dir, "lineitem"), columns)


@query("cast_schema")
def cast_schema_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = {
        "l_orderkey": "string",
        "l_linenumber": "string",
        "l_quantity": "int",
        "l_extendedprice": "float",
        "l_discount": "float",
        "l_returnflag": "string",
    }
    return cast_schema(table(spark, sf_dir, "lineitem"), types)


@query("cast_schema_text")
def cast_schema_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = view(table(spark, sf_dir, "events"), TEXT_EVENTS)
    return cast_schema(text, {"event_id": "bigint", "count_text": "int", "value_text": "int"})


@query("cast_schema_spellings")
def cast_schema_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of an integer type cuts a fraction off."""
    text = view(table(spark, sf_dir, "events"), TEXT_EVENTS)
    spelt = {"as_int": "INT", "as_integer": "integer", "as_short": "short", "as_smallint": "SmallInt", "as_long": "LONG"}
    copies = text.select("event_id", *[F.col("value_text").alias(name) for name in spelt])
    return cast_schema(copies, {"event_id": "bigint", **spelt})


@query("cast_failures")
def cast_failures_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = view(table(spark, sf_dir, "events"), TEXT_EVENTS)
    return cast_failures(text, {"event_id": "bigint", "count_text": "int", "value_text": "float"})


@query("derive_datetime")
def derive_datetime_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "events").select("event_id", iso_text(F.col("ts")).alias("ts_text"))
    return derive_datetime(text, "ts_text", "ts_datetime")


@query("warehouse_projection")
def warehouse_projection_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("iso_ts", iso_text(F.col("ts")))
    typed = cast_schema(
        events.select(
            F.expr("CASE WHEN event_id % 97 = 0 THEN 'unknown' ELSE iso_ts END").alias("ts"), "event_type", "user_id", "value"
        ),
        {"ts": "string", "event_type": "string", "user_id": "int", "value": "float"},
    )
    types = {"ts": "timestamp_ntz", "event_type": "string", "user_id": "bigint", "value": "double"}
    return warehouse_projection(typed, "ts", types)


@query("dedup_rows")
def dedup_rows_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_rows(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_shipdate"))


@query("dedup_rows_copies")
def dedup_rows_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return dedup_rows(append_union(lines, lines.where("l_returnflag = 'R'")))


@query("dedup_keys")
def dedup_keys_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    return dedup_keys(table(spark, sf_dir, "lineitem"), LINE_KEYS, [F.col(c) for c in order])


# --- rules ------------------------------------------------------------------------------------------


def violating(df: DataFrame, rule: Rule) -> DataFrame:
    return bad_rows(evaluate(df, [rule]), [rule])


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(table(spark, sf_dir, "events"), DIRTY_EVENTS)


def event_rules() -> list[Rule]:
    return [in_set("et", ["click", "view", "error"]), between("v", 1, 100)]


def flagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(dirty_events(spark, sf_dir), event_rules())


@query("rule_regex")
def rule_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violating(table(spark, sf_dir, "events"), matches_regex("props", r'^\{"k": \d{2}\}$'))


@query("rule_in_set")
def rule_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violating(dirty_events(spark, sf_dir), in_set("et", ["click", "view", "error"]))


@query("rule_between")
def rule_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violating(dirty_events(spark, sf_dir), between("v", 1, 100))


@query("rule_in_dimension")
def rule_in_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey")
    return violating(table(spark, sf_dir, "lineitem"), in_dimension("l_suppkey", suppliers, ["s_suppkey"]))


@query("rule_in_dimension_pair")
def rule_in_dimension_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = stations(spark, sf_dir)
    raw = raw_events(spark, sf_dir).select("transit_timestamp", "station_complex_id", "station_complex", "transfers")
    return violating(raw, in_dimension(["station_complex_id", "station_complex"], pairs))


@query("rule_not_null")
def rule_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violating(dirty_events(spark, sf_dir), not_null("et"))


@query("rule_parses_as")
def rule_parses_as(spark: SparkSession, sf_dir: str) -> DataFrame:
    return violating(view(table(spark, sf_dir, "events"), TEXT_EVENTS), parses_as("count_text", "int"))


def flat_summary(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """The summary with its list as one text, which every engine compares alike."""
    listed = F.array_join("partial_unexpected_list", ";").alias("partial_unexpected_list")
    summary = validation_summary(flagged, rules)
    return summary.select(*[c for c in summary.columns if c != "partial_unexpected_list"], listed)


@query("validation_summary")
def validation_summary_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_summary(flagged_events(spark, sf_dir), event_rules())


@query("validation_summary_ridership")
def validation_summary_ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = RIDERSHIP.rules(stations(spark, sf_dir))
    return flat_summary(store(prepare_batch(raw_events(spark, sf_dir), RIDERSHIP, rules), "batch"), rules)


@query("validation_summary_strict")
def validation_summary_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with declared extra rules: required columns, a type to parse as, and the station as a pair."""
    strict = replace(
        RIDERSHIP,
        required=("borough", "ridership"),
        parseable={"transit_timestamp": "timestamp_ntz"},
        dimension_groups=(("station_complex_id", "station_complex"),),
    )
    rules = strict.rules(stations(spark, sf_dir))
    return flat_summary(store(prepare_batch(raw_events(spark, sf_dir), strict, rules), "batch"), rules)


@query("unexpected_samples")
def unexpected_samples_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = unexpected_samples(flagged_events(spark, sf_dir), event_rules())
    return samples.select("rule_no", F.posexplode("samples").alias("position", "value"))


@query("validation_gate")
def validation_gate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation_gate(flagged_events(spark, sf_dir), event_rules())


@query("validation_gate_passing")
def validation_gate_passing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = RIDERSHIP.rules(stations(spark, sf_dir))
    return validation_gate(prepare_batch(raw_orders(spark, sf_dir), RIDERSHIP, rules), rules)


# --- split ------------------------------------------------------------------------------------------


def quarantined_events(spark: SparkSession, sf_dir: str, null_policy: NullPolicy) -> Quarantine:
    return quarantine(flagged_events(spark, sf_dir), event_rules(), scratch_path(spark, "quarantine"), "events", null_policy)


@query("quarantine_good")
def quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined_events(spark, sf_dir, "pass").good


@query("quarantine_bad")
def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined_events(spark, sf_dir, "pass").bad


@query("quarantine_good_drop")
def quarantine_good_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_rows(flagged_events(spark, sf_dir), event_rules(), "drop")


@query("quarantine_bad_fail")
def quarantine_bad_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad_rows(flagged_events(spark, sf_dir), event_rules(), "fail")


@query("quarantine_limbo")
def quarantine_limbo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined_events(spark, sf_dir, "drop").limbo


@query("quarantine_rerun")
def quarantine_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch id three times: good and bad rows, then the bad ones only, then good ones only, which are loaded."""
    places, known = Places.below(scratch_path(spark, "feed")), stations(spark, sf_dir)
    raw, columns = raw_events(spark, sf_dir), list(RIDERSHIP.types)
    bad = load_batch(spark, raw, known, RIDERSHIP, places, "events", on_reject="record")
    schema = bad.flagged.drop(CHECKS).schema

    def left(step: int) -> DataFrame:
        found = read_quarantine(spark, places.quarantine, schema).groupBy("verdict").agg(F.count(F.lit(1)).alias("n_rows"))
        return store(found.select(F.lit(step).alias("step"), "verdict", "n_rows"), "left")

    steps = [left(1)]
    only_bad = bad_rows(bad.flagged, bad.rules).select(*[F.col(c).cast("string") for c in columns])
    load_batch(spark, only_bad, known, RIDERSHIP, places, "events", on_reject="record")
    steps.append(left(2))
    load_batch(spark, raw_orders(spark, sf_dir), known, RIDERSHIP, places, "events", on_reject="record")
    return append_union(*steps, left(3))


@query("quarantine_counts_drop")
def quarantine_counts_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under ``drop`` the rows in neither part are kept and counted too."""
    kept = quarantined_events(spark, sf_dir, "drop")
    parts = ((GOOD, kept.good, kept.n_good), (BAD, kept.bad, kept.n_bad), (LIMBO, kept.limbo, kept.n_limbo))
    counted = [part.agg(F.lit(name).alias("verdict"), F.count(F.lit(1)).alias("n_rows"), F.lit(n).cast("bigint").alias("n_told")) for name, part, n in parts]
    return append_union(*counted)


@query("append_union")
def append_union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged, rules = flagged_events(spark, sf_dir), event_rules()
    return append_union(good_rows(flagged, rules), bad_rows(flagged, rules))


@query("batch_counts")
def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the quarantine and staging writes observe on the way."""
    kept = quarantined_events(spark, sf_dir, "pass")
    target = KeyedTable(scratch_path(spark, "table"), ("event_id",))
    staging = scratch_path(spark, "staging")
    insert_new(spark, kept.bad, target, staging, "bad")
    new = stage_new(spark, append_union(kept.good, kept.bad), target, staging, "all")
    return spark.createDataFrame([(kept.n_good, kept.n_bad, new.n_new)], "n_good bigint, n_bad bigint, n_new bigint")


# --- joins and inserts ------------------------------------------------------------------------------


@query("semi_join_dimension")
def semi_join_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").where("n_regionkey = 1")
    return semi_join_dimension(table(spark, sf_dir, "customer"), ["c_nationkey"], nations, ["n_nationkey"])


@query("anti_join_dimension")
def anti_join_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").where("n_regionkey = 1")
    return anti_join_dimension(table(spark, sf_dir, "customer"), ["c_nationkey"], nations, ["n_nationkey"])


def earlier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < moment(SPLIT_DAY))


@query("anti_join_new")
def anti_join_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_rows(table(spark, sf_dir, "lineitem"), earlier_lines(spark, sf_dir), LINE_KEYS)


def lines_table(spark: SparkSession, sf_dir: str) -> tuple[KeyedTable, str]:
    target, staging = KeyedTable(scratch_path(spark, "table"), LINE_KEYS), scratch_path(spark, "staging")
    insert_new(spark, earlier_lines(spark, sf_dir), target, staging, "earlier")
    return target, staging


@query("staging_delta")
def staging_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staging = lines_table(spark, sf_dir)
    return stage_new(spark, table(spark, sf_dir, "lineitem"), target, staging, "all").staged


@query("insert_new")
def insert_new_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier lines, then all lines, then all again, which adds nothing."""
    target, staging = lines_table(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem")
    insert_new(spark, lines, target, staging, "all")
    insert_new(spark, lines, target, staging, "again")
    return read_table(spark, target, lines.schema)


@query("insert_new_one_per_key")
def insert_new_one_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    target, staging = KeyedTable(scratch_path(spark, "table"), LINE_KEYS), scratch_path(spark, "staging")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    insert_new(spark, lines, target, staging, "all", key_order=[F.col(c) for c in order])
    return read_table(spark, target, lines.schema)


@query("insert_new_one_per_key_nulls")
def insert_new_one_per_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key, where keys with a NULL equal none and so all stay."""
    events = dirty_events(spark, sf_dir).select("event_id", (F.col("event_id") % 50).alias("slot"), "et", "v")
    target, staging = KeyedTable(scratch_path(spark, "table"), ("slot", "et")), scratch_path(spark, "staging")
    insert_new(spark, events, target, staging, "all", key_order=[F.col("event_id")])
    return read_table(spark, target, events.schema)


def insert_null_keys_twice(spark: SparkSession, sf_dir: str, null_safe_keys: bool) -> DataFrame:
    events = dirty_events(spark, sf_dir)
    target, staging = KeyedTable(scratch_path(spark, "table"), ("event_id", "et")), scratch_path(spark, "staging")
    for batch_id in ("first", "second"):
        insert_new(spark, events, target, staging, batch_id, null_safe_keys=null_safe_keys)
    return read_table(spark, target, events.schema)


@query("insert_new_null_keys")
def insert_new_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insert_null_keys_twice(spark, sf_dir, null_safe_keys=False)


@query("insert_new_null_safe")
def insert_new_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insert_null_keys_twice(spark, sf_dir, null_safe_keys=True)


@query("create_or_insert")
def create_or_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An absent table takes the whole batch, by month."""
    orders, staging = table(spark, sf_dir, "orders"), scratch_path(spark, "staging")
    target = KeyedTable(scratch_path(spark, "table"), ("o_orderkey", "o_orderdate"), "o_orderdate")
    insert_new(spark, orders, target, staging, "first")
    return read_table(spark, target, orders.schema)


@query("warehouse_merge")
def warehouse_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two staged batches that overlap, merged one after the other."""
    events = warehouse_projection(
        table(spark, sf_dir, "events").withColumn("ts", iso_text(F.col("ts"))),
        "ts",
        {"ts": "timestamp_ntz", "event_id": "bigint", "event_type": "string", "value": "double"},
    )
    target = KeyedTable(scratch_path(spark, "table"), ("event_id", "ts"), "ts")
    day = moment(datetime(2024, 1, 20))
    for batch_id, part in (("early", events.where(F.col("ts") < day)), ("all", events)):
        merge_batches(spark, part.withColumn("batch_id", F.lit(batch_id)), target, [batch_id])
    return read_table(spark, target, events.schema)


@query("round_robin_shards")
def round_robin_shards_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = add_place(table(spark, sf_dir, "lineitem")).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "copy_id")
    return round_robin_shards(lines, LINE_KEYS, 3, "copy_id")


# --- the feed end to end ----------------------------------------------------------------------------


@query("ridership_rejected")
def ridership_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A defective batch: both quarantine folders, told apart by a flag."""
    places = Places.below(scratch_path(spark, "feed"))
    load_batch(
        spark, raw_events(spark, sf_dir), stations(spark, sf_dir), RIDERSHIP, places, "events", on_reject="record"
    )
    schema = prepare_batch(raw_events(spark, sf_dir), RIDERSHIP, RIDERSHIP.rules(stations(spark, sf_dir))).drop(CHECKS).schema
    kept = read_quarantine(spark, places.quarantine, schema)
    return kept.withColumn("is_good", F.col("verdict") == GOOD).drop("verdict", "batch_id")


def run_feed_twice(spark: SparkSession, sf_dir: str) -> Places:
    """Months before the split day in a first run, all others in a second."""
    places, raw, known = Places.below(scratch_path(spark, "feed")), raw_orders(spark, sf_dir), stations(spark, sf_dir)
    earlier = raw.where(RIDERSHIP.time() < moment(SPLIT_DAY))
    for batch_id, source in (("first", earlier), ("second", raw)):
        land_missing_months(spark, source, RIDERSHIP, places)
        load_worklist(spark, known, RIDERSHIP, places, batch_id)
        merge_warehouse(spark, RIDERSHIP, places)
    return places


@query("ridership_worklist")
def ridership_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run lists only the months that the first had not landed."""
    return read_worklist(spark, run_feed_twice(spark, sf_dir).worklist)


@query("worklist_reopened")
def worklist_reopened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows of settled months: landed again, listed, still listed after another run, and loaded."""
    places, raw, known = Places.below(scratch_path(spark, "feed")), raw_orders(spark, sf_dir), stations(spark, sf_dir)
    on_time = raw.where("cast(ridership as double) % 7 <> 0")
    land_missing_months(spark, on_time, RIDERSHIP, places)
    load_worklist(spark, known, RIDERSHIP, places, "first")
    land_missing_months(spark, raw, RIDERSHIP, places, reopen_last=2)
    land_missing_months(spark, raw, RIDERSHIP, places)
    listed = store(read_worklist(spark, places.worklist), "listed")
    loaded = load_worklist(spark, known, RIDERSHIP, places, "second")
    return listed.withColumn("n_new", F.lit(loaded.n_new).cast("bigint"))


@query("ridership_overlap")
def ridership_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch shares keys and months with the first: only its unseen keys reach table and warehouse."""
    places, raw, known = Places.below(scratch_path(spark, "feed")), raw_orders(spark, sf_dir), stations(spark, sf_dir)
    early = raw.where("cast(ridership as double) % 3 <> 0")
    changed = raw.withColumn("transfers", F.expr("cast(cast(transfers as int) % 1000 + 1 as string)"))
    for batch_id, rows in (("first", early), ("second", changed)):
        load_batch(spark, rows, known, RIDERSHIP, places, batch_id)
        merge_warehouse(spark, RIDERSHIP, places)
    return read_warehouse(spark, RIDERSHIP, places)


class Cut(Exception):
    """Stands for a job that is killed."""


def cut_at(step: str) -> Callable[[str], None]:
    """Told the steps of a batch, ends it there."""

    def told(done: str) -> None:
        if done == step:
            raise Cut(done)

    return told


@query("insert_after_crash")
def insert_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two years of three in batches that are cut off, one before and one after the table; then all rows, and the warehouse."""
    places, raw, known = Places.below(scratch_path(spark, "feed")), raw_orders(spark, sf_dir), stations(spark, sf_dir)
    for k, step in enumerate(("staged", "appended")):
        try:
            rows = raw.where(f"cast(left(transit_timestamp, 4) as int) % 3 = {k}")
            load_batch(spark, rows, known, RIDERSHIP, places, f"cut-{step}", progress=cut_at(step))
        except Cut:
            continue
    load_batch(spark, raw, known, RIDERSHIP, places, "whole")
    merge_warehouse(spark, RIDERSHIP, places)
    return read_warehouse(spark, RIDERSHIP, places)


@query("ridership_warehouse")
def ridership_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_warehouse(spark, RIDERSHIP, run_feed_twice(spark, sf_dir))


@query("flagship")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty events through cast, dedup, rules and split; then the good rows the table does not hold yet."""
    rules = event_rules()
    dirty = view(table(spark, sf_dir, "events"), {**DIRTY_EVENTS, "ts": "ts"})
    typed = cast_schema(dirty, {"event_id": "bigint", "ts": "timestamp_ntz", "et": "string", "v": "double"})
    good = store(good_rows(evaluate(dedup_rows(typed), rules), rules), "good")
    target = KeyedTable(scratch_path(spark, "table"), ("event_id", "ts"), "ts")
    staging = scratch_path(spark, "staging")
    earlier = good.where(F.col("ts") < moment(datetime(2024, 1, 16)))
    insert_new(spark, earlier, target, staging, "earlier")
    return insert_new(spark, good, target, staging, "all").staged
