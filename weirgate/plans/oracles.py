"""Plain SQL for the registered queries, over the same tables, for another engine to run."""

from __future__ import annotations

from weirgate.plans.views import DIRTY_EVENTS, RAW_EVENTS, RAW_ORDERS, TEXT_EVENTS, view_sql

# Fixed values of the feed, stated here again so that a wrong one elsewhere does not pass on both sides.
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}$"
TRANSIT_MODES = ["subway", "tram", "staten_island_railway"]
BOROUGHS = ["Brooklyn", "Manhattan", "Bronx", "Queens", "Staten Island"]
PAYMENT_METHODS = ["metrocard", "omny"]
FARE_CLASSES = [
    "Metrocard - Fair Fare",
    "OMNY - Seniors & Disability",
    "Metrocard - Seniors & Disability",
    "Metrocard - Full Fare",
    "OMNY - Other",
    "OMNY - Full Fare",
    "Metrocard - Unlimited 7-Day",
    "Metrocard - Unlimited 30-Day",
    "Metrocard - Students",
    "Metrocard - Other",
    "OMNY - Students",
    "OMNY - Fair Fare",
]
RANGES = {
    "ridership": (1, 16217),
    "transfers": (0, 1450),
    "latitude": (40.576126, 40.903126),
    "longitude": (-74.07484, -73.7554),
}
TEXT_COLUMNS = [
    "transit_timestamp",
    "transit_mode",
    "station_complex_id",
    "station_complex",
    "borough",
    "payment_method",
    "fare_class_category",
]
CAST_TO = {**{c: "string" for c in TEXT_COLUMNS}, "ridership": "int", "transfers": "int", "latitude": "float", "longitude": "float"}
KEY = ["transit_timestamp", "station_complex_id", "payment_method", "fare_class_category", "transit_mode"]

ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%g')"
FILE_NAME = "'ridership_' || strftime({0}, '%Y-%m-%dT%H-%M-%S-%g') || '.parquet'"
ORDER_MONTHS = "SELECT DISTINCT date_trunc('month', o_orderdate) AS month FROM orders"
SHIP_MONTHS = "SELECT DISTINCT date_trunc('month', l_shipdate) AS month FROM lineitem"
DELTA = f"({SHIP_MONTHS}) EXCEPT ({ORDER_MONTHS})"
LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax"
FIRST_LINES = (
    "SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER"
    f" (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS nth FROM lineitem) WHERE nth = 1"
)
DIRTY = f"dirty AS ({view_sql(DIRTY_EVENTS, 'events')})"
BAD = "(NOT (et IN ('click', 'view', 'error')) OR v < 1 OR v > 100)"
EARLIER = "l_shipdate < TIMESTAMP '1998-01-01'"
NEW_LINES = (
    f"SELECT * FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem k WHERE k.{EARLIER}"
    " AND k.l_orderkey = l.l_orderkey AND k.l_linenumber = l.l_linenumber)"
)


def _quoted(values: list[str]) -> str:
    return ", ".join("'" + v + "'" for v in values)


def _typed(expressions: dict[str, str], source: str, time: str) -> str:
    """The feed's columns of a raw view, cast and made distinct, with the derived time."""
    raw = view_sql(expressions, f"(SELECT *, {ISO.format(time)} AS iso_ts FROM {source})")
    casts = {
        "string": "{0}",
        "int": "CAST(trunc(TRY_CAST({0} AS DOUBLE)) AS INTEGER)",
        "float": "TRY_CAST({0} AS FLOAT)",
    }
    columns = ", ".join(f"{casts[kind].format(name)} AS {name}" for name, kind in CAST_TO.items())
    # The LIKE keeps this engine from reading text as a time that the other one would not.
    derived = (
        "CASE WHEN transit_timestamp LIKE '____-__-__T%'"
        " THEN strftime(TRY_CAST(transit_timestamp AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') END AS transit_datetime"
    )
    return f"SELECT DISTINCT *, {derived} FROM (SELECT {columns} FROM ({raw}))"


EVENTS_TWICE = "(SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'click')"
BATCH = f"batch AS ({_typed(RAW_EVENTS, EVENTS_TWICE, 'ts')})"
KNOWN_IDS = "SELECT CAST(n_nationkey AS VARCHAR) FROM nation"

# One entry per rule of the feed: its type, column and violation.
RIDERSHIP_RULES = [
    ("match_regex", "transit_timestamp", f"NOT regexp_matches(transit_timestamp, '{TIMESTAMP_PATTERN}')"),
    ("be_in_set", "transit_mode", f"transit_mode NOT IN ({_quoted(TRANSIT_MODES)})"),
    ("be_in_set", "station_complex_id", f"station_complex_id NOT IN ({KNOWN_IDS})"),
    ("be_in_set", "station_complex", "station_complex NOT IN (SELECT n_name FROM nation)"),
    ("be_in_set", "borough", f"borough NOT IN ({_quoted(BOROUGHS)})"),
    ("be_in_set", "payment_method", f"payment_method NOT IN ({_quoted(PAYMENT_METHODS)})"),
    ("be_in_set", "fare_class_category", f"fare_class_category NOT IN ({_quoted(FARE_CLASSES)})"),
    *[
        (
            "be_between",
            column,
            f"(CAST({column} AS DOUBLE) < CAST({low} AS DOUBLE) OR CAST({column} AS DOUBLE) > CAST({high} AS DOUBLE))",
        )
        for column, (low, high) in RANGES.items()
    ],
]
ANY_RIDERSHIP = " OR ".join(f"coalesce({violation}, FALSE)" for _, _, violation in RIDERSHIP_RULES)


def _summary(source: str, rules: list[tuple[str, ...]], numeric: set[str]) -> str:
    """Rules are type, column and violation, and where they differ from the column, its known rows and its text."""
    parts = []
    for kind, column, violation, *special in rules:
        known, text = special or (f"{column} IS NOT NULL", f"CAST({column} AS VARCHAR)")
        order = column if column in numeric else text
        listed = (
            f"(SELECT string_agg(value, ';' ORDER BY nth) FROM (SELECT {text} AS value,"
            f" row_number() OVER (ORDER BY {order}) AS nth FROM {source} WHERE {violation}) WHERE nth <= 20)"
        )
        count = f"count(*) FILTER ({violation})"
        parts.append(
            f"SELECT 'expect_column_values_to_{kind}' AS expectation_type, '{column}' AS \"column\","
            f" {count} = 0 AS success, {count} AS unexpected_count,"
            f" CASE WHEN count(*) FILTER ({known}) = 0 THEN CAST(0 AS DOUBLE)"
            f" ELSE CAST(100 AS DOUBLE) * {count} / count(*) FILTER ({known}) END AS unexpected_percent,"
            f" coalesce({listed}, '') AS partial_unexpected_list FROM {source}"
        )
    return " UNION ALL ".join(parts)


# Text is read as a time only where the other engine would read it, too.
UNREADABLE = (
    "(transit_timestamp IS NOT NULL AND (transit_timestamp NOT LIKE '____-__-__T%'"
    " OR TRY_CAST(transit_timestamp AS TIMESTAMP) IS NULL))"
)
BOTH_KNOWN = "station_complex_id IS NOT NULL AND station_complex IS NOT NULL"
STRICT_RULES = [
    ("be_of_type", "transit_timestamp", UNREADABLE),
    *RIDERSHIP_RULES[:4],
    ("not_be_null", "borough", "borough IS NULL", "TRUE", "borough"),
    *RIDERSHIP_RULES[4:7],
    ("not_be_null", "ridership", "ridership IS NULL", "TRUE", "CAST(ridership AS VARCHAR)"),
    *RIDERSHIP_RULES[7:],
    (
        "be_in_set",
        "station_complex_id,station_complex",
        f"({BOTH_KNOWN} AND (station_complex_id, station_complex) NOT IN (SELECT (CAST(n_nationkey AS VARCHAR), n_name) FROM nation))",
        BOTH_KNOWN,
        "station_complex_id || ',' || station_complex",
    ),
]


EVENT_RULES = [
    ("be_in_set", "et", "et NOT IN ('click', 'view', 'error')"),
    ("be_between", "v", "(v < 1 OR v > 100)"),
]


def _samples() -> str:
    parts = [
        f"SELECT {number} AS rule_no, CAST(row_number() OVER (ORDER BY {column}) - 1 AS INTEGER) AS position,"
        f" CAST({column} AS VARCHAR) AS value FROM dirty WHERE {violation} QUALIFY position < 20"
        for number, (_, column, violation) in enumerate(EVENT_RULES)
    ]
    return " UNION ALL ".join(f"SELECT * FROM ({part})" for part in parts)


TYPED_ORDERS = _typed(RAW_ORDERS, "orders", "o_orderdate")
CHANGED_ORDERS = _typed(
    {**RAW_ORDERS, "transfers": "CAST((o_custkey % 1400) % 1000 + 1 AS VARCHAR)"}, "orders", "o_orderdate"
)
SAME_KEY = " AND ".join(f"k.{c} = r.{c}" for c in KEY)
MONTH_OF = "date_trunc('month', CAST(transit_timestamp AS TIMESTAMP))"
WAREHOUSE_COLUMNS = (
    "CAST(transit_timestamp AS TIMESTAMP) AS transit_timestamp, transit_mode,"
    " station_complex_id, station_complex, borough, payment_method, fare_class_category,"
    " CAST(ridership AS BIGINT) AS ridership, CAST(transfers AS BIGINT) AS transfers,"
    " CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude"
)
WHOLE = "TRY_CAST(trunc(TRY_CAST(value_text AS DOUBLE)) AS {0})"

ORACLES: dict[str, str] = {
    "source_month_inventory": f"{ORDER_MONTHS} ORDER BY month",
    "landing_inventory": "SELECT DISTINCT "
    + ISO.format("date_trunc('month', o_orderdate)")
    + " AS iso_time FROM orders ORDER BY iso_time",
    "month_delta": f"SELECT month FROM ({DELTA}) ORDER BY month",
    "month_windows": "SELECT month AS start_month, month + INTERVAL 1 MONTH AS end_month FROM"
    f" ({SHIP_MONTHS}) ORDER BY start_month",
    "increment_month": "SELECT o_orderkey, o_orderdate, o_orderdate + INTERVAL 1 MONTH AS next_month FROM orders",
    "month_range_scan": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'",
    "limited_scan": "SELECT * EXCLUDE (n_month), n_month > 100 AS truncated FROM (SELECT *, row_number() OVER"
    " (PARTITION BY date_trunc('month', o_orderdate) ORDER BY o_orderdate, o_orderkey) - 1 AS ordinal, count(*) OVER"
    " (PARTITION BY date_trunc('month', o_orderdate)) AS n_month FROM orders) WHERE ordinal < 100",
    "worklist_scan": f"SELECT * FROM lineitem WHERE date_trunc('month', l_shipdate) IN (SELECT month FROM ({DELTA}))",
    "multi_file_scan": "SELECT * FROM orders WHERE date_trunc('month', o_orderdate) IN"
    f" (SELECT month FROM ({SHIP_MONTHS}))",
    "multi_file_scan_drift": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
    + ISO.format("o_orderdate")
    + " AS o_orderdate, o_orderstatus FROM orders",
    "landing_changed_months": "WITH r AS (SELECT CASE WHEN CAST(transfers AS INTEGER) % 50 <> 7 THEN date_trunc('month', CAST(transit_timestamp"
    f" AS TIMESTAMP)) END AS month, CAST(ridership AS DOUBLE) % 97 <> 0 AS early FROM ({view_sql(RAW_ORDERS, '(SELECT *, ' + ISO.format('o_orderdate') + ' AS iso_ts FROM orders)')}))"
    " SELECT month, count(*) AS n_rows, CASE WHEN bool_or(early) AND NOT bool_and(early) THEN 2 ELSE 1 END::BIGINT AS n_landings FROM r GROUP BY month",
    "json_ingest": "SELECT * FROM events",
    "dimension_scan": "SELECT n_nationkey, n_name || ' (a, \"b\")' || CAST(n_regionkey AS VARCHAR) AS n_label FROM nation",
    "land_by_month": "SELECT "
    + FILE_NAME.format("date_trunc('month', o_orderdate)")
    + " AS month_file, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key"
    " FROM orders GROUP BY 1",
    "safe_file_name": "SELECT event_id, " + FILE_NAME.format("ts") + " AS file_name FROM events",
    "parse_file_name": "SELECT event_id, " + ISO.format("ts") + " AS iso_time, date_trunc('millisecond', ts) AS ts_millis"
    " FROM events",
    "project_columns": "SELECT l_shipdate, l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem",
    "cast_schema": "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,"
    " CAST(trunc(l_quantity) AS INTEGER) AS l_quantity, CAST(l_extendedprice AS FLOAT) AS l_extendedprice,"
    " CAST(l_discount AS FLOAT) AS l_discount, l_returnflag FROM lineitem",
    "cast_schema_text": "SELECT event_id, TRY_CAST(trunc(TRY_CAST(count_text AS DOUBLE)) AS INTEGER) AS count_text,"
    " TRY_CAST(trunc(TRY_CAST(value_text AS DOUBLE)) AS INTEGER) AS value_text"
    f" FROM ({view_sql(TEXT_EVENTS, 'events')})",
    "cast_failures": f"WITH text AS ({view_sql(TEXT_EVENTS, 'events')})"
    " SELECT 'event_id' AS column_name, count(*) FILTER (event_id IS NULL) AS cast_failures FROM text"
    " UNION ALL SELECT 'count_text', count(*) FILTER (count_text IS NOT NULL AND TRY_CAST(count_text AS INTEGER) IS NULL)"
    " FROM text"
    " UNION ALL SELECT 'value_text', count(*) FILTER (value_text IS NOT NULL AND TRY_CAST(value_text AS FLOAT) IS NULL)"
    " FROM text",
    "derive_datetime": "SELECT event_id, " + ISO.format("ts") + " AS ts_text,"
    " strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_datetime FROM events",
    "warehouse_projection": "SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE date_trunc('millisecond', ts) END AS ts,"
    " event_type, user_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM events",
    "dedup_rows": "SELECT DISTINCT l_suppkey, l_returnflag, l_shipdate FROM lineitem",
    "dedup_rows_copies": "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL"
    " SELECT * FROM lineitem WHERE l_returnflag = 'R')",
    "dedup_keys": FIRST_LINES,
    "rule_regex": r"""SELECT * FROM events WHERE NOT regexp_matches(props, '^\{"k": \d{2}\}$')""",
    "rule_in_set": f"WITH {DIRTY} SELECT * FROM dirty WHERE et NOT IN ('click', 'view', 'error')",
    "rule_between": f"WITH {DIRTY} SELECT * FROM dirty WHERE v < 1 OR v > 100",
    "rule_in_dimension": "SELECT * FROM lineitem WHERE l_suppkey NOT IN"
    " (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)",
    "rule_in_dimension_pair": "SELECT r.* FROM (SELECT transit_timestamp, station_complex_id, station_complex, transfers"
    f" FROM ({view_sql(RAW_EVENTS, '(SELECT *, ' + ISO.format('ts') + ' AS iso_ts FROM ' + EVENTS_TWICE + ')')})) r"
    " WHERE NOT EXISTS (SELECT 1 FROM nation WHERE CAST(n_nationkey AS VARCHAR) = station_complex_id"
    " AND n_name = station_complex)",
    "rule_not_null": f"WITH {DIRTY} SELECT * FROM dirty WHERE et IS NULL",
    "rule_parses_as": f"SELECT * FROM ({view_sql(TEXT_EVENTS, 'events')})"
    " WHERE count_text IS NOT NULL AND TRY_CAST(count_text AS INTEGER) IS NULL",
    "validation_summary": f"WITH {DIRTY} " + _summary("dirty", EVENT_RULES, {"v"}),
    "validation_summary_ridership": f"WITH {BATCH} " + _summary("batch", RIDERSHIP_RULES, set(RANGES)),
    "unexpected_samples": f"WITH {DIRTY} " + _samples(),
    "validation_gate": f"WITH {DIRTY} SELECT count(*) FILTER ({BAD}) = 0 AS success FROM dirty",
    "validation_gate_passing": f"WITH batch AS ({_typed(RAW_ORDERS, 'orders', 'o_orderdate')})"
    f" SELECT count(*) FILTER ({ANY_RIDERSHIP}) = 0 AS success FROM batch",
    "quarantine_good": f"WITH {DIRTY} SELECT * FROM dirty WHERE NOT coalesce({BAD}, FALSE)",
    "quarantine_bad": f"WITH {DIRTY} SELECT * FROM dirty WHERE {BAD}",
    "quarantine_good_drop": f"WITH {DIRTY} SELECT * FROM dirty WHERE NOT {BAD}",
    "quarantine_bad_fail": f"WITH {DIRTY} SELECT * FROM dirty WHERE coalesce({BAD}, TRUE)",
    "quarantine_limbo": f"WITH {DIRTY} SELECT * FROM dirty WHERE {BAD} IS NULL",
    "append_union": f"WITH {DIRTY} SELECT * FROM dirty",
    "batch_counts": f"WITH {DIRTY} SELECT count(*) FILTER (NOT coalesce({BAD}, FALSE)) AS n_good,"
    f" count(*) FILTER ({BAD}) AS n_bad, count(*) FILTER (NOT coalesce({BAD}, FALSE)) AS n_new FROM dirty",
    "semi_join_dimension": "SELECT * FROM customer WHERE c_nationkey IN"
    " (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)",
    "anti_join_dimension": "SELECT * FROM customer WHERE c_nationkey NOT IN"
    " (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)",
    "anti_join_new": NEW_LINES,
    "staging_delta": NEW_LINES,
    "insert_new": f"SELECT * FROM lineitem WHERE {EARLIER} UNION ALL ({NEW_LINES})",
    "insert_new_one_per_key": FIRST_LINES,
    "insert_new_null_keys": f"WITH {DIRTY} SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE et IS NULL",
    "insert_new_null_safe": f"WITH {DIRTY} SELECT * FROM dirty",
    "create_or_insert": "SELECT * FROM orders",
    "warehouse_merge": "SELECT date_trunc('millisecond', ts) AS ts, event_id, event_type, value FROM events",
    "round_robin_shards": "SELECT *, ordinal % 3 AS shard FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,"
    " row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate) - 1 AS ordinal FROM lineitem)",
    "ridership_rejected": f"WITH {BATCH} SELECT *, NOT ({ANY_RIDERSHIP}) AS is_good FROM batch",
    "ridership_worklist": f"SELECT month FROM ({ORDER_MONTHS}) WHERE month >= TIMESTAMP '1998-01-01'",
    "insert_after_crash": f"SELECT {WAREHOUSE_COLUMNS} FROM ({TYPED_ORDERS})",
    "ridership_warehouse": f"SELECT {WAREHOUSE_COLUMNS} FROM ({TYPED_ORDERS})",
    "ridership_overlap": f"WITH early AS (SELECT * FROM ({TYPED_ORDERS}) WHERE ridership % 3 <> 0),"
    f" late AS (SELECT * FROM ({CHANGED_ORDERS}) r WHERE NOT EXISTS (SELECT 1 FROM early k WHERE {SAME_KEY}))"
    f" SELECT {WAREHOUSE_COLUMNS} FROM (SELECT * FROM early UNION ALL SELECT * FROM late)",
    "worklist_reopened": f"WITH typed AS (SELECT *, {MONTH_OF} AS month FROM ({TYPED_ORDERS})),"
    " early AS (SELECT * FROM typed WHERE ridership % 7 <> 0), listed AS (SELECT DISTINCT month FROM early ORDER BY month DESC LIMIT 2),"
    " late AS (SELECT count(*) AS n_new FROM typed r WHERE month IN (SELECT month FROM listed)"
    f" AND NOT EXISTS (SELECT 1 FROM early k WHERE {SAME_KEY})) SELECT month, n_new FROM listed, late",
    "flagship": f"SELECT DISTINCT event_id, ts, et, v FROM ({view_sql({**DIRTY_EVENTS, 'ts': 'ts'}, 'events')})"
    f" WHERE NOT coalesce({BAD}, FALSE) AND ts >= TIMESTAMP '2024-01-16'",
    "landed_rows_accounted": "SELECT CASE WHEN event_id % 97 <> 0 THEN date_trunc('month', ts) END AS month,"
    f" count(*) AS n_rows FROM {EVENTS_TWICE} GROUP BY 1",
    "multi_file_scan_flat": "SELECT * FROM orders",
    "quarantine_counts_drop": f"WITH {DIRTY} SELECT CASE WHEN {BAD} THEN 'bad' WHEN NOT {BAD} THEN 'good' ELSE 'limbo' END"
    " AS verdict, count(*) AS n_rows, count(*) AS n_told FROM dirty GROUP BY 1",
    "quarantine_rerun": f"WITH {BATCH}, split AS (SELECT CASE WHEN {ANY_RIDERSHIP} THEN 'bad' ELSE 'good' END AS verdict"
    " FROM batch), n AS (SELECT verdict, count(*) AS n_rows FROM split GROUP BY 1)"
    " SELECT 1 AS step, verdict, n_rows FROM n UNION ALL SELECT 2, verdict, n_rows FROM n WHERE verdict = 'bad'",
    "insert_new_one_per_key_nulls": f"WITH {DIRTY} SELECT event_id, event_id % 50 AS slot, et, v FROM dirty WHERE et IS NULL"
    " UNION ALL (SELECT event_id, event_id % 50 AS slot, et, v FROM dirty WHERE et IS NOT NULL"
    " QUALIFY row_number() OVER (PARTITION BY event_id % 50, et ORDER BY event_id) = 1)",
    "cast_schema_spellings": "SELECT event_id, " + ", ".join(
        f"{WHOLE.format(kind)} AS {name}"
        for name, kind in (("as_int", "INTEGER"), ("as_integer", "INTEGER"), ("as_short", "SMALLINT"), ("as_smallint", "SMALLINT"), ("as_long", "BIGINT"))
    ) + f" FROM ({view_sql(TEXT_EVENTS, 'events')})",
    "validation_summary_strict": f"WITH {BATCH} " + _summary("batch", STRICT_RULES, set(RANGES)),
}
