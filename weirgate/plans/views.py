"""Views that give the sample tables the defects the operators are about.

Each expression is plain text that Spark and the checking engine read alike. The remainders below only
choose which rows get a defect; every row of the table stays in the view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.functions import iso_text

DIRTY_EVENTS = {
    "event_id": "event_id",
    "et": "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'bogus' ELSE event_type END",
    "v": "CASE WHEN event_id % 19 = 0 THEN NULL ELSE value END",
}

TEXT_EVENTS = {
    "event_id": "event_id",
    "count_text": "CASE WHEN event_id % 17 = 0 THEN 'abc' WHEN event_id % 13 = 0 THEN '' ELSE CAST(user_id AS STRING) END",
    "value_text": "CASE WHEN event_id % 23 = 0 THEN 'n/a' ELSE CAST(event_id % 1000 AS STRING) || '.25' END",
}

# Feed rows with defects under each of the eleven rules; the time text comes in as iso_ts.
RAW_EVENTS = {
    "transit_timestamp": "CASE WHEN event_id % 97 = 0 THEN '2024/01/05 10:00' ELSE iso_ts END",
    "transit_mode": "CASE WHEN event_id % 89 = 0 THEN 'bus' WHEN event_id % 83 = 0 THEN NULL"
    " WHEN event_type = 'error' THEN 'tram' WHEN event_type = 'signup' THEN 'staten_island_railway' ELSE 'subway' END",
    "station_complex_id": "CAST(user_id % 26 AS STRING)",
    "station_complex": "CASE WHEN event_id % 101 = 0 THEN 'NATION_99' ELSE 'NATION_' || CAST(user_id % 25 AS STRING) END",
    "borough": "CASE WHEN event_id % 107 = 0 THEN 'Yonkers' WHEN event_id % 79 = 0 THEN NULL"
    " WHEN user_id % 3 = 0 THEN 'Queens' WHEN user_id % 3 = 1 THEN 'Bronx' ELSE 'Staten Island' END",
    "payment_method": "CASE WHEN event_id % 109 = 0 THEN 'cash' WHEN user_id % 2 = 0 THEN 'metrocard' ELSE 'omny' END",
    "fare_class_category": "CASE WHEN event_id % 113 = 0 THEN 'Token'"
    " WHEN user_id % 2 = 0 THEN 'Metrocard - Full Fare' ELSE 'OMNY - Full Fare' END",
    "ridership": "CASE WHEN event_id % 71 = 0 THEN 'abc' ELSE CAST(user_id % 400 AS STRING) || '.0' END",
    "transfers": "CAST(event_id % 1453 AS STRING)",
    "latitude": "'40.' || CAST(570000 + (event_id * 37) % 340000 AS STRING)",
    "longitude": "'-73.' || CAST(750000 + (event_id * 41) % 250000 AS STRING)",
    "note": "props",
}

# Clean feed rows over the eighty months of the orders.
RAW_ORDERS = {
    "transit_timestamp": "iso_ts",
    "transit_mode": "CASE WHEN o_orderstatus = 'O' THEN 'subway' WHEN o_orderstatus = 'F' THEN 'tram'"
    " ELSE 'staten_island_railway' END",
    "station_complex_id": "CAST(o_custkey % 25 AS STRING)",
    "station_complex": "'NATION_' || CAST(o_custkey % 25 AS STRING)",
    "borough": "'Manhattan'",
    "payment_method": "CASE WHEN o_custkey % 2 = 0 THEN 'metrocard' ELSE 'omny' END",
    "fare_class_category": "CASE WHEN o_custkey % 2 = 0 THEN 'Metrocard - Other' ELSE 'OMNY - Other' END",
    "ridership": "CAST(1 + o_orderkey % 1600 AS STRING) || '.0'",
    "transfers": "CAST(o_custkey % 1400 AS STRING)",
    "latitude": "'40.' || CAST(600000 + o_custkey % 300000 AS STRING)",
    "longitude": "'-73.' || CAST(800000 + o_custkey % 100000 AS STRING)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in expressions.items()])


def view_sql(expressions: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{text} AS {name}" for name, text in expressions.items()) + f" FROM {source}"


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The defective feed, with a second copy of its click rows."""
    events = table(spark, sf_dir, "events").withColumn("iso_ts", iso_text(F.col("ts")))
    return view(events.unionAll(events.where("event_type = 'click'")), RAW_EVENTS)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(table(spark, sf_dir, "orders").withColumn("iso_ts", iso_text(F.col("o_orderdate"))), RAW_ORDERS)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations stand in for the station list."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("station_complex_id"), F.col("n_name").alias("station_complex")
    )
