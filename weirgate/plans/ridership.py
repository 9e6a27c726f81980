"""The hourly ridership feed: its columns, types, key and rules."""

from __future__ import annotations

from weirgate.plans.feed import Feed

# Fixed values of the feed: column order, types, key and accepted domains.
SCHEMA = {
    "transit_timestamp": "string",
    "transit_mode": "string",
    "station_complex_id": "string",
    "station_complex": "string",
    "borough": "string",
    "payment_method": "string",
    "fare_class_category": "string",
    "ridership": "int",
    "transfers": "int",
    "latitude": "float",
    "longitude": "float",
}
KEY = ("transit_timestamp", "station_complex_id", "payment_method", "fare_class_category", "transit_mode")
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
STATION_SCHEMA = "index int, station_complex_id string, station_complex string"
WAREHOUSE_SCHEMA = {
    "transit_timestamp": "timestamp_ntz",
    "transit_mode": "string",
    "station_complex_id": "string",
    "station_complex": "string",
    "borough": "string",
    "payment_method": "string",
    "fare_class_category": "string",
    "ridership": "bigint",
    "transfers": "bigint",
    "latitude": "double",
    "longitude": "double",
}
TIME_COLUMN = "transit_timestamp"
DERIVED_TIME = "transit_datetime"


RIDERSHIP = Feed(
    types=SCHEMA,
    keys=KEY,
    time_column=TIME_COLUMN,
    derived_time=DERIVED_TIME,
    warehouse_types=WAREHOUSE_SCHEMA,
    patterns={TIME_COLUMN: TIMESTAMP_PATTERN},
    accepted={
        "transit_mode": TRANSIT_MODES,
        "borough": BOROUGHS,
        "payment_method": PAYMENT_METHODS,
        "fare_class_category": FARE_CLASSES,
    },
    ranges=RANGES,
    dimension_columns=("station_complex_id", "station_complex"),
)
