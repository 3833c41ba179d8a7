"""Column names and types of the trip tables."""

from __future__ import annotations

# Measures of the fact: twelve digits before the point, six after it, in one long.
MONEY = "decimal(18,6)"

# Raw trip columns the library reads, with the type each has in the fact. Readers keep
# the types of the files; values are cast after the rules have seen them. Timestamps
# keep the type of the file: zone-less ones stay TIMESTAMP_NTZ (wall clock).
RAW_TYPES = {
    "payment_type": "int",
    "PULocationID": "int",
    "DOLocationID": "int",
    "passenger_count": "int",
    "fare_amount": MONEY,
    "trip_distance": MONEY,
    "total_amount": MONEY,
    "tip_amount": MONEY,
    "toll_amount": MONEY,
    "congestion_surcharge": MONEY,
}

# Columns of the zone lookup that are read, by header name; only the first must exist.
ZONE_COLUMNS = {
    "LocationID": "int",
    "Borough": "string",
    "Zone": "string",
    "service_zone": "string",
}

FACT_PARTITIONS = ("pickup_year", "pickup_month")

FACT_COLUMNS = (
    "trip_id",
    "pickup_date_key",
    "pickup_zone_key",
    "dropoff_zone_key",
    "payment_key",
    "fare_amount",
    "trip_distance",
    "trip_duration",
    "passenger_count",
    "total_amount",
    "tip_amount",
    "toll_amount",
    "congestion_surcharge",
    *FACT_PARTITIONS,
)
