"""Column names, key lists and code tables of the trip data model."""

from __future__ import annotations

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# The columns that counts, metrics and keys are made of.
CODE_COLUMNS = ["passenger_count", "payment_type", "RatecodeID"]
CATEGORICAL_COLUMNS = ["VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag"]
METRIC_COLUMNS = ["trip_distance", "total_amount", "trip_duration_min", "avg_mph"]
RAW_KEY = ["VendorID", PICKUP, DROPOFF, "passenger_count", "trip_distance"]
PREPARED_KEY = [PICKUP, DROPOFF, "PULocationID", "DOLocationID", "trip_distance", "total_amount"]

# Labels of the payment type codes.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}

# Labels of the rate codes.
RATECODE_LABELS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Unknown/Null",
}
