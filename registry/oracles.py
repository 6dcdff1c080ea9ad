"""DuckDB SQL that gives the result of each registered query on the same tables."""

from __future__ import annotations

from hackney.schema import PAYMENT_LABELS, RATECODE_LABELS

_PICKUP = "o_orderdate + to_minutes(CAST(l_partkey * 7 % 1440 AS INTEGER))"


def _trips(lines: str) -> str:
    return f"""
    SELECT
        CAST(l_suppkey % 2 + 1 AS INTEGER) AS VendorID,
        {_PICKUP} AS tpep_pickup_datetime,
        CASE WHEN l_orderkey % 97 <> 0
             THEN {_PICKUP} + to_minutes(CAST(l_orderkey % 360 - 10 AS INTEGER))
        END AS tpep_dropoff_datetime,
        CASE WHEN l_linenumber <> 7 THEN l_linenumber::DOUBLE END AS passenger_count,
        l_quantity * 2.5::DOUBLE - 5.0::DOUBLE AS trip_distance,
        CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN 99.0::DOUBLE
             ELSE (l_partkey % 6 + 1)::DOUBLE END AS RatecodeID,
        l_returnflag AS store_and_fwd_flag,
        CASE WHEN l_orderkey % 23 = 0 THEN c_nationkey + 1000 ELSE c_nationkey END AS PULocationID,
        CASE WHEN l_orderkey % 29 = 0 THEN s_nationkey + 1000 ELSE s_nationkey END AS DOLocationID,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
        l_extendedprice / 200.0::DOUBLE - 10.0::DOUBLE AS fare_amount,
        l_tax * 10.0::DOUBLE AS mta_tax,
        l_extendedprice * l_discount / 200.0::DOUBLE AS tip_amount,
        l_extendedprice / 200.0::DOUBLE - 10.0::DOUBLE + l_tax * 10.0::DOUBLE AS total_amount
    FROM {lines}
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    """


_REPEATED_LINES = """(
    SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 50 = 0
)"""

_ZONES = """
    SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
           CASE WHEN n_nationkey % 2 = 0 THEN 'A' ELSE 'B' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
"""

_DRIFTING_MONTHS = """
    SELECT 2024 AS year, VendorID AS month, passenger_count, RatecodeID, count(*) AS trips,
           round(sum(tip_amount), 6) AS tips, count(CASE WHEN VendorID = 1 THEN mta_tax END) AS taxed
    FROM trips GROUP BY VendorID, passenger_count, RatecodeID
"""

_KEPT = """
    SELECT * FROM trips
    WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
      AND trip_distance >= 0 AND total_amount >= 0
      AND date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) > 0
"""

_DERIVED = """
    SELECT *,
        CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
        CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
        CAST(tpep_dropoff_datetime AS DATE) AS dropoff_date,
        date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0::DOUBLE
            AS trip_duration_min,
        trip_distance
            / (date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0::DOUBLE
               / 60.0::DOUBLE) AS avg_mph
    FROM kept
"""

_NORMALISED = """
    SELECT * REPLACE (
        CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
        CAST(trunc(RatecodeID) AS INTEGER) AS RatecodeID
    ) FROM derived
"""

_PREPARED = """
    SELECT t.*,
        pu.Borough AS PU_Borough, pu.Zone AS PU_Zone, pu.service_zone AS PU_service_zone,
        dz.Borough AS DO_Borough, dz.Zone AS DO_Zone, dz.service_zone AS DO_service_zone
    FROM normalised t
    LEFT JOIN zones pu ON t.PULocationID = pu.LocationID
    LEFT JOIN zones dz ON t.DOLocationID = dz.LocationID
"""


def _with(query: str, repeated: bool = False) -> str:
    return f"""
    WITH trips AS ({_trips(_REPEATED_LINES if repeated else "lineitem")}),
    zones AS ({_ZONES}),
    kept AS ({_KEPT}),
    derived AS ({_DERIVED}),
    normalised AS ({_NORMALISED}),
    prepared AS ({_PREPARED})
    {query}
    """


_DERIVED_COLUMNS = """tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, pickup_date,
    pickup_hour, dropoff_date, trip_duration_min, avg_mph"""

_METRICS = ["trip_distance", "total_amount", "trip_duration_min", "avg_mph"]
_NUMERIC = [
    "VendorID", "passenger_count", "trip_distance", "RatecodeID", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount", "mta_tax", "tip_amount", "total_amount",
]
_ALL = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
    "trip_distance", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID",
    "payment_type", "fare_amount", "mta_tax", "tip_amount", "total_amount",
]
_RAW_KEY = "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance"
_PREPARED_KEY = """tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
    trip_distance, total_amount"""
_TEXT = ["store_and_fwd_flag"] + [
    f"{role}_{name}" for role in ["PU", "DO"] for name in ["Borough", "Zone", "service_zone"]
]


def _describe(name: str, source: str, label: str | None = None) -> str:
    return f"""SELECT '{label or name}' AS column_name, count({name}) AS "count",
        round(avg({name}), 6) AS mean, round(stddev_samp({name}), 6) AS std,
        round(min({name})::DOUBLE, 6) AS min,
        round(quantile_cont({name}::DOUBLE, 0.25), 8) AS p25,
        round(quantile_cont({name}::DOUBLE, 0.5), 8) AS p50,
        round(quantile_cont({name}::DOUBLE, 0.75), 8) AS p75,
        round(max({name})::DOUBLE, 6) AS max FROM {source}"""


def _micros(value: str) -> str:
    return f"make_timestamp(CAST(floor({value}) AS BIGINT))"


def _describe_timestamps(name: str, source: str) -> str:
    us = f"epoch_us({name})"
    return f"""SELECT '{name}' AS column_name, count({name}) AS "count",
        make_timestamp(CAST(sum({us}) // count({name}) AS BIGINT)) AS mean,
        min({name}) AS min,
        {_micros(f"quantile_cont({us}::DOUBLE, 0.25)")} AS p25,
        {_micros(f"quantile_cont({us}::DOUBLE, 0.5)")} AS p50,
        {_micros(f"quantile_cont({us}::DOUBLE, 0.75)")} AS p75,
        max({name}) AS max FROM {source}"""


def _describe_text(name: str, source: str = "prepared") -> str:
    return f"""SELECT '{name}' AS column_name, CAST(sum(n) AS BIGINT) AS "count",
        count(*) AS "unique", first(value ORDER BY n DESC, value) AS top, max(n) AS freq
        FROM (SELECT {name} AS value, count(*) AS n FROM {source}
              WHERE {name} IS NOT NULL GROUP BY 1)
    """


def _long(section: str, sql: str, keys: list[str], measures: list[str], digits: int = 6) -> str:
    """A section of a report as rows `section, key, measure, value`; quantiles keep 8 digits."""
    places = {m: 8 if m in ("p25", "p50", "p75") or "_q[" in m else digits for m in measures}
    key = ", ".join(f"coalesce({k}::VARCHAR, '-')" for k in keys)
    names = ", ".join(f"'{m}'" for m in measures) or "'row'"
    values = ", ".join(f'round("{m}"::DOUBLE, {p})' for m, p in places.items()) or "1.0::DOUBLE"
    return f"""SELECT '{section}' AS section, key, unnest([{names}]) AS measure,
        unnest([{values}]) AS value
        FROM (SELECT {f"concat_ws('|', {key})" if keys else "''"} AS key, * FROM ({sql}))"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _missing(name: str) -> str:
    nulls = f"count(*) - count({name})"
    return f"""SELECT '{name}' AS column_name, {nulls} AS null_count,
        round(({nulls})::DOUBLE / count(*) * 100, 6) AS null_pct FROM trips"""


def _inventory(position: int, name: str, source: str = "trips") -> str:
    return f"""SELECT {position}::INTEGER AS position, '{name}' AS column_name,
        CASE typeof(first({name})) WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
             WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
             WHEN 'DATE' THEN 'date' END AS data_type,
        count({name}) AS non_null_count FROM {source}"""


def _top_values(name: str) -> str:
    return f"""SELECT '{name}' AS column_name, value, trips, CAST(rank AS INTEGER) AS rank FROM (
        SELECT value, trips, row_number() OVER (ORDER BY trips DESC, value NULLS LAST) AS rank
        FROM (SELECT {name}::VARCHAR AS value, count(*) AS trips FROM trips GROUP BY 1)
    ) WHERE rank <= 20"""


def _top_zones(role: str, name: str) -> str:
    return f"""SELECT '{role}' AS role, CAST(rank AS INTEGER) AS rank, c.LocationID,
        coalesce(Borough || ' — ' || Zone, c.LocationID::VARCHAR) AS zone_label, trips
    FROM (
        SELECT *, row_number() OVER (ORDER BY trips DESC, LocationID) AS rank
        FROM (SELECT {name} AS LocationID, count(*) AS trips FROM trips
              WHERE {name} IS NOT NULL GROUP BY 1)
    ) c LEFT JOIN zones z ON c.LocationID = z.LocationID
    WHERE rank <= 20"""


def _histogram(name: str, bins: int, source: str) -> str:
    """Bins by their edges: bin i holds the values from edge i to before edge i + 1."""
    return f"""SELECT '{name}' AS column_name, CAST(i AS INTEGER) AS bin,
        round(lo + (i + 0.5::DOUBLE) * ((hi - lo) / {bins}.0::DOUBLE), 6) AS center,
        (SELECT count(*) FROM {source} s
         WHERE s.{name} >= lo + i * ((hi - lo) / {bins}.0::DOUBLE)
           AND (s.{name} < lo + (i + 1) * ((hi - lo) / {bins}.0::DOUBLE) OR i = {bins - 1}))
            AS "count"
    FROM (SELECT min({name}) AS lo, max({name}) AS hi FROM {source}),
         range({bins}) r(i)"""


def _distribution(name: str) -> str:
    return f"SELECT {name}, count(*) AS trips FROM prepared GROUP BY 1"


def _quantiles(name: str) -> str:
    return _union(
        [
            f"""SELECT '{name}' AS column_name, {p}::DOUBLE AS probability,
            round(quantile_cont({name}, {p}), 8) AS value FROM prepared"""
            for p in [0.5, 0.9, 0.95, 0.99]
        ]
    )


def _code_label(name: str, labels: dict[int, str], missing: str) -> str:
    cases = " ".join(f"WHEN {code} THEN '{code} - {label}'" for code, label in labels.items())
    return f"""SELECT {name}, CASE WHEN {name} IS NULL THEN '{missing}' ELSE CASE
        CAST({name} AS INTEGER) {cases}
        ELSE CAST({name} AS INTEGER)::VARCHAR || ' - Other/Unknown' END END AS label,
        count(*) AS trips FROM trips GROUP BY 1"""


_BY_DATE = "SELECT pickup_date, count(*) AS trips FROM prepared GROUP BY 1"

_EVENT_MINUTES = "epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')"


def oracle_sql() -> dict[str, str]:
    found = _plain_sql()
    return found | _check_sql() | _report_sql(found)


def _check_sql() -> dict[str, str]:
    return {
        "preview_check": _with(
            """SELECT least(count(*), 100)::BIGINT AS rows_shown, 0::BIGINT AS rows_unknown,
               0::BIGINT AS copies_too_many FROM prepared"""
        ),
        "sample_rows_check": _with(
            """SELECT least(count(*), 5000)::BIGINT AS rows_shown, 0::BIGINT AS rows_unknown,
               0::BIGINT AS copies_too_many FROM prepared"""
        ),
        "describe_sample_check": _with(
            _union(
                [
                    f"""SELECT '{name}' AS column_name, least(count({name}), 5000)::BIGINT AS "count",
                    true AS within FROM prepared"""
                    for name in _METRICS
                ]
            )
        ),
    }


_JOINED_BY = ["DOLocationID", "PULocationID"]  # a join by name puts its key first
_PREPARED_COLUMNS = _JOINED_BY + [n for n in _ALL if n not in _JOINED_BY] + [
    "pickup_date", "pickup_hour", "dropoff_date", "trip_duration_min", "avg_mph",
    *[f"{role}_{name}" for role in ["PU", "DO"] for name in ["Borough", "Zone", "service_zone"]],
]


def _report_sql(plain: dict[str, str]) -> dict[str, str]:
    """The sections of both reports; most are queries of their own."""
    described = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    quartiles = ["mean", "min", "p25", "p50", "p75", "max"]
    checks = [f"{r}_{n}_missing" for n in ["zone", "borough"] for r in ["pu", "do"]]
    raw = [
        _long("row_count", _with(f"SELECT count(*) AS row_count, {len(_ALL)} AS column_count FROM trips"),
              [], ["row_count", "column_count"]),
        _long("column_inventory", plain["column_inventory"], ["position", "column_name", "data_type"],
              ["non_null_count"]),
        _long("missing_summary", plain["missing_summary"], ["column_name"], ["null_count", "null_pct"]),
        _long("min_dates", plain["min_dates"],
              ["min_tpep_pickup_datetime", "min_tpep_dropoff_datetime"], []),
        _long("describe_numeric", plain["describe_numeric"], ["column_name"], described),
        _long("describe_timestamps", plain["describe_timestamps"], ["column_name", *quartiles], ["count"]),
        _long("describe_categorical", _with(_describe_text("store_and_fwd_flag", "trips")),
              ["column_name", "top"], ["count", "unique", "freq"]),
        _long("duplicate_rows", _with(
            "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS duplicate_rows"
            " FROM trips"), [], ["duplicate_rows"]),
        _long("categorical_value_counts", plain["categorical_value_counts"],
              ["column_name", "value", "rank"], ["trips"]),
        _long("raw_key_duplicates", _with(
            f"SELECT count(*) - count(DISTINCT ROW({_RAW_KEY})) AS duplicate_rows FROM trips"),
              [], ["duplicate_rows"]),
        _long("describe_duration", plain["describe_duration"], ["column_name"], described),
        _long("histograms", plain["histogram_total_amount"], ["column_name", "bin"], ["center", "count"]),
        _long("histograms", plain["histogram_tip_amount"], ["column_name", "bin"], ["center", "count"]),
        _long("passenger_counts", plain["passenger_counts"], ["passenger_count"], ["trips"]),
        _long("payment_counts", plain["payment_counts_labelled"], ["payment_type", "label"], ["trips"]),
        _long("ratecode_counts", plain["ratecode_counts_labelled"], ["RatecodeID", "label"], ["trips"]),
        _long("trips_by_hour", plain["raw_trips_by_hour"], ["hour"], ["trips"]),
        _long("mean_amount_by_hour", plain["hourly_mean_filled"], ["hour"], ["mean_amount"]),
        _long("top_zones", plain["top_zones_labelled"], ["role", "rank", "LocationID", "zone_label"],
              ["trips"]),
    ]
    percentiles = ", ".join(
        f'quantile_cont({n}, {p}) AS "{n}_q[{i}]"'
        for n in _METRICS
        for i, p in enumerate([0.5, 0.9, 0.95, 0.99])
    )
    prepared = [
        _long("row_count", plain["row_count"], [], ["row_count", "column_count"]),
        _long("column_inventory", _with(_union(
            [_inventory(i, n, "prepared") for i, n in enumerate(_PREPARED_COLUMNS, 1)])),
              ["position", "column_name", "data_type"], ["non_null_count"]),
        _long("temporal_coverage", plain["temporal_coverage"], ["min_date", "max_date"],
              ["distinct_hours"]),
        _long("hourly_by_date", plain["hourly_by_date"], ["pickup_date", "pickup_hour"],
              ["trips", "avg_distance_miles", "avg_total_amount"], digits=9),
        _long("trips_by_hour", plain["trips_by_hour"], ["pickup_hour"],
              ["trips", "avg_total_amount", "avg_trip_distance"]),
        _long("trips_by_weekday", plain["trips_by_weekday"], ["dow"], ["trips", "avg_total_amount"]),
        _long("range_checks", plain["range_checks"], [], [
            "trip_distance_negative", "trip_distance_gt_100", "total_amount_negative",
            "total_amount_gt_500", "duration_le_0", "duration_gt_300", "avg_mph_gt_90",
            "avg_mph_negative"]),
        _long("zone_coverage", plain["zone_coverage"], [], [*checks, *[f"{c}_pct" for c in checks]]),
        _long("natural_key_duplicates", _with(
            f"""SELECT count(*) AS rows_total,
                count(DISTINCT ROW({_PREPARED_KEY})) AS distinct_trip_keys,
                count(*) - count(DISTINCT ROW({_PREPARED_KEY})) AS estimated_duplicates
                FROM prepared"""), [], ["rows_total", "distinct_trip_keys", "estimated_duplicates"]),
        _long("metric_percentiles", _with(f"SELECT {percentiles} FROM prepared"), [],
              [f"{n}_q[{i}]" for n in _METRICS for i in range(4)]),
        _long("histograms", plain["histogram_metrics"], ["column_name", "bin"], ["center", "count"]),
        _long("top_pickup_zones", plain["top_pickup_zones"], ["PU_Borough", "PU_Zone"], ["trips"]),
        _long("top_od_pairs", plain["top_od_pairs"], ["PU_Zone", "DO_Zone"],
              ["trips", "avg_trip_distance", "avg_total_amount"]),
        *[_long(f"{n}_distribution", plain[q], [n], ["trips"])
          for n, q in [("payment_type", "payment_distribution"), ("RatecodeID", "ratecode_distribution"),
                       ("passenger_count", "passenger_distribution")]],
    ]
    return {"raw_profile": _union(raw), "validate": _union(prepared)}


def _plain_sql() -> dict[str, str]:
    missing = ["PU_Zone", "DO_Zone", "PU_Borough", "DO_Borough"]
    counted = ", ".join(
        f"CAST(sum(CASE WHEN {n} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {n.lower()}_missing"
        for n in missing
    )
    shares = ", ".join(
        f"round(sum(CASE WHEN {n} IS NULL THEN 1 ELSE 0 END)::DOUBLE / count(*) * 100, 6)"
        f" AS {n.lower()}_missing_pct"
        for n in missing
    )
    checks = {
        "trip_distance_negative": "trip_distance < 0",
        "trip_distance_gt_100": "trip_distance > 100",
        "total_amount_negative": "total_amount < 0",
        "total_amount_gt_500": "total_amount > 500",
        "duration_le_0": "trip_duration_min <= 0",
        "duration_gt_300": "trip_duration_min > 300",
        "avg_mph_gt_90": "avg_mph IS NOT NULL AND avg_mph > 90",
        "avg_mph_negative": "avg_mph IS NOT NULL AND avg_mph < 0",
    }
    ranges = ", ".join(
        f"CAST(sum(CASE WHEN {test} THEN 1 ELSE 0 END) AS BIGINT) AS {name}"
        for name, test in checks.items()
    )
    return {
        # sources and sinks
        "scan_trips": _with("SELECT * FROM trips"),
        "scan_prepared": _with(
            "SELECT *, 2024::INTEGER AS year, 1::INTEGER AS month FROM prepared"
        ),
        "prepared_roundtrip": _with(_BY_DATE),
        "publish_table": _with(_BY_DATE),
        "run_month": _with(_BY_DATE),
        "landed_zones": _with("SELECT * FROM zones"),
        "scan_drifting_months": _with(_DRIFTING_MONTHS),
        "row_count": _with(
            """SELECT count(*) AS row_count,
               CAST(max(len(json_keys(to_json(p)))) AS INTEGER) AS column_count FROM prepared p"""
        ),
        "column_inventory": _with(
            _union([_inventory(i, name) for i, name in enumerate(_ALL, 1)])
        ),
        # preparation
        "clean_trips": _with("SELECT * FROM kept"),
        "derive_trip_features": _with(f"SELECT {_DERIVED_COLUMNS} FROM derived"),
        "normalise_codes": _with(
            "SELECT passenger_count, payment_type, RatecodeID, count(*) AS trips"
            " FROM normalised GROUP BY 1, 2, 3"
        ),
        "enrich_zones": _with("SELECT * FROM prepared"),
        # quality
        "nonpositive_distance": _with("SELECT * FROM trips WHERE trip_distance <= 0"),
        "problem_fares": _with(
            """SELECT fare_amount, 'fare_amount' AS problem_col,
                      NULL::DOUBLE AS total_amount FROM trips WHERE fare_amount <= 0
               UNION ALL
               SELECT NULL, 'total_amount', total_amount FROM trips
               WHERE total_amount <= 0"""
        ),
        "missing_summary": _with(_union([_missing(name) for name in _ALL])),
        "min_dates": _with(
            """SELECT min(tpep_pickup_datetime)::DATE AS min_tpep_pickup_datetime,
                      min(tpep_dropoff_datetime)::DATE AS min_tpep_dropoff_datetime FROM trips"""
        ),
        "duplicate_rows": _with(
            """SELECT (SELECT count(*) FROM trips)
                      - (SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS duplicate_rows""",
            repeated=True,
        ),
        "raw_key_duplicates": _with(
            f"SELECT count(*) - count(DISTINCT ROW({_RAW_KEY})) AS duplicate_rows FROM trips",
            repeated=True,
        ),
        "natural_key_duplicates": _with(
            f"""SELECT count(*) AS rows_total,
                count(DISTINCT ROW({_PREPARED_KEY})) AS distinct_trip_keys,
                count(*) - count(DISTINCT ROW({_PREPARED_KEY})) AS estimated_duplicates
                FROM prepared""",
            repeated=True,
        ),
        "range_checks": _with(f"SELECT {ranges} FROM prepared"),
        "zone_coverage": _with(f"SELECT {counted}, {shares} FROM prepared"),
        # distributions
        "payment_distribution": _with(_distribution("payment_type")),
        "ratecode_distribution": _with(_distribution("RatecodeID")),
        "passenger_distribution": _with(_distribution("passenger_count")),
        "passenger_counts": _with(
            "SELECT passenger_count, count(*) AS trips FROM trips GROUP BY 1"
        ),
        "payment_counts_labelled": _with(
            _code_label("payment_type", PAYMENT_LABELS, "NaN (missing)")
        ),
        "ratecode_counts_labelled": _with(_code_label("RatecodeID", RATECODE_LABELS, "NaN")),
        "categorical_value_counts": _with(
            _union(
                [
                    _top_values(name)
                    for name in ["VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag"]
                ]
            )
        ),
        "histogram_total_amount": _with(_histogram("total_amount", 100, "trips")),
        "histogram_tip_amount": _with(_histogram("tip_amount", 100, "trips")),
        "histogram_metrics": _with(
            _union([_histogram(name, 80, "prepared") for name in _METRICS])
        ),
        "metric_percentiles": _with(_union([_quantiles(name) for name in _METRICS])),
        # descriptions
        "describe_numeric": _with(_union([_describe(name, "trips") for name in _NUMERIC])),
        "describe_timestamps": _with(
            _union(
                [
                    _describe_timestamps(name, "trips")
                    for name in ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
                ]
            )
        ),
        "describe_categorical": _with(_union([_describe_text(name) for name in _TEXT])),
        "describe_duration": _with(
            f"""SELECT * FROM ({_describe('m', '''(SELECT (epoch_us(tpep_dropoff_datetime)
                - epoch_us(tpep_pickup_datetime)) / 60000000.0::DOUBLE AS m FROM trips)''',
                'trip_duration_min')})"""
        ),
        # demand
        "temporal_coverage": _with(
            """SELECT min(pickup_date) AS min_date, max(pickup_date) AS max_date,
                      count(DISTINCT pickup_hour) AS distinct_hours FROM prepared"""
        ),
        "hourly_by_date": _with(
            """SELECT pickup_date, pickup_hour, count(*) AS trips,
                      round(avg(trip_distance), 9) AS avg_distance_miles,
                      round(avg(total_amount), 9) AS avg_total_amount
               FROM prepared GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 100"""
        ),
        "trips_by_hour": _with(
            """SELECT pickup_hour, count(*) AS trips,
                      round(avg(total_amount), 6) AS avg_total_amount,
                      round(avg(trip_distance), 6) AS avg_trip_distance
               FROM prepared GROUP BY 1"""
        ),
        "trips_by_weekday": _with(
            """SELECT CAST(extract('dow' FROM pickup_date) AS INTEGER) AS dow, count(*) AS trips,
                      round(avg(total_amount), 6) AS avg_total_amount
               FROM prepared GROUP BY 1"""
        ),
        "raw_trips_by_hour": _with(
            """SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour, count(*) AS trips
               FROM trips GROUP BY 1"""
        ),
        "hourly_mean_filled": _with(
            """SELECT CAST(h AS INTEGER) AS hour, round(avg(total_amount), 6) AS mean_amount
               FROM range(24) r(h) LEFT JOIN trips ON hour(tpep_pickup_datetime) = h GROUP BY 1"""
        ),
        "top_pickup_zones": _with(
            """SELECT PU_Borough, PU_Zone, count(*) AS trips FROM prepared GROUP BY 1, 2
               ORDER BY trips DESC, PU_Borough NULLS LAST, PU_Zone NULLS LAST LIMIT 20"""
        ),
        "top_od_pairs": _with(
            """SELECT PU_Zone, DO_Zone, count(*) AS trips,
                      round(avg(trip_distance), 6) AS avg_trip_distance,
                      round(avg(total_amount), 6) AS avg_total_amount
               FROM prepared GROUP BY 1, 2
               ORDER BY trips DESC, PU_Zone NULLS LAST, DO_Zone NULLS LAST LIMIT 20"""
        ),
        "top_zones_labelled": _with(
            _union([_top_zones("pickup", "PULocationID"), _top_zones("dropoff", "DOLocationID")])
        ),
        # the same operators on the events table, whose timestamps have fractional seconds
        "events_by_hour": (
            "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS trips FROM events GROUP BY 1"
        ),
        "events_mean_by_hour": """SELECT CAST(h AS INTEGER) AS hour,
            round(avg(value), 6) AS mean_amount
            FROM range(24) r(h) LEFT JOIN events ON hour(ts) = h GROUP BY 1""",
        "events_min_date": "SELECT min(ts)::DATE AS min_ts FROM events",
        "events_describe_timestamps": _describe_timestamps("ts", "events"),
        "events_describe_duration": _describe(
            "m",
            f"(SELECT ({_EVENT_MINUTES}) / 60000000.0::DOUBLE AS m FROM events)",
            "trip_duration_min",
        ),
        "events_describe_categorical": """SELECT 'event_type' AS column_name,
            CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
            first(value ORDER BY n DESC, value) AS top, max(n) AS freq
            FROM (SELECT event_type AS value, count(*) AS n FROM events
                  WHERE event_type IS NOT NULL GROUP BY 1)""",
    }
