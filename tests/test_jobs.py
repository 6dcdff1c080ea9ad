from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hackney import session
from hackney.plans import jobs, reports
from tests.conftest import RAW_TRIPS
from hackney.sources import readers, writers
from hackney.sources.layout import Layout, run_month_of
from tests.conftest import at

ZONES_CSV = """LocationID,Borough,Zone,service_zone
1,Manhattan,Soho,Yellow Zone
2,Queens,Astoria,Boro Zone
bad,a,b,c
265,N/A,,N/A
"""


@pytest.fixture
def lake(tmp_path, make_trips) -> Layout:
    """A source folder with one month of trips and the zone lookup."""
    lake = Layout(root=str(tmp_path / "lake"), source=str(tmp_path / "source"))
    trips = make_trips(
        {},
        {"tip_amount": 9.0},
        {"trip_distance": -1.0},
        {
            "tpep_pickup_datetime": at("2002-12-31 23:00:00"),
            "tpep_dropoff_datetime": at("2002-12-31 23:30:00"),
            "PULocationID": 77,
        },
    )
    trips.write.parquet(lake.trips_file(2024, 1))
    (tmp_path / "source" / "taxi_zone_lookup.csv").write_text(ZONES_CSV)
    return lake


def contents(df):
    return sorted(map(repr, df.collect()))


def test_a_month_from_files_to_table(spark, lake):
    rows = jobs.run_month(spark, lake, 2024, 1)
    assert rows == {"trips": 4, "zones": 4, "prepared": 3, "published": 3}

    landed = spark.read.parquet(lake.landing(2024, 1))
    assert landed.columns == RAW_TRIPS.fieldNames()
    assert landed.count() == 4

    table = readers.read_table(spark)
    assert {"year", "month", "pickup_date"} <= set(table.columns)
    assert {str(r[0]) for r in table.select("pickup_date").distinct().collect()} == {
        "2024-01-05",
        "2002-12-31",
    }
    assert {tuple(r) for r in table.select("year", "month").distinct().collect()} == {(2024, 1)}


def test_a_second_run_gives_the_same_table(spark, lake):
    jobs.run_month(spark, lake, 2024, 1)
    first = contents(readers.read_table(spark))
    jobs.run_month(spark, lake, 2024, 1)
    assert contents(readers.read_table(spark)) == first


def test_the_table_holds_only_the_last_month(spark, lake, make_trips):
    jobs.run_month(spark, lake, 2024, 1)
    make_trips({}).write.parquet(lake.trips_file(2024, 2))
    jobs.run_month(spark, lake, 2024, 2)
    assert readers.read_table(spark).count() == 1
    assert readers.read_prepared(spark, lake, 2024, 1).count() == 3


def test_dates_of_an_earlier_run_disappear(spark, lake, make_trips):
    jobs.ingest(spark, lake, 2024, 1)
    jobs.transform(spark, lake, 2024, 1)
    make_trips({}).write.mode("overwrite").parquet(lake.landing(2024, 1))
    assert jobs.transform(spark, lake, 2024, 1) == 1
    assert readers.read_prepared(spark, lake, 2024, 1).count() == 1


def test_zone_text_is_normalised(spark, lake):
    zones = readers.normalise_zones(readers.read_zone_text(spark, lake.zones_file))
    assert dict(zones.dtypes) == {
        "LocationID": "int",
        "Borough": "string",
        "Zone": "string",
        "service_zone": "string",
    }
    rows = {tuple(r) for r in zones.collect()}
    assert (None, "a", "b", "c") in rows
    assert (265, "N/A", None, "N/A") in rows


def test_zones_are_one_file(spark, lake):
    zones = readers.normalise_zones(readers.read_zone_text(spark, lake.zones_file))
    writers.land_zones(zones.repartition(4), lake.landing_zones)
    assert len(readers.read_zones(spark, lake.landing_zones).inputFiles()) == 1


def test_a_missing_zone_file_is_reported(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no zone lookup"):
        readers.read_zone_text(spark, str(tmp_path / "none.csv"))


def test_paths():
    lake = Layout("s3a://bucket", "/data")
    assert lake.trips_file(2024, 1) == "/data/yellow_tripdata_2024-01.parquet"
    assert lake.landing(2024, 3) == "s3a://bucket/landing/taxi/year=2024/month=03/"
    assert lake.prepared(2024, 12) == "s3a://bucket/prepared/taxi/year=2024/month=12/"
    assert lake.landing_zones == "s3a://bucket/landing/reference/taxi_zones/"


@pytest.mark.parametrize("month", [0, 13])
def test_invalid_months_are_rejected(month):
    with pytest.raises(ValueError, match="no such month"):
        Layout("r", "s").landing(2024, month)
    with pytest.raises(ValueError, match="no such month"):
        jobs.main(
            ["run", "--year", "2024", "--month", str(month), "--root", "r", "--source", "s"]
        )


def test_the_command_line_wins_over_params_and_defaults(monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "get_session", lambda name: type("S", (), {"stop": lambda self: None})())
    monkeypatch.setitem(jobs.JOBS, "ingest", lambda spark, lake, *month: seen.append(month))
    paths = ["ingest", "--root", "r", "--source", "s"]
    jobs.main(paths)
    jobs.main([*paths, "--params", '{"year": 2023, "month": 5}'])
    jobs.main([*paths, "--month", "7", "--params", '{"year": 2023, "month": 5}'])
    assert seen == [(2024, 1), (2023, 5), (2023, 7)]
    with pytest.raises(ValueError, match="no such month"):
        jobs.main([*paths, "--month", "13"])


def test_conf_goes_before_params_before_defaults():
    assert run_month_of(None, {}) == (2024, 1)
    assert run_month_of({}, {"year": 2023, "month": 5}) == (2023, 5)
    assert run_month_of({"month": "7"}, {"year": 2023, "month": 5}) == (2023, 7)
    with pytest.raises(ValueError):
        run_month_of({"month": 13}, {})


def test_object_store_settings_come_from_the_environment():
    assert session.object_store_settings({}) == {}
    settings = session.object_store_settings(
        {
            "S3_ENDPOINT_URL": "http://store:9000",
            "AWS_ACCESS_KEY_ID": "id",
            "AWS_SECRET_ACCESS_KEY": "secret",
        }
    )
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_staged_tables_lie_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    staged = session.stage(spark.range(10).where("id < 0"), "empty")
    assert staged.count() == 0 and staged.columns == ["id"]
    full = session.stage(spark.range(10), "full")
    assert all(shared in f for f in full.inputFiles())


def test_reports(spark, lake, zones):
    jobs.run_month(spark, lake, 2024, 1)
    profile = reports.raw_profile(spark.read.parquet(lake.landing(2024, 1)), zones)
    report = reports.validate(readers.read_table(spark))
    for name, frame in {**profile, **report}.items():
        assert frame.columns, name
        frame.collect()
    assert profile["row_count"].first()["row_count"] == 4
    assert report["zone_coverage"].first()["pu_zone_missing"] == 1
    text = spark.read.parquet(lake.landing(2024, 1)).withColumn(
        "tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("string")
    )
    assert reports.raw_profile(text, zones)["min_dates"].first()[0].year == 2002
