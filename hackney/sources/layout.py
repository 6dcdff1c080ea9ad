"""Where a month of data lives, and which month a run is for."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

# The month a run takes when neither its conf nor its params name one.
DEFAULT_YEAR = 2024
DEFAULT_MONTH = 1


def checked_month(month: int) -> int:
    if not 1 <= month <= 12:
        raise ValueError(f"no such month: {month}")
    return month


def run_month_of(conf: Mapping[str, Any] | None, params: Mapping[str, Any]) -> tuple[int, int]:
    """Year and month of a run: its conf first, then the params, then the default."""
    chosen = {"year": DEFAULT_YEAR, "month": DEFAULT_MONTH, **params, **(conf or {})}
    return int(chosen["year"]), checked_month(int(chosen["month"]))


# The path templates below, by which other programs find the files.
@dataclass(frozen=True)
class Layout:
    """Paths under one root, e.g. `s3a://bucket`; `source` holds the files to ingest."""

    root: str
    source: str

    def _month(self, zone: str, year: int, month: int) -> str:
        return f"{self.root}/{zone}/taxi/year={year}/month={checked_month(month):02d}/"

    def trips_file(self, year: int, month: int) -> str:
        return f"{self.source}/yellow_tripdata_{year}-{checked_month(month):02d}.parquet"

    @property
    def zones_file(self) -> str:
        return f"{self.source}/taxi_zone_lookup.csv"

    def landing(self, year: int, month: int) -> str:
        return self._month("landing", year, month)

    @property
    def landing_root(self) -> str:
        return f"{self.root}/landing/taxi/"

    @property
    def landing_zones(self) -> str:
        return f"{self.root}/landing/reference/taxi_zones/"

    def prepared(self, year: int, month: int) -> str:
        return self._month("prepared", year, month)

    @property
    def prepared_root(self) -> str:
        return f"{self.root}/prepared/taxi/"

    @property
    def warehouse(self) -> str:
        return f"{self.root}/warehouse"
