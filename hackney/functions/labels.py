"""Readable labels for codes and zones."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions.columns import first_present, required


def code_label(code: Column, labels: dict[int, str], missing: str) -> Column:
    """`"<code> - <label>"`, with fixed texts for unknown and missing codes."""
    number = code.try_cast("int")
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    known = F.coalesce(F.element_at(lookup, number), F.lit("Other/Unknown"))
    return F.when(code.isNull(), F.lit(missing)).otherwise(
        F.concat(number.cast("string"), F.lit(" - "), known)
    )


def labelled_zones(zones: DataFrame) -> DataFrame:
    """`LocationID, zone_label`; the label is as full as the columns of `zones` allow.

    A missing part of a label reads `nan`, an id that is no number becomes null.
    """
    id_column = required(zones, ["LocationID", "location_id", "locationid"])
    zone = first_present(zones, ["Zone", "zone"])
    borough = first_present(zones, ["Borough", "borough"])
    location = F.col(id_column).try_cast("int")

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("nan"))

    if zone is None:
        label = location.cast("string")
    elif borough is None:
        label = text(zone)
    else:
        label = F.concat(text(borough), F.lit(" — "), text(zone))
    return zones.select(location.alias("LocationID"), label.alias("zone_label"))
