"""Bike-share ratios and message lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def availability_ratio(bikes: Column, capacity: Column, matched: Column) -> Column:
    """Bikes per dock; 1 for a station without information, null at capacity 0."""
    return (F.when(~matched | capacity.isNull(), F.lit(1.0))
            .otherwise(F.try_divide(bikes.cast("double"), capacity.cast("double"))))


def turnover_percent(net: Column, capacity: Column) -> Column:
    """Moved bikes as a percentage of capacity; null at capacity 0."""
    return F.try_divide(net.cast("double"), capacity.cast("double")) * 100.0


def turnover_text(percent: Column) -> Column:
    """Two decimals, ``NA`` where there is no percentage."""
    return F.when(percent.isNull(), F.lit("NA")).otherwise(F.format_string("%.2f", percent))


# Fixed formats: the texts of both messages.

def low_availability_line(station: Column, longitude: Column, latitude: Column,
                          bikes: Column, capacity: Column, ratio: Column) -> Column:
    def place(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("null"))

    return F.concat(
        F.lit("station_id: "), station,
        F.lit(", longitude "), place(longitude),
        F.lit(", latitude "), place(latitude),
        F.lit(", bikes: "), bikes.cast("string"),
        F.lit(", capacity: "), capacity.cast("string"),
        F.lit(", ratio: "), F.format_string("%.2f", ratio * 100), F.lit("%"))


def turnover_line(station: Column, percent: Column) -> Column:
    return F.concat(F.lit("station_id: "), station,
                    F.lit(", turnover: "), turnover_text(percent), F.lit("%"))
