"""Stop codes, train ids, alert periods and translations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Trip type designators of a train id.
TRIP_TYPES = {"0": "scheduled", "=": "reroute", "/": "skip stop", "$": "turn train"}

#: Fixed format of a train id such as ``06 0123+ PEL/BBR``.
TRAIN_ID = r"^(.)(\S+) (\d{2})(\d{2})([+ ]?) ?(\w{3})/(\w{3})$"


def stop_and_direction(stop_code: Column) -> list[Column]:
    """First three characters name the stop, the rest the direction."""
    return [F.substring(stop_code, 1, 3).alias("stop_id"),
            F.substr(stop_code, F.lit(4)).alias("direction")]


def train_id_parts(train_id: Column) -> list[Column]:
    """Type, line, origin time in seconds after midnight, origin and destination."""
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(train_id, TRAIN_ID, i), F.lit(""))

    trip_type = F.lit(None).cast("string")
    for mark, name in TRIP_TYPES.items():
        trip_type = F.when(part(1) == mark, F.lit(name)).otherwise(trip_type)
    origin = (part(3).cast("int") * 3600 + part(4).cast("int") * 60
              + F.when(part(5) == "+", 30).otherwise(0))
    return [trip_type.alias("trip_type"), part(2).alias("line"),
            origin.alias("origin_seconds"), part(6).alias("origin"), part(7).alias("destination")]


def is_active(periods: Column, now: Column) -> Column:
    """True when any half-open period holds ``now``; null bounds are infinite.

    No period at all means always active.
    """
    def holds(period: Column) -> Column:
        start, end = period["start"], period["end"]
        return (start.isNull() | (start <= now)) & (end.isNull() | (now < end))

    return periods.isNull() | (F.size(periods) == 0) | F.exists(periods, holds)


def pick_translation(translations: Column, language: Column, default_language: str) -> Column:
    """Text in the user's language, else the default one, else the untagged one."""
    def first(matching) -> Column:
        return F.get(F.filter(translations, matching), F.lit(0))["text"]

    return F.coalesce(
        first(lambda t: t["language"] == language),
        first(lambda t: t["language"] == F.lit(default_language)),
        first(lambda t: t["language"].isNull()))


def vehicle_status(status: Column, stop_sequence: Column) -> Column:
    """Ignored without a stop sequence; ``IN_TRANSIT_TO`` where not given."""
    return F.when(stop_sequence.isNotNull(), F.coalesce(status, F.lit("IN_TRANSIT_TO")))


def is_rerouted(scheduled: Column, actual: Column) -> Column:
    """Both tracks known and different."""
    return F.coalesce(scheduled != actual, F.lit(False))
