"""Service alerts: activity and the entities they inform."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.trains import is_active


def active_alerts(alerts: DataFrame, now: Column) -> DataFrame:
    """Alerts with an ``active_period`` array that holds ``now``."""
    return alerts.where(is_active(F.col("active_period"), now))


def informed_entities(entities: DataFrame) -> DataFrame:
    """(id, agency_id, route_id, route_type, trip_id, stop_id): one row per selector of
    the alerts among feed entities."""
    listed = entities.where(F.col("alert").isNotNull()).select(
        "id", F.explode("alert.informedEntity").alias("_s"))
    return listed.select(
        "id", F.col("_s.agencyId").alias("agency_id"), F.col("_s.routeId").alias("route_id"),
        F.col("_s.routeType").alias("route_type"), F.col("_s.trip.tripId").alias("trip_id"),
        F.col("_s.stopId").alias("stop_id"))


def _merged(left: DataFrame, right: DataFrame, specifiers: list[str]) -> DataFrame:
    """The selectors that two selectors of an alert give together, if they agree.

    One that gives all that the other gives adds nothing.  Each is listed under every
    set of specifiers that the other can have, with the values that both give: one
    equi-join, where selectors that disagree never meet.
    """
    full = (1 << len(specifiers)) - 1

    def pairs(own: int) -> list[int]:
        return [m for m in range(1, full + 1) if (m & own) not in (m, own)]

    def listed(rows: DataFrame, side: str, low: bool) -> DataFrame:
        others = F.create_map(*[x for own in range(1, full + 1) for x in (
            F.lit(own), F.array(*[F.lit(m) for m in pairs(own) if (own < m) == low]).cast("array<int>"))])
        rows = rows.select("id", *specifiers, "_mask", F.explode(others[F.col("_mask")]).alias("_other"))
        common = F.col("_mask").bitwiseAND(F.col("_other"))
        return rows.select(
            "id", (F.col("_mask") if low else F.col("_other")).alias("_low"),
            (F.col("_other") if low else F.col("_mask")).alias("_high"),
            F.struct(*[F.when(common.bitwiseAND(1 << i) != 0, F.col(s)).alias(s)
                       for i, s in enumerate(specifiers)]).alias("_common"),
            F.struct(*specifiers).alias(side))

    met = listed(left, "_a", True).join(listed(right, "_b", False), ["id", "_low", "_high", "_common"])
    return met.select("id", *[F.coalesce(f"_a.{s}", f"_b.{s}").alias(s) for s in specifiers],
                      F.col("_low").bitwiseOR(F.col("_high")).alias("_mask"))


def _weighted(selectors: DataFrame, specifiers: list[str]) -> DataFrame:
    """Selectors with whole weights whose sum, over those that a target matches, is one per alert.

    ``selectors`` are the distinct ones of alerts that have several.  With them go all that some
    of them give together, so that what a target matches of an alert has one greatest element;
    its weight is one less the weights of what is part of it.
    """
    size = len(specifiers)
    closed, together = selectors, 1
    while together < size:
        closed = closed.unionByName(_merged(closed, closed, specifiers)).distinct()
        together *= 2
    subsets = F.create_map(*[x for own in range(1, 1 << size) for x in (
        F.lit(own), F.array(*[F.lit(m) for m in range(1, own) if m & own == m]).cast("array<int>"))])
    whole = F.struct("_mask", *specifiers)
    parts = closed.select("id", "_mask", *specifiers, F.explode_outer(subsets[F.col("_mask")]).alias("_part")).select(
        "id", whole.alias("_whole"), F.col("_part").alias("_mask"),
        F.struct(*[F.when(F.col("_part").bitwiseAND(1 << i) != 0, F.col(s)).alias(s)
                   for i, s in enumerate(specifiers)]).alias("_values"))
    held = closed.select("id", "_mask", F.struct(*specifiers).alias("_values"), F.col("_mask").alias("_held"))
    weighed = F.array().cast("array<struct<mask:int,weight:bigint>>")

    def rest(weights: Column) -> Column:
        return F.lit(1).cast("bigint") - F.aggregate(weights, F.lit(0).cast("bigint"), lambda n, w: n + w["weight"])

    # Part of a part is part of the whole: the masks that an element holds give its weight.
    weights = F.aggregate(F.sort_array("_masks"), weighed, lambda done, m: F.concat(done, F.array(F.struct(
        m.alias("mask"), rest(F.filter(done, lambda w: w["mask"].bitwiseAND(m) == w["mask"])).alias("weight")))))
    return (parts.join(held, ["id", "_mask", "_values"], "left").groupBy("id", "_whole")
            .agg(F.collect_list("_held").alias("_masks"))
            .select("id", *[F.col(f"_whole.{s}").alias(s) for s in specifiers], rest(weights).alias("_weight")))


def alert_targets(alerts: DataFrame, targets: DataFrame, specifiers: list[str]) -> DataFrame:
    """How many alerts inform each target, and the newest of them.

    ``alerts`` is (id, one nullable column per specifier), a row per selector; a
    target must match every specifier that a selector gives, and a selector
    without any informs nobody.  An alert counts once for a target, however many
    of its selectors match.  ``targets`` are distinct rows.

    Alerts are first combined per given values; where an alert has several selectors,
    weights (see :func:`_weighted`) make it count once.  Each target is listed once under
    every combination of its own values, so all shapes of selectors meet it in one
    equi-join: no wildcard comparison, and no row per alert and target.
    """
    given = reduce(Column.__or__, [F.col(s).isNotNull() for s in specifiers])
    selectors = alerts.where(given).select("id", *specifiers).distinct()
    per_alert = selectors.groupBy("id").agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*specifiers)).alias("_one"))
    mask = reduce(Column.__add__, [F.when(F.col(s).isNotNull(), 1 << i).otherwise(0)
                                   for i, s in enumerate(specifiers)])
    single = per_alert.where("_n = 1").select("id", "_one.*", F.lit(1).cast("bigint").alias("_weight"))
    several = _weighted(selectors.join(per_alert.where("_n > 1").select("id"), "id", "left_semi")
                        .withColumn("_mask", mask), specifiers)
    entries = (single.unionByName(several).groupBy(*specifiers)
               .agg(F.sum("_weight").alias("_alerts"), F.max("id").alias("_newest"))
               .select(*[F.col(s).alias(f"_s_{s}") for s in specifiers], "_alerts", "_newest"))

    def shape(chosen: tuple[str, ...]) -> Column:
        known = reduce(Column.__and__, [F.col(s).isNotNull() for s in chosen])
        return F.when(known, F.struct(*[
            (F.col(s) if s in chosen else F.lit(None).cast(dict(targets.dtypes)[s])).alias(s)
            for s in specifiers]))

    shapes = [shape(c) for n in range(1, len(specifiers) + 1) for c in combinations(specifiers, n)]
    listed = targets.select("*", F.explode(F.array_compact(F.array(*shapes))).alias("_shape"))
    match = reduce(Column.__and__, [F.col(f"_shape.{s}").eqNullSafe(F.col(f"_s_{s}")) for s in specifiers])
    return (listed.join(entries, match).groupBy(*targets.columns)
            .agg(F.sum("_alerts").alias("alerts"), F.max("_newest").alias("last_id")))
