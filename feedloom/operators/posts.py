"""Submitted posts: validation and routing by action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed format of a submitted date: four-digit year, month, day.
DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def post_date(date: Column) -> Column:
    return F.when(date.rlike(DATE_SHAPE), F.try_to_timestamp(date, F.lit("y-M-d")))


def validate_posts(posts: DataFrame) -> DataFrame:
    """Add ``reason``: null for a valid post, else what is wrong with it first.

    Title and author must not be blank.  A date may be missing, but one that is
    given must parse.
    """
    def blank(name: str) -> Column:
        return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""

    date = F.col("date")
    return posts.withColumn("reason", F.when(blank("title"), F.lit("title"))
                            .when(blank("author"), F.lit("author"))
                            .when(date.isNotNull() & post_date(date).isNull(), F.lit("date")))


def route_posts(posts: DataFrame) -> DataFrame:
    """Valid posts with their destination: drafts to key-value entries, the rest to the table."""
    return (validate_posts(posts).where(F.col("reason").isNull()).drop("reason")
            .withColumn("route", F.when(F.col("action") == "draft", F.lit("entries"))
                        .otherwise(F.lit("table"))))


def draft_entries(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("route") == "entries").select("seq", "title", "body")


def table_rows(routed: DataFrame) -> DataFrame:
    return (routed.where(F.col("route") == "table")
            .select("seq", "title", "body", post_date(F.col("date")).alias("date"), "author"))
