"""Price ticks: positional CSV, pair fan-out, sliding pairwise correlation.

The same functions run on batch tables and on streams.  On a stream every
input needs a watermark on ``trade_date`` and the result appends when a window
closes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SIGNAL_THRESHOLD = -0.75


def pairs_of(tickers: Sequence[str]) -> list[tuple[str, str]]:
    """All pairs of the configured tickers, in their listed order."""
    return list(combinations(tickers, 2))


def parse_ticks(lines: DataFrame, ticker: str, value: str = "value",
                keep: Sequence[str] = ()) -> DataFrame:
    """(ticker, trade_date, price) of one ticker's lines, header lines removed.

    Lines may arrive as text or as UTF-8 bytes.  Only the first two positional
    fields count.  A line whose date cannot be read keeps a null date; see
    :func:`undated_lines`.
    """
    text = F.col(value).cast("string")
    field = F.split(text, ",", 3)
    date = F.get(field, F.lit(0))
    header = (text == "date") | text.startswith("date,")
    return lines.where(~header).select(
        F.lit(ticker).alias("ticker"),
        F.try_to_timestamp(date, F.lit("y/M/d")).alias("trade_date"),
        F.get(field, F.lit(1)).try_cast("double").alias("price"), *keep)


def undated_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The lines, headers aside, whose date :func:`parse_ticks` cannot read."""
    parsed = parse_ticks(lines.select(F.col(value).alias("value"), F.col(value).alias("_line")), "", "value",
                         keep=["_line"])
    return parsed.where(F.col("trade_date").isNull()).select(F.col("_line").cast("string").alias(value))


def union_ticks(inputs: Sequence[DataFrame]) -> DataFrame:
    """The per-ticker inputs as one keyed table."""
    return reduce(DataFrame.unionByName, inputs)


def daily_prices(ticks: DataFrame) -> DataFrame:
    """One price per (ticker, day): the mean.  Combines map-side to a tiny table.

    On a stream the day is stamped with its window's event time, so that
    further windows can follow.
    """
    daily = (ticks.groupBy("ticker", F.window("trade_date", "1 day").alias("day"))
             .agg(F.avg("price").alias("price")))
    at = F.window_time("day") if ticks.isStreaming else F.col("day.start")
    return daily.select("ticker", at.alias("trade_date"), "price")


def pair_sides(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(ticker, t1, t2): each pair once under either of its tickers."""
    rows = [(t, a, b) for a, b in pairs for t in dict.fromkeys((a, b))]
    return spark.createDataFrame(rows, "ticker string, t1 string, t2 string")


def pair_fanout(ticks: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Each tick once per configured pair that contains its ticker.

    An equi-join on the ticker: the plan does not grow with the pairs.
    """
    return ticks.join(pair_sides(ticks.sparkSession, pairs), "ticker").select(*ticks.columns, "t1", "t2")


def aligned_days(ticks: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Both prices of each pair side by side, one row per (pair, day)."""
    fanned = pair_fanout(ticks, pairs)

    def price_of(side: str) -> Column:
        return F.max(F.when(F.col("ticker") == F.col(side), F.col("price")))

    return (fanned.groupBy(F.window("trade_date", "1 day").alias("day"), "t1", "t2")
            .agg(price_of("t1").alias("a"), price_of("t2").alias("b"))
            .select("t1", "t2", F.window_time("day").alias("day_time"), "a", "b"))


def _sliding(size: str, period: str) -> Column:
    return F.window("day_time", size, period).alias("window")


def _window_columns(df: DataFrame, *columns) -> DataFrame:
    return df.select("t1", "t2", F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *columns)


def cogroup_windows(ticks: DataFrame, pairs: Sequence[tuple[str, str]],
                    size: str = "10 days", period: str = "1 day") -> DataFrame:
    """Per pair and window, one list of (day, price) per side.

    The lists hold one entry per day, so their length is bounded by the window.
    """
    def side(column: str) -> Column:
        entry = F.when(F.col(column).isNotNull(),
                       F.struct(F.to_date("day_time").alias("day"), F.col(column).alias("price")))
        return F.sort_array(F.collect_list(entry))

    grouped = (aligned_days(ticks, pairs).groupBy(_sliding(size, period), "t1", "t2")
               .agg(side("a").alias("prices_1"), side("b").alias("prices_2")))
    return _window_columns(grouped, "prices_1", "prices_2")


def cogroup_counts(ticks: DataFrame, pairs: Sequence[tuple[str, str]],
                   size: str = "10 days", period: str = "1 day") -> DataFrame:
    """Sizes of the two lists of :func:`cogroup_windows`, and of their common days."""
    grouped = (aligned_days(ticks, pairs).groupBy(_sliding(size, period), "t1", "t2")
               .agg(F.count("a").alias("n_1"), F.count("b").alias("n_2"),
                    F.count(F.col("a") + F.col("b")).alias("n_both")))
    return _window_columns(grouped, "n_1", "n_2", "n_both")


def _day_span(length: str) -> int | None:
    """The days of a window length such as "10 days"; none for other units."""
    count, unit = length.split()
    return int(count) if unit in ("day", "days") else None


def _ends(pair_days: DataFrame, size: int, period: int) -> DataFrame:
    """The pair's days and, with no prices, the later days on which a window ends that
    holds the last price before them.

    Days are numbers; a day that starts no new gap adds nothing, so a pair with prices on
    all days has one row for each and ``size`` - 1 more after its last.
    """
    by_pair = Window.partitionBy("t1", "t2").orderBy("day")
    # After the last day of a pair the next one is null, which least() passes over.
    last = F.least(F.col("day") + F.lit(size - 1), F.lead("day").over(by_pair) - 1)
    ends = pair_days.withColumn("_last", last).withColumn("_end", F.explode(F.sequence("day", "_last")))
    own = F.col("_end") == F.col("day")
    return ends.select("t1", "t2", "_end", *[F.when(own, F.col(c)).alias(c) for c in ("a", "b")],
                       ((F.col("_end") + 1 - size) % period == 0).alias("_listed"))


def pane_correlation(ticks: DataFrame, pairs: Sequence[tuple[str, str]], size: int = 10, period: int = 1) -> DataFrame:
    """:func:`pair_correlation` of a batch for windows of whole days, without a copy of
    each day for every window that holds it.

    A day of a pair is one pane, shuffled once; a window is a range of panes, over which
    the co-moments are merged (centred, so that large prices lose no digits).
    """
    if not 1 <= period <= size:
        raise ValueError("period must be between one day and size")
    day = F.floor(F.unix_seconds("day_time") / 86400).cast("int")
    panes = _ends(aligned_days(ticks, pairs).select("t1", "t2", day.alias("day"), "a", "b"), size, period)
    span = Window.partitionBy("t1", "t2").orderBy("_end").rangeBetween(1 - size, Window.currentRow)
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    a, b = F.when(both, F.col("a")), F.when(both, F.col("b"))
    merged = panes.select(
        "t1", "t2", "_end", "_listed", F.count("a").over(span).alias("n_1"), F.count("b").over(span).alias("n_2"),
        F.covar_pop(a, b).over(span).alias("_cov"), F.stddev_pop(a).over(span).alias("_sd1"),
        F.stddev_pop(b).over(span).alias("_sd2")).where("_listed")
    end = F.date_add(F.lit("1970-01-01").cast("date"), F.col("_end") + 1).cast("timestamp")
    return merged.select("t1", "t2", (end - F.expr(f"interval {size} days")).alias("window_start"),
                         end.alias("window_end"), _corr().alias("corr"))


def _corr() -> Column:
    corr = (F.when((F.col("n_1") == 0) | (F.col("n_2") == 0), F.lit(0.0))
            .otherwise(F.try_divide("_cov", F.col("_sd1") * F.col("_sd2"))))
    return F.nanvl(corr, F.lit(None))


def pair_correlation(ticks: DataFrame, pairs: Sequence[tuple[str, str]],
                     size: str = "10 days", period: str = "1 day") -> DataFrame:
    """Pearson correlation per pair and sliding window.

    0 when one side has no price in the window; null when the sides share fewer
    than two days or one of them does not vary.  A batch whose windows are whole
    days goes through :func:`pane_correlation`.
    """
    days = _day_span(size), _day_span(period)
    if not ticks.isStreaming and None not in days:
        return pane_correlation(ticks, pairs, *days)
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    a, b = F.when(both, F.col("a")), F.when(both, F.col("b"))
    grouped = (aligned_days(ticks, pairs).groupBy(_sliding(size, period), "t1", "t2")
               .agg(F.count("a").alias("n_1"), F.count("b").alias("n_2"),
                    F.covar_pop(a, b).alias("_cov"),
                    F.stddev_pop(a).alias("_sd1"), F.stddev_pop(b).alias("_sd2")))
    return _window_columns(grouped, _corr().alias("corr"))


def pair_signals(correlations: DataFrame, threshold: float = SIGNAL_THRESHOLD) -> DataFrame:
    """Windows whose correlation is strictly below the threshold."""
    return correlations.where(F.col("corr") < threshold)


def signal_lines(signals: DataFrame) -> DataFrame:
    """Signals as text, for text and topic sinks."""
    return signals.select(F.format_string(
        "(('%s', '%s'), %s)", "t1", "t2", F.col("corr").cast("string")).alias("value"))
