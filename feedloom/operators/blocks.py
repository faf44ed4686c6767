"""Sliding correlation of all pairs of very many tickers.

With T tickers a list of pairs has T(T-1)/2 entries, and a fan-out copies every
price T - 1 times.  Here tickers are dealt into blocks by a hash: a price is
copied once for every block, and each pair of blocks, cut into spans of days,
is one group whose co-moments come from matrix products.  Groups are bounded
by ``block`` and ``days``, whatever the number of tickers or days.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, DAYS = 64, 128
#: Below this share of the sum of squares a variance has lost too many digits.
SURE = 1e-6


def _windows(values: np.ndarray, present: np.ndarray) -> tuple[np.ndarray, ...]:
    """Masks, values centred on each ticker's mean, and presence in one window."""
    mask = ~np.isnan(values)
    n = mask.sum(axis=1, keepdims=True)
    mean = np.where(mask, values, 0.0).sum(axis=1, keepdims=True) / np.maximum(n, 1)
    return mask.astype(float), np.where(mask, values - mean, 0.0), n[:, 0] > 0, present.any(axis=1)


def _directly(a: np.ndarray, b: np.ndarray) -> float:
    """Two passes over the common days; none if a side does not vary."""
    both = ~np.isnan(a) & ~np.isnan(b)
    a, b = a[both], b[both]
    if len(a) < 2 or a.min() == a.max() or b.min() == b.max():
        return np.nan
    a, b = a - a.mean(), b - b.mean()
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def correlate(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Correlations of all rows of ``a`` with all of ``b`` over one window, and where the
    window exists: one of both has a row on one of its days.  Unknown prices are NaN."""
    mask_a, x, has_a, there_a = _windows(a, in_a)
    mask_b, y, has_b, there_b = _windows(b, in_b)
    n = mask_a @ mask_b.T
    sum_a, sum_b = x @ mask_b.T, mask_a @ y.T
    square_a, square_b = (x * x) @ mask_b.T, mask_a @ (y * y).T
    with np.errstate(divide="ignore", invalid="ignore"):
        var_a, var_b = square_a - sum_a ** 2 / n, square_b - sum_b ** 2 / n
        corr = (x @ y.T - sum_a * sum_b / n) / np.sqrt(var_a * var_b)
    corr[n < 2] = np.nan
    for i, j in zip(*np.nonzero((n >= 2) & ((var_a <= SURE * square_a) | (var_b <= SURE * square_b)))):
        corr[i, j] = _directly(a[i], b[j])
    corr[~(has_a[:, None] & has_b[None, :])] = 0.0
    return corr, there_a[:, None] | there_b[None, :]


def _group(part: pd.DataFrame, low: int, high: int, first: int, last: int, size: int, period: int,
           below: float | None) -> pd.DataFrame:
    """All pairs between two blocks, for the windows that end on the days first to last."""
    def side(block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = part[part["block"] == block]
        names, at = np.unique(rows["ticker"].to_numpy(str), return_inverse=True)
        values = np.full((len(names), last - first + size), np.nan)
        present = np.zeros(values.shape, bool)
        day = rows["day"].to_numpy() - (first - size + 1)
        values[at, day], present[at, day] = rows["price"].to_numpy(float), True
        return names, values, present

    names_a, a, in_a = side(low)
    names_b, b, in_b = (names_a, a, in_a) if low == high else side(high)
    wanted = names_a[:, None] < names_b[None, :] if low == high else np.ones((len(names_a), len(names_b)), bool)
    found = []
    for end in range(first, last + 1):
        if (end + 1 - size) % period:
            continue
        cut = slice(end - first, end - first + size)
        corr, there = correlate(a[:, cut], b[:, cut], in_a[:, cut], in_b[:, cut])
        i, j = np.nonzero(wanted & there & (True if below is None else corr < below))
        found.append((i, j, np.full(len(i), end), corr[i, j]))
    i, j, end, corr = (np.concatenate(x) for x in zip(*found)) if found else ([], [], [], [])
    i, j = np.asarray(i, int), np.asarray(j, int)
    one, two = names_a[i].astype(object), names_b[j].astype(object)
    swap = one > two
    return pd.DataFrame({"t1": np.where(swap, two, one), "t2": np.where(swap, one, two), "end": end, "corr": corr})


def all_pairs_correlation(ticks: DataFrame, size: int = 10, period: int = 1, below: float | None = None,
                          block: int = BLOCK, days: int = DAYS) -> DataFrame:
    """:func:`feedloom.operators.ticks.pair_correlation` of a batch for every two tickers
    that it holds, ``t1`` before ``t2`` by name, without a list of pairs.

    With ``below`` only the windows under it leave a group (null correlations do not).
    Ticks without a ticker or a date are left out; of a day's prices the highest counts.
    """
    if not 1 <= period <= size:
        raise ValueError("period must be between one day and size")
    day = F.floor(F.unix_seconds(F.col("trade_date").cast("timestamp")) / 86400).cast("int")
    daily = (ticks.where(F.col("ticker").isNotNull() & F.col("trade_date").isNotNull())
             .groupBy("ticker", day.alias("day")).agg(F.max("price").alias("price")))
    blocks = -(-ticks.agg(F.count_distinct("ticker")).first()[0] // block) or 1
    own, other = F.col("block"), F.col("other")
    dealt = (daily.withColumn("block", F.pmod(F.xxhash64("ticker"), F.lit(blocks)).cast("int"))
             .withColumn("span", F.explode(F.sequence(F.floor(F.col("day") / days),
                                                      F.floor((F.col("day") + size - 1) / days))))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select(F.least(own, other).alias("low"), F.greatest(own, other).alias("high"), "span",
                     "block", "ticker", "day", "price"))

    def one(key: tuple[Any, ...], part: pd.DataFrame) -> pd.DataFrame:
        low, high, span = (int(x) for x in key)
        return _group(part, low, high, span * days, span * days + days - 1, size, period, below)

    found = dealt.groupBy("low", "high", "span").applyInPandas(one, "t1 string, t2 string, end int, corr double")
    end = F.date_add(F.lit("1970-01-01").cast("date"), F.col("end") + 1).cast("timestamp")
    return found.select("t1", "t2", (end - F.expr(f"interval {size} days")).alias("window_start"),
                        end.alias("window_end"), F.nanvl("corr", F.lit(None)).alias("corr"))
