"""Pair signals over price ticks, batch or streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from feedloom.operators import ticks

#: The default tickers.
TICKERS = ["goog", "aapl", "fb"]


def signals(prices: DataFrame, tickers: Sequence[str] = TICKERS,
            threshold: float = ticks.SIGNAL_THRESHOLD, size: str = "10 days",
            period: str = "1 day", lateness: str = "1 day") -> DataFrame:
    """Windows in which a pair's correlation fell below the threshold."""
    if prices.isStreaming:
        prices = prices.withWatermark("trade_date", lateness)
    return ticks.pair_signals(
        ticks.pair_correlation(prices, ticks.pairs_of(tickers), size, period), threshold)
