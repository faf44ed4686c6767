import math
import random
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import at
from feedloom.operators import ticks
from feedloom.plans import trading
from feedloom.sinks import writers
from feedloom.sources import files
from feedloom.streaming import run

PAIRS = ticks.pairs_of(trading.TICKERS)


def prices(spark, data):
    return spark.createDataFrame([(t, at(d), p) for t, d, p in data],
                                 "ticker string, trade_date timestamp, price double")


def test_pairs_keep_the_listed_order():
    assert PAIRS == [("goog", "aapl"), ("goog", "fb"), ("aapl", "fb")]


def test_tick_files(spark, rows, tmp_path):
    (tmp_path / "goog.csv").write_text("date,close,volume\n2018/06/01,1119.5,7\n2018/06/04,1139.29,9\n")
    (tmp_path / "fb.csv").write_text("date,close\n2018/06/01,193.99\n")
    got = files.tick_files(spark, {"goog": str(tmp_path / "goog.csv"), "fb": str(tmp_path / "fb.csv")})
    assert rows(got) == [("fb", at("2018-06-01"), 193.99), ("goog", at("2018-06-01"), 1119.5),
                         ("goog", at("2018-06-04"), 1139.29)]


def test_ticks_may_arrive_as_bytes(spark, rows):
    df = spark.createDataFrame([(bytearray(b"2018/06/01,5.5"),), (bytearray(b"date,x"),)], "value binary")
    assert rows(ticks.parse_ticks(df, "goog")) == [("goog", at("2018-06-01"), 5.5)]


def test_dates_need_no_padding_and_bad_ones_are_reported(spark, rows):
    df = spark.createDataFrame([("2018/1/2,5.5",), ("2018/06/01,6",), ("soon,7",), ("date,x",)], "value string")
    assert rows(ticks.parse_ticks(df, "goog"), "trade_date", "price") == [
        (None, 7.0), (at("2018-01-02"), 5.5), (at("2018-06-01"), 6.0)]
    assert rows(ticks.undated_lines(df)) == [("soon,7",)]


def test_many_pairs_make_no_larger_plan(spark):
    names = [f"t{i:03d}" for i in range(250)]
    df = prices(spark, [(names[0], "2018-06-01", 1.0)])
    assert ticks.pair_fanout(df, ticks.pairs_of(names)).count() == 249


def test_fanout(spark, rows):
    df = prices(spark, [("aapl", "2018-06-01", 1.0), ("msft", "2018-06-01", 2.0)])
    assert rows(ticks.pair_fanout(df, PAIRS), "t1", "t2", "price") == [
        ("aapl", "fb", 1.0), ("goog", "aapl", 1.0)]


def _series(seed=5, days=25):
    rng = random.Random(seed)
    data = []
    for d in range(days):
        day = (at("2018-06-01") + timedelta(days=d)).date().isoformat()
        for ticker in trading.TICKERS:
            if ticker == "fb" and d < 12 or rng.random() < 0.2:
                continue
            data.append((ticker, day, round(rng.uniform(90, 110), 2)))
    return data


def _expected(data, t1, t2, start):
    end = start + timedelta(days=10)
    a, b = ({d: p for t, d, p in data if t == x and start <= at(d) < end} for x in (t1, t2))
    if not a and not b:
        return "no window"
    if not a or not b:
        return 0.0
    corr = pd.Series(a).corr(pd.Series(b))
    return None if math.isnan(corr) else round(corr, 9)


@pytest.mark.filterwarnings("ignore")
def test_correlation_equals_aligned_series(spark):
    data = _series()
    got = {(r.t1, r.t2, r.window_start): r.corr and round(r.corr, 9)
           for r in ticks.pair_correlation(prices(spark, data), PAIRS).collect()}
    want = {}
    for t1, t2 in PAIRS:
        for k in range(-9, 25):
            start = at("2018-06-01") + timedelta(days=k)
            corr = _expected(data, t1, t2, start)
            if corr != "no window":
                want[(t1, t2, start)] = corr
    assert got == want
    assert any(v == 0.0 for v in want.values()) and any(v is None for v in want.values())
    assert all(abs(v) <= 1 for v in got.values() if v is not None)


def test_constant_prices_have_no_correlation(spark):
    data = [(t, f"2018-06-{d:02d}", 5.0 if t == "goog" else float(d)) for t in ("goog", "aapl")
            for d in range(1, 6)]
    corr = ticks.pair_correlation(prices(spark, data), [("goog", "aapl")])
    assert corr.where("corr is not null and corr <> 0").count() == 0


def test_cogroup_lists(spark):
    data = [("goog", "2018-06-02", 2.0), ("goog", "2018-06-01", 1.0), ("aapl", "2018-06-02", 9.0)]
    row = (ticks.cogroup_windows(prices(spark, data), [("goog", "aapl")])
           .where(F.col("window_start") == at("2018-06-01")).first())
    assert [r.price for r in row.prices_1] == [1.0, 2.0]
    assert [r.price for r in row.prices_2] == [9.0]


def test_signals_are_strictly_below(spark, rows):
    df = spark.createDataFrame([("a", "b", -0.75), ("a", "c", -0.76), ("b", "c", None)],
                               "t1 string, t2 string, corr double")
    signals = ticks.pair_signals(df)
    assert rows(signals, "t2") == [("c",)]
    assert rows(ticks.signal_lines(signals)) == [("(('a', 'c'), -0.76)",)]


def test_stream_signals_equal_batch_once_windows_close(spark, rows, tmp_path):
    data = _series(seed=9, days=40)
    source = str(tmp_path / "ticks")
    days = sorted({d for _, d, _ in data})
    for i in range(0, len(days), 10):
        chunk = [x for x in data if x[1] in days[i:i + 10]]
        prices(spark, chunk).coalesce(1).write.mode("append").parquet(source)
    schema = "ticker string, trade_date timestamp, price double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    run.run_available(trading.signals(stream, threshold=2.0), writers.files(out),
                      str(tmp_path / "checkpoint"))
    got = spark.read.parquet(out).select("t1", "t2", "window_start", F.round("corr", 9))
    # Windows that ended well before the last watermark have closed.
    closed = F.col("window_end") <= at("2018-07-07")
    want = (trading.signals(prices(spark, data), threshold=2.0).where(closed)
            .select("t1", "t2", "window_start", F.round("corr", 9)))
    assert set(rows(want)) <= set(rows(got))
    everything = trading.signals(prices(spark, data), threshold=2.0).select(
        "t1", "t2", "window_start", F.round("corr", 9))
    assert set(rows(got)) <= set(rows(everything))
    assert want.count() > 50


@pytest.mark.parametrize(("size", "period"), [(10, 1), (7, 3), (2, 2), (1, 1)])
def test_panes_equal_the_copied_windows(spark, rows, size, period):
    """The form for streams, which copies each day into all its windows, on the same batch."""
    data = [x for x in _series(seed=size) if random.Random(str(x)).random() < 0.7]
    data += [("goog", "2019-01-01", 5.0), ("goog", "1969-12-20", 4.0), ("aapl", "1969-12-22", 4.0)]
    df = prices(spark, data)
    want = ticks.pair_correlation(df, PAIRS, f"{24 * size} hours", f"{24 * period} hours")
    got = ticks.pane_correlation(df, PAIRS, size, period)
    columns = ["t1", "t2", "window_start", "window_end", F.round("corr", 9)]
    assert rows(got, *columns) == rows(want, *columns)
    assert want.count() > 20


def test_windows_with_gaps_between_are_refused(spark):
    with pytest.raises(ValueError):
        ticks.pane_correlation(prices(spark, _series()), PAIRS, 2, 5)


def test_a_pane_is_shuffled_once(spark):
    plan = ticks.pane_correlation(prices(spark, _series()), PAIRS)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Window [") + plan.count("Window(") <= 4
