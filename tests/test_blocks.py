"""Blocked correlation against the pairwise form."""

import itertools
import math
import random
from datetime import timedelta
from fractions import Fraction
from operator import mul

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import at
from feedloom.operators import blocks, ticks

KIND = "ticker string, trade_date timestamp, price double"


def some_prices(tickers, days=40, seed=3):
    rng = random.Random(seed)
    return [(t, at("2018-06-01") + timedelta(days=d),
             None if rng.random() < 0.1 else 5.0 if d // 10 == hash_of(t) % 4 else 1e6 + rng.random())
            for t in tickers for d in range(days) if rng.random() < 0.6]


def hash_of(ticker):
    return int(ticker[1:])


def exact(data, size, period):
    """Every window of every pair by rational numbers."""
    held = {}
    for t, at_, p in data:
        held.setdefault(t, {})[(at_ - at("1970-01-01")).days] = p
    out = {}
    for t1, t2 in itertools.combinations(sorted(held), 2):
        days = held[t1].keys() | held[t2].keys()
        for start in range(min(days) - size + 1, max(days) + 1):
            inside = [d for d in days if start <= d < start + size]
            if start % period or not inside:
                continue
            a, b = ({d: Fraction(held[t][d]) for d in inside if held[t].get(d) is not None} for t in (t1, t2))
            common = sorted(a.keys() & b.keys())
            corr = None
            if not a or not b:
                corr = 0.0
            elif len(common) > 1:
                x, y = ([v[d] - sum(v[c] for c in common) / len(common) for d in common] for v in (a, b))
                if any(x) and any(y):
                    corr = float(sum(map(mul, x, y))) / math.sqrt(float(sum(map(mul, x, x)) * sum(map(mul, y, y))))
            out[t1, t2, at("1970-01-01") + timedelta(days=start)] = corr
    return out


@pytest.mark.parametrize(("size", "period", "block", "days"), [(10, 1, 3, 16), (7, 3, 2, 5), (10, 1, 64, 128)])
def test_blocks_equal_exact_windows(spark, rows, size, period, block, days):
    """Prices that jump between 5 and a million lose digits where means are not taken first."""
    names = [f"t{i}" for i in range(9)]
    data = some_prices(names)
    df = spark.createDataFrame(data + [(None, at("2018-06-01"), 1.0), ("t1", None, 1.0)], KIND)
    got = blocks.all_pairs_correlation(df, size, period, block=block, days=days)
    found = {(r.t1, r.t2, r.window_start): r.corr and round(r.corr, 8) for r in got.collect()}
    want = exact(data, size, period)
    assert found == {k: v and round(v, 8) for k, v in want.items()}
    assert None in want.values() and 0.0 in want.values() and len(set(want.values())) > 50
    pairwise = {(r.t1, r.t2, r.window_start): r.corr for r in ticks.pair_correlation(
        df, ticks.pairs_of(names), f"{size} days", f"{period} days").collect()}
    assert pairwise.keys() == found.keys()
    assert all((v is None) == (found[k] is None) and abs((v or 0) - (found[k] or 0)) < 1e-4
               for k, v in pairwise.items())


def test_only_what_lies_below(spark, rows):
    df = spark.createDataFrame(some_prices([f"t{i}" for i in range(6)]), KIND)
    every = blocks.all_pairs_correlation(df, block=2)
    assert rows(blocks.all_pairs_correlation(df, block=2, below=-0.5)) == rows(every.where("corr < -0.5"))


def test_nothing_gives_nothing_and_gaps_are_refused(spark):
    empty = spark.createDataFrame([], KIND)
    assert blocks.all_pairs_correlation(empty).count() == 0
    with pytest.raises(ValueError):
        blocks.all_pairs_correlation(empty, 2, 3)


def test_two_thousand_tickers(spark):
    """No list of two million pairs; the strongest windows agree with numpy."""
    df = spark.range(2000 * 12).selectExpr(
        "concat('t', id div 12) ticker", "timestamp_seconds(86400 * (id % 12)) trade_date",
        "cast(pmod(xxhash64(id), 1000) as double) price")
    got = blocks.all_pairs_correlation(df, 10, 10, below=-0.95).where("window_start = timestamp'1970-01-01'")
    found = {(r.t1, r.t2): r.corr for r in got.collect()}
    data = df.where("trade_date < timestamp'1970-01-11'").orderBy("trade_date").groupBy("ticker").agg(
        F.sort_array(F.collect_list(F.struct("trade_date", "price"))).alias("p")).select("ticker", "p.price").collect()
    names = np.array([r.ticker for r in data])
    corr = np.corrcoef(np.array([r.price for r in data]))
    want = {tuple(sorted((names[i], names[j]))) for i, j in zip(*np.nonzero(np.triu(corr < -0.95, 1)))}
    assert set(found) == want and len(want) > 3
