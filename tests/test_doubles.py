"""Exact sums of doubles against fractions."""

import itertools
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from antecede.operators import doubles, prior_avg, prior_measures, prior_sum

AWKWARD = [0.0, -0.0, 1e300, -1e300, 1e-300, 1e20, -1e20, 1.0, 2.0, 1e-19, 5e-324, -5e-324, 1.7976931348623157e308, 0.1, 1 / 3, 2.0**60, 2.0**59, -(2.0**59), 2.0**119 + 2.0**67]


def summed(df, within=None):
    parts = doubles.band_parts(F.col("x"), within)
    sums = df.groupBy("k").agg(*(F.sum(p).alias(f"b{b}") for b, p in parts.items()))
    return {r["k"]: r["total"] for r in sums.select("k", doubles.joined({b: F.col(f"b{b}") for b in parts}).alias("total")).collect()}


def near(got, exact):
    """The nearest double, or one beside it."""
    try:
        want = float(exact)
    except OverflowError:
        want = math.inf if exact > 0 else -math.inf
    if math.isinf(want) or math.isinf(got):
        return got == want
    return abs(Fraction(got) - exact) <= 2 * Fraction(math.ulp(want))


def test_any_finite_doubles(spark):
    rng = random.Random(21)
    groups = [list(c) for n in (1, 2) for c in itertools.product(AWKWARD, repeat=n)]
    for _ in range(400):
        scale = rng.choice([0, 0, 30, 300, 1000])
        groups.append([rng.choice([rng.choice(AWKWARD), math.ldexp(rng.random() - 0.5, rng.randint(-scale, scale))]) for _ in range(rng.randint(1, 60))])
    for _ in range(100):  # all but the least cancels
        xs = [math.ldexp(rng.random(), rng.randint(-500, 500)) for _ in range(20)]
        groups.append([*xs, *[-x for x in xs], 5e-324])
    rows = [(k, x) for k, xs in enumerate(groups) for x in xs]
    rng.shuffle(rows)
    got = summed(spark.createDataFrame(rows, "k int, x double").repartition(7))
    for k, xs in enumerate(groups):
        assert near(got[k], sum(map(Fraction, xs))), (xs, got[k])


def test_what_is_no_finite_number_is_missing(spark):
    rows = [(0, math.nan), (0, math.inf), (1, None), (2, -math.inf), (2, 3.0), (3, 0.0)]
    got = summed(spark.createDataFrame(rows, "k int, x double"))
    assert got == {0: None, 1: None, 2: 3.0, 3: 0.0}


def test_fewer_bands_give_the_same_and_refuse_the_rest(spark):
    rng = random.Random(2)
    rows = [(k % 9, rng.choice([0.0, rng.randint(1, 9000) / 60, -rng.randint(1, 900) / 7])) for k in range(3000)]
    df = spark.createDataFrame(rows, "k int, x double")
    bounds = (2.0**-7, 2.0**32)
    assert len(doubles.bands_within(bounds)) == 5 and summed(df, bounds) == summed(df)
    for x in (2.0**-8, 2.0**33):
        with pytest.raises(Exception, match="not between"):
            summed(spark.createDataFrame([(0, x)], "k int, x double"), bounds)


@pytest.mark.parametrize("low", [2.0**-7, 1.0, 2.0**-60, 2.0**-61, 2.0**59, 2.0**60, 2.0**-24, 2.0**24, 2.0**23, 2.0**700])
def test_bounds_themselves(spark, low):
    xs = [low, low * (1 + 2**-52), low * 3 * (1 - 2**-53), low * 4]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(xs)], "k int, x double")
    assert summed(df, (low, low * 4)) == dict(enumerate(xs))


def test_prior_sums_plain_and_sliced_have_the_same_bits(spark):
    rng = random.Random(5)
    rows = [(k % 3, k, rng.choice([*AWKWARD, math.inf, math.nan, None, rng.random()])) for k in range(1500)]
    df = spark.createDataFrame(rows, "who int, at int, x double")
    measures = {"mean": prior_avg(F.col("x")), "total": prior_sum(F.col("x"), default=0.0)}
    plain = prior_measures(df, ["who"], ["at"], measures, heavy=[]).orderBy("at").collect()
    sliced = prior_measures(df, ["who"], ["at"], measures, max_rows=90).orderBy("at").collect()
    assert [(r["mean"], r["total"]) for r in plain] == [(r["mean"], r["total"]) for r in sliced]
    seen = {0: [], 1: [], 2: []}
    for (who, _, x), r in zip(rows, plain, strict=True):
        exact = sum(map(Fraction, seen[who]))
        assert near(r["total"], exact)
        assert (r["mean"] is None) == (not seen[who])
        if x is not None and math.isfinite(x):
            seen[who].append(x)


def test_large_values_do_not_vanish(spark):
    rows = [(0, k, x) for k, x in enumerate([1e20, 1.0, 2.0, 1e-19, 0.0])]
    df = spark.createDataFrame(rows, "who int, at int, x double")
    got = prior_measures(df, ["who"], ["at"], {"s": prior_sum(F.col("x"))}, heavy=[]).orderBy("at").collect()
    assert [r["s"] for r in got] == [None, 1e20, 1e20, 1e20, 1e20]
    same = spark.createDataFrame([(0, k, 1.2e19) for k in range(8)], "who int, at int, x double")
    for most in (3, 100):
        sums = prior_measures(same, ["who"], ["at"], {"s": prior_sum(F.col("x"))}, max_rows=most).orderBy("at").collect()
        assert [r["s"] for r in sums] == [None, *(1.2e19 * k for k in range(1, 8))]
