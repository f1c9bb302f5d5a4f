"""Overlap pairs with long-tailed lengths and with many equal rows."""

import random

from pyspark.sql import functions as F

from basetide.operators import intervals
from basetide.plans import skew

IV = "chrom string, start long, end long"


def pairs(a, b):
    return sorted((*x, *y, min(x[2], y[2]) - max(x[1], y[1])) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])


def test_class_bins_are_as_wide_as_their_intervals(spark):
    sizes = [1, 2, 3, 4, 5, 11, 12, 13, 48, 49, 3 * 4 ** 9, 3 * 4 ** 9 + 1, 250_000_000, 2 ** 40]
    df = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", intervals.length_class(F.col("n"), 3).alias("c"))
    for n, c in df.collect():
        assert 3 * 4 ** c >= n and (c == 0 or 3 * 4 ** (c - 1) < n)


def test_long_tailed_lengths(spark):
    rng = random.Random(9)

    def some(n):
        out = []
        for _ in range(n):
            s, size = rng.randrange(0, 100_000), rng.choice([1, 2, 5, 30, 200, 4000, 60_000])
            out.append((rng.choice("xy"), s, s + size))
        return out

    a, b = some(140), some(120)
    a.append(("x", 0, 100_000_000))
    for width in (None, 3, 5000):
        out = intervals.overlap_join(spark.createDataFrame(a, IV), spark.createDataFrame(b, IV), width)
        assert sorted(map(tuple, out.collect())) == pairs(a, b)
        out = intervals.overlap_join(spark.createDataFrame(b, IV), spark.createDataFrame(a, IV), width, hot_rows=4)
        assert sorted(map(tuple, out.collect())) == pairs(b, a)


def test_one_very_long_interval_is_laid_on_few_bins(spark):
    """2.5e8 bases among intervals of 200: two bins for each class that occurs, and not a million."""
    short = spark.range(2000).select(F.lit("c").alias("chrom"), (F.col("id") * 1000).alias("start"), (F.col("id") * 1000 + 200).alias("end"))
    long = spark.createDataFrame([("c", 0, 250_000_000)], IV)
    generated = []
    real = skew.grid_salt
    try:
        intervals.grid_salt = lambda x, y, keys, hot: (generated.append((x.count(), y.count())), real(x, y, keys, hot))[1]
        out = intervals.overlap_join(long, short.unionByName(long), 200)
        assert out.count() == 2001
    finally:
        intervals.grid_salt = real
    assert all(n <= 4 * 2001 for pair in generated for n in pair)


def test_equal_rows_spread_evenly(spark):
    """A million equal rows become cells of about ``hot_rows`` rows."""
    many = spark.range(1_000_000).select(F.lit("c").alias("k"), F.lit(5).alias("v"))
    few = spark.createDataFrame([("c", 1), ("d", 2)], "k string, w int")
    left, right = skew.grid_salt(many, few, ["k"], hot_rows=50_000)
    sizes = [r["count"] for r in left.groupBy("k", "_ls", "_rs").count().collect()]
    assert len(sizes) == 20 and sum(sizes) == 1_000_000 and max(sizes) < 52_000
    assert left.join(right, ["k", "_ls", "_rs"]).count() == 1_000_000


def test_sides_without_rows(spark):
    none = spark.createDataFrame([], IV)
    some = spark.createDataFrame([("c", 0, 5)], IV)
    assert intervals.overlap_join(none, some).count() == 0 and intervals.overlap_join(some, none).count() == 0
