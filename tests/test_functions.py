import math

import pytest
from pyspark.sql import functions as F

from geotrail.functions import duration_minutes, haversine_m, java_round2, rounded_mean_fold, speed_kph


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0].x


@pytest.mark.parametrize(
    "pts, expected",
    [
        ((30.266, -97.730, 32.776, -96.796), 292799.576),
        ((30.266, -97.730, 30.266, -97.730), 0.0),
        ((30.266, -97.730, 30.275, -97.730), 1000.754),
        ((30.26455, -97.7284, 30.2645, -97.7286), 19.996),
        ((30.264, -97.728, 30.2642, -97.7281), 24.224),
        ((30.264, -97.728, 30.2642, -97.7285), 52.920),
        ((30.267, -97.799, 30.264, -97.728), 6826.921),
    ],
)
def test_haversine_golden(spark, pts, expected):
    d = one(spark, haversine_m(*[F.lit(x) for x in pts]))
    assert d == pytest.approx(expected, abs=1e-3)


def test_haversine_reference_bounds_and_symmetry(spark):
    far = one(spark, haversine_m(F.lit(30.266), F.lit(-97.730), F.lit(32.776), F.lit(-96.796)))
    back = one(spark, haversine_m(F.lit(32.776), F.lit(-96.796), F.lit(30.266), F.lit(-97.730)))
    assert 290_000 < far < 295_000
    assert abs(far - back) < 0.001
    short = one(spark, haversine_m(F.lit(30.266), F.lit(-97.730), F.lit(30.275), F.lit(-97.730)))
    assert abs(short - 1000) < 100


@pytest.mark.parametrize(
    "m, dt_ms, expected",
    [(100.0, 1000, 360.0), (7000.0, 180_000, 140.0), (0.0, 240_000, 0.0), (1220.0, 0, 0.0), (5.0, -1000, 0.0)],
)
def test_speed_golden(spark, m, dt_ms, expected):
    v = one(spark, speed_kph(F.lit(m), F.lit(0), F.lit(dt_ms)))
    assert v == pytest.approx(expected, abs=1e-9)


def test_pair_speeds(spark):
    v = one(spark, speed_kph(haversine_m(F.lit(30.264), F.lit(-97.728), F.lit(30.2642), F.lit(-97.7285)), F.lit(0), F.lit(1000)))
    assert v == pytest.approx(190.511, abs=1e-3)


@pytest.mark.parametrize("x, expected", [(1.005, 1.0), (-0.125, -0.12), (87.383, 87.38), (2.675, 2.68), (0.0, 0.0),
                                         (65.505, 65.51), (-1.5, -1.5), (0.125, 0.13)])
def test_java_round2(spark, x, expected):
    # ties go toward +infinity on the binary value of x * 100, like Math.round
    assert one(spark, java_round2(F.lit(x))) == expected


def test_java_round2_differs_from_spark_round(spark):
    assert one(spark, F.round(F.lit(1.005), 2)) == 1.01
    assert one(spark, java_round2(F.lit(1.005))) == 1.0


@pytest.mark.parametrize("start, end, minutes", [(0, 125_999, 2), (0, 59_999, 0), (1000, 2000, 0), (0, 600_000, 10)])
def test_duration_minutes(spark, start, end, minutes):
    assert one(spark, duration_minutes(F.lit(start), F.lit(end))) == minutes


def test_sticking_mean(spark):
    """1000 readings at 50 then 1000 at 54 -> the rounded fold stays at 50.0."""
    speeds = [50.0] * 1000 + [54.0] * 1000
    df = spark.createDataFrame([(speeds,)], "v array<double>")
    got = df.select(rounded_mean_fold(F.col("v"), F.lit(0), F.lit(0.0)).alias("m")).collect()[0].m
    assert got == 50.0
    assert sum(speeds) / len(speeds) == 52.0


def test_fold_seeded_reference_value(spark):
    """Seed (3, 50.5) then 87.383 and 52.894 kph -> 58.35 exactly (reference assertion)."""
    df = spark.createDataFrame([([87.38311, 52.89402],)], "v array<double>")
    got = df.select(rounded_mean_fold(F.col("v"), F.lit(3), F.lit(50.5)).alias("m")).collect()[0].m
    assert got == 58.35


def _py_fold(speeds, n=0, avg=0.0):
    def r2(x):
        y = x * 100.0
        f = math.floor(y)
        return (f + (1 if y - f >= 0.5 else 0)) / 100.0

    for v in speeds:
        n += 1
        avg = r2((avg * (n - 1) + v) / n)
    return avg


def test_fold_matches_python(spark):
    import random

    rnd = random.Random(7)
    rows = [[rnd.uniform(0, 300) for _ in range(rnd.randint(0, 400))] for _ in range(30)]
    df = spark.createDataFrame([(r,) for r in rows], "v array<double>")
    got = [r.m for r in df.select(rounded_mean_fold(F.col("v"), F.lit(0), F.lit(0.0)).alias("m")).collect()]
    assert got == [_py_fold(r) for r in rows]
