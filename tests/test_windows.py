"""Overlap and rolling operators against plain definitions, and the shape of their plans."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tests.conftest import plan_text, rows
from tidemark.operators.overlap import overlapping_pairs
from tidemark.operators.rolling import mean_of_previous

BASE = datetime(2024, 6, 1)


def intervals(spark, data):
    made = [
        (f"r{i:03d}", None if s is None else BASE + timedelta(seconds=s), None if e is None else BASE + timedelta(seconds=e))
        for i, (s, e) in enumerate(data)
    ]
    return spark.createDataFrame(made, "id string, s timestamp, e timestamp"), made


def brute_force(made, since=None):
    return sorted(
        (a, b)
        for a, sa, ea in made
        for b, sb, eb in made
        if a < b and None not in (sa, ea, sb, eb) and sa < eb and sb < ea and (since is None or sa >= since)
    )


def found_pairs(frame, **options):
    pairs = overlapping_pairs(frame, "id", "s", "e", [], **options)
    return rows(pairs.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")))


second = st.integers(-50, 3000)
any_interval = st.one_of(
    st.tuples(second, second),
    st.tuples(second, st.integers(0, 40)).map(lambda p: (p[0], p[0] + p[1])),
    st.tuples(second, st.integers(0, 40_000_000)).map(lambda p: (p[0], p[0] + p[1])),
    st.tuples(second, st.integers(1, 9)).map(lambda p: (p[0], p[0] + p[1] / 100)),
    st.just((None, 5)),
    st.just((5, None)),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(any_interval, max_size=40), st.sampled_from([1 / 64, 1, 1000]), st.sampled_from([None, 0, 1500]))
def test_overlap_equals_theta_join(spark, data, finest, since_second):
    frame, made = intervals(spark, data)
    since = None if since_second is None else BASE + timedelta(seconds=since_second)
    assert found_pairs(frame, finest_seconds=finest, first_since=since) == brute_force(made, since)


def test_far_off_ends_stay_one_row(spark):
    years = 60 * 60 * 24 * 365
    frame, made = intervals(spark, [(0, 7000 * years), (50, 60), (55, 70), (90 * years, 95 * years), (-5, 3000 * years)])
    assert found_pairs(frame) == brute_force(made)
    covered = plan_text(overlapping_pairs(frame, "id", "s", "e", []))
    assert "CartesianProduct" not in covered and "NestedLoop" not in covered


def test_overlap_edges(spark):
    frame, made = intervals(spark, [(0, 10), (10, 20), (0, 10), (5, 5), (30, 1), (0, 0), (-5, 40)])
    assert found_pairs(frame) == brute_force(made)


def test_overlap_of_a_burst(spark):
    data = [(1 + i / 1000, 1 + i / 1000 + 0.003) for i in range(300)] + [(0, 100), (-10_000_000, 10_000_000)]
    frame, made = intervals(spark, data)
    assert found_pairs(frame) == brute_force(made)


def test_overlap_plan_has_no_nested_loop(spark):
    frame, _ = intervals(spark, [(0, 10), (5, 20)])
    plan = plan_text(overlapping_pairs(frame, "id", "s", "e", []))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize(("max_rows", "chunk"), [(10_000, 60), (10, 60), (3, 1), (40, 3600), (7, 100_000)])
def test_mean_of_previous_does_not_depend_on_the_cut(spark, max_rows, chunk):
    data = [("hot", f"r{i:04d}", BASE + timedelta(seconds=(i * 37) % 4000), float(i % 13)) for i in range(300)]
    data += [("gap", f"g{i:04d}", BASE + timedelta(hours=i * i), float(i)) for i in range(25)]
    data += [("one", "o", BASE, 1.0)]
    frame = spark.createDataFrame(data, "k string, id string, t timestamp, v double")
    window = Window.partitionBy("k").orderBy("t", "id").rowsBetween(-5, -1)
    expected = rows(frame.withColumn("m", F.round(F.avg("v").over(window), 9)))
    cut = mean_of_previous(frame, "k", "t", "id", "v", 5, "m", max_rows, chunk)
    assert rows(cut.withColumn("m", F.round("m", 9))) == expected
