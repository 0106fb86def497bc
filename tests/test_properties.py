"""Property tests: distributed operators equal naive local recomputation."""

import math
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierlake.operators import evaluation as ev
from tierlake.functions.ordering import count_at_or_below
from tierlake.operators.features import rolling_mean
from tierlake.operators.halo import rolling_mean_of_events

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

scores = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12).map(lambda g: 1.0 - g / 8.0)),
                  min_size=2, max_size=60)


def _auc_pairs(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    if not pos or not neg:
        return None
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


@SETTINGS
@given(scores)
def test_auc_equals_pair_counting(spark, rows):
    df = spark.createDataFrame(rows, "y int, p double")
    got = ev.auc_roc(df, "y", "p").first()["auc"]
    want = _auc_pairs(rows)
    assert (got is None and want is None) or math.isclose(got, want, rel_tol=1e-12)


@SETTINGS
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=80), st.integers(1, 9), st.booleans())
def test_running_sums_match_cumsum(spark, values, ranges, desc):
    distinct = sorted(set(values), reverse=desc)
    rows = [(v / 800.0, i + 1) for i, v in enumerate(distinct)]        # some beyond the ranges
    df = spark.createDataFrame(rows, "v double, c long")
    out = {r.v: r.cum_c for r in ev.running_sums(df, "v", ["c"], descending=desc, ranges=ranges).collect()}
    acc = 0
    for v, c in rows:
        acc += c
        assert out[v] == acc


@SETTINGS
@given(scores)
def test_sweep_equals_direct_definition(spark, rows):
    df = spark.createDataFrame(rows, "y int, p double")
    got = {r.threshold: r for r in ev.threshold_sweep(df, "y", "p").collect()}
    grid = ev.sweep_thresholds()
    assert len(grid) == 61 and grid[20] == 0.5000000000000002
    for t in grid:
        preds = [1 if p >= t else 0 for _, p in rows]
        ys = [y for y, _ in rows]
        acc = sum(a == b for a, b in zip(preds, ys)) / len(ys)
        npos = sum(ys)
        rec = None if npos == 0 else sum(1 for a, b in zip(preds, ys) if a == 1 and b == 1) / npos
        pp = sum(preds)
        prec = 0.0 if pp == 0 else sum(1 for a, b in zip(preds, ys) if a == 1 and b == 1) / pp
        r = got[t]
        assert math.isclose(r.accuracy, acc) and r.precision == prec
        assert (r.recall is None and rec is None) or math.isclose(r.recall, rec)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=50), st.integers(1, 6))
def test_rolling_mean_matches_naive(spark, rows, n):
    data = [(k, i, float(v)) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, t int, x double")
    out = {(r.k, r.t): r.m for r in rolling_mean(df, {"m": F.col("x")}, ["k"], ["t"], n).collect()}
    for k in {d[0] for d in data}:
        seq = [d for d in data if d[0] == k]
        for i, (kk, t, _) in enumerate(seq):
            prev = [x for _, _, x in seq[max(0, i - n):i]]
            want = sum(prev) / len(prev) if prev else None
            got = out[(kk, t)]
            assert (got is None and want is None) or math.isclose(got, want)


def test_prior_events_never_see_same_event(spark):
    rows = [(1, 1, "a", 10.0), (1, 1, "b", 20.0), (1, 2, "a", 30.0), (1, 2, "b", 40.0), (1, 3, "a", 0.0)]
    df = spark.createDataFrame(rows, "k int, race int, d string, x double")
    out = {(r.race, r.d): r.m for r in rolling_mean_of_events(
        df, {"m": F.col("x")}, ["k"], ["race"], 1, [F.floor(F.col("race") / 2)]).collect()}
    assert out[(1, "a")] is None and out[(1, "b")] is None
    assert out[(2, "a")] == 15.0 and out[(2, "b")] == 15.0
    assert out[(3, "a")] == 35.0


def test_bucket_tree_counts_bounds(spark):
    bounds = sorted(random.Random(1).uniform(-5, 5) for _ in range(37))
    xs = [-9.0, *bounds, 0.0, 9.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r.b for r in df.select(count_at_or_below(F.col("x"), bounds).alias("b")).collect()]
    assert got == [sum(b <= x for b in bounds) for x in xs]


def test_clustered_scores_use_every_range(spark):
    """Scores all in [0, 0.001]: the sketch's bounds spread them evenly, sums stay exact."""
    rng = random.Random(11)
    values = sorted({rng.random() ** 3 / 1000 for _ in range(4000)})
    df = spark.createDataFrame([(v, 1 + k % 3, k % 2) for k, v in enumerate(values)], "v double, pos long, neg long")
    sizes = [r["count"] for r in ev.with_ranges(df, "v", ["pos", "neg"], 64).groupBy("__range").count().collect()]
    assert len(sizes) == 64 and max(sizes) <= 2 * len(values) / 64
    out = {r.v: (r.cum_pos, r.cum_neg, r.total_pos) for r in ev.running_sums(df, "v", ["pos", "neg"], ranges=64).collect()}
    total, a, b = sum(1 + k % 3 for k in range(len(values))), 0, 0
    for k, v in enumerate(values):
        a, b = a + 1 + k % 3, b + k % 2
        assert out[v] == (a, b, total)


def test_curves_on_empty_and_single_scores(spark):
    for rows in ([], [(1, 0.4)], [(0, 0.4), (1, 0.4)], [(1, None), (0, 0.2)]):
        df = spark.createDataFrame(rows, "y int, p double")
        known = {p for _, p in rows if p is not None}
        assert ev.roc_curve(df, "y", "p").count() == 1 + len(known)
        assert ev.pr_curve(df, "y", "p").count() == 1 + len(known)
        assert ev.auc_roc(df, "y", "p").count() == 1 if known else True
