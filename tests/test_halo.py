"""Halo frames equal the plain window on any groups, buckets and values."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierlake.operators import features as ft
from tierlake.operators import halo

SETTINGS = settings(max_examples=12, deadline=None)
SCHEMA = "k string, s int, r int, d int, x double, z int"
BUCKETS = {
    "one": lambda: [F.col("s")],
    "two": lambda: [F.col("s"), F.floor(F.col("r") / 4)],
    "three": lambda: [F.col("s"), F.floor(F.col("r") / 8), F.floor(F.col("r") / 2)],
    "constant": lambda: [F.lit(0)],
}
ROW = st.tuples(st.sampled_from([None, None, "a", "b"]), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 20),
                st.one_of(st.none(), st.floats(-1e6, 1e6)), st.one_of(st.none(), st.integers(0, 1)))


def plain(df, n):
    w = Window.partitionBy("k").orderBy("s", "r", "d").rowsBetween(-n, -1)
    return {r.d: (r.mx, r.mz) for r in df.withColumns({"mx": F.avg("x").over(w), "mz": F.avg("z").over(w)}).collect()}


@pytest.mark.parametrize("buckets", sorted(BUCKETS))
@SETTINGS
@given(rows=st.lists(ROW, max_size=60), n=st.integers(1, 7))
def test_rows_equal_the_plain_window(spark, buckets, rows, n):
    df = spark.createDataFrame([(k, s, r, d, x, z) for d, (k, s, r, x, z) in enumerate(rows)], SCHEMA)
    out = halo.rolling_mean(df, {"mx": F.col("x"), "mz": F.col("z")}, ["k"], ["s", "r", "d"], n, BUCKETS[buckets]())
    assert out.columns == [*df.columns, "mx", "mz"]
    assert {r.d: (r.mx, r.mz) for r in out.collect()} == plain(df, n)


@SETTINGS
@given(rows=st.lists(ROW, max_size=50), n=st.integers(1, 4))
def test_events_equal_a_plain_version(spark, rows, n):
    data = [(k, s, r, d, None if x is None else float(round(x)), z) for d, (k, s, r, x, z) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    out = halo.rolling_mean_of_events(df, {"m": F.col("x")}, ["k"], ["s", "r"], n, BUCKETS["two"]())
    got = {r.d: r.m for r in out.collect()}
    for k, s, r, d, _, _ in data:
        def rank(v):
            return (v[0] is not None, v[0] or 0, v[1])

        earlier = sorted({(t[1], t[2]) for t in data if t[0] == k and rank((t[1], t[2])) < rank((s, r))}, key=rank)[-n:]
        seen = [t[4] for t in data if t[0] == k and (t[1], t[2]) in earlier and t[4] is not None]
        assert got[d] == (sum(seen) / len(seen) if seen else None)


def test_a_hot_null_group_is_spread(spark):
    """A third of the rows without a team: no task gets them together, results as before."""
    rows = [(None if d % 3 == 0 else "t%d" % (d % 40), 2000 + d % 4, d % 64, d, float(d % 11), d % 2) for d in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = halo.rolling_mean(df, {"mx": F.col("x"), "mz": F.col("z")}, ["k"], ["s", "r", "d"], 10, BUCKETS["two"]())
    assert {r.d: (r.mx, r.mz) for r in out.collect()} == plain(df, 10)
    keyed = halo.with_buckets(df, ["k"], F.col("x"), BUCKETS["two"]())
    largest = keyed.groupBy(halo.KEY).count().agg(F.max("count")).first()[0]
    assert largest <= 3000 / 3 / 4 / 8


def test_rows_are_never_dealt_by_the_team_alone(spark):
    base = spark.createDataFrame(
        [(2000, 1, "d", "c", "x", 1, 1.0, True, False, False)],
        "season int, round int, driver_id string, constructor_id string, circuit_name string, "
        "position int, points double, is_podium boolean, is_winner boolean, is_dnf boolean")
    for mode in ("rows", "prior_races"):
        plan = ft.constructor_form(base, mode)._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        alone = [k for k, x in enumerate(lines) if re.search(r"Exchange hashpartitioning\(constructor_id#\d+, \d+\)", x)]
        for k in alone:          # only ends of whole seasons, already aggregated, meet by team
            below = "\n".join(lines[k + 1:k + 5])
            assert "Aggregate" in below, below
