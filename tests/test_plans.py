"""Plan shape: laziness, exchanges, pushdown, join types, no single-task windows over rows."""

import re
import uuid

from tierlake.operators import evaluation as ev
from tierlake.operators import features as ft
from tierlake.operators import marts
from tierlake.plans import fixtures as fx
from tierlake.plans.queries_eval import model_frame, scored
from tierlake.plans.registry import QUERIES
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, build):
    """Ids of the Spark jobs that ``build`` starts."""
    group = f"laziness-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
        return list(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_frame_starts_no_job_beyond_schema_reads(spark):
    keys = ["race_results", "driver_standings", "constructor_standings", "rank_drivers", "recent_standings",
            "podium_features", "rolling_constructor_form", "filter_has_history", "auc_roc", "roc_curve", "pr_curve",
            "threshold_sweep", "best_threshold", "classification_report", "time_split"]
    reads = len(jobs_of(spark, lambda: QUERIES["race_results"](spark, SF_SMALL)))     # parquet footers
    for k in keys:
        assert len(jobs_of(spark, lambda: QUERIES[k](spark, SF_SMALL))) <= reads, k


def test_driver_windows_share_one_exchange(spark):
    base = spark.createDataFrame(
        [(2000, 1, "d", "c", "x", 3, 1, 1.0, True, False, False)],
        "season int, round int, driver_id string, constructor_id string, circuit_name string, grid int, "
        "position int, points double, is_podium boolean, is_winner boolean, is_dnf boolean")
    # driver and driver x circuit windows share one exchange, the constructor's rows go by halo bucket
    assert plan(ft.circuit_history(ft.driver_form(base))).count("Exchange hashpartitioning") == 1
    both = plan(ft.podium_features(base, families=("driver", "circuit")))
    assert both.count("Exchange hashpartitioning") == 1
    # rows go by halo bucket, once as it runs (test_features_scan_each_fact_table_once)
    assert "Exchange hashpartitioning(__key" in plan(ft.podium_features(base, labels=()))


def test_unused_windows_are_pruned(spark):
    p = plan(QUERIES["threshold_sweep"](spark, SF_SMALL))
    assert "constructor_avg_points_last10" not in p and "Window" in p


def test_season_filter_is_below_the_rank(spark):
    p = plan(QUERIES["recent_standings"](spark, SF_SMALL))
    filters = [m.start() for m in re.finditer(r"Filter .*season#\d+ >= 2000|year\(.*>= 2000", p)]
    ranks = [m.start() for m in re.finditer("Window ", p)]
    assert filters and ranks and min(filters) > min(ranks)      # further down the printed tree


def test_scan_pushdown_and_pruning(spark):
    df = fx.table(spark, SF_SMALL, "lineitem").filter("l_quantity > 10").select("l_orderkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_evaluation_windows_are_partitioned(spark):
    """Whatever reaches a single partition has been aggregated first: per range, per
    threshold bucket or to one row."""
    s = scored(spark, SF_SMALL)
    for df in (ev.auc_roc(s, "y", "p"), ev.roc_curve(s, "y", "p"), ev.threshold_sweep(s, "y", "p")):
        lines = plan(df).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = next(x for x in lines[i + 1:] if re.search(r"[A-Z]\w+", x))
                assert re.search("HashAggregate|Project|BroadcastHashJoin|SortMergeJoin", below), below
                feeding = "\n".join(lines[i + 1:i + 8])
                assert "HashAggregate" in feeding or "Range" in feeding, feeding
    assert "hashpartitioning(__range" in plan(ev.running_sums(ev.score_counts(s, "y", "p"), "p", ["pos"]))


def test_flagship_joins_are_left_outer_without_forced_broadcast(spark):
    df = fx.gold_race_results(spark, SF_SMALL)
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("Join LeftOuter") >= 4 and "strategy=broadcast" not in logical
    names = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|CartesianProduct|BroadcastNestedLoopJoin)", plan(df))
    assert len(names) >= 4 and not {"CartesianProduct", "BroadcastNestedLoopJoin"} & set(names)


def final_plan(df):
    """The plan as it ran, after all run-time changes."""
    df.write.format("noop").mode("overwrite").save()        # warm file listings; the frame's own plan follows
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_standings_scan_each_fact_table_once(spark):
    for key in ("driver_standings", "constructor_standings", "rank_drivers", "rank_constructors"):
        p = final_plan(QUERIES[key](spark, SF_SMALL))
        p = p[:p.index("== Initial Plan ==")] if "== Initial Plan ==" in p else p
        once = len(re.findall(r"FileScan parquet \[l_orderkey", p))
        assert once == 1, (key, once)
        assert "ReusedExchange" in p


def test_features_scan_each_fact_table_once(spark):
    for key in ("podium_features", "rolling_constructor_form"):
        p = final_plan(QUERIES[key](spark, SF_SMALL))
        p = p[:p.index("== Initial Plan ==")] if "== Initial Plan ==" in p else p
        assert len(re.findall(r"FileScan parquet \[[^]]*l_quantity", p)) == 1 and "ReusedExchange" in p, key


def test_model_frame_ranks_the_races_once(spark):
    """The team's bucket ends read the exchange of the rows although the frame drops the team."""
    p = final_plan(model_frame(spark, SF_SMALL))
    p = p[:p.index("== Initial Plan ==")] if "== Initial Plan ==" in p else p
    assert len(re.findall(r"row_number\(\) windowspecdefinition\([^\]]*min_price", p)) == 1


def test_races_are_grouped_from_the_lines(spark):
    p = plan(fx.bronze_races(spark, SF_SMALL))
    assert not re.search(r"HashAggregate\(keys=\[[^]]*l_suppkey#\d+L?[,\]]", p)     # no entries on the way


def test_standings_rank_ties_join_back(spark):
    p = plan(marts.season_rank(marts.driver_season_stats(fx.gold_race_results(spark, SF_SMALL))))
    assert "__tied" in p and "rank(" not in p
