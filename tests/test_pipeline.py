"""Landing files -> bronze -> silver -> gold tables equal the direct one-plan result."""

import uuid

from tierlake.config import LakeNames
from tierlake.operators import marts
from tierlake.plans import fixtures as fx
from tierlake.plans.landing import land_all
from tierlake.plans.pipeline import run_all, run_model, run_silver
from tierlake.session import scratch_path
from tierlake.sinks.tables import write_snapshot
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_pipeline_equals_direct(spark):
    root = scratch_path(spark, "landing")
    land_all(spark, SF_SMALL, root, files=3)
    tag = uuid.uuid4().hex[:8]
    names = LakeNames(bronze=f"b_{tag}", silver=f"s_{tag}", gold=f"g_{tag}")
    snapshots = scratch_path(spark, "snapshots")
    out = run_all(spark, root, names, cut=fx.CUT_SEASON, model_params={"maxIter": 5}, snapshots=snapshots)
    stats = out["feature_table"]
    assert stats["rows"] == stats["distinct_keys"] > 0
    # the model stage
    frame = spark.table(names.table("gold", "podium_model_frame"))
    predictions = spark.table(names.table("gold", "podium_predictions"))
    assert predictions.count() == frame.filter(f"season >= {fx.CUT_SEASON}").count() > 0
    assert predictions.filter("predicted_podium <> int(predicted_podium_prob >= %r)" % out["model"]["threshold"]).count() == 0
    top = spark.table(names.table("gold", "latest_season_podiums")).collect()
    best = predictions.filter("season = (SELECT max(season) FROM %s)" % names.table("gold", "podium_predictions"))
    assert len(top) == min(20, best.count())
    assert sorted(r.predicted_podium_prob for r in top) == sorted(
        sorted((r.predicted_podium_prob for r in best.collect()), reverse=True)[:20])
    metrics = names.table("gold", "run_metrics")
    n = spark.table(metrics).count()
    again = run_model(spark, names, cut=fx.CUT_SEASON, params={"maxIter": 2})
    assert spark.table(metrics).count() == 2 * n and spark.table(metrics).select("run_id").distinct().count() == 2
    assert 0.0 <= again["test_accuracy"] <= 1.0
    gold = spark.table(names.table("gold", "race_results"))
    direct = fx.gold_race_results(spark, SF_SMALL)
    assert _rows(gold) == _rows(direct)
    ds = spark.table(names.table("gold", "driver_standings"))
    assert _rows(ds) == _rows(marts.driver_standings(direct))
    bronze = spark.table(names.table("bronze", "results"))
    assert {"ingested_at", "source_file"} <= set(bronze.columns)
    assert bronze.filter("source_file IS NULL OR ingested_at IS NULL").count() == 0
    silver = spark.table(names.table("silver", "sprints"))
    assert silver.schema["date"].dataType.simpleString() == "date"
    # circuits can be conformed from an older version
    write_snapshot(spark.table(names.table("bronze", "circuits")).limit(0), f"{snapshots}/circuits")
    run_silver(spark, names, snapshots=snapshots)
    assert spark.table(names.table("silver", "circuits")).count() == 0
    run_silver(spark, names, snapshots=snapshots, circuits_version=0)
    assert spark.table(names.table("silver", "circuits")).count() == 5
