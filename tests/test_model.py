"""Model training, scoring, persistence and importances (10 rounds for speed)."""

from pyspark.sql import functions as F

from tierlake.operators import evaluation as ev
from tierlake.operators import modeling as md
from tierlake.operators.features import FEATURE_COLS
from tierlake.plans.fixtures import CUT_SEASON
from tierlake.plans.queries_eval import model_frame
from tierlake.session import scratch_path
from tests.conftest import SF_SMALL


def test_train_score_roundtrip_importance(spark):
    train, test = md.time_split(model_frame(spark, SF_SMALL), cut=CUT_SEASON)
    model = md.train_podium_model(train, params={"maxIter": 10})
    scored = md.score(model, test)
    assert scored.count() == test.count()
    assert scored.filter(~F.col("predicted_podium_prob").between(0.0, 1.0)).count() == 0
    path = scratch_path(spark, "model")
    md.save_model(model, path)
    again = md.score(md.load_model(path), test)
    a = sorted((r.driver_id, r.season, r.round, r.predicted_podium_prob) for r in scored.collect())
    b = sorted((r.driver_id, r.season, r.round, r.predicted_podium_prob) for r in again.collect())
    assert a == b
    keys = ["season", "round", "driver_id"]
    frames = [md.permutation_importance(model, test.repartition(n), keys) for n in (4, 16)]
    a, b = (sorted(tuple(r) for r in f.collect()) for f in frames)
    assert a == b and len(a) == len(FEATURE_COLS)           # whatever the layout
    base = ev.auc_roc(scored.withColumn("y", F.col("is_podium").cast("int")), "y", "predicted_podium_prob").first().auc
    assert {r[1] for r in a} == {base}
    one = md.permutation_importance(model, test, keys, feature_cols=["grid"]).collect()
    assert [tuple(r) for r in one] == [r for r in a if r[0] == "grid"]


def test_permutation_is_a_permutation(spark):
    df = spark.createDataFrame([(i, float(i % 17), i % 3) for i in range(300)], "k int, x double, z int")
    out = md.permuted_columns(df, ["x", "z"], ["k"], rows=5)
    rows = out.select("k", "x", "__next.x", "__next.z").collect()
    assert sorted(r[2] for r in rows) == sorted(r[1] for r in rows)
    assert any(r[1] != r[2] for r in rows)
    again = md.permuted_columns(df.repartition(16), ["x", "z"], ["k"], rows=5).select("k", "x", "__next.x", "__next.z")
    assert sorted(rows) == sorted(again.collect())


def test_training_rows_fill_the_cores_evenly(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 100 * cores, 1, cores + 1).withColumn("y", F.col("id") % 2)
    sizes = lambda d: [len(p) for p in d.rdd.glom().collect()]                       # noqa: E731
    assert len(sizes(md.spread_rows(df, 100 * cores))) == cores + 1                  # too few rows: as they are
    for least_most, waves in (((10, 1000), 1), ((10, 40), 3)):
        monkeypatch.setattr(md, "PARTITION_ROWS", least_most)
        out = md.spread_rows(df, 100 * cores)
        found = sizes(out)
        assert len(found) == waves * cores and max(found) - min(found) <= cores + 1
        assert sorted(r.id for r in out.collect()) == list(range(100 * cores))
    fitted = []
    monkeypatch.setattr(md.Pipeline, "fit", lambda self, data: fitted.append(data.rdd.getNumPartitions()))
    md.train_podium_model(df, feature_cols=["id"], y="y")
    assert fitted == [3 * cores]
