"""Time split, class weights, the boosted-tree podium model and its explanations.

The reference trains a single-machine booster on a pandas copy of the data.
Here training is Spark ML's distributed ``GBTClassifier`` (per-level histogram
aggregation across executors); the frame never leaves the cluster.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.functions.exprs import safe_div
from tierlake.operators.evaluation import (
    MIN_ACCURACY, apply_threshold, auc_roc, best_threshold, classification_report, f1_binary, threshold_sweep,
)
from tierlake.operators.features import FEATURE_COLS, TARGET_COL
from tierlake.operators.trees import split_importance

# --- fixed values: the reference model's hyper-parameters, mapped to GBTClassifier
PODIUM_PARAMS = {
    "maxIter": 300,            # n_estimators
    "maxDepth": 6,             # max_depth
    "stepSize": 0.05,          # learning_rate
    "minInstancesPerNode": 20,  # min_child_samples
    "subsamplingRate": 1.0,    # subsample is 0.8 there, but without a bagging frequency it is ignored
    "featureSubsetStrategy": "0.8",  # colsample_bytree (per node here)
    "seed": 42,                # random_state
}
SPLIT_SEASON = 2020
# --- end fixed values ------------------------------------------------------------

# Rows of a training partition at least and at most.
PARTITION_ROWS = 50_000, 2_000_000


def label_split(df: DataFrame, col: str = "season", cut: int = SPLIT_SEASON,
                fill_cols: list[str] | None = None) -> DataFrame:
    """One pass: ``split`` = 'train' (col < cut) or 'test' (col >= cut); NULL features -> 0.

    Rows without a ``col`` are in neither split and are dropped, as by ``time_split``.
    """
    fill_cols = FEATURE_COLS if fill_cols is None else fill_cols
    out = df.filter(F.col(col).isNotNull()).withColumn(
        "split", F.when(F.col(col) < cut, "train").otherwise("test"))
    return out.fillna(0, subset=fill_cols)


def time_split(df: DataFrame, col: str = "season", cut: int = SPLIT_SEASON,
               fill_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test): ``col < cut`` and ``col >= cut``, NULL features filled with 0."""
    fill_cols = FEATURE_COLS if fill_cols is None else fill_cols
    train = df.filter(F.col(col) < cut).fillna(0, subset=fill_cols)
    test = df.filter(F.col(col) >= cut).fillna(0, subset=fill_cols)
    return train, test


def class_weights(train: DataFrame, y: str = TARGET_COL) -> DataFrame:
    """One row: negatives, positives and their ratio (the positive-class weight)."""
    yy = F.col(y).cast("int")
    agg = train.agg(F.count(F.when(yy == 0, 1)).alias("negatives"), F.count(F.when(yy == 1, 1)).alias("positives"))
    return agg.withColumn(
        "scale_pos_weight",
        safe_div(F.col("negatives"), F.col("positives"), zero=None))


def with_weight(train: DataFrame, y: str = TARGET_COL, weight_col: str = "weight") -> DataFrame:
    """Attach the positive-class weight (a scalar from one aggregate row) per row."""
    return _weighted(train, class_weights(train, y).first(), y, weight_col)


def _weighted(train: DataFrame, counts: Row, y: str, weight_col: str = "weight") -> DataFrame:
    w = counts["scale_pos_weight"] or 1.0
    return train.withColumn(weight_col, F.when(F.col(y).cast("int") == 1, F.lit(float(w))).otherwise(F.lit(1.0)))


def spread_rows(df: DataFrame, rows: int) -> DataFrame:
    """Deal ``rows`` training rows out evenly, in full waves of tasks.

    Files are read in a few partitions more than there are cores, uneven ones; each of the
    booster's passes, several a round, would then wait for a second wave of a few tasks.
    A frame too small to fill the cores keeps its partitions.
    """
    least, most = PARTITION_ROWS
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * -(-rows // (cores * most))) if rows >= cores * least else df


def train_podium_model(train: DataFrame, feature_cols: list[str] | None = None, y: str = TARGET_COL,
                       params: dict | None = None) -> PipelineModel:
    """Fit assembler + GBT on ``train`` with the class-balancing weight column."""
    feature_cols = FEATURE_COLS if feature_cols is None else feature_cols
    gbt = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                        **{**PODIUM_PARAMS, **(params or {})})
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feature_cols, outputCol="features"), gbt])
    # The booster persists its input; ``train`` should be a filter over a written table.
    counts = class_weights(train, y).first()
    rows = spread_rows(train.select(*feature_cols, y), counts["negatives"] + counts["positives"])
    data = _weighted(rows, counts, y).withColumn("label", F.col(y).cast("double"))
    return pipe.fit(data)


def score(model: PipelineModel, df: DataFrame, prob_col: str = "predicted_podium_prob",
          label_col: str = "predicted_podium") -> DataFrame:
    """P(class 1) and the default label (the more probable class; a 0.5 tie is 0)."""
    out = model.transform(df)
    out = out.withColumn(prob_col, vector_to_array(F.col("probability"))[1])
    out = out.withColumn(label_col, F.col("prediction").cast("int"))
    return out.drop("features", "rawPrediction", "probability", "prediction")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def metrics_table(spark: SparkSession, run_id: str, values: list[tuple[str, str, object]]) -> DataFrame:
    """Run metrics / params / tags as rows (run_id, kind, name, value as text)."""
    rows = [(run_id, kind, name, None if v is None else str(v)) for kind, name, v in values]
    return spark.createDataFrame(rows, "run_id string, kind string, name string, value string")


def evaluate_scores(scored: DataFrame, y: str, p: str, label: str, min_acc: float = MIN_ACCURACY) -> tuple[float, list]:
    """(tuned threshold, the run's metrics, params and tags); accuracy is computed at
    the tuned threshold.  ``scored`` is read five times: pass a written table."""
    auc = auc_roc(scored, y, p).first()["auc"]
    f1 = f1_binary(scored, y, label).first()["f1"]
    threshold = best_threshold(threshold_sweep(scored, y, p), min_acc).first()["threshold"]
    report = classification_report(apply_threshold(scored, p, threshold, "__tuned"), y, "__tuned")
    accuracy = report.filter(F.col("label") == "accuracy").first()["f1_score"]
    return threshold, [
        ("metric", "test_auc", auc),
        ("metric", "test_f1", f1),
        ("metric", "test_accuracy", accuracy),
        ("param", "threshold", threshold),
        *[("param", k, v) for k, v in PODIUM_PARAMS.items()],
        ("tag", "model_type", "GBTClassifier"),
        ("tag", "task", "binary_classification"),
        ("tag", "target", "podium_finish"),
    ]


def feature_importance(nodes: DataFrame, feature_cols: list[str] | None = None) -> DataFrame:
    """feature, splits, importance (share of all gain): every feature of a fitted model's node
    table, ascending by splits (the reference's measure is split-based)."""
    feature_cols = FEATURE_COLS if feature_cols is None else feature_cols
    names = nodes.sparkSession.createDataFrame([(c,) for c in feature_cols], "feature string")
    used = split_importance(nodes)
    total = F.sum("gain").over(Window.partitionBy())                # one row per feature
    return names.join(used, "feature", "left").select(
        "feature", F.coalesce("splits", F.lit(0)).alias("splits"),
        F.coalesce(F.col("gain") / total, F.lit(0.0)).alias("importance")).orderBy("splits", "feature")


# A permutation group holds about this many rows at most.
PERMUTATION_ROWS = 256
HEX_DIGITS = 14         # 256 * 16^13 rows are beyond any table


def permuted_columns(df: DataFrame, cols: list[str], key_cols: list[str], seed: int = 42,
                     rows: int = PERMUTATION_ROWS) -> DataFrame:
    """Add ``__next``: for every row the values of ``cols`` in its successor row.

    Rows are ordered by a hash (MD5) of seed and key, and grouped by the hash's first hex
    digits: as many as the row count needs for about ``rows`` a group, so groups grow in
    number and not in size.  Within a group each row takes the next row's values (the last
    takes the first's): a permutation that depends on the keys alone.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key_cols]).cast("binary"))
    n = F.col("__n")
    digits = F.lit(1)
    for k in range(1, HEX_DIGITS):
        digits = digits + (n > rows * 16 ** k).cast("int")
    count = F.broadcast(df.agg(F.count(F.lit(1)).alias("__n")))                     # one row
    tmp = df.crossJoin(count).withColumns({"__h": h, "__own": F.struct(*cols)}).withColumn(
        "__g", F.substring(F.col("__h"), F.lit(1), digits))
    w = Window.partitionBy("__g").orderBy("__h", *key_cols)
    first = F.first("__own").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return tmp.withColumn("__next", F.coalesce(F.lead("__own").over(w), first)).drop("__g", "__h", "__own", "__n")


def permutation_importance(scorer, df: DataFrame, key_cols: list[str],
                           feature_cols: list[str] | None = None, y: str = TARGET_COL,
                           seed: int = 42, rows: int = PERMUTATION_ROWS) -> DataFrame:
    """AUC lost when each feature's values are permuted (larger = more important).

    ``scorer`` is a fitted pipeline, or a function that adds ``predicted_podium_prob`` to a
    frame.  One pass: every row is scored as it is and once per feature with that feature
    taken from its successor; one exact AUC per feature follows.
    """
    if isinstance(scorer, PipelineModel):
        model = scorer

        def scorer(frame: DataFrame) -> DataFrame:
            return score(model, frame)

    feature_cols = FEATURE_COLS if feature_cols is None else feature_cols
    rest = [c for c in FEATURE_COLS if c not in feature_cols and c in df.columns]
    permuted = permuted_columns(df, feature_cols, key_cols, seed, rows)

    def variant(name: str | None):
        return F.struct(F.lit(name).cast("string").alias("feature"),
                        *[(F.col(f"__next.{c}") if c == name else F.col(c)).alias(c) for c in feature_cols])

    stacked = permuted.select(F.col(y).cast("int").alias("__y"), *rest, F.explode(
        F.array(variant(None), *[variant(c) for c in feature_cols])).alias("v")).select("__y", *rest, "v.*")
    scored = scorer(stacked).select("feature", "__y", "predicted_podium_prob")
    named = scored.withColumn("feature", F.coalesce("feature", F.lit("")))
    per = auc_roc(named, "__y", "predicted_podium_prob", by=("feature",)).select("feature", "auc")
    # one row per feature and the unchanged rows' own
    base = F.max(F.when(F.col("feature") == "", F.col("auc"))).over(Window.partitionBy())
    return per.withColumn("base_auc", base).filter("feature <> ''").select(
        "feature", "base_auc", F.col("auc").alias("permuted_auc"), (F.col("base_auc") - F.col("auc")).alias("importance"))
