"""The lakehouse run, in explicit order: landing -> bronze -> silver -> gold -> features -> model.

Stages communicate only through catalog tables, as in the reference; every
write is a full overwrite.  Each stage reads its inputs from the catalog, so
a failed run restarts from the last completed table rather than from landing.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tierlake.config import GOLD_TABLES, SOURCES, LakeNames
from tierlake.operators import features as ft
from tierlake.operators import marts
from tierlake.operators import modeling as md
from tierlake.operators.conform import CONFORMERS
from tierlake.operators.evaluation import MIN_ACCURACY, apply_threshold
from tierlake.operators.reports import latest_season_topk
from tierlake.plans.landing import FORMATS
from tierlake.sinks.tables import append_table, ensure_schema, overwrite_table, write_keyed_table, write_snapshot
from tierlake.sources.files import read_csv_strict, read_json_strict
from tierlake.sources.lineage import add_ingestion_meta
from tierlake.sources.schemas import LANDING_SCHEMAS
from tierlake.sources.tables import read_snapshot


def read_landing(spark: SparkSession, root: str, name: str):
    """Strict typed read of one landing source, with lineage columns."""
    fmt, rel = FORMATS[name]
    path = os.path.join(root, rel)
    schema = LANDING_SCHEMAS[name]
    if fmt == "csv":
        df = read_csv_strict(spark, path, schema)
    else:
        df = read_json_strict(spark, path, schema, multi_line=(fmt == "json_array"))
    return add_ingestion_meta(df)


def run_bronze(spark: SparkSession, landing_root: str, names: LakeNames, locations: dict | None = None,
               snapshots: str | None = None) -> None:
    """Land every source as a table; with ``snapshots``, circuits also as the next
    version of a snapshot under that path."""
    ensure_schema(spark, names.schema("bronze"), (locations or {}).get("bronze"))
    for src in SOURCES:
        overwrite_table(read_landing(spark, landing_root, src), names.table("bronze", src))
    if snapshots:
        write_snapshot(spark.table(names.table("bronze", "circuits")), os.path.join(snapshots, "circuits"))


def run_silver(spark: SparkSession, names: LakeNames, locations: dict | None = None,
               snapshots: str | None = None, circuits_version: int | None = None) -> None:
    """Conform every source; with ``snapshots``, circuits come from the given version of
    their snapshot (None: the latest)."""
    ensure_schema(spark, names.schema("silver"), (locations or {}).get("silver"))
    for src in SOURCES:
        if src == "circuits" and snapshots:
            bronze = read_snapshot(spark, os.path.join(snapshots, "circuits"), circuits_version)
        else:
            bronze = spark.table(names.table("bronze", src))
        overwrite_table(CONFORMERS[src](bronze), names.table("silver", src))


def run_gold(spark: SparkSession, names: LakeNames, locations: dict | None = None) -> None:
    ensure_schema(spark, names.schema("gold"), (locations or {}).get("gold"))
    s = {n: spark.table(names.table("silver", n)) for n in ("results", "drivers", "constructors", "races", "circuits")}
    rr_name = names.table("gold", GOLD_TABLES[0])
    overwrite_table(marts.race_results(s["results"], s["drivers"], s["constructors"], s["races"], s["circuits"]),
                    rr_name)
    rr = spark.table(rr_name)
    # A table keeps no row order: no global sort is paid for.
    overwrite_table(marts.driver_standings(rr, sort=False), names.table("gold", GOLD_TABLES[1]))
    overwrite_table(marts.constructor_standings(rr, sort=False), names.table("gold", GOLD_TABLES[2]))


def run_features(spark: SparkSession, names: LakeNames) -> dict:
    """Write the modelling frame once, publish the keyed feature table from it (validated
    primary key) and return its key stats."""
    rr = spark.table(names.table("gold", GOLD_TABLES[0]))
    frame = names.table("gold", "podium_model_frame")
    overwrite_table(ft.model_frame(ft.podium_features(rr)), frame)
    return write_keyed_table(ft.feature_table(spark.table(frame)), names.table("gold", "driver_race_features"),
                             ["feature_key"])


def run_model(spark: SparkSession, names: LakeNames, cut: int = md.SPLIT_SEASON, params: dict | None = None,
              min_accuracy: float = MIN_ACCURACY, top: int = 20, model_path: str | None = None) -> dict:
    """Split, weight, fit, score, tune the threshold and publish.

    Writes ``podium_scores`` (the test split's probabilities), ``podium_predictions``
    (labels at the tuned threshold) and ``latest_season_podiums`` (the ``top`` most
    probable of the newest season), appends the run to ``run_metrics`` and saves
    the model when a path is given.
    """
    train, test = md.time_split(spark.table(names.table("gold", "podium_model_frame")), cut=cut)
    model = md.train_podium_model(train, params=params)
    if model_path:
        md.save_model(model, model_path)
    scores = names.table("gold", "podium_scores")
    overwrite_table(md.score(model, test).withColumn("y", F.col(ft.TARGET_COL).cast("int")), scores)
    scored = spark.table(scores)
    threshold, values = md.evaluate_scores(scored, "y", "predicted_podium_prob", "predicted_podium", min_accuracy)
    published = names.table("gold", "podium_predictions")
    overwrite_table(apply_threshold(scored.drop("y"), "predicted_podium_prob", threshold, "predicted_podium"), published)
    overwrite_table(latest_season_topk(spark.table(published), top), names.table("gold", "latest_season_podiums"))
    run_id = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
    append_table(md.metrics_table(spark, run_id, values), names.table("gold", "run_metrics"))
    return {"run_id": run_id, **{name: value for kind, name, value in values if kind == "metric"},
            "threshold": threshold}


def run_all(spark: SparkSession, landing_root: str, names: LakeNames = LakeNames(),
            locations: dict | None = None, cut: int = md.SPLIT_SEASON, model_params: dict | None = None,
            snapshots: str | None = None, circuits_version: int | None = None) -> dict:
    run_bronze(spark, landing_root, names, locations, snapshots)
    run_silver(spark, names, locations, snapshots, circuits_version)
    run_gold(spark, names, locations)
    return {"feature_table": run_features(spark, names), "model": run_model(spark, names, cut, model_params)}


def main(argv=None) -> None:
    """Run the whole lakehouse from a landing folder (the notebooks' run order).

        python -m tierlake.plans.pipeline --landing PATH [--catalog C] [--sf-dir DIR]

    With ``--sf-dir`` the landing files are first derived from the driver's
    tables (under the shared scratch root) and ``--landing`` may be omitted.
    """
    import argparse
    import json

    from tierlake.plans.landing import land_all
    from tierlake.session import local_session, scratch_path

    ap = argparse.ArgumentParser()
    ap.add_argument("--landing")
    ap.add_argument("--sf-dir")
    ap.add_argument("--catalog", default="spark_catalog")
    ap.add_argument("--cut", type=int, default=md.SPLIT_SEASON, help="first season of the test split")
    ap.add_argument("--rounds", type=int, default=None, help="boosting rounds (default: the model's own)")
    ap.add_argument("--master", default=None, help="local[N] for a local run; omit under spark-submit")
    args = ap.parse_args(argv)
    if args.master:
        spark = local_session("tierlake-pipeline", cpus=args.master.strip("local[]") or "*")
    else:
        spark = SparkSession.builder.appName("tierlake-pipeline").getOrCreate()
    landing = args.landing
    if args.sf_dir:
        landing = landing or scratch_path(spark, "landing")
        land_all(spark, args.sf_dir, landing)
    if not landing:
        ap.error("--landing or --sf-dir is required")
    params = {"maxIter": args.rounds} if args.rounds else None
    print(json.dumps({"landing": landing, **run_all(spark, landing, LakeNames(catalog=args.catalog), cut=args.cut,
                                                    model_params=params)}))


if __name__ == "__main__":
    main()
