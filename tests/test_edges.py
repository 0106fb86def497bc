"""Edge semantics: NULLs, ties, rounding, casing, strict parsing, snapshots, keys."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierlake.functions.dates import parse_date
from tierlake.operators import evaluation as ev
from tierlake.operators import features as ft
from tierlake.operators import marts
from tierlake.operators import modeling as md
from tierlake.operators.conform import conform_races, require_not_null
from tierlake.operators.dedupe import dedupe
from tierlake.sinks.tables import update_keyed_table, write_keyed_table, write_snapshot
from tierlake.sources.files import read_csv_strict, read_json_strict
from tierlake.sources.schemas import CIRCUITS_SCHEMA, RACES_SCHEMA, SPRINTS_SCHEMA
from tierlake.sources.tables import read_snapshot, snapshot_versions


def test_dedupe_null_and_duplicate_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 3)], "k int, v int")
    out = sorted(dedupe(df, ["k"]).collect(), key=lambda r: (r.k is not None, r.k))
    assert [(r.k, r.v) for r in out] == [(None, 1), (1, 3)]


def test_dedupe_order_and_partition_independence(spark):
    rows = [(i % 7, i, f"x{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, v int, s string")
    a = dedupe(df, ["k"], [("v", False)]).collect()
    b = dedupe(df.repartition(13), ["k"], [("v", False)]).collect()
    assert sorted(a) == sorted(b)
    assert {r.k: r.v for r in a} == {k: max(v for kk, v, _ in rows if kk == k) for k in range(7)}
    # idempotent
    assert sorted(dedupe(dedupe(df, ["k"]), ["k"]).collect()) == sorted(dedupe(df, ["k"]).collect())


def test_flags_null_position_and_status(spark):
    df = spark.createDataFrame(
        [(None, None, 5), (1, "Finished", 1), (3, "+1 Lap", 4), (4, "Finished", 2)],
        "position int, status string, grid int").withColumns(
        {"first_name": F.lit("a"), "last_name": F.lit(None).cast("string")})
    out = marts.race_flags(df).collect()
    assert [(r.is_winner, r.is_podium, r.is_dnf) for r in out] == [
        (False, False, False), (True, True, False), (False, True, True), (False, False, False)]
    assert out[0].positions_gained is None and out[3].positions_gained == -2
    assert out[0].driver_name == "a"


def test_initcap_semantics(spark):
    df = spark.createDataFrame([("jean-ERIC", "mcLaren"), ("a  b", "x\ty"), (None, "")], "a string, b string")
    out = df.select(F.initcap("a").alias("a"), F.initcap("b").alias("b")).collect()
    assert [(r.a, r.b) for r in out] == [("Jean-eric", "Mclaren"), ("A  B", "X\ty"), (None, "")]


def test_avg_decimal_is_half_up_and_never_silently_null(spark):
    df = spark.createDataFrame(
        [("a", 2), ("a", 2), ("a", 2), ("a", 2), ("a", 2), ("a", 3), ("a", 2), ("a", 2)]
        + [("b", 427)] + [("b", 0)] * 199, "g string, x int")
    out = {r.g: r.m for r in df.groupBy("g").agg(marts.mean_2dp("x").alias("m")).collect()}
    assert out["a"] == Decimal("2.13")      # 2.125 -> half-up 2.13
    assert out["b"] == Decimal("2.14")      # 2.135 -> 2.14 (not the binary 2.13)
    wide = spark.createDataFrame([("c", 1234), ("c", 1235)], "g string, x int")
    with pytest.raises(Exception):          # 1234.5 does not fit DECIMAL(5,2): the job fails
        wide.groupBy("g").agg(marts.mean_2dp("x").alias("m")).collect()
    assert wide.groupBy("g").agg(marts.mean_2dp("x", 9).alias("m")).first().m == Decimal("1234.50")


def test_string_round_joins_as_int(spark):
    races = spark.createDataFrame([(2000, "01", "u", "r", dt.date(2000, 1, 1), "c")], RACES_SCHEMA)
    silver = conform_races(races)
    assert silver.schema["round"].dataType.simpleString() == "int"
    results = spark.createDataFrame([(2000, 1, "d")], "season int, round int, driver_id string")
    joined = marts.join_races(results, silver).collect()
    assert joined[0].circuit_id == "c"
    bad = spark.createDataFrame([(2000, "x", "u", "r", None, "c")], RACES_SCHEMA)
    with pytest.raises(Exception):
        conform_races(bad).collect()


def test_to_date_strict_and_lenient(spark):
    df = spark.createDataFrame([("2024-02-29",), (None,)], "d string")
    assert [r.d for r in parse_date(df, "d").collect()] == [dt.date(2024, 2, 29), None]
    bad = spark.createDataFrame([("x",)], "d string")
    with pytest.raises(Exception):
        parse_date(bad, "d").collect()
    assert parse_date(bad, "d", strict=False).first().d is None


def test_require_not_null(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    assert [r.v for r in require_not_null(df, ["k"]).collect()] == [2]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_strict_csv(spark, tmp):
    root = tmp.replace("file:", "")
    good = os.path.join(root, "good.csv")
    _write(good, "circuitId,url,circuitName,lat,long,locality,country\nc1,u,n,1.5,2.5,l,k\n")
    assert read_csv_strict(spark, good, CIRCUITS_SCHEMA).first().lat == 1.5
    bad = os.path.join(root, "bad.csv")
    _write(bad, "circuitId,url,circuitName,lat,long,locality,country\nc1,u,n,abc,2.5,l,k\n")
    with pytest.raises(Exception):
        read_csv_strict(spark, bad, CIRCUITS_SCHEMA).collect()
    short = os.path.join(root, "short.csv")
    _write(short, "circuitId,url,circuitName,lat,long,locality,country\nc1,u\n")
    with pytest.raises(Exception):
        read_csv_strict(spark, short, CIRCUITS_SCHEMA).collect()
    wrong = os.path.join(root, "wrong.csv")
    _write(wrong, "a,b,c,d,e,f,g\nc1,u,n,1.5,2.5,l,k\n")
    assert read_csv_strict(spark, wrong, CIRCUITS_SCHEMA).count() == 1        # header only skipped
    with pytest.raises(Exception):
        read_csv_strict(spark, wrong, CIRCUITS_SCHEMA, strict_header=True).collect()


def test_strict_json(spark, tmp):
    root = tmp.replace("file:", "")
    d = os.path.join(root, "dir")
    _write(os.path.join(d, "a.json"), '{"constructorId": "c1", "name": "n", "extra": 1}\n')
    _write(os.path.join(d, "b.json"), '{"constructorId": "c2"}\n')
    df = read_json_strict(spark, d, "constructorId STRING, name STRING, nationality STRING, url STRING")
    rows = sorted(df.collect())
    assert [(r.constructorId, r.name, r.nationality) for r in rows] == [("c1", "n", None), ("c2", None, None)]
    q = os.path.join(root, "q.json")
    _write(q, '{"round": "3"}\n')
    with pytest.raises(Exception):
        read_json_strict(spark, q, SPRINTS_SCHEMA).collect()
    arr = os.path.join(root, "arr.json")
    _write(arr, '[\n  {"round": 1, "season": 2000},\n  {"round": 2, "season": 2000}\n]\n')
    assert read_json_strict(spark, arr, SPRINTS_SCHEMA, multi_line=True).count() == 2
    with pytest.raises(Exception):
        read_json_strict(spark, arr, SPRINTS_SCHEMA).collect()


def test_snapshots(spark, tmp):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert write_snapshot(df, tmp) == 0
    assert write_snapshot(df.withColumn("v", F.lit("b")), tmp) == 1
    assert snapshot_versions(spark, tmp) == [0, 1]
    assert read_snapshot(spark, tmp, 0).first().v == "a"
    assert read_snapshot(spark, tmp).first().v == "b"
    assert all("_version=0" in f for f in read_snapshot(spark, tmp, 0).inputFiles())
    assert read_snapshot(spark, tmp, 0).columns == ["k", "v"]


def test_empty_and_aborted_snapshot_loads(spark, tmp):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert write_snapshot(df, tmp) == 0
    assert write_snapshot(df.limit(0), tmp) == 1            # an empty load is a version
    assert read_snapshot(spark, tmp).count() == 0 and read_snapshot(spark, tmp).columns == ["k", "v"]
    # a load that died before its commit leaves files but no marker
    died = os.path.join(tmp.replace("file:", ""), "_version=2")
    os.makedirs(died)
    with open(os.path.join(died, "part-00000.parquet"), "wb") as f:
        f.write(b"half a file")
    assert snapshot_versions(spark, tmp) == [0, 1] and read_snapshot(spark, tmp).count() == 0
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, tmp, 2)
    assert write_snapshot(df, tmp) == 3
    assert read_snapshot(spark, tmp).first().v == "a"


def test_keyed_table_rejects_duplicates_and_nulls(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS keyed_test")
    ok = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert write_keyed_table(ok, "keyed_test.t1", ["k"])["rows"] == 2
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError):
        write_keyed_table(dup, "keyed_test.t2", ["k"])
    assert not spark.catalog.tableExists("keyed_test.t2")
    nul = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError):
        write_keyed_table(nul, "keyed_test.t3", ["k"])
    # a bad load, or one of another schema, leaves the last good table alone
    for bad in (dup, nul, ok.withColumn("w", F.lit(1))):
        with pytest.raises(ValueError):
            write_keyed_table(bad, "keyed_test.t1", ["k"])
        assert sorted((r.k, r.v) for r in spark.table("keyed_test.t1").collect()) == [("a", 1), ("b", 2)]
    assert not spark.catalog.tableExists("keyed_test.t1__staging")
    write_keyed_table(ok.limit(1), "keyed_test.t1", ["k"])
    assert spark.table("keyed_test.t1").count() == 1


def _files(spark, name):
    """Partition folder -> its data files (with length and time)."""
    location = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for folder in fs.listStatus(path):
        if folder.isDirectory():
            found = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(folder.getPath())]
            out[folder.getPath().getName()] = sorted(found)
    return out


def test_keyed_update_touches_only_its_partitions(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS keyed_test")
    name = "keyed_test.updated"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    schema = "k string, season int, v int"
    first = spark.createDataFrame([(f"{s}-{i}", s, i) for s in (2001, 2002, 2003) for i in range(4)], schema)
    assert update_keyed_table(first, name, ["k"], "season")["inserted"] == 12
    before = _files(spark, name)
    batch = spark.createDataFrame([("2002-1", 2002, 100), ("2002-9", 2002, 9), ("2004-0", 2004, 0)], schema)
    stats = update_keyed_table(batch, name, ["k"], "season")
    assert (stats["updated"], stats["inserted"], stats["partitions"]) == (1, 2, 2)
    after = _files(spark, name)
    assert after["season=2001"] == before["season=2001"] and after["season=2003"] == before["season=2003"]
    assert after["season=2002"] != before["season=2002"] and "season=2004" in after
    want = {(f"{s}-{i}", s, i) for s in (2001, 2002, 2003) for i in range(4)} - {("2002-1", 2002, 1)}
    want |= {("2002-1", 2002, 100), ("2002-9", 2002, 9), ("2004-0", 2004, 0)}
    assert {(r.k, r.season, r.v) for r in spark.table(name).collect()} == want
    # a bad batch changes nothing and leaves no helper table
    for rows in ([("a", 2001, 1), ("a", 2001, 2)], [(None, 2001, 1)], [("b", None, 1)], [("2001-0", 2003, 1)]):
        with pytest.raises(ValueError):
            update_keyed_table(spark.createDataFrame(rows, schema), name, ["k"], "season")
    with pytest.raises(ValueError):
        update_keyed_table(spark.createDataFrame([("c", 2001, "x")], "k string, season int, v string"), name, ["k"], "season")
    assert _files(spark, name) == after
    assert {r.tableName for r in spark.sql("SHOW TABLES IN keyed_test").collect()} & {"updated__batch", "updated__merged"} == set()
    assert update_keyed_table(first.limit(0), name, ["k"], "season")["rows"] == 0
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_rank_ties_share_rank(spark):
    df = spark.createDataFrame([(2000, 10.0, 1), (2000, 10.0, 1), (2000, 10.0, 0), (2000, 5.0, 3)],
                               "season int, total_points double, wins long")
    ranks = sorted(r.season_rank for r in marts.season_rank(df).collect())
    assert ranks == [1, 1, 3, 4]


def test_rank_equals_the_window_rank(spark):
    rows = [(s, float(p % 5), p % 3) for s in (None, 1999, 2000) for p in range(40)] + [(2000, None, 1)]
    df = spark.createDataFrame(rows, "season int, total_points double, wins long")
    w = Window.partitionBy("season").orderBy(F.desc("total_points"), F.desc("wins"))
    want = df.withColumn("season_rank", F.rank().over(w))
    assert sorted(map(repr, marts.season_rank(df).collect())) == sorted(map(repr, want.collect()))


def test_null_seasons_are_in_no_split(spark):
    df = spark.createDataFrame([(1999, 1), (None, 2), (2000, 3)], "season int, x int")
    assert sorted((r.x, r.split) for r in md.label_split(df, cut=2000, fill_cols=["x"]).collect()) == [(1, "train"), (3, "test")]
    train, test = md.time_split(df, cut=2000, fill_cols=["x"])
    assert [r.x for r in train.collect()] == [1] and [r.x for r in test.collect()] == [3]


def test_evaluation_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "y int, p double, yhat int")
    assert ev.auc_roc(df, "y", "p").first().auc is None
    sweep = ev.threshold_sweep(df, "y", "p").collect()
    assert len(sweep) == 61 and all(r.accuracy is None and r.recall is None and r.f1 == 0.0 for r in sweep)
    report = {r.label: r for r in ev.classification_report(df, "y", "yhat").collect()}
    assert report["weighted avg"].f1_score is None and report["accuracy"].f1_score is None
    assert sum(r.n for r in ev.confusion_matrix(df, "y", "yhat").collect()) == 0


def test_prior_races_of_a_null_team(spark):
    rows = [(2000, r, f"d{r}", None, float(r), False, False) for r in (1, 2, 3)]
    df = spark.createDataFrame(rows, "season int, round int, driver_id string, constructor_id string, points double, "
                                     "is_podium boolean, is_dnf boolean")
    out = {r["round"]: r.constructor_avg_points_last10 for r in ft.constructor_form(df, "prior_races").collect()}
    assert out == {1: None, 2: 1.0, 3: 1.5}


def test_driver_name_both_null_is_empty(spark):
    df = spark.createDataFrame([(None, None, 1, "Finished", 1)],
                               "first_name string, last_name string, position int, status string, grid int")
    assert marts.race_flags(df).first().driver_name == ""


def test_failfast_needs_the_column_parsed(spark, tmp):
    root = tmp.replace("file:", "")
    bad = os.path.join(root, "bad.csv")
    _write(bad, "circuitId,url,circuitName,lat,long,locality,country\nc1,u,n,abc,2.5,l,k\n")
    df = read_csv_strict(spark, bad, CIRCUITS_SCHEMA)
    assert df.select("circuitId").count() == 1          # lat never parsed: no failure
    with pytest.raises(Exception):
        df.collect()                                    # fully projected, as bronze writes it
