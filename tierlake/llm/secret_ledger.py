"""Incremental secret scan over a content-addressed blob ledger (DataFrame
functions only).

A *version* is one historical content of one path.  Versions are addressed by
the SHA-256 of their text, so a content that occurs under many paths or many
times in a path's history is one blob.  The ledger holds one row per scanned
(blob, rule, rule version) - with its spans, also when there are none - so a scan

1. lists the blobs of the given versions,
2. keeps the (blob, rule version) pairs that the ledger has not seen,
3. reads and scans only the texts of those blobs, and appends them to the ledger,
4. joins findings back to every path and version of each blob.

Scanning stays in the JVM: matches and the stretches between them come from the
same leftmost non-overlapping pattern (``regexp_extract_all`` and ``split``), and
their lengths add up to code-point offsets.  Texts in which the pattern does not
occur are settled by one ``rlike``.

NULL text counts as empty.  Repeated rows and paths repeat their findings; NULL
paths or versions are carried along; an empty table gives an empty result.  Very long
texts are scanned whole.  The
inputs' other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.llm.common import text_or_empty
from tierlake.session import materialize, scratch_path

LEDGER_SCHEMA = "blob string, rule string, rule_version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """``group`` and ``least``: code points that this group of a match must have."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


# --- fixed values: the base rules ------------------------------------------------
ASSIGN = (r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
RULES = (
    Rule("assign", 1, ASSIGN, group=2, least=12),
    # A run of the class that is too short cannot hide a longer match, so the
    # length is part of the pattern: the same spans as matching any run first.
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
# --- end fixed values ------------------------------------------------------------


def spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end) code-point spans of the rule's matches."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    between = F.split(text, rule.pattern, -1)
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    pieces = F.arrays_zip(found.alias("m"), between.alias("b"), part.alias("p"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc, x):
        start = acc["at"] + F.length(x["b"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        hit = F.coalesce(F.length(x["p"]), F.lit(-1)) >= rule.least
        return F.struct(end.alias("at"), F.when(hit, F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"))))).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(rule.pattern), F.aggregate(pieces, zero, step)["out"]).otherwise(zero["out"])


def blob_id(text: Column) -> Column:
    return F.sha2(text, 256)


def read_ledger(spark: SparkSession, path: str | None) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path) if path else spark.createDataFrame([], LEDGER_SCHEMA)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES) -> DataFrame:
    """New ledger rows for the (blob, rule version) pairs that ``ledger`` lacks.

    ``versions`` needs a ``text`` column.  With a ledger, what is unseen is found from the
    blob ids alone and only the texts of those blobs go on.  Equal texts are collapsed
    map-side before the shuffle, so a blob with many copies moves once per task at most.
    """
    spark = versions.sparkSession
    texts = versions.select(text_or_empty().alias("text")).withColumn("blob", blob_id(F.col("text")))
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules])
    if ledger is None:
        blobs = texts.groupBy("blob").agg(F.first("text").alias("text")).withColumn("__todo", wanted)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set(F.struct("rule", "rule_version")).alias("__seen"))
        none = F.array().cast("array<struct<rule:string,rule_version:int>>")
        unseen = texts.select("blob").distinct().join(seen, "blob", "left").select(
            "blob", F.array_except(wanted, F.coalesce("__seen", none)).alias("__todo")).filter(F.size("__todo") > 0)
        blobs = texts.join(unseen, "blob").groupBy("blob").agg(F.first("text").alias("text"), F.first("__todo").alias("__todo"))

    def scanned(r: Rule) -> Column:
        pair = F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version"))
        return F.when(F.array_contains("__todo", pair), F.struct(
            F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version"),
            spans(F.col("text"), r).alias("spans")))

    rows = blobs.select("blob", F.explode(F.array(*[scanned(r) for r in rules])).alias("r"))
    return rows.filter(F.col("r").isNotNull()).select("blob", "r.*")


def update_ledger(versions: DataFrame, path: str | None = None, rules=RULES) -> str:
    """Scan what the ledger at ``path`` lacks, append it, and return the ledger's path.

    A failed append leaves no committed files (Spark's output committer), so the
    scan can simply run again; a pair that two writers append counts once.
    """
    spark = versions.sparkSession
    known = read_ledger(spark, path) if path else None
    new = scan_unseen(versions, known, rules)
    path = path or scratch_path(spark, "secret-ledger")
    new.write.mode("append").parquet(path)
    return path


def findings_by_version(versions: DataFrame, ledger: DataFrame, rules=RULES) -> DataFrame:
    """Every version with its blob and the ledger's findings of the given rules.

    Adds ``blob`` and ``findings``: array of (kind, start, end) by start, then by
    the order of the rules.  Blobs without a finding never reach the join.
    """
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.array(*[F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules])
    hits = ledger.filter(F.size("spans") > 0).filter(F.array_contains(current, F.struct("rule", "rule_version")))
    per_blob = hits.select(F.col("blob").alias("__blob"), F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), order[F.col("rule")].alias("no"), F.col("rule").alias("kind"),
        s["end"].alias("end"))).alias("__spans"))
    per_blob = per_blob.groupBy("__blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("__spans")))).alias("__spans"))
    addressed = versions.withColumn("blob", blob_id(text_or_empty())).drop("text")
    none = F.array().cast("array<struct<start:int,no:int,kind:string,end:int>>")
    return addressed.join(per_blob, F.col("blob") == F.col("__blob"), "left").withColumn(
        "findings", F.coalesce("__spans", none)).drop("__blob", "__spans")


def scan(versions: DataFrame, path: str | None = None, rules=RULES) -> DataFrame:
    """Incremental scan of ``versions``; findings for every one of its rows."""
    path = update_ledger(versions, path, rules)
    return findings_by_version(versions, read_ledger(versions.sparkSession, path), rules)


def written(findings: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
