"""Distributed binary-classifier evaluation: AUC, F1, report, sweep, curves.

Everything stays in lazy DataFrames.  Only aggregated rows reach a single task:
per-class counts (<= 4 rows), per-threshold-bucket counts (<= 62 rows), per
score-range totals (<= ``SCORE_RANGES`` rows).  Running sums over *distinct
scores* - whose number grows with the data - use a two-level prefix sum: ranges
of the score whose bounds are quantiles from a mergeable sketch, exact range
offsets, and a running window per range.  The ranges hold about equally many
scores however these cluster, and any bounds give exact sums: a reader takes its
bounds from the very row that holds the offsets belonging to them.
No window ever runs unpartitioned over raw or per-score rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions.exprs import safe_div
from tierlake.functions.ordering import count_at_or_below

# --- fixed values: the reference's threshold grid and report labels -------------
SWEEP_START, SWEEP_STOP, SWEEP_STEP = 0.3, 0.9, 0.01
MIN_ACCURACY = 0.90
CLASS_NAMES = ("No Podium", "Podium")
# --- end fixed values ------------------------------------------------------------
SCORE_RANGES = 1024     # ranges of the two-level prefix sums
STRETCH = 32            # bounds between two that are searched first


def sweep_thresholds(start: float = SWEEP_START, stop: float = SWEEP_STOP, step: float = SWEEP_STEP) -> list[float]:
    """The half-open grid ``start, start + d, ...`` below ``stop`` with d = (start + step) - start.

    Built like an arange over doubles: 61 points for the defaults, the last one
    0.9000000000000006 and the 21st 0.5000000000000002 (so a score of exactly
    0.5 falls below it).
    """
    n = math.ceil((stop - start) / step)
    delta = (start + step) - start
    return [start + i * delta for i in range(n)]


def at_or_below(df: DataFrame, value: str, bounds: str, most: int, out: str) -> DataFrame:
    """Add ``out``, the number of ascending ``bounds`` (a column of at most ``most`` values) that
    are at or below the value: a search among every ``STRETCH``-th bound, then between two."""
    def tree(index, low: int, high: int) -> str:
        """Of the bounds at index(1), ..., index(high): how many are at or below (NULL: beyond the last)."""
        if low == high:
            return str(low)
        mid = (low + high + 1) // 2
        test = f"`{value}` >= get(`{bounds}`, {index(mid)})"
        return f"CASE WHEN {test} THEN {tree(index, mid, high)} ELSE {tree(index, low, mid - 1)} END"

    coarse = tree(lambda k: k * STRETCH - 1, 0, most // STRETCH)
    fine = tree(lambda k: f"`{out}` + {k - 1}", 0, STRETCH - 1)
    return df.withColumn(out, F.expr(f"{STRETCH} * {coarse}")).withColumn(out, F.expr(f"`{out}` + {fine}"))


def with_ranges(df: DataFrame, value: str, cols: list[str], ranges: int = SCORE_RANGES) -> DataFrame:
    """``df`` (one row per distinct value) with ``__range``, the number of the value's range.

    The bounds are one row, broadcast: quantiles of ``value`` from a sketch.  ``cols`` are
    read for it too, so that both readings of ``df`` are the same exchange.
    """
    shares = ", ".join(f"{k / ranges!r}D" for k in range(1, ranges))
    sketch = F.percentile_approx(F.col(value).cast("double"), F.expr(f"array({shares})"), F.lit(16 * ranges))
    found = df.agg(sketch.alias("b"), *[F.sum(c).alias(f"__{c}") for c in cols])
    read = F.coalesce(*[F.col(f"__{c}") for c in cols]).isNotNull()         # false only without rows
    found = found.select(F.when(read, F.array_distinct("b")).alias("__bounds"))
    return at_or_below(df.crossJoin(F.broadcast(found)), value, "__bounds", ranges, "__range").drop("__bounds")


def range_offsets(df: DataFrame, value: str, cols: list[str], descending: bool, ranges: int) -> DataFrame:
    """One row: the lowest value of every range (which bounds the ranges for the reader),
    the sums of ``cols`` over all ranges before each, and over all rows."""
    per = with_ranges(df, value, cols, ranges).groupBy("__range").agg(
        F.min(F.col(value).cast("double")).alias("__low"), *[F.sum(c).alias(c) for c in cols])   # one row per range
    everything = Window.partitionBy()
    before = everything.orderBy(F.desc("__range") if descending else F.asc("__range")).rowsBetween(
        Window.unboundedPreceding, -1)
    sums = per.select("__low", *cols, F.struct(
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in cols]).alias("__before"))
    one = sums.agg(F.sort_array(F.collect_list(F.struct("__low", "__before"))).alias("found"),
                   F.struct(*[F.sum(c).alias(c) for c in cols]).alias("__totals"))
    return one.select(F.transform("found", lambda x: x["__low"]).alias("__lows"),
                      F.transform("found", lambda x: x["__before"]).alias("__offsets"), "__totals")


def running_sums(df: DataFrame, value: str, cols: list[str], descending: bool = False,
                 inclusive: bool = True, ranges: int = SCORE_RANGES) -> DataFrame:
    """Add ``cum_<c>``: sum of ``c`` over rows whose ``value`` is <= (or >=) this row's,
    and ``total_<c>``: the sum over all rows.

    ``df`` must hold one row per distinct non-NULL ``value`` (an aggregate).
    Exclusive sums (``inclusive=False``) leave the current row out.
    """
    found = range_offsets(df, value, cols, descending, ranges)
    rows = at_or_below(df.crossJoin(F.broadcast(found)), value, "__lows", ranges, "__range")
    rows = rows.withColumns({"__before": F.get("__offsets", F.col("__range") - 1),
                             **{f"total_{c}": F.col("__totals")[c] for c in cols}}).drop("__lows", "__offsets", "__totals")
    within = Window.partitionBy("__range").orderBy(F.desc(value) if descending else F.asc(value)).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    return rows.withColumns({
        f"cum_{c}": F.col("__before")[c] + F.coalesce(F.sum(c).over(within), F.lit(0)) for c in cols
    }).drop("__range", "__before")


def score_counts(df: DataFrame, y: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Positives and negatives per distinct score (the only per-score state)."""
    return (df.filter(F.col(p).isNotNull())
              .groupBy(*by, p)
              .agg(F.sum(F.col(y).cast("long")).alias("pos"),
                   F.sum((1 - F.col(y)).cast("long")).alias("neg")))


def auc_roc(df: DataFrame, y: str, p: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact ROC AUC with tied scores counted half: (auc, positives, negatives), one row
    or one per ``by``.

    AUC = sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N); the numerator is
    accumulated doubled, in DECIMAL(38,0), so the sum is exact at any size.  Within a
    range the scores are counted against each other, then whole ranges against the
    negatives of the ranges below: one flow, no join back.
    """
    def dec(c) -> Column:
        return F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c.cast("decimal(38,0)")

    per = with_ranges(score_counts(df, y, p, by), p, ["pos", "neg"])
    below = Window.partitionBy(*by, "__range").orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("__below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    ranges = per.groupBy(*by, "__range").agg(
        F.sum(F.lit(2).cast("decimal(38,0)") * dec("pos") * dec("__below") + dec("pos") * dec("neg")).alias("num2"),
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))                            # one row per range
    lower = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("__lower", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
    agg = ranges.groupBy(*by).agg(
        F.sum(dec("num2") + F.lit(2).cast("decimal(38,0)") * dec("pos") * dec("__lower")).alias("num2"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    den = F.lit(2.0) * F.col("positives").cast("double") * F.col("negatives").cast("double")
    return agg.select(
        *by,
        F.when(den > 0, F.col("num2").cast("double") / den).alias("auc"),
        F.col("positives").cast("long").alias("positives"),
        F.col("negatives").cast("long").alias("negatives"))


def confusion_counts(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row of tp, fp, fn, tn (a single aggregate)."""
    yy, hh = F.col(y), F.col(yhat)
    return df.agg(
        F.count(F.when((yy == 1) & (hh == 1), 1)).alias("tp"),
        F.count(F.when((yy == 0) & (hh == 1), 1)).alias("fp"),
        F.count(F.when((yy == 1) & (hh == 0), 1)).alias("fn"),
        F.count(F.when((yy == 0) & (hh == 0), 1)).alias("tn"))


def f1_binary(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """F1 of the positive class (label 1), 0 when undefined; with its counts."""
    c = confusion_counts(df, y, yhat)
    return c.select("tp", "fp", "fn",
                    safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def classification_report(df: DataFrame, y: str, yhat: str, names=CLASS_NAMES) -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and weighted averages."""
    c = confusion_counts(df, y, yhat)
    tp1, fp1, fn1, tn1 = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    # class 0 sees the matrix mirrored: its true positives are tn
    stats = {0: (tn1, fn1, fp1), 1: (tp1, fp1, fn1)}
    cols = {}
    for k, (tp, fp, fn) in stats.items():
        cols[f"p{k}"] = safe_div(tp, tp + fp)
        cols[f"r{k}"] = safe_div(tp, tp + fn)
        cols[f"f{k}"] = safe_div(2 * tp, 2 * tp + fp + fn)
        cols[f"s{k}"] = (tp + fn).cast("long")
    c = c.select(*[v.alias(k) for k, v in cols.items()], (tp1 + tn1).alias("correct"))
    total = (F.col("s0") + F.col("s1")).cast("double")

    def row(label, prec, rec, f1, sup):
        return F.struct(F.lit(label).alias("label"), prec.alias("precision"), rec.alias("recall"),
                        f1.alias("f1_score"), sup.cast("long").alias("support"))

    def macro(m):
        return (F.col(f"{m}0") + F.col(f"{m}1")) / F.lit(2.0)

    def weighted(m):
        return safe_div(F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1"), total, zero=None)

    null = F.lit(None).cast("double")
    rows = F.array(
        row(names[0], F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row(names[1], F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", null, null, safe_div(F.col("correct"), total, zero=None), F.col("s0") + F.col("s1")),
        row("macro avg", macro("p"), macro("r"), macro("f"), F.col("s0") + F.col("s1")),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), F.col("s0") + F.col("s1")),
    )
    return c.select(F.inline(rows))


def threshold_sweep(df: DataFrame, y: str, p: str, thresholds: list[float] | None = None) -> DataFrame:
    """Accuracy, recall, precision and F1 when predicting ``p >= t`` for each grid ``t``.

    One pass over the rows: each row falls in bucket b = #thresholds <= p, and
    it is a predicted positive at threshold i exactly when b > i.  Per-bucket
    counts (<= len(grid)+1 rows) are suffix-summed.  accuracy is NULL without
    rows, recall is NULL without positives; precision is 0 without predicted positives; F1 is 0 when
    precision + recall is not > 0.
    """
    spark = df.sparkSession
    t = thresholds or sweep_thresholds()
    per = (df.filter(F.col(p).isNotNull())
             .groupBy(count_at_or_below(F.col(p), t).alias("b"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("pos")))
    grid = spark.range(0, len(t) + 1).select(F.col("id").cast("int").alias("b"))
    g = grid.join(per, "b", "left").fillna(0, subset=["n", "pos"])
    suffix = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, 0)   # <= 62 rows
    everything = Window.partitionBy()
    g = g.select(
        "b",
        F.sum("n").over(suffix).alias("pp"), F.sum("pos").over(suffix).alias("tp"),
        F.sum("n").over(everything).alias("total"), F.sum("pos").over(everything).alias("positives"))
    start, delta = t[0], (t[1] - t[0]) if len(t) > 1 else 0.0
    g = g.filter(F.col("b") >= 1).select(
        (F.lit(start) + (F.col("b") - 1).cast("double") * F.lit(delta)).alias("threshold")
        if thresholds is None else F.element_at(F.array(*[F.lit(v) for v in t]), F.col("b")).alias("threshold"),
        "pp", "tp", "total", "positives")
    # correct = tp + tn,  tn = (total - positives) - (pp - tp)
    correct = F.col("tp") + (F.col("total") - F.col("positives")) - (F.col("pp") - F.col("tp"))
    g = g.select(
        "threshold",
        safe_div(correct, F.col("total"), zero=None).alias("accuracy"),
        safe_div(F.col("tp"), F.col("positives"), zero=None).alias("recall"),
        safe_div(F.col("tp"), F.col("pp")).alias("precision"))
    return g.withColumn("f1", safe_div(F.lit(2.0) * F.col("precision") * F.col("recall"),
                                       F.col("precision") + F.col("recall")))


def best_threshold(sweep: DataFrame, min_acc: float = MIN_ACCURACY) -> DataFrame:
    """One sweep row: best F1 among thresholds with accuracy >= ``min_acc``,
    else the best accuracy; ties go to the lowest threshold."""
    valid = F.col("accuracy") >= F.lit(min_acc)
    any_valid = F.max(valid.cast("int")).over(Window.partitionBy()) == 1    # over <= 61 rows
    s = sweep.withColumn("__any", any_valid)
    tier = F.when(F.col("__any"), valid.cast("int")).otherwise(F.lit(1))
    metric = F.when(F.col("__any"), F.col("f1")).otherwise(F.col("accuracy"))
    rule = F.when(F.col("__any"), F.lit("best_f1_at_min_accuracy")).otherwise(F.lit("best_accuracy"))
    return (s.withColumn("rule", rule)
             .orderBy(tier.desc(), metric.desc(), F.col("threshold").asc())
             .limit(1)
             .drop("__any"))


def apply_threshold(df: DataFrame, p: str, threshold: float, out: str = "yhat") -> DataFrame:
    """Label ``p >= threshold`` as 1, else 0 (NULL score -> 0)."""
    return df.withColumn(out, F.coalesce((F.col(p) >= F.lit(threshold)).cast("int"), F.lit(0)))


def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """(actual, predicted, n) for all four cells, zero-filled."""
    c = confusion_counts(df, y, yhat)
    cells = F.array(
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("n")),
    )
    return c.select(F.inline(cells))


def _cumulative_desc(df: DataFrame, y: str, p: str) -> DataFrame:
    per = running_sums(score_counts(df, y, p), p, ["pos", "neg"], descending=True)
    return per.withColumnsRenamed({"total_pos": "__all_pos", "total_neg": "__all_neg"})


def roc_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, plus the (inf, 0, 0) origin."""
    c = _cumulative_desc(df, y, p)
    pts = c.select(
        F.col(p).cast("double").alias("threshold"),
        safe_div(F.col("cum_neg"), F.col("__all_neg"), zero=None).alias("fpr"),
        safe_div(F.col("cum_pos"), F.col("__all_pos"), zero=None).alias("tpr"))
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts)


def pr_curve(df: DataFrame, y: str, p: str) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the end point
    (NULL threshold, precision 1, recall 0).  Without positives recall is 1."""
    c = _cumulative_desc(df, y, p)
    pts = c.select(
        F.col(p).cast("double").alias("threshold"),
        (F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg")).cast("double")).alias("precision"),
        safe_div(F.col("cum_pos"), F.col("__all_pos"), zero=1.0).alias("recall"))
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)
