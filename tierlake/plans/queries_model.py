"""Model keys: predictions, importances, rounds, attributions, persistence, run metrics.

The first group works on ``fixed_model``'s trees and on the deterministic score of
``queries_eval``, so that SQL gives every value.  ``model_predictions``, the ``trained_`` keys
and ``model_roundtrip`` fit the booster with the reference's hyper-parameters (300 rounds):
the modelling frame is written once and the model fitted once per (application, input
directory), and the keys share both from the shared scratch root.
"""

from __future__ import annotations

import threading

from pyspark.sql import functions as F

from tierlake.operators import modeling as md
from tierlake.operators import trees as tr
from tierlake.operators.features import FEATURE_COLS
from tierlake.plans import fixed_model
from tierlake.plans import fixtures as fx
from tierlake.plans import oracle_sql as osql
from tierlake.plans.catalog import register
from tierlake.plans.queries_eval import MODEL, SWEEP, _COUNTS_SQL, _ratio_sql, model_frame, scored
from tierlake.session import materialize, scratch_path

_LOCK = threading.Lock()
_FRAMES: dict[tuple[str, str], str] = {}
_FITTED: dict[tuple[str, str], str] = {}
KEYS = ["season", "round", "driver_id"]
SCORE_DIGITS = 9        # exp() differs between engines in the last bits


def frame_path(spark, sf_dir) -> str:
    """The modelling frame, written once per application and input."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:
        if key not in _FRAMES:
            path = scratch_path(spark, "model-frame")
            model_frame(spark, sf_dir).write.parquet(path)
            _FRAMES[key] = path
        return _FRAMES[key]


def splits(spark, sf_dir):
    return md.time_split(spark.read.parquet(frame_path(spark, sf_dir)), cut=fx.CUT_SEASON)


def test_split(spark, sf_dir):
    return splits(spark, sf_dir)[1]


def model_path(spark, sf_dir) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    train, _ = splits(spark, sf_dir)
    with _LOCK:
        if key not in _FITTED:
            path = scratch_path(spark, "podium-model")
            md.save_model(md.train_podium_model(train), path)
            _FITTED[key] = path
        return _FITTED[key]


def fitted_model(spark, sf_dir):
    return md.load_model(model_path(spark, sf_dir))


def trained_nodes(spark, sf_dir):
    return tr.model_nodes(spark, model_path(spark, sf_dir), FEATURE_COLS)


# --- the fixed trees, with SQL ---------------------------------------------------------

_NAMES = ", ".join(f"'{c}'" for c in FEATURE_COLS)
_VALUES = ", ".join(f"coalesce({c}, 0)::DOUBLE" for c in FEATURE_COLS)

# Every row as (feature, value) pairs, and the node table as rows.
ROWS = MODEL.rstrip() + f""",
rows_ AS MATERIALIZED (SELECT row_number() OVER () AS rid, season, round, driver_id, is_podium::INTEGER AS y,
                              season >= {fx.CUT_SEASON} AS is_test, [{_VALUES}] AS v
                       FROM model_frame WHERE season IS NOT NULL),
long_ AS MATERIALIZED (SELECT rid, unnest([{_NAMES}]) AS feature, unnest(v) AS v FROM rows_),
nodes AS (SELECT * FROM (VALUES {fixed_model.values_sql()}) t(tree, node, feature, threshold, value))"""


def route_sql(long_name: str, ids: str = "rid") -> str:
    """CTEs s0, s1, ...: the node of every row (``ids``) and tree after so many splits."""
    on = " AND ".join(f"l.{c} = s.{c}" for c in ids.split(", "))
    picked = ", ".join(f"s.{c}" for c in ids.split(", "))
    parts = [f"""
s0 AS MATERIALIZED (SELECT {ids}, tree, 1 AS node FROM (SELECT DISTINCT {ids} FROM {long_name}),
                    (SELECT DISTINCT tree FROM nodes))"""]
    parts += [f"""
s{k + 1} AS MATERIALIZED (SELECT {picked}, tree, CASE WHEN n.feature IS NULL THEN node WHEN l.v <= n.threshold
                          THEN 2 * node ELSE 2 * node + 1 END AS node
                   FROM s{k} s JOIN nodes n USING (tree, node) LEFT JOIN {long_name} l ON {on} AND l.feature = n.feature)"""
              for k in range(fixed_model.depth())]
    return ",".join(parts)


_LAST = f"s{fixed_model.depth()}"
MARGINS = ROWS + "," + route_sql("long_") + f""",
margins AS (SELECT rid, sum(value) AS margin FROM {_LAST} JOIN nodes USING (tree, node) GROUP BY rid)
"""


def fixed_trees(spark):
    return tr.read_trees(fixed_model.nodes(spark))


@register("model_predictions", MARGINS + f"""
SELECT season, round, driver_id, y AS is_podium, margin, round(1 / (1 + exp(-2 * margin)), {SCORE_DIGITS}) AS score,
       CAST(margin > 0 AS INTEGER) AS predicted_podium, true AS in_range, true AS label_matches
FROM rows_ JOIN margins USING (rid) WHERE is_test""")
def q_model_predictions(spark, sf_dir):
    """The fitted booster's prediction of every test row, in range and with the label of its
    probability, beside the fixed trees' values."""
    trees, p = fixed_trees(spark), F.col("booster_prob")
    fitted = md.score(fitted_model(spark, sf_dir), test_split(spark, sf_dir), "booster_prob", "booster_label")
    out = tr.with_margin(tr.score_nodes(fitted, trees, "p", "predicted_podium"), trees)
    return out.select(*KEYS, F.col("is_podium").cast("int").alias("is_podium"), "margin",
                      F.round("p", SCORE_DIGITS).alias("score"), "predicted_podium",
                      p.between(0.0, 1.0).alias("in_range"),
                      (F.col("booster_label") == (p > 0.5).cast("int")).alias("label_matches"))


_VISITS = " UNION ALL ".join(f"SELECT rid, tree, node FROM s{k}" for k in range(fixed_model.depth()))


@register("feature_importance", MARGINS.rstrip() + f""",
visits AS (SELECT n.feature, count(*) AS rows FROM ({_VISITS}) JOIN nodes n USING (tree, node)
           JOIN rows_ USING (rid) WHERE is_test AND n.feature IS NOT NULL GROUP BY n.feature)
SELECT feature, count(*) AS splits, coalesce(any_value(rows), 0)::BIGINT AS rows
FROM nodes LEFT JOIN visits USING (feature) WHERE feature IS NOT NULL GROUP BY feature""")
def q_feature_importance(spark, sf_dir):
    """Splits per feature and the test rows that reach them."""
    return tr.split_reach(test_split(spark, sf_dir), fixed_trees(spark)).orderBy("splits", "feature")


@register("evaluation_rounds", MARGINS.rstrip() + f""",
grown AS (SELECT rid, y, tree + 1 AS round, sum(value) OVER (PARTITION BY rid ORDER BY tree) AS m
          FROM {_LAST} JOIN nodes USING (tree, node) JOIN rows_ USING (rid) WHERE is_test),
per AS (SELECT round, m, sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg FROM grown GROUP BY round, m),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY round ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING
                                          AND 1 PRECEDING), 0) AS below FROM per)
SELECT round, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN CAST(sum(2 * pos * below + pos * neg) AS DOUBLE)
                / (2.0e0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc,
       sum(pos)::BIGINT AS positives, sum(neg)::BIGINT AS negatives
FROM cum GROUP BY round""")
def q_evaluation_rounds(spark, sf_dir):
    """AUC on the test split after every boosting round."""
    rows = test_split(spark, sf_dir).withColumn("y", F.col("is_podium").cast("int"))
    return tr.auc_by_round(rows, fixed_trees(spark), "y")


@register("attributions", MARGINS + """
SELECT season, round, driver_id, margin, margin AS contribution_sum,
       (SELECT round(avg(margin), 6) FROM rows_ JOIN margins USING (rid) WHERE NOT is_test) AS base
FROM rows_ JOIN margins USING (rid) WHERE is_test""")
def q_attributions(spark, sf_dir):
    """Shapley values of every test row; with the base they add up to the margin, and the base
    is the mean margin of the training rows."""
    train, test = splits(spark, sf_dir)
    trees = tr.with_cover(train, fixed_trees(spark))
    rows = tr.with_margin(test, trees)
    found = tr.attributions(rows, trees, [*KEYS, "margin"], FEATURE_COLS)
    total = F.col("base")
    for c in FEATURE_COLS:
        total = total + F.col(f"phi_{c}")
    return found.select(*KEYS, "margin", F.round(total, 6).alias("contribution_sum"), F.round("base", 6).alias("base"))


def _digits_sql() -> str:
    return "1 + " + " + ".join(f"(count(*) OVER () > {md.PERMUTATION_ROWS * 16 ** k})::INTEGER"
                               for k in range(1, md.HEX_DIGITS))


PERMUTED = ROWS + f""",
hashed AS (SELECT rid, season, round, driver_id, md5(concat_ws(':', '42', season, round, driver_id)) AS h,
                  {_digits_sql()} AS digits FROM rows_ WHERE is_test),
nexts AS (SELECT rid, coalesce(lead(rid) OVER w, first_value(rid) OVER w) AS next_rid
          FROM hashed WINDOW w AS (PARTITION BY left(h, digits) ORDER BY h, season, round, driver_id)),
variants AS (SELECT unnest(['', {_NAMES}]) AS changed),
mixed AS MATERIALIZED (SELECT o.rid, changed, o.feature, CASE WHEN o.feature = changed THEN x.v ELSE o.v END AS v
          FROM long_ o JOIN nexts n USING (rid) JOIN long_ x ON x.rid = n.next_rid AND x.feature = o.feature, variants),"""


@register("permutation_importance", PERMUTED + route_sql("mixed", "rid, changed") + f""",
scored_ AS (SELECT changed, rid, sum(value) AS m FROM {_LAST} JOIN nodes USING (tree, node) GROUP BY changed, rid),
per AS (SELECT changed, m, sum(y)::BIGINT AS pos, (count(*) - sum(y))::BIGINT AS neg
        FROM scored_ JOIN rows_ USING (rid) GROUP BY changed, m),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY changed ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING
                                          AND 1 PRECEDING), 0) AS below FROM per),
auc AS (SELECT changed, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN CAST(sum(2 * pos * below + pos * neg) AS DOUBLE)
                / (2.0e0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc FROM cum GROUP BY changed)
SELECT a.changed AS feature, b.auc AS base_auc, a.auc AS permuted_auc, b.auc - a.auc AS importance
FROM auc a, auc b WHERE a.changed <> '' AND b.changed = ''""")
def q_permutation_importance(spark, sf_dir):
    trees = fixed_trees(spark)

    def by_margin(rows):
        return tr.with_margin(rows, trees, "predicted_podium_prob")       # any score in the order of the probability

    return md.permutation_importance(by_margin, test_split(spark, sf_dir), KEYS)


_PARAMS = ", ".join(f"('param', '{k}', '{v}')" for k, v in md.PODIUM_PARAMS.items())


@register("run_metrics", SWEEP.rstrip() + f""", {osql.best_threshold_cte('best', '0.9e0')}, {_COUNTS_SQL},
tuned AS (SELECT *, CAST(p >= (SELECT threshold FROM best) AS INTEGER) AS hit FROM scored),
per AS (SELECT p, CAST(sum(y) AS BIGINT) AS pos, CAST(count(*) - sum(y) AS BIGINT) AS neg FROM scored GROUP BY p),
cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM per)
SELECT 'evaluation' AS run_id, kind, name, value FROM (
  SELECT 'metric' AS kind, 'test_auc' AS name,
         (SELECT CAST(CAST(sum(2 * pos * below + pos * neg) AS DOUBLE)
                 / (2.0e0 * CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS VARCHAR) FROM cum) AS value
  UNION ALL SELECT 'metric', 'test_f1', (SELECT CAST({_ratio_sql('2 * tp', '2 * tp + fp + fn')} AS VARCHAR) FROM counts)
  UNION ALL SELECT 'metric', 'test_accuracy',
         (SELECT CAST(CAST(count(*) FILTER (hit = y) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS VARCHAR) FROM tuned)
  UNION ALL SELECT 'param', 'threshold', (SELECT CAST(threshold AS VARCHAR) FROM best)
  UNION ALL SELECT * FROM (VALUES {_PARAMS}, ('tag', 'model_type', 'GBTClassifier'),
         ('tag', 'task', 'binary_classification'), ('tag', 'target', 'podium_finish')))""")
def q_run_metrics(spark, sf_dir):
    rows = materialize(scored(spark, sf_dir), "scored")       # read by the evaluations below
    _, values = md.evaluate_scores(rows, "y", "p", "yhat")
    return md.metrics_table(spark, "evaluation", values)


# --- the fitted booster ----------------------------------------------------------------

@register("trained_predictions", MODEL + f"""
SELECT season, round, driver_id, is_podium, true AS in_range, true AS label_matches
FROM model_frame WHERE season >= {fx.CUT_SEASON}""")
def q_trained_predictions(spark, sf_dir):
    """The booster's saved nodes, compiled into the query."""
    p = F.col("predicted_podium_prob")
    trees = tr.read_trees(trained_nodes(spark, sf_dir))
    return tr.score_nodes(test_split(spark, sf_dir), trees).select(
        *KEYS, "is_podium", p.between(0.0, 1.0).alias("in_range"),
        (F.col("predicted_podium") == (p > 0.5).cast("int")).alias("label_matches"))


@register("model_roundtrip", MODEL + f"""
SELECT season, round, driver_id, true AS same_score
FROM model_frame WHERE season >= {fx.CUT_SEASON}""")
def q_model_roundtrip(spark, sf_dir):
    # Save a fresh copy, load it back, score with both.
    path = scratch_path(spark, "podium-model-copy")
    model = fitted_model(spark, sf_dir)
    md.save_model(model, path)
    once = md.score(model, test_split(spark, sf_dir), "score_before", "label_before")
    both = md.score(md.load_model(path), once, "score_after", "label_after")
    same = (F.col("score_before") == F.col("score_after")) & (F.col("label_before") == F.col("label_after"))
    return both.select(*KEYS, same.alias("same_score"))


@register("trained_importance")
def q_trained_importance(spark, sf_dir):
    """Split counts and gains of the booster, every feature, ascending by splits."""
    return md.feature_importance(trained_nodes(spark, sf_dir))


@register("trained_permutation_importance")
def q_trained_permutation_importance(spark, sf_dir):
    return md.permutation_importance(fitted_model(spark, sf_dir), test_split(spark, sf_dir), KEYS)


@register("trained_run_metrics")
def q_trained_run_metrics(spark, sf_dir):
    rows = md.score(fitted_model(spark, sf_dir), test_split(spark, sf_dir))
    rows = materialize(rows.withColumn("y", F.col("is_podium").cast("int")))      # read by the evaluations below
    _, values = md.evaluate_scores(rows, "y", "predicted_podium_prob", "predicted_podium")
    return md.metrics_table(spark, spark.sparkContext.applicationId, values)
