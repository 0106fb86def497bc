"""DuckDB SQL for the same fixture, silver and gold steps, used as the oracle.

Written independently of the DataFrame code: each query key's SQL is a
``WITH`` chain of the CTEs below plus a final SELECT.  DuckDB lacks ``initcap``
and rounds a double's binary value when casting to DECIMAL, so both have exact
SQL re-statements here (``initcap_sql`` / ``avg_2dp_sql``).
"""

from __future__ import annotations


def initcap_sql(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def avg_2dp_sql(x: str) -> str:
    """Half-up mean to DECIMAL(5,2), exact in integers."""
    n = (f"(sign(sum({x})) * ((200 * abs(sum({x})) + count({x})) // (2 * count({x}))))")
    return (f"CASE WHEN count({x}) > 0 "
            f"THEN CAST(CAST({n} AS DECIMAL(18,0)) / 100 AS DECIMAL(5,2)) END")


# --- bronze (landing-shaped) fixture -------------------------------------------
ENTRY_CTES = """
entry_groups AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season,
         CAST(month(o.o_orderdate) AS INTEGER) AS month,
         l.l_suppkey AS driver_key,
         CAST(month(o.o_orderdate) + 12 * (l.l_suppkey // 20) AS INTEGER) AS round,
         CAST(count(*) AS INTEGER) AS laps,
         sum(l.l_quantity) AS qty,
         min(l.l_extendedprice) AS min_price,
         CAST(min(o.o_orderdate) AS DATE) AS first_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2, 3, 4
),
ranked_entries AS (
  SELECT *,
         CAST(row_number() OVER (PARTITION BY season, round ORDER BY min_price, driver_key) AS INTEGER) AS grid,
         CAST(row_number() OVER (PARTITION BY season, round ORDER BY qty DESC, driver_key) AS INTEGER) AS finish,
         CASE WHEN month = 3 AND driver_key % 13 = 5 THEN NULL
              ELSE driver_key // 2 + CASE WHEN month > 6 AND driver_key % 10 = 0 THEN 1 ELSE 0 END END AS team_key
  FROM entry_groups
)"""


def _result_select(date_as_text: bool, points: str) -> str:
    date = "make_date(season, month, 1)"
    if date_as_text:
        date = f"strftime({date}, '%Y-%m-%d')"
    pos = "CASE WHEN laps % 5 = 0 THEN NULL ELSE finish END"
    return f"""
  SELECT {date} AS date,
         'grand prix ' || CAST(round AS VARCHAR) AS raceName,
         CAST(round AS INTEGER) AS round,
         CAST(season AS INTEGER) AS season,
         concat_ws('/', 'results', season, round, driver_key) AS url,
         CAST(team_key AS VARCHAR) AS constructorId,
         CAST(driver_key AS VARCHAR) AS driverId,
         grid, laps,
         CAST(driver_key % 100 + 100 * copy AS INTEGER) AS number,
         CAST({points} AS FLOAT) AS points,
         CAST({pos} AS INTEGER) AS position,
         coalesce(CAST({pos} AS VARCHAR), 'R') AS positionText,
         CASE WHEN copy = 1 THEN 'disqualified' WHEN laps % 9 = 4 THEN NULL WHEN laps % 5 = 0 THEN 'retired'
              WHEN laps % 5 = 1 THEN '+1 LAP' ELSE 'finished' END AS status
  FROM ranked_entries, (VALUES (0), (1)) AS copies(copy) WHERE copy = 0 OR laps % 4 = 3"""


BRONZE_CTES = {
    "results": f"bronze_results AS ({_result_select(False, 'qty')}\n)",
    "sprints": f"bronze_sprints AS ({_result_select(True, 'qty / 2')}\n)",
    "drivers": """bronze_drivers AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS driverId,
         {'givenName': CASE WHEN s.s_suppkey % 27 <> 4 THEN substring(s.s_name, 1, 8) END,
          'familyName': CASE WHEN s.s_suppkey % 9 <> 4 THEN substring(s.s_name, 10) END} AS name,
         CAST(DATE '1960-01-01' + CAST(s.s_suppkey % 7300 AS INTEGER) AS DATE) AS dateOfBirth,
         lower(n.n_name) AS nationality,
         'drivers/' || CAST(s.s_suppkey AS VARCHAR) AS url
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
)""",
    "constructors": """bronze_constructors AS (
  SELECT CAST(t.team AS VARCHAR) AS constructorId, concat_ws(' ', n.n_name, 'team', t.team) AS name,
         r.r_name AS nationality, 'constructors/' || CAST(t.team AS VARCHAR) AS url
  FROM (SELECT s_suppkey // 2 AS team, min(s_nationkey) AS nation FROM supplier GROUP BY 1) t
  LEFT JOIN nation n ON t.nation = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)""",
    "races": """bronze_races AS (
  SELECT season, CAST(round AS VARCHAR) AS round,
         concat_ws('/', 'races', season, round) AS url,
         'grand prix ' || CAST(round AS VARCHAR) AS raceName,
         min(first_date) AS date,
         CAST((season + round) % 6 AS VARCHAR) AS circuitId
  FROM entry_groups GROUP BY season, round
)""",
    "circuits": """bronze_circuits AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS circuitId,
         'circuits/' || CAST(r_regionkey AS VARCHAR) AS url,
         r_name AS circuitName,
         CAST(r_regionkey * 10.5e0 AS DOUBLE) AS lat,
         CAST(r_regionkey * -3.25e0 AS DOUBLE) AS long,
         lower(r_name) || ' city' AS locality,
         r_name AS country
  FROM region
)""",
}


def _dedupe(src: str, keys: list[str], cols: list[str]) -> str:
    """First row per key under the order of all remaining columns (NULLS FIRST)."""
    rest = [c for c in cols if c not in keys]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    return (f"SELECT * FROM {src} QUALIFY row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1")


_RESULT_SILVER_COLS = ["date", "race_name", "round", "season", "constructor_id", "driver_id",
                       "grid", "laps", "number", "points", "position", "position_text", "status"]

SILVER_CTES = {
    "results": f"""silver_results_r AS (
  SELECT date, raceName AS race_name, round, season, constructorId AS constructor_id,
         driverId AS driver_id, grid, laps, number, points, position,
         positionText AS position_text, status FROM bronze_results
),
silver_results_d AS ({_dedupe('silver_results_r', ['season', 'round', 'driver_id'], _RESULT_SILVER_COLS)}),
silver_results AS (
  SELECT date, {initcap_sql('race_name')} AS race_name, round, season, constructor_id, driver_id,
         grid, laps, number, points, position, position_text, {initcap_sql('status')} AS status
  FROM silver_results_d
)""",
    "sprints": f"""silver_sprints_r AS (
  SELECT date, raceName AS race_name, round, season, constructorId AS constructor_id,
         driverId AS driver_id, grid, laps, number, points, position,
         positionText AS position_text, status FROM bronze_sprints
),
silver_sprints_d AS ({_dedupe('silver_sprints_r', ['season', 'round', 'driver_id'], _RESULT_SILVER_COLS)}),
silver_sprints AS (
  SELECT CAST(strptime(date, '%Y-%m-%d') AS DATE) AS date, {initcap_sql('race_name')} AS race_name,
         round, season, constructor_id, driver_id, grid, laps, number, points, position,
         position_text, {initcap_sql('status')} AS status
  FROM silver_sprints_d
)""",
    "drivers": f"""silver_drivers_r AS (
  SELECT driverId AS driver_id, dateOfBirth AS date_of_birth, nationality,
         name.givenName AS first_name, name.familyName AS last_name FROM bronze_drivers
),
silver_drivers_d AS ({_dedupe('silver_drivers_r', ['driver_id'], ['driver_id', 'date_of_birth', 'nationality', 'first_name', 'last_name'])}),
silver_drivers AS (
  SELECT driver_id, date_of_birth, {initcap_sql('nationality')} AS nationality,
         {initcap_sql('first_name')} AS first_name, {initcap_sql('last_name')} AS last_name
  FROM silver_drivers_d
)""",
    "constructors": f"""silver_constructors_r AS (
  SELECT constructorId AS constructor_id, name AS constructor_name, nationality FROM bronze_constructors
),
silver_constructors_d AS ({_dedupe('silver_constructors_r', ['constructor_id'], ['constructor_id', 'constructor_name', 'nationality'])}),
silver_constructors AS (
  SELECT constructor_id, constructor_name, {initcap_sql('nationality')} AS nationality FROM silver_constructors_d
)""",
    "races": f"""silver_races_r AS (
  SELECT season, CAST(round AS INTEGER) AS round, raceName AS race_name, date AS race_date,
         circuitId AS circuit_id FROM bronze_races
),
silver_races_d AS ({_dedupe('silver_races_r', ['season', 'round'], ['season', 'round', 'race_name', 'race_date', 'circuit_id'])}),
silver_races AS (
  SELECT season, round, {initcap_sql('race_name')} AS race_name, race_date, circuit_id FROM silver_races_d
)""",
    "circuits": f"""silver_circuits_r AS (
  SELECT circuitId AS circuit_id, circuitName AS circuit_name, lat AS latitude, long AS longitude,
         locality, country FROM bronze_circuits WHERE circuitId IS NOT NULL
),
silver_circuits_d AS ({_dedupe('silver_circuits_r', ['circuit_id'], ['circuit_id', 'circuit_name', 'latitude', 'longitude', 'locality', 'country'])}),
silver_circuits AS (
  SELECT circuit_id, {initcap_sql('circuit_name')} AS circuit_name, latitude, longitude,
         {initcap_sql('locality')} AS locality, country FROM silver_circuits_d
)""",
}

GOLD_RACE_RESULTS_CTE = """race_results AS (
  SELECT r.season, r.round, r.race_name, ra.race_date,
         c.circuit_name, c.locality, c.country,
         r.driver_id, concat_ws(' ', d.first_name, d.last_name) AS driver_name,
         d.nationality AS driver_nationality,
         r.constructor_id, k.constructor_name, k.nationality AS constructor_nationality,
         r.grid, r.position, r.position_text, r.points, r.laps, r.status,
         r.grid - r.position AS positions_gained,
         coalesce(r.position = 1, false) AS is_winner,
         coalesce(r.position <= 3, false) AS is_podium,
         coalesce(r.status <> 'Finished', false) AS is_dnf
  FROM silver_results r
  LEFT JOIN silver_drivers d ON r.driver_id = d.driver_id
  LEFT JOIN silver_constructors k ON r.constructor_id = k.constructor_id
  LEFT JOIN silver_races ra ON r.season = ra.season AND r.round = ra.round
  LEFT JOIN silver_circuits c ON ra.circuit_id = c.circuit_id
)"""


def with_ctes(*parts: str) -> str:
    """``WITH`` prefix over the named CTE groups, in dependency order."""
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def bronze_prefix(*names: str) -> list[str]:
    parts = []
    if any(n in ("results", "sprints", "races") for n in names):
        parts.append(ENTRY_CTES)
    parts += [BRONZE_CTES[n] for n in names]
    return parts


def silver_prefix(*names: str) -> list[str]:
    return bronze_prefix(*names) + [SILVER_CTES[n] for n in names]


def gold_prefix() -> list[str]:
    return silver_prefix("results", "drivers", "constructors", "races", "circuits") + [GOLD_RACE_RESULTS_CTE]


# --- history features ------------------------------------------------------------
FEATURE_WINDOWS = """
  WINDOW dw AS (PARTITION BY driver_id ORDER BY season, round ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
         cw AS (PARTITION BY constructor_id ORDER BY season, round, driver_id
                ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING),
         hw AS (PARTITION BY driver_id, circuit_name ORDER BY season, round
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""

FEATURES_CTE = f"""classified AS (SELECT * FROM race_results WHERE position IS NOT NULL),
features AS (
  SELECT *,
         avg(position) OVER dw AS driver_avg_position_last5,
         avg(points) OVER dw AS driver_avg_points_last5,
         avg(CAST(is_podium AS INTEGER)) OVER dw AS driver_podium_rate_last5,
         avg(CAST(is_winner AS INTEGER)) OVER dw AS driver_win_rate_last5,
         avg(CAST(is_dnf AS INTEGER)) OVER dw AS driver_dnf_rate_last5,
         avg(position) OVER hw AS driver_circuit_avg_position,
         count(*) OVER hw AS driver_circuit_races,
         avg(points) OVER cw AS constructor_avg_points_last10,
         avg(CAST(is_podium AS INTEGER)) OVER cw AS constructor_podium_rate_last10,
         avg(CAST(is_dnf AS INTEGER)) OVER cw AS constructor_dnf_rate_last10
  FROM classified
  {FEATURE_WINDOWS}
)"""

FEATURE_COLS_SQL = """grid, season, round, driver_avg_position_last5, driver_avg_points_last5,
       driver_podium_rate_last5, driver_win_rate_last5, driver_dnf_rate_last5,
       constructor_avg_points_last10, constructor_podium_rate_last10, constructor_dnf_rate_last10,
       driver_circuit_avg_position, driver_circuit_races"""

MODEL_FRAME_CTE = f"""model_frame AS (
  SELECT {FEATURE_COLS_SQL}, is_podium, driver_name, race_name, driver_id
  FROM features WHERE driver_avg_position_last5 IS NOT NULL
)"""


def features_prefix() -> list[str]:
    return gold_prefix() + [FEATURES_CTE]


def model_prefix() -> list[str]:
    return features_prefix() + [MODEL_FRAME_CTE]


# --- deterministic score fixture and evaluation -----------------------------------
SCORED_CTE = """scored AS (
  SELECT *, CAST(is_podium AS INTEGER) AS y, 1.0e0 - grid / 32.0e0 AS p,
         CAST((1.0e0 - grid / 32.0e0) > 0.85e0 AS INTEGER) AS yhat
  FROM model_frame WHERE season >= 2000
)"""

SWEEP_CTES = """sweep_grid AS (
  SELECT 0.3e0 + CAST(i AS DOUBLE) * ((0.3e0 + 0.01e0) - 0.3e0) AS threshold FROM range(61) t(i)
),
sweep_counts AS (
  SELECT g.threshold, count(*) AS total, sum(s.y) AS positives,
         sum(CASE WHEN s.p >= g.threshold THEN 1 ELSE 0 END) AS pp,
         sum(CASE WHEN s.p >= g.threshold AND s.y = 1 THEN 1 ELSE 0 END) AS tp
  FROM sweep_grid g, scored s GROUP BY g.threshold
),
sweep_rates AS (
  SELECT threshold,
         CASE WHEN total > 0 THEN CAST(tp + (total - positives) - (pp - tp) AS DOUBLE) / CAST(total AS DOUBLE) END
           AS accuracy,
         CASE WHEN positives > 0 THEN CAST(tp AS DOUBLE) / CAST(positives AS DOUBLE) END AS recall,
         CASE WHEN pp > 0 THEN CAST(tp AS DOUBLE) / CAST(pp AS DOUBLE) ELSE 0.0e0 END AS precision
  FROM sweep_counts
),
sweep AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2.0e0 * precision * recall / (precision + recall)
                 ELSE 0.0e0 END AS f1
  FROM sweep_rates
)"""


def best_threshold_cte(name: str, min_acc: str) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (any_valid, tier, metric) FROM (
    SELECT *, CASE WHEN any_valid THEN 'best_f1_at_min_accuracy' ELSE 'best_accuracy' END AS rule,
           CASE WHEN any_valid THEN CAST(accuracy >= {min_acc} AS INTEGER) ELSE 1 END AS tier,
           CASE WHEN any_valid THEN f1 ELSE accuracy END AS metric
    FROM (SELECT *, max(CAST(accuracy >= {min_acc} AS INTEGER)) OVER () = 1 AS any_valid FROM sweep)
  ) ORDER BY tier DESC, metric DESC, threshold ASC LIMIT 1
)"""


def scored_prefix() -> list[str]:
    return model_prefix() + [SCORED_CTE]


def sweep_prefix() -> list[str]:
    return scored_prefix() + [SWEEP_CTES]
