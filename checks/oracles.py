"""The same queries as SQL, written on their own and run by another engine."""

from __future__ import annotations

# Views over the given tables, as common table expressions.
LINES = """
li AS (
  SELECT l_orderkey, COUNT(*) AS n_li, CAST(SUM(l_quantity) AS BIGINT) AS qty,
         COUNT(*) FILTER (WHERE l_returnflag = 'N') AS n_n,
         COUNT(*) FILTER (WHERE l_returnflag = 'A') AS n_a,
         COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_r
  FROM lineitem GROUP BY l_orderkey
)"""

ENCOUNTERS = LINES + """,
encounters AS (
  SELECT
    o_orderkey AS encounter_id,
    o_custkey AS patient_nbr,
    CASE WHEN o_custkey % 37 = 0 THEN '?' ELSE c_mktsegment END AS race,
    CASE WHEN o_custkey % 50 = 0 THEN 'Unknown/Invalid' WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN o_custkey % 41 = 0 THEN '?' WHEN o_custkey % 43 = 0 THEN 'unknown'
         ELSE '[' || CAST(10 * (o_custkey % 10) AS VARCHAR) || '-' || CAST(10 * (o_custkey % 10) + 10 AS VARCHAR) || ')'
    END AS age,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_orderkey % 28 + 1 AS INT) END AS discharge_disposition_id,
    CAST(1 + o_orderkey % 14 AS INT) AS time_in_hospital,
    CAST(COALESCE(qty, 0) % 97 AS INT) AS num_lab_procedures,
    CAST(COALESCE(n_li, 0) % 7 AS INT) AS num_procedures,
    CAST(COALESCE(qty, 0) // 8 AS INT) AS num_medications,
    CAST(COALESCE(n_n, 0) AS INT) AS number_outpatient,
    CAST(COALESCE(n_a, 0) AS INT) AS number_emergency,
    CAST(COALESCE(n_r, 0) AS INT) AS number_inpatient,
    CAST(1 + o_orderkey % 9 AS INT) AS number_diagnoses,
    CASE o_orderkey % 12 WHEN 0 THEN '250.83' WHEN 1 THEN '250' WHEN 2 THEN '410' WHEN 3 THEN '785' WHEN 4 THEN '486'
         WHEN 5 THEN '786.5' WHEN 6 THEN 'V27' WHEN 7 THEN 'E885' WHEN 8 THEN '?' WHEN 9 THEN '251'
         WHEN 10 THEN ' 428 ' ELSE '715' END AS diag_1,
    CASE o_orderkey % 5 WHEN 0 THEN 'InternalMedicine' WHEN 1 THEN 'Cardiology' WHEN 2 THEN '?'
         WHEN 3 THEN 'INTERNAL-Other' ELSE 'Surgery-General' END AS medical_specialty,
    CASE o_orderkey % 6 WHEN 0 THEN '>8' WHEN 1 THEN '>7' WHEN 2 THEN 'Norm' ELSE 'None' END AS "A1Cresult",
    CASE o_orderkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'Up' WHEN 2 THEN 'Steady' ELSE 'Down' END AS insulin,
    CASE WHEN o_orderkey % 3 = 0 THEN 'Ch' ELSE 'No' END AS change,
    CASE WHEN o_orderkey % 7 < 5 THEN 'Yes' ELSE 'No' END AS "diabetesMed",
    CASE o_orderpriority WHEN '1-URGENT' THEN '<30' WHEN '2-HIGH' THEN '>30' ELSE 'NO' END AS readmitted
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN li ON l_orderkey = o_orderkey
)"""

_TEXT = [
    "race", "gender", "age", "diag_1", "medical_specialty", '"A1Cresult"', "insulin", "change", '"diabetesMed"',
    "readmitted",
]
_NULLIF = ", ".join(f"NULLIF({name}, '?') AS {name}" for name in _TEXT)

CLEAN = ENCOUNTERS + f""",
clean AS (SELECT * REPLACE ({_NULLIF}) FROM encounters)"""

COHORT = CLEAN + """,
cohort AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY patient_nbr ORDER BY encounter_id NULLS LAST) AS nth
    FROM clean WHERE gender IN ('Male', 'Female')
  ) WHERE nth = 1 AND (discharge_disposition_id IS NULL OR discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21))
)"""


def _features(source: str) -> str:
    """Feature rules over a cleaned encounter table."""
    return f"""
  SELECT
    encounter_id,
    patient_nbr,
    COALESCE((TRY_CAST(regexp_extract(age, '^\\[(\\d+)-(\\d+)\\)$', 1) AS INT)
              + TRY_CAST(regexp_extract(age, '^\\[(\\d+)-(\\d+)\\)$', 2) AS INT)) // 2, 55) AS age_mid,
    CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS gender_enc,
    time_in_hospital, num_lab_procedures, num_procedures, num_medications,
    number_outpatient, number_emergency, number_inpatient, number_diagnoses,
    number_outpatient + number_emergency + number_inpatient AS total_visits,
    CASE WHEN insulin IN ('Up', 'Down', 'Steady') THEN 1 ELSE 0 END AS on_insulin,
    CASE WHEN change = 'Ch' THEN 1 ELSE 0 END AS change_meds,
    CASE WHEN "diabetesMed" = 'Yes' THEN 1 ELSE 0 END AS on_diabetes_med,
    CASE WHEN "A1Cresult" = 'None' THEN 0 ELSE 1 END AS has_a1c_result,
    CASE WHEN "A1Cresult" IN ('>8', '>7') THEN 1 ELSE 0 END AS a1c_high,
    CASE WHEN dx >= 250 AND dx < 251 THEN 1 ELSE 0 END AS diag_diabetes,
    CASE WHEN dx >= 390 AND dx < 460 OR dx >= 785 AND dx < 786 THEN 1 ELSE 0 END AS diag_circulatory,
    CASE WHEN dx >= 460 AND dx < 520 OR dx >= 786 AND dx < 787 THEN 1 ELSE 0 END AS diag_respiratory,
    CASE WHEN LOWER(medical_specialty) LIKE '%internal%' THEN 1 ELSE 0 END AS specialty_internal_med,
    CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmitted_30,
    CASE WHEN readmitted = 'NO' THEN 0 ELSE 1 END AS readmitted_any
  FROM (SELECT *, TRY_CAST(TRIM(diag_1) AS DOUBLE) AS dx FROM {source})"""


FEATURES = CLEAN + ",\nfeatures AS (" + _features("clean") + ")"
COHORT_FEATURES = COHORT + ",\nfeatures AS (" + _features("cohort") + ")"


def _scores(models: int) -> str:
    return f"""
scores AS (
  SELECT *, CASE WHEN predicted_proba > 0.5 THEN 1 ELSE 0 END AS predicted_label FROM (
    SELECT event_id AS id, 'm' || CAST(event_id % {models} AS VARCHAR) AS model_name,
      CAST(FLOOR(LEAST(value, CAST(100.0 AS DOUBLE)) * 100) AS INT) / CAST(10000 AS DOUBLE) AS predicted_proba,
      CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS actual_label,
      CASE WHEN event_id % 4 < 2 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-01-02 00:00:00' END AS run_timestamp
    FROM events)
)"""


SCORES, TWO_MODELS = _scores(1), _scores(2)

# Score table: one row per model and score, best first, with running counts.
CURVE = TWO_MODELS + """,
points AS (
  SELECT model_name, predicted_proba,
    CAST(SUM(actual_label) AS BIGINT) AS pos, CAST(SUM(1 - actual_label) AS BIGINT) AS neg
  FROM scores GROUP BY model_name, predicted_proba
),
curve AS (
  SELECT *,
    CAST(SUM(pos) OVER up AS BIGINT) AS tp, CAST(SUM(neg) OVER up AS BIGINT) AS fp,
    CAST(SUM(pos) OVER whole AS BIGINT) AS p, CAST(SUM(neg) OVER whole AS BIGINT) AS n
  FROM points
  WINDOW up AS (PARTITION BY model_name ORDER BY predicted_proba DESC ROWS UNBOUNDED PRECEDING),
         whole AS (PARTITION BY model_name)
),
areas AS (
  SELECT model_name,
    CAST(SUM(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE) / MAX(CAST(p AS DOUBLE) * n) / 2 AS roc_auc,
    SUM(pos * (tp / CAST(tp + fp AS DOUBLE))) / MAX(p) AS average_precision
  FROM curve GROUP BY model_name
),
cells AS (
  SELECT model_name,
    COUNT(*) FILTER (WHERE actual_label = 0 AND predicted_label = 0) AS tn,
    COUNT(*) FILTER (WHERE actual_label = 0 AND predicted_label = 1) AS fp,
    COUNT(*) FILTER (WHERE actual_label = 1 AND predicted_label = 0) AS fn,
    COUNT(*) FILTER (WHERE actual_label = 1 AND predicted_label = 1) AS tp
  FROM scores GROUP BY model_name
),
rates AS (
  SELECT model_name, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / CAST(tp + fp AS DOUBLE) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / CAST(tp + fn AS DOUBLE) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1
  FROM cells
)"""


def pct(num: str, den: str = "COUNT(*)", digits: int = 2) -> str:
    """100 * num / den, rounded half up in whole numbers."""
    step = 10**digits
    return f"((CAST({num} AS HUGEINT) * {200 * step} + {den}) // (2 * {den})) / {float(step)}::DOUBLE"


def ratio(num: str, den: str, digits: int) -> str:
    step = 10**digits
    return f"((CAST({num} AS HUGEINT) * {2 * step} + {den}) // (2 * {den})) / {float(step)}::DOUBLE"


def mean(col: str) -> str:
    return ratio(f"SUM({col})", f"COUNT({col})", 2)


BAND = (
    "CASE WHEN age_mid BETWEEN 0 AND 30 THEN '0-30' WHEN age_mid BETWEEN 31 AND 50 THEN '31-50' "
    "WHEN age_mid BETWEEN 51 AND 70 THEN '51-70' ELSE '71+' END"
)


def binned(col: str, top: int, suffix: str = "") -> str:
    return (
        f"CASE WHEN {col} > 0 AND {col} <= 30 THEN '0-30{suffix}' WHEN {col} > 30 AND {col} <= 50 THEN '31-50{suffix}' "
        f"WHEN {col} > 50 AND {col} <= 70 THEN '51-70{suffix}' WHEN {col} > 70 AND {col} <= {top} THEN '71+{suffix}' END"
    )


RISK = (
    "(CASE WHEN total_visits >= 5 THEN 3 WHEN total_visits >= 3 THEN 1 ELSE 0 END"
    " + CASE WHEN num_medications >= 20 THEN 3 WHEN num_medications >= 15 THEN 1 ELSE 0 END"
    " + CASE WHEN a1c_high = 1 THEN 1 ELSE 0 END + CASE WHEN time_in_hospital >= 7 THEN 1 ELSE 0 END)"
)
TIER = f"CASE WHEN {RISK} >= 5 THEN 'High Risk' WHEN {RISK} >= 3 THEN 'Medium Risk' ELSE 'Low Risk' END"

KPI_MEASURES = f"""
    COUNT(*) AS total_encounters, CAST(SUM(readmitted_30) AS BIGINT) AS readmitted_30_count,
    {ratio('SUM(readmitted_30)', 'COUNT(*)', 4)} AS readmission_rate_30,
    {mean('time_in_hospital')} AS avg_time_in_hospital, {mean('num_medications')} AS avg_num_medications,
    {mean('total_visits')} AS avg_total_visits"""

KPI_SQL = f"""
kpis AS (
  SELECT 1 AS family, 'overall' AS segment_type, 'All Patients' AS segment_value, {KPI_MEASURES} FROM features
  UNION ALL
  SELECT 2, 'age_group', {BAND}, {KPI_MEASURES} FROM features GROUP BY 3
  UNION ALL
  SELECT 3, 'insulin', CASE WHEN on_insulin = 1 THEN 'On Insulin' ELSE 'Not on Insulin' END, {KPI_MEASURES}
  FROM features GROUP BY 3
)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY family, segment_value) AS INT) AS kpi_id, * EXCLUDE (family) FROM kpis"""


def _dx(col: str, label: str) -> str:
    return f"SELECT 'diagnosis', 'Primary Dx: {label}', {KPI_MEASURES} FROM features WHERE {col} = 1"


KPI_EXPORT = f"""
SELECT 'overall' AS segment_type, 'All Patients' AS segment_value, {KPI_MEASURES} FROM features
UNION ALL
SELECT 'age_group', {binned('age_mid', 120)} AS band, {KPI_MEASURES} FROM features
WHERE age_mid > 0 AND age_mid <= 120 GROUP BY band
UNION ALL
SELECT 'insulin', 'No Insulin', {KPI_MEASURES} FROM features WHERE on_insulin = 0
UNION ALL
SELECT 'insulin', 'On Insulin', {KPI_MEASURES} FROM features WHERE on_insulin = 1
UNION ALL
{_dx('diag_diabetes', 'Diabetes')}
UNION ALL
{_dx('diag_circulatory', 'Circulatory')}
UNION ALL
{_dx('diag_respiratory', 'Respiratory')}"""

_CORRELATED = [
    "age_mid", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications", "total_visits",
    "number_diagnoses", "readmitted_30",
]
CORRELATIONS = "\nUNION ALL\n".join(
    f"SELECT '{b}' AS column_a, '{a}' AS column_b, ROUND(CORR({b}, {a}), 6) AS correlation FROM features"
    for i, a in enumerate(_CORRELATED)
    for b in _CORRELATED[i + 1 :]
)

HISTOGRAM = """
bins AS (SELECT CAST(range AS INT) AS lo FROM range(1, 14)),
groups AS (
  SELECT readmitted_30, AVG(time_in_hospital) AS mean,
    COUNT(*) FILTER (WHERE time_in_hospital BETWEEN 1 AND 14) AS in_range
  FROM features GROUP BY readmitted_30
),
counted AS (
  SELECT readmitted_30, LEAST(time_in_hospital, 13) AS lo, COUNT(*) AS n
  FROM features WHERE time_in_hospital BETWEEN 1 AND 14 GROUP BY ALL
)
SELECT g.readmitted_30, CAST(b.lo AS DOUBLE) AS bin_low, CAST(b.lo + 1 AS DOUBLE) AS bin_high, COALESCE(c.n, 0) AS n,
  ROUND(COALESCE(c.n, 0) / CAST(g.in_range AS DOUBLE), 8) AS density, ROUND(g.mean, 8) AS mean
FROM groups g CROSS JOIN bins b LEFT JOIN counted c ON c.readmitted_30 = g.readmitted_30 AND c.lo = b.lo"""

BOXPLOT = """
box AS (
  SELECT readmitted_30, COUNT(*) AS n, quantile_cont(CAST(num_medications AS DOUBLE), 0.25) AS q1,
    quantile_cont(CAST(num_medications AS DOUBLE), 0.5) AS median,
    quantile_cont(CAST(num_medications AS DOUBLE), 0.75) AS q3
  FROM features GROUP BY readmitted_30
),
fenced AS (
  SELECT f.readmitted_30, f.num_medications AS x, b.* EXCLUDE (readmitted_30),
    q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi
  FROM features f JOIN box b USING (readmitted_30)
)
SELECT readmitted_30, MAX(n) AS n, MAX(q1) AS q1, MAX(median) AS median, MAX(q3) AS q3,
  LEAST(CAST(MIN(x) FILTER (WHERE x >= lo) AS DOUBLE), MAX(q1)) AS whisker_low,
  GREATEST(CAST(MAX(x) FILTER (WHERE x <= hi) AS DOUBLE), MAX(q3)) AS whisker_high,
  COUNT(*) FILTER (WHERE x < lo OR x > hi) AS fliers,
  ROUND(MAX(median) - 1.57::DOUBLE * (MAX(q3) - MAX(q1)) / SQRT(MAX(n)), 8) AS notch_low,
  ROUND(MAX(median) + 1.57::DOUBLE * (MAX(q3) - MAX(q1)) / SQRT(MAX(n)), 8) AS notch_high
FROM fenced GROUP BY readmitted_30"""

SPLIT = FEATURES + """,
hashed AS (
  SELECT *, CAST('0x' || substr(md5(CAST(encounter_id AS VARCHAR) || ':42'), 1, 8) AS BIGINT) AS h FROM features
),
sizes AS (
  SELECT readmitted_30, COUNT(*) AS n_c, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS n FROM features GROUP BY readmitted_30
),
tests AS (SELECT *, (n + 4) // 5 AS t FROM sizes),
floors AS (SELECT *, (t * n_c) // n AS base, (t * n_c) % n AS rest FROM tests),
quotas AS (
  SELECT readmitted_30,
    base + CASE WHEN ROW_NUMBER() OVER (ORDER BY rest DESC, readmitted_30) <= t - SUM(base) OVER () THEN 1 ELSE 0 END AS quota
  FROM floors
),
split AS (
  SELECT x.* EXCLUDE (nth, h), CASE WHEN nth <= quota THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY readmitted_30 ORDER BY h, encounter_id) AS nth FROM hashed) x
  JOIN quotas USING (readmitted_30)
)"""

_INPUTS = [
    "age_mid", "gender_enc", "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "total_visits", "number_diagnoses", "on_insulin", "change_meds", "on_diabetes_med", "has_a1c_result",
    "a1c_high", "diag_diabetes", "diag_circulatory", "diag_respiratory", "specialty_internal_med",
]
SCALER = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, ROUND(AVG({c}), 8) AS mean, "
    f"ROUND(CASE WHEN STDDEV_POP({c}) = 0 THEN 1 ELSE STDDEV_POP({c}) END, 8) AS scale FROM split WHERE split = 'train'"
    for c in _INPUTS
)
# The cells of all inputs of rows with two sums, per value, and the sums below each value that is not the least.
def _splits(rows: str, first: str, second: str) -> str:
    names = ", ".join(f"CAST({c} AS DOUBLE)" for c in _INPUTS)
    return f"""SELECT f, v AS threshold, SUM(a) OVER below AS al, SUM(b) OVER below AS bl, COUNT(*) OVER () AS _n,
    SUM(n) OVER below AS nl, SUM(a) OVER whole AS a, SUM(b) OVER whole AS b, SUM(n) OVER whole AS n
  FROM (
    SELECT f, v, SUM(a) AS a, SUM(b) AS b, COUNT(*) AS n
    FROM (SELECT unnest(range({len(_INPUTS)})) AS f, unnest([{names}]) AS v, {first} AS a, {second} AS b FROM {rows})
    GROUP BY f, v
  )
  WINDOW below AS (PARTITION BY f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), whole AS (PARTITION BY f)"""


_NAMES = "[" + ", ".join(f"'{c}'" for c in _INPUTS) + "]"
_TRAIN = """,
counts AS (SELECT SUM(1 - readmitted_30) AS n0, SUM(readmitted_30) AS n1 FROM split WHERE split = 'train'),
train AS (SELECT split.*, n0, n1 FROM split, counts WHERE split = 'train')"""


def _nodes(tree: int, best: str, root: str, left: str, right: str) -> str:
    """The three nodes of a tree of one split; weights and values as SQL."""
    rows = []
    for node, (n, (weight, value)) in enumerate(zip(("n", "nl", "n - nl"), (w.split(";") for w in (root, left, right)))):
        split = f"{_NAMES}[f + 1], threshold, ROUND(gain, 4)" if node == 0 else "NULL, NULL, NULL"
        rows.append(
            f"SELECT CAST({tree} AS INT) AS tree, CAST({node} AS INT) AS node, {split}, CAST({n} AS BIGINT), ROUND({weight}, 4), ROUND({value}, 6) FROM {best}"
        )
    return " UNION ALL ".join(rows)


def _boosted_stumps(rounds: int, step: float) -> str:
    parts = [_TRAIN, "\nm0 AS (SELECT *, CASE WHEN readmitted_30 = 1 THEN n0 / CAST(n1 AS DOUBLE) ELSE 1 END AS w, CAST(0 AS DOUBLE) AS margin FROM train)"]
    out = []
    columns = ", ".join(f"CAST({c} AS DOUBLE)" for c in _INPUTS)
    for t in range(rounds):
        gain = "al * al / (bl + 1) + (a - al) * (a - al) / (b - bl + 1) - a * a / (b + 1)"
        parts.append(f"""
g{t} AS (SELECT *, w * (p - readmitted_30) AS g, w * p * (1 - p) AS h FROM (SELECT *, 1 / (1 + EXP(-margin)) AS p FROM m{t})),
s{t} AS ({_splits(f"g{t}", "g", "h")}),
b{t} AS (SELECT *, {gain} AS gain FROM s{t} WHERE nl IS NOT NULL AND bl >= 1 AND b - bl >= 1
  ORDER BY ROUND({gain}, 6) DESC, f, threshold LIMIT 1),
m{t + 1} AS (SELECT m{t}.* EXCLUDE (margin),
  margin - {step} * CASE WHEN [{columns}][f + 1] < threshold THEN al / (bl + 1) ELSE (a - al) / (b - bl + 1) END AS margin FROM m{t}, b{t})""")
        out.append(_nodes(t, f"b{t}", f"b;-{step} * a / (b + 1)", f"bl;-{step} * al / (bl + 1)", f"b - bl;-{step} * (a - al) / (b - bl + 1)"))
    names = "SELECT tree, node, feature, threshold, n_rows, gain, weight, value"
    return ",".join(parts) + f"\n{names} FROM ({' UNION ALL '.join(out)}) AS t(tree, node, feature, threshold, gain, n_rows, weight, value)"


def _forest_stump() -> str:
    share = lambda a, b: f"({a} * {a} + {b} * {b}) / ({a} + {b})"
    gain = f"{share('al', 'bl')} + {share('(a - al)', '(b - bl)')} - {share('a', 'b')}"
    weighted = "CASE WHEN readmitted_30 = {c} THEN (n0 + n1) / (2.0 * n{c}) ELSE 0 END"
    nodes = _nodes(0, "best", "a + b;b / (a + b)", "al + bl;bl / (al + bl)", "a + b - al - bl;(b - bl) / (a + b - al - bl)")
    return f"""{_TRAIN},
s AS ({_splits("train", weighted.format(c=0), weighted.format(c=1))}),
best AS (SELECT *, {gain} AS gain FROM s WHERE nl >= 20 AND n - nl >= 20 ORDER BY ROUND({gain}, 6) DESC, f, threshold LIMIT 1)
SELECT tree, node, feature, threshold, n_rows, gain, weight, value
FROM ({nodes}) AS t(tree, node, feature, threshold, gain, n_rows, weight, value)"""


def _newton_steps(steps: int) -> str:
    """Newton's method for one scaled input and an intercept, a step after the other, over the rows per value and label."""
    parts = [f"""{_TRAIN},
x AS (SELECT (time_in_hospital - AVG(time_in_hospital) OVER ()) / STDDEV_POP(time_in_hospital) OVER () AS x, readmitted_30 AS y,
  (n0 + n1) / (2.0 * CASE WHEN readmitted_30 = 1 THEN n1 ELSE n0 END) AS w FROM train),
v AS (SELECT x, y, SUM(w) AS w FROM x GROUP BY x, y),
n0_ AS (SELECT CAST(0 AS DOUBLE) AS s, CAST(0 AS DOUBLE) AS i)"""]
    for t in range(steps):
        parts.append(f"""
d{t} AS (SELECT ANY_VALUE(s) AS s, ANY_VALUE(i) AS i, SUM(w * (p - y) * x) + ANY_VALUE(s) / 0.1 AS gs, SUM(w * (p - y)) AS gi,
  SUM(w * p * (1 - p) * x * x) + 1 / 0.1 AS ss, SUM(w * p * (1 - p) * x) AS si, SUM(w * p * (1 - p)) AS ii
  FROM (SELECT *, 1 / (1 + EXP(-(i + s * x))) AS p FROM v, n{t}_)),
n{t + 1}_ AS (SELECT s - (ii * gs - si * gi) / (ss * ii - si * si) AS s, i - (ss * gi - si * gs) / (ss * ii - si * si) AS i FROM d{t})""")
    return ",".join(parts) + f"\nSELECT ROUND(s, 6) AS slope, ROUND(i, 6) AS intercept, TRUE AS few_passes FROM n{steps}_"


_SCALED = ", ".join(
    f"ROUND(({c} - (SELECT AVG({c}) FROM train)) / "
    f"(SELECT CASE WHEN STDDEV_POP({c}) = 0 THEN 1 ELSE STDDEV_POP({c}) END FROM train), 6) AS {c}"
    for c in _INPUTS
)
SCALED = f""",
train AS (SELECT * FROM split WHERE split = 'train')
SELECT encounter_id, split, {_SCALED} FROM split"""

ROC = CURVE + """,
bends AS (
  SELECT *, ROW_NUMBER() OVER w AS i, LEAD(pos) OVER w AS pos2, LEAD(neg) OVER w AS neg2 FROM curve
  WINDOW w AS (PARTITION BY model_name ORDER BY predicted_proba DESC)
)
SELECT model_name, CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr FROM areas
UNION ALL
SELECT model_name, predicted_proba, ROUND(fp / CAST(n AS DOUBLE), 8), ROUND(tp / CAST(p AS DOUBLE), 8) FROM bends
WHERE i = 1 OR pos2 IS NULL OR pos2 <> pos OR neg2 <> neg"""

PR = CURVE + """
SELECT model_name, predicted_proba AS threshold, ROUND(tp / CAST(tp + fp AS DOUBLE), 8) AS precision,
  ROUND(tp / CAST(p AS DOUBLE), 8) AS recall, ROUND(p / CAST(p + n AS DOUBLE), 8) AS prevalence FROM curve
UNION ALL
SELECT model_name, NULL, 1, 0, ROUND(AVG(actual_label), 8) FROM scores GROUP BY model_name"""

REPORT = CURVE + """,
shares AS (
  SELECT *, tn + fp + fn + tp AS size,
    CASE WHEN tn + fn = 0 THEN 0 ELSE tn / CAST(tn + fn AS DOUBLE) END AS p0,
    CASE WHEN tn + fp = 0 THEN 0 ELSE tn / CAST(tn + fp AS DOUBLE) END AS r0,
    CASE WHEN 2 * tn + fp + fn = 0 THEN 0 ELSE 2 * tn / CAST(2 * tn + fp + fn AS DOUBLE) END AS f0,
    precision AS p1, recall AS r1, f1
  FROM cells JOIN rates USING (model_name)
),
lines AS (
  SELECT model_name, '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, tn + fp AS support FROM shares
  UNION ALL SELECT model_name, '1', p1, r1, f1, tp + fn FROM shares
  UNION ALL SELECT model_name, 'accuracy', (tp + tn) / CAST(size AS DOUBLE), (tp + tn) / CAST(size AS DOUBLE),
    (tp + tn) / CAST(size AS DOUBLE), size FROM shares
  UNION ALL SELECT model_name, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, size FROM shares
  UNION ALL SELECT model_name, 'weighted avg', (p0 * (tn + fp) + p1 * (tp + fn)) / size,
    (r0 * (tn + fp) + r1 * (tp + fn)) / size, (f0 * (tn + fp) + f1 * (tp + fn)) / size, size FROM shares
)
SELECT model_name, class, ROUND(precision, 8) AS precision, ROUND(recall, 8) AS recall, ROUND(f1, 8) AS f1, support
FROM lines"""

METRICS = CURVE + """
SELECT model_name AS "Model", ROUND(roc_auc, 4) AS "ROC_AUC", ROUND(average_precision, 4) AS "AUCPR",
  ROUND(f1, 4) AS "F1", ROUND(precision, 4) AS "Precision_class1", ROUND(recall, 4) AS "Recall_class1"
FROM areas JOIN rates USING (model_name)"""

CAPTURE = TWO_MODELS + """,
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY model_name ORDER BY predicted_proba DESC, id) AS nth,
    (3 * COUNT(*) OVER (PARTITION BY model_name) + 9) // 10 AS top_rows
  FROM scores
),
found AS (
  SELECT model_name, MAX(top_rows) AS top_rows,
    COUNT(*) FILTER (WHERE nth <= top_rows AND actual_label = 1) AS captured,
    CAST(SUM(actual_label) AS BIGINT) AS positives
  FROM ranked GROUP BY model_name
)
SELECT *, ROUND(captured / CAST(positives AS DOUBLE), 8) AS capture,
  ROUND(captured / CAST(positives AS DOUBLE) / CAST(0.3 AS DOUBLE), 8) AS lift FROM found"""


def _with(views: str, query: str) -> str:
    return f"WITH {views}\n{query}"


def _dx_only(flag: str) -> str:
    return (
        f"SELECT f.encounter_id, c.diag_1, f.{flag} FROM features f JOIN clean c ON f.encounter_id = c.encounter_id"
    )


def _count_stage(ordinal: int, stage: str, table: str, columns: int) -> str:
    return f"SELECT {ordinal} AS ordinal, '{stage}' AS stage, COUNT(*) AS n_rows, {columns} AS n_columns FROM {table}"


_PANDAS_NULLS = CLEAN.replace(
    """NULLIF("A1Cresult", '?') AS "A1Cresult\"""", """NULLIF(NULLIF("A1Cresult", '?'), 'None') AS "A1Cresult\""""
)

_MODELS = {"lr": "Logistic Regression", "rf": "Random Forest", "gbt": "Gradient-Boosted Trees"}

ORACLES: dict[str, str] = {
    # sources and sinks
    "read_encounters": _with(CLEAN, "SELECT * FROM clean"),
    "normalise_nulls": _with(CLEAN, "SELECT * FROM clean"),
    "normalise_pandas_nulls": _with(_PANDAS_NULLS, "SELECT * FROM clean"),
    "table_round_trip": _with(FEATURES, "SELECT * FROM features"),
    "read_feature_rows": _with(
        FEATURES,
        "SELECT encounter_id, "
        + ", ".join(f"CAST({name} AS DOUBLE) + {0.25 if name == 'age_mid' else 0} AS {name}" for name in _INPUTS)
        + " FROM features",
    ),
    "prediction_log": _with(
        SCORES,
        """,
runs AS (
  SELECT 'a' AS run_id, run_timestamp, model_name, id, actual_label FROM scores
  UNION ALL SELECT 'b', TIMESTAMP '2024-03-01 12:00:00', model_name, id, actual_label FROM scores
)
SELECT run_id, run_timestamp, model_name, COUNT(*) AS n, CAST(SUM(actual_label) AS BIGINT) AS positives,
  CAST(SUM(id) AS BIGINT) AS id_sum FROM runs GROUP BY ALL""",
    ),
    "stored_kpis": _with(FEATURES, "," + KPI_SQL),
    "exported_metrics": _with("", METRICS),
    # cohort
    "keep_gender": _with(ENCOUNTERS, "SELECT * FROM encounters WHERE gender IN ('Male', 'Female')"),
    "drop_disposition": _with(
        ENCOUNTERS,
        """SELECT * FROM encounters
WHERE discharge_disposition_id IS NULL OR discharge_disposition_id NOT IN (11, 13, 14, 19, 20, 21)""",
    ),
    "first_encounter": _with(
        ENCOUNTERS,
        "SELECT * FROM encounters QUALIFY ROW_NUMBER() OVER (PARTITION BY patient_nbr ORDER BY encounter_id) = 1",
    ),
    "build_cohort": _with(COHORT, "SELECT * FROM cohort"),
    "stage_counts": _with(
        COHORT,
        " UNION ALL ".join(
            [
                _count_stage(1, "raw", "encounters", 21),
                _count_stage(2, "cohort", "cohort", 21),
                _count_stage(3, "features", "cohort", 24),
            ]
        ),
    ),
    # features
    "engineer_features": _with(FEATURES, "SELECT * FROM features"),
    "cohort_features": _with(COHORT_FEATURES, "SELECT * FROM features"),
    "features_pandas_nulls": _with(_PANDAS_NULLS + ",\nfeatures AS (" + _features("clean") + ")", "SELECT * FROM features"),
    "cast_counts": _with(ENCOUNTERS, "SELECT encounter_id, num_medications FROM encounters"),
    "age_midpoint": _with(FEATURES, "SELECT encounter_id, age_mid FROM features"),
    "diag_diabetes": _with(FEATURES, _dx_only("diag_diabetes")),
    "diag_circulatory": _with(FEATURES, _dx_only("diag_circulatory")),
    "diag_respiratory": _with(FEATURES, _dx_only("diag_respiratory")),
    "age_bands": f"""
WITH aged AS (SELECT o_orderkey, CAST(o_orderkey % 125 - 1 AS INT) AS age_mid FROM orders)
SELECT o_orderkey, age_mid AS age, {BAND} AS band, {binned('age_mid', 110)} AS summary_band,
  {binned('age_mid', 120)} AS export_band FROM aged""",
    # quality
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
    "orphan_rows": """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    # segments
    "q1_overall": _with(
        FEATURES,
        f"""SELECT COUNT(*) AS total_encounters, CAST(SUM(readmitted_30) AS BIGINT) AS readmitted_under_30,
  {pct('SUM(readmitted_30)')} AS readmission_rate_30_pct, CAST(SUM(readmitted_any) AS BIGINT) AS readmitted_any,
  {pct('SUM(readmitted_any)')} AS readmission_rate_any_pct FROM features""",
    ),
    "q3_high_risk": _with(
        FEATURES,
        """SELECT encounter_id, patient_nbr, age_mid, time_in_hospital, num_medications, total_visits, on_insulin,
  a1c_high, readmitted_30 FROM features WHERE total_visits >= 5 AND num_medications >= 15
ORDER BY total_visits DESC, num_medications DESC, encounter_id LIMIT 100""",
    ),
    "q4_insulin": _with(
        FEATURES,
        f"""SELECT on_insulin, change_meds, COUNT(*) AS encounters, CAST(SUM(readmitted_30) AS BIGINT) AS readmitted_30,
  {pct('SUM(readmitted_30)')} AS readmission_rate_pct, {mean('time_in_hospital')} AS avg_los
FROM features GROUP BY on_insulin, change_meds""",
    ),
    "q5_a1c": _with(
        FEATURES,
        f"""SELECT has_a1c_result, a1c_high, COUNT(*) AS encounters, {pct('SUM(readmitted_30)')} AS readmission_rate_30_pct,
  {mean('num_medications')} AS avg_medications FROM features GROUP BY has_a1c_result, a1c_high""",
    ),
    "q6_diagnosis": _with(
        FEATURES,
        f"""SELECT diag_diabetes, diag_circulatory, diag_respiratory, COUNT(*) AS encounters,
  {pct('SUM(readmitted_30)')} AS readmission_rate_30_pct, {mean('time_in_hospital')} AS avg_los
FROM features GROUP BY diag_diabetes, diag_circulatory, diag_respiratory""",
    ),
    "q7_accuracy": _with(
        TWO_MODELS,
        f"""SELECT model_name, run_timestamp, COUNT(*) AS predictions_made,
  COUNT(*) FILTER (WHERE predicted_label = actual_label) AS correct,
  {pct('COUNT(*) FILTER (WHERE predicted_label = actual_label)')} AS accuracy_pct,
  ROUND(AVG(predicted_proba), 4) AS avg_predicted_proba FROM scores GROUP BY model_name, run_timestamp""",
    ),
    "q8_kpis": _with(FEATURES, "," + KPI_SQL),
    "kpi_export": _with(FEATURES, KPI_EXPORT),
    "insulin_effect": _with(
        FEATURES,
        """SELECT on_insulin, CASE on_insulin WHEN 0 THEN 'Not on Insulin' WHEN 1 THEN 'On Insulin' END AS label,
  SUM(readmitted_30) / CAST(COUNT(*) AS DOUBLE) * 100 AS rate, COUNT(*) AS total FROM features GROUP BY on_insulin""",
    ),
    "risk_scores": _with(FEATURES, f"SELECT encounter_id, {RISK} AS score, {TIER} AS risk_tier FROM features"),
    "risk_tiers": _with(
        FEATURES,
        f"""SELECT {TIER} AS risk_tier, COUNT(*) AS encounters, CAST(SUM(readmitted_30) AS BIGINT) AS readmitted_30,
  {pct('SUM(readmitted_30)')} AS readmission_rate_pct FROM features GROUP BY 1""",
    ),
    "overview_kpis": _with(
        FEATURES,
        f"""SELECT COUNT(*) AS total_encounters, {pct('SUM(readmitted_30)')} AS readmission_rate_30_pct,
  {mean('time_in_hospital')} AS avg_los, {pct('SUM(has_a1c_result)')} AS a1c_coverage_pct FROM features""",
    ),
    # statistics
    "outcome_distribution": _with(
        FEATURES,
        f"""SELECT outcome, COUNT(*) AS encounters, {pct('COUNT(*)', 'MAX(everyone)', 1)} AS pct FROM (
  SELECT CASE WHEN readmitted_30 = 1 THEN 'Readmitted < 30 days' WHEN readmitted_any = 1 THEN 'Readmitted > 30 days'
    ELSE 'Not Readmitted' END AS outcome, COUNT(*) OVER () AS everyone FROM features) GROUP BY outcome""",
    ),
    "age_rate_points": _with(
        FEATURES,
        f"""SELECT {binned('age_mid', 110)} AS age_group, COUNT(*) AS total, CAST(SUM(readmitted_30) AS BIGINT) AS readmitted,
  SUM(readmitted_30) / CAST(COUNT(*) AS DOUBLE) * 100 AS rate FROM features
WHERE age_mid > 0 AND age_mid <= 110 GROUP BY 1""",
    ),
    "los_histogram": _with(FEATURES, "," + HISTOGRAM),
    "correlation_pairs": _with(FEATURES, CORRELATIONS),
    "medication_boxplot": _with(FEATURES, "," + BOXPLOT),
    # split and scaling
    "class_balance": _with(FEATURES, "SELECT readmitted_30, COUNT(*) AS n FROM features GROUP BY readmitted_30"),
    "class_weights": _with(
        FEATURES,
        """SELECT readmitted_30, COUNT(*) AS n,
  ROUND(CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / (COUNT(*) OVER () * COUNT(*)), 8) AS weight
FROM features GROUP BY readmitted_30""",
    ),
    "weighted_rows": _with(
        FEATURES,
        """SELECT readmitted_30, COUNT(*) AS n,
  ROUND(CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / (COUNT(*) OVER () * COUNT(*)), 8) AS weight,
  ROUND(CASE WHEN readmitted_30 = 1
    THEN CAST(SUM(COUNT(*)) FILTER (WHERE readmitted_30 = 0) OVER () AS DOUBLE) / COUNT(*) ELSE 1 END, 8) AS positive_weight
FROM features GROUP BY readmitted_30""",
    ),
    "stratified_split": _with(SPLIT, "SELECT encounter_id, readmitted_30, split FROM split"),
    "scaler_params": _with(SPLIT, SCALER),
    "scaled_features": _with(SPLIT, SCALED),
    # metrics
    "confusion_matrix": _with(
        CURVE,
        """SELECT model_name, 0 AS actual_label, 0 AS predicted_label, tn AS n FROM cells
UNION ALL SELECT model_name, 0, 1, fp FROM cells
UNION ALL SELECT model_name, 1, 0, fn FROM cells
UNION ALL SELECT model_name, 1, 1, tp FROM cells""",
    ),
    "roc_auc": _with(CURVE, "SELECT model_name, ROUND(roc_auc, 8) AS roc_auc FROM areas"),
    "average_precision": _with(CURVE, "SELECT model_name, ROUND(average_precision, 8) AS average_precision FROM areas"),
    "roc_points": _with("", ROC),
    "pr_points": _with("", PR),
    "classification_report": _with("", REPORT),
    "metrics_table": _with("", METRICS),
    "best_model": _with(
        CURVE, "SELECT model_name, ROUND(roc_auc, 8) AS roc_auc FROM areas ORDER BY areas.roc_auc DESC, model_name LIMIT 1"
    ),
    "capture_at_30": _with("", CAPTURE),
    # scoring and exports
    "proba_tiers": _with(
        SCORES,
        """SELECT id, predicted_proba, predicted_proba >= 0.5 AS flag,
  CASE WHEN predicted_proba >= 0.5 THEN 'HIGH' WHEN predicted_proba >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM scores""",
    ),
    "shown_scores": _with(
        SCORES,
        """SELECT id, ROUND(predicted_proba, 4) AS readmission_probability, predicted_proba >= 0.5 AS flagged,
  CASE WHEN predicted_proba >= 0.5 THEN 'HIGH' WHEN predicted_proba >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
  'GBT' AS model_used FROM scores""",
    ),
    "labelled_features": _with(
        FEATURES,
        f"""SELECT *, {binned('age_mid', 120, ' yrs')} AS age_group,
  CASE gender_enc WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' END AS gender_label,
  CASE on_insulin WHEN 0 THEN 'No Insulin' WHEN 1 THEN 'On Insulin' END AS insulin_label,
  CASE readmitted_30 WHEN 0 THEN 'Not Readmitted' WHEN 1 THEN 'Readmitted <30d' END AS readmit_label,
  {TIER} AS risk_tier FROM features""",
    ),
    "predictions_export": _with(
        FEATURES + "," + TWO_MODELS,
        """SELECT id AS encounter_id, model_name, predicted_proba, predicted_label, actual_label, run_timestamp, age_mid,
  gender_enc, time_in_hospital, num_medications, total_visits,
  CASE gender_enc WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' END AS gender_label
FROM scores JOIN features ON id = encounter_id""",
    ),
    # what must hold of trained models
    **{
        f"{short}_checked": _with(
            SPLIT,
            f"""SELECT encounter_id, '{name}' AS model_name, readmitted_30 AS actual_label, TRUE AS is_probability, TRUE AS label_fits
FROM split WHERE split = 'test'""",
        )
        for short, name in _MODELS.items()
    },
    "importances_checked": f"""SELECT name AS model_name, CAST(15 AS INT) AS n_shown, CAST({len(_INPUTS)} AS INT) AS n_inputs,
TRUE AS in_order, CAST(1 AS DOUBLE) AS total FROM (VALUES ('{_MODELS["rf"]}'), ('{_MODELS["gbt"]}')) AS models(name)""",
    "lr_gradient": "SELECT unnest(['intercept', "
    + ", ".join(f"'{name}'" for name in _INPUTS)
    + "]) AS feature, TRUE AS is_flat",
    "gbt_stumps": _with(SPLIT, _boosted_stumps(3, 0.3)),
    "rf_stump": _with(SPLIT, _forest_stump()),
    "lr_one_input": _with(SPLIT, _newton_steps(12)),
    "planted_models": _with(
        FEATURES,
        f""",
labels AS (
  SELECT CASE WHEN (time_in_hospital BETWEEN 5 AND 10) <> (encounter_id % 10 = 3) THEN 1 ELSE 0 END AS y FROM features
)
SELECT model_name, CAST((SELECT (COUNT(*) + 4) // 5 FROM labels) AS BIGINT) AS n_rows, tells, NOT tells AS does_not_tell,
  tells AS is_among_best, TRUE AS same_when_reloaded
FROM (VALUES ('{_MODELS["lr"]}', FALSE), ('{_MODELS["rf"]}', TRUE), ('{_MODELS["gbt"]}', TRUE)) AS m(model_name, tells)""",
    ),
    "batch_checked": _with(
        FEATURES,
        """SELECT encounter_id, 'GBT' AS model_used, TRUE AS is_probability, TRUE AS flag_fits, TRUE AS tier_fits FROM features""",
    ),
    "log_checked": _with(
        SPLIT,
        """SELECT 'run-1' AS run_id, TIMESTAMP '2024-03-01 12:00:00' AS run_timestamp, encounter_id, readmitted_30 AS actual_label,
  TRUE AS is_best FROM split WHERE split = 'test'""",
    ),
}

_BY_AGE = f"""SELECT {BAND} AS age_group, COUNT(*) AS total, CAST(SUM(readmitted_30) AS BIGINT) AS readmitted_30,
  {pct('SUM(readmitted_30)')} AS rate_pct, {mean('time_in_hospital')} AS avg_los,
  {mean('num_medications')} AS avg_medications FROM features GROUP BY 1"""
ORACLES["q2_age"] = _with(FEATURES, _BY_AGE)
ORACLES["q2_age_cohort"] = _with(COHORT_FEATURES, _BY_AGE)
ORACLES["merged_cohort"] = ORACLES["build_cohort"]
ORACLES["kpis_by_part"] = ORACLES["q8_kpis"]
