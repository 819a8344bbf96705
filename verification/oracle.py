"""The SQL each registered query is compared with, for DuckDB over the same tables.

Queries over random forests have no SQL form; their invariants do.
"""

from __future__ import annotations

from verification.synthetic import FIRST_NAMES, LAST_NAMES

ORACLE_SQL: dict[str, str] = {}

DIRTY = """dirty AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT event_id,
      CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'N/A'
           WHEN event_id % 29 = 0 THEN '' ELSE CAST(value AS VARCHAR) END AS value_raw,
      CASE WHEN event_id % 97 = 0 OR event_id % 13 = 0 THEN NULL ELSE user_id END AS user_id,
      CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'N/A'
           ELSE event_type END AS event_type,
      CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id % 12 END AS bucket,
      event_id % 3 AS flag,
      unnest(range(CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)) AS copy
    FROM events))"""

TYPED = f"""{DIRTY}, typed AS (
  SELECT TRY_CAST(value_raw AS DOUBLE) AS value_raw, CAST(user_id AS DOUBLE) AS user_id,
         event_type, CAST(bucket AS DOUBLE) AS bucket, flag FROM dirty),
counted AS (
  SELECT *,
    CAST((value_raw IS NULL) AS BIGINT) + CAST((user_id IS NULL) AS BIGINT)
    + CAST((event_type IS NULL OR event_type IN ('N/A', '')) AS BIGINT)
    + CAST((bucket IS NULL) AS BIGINT) + CAST((flag IS NULL) AS BIGINT) AS n_missing
  FROM typed),
complete AS (SELECT * EXCLUDE (n_missing) FROM counted WHERE n_missing <= 2)"""

FILLED = f"""{TYPED}, filled AS (
  SELECT coalesce(value_raw, (SELECT quantile_disc(value_raw, 0.5) FROM complete)) AS value_raw,
         coalesce(user_id, (SELECT quantile_disc(user_id, 0.5) FROM complete)) AS user_id,
         CASE WHEN event_type IS NULL OR event_type = 'N/A' THEN
           (SELECT event_type FROM complete WHERE event_type IS NOT NULL AND event_type <> 'N/A'
            GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
         ELSE event_type END AS event_type,
         coalesce(bucket, (SELECT quantile_disc(bucket, 0.5) FROM complete)) AS bucket,
         flag
  FROM complete)"""


def _bounded(source: str, target: str, column: str) -> str:
    """One step of the outlier chain: quartiles of ``source`` applied to ``source``."""
    return f"""q_{target} AS (
  SELECT quantile_disc({column}, 0.25) AS q1, quantile_disc({column}, 0.75) AS q3 FROM {source}),
{target} AS (
  SELECT {source}.* FROM {source}, q_{target}
  WHERE q3 - q1 <= 0
     OR ({column} >= q1 - 1.5 * (q3 - q1) AND {column} <= q3 + 1.5 * (q3 - q1)))"""


CLEANED = f"""{FILLED},
{_bounded("filled", "o1", "value_raw")},
{_bounded("o1", "o2", "user_id")},
{_bounded("o2", "o3", "bucket")},
clean AS (SELECT DISTINCT * FROM o3)"""


def _long(parts: dict[str, str], template: str) -> str:
    return "\nUNION ALL\n".join(template.format(name=n, column=c) for n, c in parts.items())


# --- projections and predicates ------------------------------------------------------------------

ORACLE_SQL["lenient_cast"] = f"""WITH {DIRTY}
SELECT event_id, TRY_CAST(value_raw AS DOUBLE) AS value_raw, CAST(user_id AS DOUBLE) AS user_id,
       CAST(bucket AS DOUBLE) AS bucket FROM dirty"""

ORACLE_SQL["missing_count_hist"] = f"""WITH {TYPED}
SELECT n_missing, count(*) AS n_rows FROM counted GROUP BY n_missing"""

ORACLE_SQL["drop_sparse"] = f"WITH {TYPED} SELECT * FROM complete"

# --- statistics ----------------------------------------------------------------------------------

ORACLE_SQL["quantiles_by_column"] = "\nUNION ALL\n".join(
    f"""SELECT '{column}' AS column_name, CAST({prob} AS DOUBLE) AS prob,
       CAST(quantile_disc({column}, {prob}) AS DOUBLE) AS value FROM {source}"""
    for source, columns in {
        "lineitem": ("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
        "events": ("value", "user_id"),
    }.items()
    for column in columns
    for prob in (0.25, 0.5, 0.75)
)

ORACLE_SQL["approx_medians_within_error"] = """
SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) AS column_name,
       count(*) > 0 AS within_error FROM lineitem"""

_LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
_DISTINCT = """SELECT '{name}' AS column_name,
  count(DISTINCT {name}) + CAST(count(*) > count({name}) AS BIGINT) AS n_distinct FROM {column}"""
ORACLE_SQL["distinct_counts_by_column"] = f"WITH {TYPED}\n" + _long(
    {name: "lineitem" for name in _LINEITEM}
    | {name: "typed" for name in ("value_raw", "user_id", "bucket", "event_type", "flag")},
    _DISTINCT,
)

_MODE = """(SELECT '{name}' AS column_name, {name} AS mode_value, count(*) AS n_rows FROM {column}
 WHERE {name} IS NOT NULL AND {name} <> 'N/A'
 GROUP BY {name} ORDER BY n_rows DESC, {name} LIMIT 1)"""
ORACLE_SQL["modes_by_column"] = f"WITH {DIRTY}\n" + _long(
    {"o_orderstatus": "orders", "o_orderpriority": "orders", "event_type": "dirty"}, _MODE
)

ORACLE_SQL["column_stats_by_column"] = _long(
    {name: "lineitem" for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")},
    """SELECT '{name}' AS column_name, count({name}) AS n_values, round(avg({name}), 6) AS mean,
       round(stddev_samp({name}), 6) AS std FROM {column}""",
)

ORACLE_SQL["label_dictionary_by_column"] = _long(
    {name: "orders" for name in ("o_orderstatus", "o_orderpriority", "o_custkey")},
    """SELECT '{name}' AS column_name, CAST({name} AS VARCHAR) AS value, count(*) AS n_rows,
  row_number() OVER (ORDER BY count(*) DESC, CAST({name} AS VARCHAR)) - 1 AS label_index
FROM {column} GROUP BY {name}""",
)

# --- cleaning ------------------------------------------------------------------------------------

ORACLE_SQL["median_imputation"] = f"""WITH {FILLED}
SELECT coalesce(value_raw, (SELECT quantile_disc(value_raw, 0.5) FROM complete)) AS value_raw,
       coalesce(user_id, (SELECT quantile_disc(user_id, 0.5) FROM complete)) AS user_id,
       event_type,
       coalesce(bucket, (SELECT quantile_disc(bucket, 0.5) FROM complete)) AS bucket, flag
FROM complete"""

ORACLE_SQL["mode_imputation"] = f"""WITH {TYPED}, top AS (
  SELECT event_type AS mode FROM complete WHERE event_type IS NOT NULL AND event_type <> 'N/A'
  GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT value_raw, user_id,
  CASE WHEN event_type IS NULL OR event_type = 'N/A' THEN mode ELSE event_type END AS event_type,
  bucket, flag FROM complete, top"""

ORACLE_SQL["continuous_column_flags"] = _long(
    {
        name: "lineitem"
        for name in (
            "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey",
        )
    },
    """SELECT '{name}' AS column_name, count(DISTINCT {name}) > 10 AS is_continuous,
       count(*) AS n_rows FROM {column}""",
)

_SQUARED = "base AS (SELECT event_id, value, value * value AS squared, user_id FROM events)"
ORACLE_SQL["outliers_sequential"] = f"""WITH {_SQUARED},
{_bounded("base", "s1", "value")},
{_bounded("s1", "s2", "squared")},
{_bounded("s2", "s3", "user_id")}
SELECT * FROM s3"""

ORACLE_SQL["outliers_independent"] = f"""WITH {_SQUARED}, limits AS (
  SELECT quantile_disc(value, 0.25) AS v1, quantile_disc(value, 0.75) AS v3,
         quantile_disc(squared, 0.25) AS s1, quantile_disc(squared, 0.75) AS s3,
         quantile_disc(user_id, 0.25) AS u1, quantile_disc(user_id, 0.75) AS u3 FROM base)
SELECT base.* FROM base, limits
WHERE value BETWEEN v1 - 1.5 * (v3 - v1) AND v3 + 1.5 * (v3 - v1)
  AND squared BETWEEN s1 - 1.5 * (s3 - s1) AND s3 + 1.5 * (s3 - s1)
  AND user_id BETWEEN u1 - 1.5 * (u3 - u1) AND u3 + 1.5 * (u3 - u1)"""

ORACLE_SQL["exact_dedup"] = f"WITH {TYPED} SELECT DISTINCT * FROM typed"

ORACLE_SQL["clean_chain"] = f"WITH {CLEANED} SELECT * FROM clean"

ORACLE_SQL["clean_stage_counts"] = f"WITH {CLEANED}\n" + "\nUNION ALL\n".join(
    f"SELECT 'dirty_events' AS disease, '{stage}' AS stage, count(*) AS n_rows FROM {source}"
    for stage, source in {
        "original": "typed",
        "complete": "complete",
        "within_bounds": "o3",
        "final": "clean",
    }.items()
)

_REPORT = f"""WITH {CLEANED}, sizes AS (
  SELECT (SELECT count(*) FROM typed) AS original, (SELECT count(*) FROM complete) AS kept,
         (SELECT count(*) FROM o3) AS bounded, (SELECT count(*) FROM clean) AS final)
SELECT 'dirty_events' AS disease, original AS original_rows, original - kept AS null_rows_removed,
  kept - bounded AS outlier_rows_removed, bounded - final AS duplicate_rows_removed,
  final AS final_rows, CAST(5 AS BIGINT) AS column_count"""
ORACLE_SQL["quality_report"] = (
    f"{_REPORT}, round(final / original * 100, 1) AS retained_pct FROM sizes"
)

# --- sources and sinks ---------------------------------------------------------------------------

ORACLE_SQL["csv_round_trip"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate, o_orderpriority FROM orders"""

ORACLE_SQL["csv_spec_scan"] = f"""WITH {TYPED}
SELECT value_raw, user_id, event_type, bucket, CAST(flag AS DOUBLE) AS flag FROM typed"""

ORACLE_SQL["parquet_round_trip"] = "SELECT * FROM lineitem"

ORACLE_SQL["report_round_trip"] = f"{_REPORT} FROM sizes"

# --- synthetic records ---------------------------------------------------------------------------


def _draw(field: str, low: int, high: int) -> str:
    """A whole number in low..high from the hash of seed, field and id."""
    digest = f"substr(md5('42:{field}:' || id), 1, 8)"
    return f"({low} + CAST(CAST('0x' || {digest} AS UBIGINT) AS BIGINT) % {high - low + 1})"


def _pick(field: str, choices: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{c}'" for c in choices)
    return f"([{listed}])[{_draw(field, 1, len(choices))}]"


# The record's fields and domains, written out here so that the library's own list is checked by it:
# a name and its choices, or a whole number in low..high over a scale.
DOMAINS = (
    ("HighBP", 0, 1, 1),
    ("HighChol", 0, 1, 1),
    ("CholCheck", 0, 1, 1),
    ("BMI", 150, 500, 10),
    ("Smoker", 0, 1, 1),
    ("Stroke", 0, 1, 1),
    ("Diabetes", 0, 2, 1),
    ("HeartDiseaseorAttack", 0, 1, 1),
    ("PhysActivity", 0, 1, 1),
    ("Fruits", 0, 1, 1),
    ("Veggies", 0, 1, 1),
    ("HvyAlcoholConsump", 0, 1, 1),
    ("AnyHealthcare", 0, 1, 1),
    ("NoDocbcCost", 0, 1, 1),
    ("GenHlth", 1, 5, 1),
    ("MentHlth", 0, 30, 1),
    ("PhysHlth", 0, 30, 1),
    ("DiffWalk", 0, 1, 1),
    ("Sex", 0, 1, 1),
    ("Age", 1, 13, 1),
    ("Education", 1, 6, 1),
    ("Income", 1, 8, 1),
    ("gender", ["Male", "Female"]),
    ("age_stroke", 200, 850, 10),
    ("hypertension", 0, 1, 1),
    ("heart_disease", 0, 1, 1),
    ("ever_married", ["Yes", "No"]),
    ("work_type", ["Private", "Self-employed", "Govt_job", "children"]),
    ("Residence_type", ["Urban", "Rural"]),
    ("avg_glucose_level", 5500, 28000, 100),
    ("bmi_stroke", 150, 500, 10),
    ("smoking_status", ["formerly smoked", "never smoked", "smokes", "Unknown"]),
    ("Gender_lung", 1, 2, 1),
    ("Air_Pollution", 1, 8, 1),
    ("Alcohol_use", 1, 8, 1),
    ("Dust_Allergy", 1, 8, 1),
    ("OccuPational_Hazards", 1, 8, 1),
    ("Genetic_Risk", 1, 8, 1),
    ("chronic_Lung_Disease", 1, 7, 1),
    ("Balanced_Diet", 1, 7, 1),
    ("Obesity", 1, 7, 1),
    ("Smoking_lung", 1, 8, 1),
    ("Passive_Smoker", 1, 8, 1),
    ("Chest_Pain", 1, 9, 1),
    ("Coughing_of_Blood", 1, 9, 1),
    ("Fatigue", 1, 9, 1),
    ("Weight_Loss", 1, 8, 1),
    ("Shortness_of_Breath", 1, 9, 1),
    ("Wheezing", 1, 8, 1),
    ("Swallowing_Difficulty", 1, 8, 1),
    ("Clubbing_of_Finger_Nails", 1, 9, 1),
    ("Frequent_Cold", 1, 7, 1),
    ("Dry_Cough", 1, 7, 1),
    ("Snoring", 1, 7, 1),
)


def _field(name: str, *domain) -> str:
    if len(domain) == 1:
        return _pick(name, domain[0])
    low, high, scale = domain
    drawn = f"CAST({_draw(name, low, high)} AS DOUBLE)"
    return f"{drawn} / {scale}" if scale > 1 else drawn


def _patients(source: str, key: str) -> str:
    fields = ",\n  ".join(f'{_field(*f)} AS "{f[0]}"' for f in DOMAINS)
    return f"""patients AS (
SELECT 'PAT-' || {_pick("first", FIRST_NAMES)} || '-' || {_pick("last", LAST_NAMES)}
    || '-' || id AS patient_id,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((id % 6307200) * 5),
           '%Y-%m-%d %H:%M:%S') AS "timestamp",
  {fields}
FROM (SELECT {key} AS id FROM {source}))"""


_CUSTOMERS = _patients("customer", "c_custkey")
_GAPPY = f"""{_CUSTOMERS}, gappy AS (
SELECT * REPLACE (
  CASE WHEN BMI > 45 THEN NULL ELSE BMI END AS BMI,
  CASE WHEN avg_glucose_level > 260 THEN NULL ELSE avg_glucose_level END AS avg_glucose_level,
  CASE WHEN age_stroke < 25 THEN NULL ELSE age_stroke END AS age_stroke,
  CASE WHEN smoking_status = 'Unknown' THEN NULL ELSE smoking_status END AS smoking_status,
  CASE WHEN Snoring = 7 AND Dry_Cough = 7 THEN NULL ELSE Snoring END AS Snoring)
FROM patients)"""

ORACLE_SQL["synthetic_patients"] = f"WITH {_patients('orders', 'o_orderkey')} SELECT * FROM patients"
ORACLE_SQL["json_stream_source"] = f"WITH {_CUSTOMERS} SELECT * FROM patients"

ORACLE_SQL["quarantined_records"] = """
SELECT CASE c_custkey % 10 WHEN 1 THEN 'not JSON' WHEN 2 THEN 'not a JSON object'
         WHEN 3 THEN 'no number: BMI' ELSE 'sound' END AS kind,
  count(*) AS n_rows, count(*) AS n_told
FROM customer GROUP BY kind"""

# --- features ------------------------------------------------------------------------------------

ORACLE_SQL["numeric_label"] = (
    "SELECT doc_id, quality, CAST(quality AS DOUBLE) AS label FROM labels"
)


def _index(column: str, source: str = "orders") -> str:
    return f"""ix_{column} AS (
  SELECT {column} AS v, CAST(row_number() OVER (
    ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1 AS DOUBLE) AS i
  FROM {source} WHERE {column} IS NOT NULL GROUP BY {column})"""


ORACLE_SQL["label_dispatch"] = f"""WITH {_index("o_orderstatus")}
SELECT o_orderkey, o_orderstatus, i AS label FROM orders JOIN ix_o_orderstatus ON o_orderstatus = v"""

ORACLE_SQL["index_categories"] = f"""WITH {_index("o_orderstatus")}, {_index("o_orderpriority")}
SELECT o_orderkey, s.i AS o_orderstatus_idx, p.i AS o_orderpriority_idx
FROM orders JOIN ix_o_orderstatus s ON o_orderstatus = s.v
JOIN ix_o_orderpriority p ON o_orderpriority = p.v"""

ORACLE_SQL["index_unseen_categories"] = f"""WITH tagged AS (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN NULL
         ELSE o_orderpriority END AS priority FROM orders),
seen AS (SELECT priority FROM tagged WHERE o_orderstatus = 'F' AND priority <> '1-URGENT'),
{_index("priority", "seen")}
SELECT o_orderkey, coalesce(i, (SELECT CAST(count(*) AS DOUBLE) FROM ix_priority)) AS priority_idx
FROM tagged LEFT JOIN ix_priority ON priority = v"""

ORACLE_SQL["index_wide_category"] = f"""WITH {_index("o_custkey")}
SELECT o_orderkey, i AS o_custkey_idx FROM orders JOIN ix_o_custkey ON o_custkey = v"""

ORACLE_SQL["assembled_vectors"] = f"""WITH {DIRTY}
SELECT event_id, f0, f1, f2 FROM (
  SELECT event_id, TRY_CAST(value_raw AS DOUBLE) AS f0, CAST(user_id AS DOUBLE) AS f1,
         CAST(bucket AS DOUBLE) AS f2 FROM dirty)
WHERE f0 IS NOT NULL AND f1 IS NOT NULL AND f2 IS NOT NULL"""


def _scaled(column: str) -> str:
    return f"round(({column} - avg({column}) OVER ()) / stddev_samp({column}) OVER (), 5)"


ORACLE_SQL["scaled_features"] = f"""
SELECT l_orderkey, l_linenumber,
  {", ".join(f"{_scaled(c)} AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))},
  CAST(0 AS DOUBLE) AS constant
FROM lineitem"""

ORACLE_SQL["feature_table"] = f"""WITH {_index("o_orderstatus")}, {_index("o_orderpriority")},
joined AS (
  SELECT s.i AS label, o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey,
         p.i AS o_orderpriority_idx
  FROM orders JOIN ix_o_orderstatus s ON o_orderstatus = s.v
  JOIN ix_o_orderpriority p ON o_orderpriority = p.v)
SELECT label,
  {", ".join(f"{_scaled(c)} AS {c}" for c in ("o_totalprice", "o_custkey", "o_orderpriority_idx"))}
FROM joined"""

ORACLE_SQL["wide_feature_table"] = f"""WITH {_index("o_orderstatus")}, {_index("o_orderpriority")},
{_index("o_custkey")},
joined AS (
  SELECT s.i AS label, o_totalprice, c.i AS o_custkey_idx, p.i AS o_orderpriority_idx
  FROM orders JOIN ix_o_orderstatus s ON o_orderstatus = s.v
  JOIN ix_o_custkey c ON o_custkey = c.v
  JOIN ix_o_orderpriority p ON o_orderpriority = p.v)
SELECT label,
  {", ".join(f"{_scaled(c)} AS {c}" for c in ("o_totalprice", "o_custkey_idx", "o_orderpriority_idx"))}
FROM joined"""

ORACLE_SQL["wide_category_scores"] = """
SELECT count(*) AS n_rows, count(*) AS n_sound, count(*) AS n_reloaded, count(*) AS n_streamed FROM orders"""

# --- training and evaluation ---------------------------------------------------------------------

ORACLE_SQL["hash_split_counts"] = """
SELECT o_orderstatus,
  CAST('0x' || substr(md5('42:' || o_orderkey), 1, 8) AS UBIGINT) % 100 < 80 AS is_train,
  count(*) AS n_rows
FROM orders GROUP BY ALL"""

_JUDGED = """judged AS (
  SELECT CAST(quality AS DOUBLE) AS label, CAST(1 - toxic AS DOUBLE) AS prediction FROM labels)"""
_CONFUSED = """confused AS (
  SELECT label, prediction, count(*) AS n_rows FROM judged GROUP BY label, prediction)"""
_METRICS = """, classes AS (
  SELECT label AS class, CAST(sum(n_rows) AS DOUBLE) AS actual,
         CAST(sum(n_rows) FILTER (label = prediction) AS DOUBLE) AS hits FROM confused GROUP BY label),
taken AS (SELECT prediction AS class, CAST(sum(n_rows) AS DOUBLE) AS predicted FROM confused GROUP BY prediction),
rates AS (
  SELECT actual, coalesce(hits, 0) AS hits, coalesce(hits / predicted, 0) AS p,
         coalesce(hits / actual, 0) AS r FROM classes LEFT JOIN taken USING (class))
SELECT round(sum(hits) / sum(actual), 9) AS accuracy,
  round(sum(actual * p) / sum(actual), 9) AS "precision",
  round(sum(actual * r) / sum(actual), 9) AS recall,
  round(sum(actual * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(actual), 9) AS f1_score,
  CAST(sum(actual) AS BIGINT) AS n_rows FROM rates"""

ORACLE_SQL["confusion_counts"] = f"WITH {_JUDGED}, {_CONFUSED} SELECT * FROM confused"
ORACLE_SQL["metrics_of_labels"] = f"WITH {_JUDGED}, {_CONFUSED}{_METRICS}"
ORACLE_SQL["metrics_of_many_classes"] = f"""WITH judged AS (
  SELECT CAST(l_linenumber AS DOUBLE) AS label,
         CAST(l_linenumber % 5 + l_suppkey % 2 AS DOUBLE) AS prediction FROM lineitem),
{_CONFUSED}{_METRICS}"""



def _judged_orders(name: str, key: str) -> str:
    """One judge's line of the report; part 1 was evaluated twice and counts once."""
    return f"""(WITH judged AS (
  SELECT CAST(strpos('FOP', o_orderstatus) - 1 AS DOUBLE) AS label,
         CAST({key} % 3 AS DOUBLE) AS prediction FROM orders),
{_CONFUSED}, metrics AS ({_METRICS.removeprefix(", ").replace("classes AS", "WITH classes AS", 1)})
SELECT '{name}' AS disease, accuracy, "precision", recall, f1_score,
  CAST(46 AS BIGINT) AS train_rows, n_rows AS test_rows FROM metrics)"""


ORACLE_SQL["evaluation_by_parts"] = "\nUNION ALL\n".join(
    _judged_orders(name, key) for name, key in (("by_customer", "o_custkey"), ("by_order", "o_orderkey"))
)

ORACLE_SQL["model_round_trip"] = (
    "SELECT count(*) AS n_rows, count(*) AS n_identical FROM customer"
)

# --- scoring -------------------------------------------------------------------------------------

ORACLE_SQL["risk_bands"] = """
SELECT event_id, CASE WHEN value / 100 > 0.6 THEN 'HIGH' WHEN value / 100 > 0.3 THEN 'MEDIUM'
                      ELSE 'LOW' END AS risk FROM events"""

ORACLE_SQL["risk_from_labels"] = """
SELECT o_orderkey, CASE o_custkey % 4 WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk
FROM orders"""

ORACLE_SQL["rename_stroke"] = f"""WITH {_CUSTOMERS}
SELECT patient_id, "timestamp", age_stroke AS age, hypertension, heart_disease, avg_glucose_level,
  bmi_stroke AS bmi, gender, ever_married, work_type, Residence_type, smoking_status FROM patients"""

_LUNG_COLUMNS = """
  "Age" AS "Age",
  "Gender_lung" AS "Gender",
  "Air_Pollution" AS "Air Pollution",
  "Alcohol_use" AS "Alcohol use",
  "Dust_Allergy" AS "Dust Allergy",
  "OccuPational_Hazards" AS "OccuPational Hazards",
  "Genetic_Risk" AS "Genetic Risk",
  "chronic_Lung_Disease" AS "chronic Lung Disease",
  "Balanced_Diet" AS "Balanced Diet",
  "Obesity" AS "Obesity",
  "Smoking_lung" AS "Smoking",
  "Passive_Smoker" AS "Passive Smoker",
  "Chest_Pain" AS "Chest Pain",
  "Coughing_of_Blood" AS "Coughing of Blood",
  "Fatigue" AS "Fatigue",
  "Weight_Loss" AS "Weight Loss",
  "Shortness_of_Breath" AS "Shortness of Breath",
  "Wheezing" AS "Wheezing",
  "Swallowing_Difficulty" AS "Swallowing Difficulty",
  "Clubbing_of_Finger_Nails" AS "Clubbing of Finger Nails",
  "Frequent_Cold" AS "Frequent Cold",
  "Dry_Cough" AS "Dry Cough",
  "Snoring" AS "Snoring"
"""
ORACLE_SQL["rename_lung"] = (
    f'WITH {_CUSTOMERS} SELECT patient_id, "timestamp", {_LUNG_COLUMNS} FROM patients'
)

_LACKING = {
    "heart": {"BMI": "BMI"},
    "diabetes": {"BMI": "BMI"},
    "stroke": {"age_stroke": "age_stroke", "avg_glucose_level": "avg_glucose_level"},
    "lungcancer": {"Snoring": "Snoring"},
}


def _error(fields: dict[str, str]) -> str:
    """Fields are named in the order of the dataset's inputs."""
    names = ", ".join(f"CASE WHEN {c} IS NULL THEN '{n}' END" for n, c in fields.items())
    anyone = " OR ".join(f"{c} IS NULL" for c in fields.values())
    return f"CASE WHEN {anyone} THEN 'missing: ' || concat_ws(', ', {names}) END"


ORACLE_SQL["score_validity"] = f"WITH {_GAPPY}\n" + "\nUNION ALL\n".join(
    f"SELECT patient_id, \"timestamp\", '{name}' AS dataset, {_error(fields)} AS error FROM gappy"
    for name, fields in _LACKING.items()
)

ORACLE_SQL["zero_filled_inputs"] = f"""WITH {_CUSTOMERS}
SELECT patient_id, "timestamp", CASE WHEN age_stroke < 25 THEN 0 ELSE age_stroke END AS age,
  hypertension, heart_disease,
  CASE WHEN avg_glucose_level > 260 THEN CAST('nan' AS DOUBLE)
       ELSE avg_glucose_level END AS avg_glucose_level,  -- a null is zero, NaN stays
  bmi_stroke AS bmi, gender, ever_married, work_type, Residence_type,
  CASE WHEN smoking_status = 'Unknown' THEN NULL ELSE smoking_status END AS smoking_status
FROM patients"""

ORACLE_SQL["score_invariants"] = f"WITH {_GAPPY}\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS dataset, count(*) AS n_rows, count({_error(fields)}) AS n_errors, "
    f"count(*) - count({_error(fields)}) AS n_sound FROM gappy"
    for name, fields in _LACKING.items()
)

ORACLE_SQL["stream_matches_batch"] = """
SELECT unnest(['heart', 'diabetes', 'stroke', 'lungcancer']) AS dataset,
       count(*) AS n_rows, count(*) AS n_equal FROM customer"""

ORACLE_SQL["triggered_stream"] = ORACLE_SQL["json_stream_source"]

# --- invariants of trained forests ---------------------------------------------------------------

_TEST_ROWS = "CAST('0x' || substr(md5('42:' || o_orderkey), 1, 8) AS UBIGINT) % 100 >= 80"

ORACLE_SQL["forest_on_orders"] = f"""
SELECT count(*) FILTER (NOT {_TEST_ROWS}) AS train_rows, count(*) FILTER ({_TEST_ROWS}) AS test_rows,
  count(*) FILTER ({_TEST_ROWS}) AS n_sound, true AS metrics_agree, true AS same_when_dealt_anew
FROM orders"""

_IS_TRAIN = "CAST('0x' || substr(md5('42:' || row_key), 1, 8) AS UBIGINT) % 100 < 80"
ORACLE_SQL["trained_side_by_side"] = f"""WITH keyed AS (
  SELECT 'orders' AS disease, CAST(o_orderkey AS VARCHAR) AS row_key FROM orders
  UNION ALL SELECT 'lines', l_orderkey || '-' || l_linenumber FROM lineitem)
SELECT disease, count(*) FILTER ({_IS_TRAIN}) AS train_rows, count(*) FILTER (NOT {_IS_TRAIN}) AS test_rows,
  true AS same_when_kept, true AS same_when_loaded, true AS accuracy_counted
FROM keyed GROUP BY disease"""

ORACLE_SQL["forest_test_labels"] = f"""WITH {_index("o_orderstatus")}
SELECT i AS label, count(*) AS n_rows FROM orders JOIN ix_o_orderstatus ON o_orderstatus = v
WHERE {_TEST_ROWS} GROUP BY i"""

ORACLE_SQL["importances_on_orders"] = """
SELECT unnest(['o_custkey', 'o_orderpriority_idx', 'o_totalprice']) AS feature,
  true AS ordered, CAST(1 AS DOUBLE) AS total"""

ORACLE_SQL["schema_check"] = """
SELECT * FROM (VALUES ('o_totalprice', true, 'double', 'double'), ('o_custkey', true, 'double', 'double'),
  ('o_orderpriority', false, 'string', NULL), ('o_orderstatus', true, 'string', 'string'))
  AS t(column_name, present, expected_type, actual_type)"""

ORACLE_SQL["index_skewed_category"] = f"""WITH {_index("user_id", "events")}
SELECT event_id, i AS user_id_idx FROM events JOIN ix_user_id ON user_id = v"""
