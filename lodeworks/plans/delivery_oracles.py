"""DuckDB SQL that gives the same rows as the delivery's queries.

The delivery, the rules of standardising, the links, features and reports are
restated here on their own; nothing is taken from the operators.
"""

from __future__ import annotations

from .oracles import AGE, HISTORY, LABEL, METRIC_COLUMNS, PRIOR, STAY, _report

END = "DATE '2001-08-31'"
CUTOFF = "DATE '1999-01-01'"


def reasons(*cases: tuple[str, str]) -> str:
    """The sorted codes whose condition holds, joined."""
    listed = ", ".join(f"CASE WHEN {c} THEN '{code}' END" for c, code in cases)
    return f"array_to_string(list_sort(list_filter([{listed}], lambda x: x IS NOT NULL)), ';')"


_PID = "CASE WHEN {k} % 2 = 0 THEN 'LG-' || lpad(({k})::VARCHAR, 6, '0') ELSE 'RS' || lpad(({k})::VARCHAR, 5, '0') END"
_FIVE = "lpad(e::VARCHAR, 5, '0')"
PATIENTS = f"""
c AS (SELECT c_custkey AS k, c_custkey // 2 AS e, (c_custkey % 2 = 1 AND (c_custkey // 2) % 3 = 1) AS other FROM customer),
copies AS (SELECT *, 0 AS copy FROM c UNION ALL SELECT *, 1 FROM c WHERE k % 41 IN (17, 19)),
rp AS (
  SELECT k, e, k * 2 + copy + 2 AS rn, CASE WHEN k % 41 = 13 THEN ' LG-1 ' ELSE {_PID.format(k="k")} END AS patient_id,
         CASE WHEN k % 41 = 11 THEN 'XX' WHEN k % 2 = 0 THEN 'LG' ELSE 'RS' END AS src, other, DATE '1940-01-01' + (e % 20000 + CASE WHEN other THEN 7 ELSE 0 END)::INT AS dob,
         CASE WHEN k % 41 = 19 AND copy = 1 THEN 'Kano' ELSE 'Lagos' END AS state, CASE WHEN e % 2 = 0 THEN 'M' ELSE 'F' END AS sex
  FROM copies),
pg AS (SELECT trim(patient_id) AS pid, count(*) AS n, count(DISTINCT (k, state)) AS d, min(rn) AS f FROM rp GROUP BY 1),
cp AS (
  SELECT rp.*, CASE WHEN k % 41 = 9 THEN NULL ELSE dob END AS born, CASE WHEN k % 41 IN (7, 21) THEN '' ELSE sex END AS s_sex,
         {reasons(("n > 1 AND d > 1", "duplicate_primary_key_conflict"), ("n > 1 AND d = 1 AND rn <> f", "duplicate_record"), ("k % 41 = 11", "invalid_source_system"),
                  ("src <> 'XX' AND k % 41 = 13", "patient_id_source_mismatch"), ("k % 41 = 9", "invalid_date_of_birth"), ("k % 41 = 7", "unmapped_numeric_sex_code"), ("k % 41 = 21", "invalid_sex"))} AS reasons
  FROM rp JOIN pg ON trim(rp.patient_id) = pg.pid),
okp AS (SELECT * FROM cp WHERE reasons = '')"""

_STILL = "o % 43 IN (8, 9)"
ADMISSIONS = f"""
ra AS (
  SELECT o_orderkey AS o, o_custkey AS k, 'ADM-' || o_orderkey AS admission_id, CASE WHEN o_orderkey % 43 = 13 THEN 'nobody' ELSE {_PID.format(k="o_custkey")} END AS pid, o_orderdate::DATE AS day, o_orderstatus FROM orders),
ca AS (
  SELECT ra.*, CASE WHEN o % 43 = 5 THEN '' WHEN ra.k % 2 = 0 THEN 'Lakeside General' ELSE 'Riverside Specialist' END AS hospital,
         CASE WHEN o % 43 IN (8, 10) THEN NULL WHEN o % 43 = 11 THEN day - 3 ELSE day + (o % 10)::INT END AS gone,
         CASE WHEN o % 43 = 12 THEN '' ELSE (['I50.9', 'E11.9', 'J18', 'K35.2'])[o % 4 + 1] END AS code,
         CASE WHEN o % 43 = 14 THEN 'gone' WHEN {_STILL} THEN 'still_admitted' WHEN o_orderstatus = 'F' THEN 'home' WHEN o_orderstatus = 'O' THEN 'transferred' ELSE 'died' END AS status,
         {reasons(("okp.k IS NULL", "unknown_patient_id"), ("o % 43 = 5", "invalid_hospital"), ("o % 43 = 14", "invalid_discharge_status"), ("o % 43 = 10", "missing_discharge_date"),
                  ("o % 43 = 9", "unexpected_discharge_date_for_still_admitted"), ("o % 43 = 11", "discharge_before_admission"), ("o % 43 = 12", "invalid_diagnosis_code"))} AS reasons
  FROM ra LEFT JOIN okp ON trim(okp.patient_id) = ra.pid),
oka AS (SELECT * FROM ca WHERE reasons = '')"""

LABS = f"""
rl AS (
  SELECT DISTINCT concat_ws('-', 'LAB', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS lab_id, l_partkey AS p, l_partkey * 100 + l_suppkey % 100 + 2 AS rn, l_quantity::INT AS q, l_orderkey AS o,
         CASE WHEN l_partkey % 47 = 8 THEN 'none' ELSE 'ADM-' || l_orderkey END AS adm,
         o_orderdate::DATE + (CASE WHEN l_partkey % 47 = 3 THEN -1 WHEN l_partkey % 47 = 4 THEN 40 ELSE (l_linenumber - 1) // 3 END)::INT AS at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
lg_ AS (SELECT lab_id, count(*) AS n, min(rn) AS f FROM rl GROUP BY 1),
cl AS (
  SELECT rl.*, oka.day AS admitted, oka.gone, (['glucose', 'haemoglobin', 'creatinine'])[p % 3 + 1] AS test,
         CASE WHEN p % 47 IN (6, 7) THEN '' ELSE (['none', 'g/L_div_10', 'umol/L_div_88.4'])[p % 3 + 1] END AS conversion,
         CASE WHEN p % 47 IN (5, 6, 7) THEN NULL WHEN p % 3 = 0 THEN (q || '.' || p % 100)::DECIMAL(18, 6) WHEN p % 3 = 1 THEN ((q || '.' || p % 100)::DECIMAL(18, 6) * 0.1)::DECIMAL(18, 6)
              ELSE round((q || '.' || p % 100)::DOUBLE / 88.4, 6)::DECIMAL(18, 6) END AS v,
         {reasons(("n > 1", "duplicate_primary_key_conflict"), ("oka.o IS NULL", "unknown_admission_id"), ("p % 47 = 7", "unsupported_test_name"), ("p % 47 = 5", "invalid_result_value"),
                  ("p % 47 = 6", "unsupported_test_unit"), ("rl.at < oka.day", "result_before_admission"), ("rl.at > oka.gone", "result_after_discharge"))} AS reasons
  FROM rl JOIN lg_ USING (lab_id) LEFT JOIN oka ON oka.admission_id = rl.adm),
okl AS (SELECT * FROM cl WHERE reasons = '')"""
SILVER = f"{PATIENTS}, {ADMISSIONS}, {LABS}"

#: Linked, pending and free rows: neighbours by key that were both accepted.
LINKS = f"""{PATIENTS},
who AS (SELECT k, e, trim(patient_id) AS patient_id, src, s_sex, born, count(*) OVER (PARTITION BY e) AS both_in FROM okp),
master AS (
  SELECT *, CASE WHEN both_in = 2 AND e % 3 = 0 THEN 'AUTO_MATCHED' WHEN both_in = 2 AND e % 3 = 2 THEN 'REVIEW_PENDING' ELSE 'UNMATCHED' END AS link_status,
         CASE WHEN both_in = 2 AND e % 3 = 0 THEN 'LG-' || lpad((e * 2)::VARCHAR, 6, '0') ELSE patient_id END AS master_of FROM who)"""

_LABEL = LABEL.replace("DATE '2001-08-01'", END).replace("CASE WHEN status = 'died'", "CASE WHEN status <> 'died' AND \"left\" IS NULL THEN 'excluded_no_discharge' WHEN status = 'died'")
GOLD = f"""{LINKS}, {ADMISSIONS}, {LABS},
stays AS (
  SELECT admission_id AS stay_id, master_of AS entity, hospital AS site, day AS admitted, gone AS "left", substr(code, 1, 3) AS grp, status, pid AS local_id, s_sex AS sex, link_status,
         (year(day) - year(born) - (strftime(day, '%m%d') < strftime(born, '%m%d'))::INT)::INT AS age
  FROM oka JOIN master ON master.patient_id = oka.pid),
lab AS ({_LABEL}), hist AS ({HISTORY}),
gold AS (
  SELECT lab.*, hist.* EXCLUDE (stay_id), ("left" - admitted)::INT AS los, CASE label_status WHEN 'labeled_positive' THEN 1 WHEN 'labeled_negative' THEN 0 END AS y FROM lab JOIN hist USING (stay_id)),
elig AS (SELECT stay_id AS admission_id, site AS hospital, sex, age AS age_at_admit, grp AS diagnosis_group, status AS discharge_status, prior_completed_admission_count AS prior, los, "left" AS discharge_date, y, entity FROM gold WHERE y IS NOT NULL)"""
_DIMS = {"hospital": "hospital", "sex": "sex", "age_band": AGE.format(c="age_at_admit"), "diagnosis_group": "diagnosis_group", "discharge_status": "discharge_status", "prior_completed_admission_band": PRIOR.format(c="prior"),
         "length_of_stay_band": STAY.format(c="los"), "discharge_year": "strftime(discharge_date, '%Y')", "discharge_month": "strftime(discharge_date, '%Y-%m')"}
_GROUPS = " UNION ALL ".join(f"SELECT '{d}' AS dimension, ({c})::VARCHAR AS category, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM elig GROUP BY 2" for d, c in _DIMS.items())
REPORT = f"WITH {GOLD}, {_report(_GROUPS, 11)}"
_NUMERIC = {"age_at_admit": "age", "length_of_stay_days": "los", "prior_completed_admission_count": "prior_completed_admission_count", "prior_admission_30d_count": "prior_admission_30d_count",
            "prior_admission_365d_count": "prior_admission_365d_count", "prior_same_diagnosis_group_count": "prior_same_diagnosis_group_count", "prior_distinct_hospital_count": "prior_distinct_hospital_count",
            "days_since_prior_discharge": "days_since_prior_discharge"}
_CATEGORICAL = {"hospital": "site", "sex": "sex", "diagnosis_group": "grp", "discharge_status": "status"}
_GAP = "days_since_prior_discharge"
COHORT = f"""{GOLD},
cohort AS (SELECT * FROM gold WHERE y IS NOT NULL AND link_status <> 'REVIEW_PENDING' AND "left" + 30 <= {END}),
train AS (SELECT * FROM cohort WHERE "left" + 30 < {CUTOFF}),
test AS (SELECT * FROM cohort WHERE admitted >= {CUTOFF} AND entity NOT IN (SELECT entity FROM train)),
med AS (SELECT {", ".join(f"coalesce(quantile_cont({c}, 0.5), 0)::DOUBLE AS {n}" for n, c in _NUMERIC.items())} FROM train)"""


def _filled(table: str) -> str:
    numbers = ", ".join(f"coalesce(t.{c}, med.{n})::DOUBLE AS {n}" for n, c in _NUMERIC.items())
    return f'SELECT t.stay_id, {numbers}, (t.{_GAP} IS NULL)::INT::DOUBLE AS "{_GAP}?" FROM {table} t, med'


_SCALED = [*_NUMERIC, f"{_GAP}?"]
_WIDTH = " + ".join(f"(SELECT count(*) FILTER (WHERE n >= 11) + (count(*) FILTER (WHERE n < 11) > 0)::INT FROM (SELECT {c}, count(*) AS n FROM train GROUP BY 1))" for c in _CATEGORICAL.values())


def outcomes(passes: str, aborts: str = "") -> str:
    """The cases that pass and those that abort, separated by bars."""
    rows = [(c, "passes") for c in passes.split("|")] + [(c, "aborts") for c in aborts.split("|") if c]
    return "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{o}')" for c, o in rows) + ") t(case_name, outcome)"


def _reason_rows(table: str, name: str) -> str:
    return f"""
SELECT '{name}' AS table_name, t.source, t.accepted, t.source - t.accepted AS quarantined, coalesce(r.reason, '') AS reason, coalesce(r.rows, 0) AS rows
FROM (SELECT count(*) AS source, count(*) FILTER (WHERE reasons = '') AS accepted FROM {table}) t
LEFT JOIN (SELECT reason, count(*) AS rows FROM (SELECT unnest(string_split(reasons, ';')) AS reason FROM {table} WHERE reasons <> '') GROUP BY 1) r ON true"""


def _lab_columns() -> str:
    out = []
    for t in ("glucose", "haemoglobin", "creatinine"):
        out += [f"coalesce(count(v) FILTER (WHERE test = '{t}'), 0)::INT AS {t}_count"] + [f"round({f}(v) FILTER (WHERE test = '{t}'), 3)::DOUBLE AS {t}_{f}" for f in ("min", "max")]
    return ", ".join(out)


_LAB_NAMES = ", ".join((f"coalesce({t}_count, 0)::INT AS {t}_count, {t}_min, {t}_max") for t in ("glucose", "haemoglobin", "creatinine"))
_MOVED = "(SELECT count(*) FROM master WHERE link_status = '{s}')"
_ORDER = "list_position([" + ", ".join(f"'{d}'" for d in _DIMS) + "], dimension), category"
_CSV = """
f AS (SELECT c_custkey AS k, c_name, c_mktsegment, c_nationkey, row_number() OVER (ORDER BY c_custkey) + 1 AS rn FROM customer),
g AS (SELECT *, CASE WHEN k % 11 = 0 THEN 'too_many_fields' WHEN k % 13 = 0 THEN 'too_few_fields' ELSE '' END AS reason FROM f)"""

ORACLES = {
    "silver_patients": f"WITH {PATIENTS} SELECT patient_id, rn AS row_number, born::VARCHAR AS born, s_sex AS sex, reasons FROM cp",
    "silver_admissions": f"""WITH {PATIENTS}, {ADMISSIONS}
SELECT admission_id, hospital, day::VARCHAR AS admitted, gone::VARCHAR AS left_on, code, status AS s_discharge_status, reasons FROM ca""",
    "silver_labs": f"WITH {SILVER} SELECT lab_id, rn AS row_number, v::DOUBLE AS value, conversion, reasons FROM cl",
    "silver_transformations": f"""WITH {SILVER}, t AS (
SELECT 'patients' AS table_name, 'date_of_birth_slash_to_iso' AS counter, count(*) FILTER (WHERE k % 41 = 15) AS rows FROM okp
UNION ALL SELECT 'patients', 'sex_' || s, count(s_sex) FROM (VALUES ('F'), ('M')) x(s) LEFT JOIN okp ON s_sex = s GROUP BY s
UNION ALL SELECT 'admissions', 'admit_date_slash_to_iso', count(*) FILTER (WHERE o % 43 = 6) FROM oka
UNION ALL SELECT 'admissions', 'diagnosis_code_reformatted', count(*) FILTER (WHERE o % 4 IN (1, 3)) FROM oka
UNION ALL SELECT 'lab_results', conversion, count(*) FROM okl GROUP BY 2)
SELECT * FROM t""",
    "silver_reconciliation": f"""WITH {SILVER}, t AS (SELECT 'patients' AS table_name, reasons FROM cp UNION ALL SELECT 'admissions', reasons FROM ca UNION ALL SELECT 'lab_results', reasons FROM cl)
SELECT table_name, count(*) AS source_rows, count(*) FILTER (WHERE reasons = '') AS accepted_rows, count(*) FILTER (WHERE reasons <> '') AS quarantined_rows FROM t GROUP BY 1""",
    "data_quality": f"WITH {SILVER} {' UNION ALL '.join(_reason_rows(t, n) for t, n in (('cp', 'patients'), ('ca', 'admissions'), ('cl', 'lab_results')))}",
    "identity_links": f"WITH {LINKS} SELECT patient_id, link_status, master_of, count(*) OVER (PARTITION BY master_of) AS members FROM master",
    "identity_counters": f"""WITH {LINKS}, n AS (
SELECT count(*) AS rows, count(DISTINCT master_of) AS masters, count(*) FILTER (WHERE link_status = 'AUTO_MATCHED') AS linked, count(*) FILTER (WHERE link_status = 'REVIEW_PENDING') AS pending,
       count(*) FILTER (WHERE src = 'LG') AS lg FROM master),
t AS (SELECT unnest([
  {{'counter': 'input_patients', 'rows': rows}}, {{'counter': 'candidate_pairs_generated', 'rows': (linked + pending) // 2}}, {{'counter': 'auto_matches', 'rows': linked // 2}},
  {{'counter': 'human_accepted_matches', 'rows': 0}}, {{'counter': 'review_candidates', 'rows': pending // 2}}, {{'counter': 'master_patient_rows', 'rows': rows}}, {{'counter': 'unique_master_patients', 'rows': masters}},
  {{'counter': 'linked_source_rows', 'rows': linked}}, {{'counter': 'review_pending_source_rows', 'rows': pending}}, {{'counter': 'pending_masters', 'rows': pending}}, {{'counter': 'unlinked_source_rows', 'rows': rows - linked}},
  {{'counter': 'low_confidence_pairs_not_queued', 'rows': 0}}, {{'counter': 'source_counts.LG', 'rows': lg}}, {{'counter': 'source_counts.RS', 'rows': rows - lg}}, {{'counter': 'review_status_counts.PENDING', 'rows': pending // 2}},
  {{'counter': 'auto_rule_counts.UNIQUE_PHONE_DOB_LAST', 'rows': linked // 2}}, {{'counter': 'review_rule_counts.NEAR_PHONE_WITH_CORROBORATION', 'rows': pending // 2}}, {{'counter': 'one_to_one_constraint_passed', 'rows': 1}}]) AS x FROM n)
SELECT x.counter AS counter, x.rows::BIGINT AS rows FROM t""",
    "identity_workload": f"""WITH {LINKS}
SELECT counter, rows FROM (SELECT {_MOVED.format(s="AUTO_MATCHED")} // 2 AS a, {_MOVED.format(s="REVIEW_PENDING")} // 2 AS r) n, LATERAL (VALUES
  ('automatic_matches', a), ('sent_for_human_review', r), ('accepted', 0), ('rejected', 0), ('abstained', 0), ('pending', r)) t(counter, rows)""",
    "review_checks": outcomes("good|no decisions", "unknown case|case twice|unknown decision|no reviewer|no offset|other columns"),
    "review_effects": f"""WITH {LINKS}, t AS (
SELECT *, CASE WHEN link_status <> 'REVIEW_PENDING' THEN link_status WHEN (e * 2) % 8 < 4 THEN 'HUMAN_MATCHED' WHEN (e * 2) % 8 < 6 THEN 'REVIEW_REJECTED' ELSE 'REVIEW_PENDING' END AS s FROM master)
SELECT s AS link_status, count(*) AS rows, count(DISTINCT CASE WHEN s = 'HUMAN_MATCHED' THEN e::VARCHAR ELSE master_of END) AS masters FROM t GROUP BY 1""",
    "delivery_features": f"""WITH {GOLD}, labs AS (SELECT adm, {_lab_columns()} FROM okl GROUP BY 1)
SELECT stay_id AS admission_id, site AS hospital, admitted::VARCHAR AS admitted, "left"::VARCHAR AS left_on, age AS age_at_admit, sex, grp AS diagnosis_group, status AS discharge_status, los AS length_of_stay_days,
       prior_completed_admission_count, prior_admission_30d_count, prior_admission_365d_count, prior_same_diagnosis_group_count, prior_distinct_hospital_count, days_since_prior_discharge,
       {_LAB_NAMES}, y AS readmitted_30d, label_status FROM gold LEFT JOIN labs ON adm = stay_id""",
    "gold_guards": outcomes("as built", "empty|repeated ids|mixed ends|mixed rules|a broken row"),
    "future_evidence_guard": f"""WITH {PATIENTS}, {ADMISSIONS}
SELECT case_name, CASE WHEN max(day) > upto THEN 'aborts' ELSE 'passes' END AS outcome
FROM oka, (VALUES ('observed whole', DATE '2001-08-31'), ('observed in part', DATE '2001-07-01'), ('observed before', DATE '1994-01-01')) t(case_name, upto) GROUP BY case_name, upto""",
    "cohort_threshold": f"""WITH {GOLD}, n AS (SELECT least(count(DISTINCT entity), count(*), count(*) FILTER (WHERE y = 1), count(*) FILTER (WHERE y = 0)) AS n FROM elig)
SELECT 'at least ' || k AS case_name, CASE WHEN n >= k THEN 'passes' ELSE 'aborts' END AS outcome FROM n, (VALUES (1), (11), (100), (1000), (10000), (100000), (1000000000)) t(k)""",
    "matching_reconciled": f"""WITH {GOLD}, f AS (
SELECT g.*, EXISTS (SELECT 1 FROM stays o WHERE o.local_id = g.local_id AND o.stay_id <> g.stay_id AND o.admitted >= g."left" AND o.admitted <= g."left" + 30 AND o.admitted <= {END}) AS seen FROM gold g WHERE y IS NOT NULL),
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE seen) AS b, count(*) FILTER (WHERE y = 1) AS a FROM f)
SELECT n AS eligible_admissions, b AS before_readmitted, round(100.0 * b / n, 2)::DOUBLE AS before_rate_pct, a AS after_readmitted, round(100.0 * a / n, 2)::DOUBLE AS after_rate_pct, a - b AS hidden_readmissions,
       (round(100.0 * a / n, 2)::DECIMAL(9, 2) - round(100.0 * b / n, 2)::DECIMAL(9, 2))::DOUBLE AS percentage_point_change FROM n""",
    "matching_guards": outcomes("as built", "stay missing|dates differ|ids repeat"),
    "learning_cohort": f"WITH {COHORT} SELECT site AS hospital, y AS outcome, count(*) AS rows FROM cohort GROUP BY 1, 2",
    "learning_guards": outcomes("as built|lineage|finite|balanced", "unknown master|repeated master rows|other features|other masters|other counts|other identities|not finite|infinite|negative|missing|unbalanced"),
    "preprocess_fit": f"""WITH {COHORT}, filled AS ({_filled("train")}), t AS (
SELECT 'median' AS kind, name, value FROM (UNPIVOT med ON {", ".join(_NUMERIC)} INTO NAME name VALUE value)
UNION ALL SELECT 'indicator', '{_GAP}', 1.0 FROM train HAVING count(*) > count({_GAP})
{" ".join(f'''UNION ALL SELECT 'mean', '{c}', round(avg("{c}"), 6) FROM filled UNION ALL SELECT 'deviation', '{c}', round(stddev_pop("{c}"), 6) FROM filled''' for c in _SCALED)}
{" ".join(f"UNION ALL SELECT 'category', '{n}=' || {c}, 1.0 FROM train GROUP BY {c} HAVING count(*) >= 11" for n, c in _CATEGORICAL.items())})
SELECT kind, name, value::DOUBLE AS value FROM t""",
    "feature_matrix": f"""WITH {COHORT}, a AS ({_filled("train")}), b AS ({_filled("test")}),
s AS (SELECT {", ".join(f'avg("{c}") AS m{i}, stddev_pop("{c}") AS d{i}' for i, c in enumerate(_SCALED))} FROM a)
SELECT stay_id AS admission_id, (9 + {_WIDTH})::INT AS features, {", ".join(f'round(("{c}" - m{i}) / CASE WHEN d{i} = 0 THEN 1.0 ELSE d{i} END, 4) AS x{i}' for i, c in enumerate(_SCALED))} FROM b, s""",
    "prevalence_baseline": f"""WITH {COHORT}, b AS (SELECT avg(y)::DOUBLE AS p FROM train)
SELECT round(any_value(p), 6) AS prevalence, 0.5::DOUBLE AS roc_auc, round(avg((p - y) * (p - y)), 6) AS brier_score, round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS log_loss, 0.5::DOUBLE AS balanced_accuracy, true AS confusion_suppressed FROM test, b""",
    "release_gate": "SELECT * FROM (VALUES " + ", ".join(f"('{c}', 'PASS')" for c in (
        "phase_evidence_files", "phase_evidence_index", "package_version", "sensitive_output_ignore_rules", "gold_hash_lineage", "analytics_output_hashes", "gold_row_uniqueness", "gold_label_audit_reconciliation",
        "gold_analytics_reconciliation", "breakdown_csv_json_reconciliation", "suppression_integrity", "identifier_exclusion", "rule_version_chain")) + ') t("check", status)',
    "publication_guards": outcomes("as built", "a check missing|a check failed|another report|another report, hashed|a broken contract|small cells|other counts|no evidence"),
    "breakdowns_republished": f"{REPORT} SELECT row_number() OVER (ORDER BY {_ORDER})::INT AS place, dimension, category, {', '.join(METRIC_COLUMNS)}, suppression_reason FROM report",
    "snapshot_guards": outcomes("pinned", "another hash|no hash|other rows|changed content|shown cells, pinned|too large|published twice"),
    "bundle_guards": outcomes("as exported", "another field|stale, told as fresh|cell twice|rate moved|interval moved|sum moved|malformed hash|run after publication|published ahead of now"),
    "run_integrity": outcomes("as written", "a table changed|the delivery changed|a table too many"),
    "pipeline_status": f"""{REPORT} SELECT 'FRESH' AS freshness, false AS published, stage, rows FROM (
SELECT 'analytics/breakdowns' AS stage, count(*) AS rows FROM report UNION ALL SELECT 'gold/features', count(*) FROM gold UNION ALL SELECT 'identity/master', count(*) FROM master)""",
    "evidence_projection": f"""WITH {GOLD} SELECT path, value FROM (
SELECT 'identity.input_patients' AS path, count(*) AS value FROM master UNION ALL SELECT 'identity.auto_matches', {_MOVED.format(s="AUTO_MATCHED")} // 2 UNION ALL SELECT 'identity.source_counts.LG', count(*) FROM master WHERE src = 'LG'
UNION ALL SELECT 'gold.gold_rows', count(*) FROM gold UNION ALL SELECT 'gold.label_counts.positive', count(*) FROM gold WHERE y = 1)""",
    "ordered_outputs": f"""WITH {GOLD} SELECT 'features' AS table_name, stay_id AS id, row_number() OVER (ORDER BY admitted, stay_id) AS place FROM gold
UNION ALL SELECT 'master', patient_id, row_number() OVER (ORDER BY src, patient_id) FROM master""",
    "csv_ingest": f"""WITH {_CSV}
SELECT k::VARCHAR AS custkey, c_name || CASE WHEN k % 5 = 0 THEN '; "so' || chr(10) || 'called" ' || k ELSE '' END AS name, CASE WHEN k % 7 <> 0 THEN c_mktsegment ELSE '' END AS segment,
       CASE WHEN reason = 'too_few_fields' THEN '' ELSE c_nationkey::VARCHAR END AS nation, rn AS row_number, 'Source A' AS source, 'r1' AS run_id, reason FROM g""",
    "csv_ingest_record": f"""WITH {_CSV}
SELECT count(*) FILTER (WHERE reason = '') AS accepted_rows, count(*) FILTER (WHERE reason <> '') AS quarantined_rows, 4 AS columns, 2 AS sensitive,
       sha256('["c_custkey","Patient ID","phone","nation"]') AS schema_sha256, true AS same_file, 'source_a' AS slug, '2024-01-20T00:00:00Z' AS at FROM g""",
    "csv_profile": """WITH d AS (SELECT c_custkey % 500 AS c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'x' END AS c_name, c_mktsegment, c_nationkey FROM customer),
n AS (SELECT count(*) AS total, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS copies FROM d),
c AS (SELECT 'c_custkey' AS name, 0 AS missing, count(DISTINCT c_custkey) AS v FROM d UNION ALL SELECT 'c_name', count(*) FILTER (WHERE c_name = ''), count(DISTINCT c_name) FILTER (WHERE c_name <> '') FROM d
      UNION ALL SELECT 'c_mktsegment', 0, count(DISTINCT c_mktsegment) FROM d UNION ALL SELECT 'c_nationkey', 0, count(DISTINCT c_nationkey) FROM d)
SELECT total AS row_count, 0 AS malformed, copies AS duplicates, name, missing, v AS distinct_values FROM c, n""",
    "header_rules": outcomes("plain|space", "empty|blank|twice|reserved|quarantine"),
    "contract_scan": """SELECT o_orderkey::VARCHAR AS o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'a "b", c' || chr(10) || o_orderkey ELSE ' x ' END AS note, o_orderpriority FROM orders""",
    "contract_guards": outcomes("plain|quoted header|no rows", "other order|another column|short row|nothing|no rows, some needed"),
    "json_object_scan": "SELECT c_nationkey::VARCHAR AS nation, count(*) AS customers, true AS tidy FROM customer GROUP BY 1",
    "output_guards": outcomes("new|existing, meant|planned|name|digest|uuid|commit|host|slug",
                              "existing|planned, existing|planned over input|odd name|JSON list|broken JSON|short digest|odd commit|odd host|empty slug"),
}
