"""DuckDB SQL that gives the same rows as the registered queries."""

_STAYS = """
SELECT o_orderkey AS stay_id, {entity}::BIGINT AS entity, o_orderpriority AS site, o_orderdate::DATE AS admitted, (o_orderdate::DATE + (o_orderkey % 10)::INT) AS "left",
       'G' || lpad((o_orderkey % 23)::VARCHAR, 2, '0') AS grp, CASE o_orderstatus WHEN 'F' THEN 'home' WHEN 'O' THEN 'transferred' ELSE 'died' END AS status, o_custkey AS local_id
FROM orders"""
PAIR_STAYS = _STAYS.format(entity="floor(o_custkey / 2)")
LOCAL_STAYS = _STAYS.format(entity="o_custkey")

#: Labels by plain self-join.
LABEL = """
SELECT s.*, CASE WHEN status = 'died' THEN 'excluded_died' WHEN EXISTS (SELECT 1 FROM stays o WHERE o.entity = s.entity AND o.stay_id <> s.stay_id
         AND o.admitted >= s."left" AND o.admitted <= s."left" + 30 AND o.admitted <= DATE '2001-08-01') THEN 'labeled_positive'
       WHEN s."left" + 30 <= DATE '2001-08-01' THEN 'labeled_negative' ELSE 'censored_incomplete_30d_followup' END AS label_status
FROM stays s"""
HISTORY = """
SELECT s.stay_id, count(o.stay_id)::INT AS prior_completed_admission_count, count(*) FILTER (WHERE s.admitted - o."left" <= 30)::INT AS prior_admission_30d_count,
       count(*) FILTER (WHERE s.admitted - o."left" <= 365)::INT AS prior_admission_365d_count, count(*) FILTER (WHERE o.grp = s.grp)::INT AS prior_same_diagnosis_group_count,
       count(DISTINCT o.site)::INT AS prior_distinct_hospital_count, min(s.admitted - o."left")::INT AS days_since_prior_discharge
FROM stays s LEFT JOIN stays o ON o.entity = s.entity AND o.stay_id <> s.stay_id AND o."left" <= s.admitted GROUP BY s.stay_id"""
COHORT = f"""
stays AS ({PAIR_STAYS}), lab AS ({LABEL}), hist AS ({HISTORY}),
cohort AS (
  SELECT lab.stay_id AS admission_id, entity AS master_patient_id, site AS hospital, CASE WHEN local_id % 2 = 0 THEN 'M' ELSE 'F' END AS sex, (local_id % 100)::INT AS age_at_admit, grp AS diagnosis_group,
         status AS discharge_status, prior_completed_admission_count AS prior, "left" - admitted AS los, admitted AS admit_date, "left" AS discharge_date, label_status, local_id,
         CASE label_status WHEN 'labeled_positive' THEN 1 WHEN 'labeled_negative' THEN 0 END AS y
  FROM lab JOIN hist USING (stay_id)),
elig AS (SELECT * FROM cohort WHERE y IS NOT NULL)"""
AGE = "CASE WHEN {c} <= 17 THEN '00-17' WHEN {c} <= 34 THEN '18-34' WHEN {c} <= 49 THEN '35-49' WHEN {c} <= 64 THEN '50-64' WHEN {c} <= 79 THEN '65-79' ELSE '80+' END"
STAY = "CASE WHEN {c} <= 0 THEN '0' WHEN {c} <= 3 THEN '1-3' WHEN {c} <= 7 THEN '4-7' WHEN {c} <= 14 THEN '8-14' ELSE '15+' END"
PRIOR = "CASE WHEN {c} <= 0 THEN '0' WHEN {c} <= 1 THEN '1' ELSE '2+' END"
_WILSON = "round(100 * (((p * 1.0 / (p + n)) + {z2} / 2 / (p + n)::DOUBLE) / (1 + {z2} / (p + n)::DOUBLE) {sign} 1.96::DOUBLE * sqrt((p / (p + n)::DOUBLE) * (1 - p / (p + n)::DOUBLE) / (p + n) + {z2} / 4 / ((p + n)::DOUBLE * (p + n))) / (1 + {z2} / (p + n)::DOUBLE)), 2)"
LOW = _WILSON.format(z2="3.8416::DOUBLE", sign="-").replace("(p * 1.0 / (p + n))", "(p / (p + n)::DOUBLE)")
HIGH = _WILSON.format(z2="3.8416::DOUBLE", sign="+").replace("(p * 1.0 / (p + n))", "(p / (p + n)::DOUBLE)")
METRIC_COLUMNS = {"eligible_admissions": "p + n", "readmitted_admissions": "p", "not_readmitted_admissions": "n", "readmission_rate_pct": "round(100.0::DOUBLE * p / (p + n), 2)", "wilson_95_lower_pct": LOW, "wilson_95_upper_pct": HIGH}
METRICS = ", ".join(f"{c} AS {n}" for n, c in METRIC_COLUMNS.items())
SHOWN = ", ".join(f"CASE WHEN suppression_reason = '' THEN {c} END AS {n}" for n, c in METRIC_COLUMNS.items())


def _report(source: str, least: int) -> str:
    """Suppression over a CTE of (dimension, category, p, n)."""
    return f"""
flagged AS (SELECT *, (p < {least} OR n < {least}) AS small FROM ({source})),
counted AS (SELECT *, sum(small::INT) OVER (PARTITION BY dimension) AS smalls, row_number() OVER (PARTITION BY dimension, small ORDER BY p + n, p, category) AS k FROM flagged),
reasoned AS (SELECT *, CASE WHEN small THEN 'primary_small_cell' WHEN smalls = 1 AND k = 1 THEN 'complementary_suppression' ELSE '' END AS suppression_reason FROM counted),
report AS (SELECT dimension, category, {SHOWN}, suppression_reason FROM reasoned)"""


_DIMS = {"hospital": "hospital", "sex": "sex", "age_band": AGE.format(c="age_at_admit"), "diagnosis_group": "diagnosis_group", "discharge_status": "discharge_status",
         "prior_completed_admission_band": PRIOR.format(c="prior"), "length_of_stay_band": STAY.format(c="los"), "discharge_year": "strftime(discharge_date, '%Y')", "discharge_month": "strftime(discharge_date, '%Y-%m')"}
_GROUPS = " UNION ALL ".join(f"SELECT '{d}' AS dimension, ({c})::VARCHAR AS category, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM elig GROUP BY 2" for d, c in _DIMS.items())
REPORT = f"WITH {COHORT}, {_report(_GROUPS, 11)}"
_LINES = """
WITH l AS (
  SELECT i.*, o.o_orderkey IS NOT NULL AS known, o.o_orderdate::DATE AS admit FROM lineitem i LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 13 <> 0) o ON l_orderkey = o_orderkey),
r AS (
  SELECT list_sort(list_filter([CASE WHEN NOT known THEN 'unknown_admission_id' END, CASE WHEN l_shipdate::DATE < admit THEN 'result_before_admission' END,
         CASE WHEN l_shipdate::DATE > admit + 90 THEN 'result_after_discharge' END, CASE WHEN l_quantity > 45 THEN 'invalid_result_value' END], lambda x: x IS NOT NULL)) AS reasons FROM l)"""
_NORM = "CASE WHEN length(d) = 11 AND d[1] = '0' THEN substr(d, 2) WHEN length(d) = 13 AND d[1:3] = '234' THEN substr(d, 4) ELSE d END"
_SIDE = """
SELECT '{s}-' || {k} AS id, '{s}' AS src, 'ann' || ({k} % 12) AS first, 'fam' || ({k} * {m} % 9) AS last, DATE '1960-01-01' + ({k} * 37 % 700)::INT AS dob, CASE WHEN {k} % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
       CASE WHEN {k} % 11 = 0 THEN '' ELSE '80' || lpad(({k} * {f})::VARCHAR, 8, '0') END AS phone, {p}_nationkey::VARCHAR AS state, {k} AS num FROM {t}"""
PEOPLE = f"""
lg AS ({_SIDE.format(s="LG", k="c_custkey", m=1, f=3, p="c", t="customer")}), rs AS ({_SIDE.format(s="RS", k="s_suppkey", m=4, f=30, p="s", t="supplier")}),
near AS (
  SELECT DISTINCT l.id AS l, r.id AS r FROM (SELECT id, length(phone) AS n, i, substr(phone, 1, i - 1) || substr(phone, i + 1) AS rest FROM lg, generate_series(1, 10) t(i) WHERE phone <> '') l
  JOIN (SELECT id, length(phone) AS n, i, substr(phone, 1, i - 1) || substr(phone, i + 1) AS rest FROM rs, generate_series(1, 10) t(i) WHERE phone <> '') r USING (n, i, rest)),
cand AS (
  SELECT l.id AS l, r.id AS r FROM lg l JOIN rs r ON l.phone = r.phone AND l.phone <> ''
  UNION SELECT l.id, r.id FROM lg l JOIN rs r ON l.dob = r.dob AND l.sex = r.sex AND l.state = r.state
  UNION SELECT l.id, r.id FROM lg l JOIN rs r ON l.first = r.first AND l.last = r.last AND l.sex = r.sex AND l.state = r.state
  UNION SELECT l, r FROM near),
lc AS (SELECT phone, count(*) AS n FROM lg WHERE phone <> '' GROUP BY 1), rc AS (SELECT phone, count(*) AS n FROM rs WHERE phone <> '' GROUP BY 1),
facts AS (
  SELECT c.l, c.r, lg.num AS num, lg.phone = rs.phone AND lg.phone <> '' AS px, length(lg.phone) = length(rs.phone) AND lg.phone <> '' AND levenshtein(lg.phone, rs.phone) = 1 AS pn, lg.dob = rs.dob AS dx,
         year(lg.dob) = year(rs.dob) AS yx, strftime(lg.dob, '%m%d') = strftime(rs.dob, '%m%d') AS mx, lg.first = rs.first AS fx, levenshtein(lg.first, rs.first) = 1 AS fn,
         lg.last = rs.last AS lx, levenshtein(lg.last, rs.last) = 1 AS ln, lg.sex = rs.sex AS sx, lg.state = rs.state AS tx,
         lg.phone = rs.phone AND lg.phone <> '' AND lc.n = 1 AND rc.n = 1 AS ux
  FROM cand c JOIN lg ON lg.id = c.l JOIN rs ON rs.id = c.r LEFT JOIN lc ON lc.phone = lg.phone LEFT JOIN rc ON rc.phone = rs.phone),
facts2 AS (SELECT * REPLACE (coalesce(ux, false) AS ux) FROM facts),
scored AS (
  SELECT *, ux AND sx AND tx AND lx AND (dx OR fx) AS auto,
    sx AND tx AND ((pn AND (dx OR (fx AND lx))) OR (dx AND ((fx AND (lx OR ln)) OR (lx AND (fx OR fn)))) OR (fx AND lx AND NOT dx AND (yx OR mx)) OR (px AND NOT ux AND (dx OR lx))) AS review FROM facts2)"""
_EVIDENCE = [("px", "PHONE_EXACT", 50), ("pn", "PHONE_EDIT_DISTANCE_1", 30), ("dx", "DOB_EXACT", 25), ("NOT dx AND yx", "BIRTH_YEAR_EXACT", 8), ("NOT dx AND mx", "BIRTH_MONTH_DAY_EXACT", 8), ("fx", "FIRST_NAME_EXACT", 10),
             ("fn", "FIRST_NAME_EDIT_DISTANCE_1", 5), ("lx", "LAST_NAME_EXACT", 15), ("ln", "LAST_NAME_EDIT_DISTANCE_1", 7), ("sx", "SEX_EXACT", 5), ("tx", "STATE_EXACT", 5), ("ux", "PHONE_UNIQUE_BOTH_SOURCES", 5)]
_CONFLICT = [("NOT px", "PHONE_DIFFERS"), ("NOT dx", "DOB_DIFFERS"), ("NOT fx", "FIRST_NAME_DIFFERS"), ("NOT lx", "LAST_NAME_DIFFERS"), ("NOT sx", "SEX_DIFFERS"), ("NOT tx", "STATE_DIFFERS"), ("px AND NOT ux", "PHONE_NOT_UNIQUE")]
_LIST = lambda pairs: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{k}' END" for c, k in pairs) + "], lambda x: x IS NOT NULL), ';')"
_RULE = "CASE WHEN auto AND dx THEN 'UNIQUE_PHONE_DOB_LAST' WHEN auto THEN 'UNIQUE_PHONE_FULL_NAME' WHEN pn THEN 'NEAR_PHONE_WITH_CORROBORATION' WHEN dx THEN 'EXACT_DOB_WITH_NEAR_NAME' WHEN fx AND lx THEN 'EXACT_FULL_NAME_WITH_BIRTH_COMPONENT' ELSE 'NON_UNIQUE_PHONE_WITH_CORROBORATION' END"
_LINKED = """
autos AS (SELECT l, r FROM scored WHERE auto QUALIFY count(*) OVER (PARTITION BY l) = 1 AND count(*) OVER (PARTITION BY r) = 1),
ends AS (SELECT l AS id FROM autos UNION ALL SELECT r FROM autos),
queue AS (SELECT * FROM scored WHERE (auto OR review) AND l NOT IN (SELECT id FROM ends) AND r NOT IN (SELECT id FROM ends)),
ruled AS (
  SELECT l, r, CASE WHEN {rule} THEN 'ACCEPT' WHEN {reject} THEN 'REJECT' WHEN {abstain} THEN 'ABSTAIN' END AS decision
  FROM (SELECT *, count(*) OVER (PARTITION BY l) = 1 AND count(*) OVER (PARTITION BY r) = 1 AS alone FROM queue)),
links AS (SELECT l, r, 'AUTO_MATCHED' AS st FROM autos UNION ALL SELECT l, r, 'HUMAN_MATCHED' FROM ruled WHERE decision = 'ACCEPT'),
level AS (SELECT id, max(v) AS v FROM (SELECT unnest([l, r]) AS id, CASE WHEN decision = 'REJECT' THEN 1 ELSE 2 END AS v FROM ruled WHERE decision IS DISTINCT FROM 'ACCEPT') GROUP BY id),
everyone AS (SELECT id FROM lg UNION ALL SELECT id FROM rs),
master AS (
  SELECT e.id, coalesce(k.st, CASE v WHEN 2 THEN 'REVIEW_PENDING' WHEN 1 THEN 'REVIEW_REJECTED' ELSE 'UNMATCHED' END) AS link_status, coalesce(k.l, e.id) AS m
  FROM everyone e LEFT JOIN links k ON e.id = k.l OR e.id = k.r LEFT JOIN level ON level.id = e.id)
SELECT link_status, count(*) AS rows, count(DISTINCT m) AS masters FROM master GROUP BY 1"""


def _hmac(message: str) -> str:
    """HMAC-SHA-256 of the test key from plain hashes, as upper-case hex."""
    key = b"0123456789abcdef0123456789abcdef".ljust(64, b"\0")
    pad = lambda x: "from_hex('" + bytes(b ^ x for b in key).hex() + "')"
    return f"upper(sha256({pad(0x5C)} || from_hex(sha256({pad(0x36)} || encode({message})))))"


ORACLES: dict[str, str] = {
    "profile_columns": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER (WHERE trim(coalesce({c}::VARCHAR, '')) = '') AS missing_count, count(DISTINCT {c}) FILTER (WHERE trim({c}::VARCHAR) <> '') AS non_missing_distinct_count FROM customer"
        for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
    "exact_duplicate_rows": "SELECT sum(n)::BIGINT AS row_count, sum(n - 1)::BIGINT AS exact_duplicate_row_count FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)",
    "date_parse_reasons": """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1, 4) THEN strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
       CASE o_orderkey % 6 WHEN 2 THEN 'missing_order_date' WHEN 3 THEN 'invalid_order_date' WHEN 5 THEN 'invalid_order_date' ELSE '' END AS reason FROM orders""",
    "timestamp_normalise": """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN strftime(date_trunc('minute', ts) - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') WHEN 2 THEN strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M:%S') END AS at_utc,
       CASE WHEN event_id % 4 = 3 THEN 'invalid_ts' ELSE '' END AS reason FROM events""",
    "code_normalise": """
WITH r AS (SELECT p_partkey, upper(regexp_replace(substr('abcdefghijklmnopqrstuvwxyz', (p_partkey % 26 + 1)::INT, 1) || (p_partkey % 90 + 10) || CASE p_partkey % 4 WHEN 0 THEN '.5' WHEN 1 THEN '' WHEN 2 THEN ' 7x' ELSE '-' END, '[.\\s]', '', 'g')) AS c FROM part),
v AS (SELECT p_partkey, CASE WHEN regexp_full_match(c, '[A-Z][0-9][0-9A-Z][0-9A-Z]{0,4}') THEN c END AS c FROM r)
SELECT p_partkey, CASE WHEN length(c) > 3 THEN c[1:3] || '.' || c[4:] ELSE c END AS code, c[1:3] AS code_group FROM v""",
    "id_source_predicate": """
WITH r AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'LG-' || lpad(c_custkey::VARCHAR, 6, '0') WHEN 1 THEN 'RS' || lpad(c_custkey::VARCHAR, 5, '0') WHEN 2 THEN '' ELSE 'LG-' || c_custkey END AS pid,
                  CASE WHEN c_custkey % 5 = 0 THEN 'XX' WHEN c_custkey % 4 = 1 THEN 'RS' ELSE 'LG' END AS src FROM customer)
SELECT c_custkey, array_to_string(list_filter([CASE WHEN src = 'XX' THEN 'invalid_source_system' END, CASE WHEN pid = '' THEN 'missing_patient_id' END,
       CASE WHEN (src = 'LG' AND NOT regexp_full_match(pid, 'LG-[0-9]{6}')) OR (src = 'RS' AND NOT regexp_full_match(pid, 'RS[0-9]{5}')) THEN 'patient_id_source_mismatch' END], lambda x: x IS NOT NULL), ';') AS reasons FROM r""",
    "unit_convert": """
WITH r AS (SELECT p_partkey, ['glucose', 'haemoglobin', 'creatinine', NULL][(p_partkey % 4 + 1)::INT] AS t, ['mg/dl', 'mmol/l', 'g/l', 'umol/l', 'g/dl'][(floor(p_partkey / 4)::BIGINT % 5 + 1)::INT] AS u,
                  CASE WHEN p_partkey % 17 = 0 OR p_partkey % 19 = 0 THEN NULL ELSE (p_size || '.' || (p_partkey % 100))::DECIMAL(18, 6) END AS v FROM part),
c AS (SELECT * FROM (VALUES ('glucose', 'mg/dl', 'mg/dL', 'none'), ('glucose', 'mmol/l', 'mg/dL', 'mmol/L_x_18.016'), ('haemoglobin', 'g/dl', 'g/dL', 'none'), ('haemoglobin', 'g/l', 'g/dL', 'g/L_div_10'),
                            ('creatinine', 'mg/dl', 'mg/dL', 'none'), ('creatinine', 'umol/l', 'mg/dL', 'umol/L_div_88.4')) x(ct, cu, unit, label))
SELECT p_partkey, t AS test, round(CASE label WHEN 'none' THEN v::DOUBLE WHEN 'mmol/L_x_18.016' THEN v::DOUBLE * 18.016 WHEN 'g/L_div_10' THEN v::DOUBLE / 10 WHEN 'umol/L_div_88.4' THEN v::DOUBLE / 88.4 END, 6) AS value,
       unit, label AS conversion, CASE WHEN t IS NULL THEN 'unsupported_test_name' WHEN v IS NULL THEN 'invalid_result_value' WHEN label IS NULL THEN 'unsupported_test_unit' ELSE '' END AS reason
FROM r LEFT JOIN c ON t = ct AND u = cu""",
    "text_fold_ascii": "SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS folded FROM part",
    "phone_normalise": f"""
WITH r AS (SELECT c_custkey, regexp_replace(CASE c_custkey % 3 WHEN 0 THEN '0' || lpad(c_custkey::VARCHAR, 10, '8') WHEN 1 THEN '234' || lpad(c_custkey::VARCHAR, 10, '7') ELSE c_custkey::VARCHAR END, '[^0-9]', '', 'g') AS d FROM customer)
SELECT c_custkey, {_NORM} AS phone FROM r""",
    "dedup_duplicate_record": "SELECT doc_id, 'duplicate_record' AS reason FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1",
    "dedup_pk_conflict": """
SELECT CASE WHEN count(*) OVER w > 1 THEN 'duplicate_primary_key_conflict' ELSE '' END AS reason FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber)""",
    "chronology_reasons": f"{_LINES} SELECT array_to_string(reasons, ';') AS reasons, count(*) AS rows FROM r GROUP BY 1",
    "reason_histogram": f"{_LINES} SELECT reason, count(*) AS rows FROM (SELECT unnest(reasons) AS reason FROM r) GROUP BY 1",
    "accept_quarantine_reconcile": f"{_LINES} SELECT count(*) AS source_rows, count(*) FILTER (WHERE len(reasons) = 0) AS accepted_rows, count(*) FILTER (WHERE len(reasons) > 0) AS quarantined_rows FROM r",
    "fk_cascade": """
WITH c AS (SELECT c_custkey, c_acctbal >= 0 AS ok FROM customer),
o AS (SELECT o_orderkey, coalesce(ok, false) AND o_orderstatus <> 'P' AS ok FROM orders LEFT JOIN c ON o_custkey = c_custkey),
l AS (SELECT coalesce(ok, false) AS ok FROM lineitem LEFT JOIN o ON l_orderkey = o_orderkey),
a AS (SELECT 'customer' AS level, ok FROM c UNION ALL SELECT 'orders', ok FROM o UNION ALL SELECT 'lineitem', ok FROM l)
SELECT level, count(*) FILTER (WHERE ok) AS accepted_rows, count(*) FILTER (WHERE NOT ok) AS quarantined_rows FROM a GROUP BY 1""",
    "history_features": f"WITH stays AS ({PAIR_STAYS}) {HISTORY}",
    "event_summary_pivot": """
WITH e AS (SELECT *, l_extendedprice::DECIMAL(18, 2) AS v FROM lineitem),
o AS (
  SELECT *, row_number() OVER w AS k, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, v DESC, l_quantity DESC, l_discount DESC, l_tax DESC, l_linestatus DESC) AS b
  FROM e WINDOW w AS (PARTITION BY l_orderkey, l_returnflag ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, v, l_quantity, l_discount, l_tax, l_linestatus))
SELECT l_orderkey, """ + ", ".join(
        f"count(*) FILTER ({w})::INT AS {f}_count, max(v) FILTER ({w} AND k = 1)::DOUBLE AS {f}_first, max(v) FILTER ({w} AND b = 1)::DOUBLE AS {f}_latest, min(v) FILTER ({w})::DOUBLE AS {f}_min, max(v) FILTER ({w})::DOUBLE AS {f}_max, "
        f"(((sum((v * 100)::BIGINT) FILTER ({w})) * 20 + count(*) FILTER ({w})) // (2 * nullif(count(*) FILTER ({w}), 0)) / 1000.0::DOUBLE) AS {f}_mean"
        for f in ("a", "n", "r") for w in (f"WHERE l_returnflag = '{f.upper()}'",)) + " FROM o GROUP BY l_orderkey",
    "readmission_label": f"WITH stays AS ({PAIR_STAYS}), lab AS ({LABEL}) SELECT stay_id, label_status, CASE label_status WHEN 'labeled_positive' THEN 1 WHEN 'labeled_negative' THEN 0 END AS readmitted_30d FROM lab",
    "label_status_counts": f"""
SELECT 'pair' AS entity, label_status, count(*) AS rows FROM (WITH stays AS ({PAIR_STAYS}) {LABEL}) GROUP BY 2
UNION ALL SELECT 'custkey', label_status, count(*) FROM (WITH stays AS ({LOCAL_STAYS}) {LABEL}) GROUP BY 2""",
    "follow_up_exists": f"""
WITH stays AS ({LOCAL_STAYS}) SELECT count(*) FILTER (WHERE EXISTS (SELECT 1 FROM stays o WHERE o.entity = s.entity AND o.stay_id <> s.stay_id AND o.admitted BETWEEN s."left" AND s."left" + 30)) AS followed, count(*) AS stays FROM stays s""",
    "completed_years": """
WITH b AS (SELECT o_orderkey, DATE '1930-02-28' + (o_custkey * 7 % 20000)::INT AS b, o_orderdate::DATE AS a FROM orders)
SELECT o_orderkey, (year(a) - year(b) - (strftime(a, '%m%d') < strftime(b, '%m%d'))::INT)::INT AS age FROM b""",
    "bands": f"SELECT {AGE.format(c='o_orderkey % 100')} AS age_band, {STAY.format(c='o_orderkey % 20')} AS stay_band, {PRIOR.format(c='o_orderkey % 4')} AS prior_band, count(*) AS rows FROM orders GROUP BY 1, 2, 3",
    "overall_metrics": f"WITH {COHORT} SELECT e AS eligible_entities, {METRICS} FROM (SELECT count(DISTINCT master_patient_id) AS e, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n FROM elig)",
    "breakdowns_suppressed": f"{REPORT} SELECT * FROM report",
    "labels_breakdown_suppressed": "WITH " + _report(" UNION ALL ".join(
        f"SELECT '{d}' AS dimension, ({c})::VARCHAR AS category, count(*) FILTER (WHERE toxic = 1) AS p, count(*) FILTER (WHERE toxic = 0) AS n FROM labels GROUP BY 2" for d, c in (("quality", "quality"), ("bucket", "doc_id % 7"))), 11) + " SELECT * FROM report",
    "excluded_status_suppression": f"""
WITH {COHORT}, g AS (SELECT label_status, count(*) AS c, count(*) < 200 AS small FROM cohort WHERE y IS NULL GROUP BY 1),
k AS (SELECT *, sum(small::INT) OVER () AS smalls, row_number() OVER (PARTITION BY small ORDER BY c, label_status) AS k FROM g),
r AS (SELECT *, CASE WHEN small THEN 'primary_small_cell' WHEN smalls = 1 AND k = 1 THEN 'complementary_suppression' ELSE '' END AS suppression_reason FROM k)
SELECT label_status, CASE WHEN suppression_reason = '' THEN c END AS admissions, suppression_reason FROM r""",
    "top_released_category": f"{REPORT} SELECT category, eligible_admissions, readmitted_admissions, readmission_rate_pct FROM report WHERE dimension = 'diagnosis_group' AND suppression_reason = '' ORDER BY readmission_rate_pct DESC, category LIMIT 1",
    "breakdown_page": f"{REPORT} SELECT dimension, category, eligible_admissions, suppression_reason FROM report WHERE dimension = 'discharge_month' ORDER BY dimension, category LIMIT 10 OFFSET 5",
    "contract_violations": f"""
{REPORT}, v AS (
  SELECT unnest([{{'rule': 'unknown dimension', 'bad': false}}, {{'rule': 'blank category', 'bad': category = ''}}, {{'rule': 'unknown reason', 'bad': false}}, {{'rule': 'suppressed metric shown', 'bad': suppression_reason <> '' AND eligible_admissions IS NOT NULL}},
    {{'rule': 'small cell shown', 'bad': suppression_reason = '' AND least(eligible_admissions, readmitted_admissions, not_readmitted_admissions) < 11}}, {{'rule': 'counts do not add up', 'bad': eligible_admissions <> readmitted_admissions + not_readmitted_admissions}},
    {{'rule': 'rate differs', 'bad': abs(readmission_rate_pct - 100.0 * readmitted_admissions / eligible_admissions) > 0.00501}}, {{'rule': 'interval misses the rate', 'bad': NOT (wilson_95_lower_pct <= readmission_rate_pct AND readmission_rate_pct <= wilson_95_upper_pct)}},
    {{'rule': 'metric missing', 'bad': suppression_reason = '' AND readmission_rate_pct IS NULL}}]) AS x FROM report)
SELECT x.rule AS rule, count(*) FILTER (WHERE x.bad) AS rows FROM v GROUP BY 1""",
    "gold_row_rules": f"""
WITH {COHORT}, b AS (
  SELECT unnest([CASE WHEN hospital NOT IN ('Lakeside General', 'Riverside Specialist') THEN 'unsupported hospital' END]) AS rule FROM cohort)
SELECT rule, count(*) AS rows FROM b WHERE rule IS NOT NULL GROUP BY 1""",
    "before_after_matching": f"""
WITH {COHORT}, loc AS ({LOCAL_STAYS}),
f AS (SELECT e.y, EXISTS (SELECT 1 FROM loc o WHERE o.entity = e.local_id AND o.stay_id <> e.admission_id AND o.admitted BETWEEN e.discharge_date AND e.discharge_date + 30 AND o.admitted <= DATE '2001-08-01') AS b FROM elig e),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE b) AS b, count(*) FILTER (WHERE y = 1) AS a FROM f)
SELECT n AS eligible_admissions, b AS before_readmitted, round(100.0::DOUBLE * b / n, 2) AS before_rate_pct, a AS after_readmitted, round(100.0::DOUBLE * a / n, 2) AS after_rate_pct, a - b AS hidden_readmissions,
       round(round(100.0::DOUBLE * a / n, 2) - round(100.0::DOUBLE * b / n, 2), 2) AS percentage_point_change FROM c""",
    "breakdown_reconciliation": f"{REPORT} SELECT category, true AS matches FROM report WHERE dimension = 'diagnosis_group' AND suppression_reason = ''",
    "block_candidates": f"WITH {PEOPLE} SELECT l AS lg_patient_id, r AS rs_patient_id FROM cand",
    "deletion_block_pairs": f"WITH {PEOPLE} SELECT l AS lg_patient_id, r AS rs_patient_id FROM near",
    "pair_scoring": f"WITH {PEOPLE} SELECT l AS lg_patient_id, r AS rs_patient_id, ({' + '.join(f'CASE WHEN {c} THEN {n} ELSE 0 END' for c, _, n in _EVIDENCE)})::INT AS match_score, {_LIST([(c, k) for c, k, _ in _EVIDENCE])} AS evidence_codes, {_LIST(_CONFLICT)} AS conflict_codes, {_RULE} AS decision_rule, auto AS auto_eligible, review AS review_eligible FROM scored",
    "one_to_one_links": f"WITH {PEOPLE} SELECT one_to_one, count(*) AS pairs FROM (SELECT count(*) OVER (PARTITION BY l) = 1 AND count(*) OVER (PARTITION BY r) = 1 AS one_to_one FROM cand) GROUP BY 1",
    "master_tokens": f"SELECT c_custkey, 'MP-' || {_hmac("'MP' || chr(31) || 'LG:' || c_name")}[1:24] AS token FROM customer",
    "master_tokens_builtin": f"SELECT c_custkey, 'RV-' || {_hmac("'RV' || chr(31) || c_name || chr(31) || c_mktsegment")}[1:20] AS token FROM customer",
    "link_status": f"WITH {PEOPLE}, {_LINKED.format(rule='false', reject='false', abstain='false')}",
    "review_decisions_apply": f"WITH {PEOPLE}, {_LINKED.format(rule='num % 3 = 0 AND alone', reject='num % 3 = 1', abstain='num % 3 = 2')}",
    "publish_parity": """
WITH a AS (SELECT o_custkey, o_orderstatus FROM orders), b AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0 UNION ALL SELECT c_custkey, 'F' FROM customer)
SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS left_only, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS right_only""",
    "coverage_check": """
SELECT count(*) FILTER (WHERE l IS NOT NULL AND r IS NOT NULL) AS in_both, count(*) FILTER (WHERE r IS NULL) AS left_only, count(*) FILTER (WHERE l IS NULL) AS right_only
FROM (SELECT DISTINCT c_custkey AS l FROM customer) FULL JOIN (SELECT DISTINCT o_custkey AS r FROM orders) ON l = r""",
    "identifier_scan": """SELECT c_name FROM customer WHERE contains('{"rows": ["Customer#000000007", "Customer#000000011x", "none"]}', c_name)""",
    "temporal_split_counts": f"""
WITH {COHORT}, r AS (SELECT * FROM elig WHERE discharge_date + 30 <= DATE '2001-08-01'), tr AS (SELECT * FROM r WHERE discharge_date + 30 < DATE '1998-01-01'),
fu AS (SELECT * FROM r WHERE admit_date >= DATE '1998-01-01'), te AS (SELECT * FROM fu WHERE master_patient_id NOT IN (SELECT master_patient_id FROM tr))
SELECT (SELECT count(*) FROM tr) AS train_admissions, (SELECT count(*) FROM te) AS test_admissions, (SELECT count(DISTINCT master_patient_id) FROM tr) AS train_entities, (SELECT count(DISTINCT master_patient_id) FROM te) AS test_entities,
       (SELECT count(*) FROM fu) - (SELECT count(*) FROM te) AS future_returning_rows_excluded, (SELECT count(*) FROM r) - (SELECT count(*) FROM tr) - (SELECT count(*) FROM fu) AS boundary_rows_excluded,
       (SELECT count(*) FROM tr WHERE y = 1) AS train_positives, (SELECT count(*) FROM te WHERE y = 1) AS test_positives""",
    "class_balance": "SELECT toxic AS outcome, count(*) AS rows, count(*) >= 11 AS enough FROM labels GROUP BY 1",
    "classifier_metrics": """
WITH s AS (SELECT quality AS y, n_chars / 131072.0::DOUBLE AS p FROM labels JOIN documents USING (doc_id)),
g AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY p),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower_neg, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp FROM g),
c AS (SELECT sum(pos)::DOUBLE AS P1, sum(neg)::DOUBLE AS N1, sum(pos * (lower_neg + neg / 2.0::DOUBLE)) AS u, sum(pos * tp / (tp + fp)::DOUBLE) AS ap FROM r),
k AS (SELECT avg((p - y) * (p - y)) AS brier, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS loss, count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp, count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp FROM s)
SELECT round(u / (P1 * N1), 6) AS roc_auc, round(ap / P1, 6) AS average_precision, round(brier, 6) AS brier_score, round(loss, 6) AS log_loss, round((tp / (tp + fn)::DOUBLE + tn / (tn + fp)::DOUBLE) / 2, 6) AS balanced_accuracy,
       CASE WHEN least(tn, fp, fn, tp) >= 11 THEN tn END AS tn, CASE WHEN least(tn, fp, fn, tp) >= 11 THEN fp END AS fp, CASE WHEN least(tn, fp, fn, tp) >= 11 THEN fn END AS fn, CASE WHEN least(tn, fp, fn, tp) >= 11 THEN tp END AS tp,
       least(tn, fp, fn, tp) < 11 AS confusion_suppressed FROM c, k""",
    "freshness_status": "SELECT CASE WHEN epoch(TIMESTAMP '2024-01-20') - floor(epoch(ts)) < 0 THEN 'INVALID' WHEN epoch(TIMESTAMP '2024-01-20') - floor(epoch(ts)) > 86400 THEN 'STALE' ELSE 'FRESH' END AS freshness, count(*) AS rows FROM events GROUP BY 1",
}
ORACLES["dedup_pk_conflict"] = f"SELECT reason, count(*) AS rows FROM ({ORACLES['dedup_pk_conflict']}) GROUP BY 1"
ORACLES["logistic_optimum"] = "SELECT * FROM (VALUES (0, true), (1, true), (2, true), (3, true), (4, true)) t(weight, at_optimum)"
