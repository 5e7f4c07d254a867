"""Labels, history and summaries against plain loops, and the feature table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lodeworks import EngineError
from lodeworks.operators import features
from lodeworks.schemas import GOLD

END = dt.date(2025, 12, 31)
STAY = "stay_id string, entity string, site string, admitted date, left date, grp string, status string"


def day(n):
    return dt.date(2025, 1, 1) + dt.timedelta(days=n)


def stays(spark, rows):
    return spark.createDataFrame(rows, STAY)


def brute(rows, end):
    out = {}
    for i, e, s, a, l, g, st in rows:
        others = [o for o in rows if o[1] == e and o[0] != i]
        follow = l is not None and any(l <= o[3] <= min(l + dt.timedelta(days=30), end) for o in others)
        status = "excluded_died" if st == "died" else "excluded_no_discharge" if l is None else "labeled_positive" if follow else "labeled_negative" if l + dt.timedelta(days=30) <= end else "censored_incomplete_30d_followup"
        prior = [o for o in others if o[4] is not None and o[4] <= a]
        gaps = [(a - o[4]).days for o in prior]
        out[i] = (status, len(prior), sum(x <= 30 for x in gaps), sum(x <= 365 for x in gaps), sum(o[5] == g for o in prior), len({o[2] for o in prior}), min(gaps) if gaps else None)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_loops(spark, seed):
    r = random.Random(seed)
    rows = []
    for k in range(400):
        a = r.randint(0, 300)
        open_ = r.random() < 0.05
        rows.append((f"s{k}", f"e{r.randint(0, 30)}", r.choice("xyz"), day(a), None if open_ else day(a + r.choice([0, 0, 1, 5, 40])), r.choice("gh"), "still_admitted" if open_ else r.choice(["home", "died"])))
    got = features.history(features.label(stays(spark, rows), F.lit(day(320)))).collect()
    names = ["label_status", "prior_completed_admission_count", "prior_admission_30d_count", "prior_admission_365d_count", "prior_same_diagnosis_group_count", "prior_distinct_hospital_count", "days_since_prior_discharge"]
    assert {g["stay_id"]: tuple(g[n] for n in names) for g in got} == brute(rows, day(320))


@pytest.mark.parametrize("gap,status", [(0, "labeled_positive"), (30, "labeled_positive"), (31, "labeled_negative")])
def test_window_ends(spark, gap, status):
    rows = [("a", "e", "x", day(0), day(4), "g", "home"), ("b", "e", "x", day(4 + gap), day(5 + gap), "g", "home")]
    got = {r["stay_id"]: r["label_status"] for r in features.label(stays(spark, rows), F.lit(END)).collect()}
    assert got["a"] == status


def test_exclusions(spark):
    late = dt.date(2025, 12, 20)
    rows = [("a", "1", "x", day(0), day(1), "g", "died"), ("b", "2", "x", day(0), None, "g", "still_admitted"), ("c", "3", "x", day(0), late, "g", "home")]
    got = {r["stay_id"]: (r["label_status"], r["readmitted_30d"]) for r in features.label(stays(spark, rows), F.lit(END)).collect()}
    assert got == {"a": ("excluded_died", None), "b": ("excluded_no_discharge", None), "c": ("censored_incomplete_30d_followup", None)}
    assert features.history(features.label(stays(spark, []), F.lit(END))).count() == 0


def tables(spark, admit3=dt.date(2025, 2, 4)):
    p = spark.createDataFrame([("P1", "LG", dt.date(1980, 5, 5), "F"), ("P2", "RS", dt.date(1980, 5, 5), "F")], "patient_id string, source_system string, date_of_birth date, sex string")
    m = spark.createDataFrame([("M", "P1", "LG", "AUTO_MATCHED", "c", "v"), ("M", "P2", "RS", "AUTO_MATCHED", "c", "v")], "master_patient_id string, patient_id string, source_system string, link_status string, match_case_id string, rule_version string")
    a = spark.createDataFrame([("A1", "P1", "Lakeside General", dt.date(2025, 1, 1), dt.date(2025, 1, 5), "I50.9", "home"), ("A2", "P2", "Riverside Specialist", dt.date(2025, 1, 5), dt.date(2025, 1, 5), "I50.1", "home"),
                               ("A3", "P1", "Lakeside General", admit3, admit3, "J18.9", "home")], "admission_id string, patient_id string, hospital string, admit_date date, discharge_date date, diagnosis_code string, discharge_status string")
    x = spark.createDataFrame([("L2", "A1", "glucose", "110", dt.datetime(2025, 1, 2, 9)), ("L1", "A1", "glucose", "90", dt.datetime(2025, 1, 2, 8))], "lab_id string, admission_id string, test_name string, v string, result_time timestamp_ntz").withColumn("result_value", F.col("v").cast("decimal(34,6)")).drop("v")
    return p, a, x, m


def test_feature_table(spark):
    gold = features.build_gold(*tables(spark), END)
    assert tuple(gold.columns) == GOLD
    rows = {r["admission_id"]: r for r in gold.collect()}
    assert {k: r["label_status"] for k, r in rows.items()} == {"A1": "labeled_positive", "A2": "labeled_positive", "A3": "labeled_negative"}
    assert (rows["A2"]["prior_completed_admission_count"], rows["A2"]["days_since_prior_discharge"], rows["A2"]["prior_same_diagnosis_group_count"]) == (1, 0, 1)
    a1 = rows["A1"]
    assert [str(a1[f"glucose_{s}"]) for s in ("count", "first", "latest", "min", "max", "mean")] == ["2", "90.000", "110.000", "90.000", "110.000", "100.000"]
    assert rows["A3"]["glucose_count"] == 0 and rows["A3"]["glucose_mean"] is None and rows["A3"]["age_at_admit"] == 44
    assert features.gold_audit(gold)["label_counts"] == {"negative": 1, "positive": 2}


def test_contracts(spark):
    p, a, x, m = tables(spark)
    for bad in ((p, a, x, m.limit(1)), (p, a.unionByName(a), x, m), (p.limit(1), a, x, m), (p, a, x.withColumn("admission_id", F.lit("no")), m), tables(spark, dt.date(2026, 1, 1))):
        with pytest.raises(EngineError):
            features.build_gold(*bad, END)
