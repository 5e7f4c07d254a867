"""Standardising: counts, reasons and values of small deliveries."""

import pytest
from pyspark.sql import functions as F

from lodeworks import EngineError
from lodeworks.functions import stats, text, times
from lodeworks.operators import quality
from lodeworks.schemas import ADMISSIONS, LABS, LINEAGE, PATIENTS, text_schema


def bronze(spark, columns, rows):
    schema = text_schema(columns)
    rows = [(*r, "LG", "f.csv", str(i + 2), "0" * 64, "2024-01-01T00:00:00Z", "run") for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, text_schema((*columns, *LINEAGE))) if rows else spark.createDataFrame([], text_schema((*schema.names, *LINEAGE)))


P = [("LG-000001", "LG", "Ada", "Obi", "5/3/1980", "1", "08012345678", "Lagos"), ("RS00002", " rs", "Ben", "Eze", "1990-01-02", "female", "", "Kano"), ("LG-000003", "LG", "Chi", "Ojo", "03/04/1975", "2", "x", "Abia")]
A = [("A1", "LG-000001", "lakeside general", "01/02/2024", "05/02/2024", "i50.9", "Home"), ("A1", "LG-000001", "lakeside general", "01/02/2024", "05/02/2024", "i50.9", "Home"),
     ("A2", "RS00002", "Riverside Specialist", "2024-03-01", "2024-03-02", "J189", "died"), ("A3", "LG-000003", "Lakeside General", "2024-04-01", "", "O80", "still_admitted")]
L = [("L1", "A1", "Glucose", "5.5", "mmol/L", "2024-02-02 10:00"), ("L2", "A2", "hemoglobin", "130", "g/L", "2024-03-01T08:00:00"), ("L3", "A3", "creatinine", "88.4", "µmol/L", "2024-04-03T08:00:00+02:00"),
     ("L4", "A2", "glucose", "90", "mg/dL", "2024-03-05T00:00:00")]
CONFIG = quality.SilverConfig("dmy", {"1": "M", "2": "F"})


def silver(spark, p=P, a=A, x=L, config=CONFIG):
    return quality.build_silver(bronze(spark, PATIENTS, p), bronze(spark, ADMISSIONS, a), bronze(spark, LABS, x), config)


def histogram(s, name):
    return {r["reason"]: r["rows"] for r in quality.reason_histogram(s.classified[name]).collect()}


def test_configured_delivery(spark):
    s = silver(spark)
    assert {k: v.count() for k, v in s.accepted.items()} == {"patients": 3, "admissions": 3, "lab_results": 3}
    assert {k: v.count() for k, v in s.quarantine.items()} == {"patients": 0, "admissions": 1, "lab_results": 1}
    assert histogram(s, "admissions") == {"duplicate_record": 1}
    assert histogram(s, "lab_results") == {"result_after_discharge": 1}
    values = {r["lab_id"]: str(r["v"]) for r in s.accepted["lab_results"].select("lab_id", stats.plain_decimal(F.col("result_value")).alias("v")).collect()}
    assert values == {"L1": "99.088", "L2": "13", "L3": "1"}
    assert sorted(r[0] for r in s.accepted["admissions"].select("diagnosis_code").collect()) == ["I50.9", "J18.9", "O80"]
    assert quality.reconcile(s.classified["admissions"]) == {"source": 4, "accepted": 3, "quarantined": 1}
    assert quality.transformation_counts(s)["patients"] == {"date_of_birth_slash_to_iso": 2, "sex_F": 2, "sex_M": 1}


def test_without_configuration_parents_refuse_children(spark):
    s = silver(spark, config=quality.SilverConfig())
    assert s.accepted["patients"].count() == 1
    assert histogram(s, "patients") == {"unconfigured_slash_date_date_of_birth": 2, "unmapped_numeric_sex_code": 2}
    assert histogram(s, "admissions")["unknown_patient_id"] == 3


def test_conflicting_keys_refuse_all_versions(spark):
    changed = [A[0], (*A[1][:4], "06/02/2024", *A[1][5:]), *A[2:]]
    s = silver(spark, a=changed)
    assert histogram(s, "admissions") == {"duplicate_primary_key_conflict": 2}
    assert histogram(s, "lab_results")["unknown_admission_id"] == 1


def test_empty_tables(spark):
    s = silver(spark, [], [], [])
    assert all(v.count() == 0 for v in (*s.accepted.values(), *s.quarantine.values()))


def test_bad_configuration():
    with pytest.raises(EngineError):
        quality.SilverConfig("ymd").checked()
    with pytest.raises(EngineError):
        quality.SilverConfig("dmy", {"1": "X"}).checked()


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize("raw,order,value,reason", [
    ("2024-02-30", "dmy", None, "invalid_d"), (" 1/2/2024\t", "dmy", "2024-02-01", None), ("1/2/2024", "mdy", "2024-01-02", None), ("1/2/2024", "reject", None, "unconfigured_slash_date_d"),
    ("", "dmy", None, "missing_d"), ("0000-01-01", "dmy", None, "invalid_d"), ("2024-01-01\n", "dmy", "2024-01-01", None), (None, "dmy", None, "missing_d"), ("٢٠٢٤-01-01", "dmy", None, "invalid_d")])
def test_dates(spark, raw, order, value, reason):
    got = one(spark, *times.parse_date(F.lit(raw).cast("string"), "d", order))
    assert (str(got[0]) if got[0] else None, got[1]) == (value, reason)


@pytest.mark.parametrize("raw,shown", [
    ("2024-01-02 03:04", "2024-01-02T03:04:00"), ("2024-01-02T03:04:05.120", "2024-01-02T03:04:05.120000"), ("2024-01-02T01:00:00+02:00", "2024-01-01T23:00:00Z"), ("2024-01-02T01:00:00Z", "2024-01-02T01:00:00Z"),
    ("2/1/2024 09:30:15", "2024-01-02T09:30:15"), ("2024-01-02", None), ("2024-01-02T25:00", None)])
def test_timestamps(spark, raw, shown):
    value, offset, reason = times.parse_timestamp(F.lit(raw), "t", "dmy")
    got = one(spark, times.format_timestamp(value, F.coalesce(offset, F.lit(False))), reason)
    assert got[0] == shown and (got[1] is None) == (shown is not None)


@pytest.mark.parametrize("born,at,age", [("2000-02-29", "2025-02-28", 24), ("2000-02-29", "2025-03-01", 25), ("1990-05-05", "1990-05-05", 0)])
def test_ages(spark, born, at, age):
    assert one(spark, times.completed_years(F.lit(born).cast("date"), F.lit(at).cast("date")))[0] == age


@pytest.mark.parametrize("test,value,unit,shown,reason", [
    ("glucose", "1e2", "mg/dL", "100", None), ("glucose", "NaN", "mg/dL", None, "invalid_result_value"), ("glucose", "-1", "mg/dL", None, "invalid_result_value"), ("glucose", "1e30", "mg/dL", None, "invalid_result_value"),
    ("sodium", "1", "mg/dL", None, "unsupported_test_name"), ("glucose", "1", "g/L", None, "unsupported_test_unit"), ("creatinine", "100", "μmol/L", "1.131222", None)])
def test_conversion(spark, test, value, unit, shown, reason):
    got = stats.convert_lab(F.lit(test), F.lit(value), F.lit(unit))
    row = one(spark, F.when(got["reason"].isNull(), stats.plain_decimal(got["value"])), got["reason"])
    assert (row[0], row[1]) == (shown, reason)


@pytest.mark.parametrize("raw,folded", [("Ádè-Òjó", "adeojo"), ("O'Neil 3", "oneil3"), (None, ""), ("ﬁn", "fin")])
def test_fold(spark, raw, folded):
    assert one(spark, text.fold(F.lit(raw).cast("string")))[0] == folded


def test_tokens_agree_with_hmac(spark):
    import hashlib
    import hmac

    key = b"k" * 40
    want = "MT-" + hmac.new(key, b"MT\x1fa\x1fb", hashlib.sha256).hexdigest().upper()[:20]
    row = one(spark, text.token(key, "MT", F.lit("a"), F.lit("b")), text.token_in_plan(key, "MT", F.lit("a"), F.lit("b")))
    assert tuple(row) == (want, want)
    with pytest.raises(ValueError):
        text.token(b"short", "MT", F.lit("a"))


def test_profile_counts(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", " ")], "id string, name string")
    got = {r["column_name"]: (r["row_count"], r["missing_count"], r["non_missing_distinct_count"]) for r in quality.profile(df).collect()}
    assert got == {"id": (3, 0, 2), "name": (3, 1, 1)}
    assert tuple(quality.exact_duplicates(df).first()) == (3, 1)
