"""Linking: automatic, reviewed and refused pairs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodeworks import EngineError
from lodeworks.operators import identity
from lodeworks.schemas import REVIEW_INPUT

KEY = b"an identity key of 32 bytes or so"
SCHEMA = "patient_id string, source_system string, first_name string, last_name string, date_of_birth date, sex string, phone string, state string"
D = dt.date(1980, 1, 2)
ROWS = [("LG-000001", "LG", "Ada", "Obi", D, "F", "08011111111", "Lagos"), ("RS00001", "RS", "Adah", "Obi", D, "F", "+234 801 111 1111", "lagos"),
        ("LG-000002", "LG", "Ben", "Eze", dt.date(1970, 3, 4), "M", "08022222222", "Kano"), ("RS00002", "RS", "Ben", "Eze", dt.date(1970, 5, 6), "M", "08033333333", "Kano"),
        ("RS00003", "RS", "Chi", "Ojo", D, "F", "", "Abia")]


def people(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def statuses(found):
    return {r["patient_id"]: r["link_status"] for r in found.master.collect()}


def test_one_link_one_review_one_alone(spark):
    found = identity.resolve(people(spark), KEY)
    assert statuses(found) == {"LG-000001": "AUTO_MATCHED", "RS00001": "AUTO_MATCHED", "LG-000002": "REVIEW_PENDING", "RS00002": "REVIEW_PENDING", "RS00003": "UNMATCHED"}
    assert found.master.select("master_patient_id").distinct().count() == 4
    row = found.queue.first()
    assert "BIRTH_YEAR_EXACT" in row["evidence_codes"] and "PHONE_DIFFERS" in row["conflict_codes"] and row["decision_rule"] == "EXACT_FULL_NAME_WITH_BIRTH_COMPONENT"
    audit = identity.audit(found)
    assert (audit["auto_matches"], audit["review_candidates"], audit["one_to_one_constraint_passed"]) == (1, 1, True)
    again = identity.resolve(people(spark), KEY)
    assert sorted(map(tuple, found.master.collect())) == sorted(map(tuple, again.master.collect()))


def reviews(spark, case, decision, at="2024-01-01T00:00:00Z", who="me"):
    return spark.createDataFrame([(case, decision, who, at, "")], ", ".join(f"{c} string" for c in REVIEW_INPUT))


def test_human_decisions(spark):
    case = identity.resolve(people(spark), KEY).queue.first()["review_case_id"]
    accepted = identity.resolve(people(spark), KEY, reviews(spark, case, "ACCEPT"))
    assert statuses(accepted)["LG-000002"] == "HUMAN_MATCHED" and accepted.master.select("master_patient_id").distinct().count() == 3
    assert identity.workload(identity.audit(accepted))["human_review_outcomes"] == {"accepted": 1, "rejected": 0, "abstained": 0, "pending": 0}
    assert statuses(identity.resolve(people(spark), KEY, reviews(spark, case, "REJECT")))["RS00002"] == "REVIEW_REJECTED"
    assert statuses(identity.resolve(people(spark), KEY, reviews(spark, case, "ABSTAIN")))["RS00002"] == "REVIEW_PENDING"
    for bad in (reviews(spark, "RV-none", "ACCEPT"), reviews(spark, case, "MAYBE"), reviews(spark, case, "ACCEPT", "2024-01-01T00:00:00"), reviews(spark, case, "ACCEPT", who=" ")):
        with pytest.raises(EngineError):
            identity.resolve(people(spark), KEY, bad)


def test_shared_phone_is_never_automatic(spark):
    rows = [*ROWS[:2], ("LG-000009", "LG", "Ada", "Obi", D, "F", "08011111111", "Lagos")]
    found = identity.resolve(people(spark, rows), KEY)
    assert identity.audit(found)["auto_matches"] == 0 and found.queue.count() == 2
    assert all("PHONE_NOT_UNIQUE" in r["conflict_codes"] for r in found.queue.collect())
    cases = [r["review_case_id"] for r in found.queue.collect()]
    both = reviews(spark, cases[0], "ACCEPT").unionByName(reviews(spark, cases[1], "ACCEPT"))
    with pytest.raises(EngineError):  # both links share one record
        identity.resolve(people(spark, rows), KEY, both)


def test_collisions_queue(spark):
    pairs = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "lg_patient_id string, rs_patient_id string")
    scored = pairs.select("*", F.lit(1).alias("match_score"), F.array().cast("array<string>").alias("evidence_codes"), F.array(F.lit("Z")).alias("conflict_codes"), F.lit("R").alias("decision_rule"), F.lit(True).alias("auto_eligible"), F.lit(False).alias("review_eligible"))
    auto, review = identity.split_decisions(scored)
    assert [r["lg_patient_id"] for r in auto.collect()] == ["b"]
    assert {r["decision_rule"] for r in review.collect()} == {"AUTO_CANDIDATE_COLLISION"} and review.first()["conflict_codes"] == ["AUTO_CANDIDATE_COLLISION", "Z"]


def test_near_phones_share_a_signature(spark):
    rows = [("LG-000001", "LG", "A", "B", D, "F", "08011111111", "X"), ("RS00001", "RS", "C", "D", dt.date(1999, 9, 9), "M", "08011111112", "Y"), ("RS00002", "RS", "E", "F", dt.date(1998, 9, 9), "M", "0801111111", "Z")]
    assert [tuple(r) for r in identity.candidates(identity.normalise(people(spark, rows))).collect()] == [("LG-000001", "RS00001")]


def test_defects(spark):
    with pytest.raises(EngineError):
        identity.resolve(people(spark), b"short")
    with pytest.raises(EngineError):
        identity.resolve(people(spark, [ROWS[0], ROWS[0]]), KEY)
    assert identity.resolve(people(spark, []), KEY).master.count() == 0
