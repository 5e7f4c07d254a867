"""Column contracts.  Order is part of a contract; blank text means missing."""

from __future__ import annotations

from pyspark.sql import types as T

#: The ordered columns of every table of the pipeline.
LINEAGE = ("_source_system", "_source_file", "_source_row_number", "_source_sha256", "_ingested_at_utc", "_ingestion_run_id")
QUARANTINE_REASON = "_quarantine_reason"
REASON_CODES = "_quarantine_reason_codes"
PATIENTS = ("patient_id", "source_system", "first_name", "last_name", "date_of_birth", "sex", "phone", "state")
ADMISSIONS = ("admission_id", "patient_id", "hospital", "admit_date", "discharge_date", "diagnosis_code", "discharge_status")
LABS = ("lab_id", "admission_id", "test_name", "result_value", "unit", "result_time")
LAB_EXTRAS = ("result_value_original", "unit_original", "conversion_applied")
MASTER = ("master_patient_id", "patient_id", "source_system", "link_status", "match_case_id", "rule_version")
DECISIONS = ("match_case_id", "lg_patient_id", "rs_patient_id", "decision", "decision_source", "match_score", "evidence_codes", "conflict_codes", "decision_rule", "rule_version", "reviewer_id", "reviewed_at_utc", "review_notes")
REVIEW_QUEUE = ("review_case_id", "lg_patient_id", "rs_patient_id", "review_status", "match_score", "evidence_codes", "conflict_codes", "decision_rule", "rule_version", "reviewer_id", "reviewed_at_utc", "review_notes")
REVIEW_INPUT = ("review_case_id", "decision", "reviewer_id", "reviewed_at_utc", "review_notes")
TESTS = ("glucose", "haemoglobin", "creatinine")
SUMMARIES = ("count", "first", "latest", "min", "max", "mean")
GOLD_BASE = ("admission_id", "master_patient_id", "hospital", "admit_date", "discharge_date", "age_at_admit", "sex", "diagnosis_group", "discharge_status", "length_of_stay_days", "prior_completed_admission_count", "prior_admission_30d_count", "prior_admission_365d_count", "prior_same_diagnosis_group_count", "prior_distinct_hospital_count", "days_since_prior_discharge")
GOLD = (*GOLD_BASE, *(f"{t}_{s}" for t in TESTS for s in SUMMARIES), "readmitted_30d", "label_status", "observation_end_date", "feature_rule_version")
METRICS = ("eligible_admissions", "readmitted_admissions", "not_readmitted_admissions", "readmission_rate_pct", "wilson_95_lower_pct", "wilson_95_upper_pct")
BREAKDOWN = ("dimension", "category", *METRICS, "suppression_reason")

#: Vocabularies.
HOSPITALS = ("Lakeside General", "Riverside Specialist")
STATUSES = ("home", "transferred", "died", "still_admitted")
ELIGIBLE = ("labeled_positive", "labeled_negative")
EXCLUDED = ("excluded_died", "excluded_no_discharge", "censored_incomplete_30d_followup")
LINK_STATUSES = ("AUTO_MATCHED", "HUMAN_MATCHED", "REVIEW_PENDING", "REVIEW_REJECTED", "UNMATCHED")
DIMENSIONS = ("hospital", "sex", "age_band", "diagnosis_group", "discharge_status", "prior_completed_admission_band", "length_of_stay_band", "discharge_year", "discharge_month")
SILVER_RULES, IDENTITY_RULES, GOLD_RULES, ANALYTICS_RULES, RELEASE_RULES = "phase2-silver-v1", "phase3-identity-v1", "phase4-gold-v1", "phase5-analytics-v1", "phase6-validation-v1"
#: Header names, normalised, whose number is published as sensitive.
SENSITIVE = frozenset("address dob email first_name full_name last_name medical_record_number mrn name national_id patient_id phone postcode social_security_number ssn".split())


def text_schema(columns) -> T.StructType:
    """All-string schema in contract order."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
