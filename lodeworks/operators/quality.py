"""Reason-coded quality: duplicates, references, chronology, quarantine.

A row carries the set of all rules it breaks and is accepted exactly if that
set is empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..errors import require
from ..functions import stats, text, times
from ..sources.scratch import stash

REASONS = "_reasons"


def duplicate_reasons(df: DataFrame, key: str, columns: Sequence[str], order: Column) -> DataFrame:
    """Adds ``_duplicate``: the reason a row repeats its key, or null.

    Rows of equal, not blank, stripped keys whose stripped columns all agree
    are copies: the first in order stays.  If any differ, all are in conflict.
    Both facts come from one aggregate by key (a key with a third of all rows
    is combined where it is read), joined back to the rows of repeated keys.
    """
    k = text.strip(F.coalesce(F.col(key), F.lit("")))
    # unit separators cannot be confused with text, being escaped by length
    signature = F.sha2(F.concat_ws("\x1f", *[F.concat(F.length(v).cast("string"), F.lit(":"), v) for v in (text.strip(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns)]), 256)
    rows = df.withColumn("_k", k).withColumn("_sig", signature).withColumn("_at", order)
    groups = (
        rows.where("_k != ''").groupBy("_k")
        .agg(F.count("*").alias("_n"), F.min("_sig").alias("_lo"), F.max("_sig").alias("_hi"), F.min("_at").alias("_first"))
        .where("_n > 1").select(F.col("_k").alias("_gk"), (F.col("_lo") != F.col("_hi")).alias("_conflict"), "_first")
    )
    reason = F.when(F.col("_conflict"), "duplicate_primary_key_conflict").when(F.col("_at") != F.col("_first"), "duplicate_record")
    return rows.join(groups, F.col("_k") == F.col("_gk"), "left").withColumn("_duplicate", reason).drop("_k", "_sig", "_at", "_gk", "_conflict", "_first")


def with_reasons(df: DataFrame, reasons: Sequence[Column]) -> DataFrame:
    """Adds ``_reasons``: the sorted set of reasons that are not null."""
    return df.withColumn(REASONS, F.array_sort(F.array_distinct(F.array_compact(F.array(*reasons)))))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.size(REASONS) == 0)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.size(REASONS) > 0)


def reason_histogram(df: DataFrame) -> DataFrame:
    """(reason, rows): a row counts once for each of its reasons."""
    return df.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def references(df: DataFrame, key: str, parents: DataFrame, parent_key: str, payload: Sequence[str] = ()) -> DataFrame:
    """Left join to unique parents; ``_known`` tells whether there is one."""
    keys = parents.select(F.col(parent_key).alias("_pk"), *[F.col(c).alias(f"_p_{c}") for c in payload], F.lit(True).alias("_known"))
    return df.join(keys, text.strip(F.coalesce(F.col(key).cast("string"), F.lit(""))) == F.col("_pk"), "left").drop("_pk").withColumn("_known", F.coalesce("_known", F.lit(False)))


@dataclass(frozen=True)
class SilverConfig:
    """How this delivery is to be read."""

    slash_date_order: str = "reject"
    numeric_sex_codes: dict[str, str] = field(default_factory=dict)

    def checked(self) -> SilverConfig:
        require(self.slash_date_order in times.ORDERS, "slash dates are rejected, dmy or mdy")
        codes = {k.strip(): v.strip().upper() for k, v in self.numeric_sex_codes.items()}
        require(all(k and v in ("M", "F") for k, v in codes.items()) and len(codes) == len(self.numeric_sex_codes), "numeric sex codes map to M or F, once each")
        return SilverConfig(self.slash_date_order, codes)


def _ordinal() -> Column:
    return F.col("_source_row_number").cast("long")


def classify_patients(df: DataFrame, config: SilverConfig) -> DataFrame:
    """Raw columns, standard ones as ``s_*``, and ``_reasons``."""
    config = config.checked()
    df = duplicate_reasons(df, "patient_id", S.PATIENTS, _ordinal())
    pid, source = text.strip(F.col("patient_id")), F.upper(text.strip(F.col("source_system")))
    born, born_reason = times.parse_date(F.col("date_of_birth"), "date_of_birth", config.slash_date_order)
    sex, sex_reason = text.sex(F.col("sex"), config.numeric_sex_codes)
    mismatch = (source == "LG") & ~pid.rlike(r"\ALG-[0-9]{6}\z") | (source == "RS") & ~pid.rlike(r"\ARS[0-9]{5}\z")
    df = df.withColumns({"s_patient_id": pid, "s_source_system": source, "s_first_name": F.col("first_name"), "s_last_name": F.col("last_name"),
                         "s_date_of_birth": born, "s_sex": sex, "s_phone": F.col("phone"), "s_state": F.col("state")})
    return with_reasons(df, [F.col("_duplicate"), F.when(pid == "", "missing_patient_id"), F.when(~source.isin("LG", "RS"), "invalid_source_system"),
                             F.when(mismatch, "patient_id_source_mismatch"), born_reason, sex_reason])


def classify_admissions(df: DataFrame, patients: DataFrame, config: SilverConfig) -> DataFrame:
    """``patients`` are the accepted ones, by ``patient_id``."""
    config = config.checked()
    df = references(duplicate_reasons(df, "admission_id", S.ADMISSIONS, _ordinal()), "patient_id", patients, "patient_id")
    hospital = F.when(F.lit(False), F.lit(None).cast("string"))
    for name in S.HOSPITALS:
        hospital = hospital.when(F.lower(text.strip(F.col("hospital"))) == name.lower(), name)
    status = F.lower(text.strip(F.col("discharge_status")))
    admit, admit_reason = times.parse_date(F.col("admit_date"), "admit_date", config.slash_date_order)
    left, left_reason = times.parse_date(F.col("discharge_date"), "discharge_date", config.slash_date_order)
    empty = text.blank(F.col("discharge_date"))
    code = text.icd10(F.col("diagnosis_code"))
    df = df.withColumns({"s_admission_id": text.strip(F.col("admission_id")), "s_patient_id": text.strip(F.col("patient_id")), "s_hospital": hospital,
                         "s_admit_date": admit, "s_discharge_date": left, "s_diagnosis_code": code, "s_discharge_status": status})
    return with_reasons(df, [
        F.col("_duplicate"), F.when(F.col("s_admission_id") == "", "missing_admission_id"), F.when(~F.col("_known"), "unknown_patient_id"),
        F.when(F.col("s_hospital").isNull(), "invalid_hospital"), F.when(~status.isin(*S.STATUSES), "invalid_discharge_status"), admit_reason,
        F.when(empty, F.when(status != "still_admitted", "missing_discharge_date")).otherwise(left_reason),
        F.when(~empty & (status == "still_admitted"), "unexpected_discharge_date_for_still_admitted"),
        F.when(F.col("s_discharge_date") < F.col("s_admit_date"), "discharge_before_admission"),
        F.when(F.col("s_diagnosis_code").isNull(), "invalid_diagnosis_code")])


def classify_labs(df: DataFrame, admissions: DataFrame, config: SilverConfig) -> DataFrame:
    """``admissions`` are the accepted ones, with dates."""
    config = config.checked()
    df = references(duplicate_reasons(df, "lab_id", S.LABS, _ordinal()), "admission_id", admissions, "admission_id", ("admit_date", "discharge_date"))
    lab = stats.convert_lab(F.col("test_name"), F.col("result_value"), F.col("unit"))
    at, offset, time_reason = times.parse_timestamp(F.col("result_time"), "result_time", config.slash_date_order)
    df = df.withColumns({"s_lab_id": text.strip(F.col("lab_id")), "s_admission_id": text.strip(F.col("admission_id")), "s_test_name": lab["test"], "s_result_value": lab["value"],
                         "s_unit": lab["unit"], "s_result_time": at, "s_had_offset": offset, "s_conversion_applied": lab["label"]})
    day = F.to_date("s_result_time")
    return with_reasons(df, [
        F.col("_duplicate"), F.when(F.col("s_lab_id") == "", "missing_lab_id"), F.when(~F.col("_known"), "unknown_admission_id"), lab["reason"], time_reason,
        F.when(day < F.col("_p_admit_date"), "result_before_admission"), F.when(day > F.col("_p_discharge_date"), "result_after_discharge")])


def _standard(df: DataFrame, columns: Sequence[str], extra: dict[str, Column] | None = None) -> DataFrame:
    return accepted(df).select(*[F.col(f"s_{c}").alias(c) for c in columns], *[c.alias(n) for n, c in (extra or {}).items()], *S.LINEAGE)


def _quarantine(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rejected(df).select(*columns, *S.LINEAGE, F.col(REASONS).alias(S.REASON_CODES))


@dataclass
class Silver:
    """Typed accepted tables, quarantines with reason arrays, classified rows."""

    accepted: dict[str, DataFrame]
    quarantine: dict[str, DataFrame]
    classified: dict[str, DataFrame]


def build_silver(patients: DataFrame, admissions: DataFrame, labs: DataFrame, config: SilverConfig = SilverConfig(), keep=stash) -> Silver:
    """Standardise in order of dependence: a refused parent refuses its children.

    ``keep`` holds each classified table, which feeds the accepted rows, the
    quarantine and the counters: by default it is written to shared scratch space.
    """
    p = keep(classify_patients(patients, config), "patients")
    clean_p = _standard(p, S.PATIENTS)
    a = keep(classify_admissions(admissions, clean_p, config), "admissions")
    clean_a = _standard(a, S.ADMISSIONS)
    x = keep(classify_labs(labs, clean_a, config), "lab_results")
    extras = {"result_value_original": F.col("result_value"), "unit_original": F.col("unit"), "conversion_applied": F.col("s_conversion_applied")}
    clean_x = accepted(x).select(*[F.col(f"s_{c}").alias(c) for c in S.LABS], *[c.alias(n) for n, c in extras.items()], F.col("s_had_offset").alias("had_offset"), *S.LINEAGE)
    return Silver({"patients": clean_p, "admissions": clean_a, "lab_results": clean_x},
                  {"patients": _quarantine(p, S.PATIENTS), "admissions": _quarantine(a, S.ADMISSIONS), "lab_results": _quarantine(x, S.LABS)},
                  {"patients": p, "admissions": a, "lab_results": x})


def reconcile(classified: DataFrame) -> dict[str, int]:
    """Row counts of the source and of both parts, which must add up."""
    got = classified.agg(F.count("*").alias("source"), F.count(F.when(F.size(REASONS) == 0, 1)).alias("accepted"), F.count(F.when(F.size(REASONS) > 0, 1)).alias("quarantined")).first().asDict()
    require(got["accepted"] + got["quarantined"] == got["source"], "accepted and quarantined rows do not add up")
    return got


def transformation_counts(silver: Silver) -> dict[str, dict[str, int]]:
    """What standardising changed in accepted rows."""
    def counts(name: str, **conditions: Column) -> dict[str, int]:
        return accepted(silver.classified[name]).agg(*[F.count(F.when(c, 1)).alias(k) for k, c in conditions.items()]).first().asDict()

    out = {
        "patients": counts("patients", date_of_birth_slash_to_iso=F.col("date_of_birth").contains("/"), sex_F=F.col("s_sex") == "F", sex_M=F.col("s_sex") == "M"),
        "admissions": counts("admissions", admit_date_slash_to_iso=F.col("admit_date").contains("/"), diagnosis_code_reformatted=F.col("s_diagnosis_code") != text.strip(F.col("diagnosis_code"))),
    }
    rows = accepted(silver.classified["lab_results"]).groupBy("s_conversion_applied").count().orderBy("s_conversion_applied").collect()  # six labels at most
    out["lab_results"] = {r[0]: r[1] for r in rows}
    return out


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, missing (blank when stripped), distinct values
    that are not missing.  No value of a record shows."""
    columns = list(columns or df.columns)
    values = [F.col(f"`{c}`").cast("string") for c in columns]
    # one exact distinct count per column without expanding the rows by each: long form, one pass
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), v.alias("v")) for c, v in zip(columns, values)])).alias("x")).select("x.*")
    per_value = long.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    empty = text.blank(F.col("v"))
    return per_value.groupBy("column_name").agg(
        F.sum("n").alias("row_count"), F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("missing_count"), F.count(F.when(~empty, 1)).alias("non_missing_distinct_count"))


def exact_duplicates(df: DataFrame) -> DataFrame:
    """One row: (row_count, exact_duplicate_row_count) over whole rows, nulls equal."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("exact_duplicate_row_count"))


