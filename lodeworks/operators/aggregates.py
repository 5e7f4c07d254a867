"""Disclosure-controlled aggregates: breakdowns, suppression, top and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import require, require_none
from ..functions import stats
from ..schemas import BREAKDOWN, DIMENSIONS, ELIGIBLE, EXCLUDED, HOSPITALS, METRICS, STATUSES


def metrics(positive: Column, negative: Column) -> dict[str, Column]:
    total = positive + negative
    low, high = stats.wilson_pct(positive, total)
    return dict(zip(METRICS, (total, positive, negative, stats.rate_pct(positive, total), low, high)))


def dimension_columns() -> dict[str, Column]:
    """The nine published dimensions of a feature table."""
    return dict(zip(DIMENSIONS, (
        F.col("hospital"), F.col("sex"), stats.age_band(F.col("age_at_admit")), F.col("diagnosis_group"), F.col("discharge_status"), stats.prior_band(F.col("prior_completed_admission_count")),
        stats.stay_band(F.col("length_of_stay_days")), F.date_format("discharge_date", "yyyy"), F.date_format("discharge_date", "yyyy-MM"))))


def eligible(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("label_status").isin(*ELIGIBLE))


def counts_by(rows: DataFrame, dimensions: dict[str, Column], label: str = "readmitted_30d") -> DataFrame:
    """(dimension, category, positive, negative) of all dimensions in one pass.

    Each row is read once and expanded by the dimensions; partial aggregation
    keeps the shuffle at one row per category and task.
    """
    one = F.array(*[F.struct(F.lit(d).alias("dimension"), c.cast("string").alias("category")) for d, c in dimensions.items()])
    long = rows.select(F.explode(one).alias("x"), F.col(label).alias("y")).select("x.*", "y")
    return long.groupBy("dimension", "category").agg(F.count(F.when(F.col("y") == 1, 1)).alias("positive"), F.count(F.when(F.col("y") == 0, 1)).alias("negative"))


def suppress(groups: DataFrame, by: list[str], small: Column, order: list[Column]) -> DataFrame:
    """Adds ``suppression_reason``: small cells are primary; where exactly one
    of several is, the least other cell in ``order`` hides it."""
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    rows = groups.withColumn("_small", F.coalesce(small, F.lit(False)))
    rows = rows.withColumn("_n_small", F.sum(F.col("_small").cast("int")).over(part))
    ranked = Window.partitionBy(*(by or [F.lit(1)]), "_small").orderBy(*order)
    least = (F.col("_n_small") == 1) & ~F.col("_small") & (F.row_number().over(ranked) == 1)
    reason = F.when(F.col("_small"), "primary_small_cell").when(least, "complementary_suppression").otherwise("")
    return rows.withColumn("suppression_reason", reason).drop("_small", "_n_small")


def breakdowns(rows: DataFrame, dimensions: dict[str, Column], least: int = 11, label: str = "readmitted_30d") -> DataFrame:
    """The long report of eligible rows; metrics of suppressed cells are null."""
    p, n = F.col("positive"), F.col("negative")
    groups = suppress(counts_by(rows, dimensions, label), ["dimension"], F.least(p, n) < least, [p + n, p, F.col("category")])
    shown = F.col("suppression_reason") == ""
    return groups.select("dimension", "category", *[F.when(shown, c).alias(name) for name, c in metrics(p, n).items()], "suppression_reason").select(*BREAKDOWN)


def overall(rows: DataFrame, entity: str, least: int = 11, label: str = "readmitted_30d") -> DataFrame:
    """One row of cohort counts and metrics."""
    p, n = F.count(F.when(F.col(label) == 1, 1)), F.count(F.when(F.col(label) == 0, 1))
    got = rows.agg(p.alias("p"), n.alias("n"), F.countDistinct(entity).alias("eligible_entities"))
    return got.select("eligible_entities", *[c.alias(name) for name, c in metrics(F.col("p"), F.col("n")).items()])


def require_cohort(total: DataFrame, least: int) -> None:
    got = total.first()
    require(min(got["eligible_entities"], got[METRICS[0]], got[METRICS[1]], got[METRICS[2]]) >= least, "the cohort is smaller than the least cell size")


def excluded_statuses(rows: DataFrame, least: int = 11) -> DataFrame:
    """(label_status, admissions, suppression_reason) of rows without a label."""
    groups = rows.where(F.col("label_status").isin(*EXCLUDED)).groupBy("label_status").agg(F.count("*").alias("n"))
    out = suppress(groups, [], F.col("n") < least, [F.col("n"), F.col("label_status")])
    return out.select("label_status", F.when(F.col("suppression_reason") == "", F.col("n")).alias("admissions"), "suppression_reason")


def released(report: DataFrame) -> DataFrame:
    return report.where("suppression_reason = ''")


def top_category(report: DataFrame, dimension: str) -> DataFrame:
    """The released category of the highest rate, then first by name."""
    return released(report).where(F.col("dimension") == dimension).orderBy(F.desc("readmission_rate_pct"), "category").limit(1)


def page(report: DataFrame, dimension: str | None = None, limit: int = 100, offset: int = 0) -> tuple[DataFrame, int]:
    """(rows, total) of one page in order of dimension and category."""
    require(1 <= limit <= 100 and 0 <= offset <= 10_000, "a page has 1 to 100 rows from 0 to 10000")
    require(dimension is None or dimension in DIMENSIONS, "unknown dimension")
    rows = report if dimension is None else report.where(F.col("dimension") == dimension)
    return rows.orderBy("dimension", "category").offset(offset).limit(limit), rows.count()


def gold_rules() -> dict[str, Column]:
    """Row rules of a feature table; true marks a bad row."""
    done, status, y = F.col("discharge_date").isNotNull(), F.col("label_status"), F.col("readmitted_30d")
    missing = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    outside = lambda c, *v: ~F.coalesce(F.col(c).isin(*v), F.lit(False))
    return {
        "blank admission_id": missing("admission_id"), "blank master_patient_id": missing("master_patient_id"), "unsupported hospital": outside("hospital", *HOSPITALS),
        "noncanonical sex": outside("sex", "M", "F"), "invalid diagnosis_group": ~F.coalesce(F.col("diagnosis_group").rlike(r"\A[A-Z][0-9]{2}\z"), F.lit(False)),
        "invalid discharge_status": outside("discharge_status", *STATUSES), "invalid chronology": F.col("discharge_date") < F.col("admit_date"),
        "open stay with an end": (F.col("discharge_status") == "still_admitted") & done, "closed stay without an end": (F.col("discharge_status") != "still_admitted") & ~done,
        "age outside 0 to 120": ~F.coalesce(F.col("age_at_admit").between(0, 120), F.lit(False)),
        "inconsistent length of stay": ~F.col("length_of_stay_days").eqNullSafe(F.datediff("discharge_date", "admit_date")),
        "negative or missing prior count": ~F.coalesce(F.col("prior_completed_admission_count") >= 0, F.lit(False)),
        "label and status disagree": ~y.eqNullSafe(F.when(status == "labeled_positive", 1).when(status == "labeled_negative", 0)),
        "eligible row of excluded status": status.isin(*ELIGIBLE) & outside("discharge_status", "home", "transferred"),
        "death exclusion conflicts": (status == "excluded_died") & (F.col("discharge_status") != "died"),
        "open exclusion conflicts": (status == "excluded_no_discharge") & (F.col("discharge_status") != "still_admitted"),
        "unsupported label_status": outside("label_status", *ELIGIBLE, *EXCLUDED), "blank rule version": missing("feature_rule_version"), "missing observation end": F.col("observation_end_date").isNull()}


def check_gold(gold: DataFrame) -> None:
    require(not gold.isEmpty(), "the feature table is empty")
    require_none(gold, gold_rules())
    require(gold.groupBy("admission_id").count().where("count > 1").isEmpty(), "admission ids repeat")
    got = gold.agg(F.countDistinct("observation_end_date").alias("e"), F.countDistinct("feature_rule_version").alias("v")).first()
    require(got["e"] == 1 and got["v"] == 1, "observation ends or rule versions are mixed")


def build_analytics(gold: DataFrame, least: int = 11, check: bool = True) -> dict[str, DataFrame]:
    """overall, breakdowns and excluded statuses of a feature table."""
    require(least >= 1, "the least cell size is 1")
    if check:
        check_gold(gold)
    rows = eligible(gold)
    total = overall(rows, "master_patient_id", least)
    if check:
        require_cohort(total, least)
    return {"overall": total, "breakdowns": breakdowns(rows, dimension_columns(), least), "excluded": excluded_statuses(gold, least)}
