"""History features, event summaries and censoring-aware labels of stays.

A stay has (stay_id, entity, site, admitted, left, grp, status); dates are
dates, ``left`` is null while the stay is open.  The interval self-joins of
history and label are windows over stays and look-ups merged on one time axis,
so an entity with k stays costs k log k, not k squared.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..errors import require, require_none
from ..functions import text, times
from ..schemas import GOLD, GOLD_BASE, GOLD_RULES, SUMMARIES, TESTS
from ..sources.scratch import stash

_BUCKET = 32


def _day(c: str) -> Column:
    return F.unix_date(F.col(c).cast("date"))


def follow_up(stays: DataFrame, observed_to: Column, days: int = 30) -> DataFrame:
    """Adds ``followed``: does another stay of the entity begin from the day
    this one ends to ``days`` later, and by ``observed_to``?

    Beginnings and ends meet within (entity, span of days): each beginning is
    put into its span and the one before, and each end looks within its own.
    So even an entity with a third of all stays is dealt over many tasks.
    """
    span = max(_BUCKET, days + 1)
    points = stays.where(F.col("admitted") <= observed_to).select("entity", _day("admitted").alias("day"))
    points = points.withColumn("span", F.explode(F.array(F.floor(F.col("day") / span), F.floor(F.col("day") / span) - 1)))
    points = points.select("entity", "span", "day", F.lit(1).alias("hit"), F.lit(None).cast("string").alias("stay_id"), F.lit(0).alias("own"))
    own = F.when((F.col("admitted") == F.col("left")) & (F.col("admitted") <= observed_to), 1).otherwise(0)
    ends = stays.where("left IS NOT NULL").select("entity", F.floor(_day("left") / span).alias("span"), _day("left").alias("day"), F.lit(0).alias("hit"), F.col("stay_id").cast("string").alias("stay_id"), own.alias("own"))
    ahead = Window.partitionBy("entity", "span").orderBy("day").rangeBetween(0, days)
    both = points.unionByName(ends).withColumn("near", F.sum("hit").over(ahead))
    found = both.where("stay_id IS NOT NULL AND near > own").select("stay_id", F.lit(True).alias("followed"))
    return stays.join(found.withColumnRenamed("stay_id", "_sid"), F.col("stay_id").cast("string") == F.col("_sid"), "left").drop("_sid").withColumn("followed", F.coalesce("followed", F.lit(False)))


def label(stays: DataFrame, observed_to: Column, days: int = 30) -> DataFrame:
    """Adds ``readmitted_30d`` (1, 0 or null) and ``label_status``.

    Deaths and open stays are excluded first; a follow-up counts even if the
    window is cut short; without one the window must be fully observed.
    """
    rows = follow_up(stays, observed_to, days)
    whole = F.date_add("left", days) <= observed_to
    status = (F.when(F.col("status") == "died", "excluded_died").when(F.col("left").isNull(), "excluded_no_discharge").when(F.col("followed"), "labeled_positive")
              .when(whole, "labeled_negative").otherwise("censored_incomplete_30d_followup"))
    rows = rows.withColumn("label_status", status)
    value = F.when(F.col("label_status") == "labeled_positive", 1).when(F.col("label_status") == "labeled_negative", 0)
    return rows.withColumn("readmitted_30d", value).drop("followed")


def history(stays: DataFrame) -> DataFrame:
    """Adds six features of the entity's other stays that ended by admission.

    Ends are points and admissions look-ups on the entity's time axis; a stay
    that ends on its own day of admission takes itself out again.
    """
    s = stays.withColumn("_a", _day("admitted")).withColumn("_l", _day("left"))
    ends = s.where("_l IS NOT NULL").select("entity", "site", "grp", F.col("_l").alias("day"), F.lit(1).alias("hit"), F.lit(None).cast("string").alias("sid"), F.lit(0).alias("own"))
    looks = s.select("entity", "site", "grp", F.col("_a").alias("day"), F.lit(0).alias("hit"), F.col("stay_id").cast("string").alias("sid"), F.when(F.col("_a") == F.col("_l"), 1).otherwise(0).alias("own"))
    # the first end of the entity at each site
    first = Window.partitionBy("entity", "site").orderBy("day", F.desc("hit"))
    both = ends.unionByName(looks).withColumn("_prev", F.coalesce(F.sum("hit").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    both = both.withColumn("first_at_site", F.when((F.col("hit") == 1) & (F.col("_prev") == 0), 1).otherwise(0))
    at = Window.partitionBy("entity").orderBy("day")
    upto, same_day = at.rangeBetween(Window.unboundedPreceding, 0), at.rangeBetween(0, 0)
    site, grp = (Window.partitionBy("entity", c).orderBy("day").rangeBetween(Window.unboundedPreceding, 0) for c in ("site", "grp"))
    hit = F.col("hit")
    both = both.withColumns({
        "n": F.sum(hit).over(upto), "n30": F.sum(hit).over(at.rangeBetween(-30, 0)), "n365": F.sum(hit).over(at.rangeBetween(-365, 0)), "today": F.sum(hit).over(same_day),
        "sites": F.sum("first_at_site").over(upto), "n_site": F.sum(hit).over(site), "n_grp": F.sum(hit).over(grp),
        "before": F.max(F.when(hit == 1, F.col("day"))).over(at.rangeBetween(Window.unboundedPreceding, -1))})
    own = F.col("own")
    gap = F.when(F.col("today") - own > 0, 0).otherwise(F.col("day") - F.col("before"))
    found = both.where("sid IS NOT NULL").select(
        F.col("sid").alias("_sid"), (F.col("n") - own).cast("int").alias("prior_completed_admission_count"), (F.col("n30") - own).cast("int").alias("prior_admission_30d_count"),
        (F.col("n365") - own).cast("int").alias("prior_admission_365d_count"), (F.col("n_grp") - own).cast("int").alias("prior_same_diagnosis_group_count"),
        # the own site counts if another stay there has ended
        (F.col("sites") - F.when(F.col("n_site") > 0, 1).otherwise(0) + F.when(F.col("n_site") - own > 0, 1).otherwise(0)).cast("int").alias("prior_distinct_hospital_count"),
        gap.cast("int").alias("days_since_prior_discharge"))
    return stays.join(found, F.col("stay_id").cast("string") == F.col("_sid")).drop("_sid")


def event_summary(events: DataFrame, group: str, kind: str, kinds: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """One row per group: for every kind its count, first, latest, min, max and
    mean, in order of ``order`` (which should break all ties).  One pass, with
    partial aggregation."""
    by = F.struct(*[F.col(c) for c in order])
    rounded = lambda c: F.round(c.cast("decimal(38,6)"), 3).cast("decimal(38,3)")
    out = []
    for k in kinds:
        mine = F.when(F.col(kind) == k, F.col(value))
        when = F.when(F.col(kind) == k, by)
        n = F.count(mine)
        out += [n.cast("int").alias(f"{k}_count"), rounded(F.min_by(mine, when)).alias(f"{k}_first"), rounded(F.max_by(mine, when)).alias(f"{k}_latest"),
                rounded(F.min(mine)).alias(f"{k}_min"), rounded(F.max(mine)).alias(f"{k}_max"), rounded(F.sum(mine).cast("decimal(38,10)") / n).alias(f"{k}_mean")]
    return events.groupBy(group).agg(*out)


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: keys in both tables, and in one only (full outer join)."""
    a, b = left.select(F.col(key).alias("_l")).distinct(), right.select(F.col(key).alias("_r")).distinct()
    both = a.join(b, F.col("_l") == F.col("_r"), "full_outer")
    return both.agg(F.count(F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), 1)).alias("in_both"), F.count(F.when(F.col("_r").isNull(), 1)).alias("left_only"), F.count(F.when(F.col("_l").isNull(), 1)).alias("right_only"))


def _unique(df: DataFrame, key: str, what: str) -> None:
    bad = df.groupBy(key).count().where(F.col("count").__gt__(1) | text.blank(F.col(key)))
    require(bad.isEmpty(), f"{what} has blank or repeated {key}")


def build_gold(patients: DataFrame, admissions: DataFrame, labs: DataFrame, master: DataFrame, observation_end: date, rules: str = GOLD_RULES, check: bool = True, keep=stash) -> DataFrame:
    """The feature table: one row per admission, no direct identifiers.

    Inputs are the typed tables that standardising gives, and the master map.
    All contracts are checked before a row is built.  ``keep`` holds the stays,
    which several steps use: by default they are written to shared scratch space.
    """
    end = F.lit(observation_end)
    if check:
        _unique(patients, "patient_id", "patients")
        _unique(master, "patient_id", "patient master")
        _unique(admissions, "admission_id", "admissions")
        _unique(labs, "lab_id", "lab results")
        got = coverage(patients, master, "patient_id").first()
        require(got["left_only"] == 0 and got["right_only"] == 0, "patient master does not cover the patients")
        pairs = patients.select("patient_id", F.col("source_system").alias("_s")).join(master, "patient_id")
        require_none(pairs, {"master id is blank": text.blank(F.col("master_patient_id")), "source systems differ": F.col("_s") != F.col("source_system")})
        require(admissions.join(patients, "patient_id", "left_anti").isEmpty(), "an admission has no patient")
        require(labs.join(admissions, "admission_id", "left_anti").isEmpty(), "a lab result has no admission")
        require_none(admissions, {"admission is after the observation end": F.col("admit_date") > end, "stay ends before it begins": F.col("discharge_date") < F.col("admit_date"),
                                  "open stay has an end": (F.col("discharge_status") == "still_admitted") & F.col("discharge_date").isNotNull(),
                                  "closed stay has no end": (F.col("discharge_status") != "still_admitted") & F.col("discharge_date").isNull(),
                                  "diagnosis is too short": text.diagnosis_group(F.col("diagnosis_code")).isNull()})
    who = patients.select("patient_id", "date_of_birth", "sex").join(master.select("patient_id", "master_patient_id"), "patient_id")
    stays = admissions.join(who, "patient_id").select(
        F.col("admission_id").alias("stay_id"), F.col("master_patient_id").alias("entity"), F.col("hospital").alias("site"), F.col("admit_date").alias("admitted"), F.col("discharge_date").alias("left"),
        text.diagnosis_group(F.col("diagnosis_code")).alias("grp"), F.col("discharge_status").alias("status"), times.completed_years(F.col("date_of_birth"), F.col("admit_date")).alias("age_at_admit"), "sex")
    stays = keep(stays, "stays")
    if check:
        require_none(stays, {"age is outside 0 to 120": ~F.col("age_at_admit").between(0, 120)})
    rows = history(keep(label(stays, end), "labelled"))
    labs = labs.withColumn("result_value", F.col("result_value").cast("decimal(34,6)"))
    summary = event_summary(labs, "admission_id", "test_name", TESTS, "result_value", ["result_time", "lab_id"]).withColumnRenamed("admission_id", "_aid")
    rows = rows.join(summary, F.col("stay_id") == F.col("_aid"), "left").drop("_aid")
    names = {"admission_id": "stay_id", "master_patient_id": "entity", "hospital": "site", "admit_date": "admitted", "discharge_date": "left", "diagnosis_group": "grp", "discharge_status": "status"}
    out = {n: F.col(names.get(n, n)) for n in GOLD_BASE if n != "length_of_stay_days"}
    out["length_of_stay_days"] = F.datediff("left", "admitted")
    out.update({f"{t}_{s}": F.coalesce(F.col(f"{t}_count"), F.lit(0)) if s == "count" else F.col(f"{t}_{s}") for t in TESTS for s in SUMMARIES})
    out.update({"readmitted_30d": F.col("readmitted_30d"), "label_status": F.col("label_status"), "observation_end_date": end, "feature_rule_version": F.lit(rules)})
    return rows.select(*[out[n].alias(n) for n in GOLD])


def gold_audit(gold: DataFrame) -> dict:
    """Row, label and test counts of a feature table."""
    named = F.when(F.col("readmitted_30d") == 1, "positive").when(F.col("readmitted_30d") == 0, "negative").otherwise("unlabeled")
    by = lambda c: {r[0]: r[1] for r in gold.groupBy(c.alias("k")).count().orderBy("k").collect()}  # noqa: E731  a few statuses
    got = gold.agg(F.count("*").alias("gold_rows"), F.countDistinct("master_patient_id").alias("masters"), *[F.count(F.when(F.col(f"{t}_count") > 0, 1)).alias(t) for t in TESTS]).first()
    return {"rule_version": GOLD_RULES, "gold_rows": got["gold_rows"], "gold_unique_master_patients": got["masters"], "label_counts": by(named), "label_status_counts": by(F.col("label_status")),
            "lab_presence_counts": {t: got[t] for t in TESTS if got[t]}}
