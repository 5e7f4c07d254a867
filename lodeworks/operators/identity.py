"""Linking records of one entity across two sources.

Candidates come from a union of equi-joins (blocks), evidence is scored per
pair, rules decide, and links are one to one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import require, require_none
from ..functions import text
from ..schemas import IDENTITY_RULES, REVIEW_INPUT
from ..sources.scratch import stash

PAIR = ["lg_patient_id", "rs_patient_id"]
FIELDS = ("patient_id", "first_name", "last_name", "date_of_birth", "sex", "phone", "state")


def normalise(patients: DataFrame, fold=text.fold) -> DataFrame:
    """The fields that matching compares, folded; ids must be present and unique."""
    rows = patients.select(
        text.strip(F.col("patient_id")).alias("patient_id"), F.upper(text.strip(F.col("source_system"))).alias("source_system"),
        fold(F.col("first_name")).alias("first_name"), fold(F.col("last_name")).alias("last_name"), F.col("date_of_birth").cast("date").alias("date_of_birth"),
        F.upper(text.strip(F.coalesce(F.col("sex"), F.lit("")))).alias("sex"), text.phone(F.col("phone")).alias("phone"), fold(F.col("state")).alias("state"))
    return rows


def check_patients(rows: DataFrame) -> None:
    require_none(rows, {"patient id is blank": text.blank(F.col("patient_id")), "source is not LG or RS": ~F.coalesce(F.col("source_system").isin("LG", "RS"), F.lit(False)), "birth date is missing": F.col("date_of_birth").isNull()})
    require(rows.groupBy("patient_id").count().where("count > 1").isEmpty(), "patient ids are not unique")


def deletion_signatures(phone: Column) -> Column:
    """(length, place, the rest) for every place of a text; equal-length texts
    with one changed character share one signature."""
    at = F.when(F.length(phone) > 1, F.sequence(F.lit(1), F.length(phone))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(F.length(phone).alias("n"), i.alias("i"), F.concat(F.substring(phone, F.lit(1), i - 1), F.substring(phone, i + 1, F.length(phone))).alias("rest")))


def block_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, keys: list[list[str]]) -> DataFrame:
    """Distinct id pairs that agree on all columns of one of ``keys``; a blank
    or null component disables a block.  One equi-join per key, never an OR."""
    out = None
    for key in keys:
        usable = text.any_of([F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in key])
        a = left.where(~usable).select(F.col(left_id).alias("_l"), *key)
        b = right.where(~usable).select(F.col(right_id).alias("_r"), *key)
        pairs = a.join(b, key).select("_l", "_r")
        out = pairs if out is None else out.unionByName(pairs)
    return out.distinct()


def candidates(rows: DataFrame) -> DataFrame:
    """(lg_patient_id, rs_patient_id) of all blocks, the fuzzy one included."""
    lg, rs = rows.where("source_system = 'LG'"), rows.where("source_system = 'RS'")
    exact = block_pairs(lg, rs, "patient_id", "patient_id", [["phone"], ["date_of_birth", "sex", "state"], ["first_name", "last_name", "sex", "state"]])
    sig = lambda df: df.where("phone != ''").select("patient_id", F.explode(deletion_signatures(F.col("phone"))).alias("s"))
    near = sig(lg).select(F.col("patient_id").alias("_l"), "s").join(sig(rs).select(F.col("patient_id").alias("_r"), "s"), "s").select("_l", "_r")
    return exact.unionByName(near).distinct().select(F.col("_l").alias(PAIR[0]), F.col("_r").alias(PAIR[1]))


def _phones(rows: DataFrame) -> DataFrame:
    """How often each phone occurs in its source."""
    return rows.where("phone != ''").groupBy("source_system", "phone").agg(F.count("*").alias("phone_count"))


def score(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Evidence, conflicts, points, rule and eligibility of every pair."""
    counts = _phones(rows)
    full = rows.join(counts, ["source_system", "phone"], "left")
    side = lambda s, p, i: full.where(F.col("source_system") == s).select(F.col("patient_id").alias(i), *[F.col(c).alias(f"{p}_{c}") for c in (*FIELDS[1:], "phone_count")])
    both = pairs.join(side("LG", "l", PAIR[0]), PAIR[0]).join(side("RS", "r", PAIR[1]), PAIR[1])
    l, r = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))  # noqa: E741
    same = lambda c: (l(c) != "") & (l(c) == r(c))
    facts = {
        "phone_exact": same("phone"),
        "phone_near": (F.length(l("phone")) == F.length(r("phone"))) & text.one_edit(l("phone"), r("phone")),
        "dob": l("date_of_birth") == r("date_of_birth"),
        "year": F.year(l("date_of_birth")) == F.year(r("date_of_birth")),
        "month_day": F.date_format(l("date_of_birth"), "MMdd") == F.date_format(r("date_of_birth"), "MMdd"),
        "first": same("first_name"), "last": same("last_name"),
        "first_near": text.one_edit(l("first_name"), r("first_name")), "last_near": text.one_edit(l("last_name"), r("last_name")),
        "sex": same("sex"), "state": same("state"),
    }
    facts["unique"] = facts["phone_exact"] & (l("phone_count") == 1) & (r("phone_count") == 1)
    both = both.select(*PAIR, *[F.coalesce(c, F.lit(False)).alias(f"f_{n}") for n, c in facts.items()])
    return both.select(*PAIR, *decide({n: F.col(f"f_{n}") for n in facts}))


def decide(f: dict[str, Column]) -> list[Column]:
    """Score, codes, rule and eligibility from the boolean facts of a pair."""
    #: fixed values: codes and points of the evidence, in order
    evidence = [
        (f["phone_exact"], "PHONE_EXACT", 50), (f["phone_near"], "PHONE_EDIT_DISTANCE_1", 30), (f["dob"], "DOB_EXACT", 25),
        (~f["dob"] & f["year"], "BIRTH_YEAR_EXACT", 8), (~f["dob"] & f["month_day"], "BIRTH_MONTH_DAY_EXACT", 8),
        (f["first"], "FIRST_NAME_EXACT", 10), (f["first_near"], "FIRST_NAME_EDIT_DISTANCE_1", 5),
        (f["last"], "LAST_NAME_EXACT", 15), (f["last_near"], "LAST_NAME_EDIT_DISTANCE_1", 7),
        (f["sex"], "SEX_EXACT", 5), (f["state"], "STATE_EXACT", 5), (f["unique"], "PHONE_UNIQUE_BOTH_SOURCES", 5)]
    conflicts = [(~f["phone_exact"], "PHONE_DIFFERS"), (~f["dob"], "DOB_DIFFERS"), (~f["first"], "FIRST_NAME_DIFFERS"), (~f["last"], "LAST_NAME_DIFFERS"),
                 (~f["sex"], "SEX_DIFFERS"), (~f["state"], "STATE_DIFFERS"), (f["phone_exact"] & ~f["unique"], "PHONE_NOT_UNIQUE")]
    place = f["sex"] & f["state"]
    auto = f["unique"] & place & f["last"] & (f["dob"] | f["first"])
    review = place & text.any_of([
        f["phone_near"] & (f["dob"] | (f["first"] & f["last"])),
        f["dob"] & ((f["first"] & (f["last"] | f["last_near"])) | (f["last"] & f["first_near"])),
        f["first"] & f["last"] & ~f["dob"] & (f["year"] | f["month_day"]),
        f["phone_exact"] & ~f["unique"] & (f["dob"] | f["last"])])
    rule = (F.when(auto & f["dob"], "UNIQUE_PHONE_DOB_LAST").when(auto, "UNIQUE_PHONE_FULL_NAME").when(f["phone_near"], "NEAR_PHONE_WITH_CORROBORATION")
            .when(f["dob"], "EXACT_DOB_WITH_NEAR_NAME").when(f["first"] & f["last"], "EXACT_FULL_NAME_WITH_BIRTH_COMPONENT").otherwise("NON_UNIQUE_PHONE_WITH_CORROBORATION"))
    points = sum((F.when(c, n).otherwise(0) for c, _, n in evidence), F.lit(0))
    return [points.cast("int").alias("match_score"), text.listed_codes(*[(c, k) for c, k, _ in evidence]).alias("evidence_codes"),
            text.listed_codes(*conflicts).alias("conflict_codes"), rule.alias("decision_rule"), auto.alias("auto_eligible"), review.alias("review_eligible")]


def with_degrees(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Adds ``one_to_one``: is each end in no other pair?  Degrees are combined
    before the shuffle and joined back, so a hub does not gather in one task."""
    l = pairs.groupBy(left).agg(F.count("*").alias("_dl"))  # noqa: E741
    r = pairs.groupBy(right).agg(F.count("*").alias("_dr"))
    return pairs.join(l, left).join(r, right).withColumn("one_to_one", (F.col("_dl") == 1) & (F.col("_dr") == 1)).drop("_dl", "_dr")


def split_decisions(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(automatic links, review candidates)."""
    auto_all = with_degrees(scored.where("auto_eligible"), *PAIR)
    auto = auto_all.where("one_to_one").drop("one_to_one")
    linked = auto.select(F.explode(F.array(*PAIR)).alias("_id"))
    free = scored.join(linked, F.col(PAIR[0]) == F.col("_id"), "left_anti").join(linked, F.col(PAIR[1]) == F.col("_id"), "left_anti")
    clash = F.col("auto_eligible")
    codes = F.when(clash, F.array_sort(F.array_append("conflict_codes", F.lit("AUTO_CANDIDATE_COLLISION")))).otherwise(F.col("conflict_codes"))
    review = free.where("auto_eligible OR review_eligible").withColumn("conflict_codes", codes).withColumn("decision_rule", F.when(clash, "AUTO_CANDIDATE_COLLISION").otherwise(F.col("decision_rule")))
    return auto, review


@dataclass
class Identity:
    """The tables of one resolution: master, decisions, queue, and its counts."""

    master: DataFrame
    decisions: DataFrame
    queue: DataFrame
    candidates: DataFrame


def check_reviews(reviews: DataFrame, cases: DataFrame) -> None:
    """Decisions name known cases once, with reviewer and a time with offset."""
    require(list(reviews.columns) == list(REVIEW_INPUT), "review decisions do not have their columns")
    require(reviews.join(cases.select("review_case_id"), "review_case_id", "left_anti").isEmpty(), "a review decision names an unknown case")
    require(reviews.groupBy("review_case_id").count().where("count > 1").isEmpty(), "a case has several review decisions")
    zone = r"(?:Z|[+-][0-9]{2}:?[0-9]{2})\z"
    require_none(reviews, {"decision is not ACCEPT, REJECT or ABSTAIN": ~F.coalesce(F.col("decision").isin("ACCEPT", "REJECT", "ABSTAIN"), F.lit(False)), "reviewer is blank": text.blank(F.col("reviewer_id")),
                           "review time has no offset": ~F.coalesce(F.col("reviewed_at_utc").rlike(zone), F.lit(False))})


def resolve(patients: DataFrame, key: bytes, reviews: DataFrame | None = None, token=text.token, fold=text.fold, check: bool = True, keep=stash) -> Identity:
    """Link the patients of sources LG and RS and name their masters.

    Automatic links need unique phones and one-to-one degree; other plausible
    pairs queue for review; an accepted review links unless an end is linked
    already, which aborts.  ``token`` makes the keyed names.  ``keep`` holds the
    tables that several results use: by default they are written to shared scratch space.
    """
    require(len(key) >= 32, "the key must have at least 32 bytes")
    rows = keep(normalise(patients, fold), "normalised")
    if check:
        check_patients(rows)
    pairs = keep(candidates(rows), "pairs")
    auto, review = split_decisions(keep(score(pairs, rows), "scored"))
    auto = keep(auto.withColumn("match_case_id", token(key, "MT", *map(F.col, PAIR))), "auto")
    cases = keep(review.withColumn("review_case_id", token(key, "RV", *map(F.col, PAIR))), "cases")
    if reviews is None:
        reviews = patients.sparkSession.createDataFrame([], ", ".join(f"{c} string" for c in REVIEW_INPUT))
    elif check:
        check_reviews(reviews, cases)
    cases = cases.join(reviews, "review_case_id", "left").withColumn(
        "review_status", F.when(F.col("decision").isNull(), "PENDING").when(F.col("decision") == "ACCEPT", "ACCEPTED").when(F.col("decision") == "REJECT", "REJECTED").otherwise("ABSTAINED"))
    human = cases.where("review_status = 'ACCEPTED'").select(*PAIR, F.lit("HUMAN").alias("by"), F.col("review_case_id").alias("match_case_id"))
    links = auto.select(*PAIR, F.lit("AUTO").alias("by"), "match_case_id").unionByName(human)
    if check:
        ends = links.select(F.explode(F.array(*PAIR)).alias("id"))
        require(ends.groupBy("id").count().where("count > 1").isEmpty(), "accepted reviews break the one-to-one rule")
    both_ways = links.select(F.col(PAIR[0]).alias("patient_id"), F.col(PAIR[1]).alias("other"), "by", "match_case_id").unionByName(
        links.select(F.col(PAIR[1]).alias("patient_id"), F.col(PAIR[0]).alias("other"), "by", "match_case_id"))
    touched = cases.where("review_status != 'ACCEPTED'").select(F.explode(F.array(*PAIR)).alias("patient_id"), F.when(F.col("review_status") == "REJECTED", 1).otherwise(2).alias("level"))
    touched = touched.groupBy("patient_id").agg(F.max("level").alias("level"))  # pending wins over rejected
    master = rows.select("patient_id", "source_system").join(both_ways, "patient_id", "left").join(touched, "patient_id", "left")
    me = F.concat_ws(":", "source_system", "patient_id")
    other = F.concat_ws(":", F.when(F.col("source_system") == "LG", "RS").otherwise("LG"), "other")
    component = F.when(F.col("other").isNull(), me).otherwise(F.array_join(F.array_sort(F.array(me, other)), "|"))
    status = (F.when(F.col("by") == "AUTO", "AUTO_MATCHED").when(F.col("by") == "HUMAN", "HUMAN_MATCHED").when(F.col("level") == 2, "REVIEW_PENDING").when(F.col("level") == 1, "REVIEW_REJECTED").otherwise("UNMATCHED"))
    master = master.withColumn("_component", component).select(
        token(key, "MP", F.col("_component"), length=24).alias("master_patient_id"), "patient_id", "source_system", status.alias("link_status"),
        F.coalesce("match_case_id", F.lit("")).alias("match_case_id"), F.lit(IDENTITY_RULES).alias("rule_version"))
    blank = F.lit("")
    common = ["match_score", "evidence_codes", "conflict_codes", "decision_rule", F.lit(IDENTITY_RULES).alias("rule_version")]
    decisions = auto.select("match_case_id", *PAIR, F.lit("ACCEPT").alias("decision"), F.lit("AUTOMATED_RULE").alias("decision_source"), *common,
                            blank.alias("reviewer_id"), blank.alias("reviewed_at_utc"), blank.alias("review_notes")).unionByName(
        cases.where("review_status != 'PENDING'").select(F.col("review_case_id").alias("match_case_id"), *PAIR, "decision", F.lit("HUMAN_REVIEW").alias("decision_source"), *common, "reviewer_id", "reviewed_at_utc", "review_notes"))
    queue = cases.select("review_case_id", *PAIR, "review_status", *common, *[F.coalesce(c, blank).alias(c) for c in ("reviewer_id", "reviewed_at_utc", "review_notes")])
    return Identity(master, decisions, queue, pairs)


def audit(found: Identity) -> dict:
    """Counts of one resolution; the one-to-one proof is among them."""
    by = lambda df, c: {r[0]: r[1] for r in df.groupBy(c).count().orderBy(c).collect()}  # noqa: E731  few rules and statuses
    m = found.master.agg(F.count("*").alias("rows"), F.countDistinct("master_patient_id").alias("unique"), F.count(F.when(F.col("link_status").isin("AUTO_MATCHED", "HUMAN_MATCHED"), 1)).alias("linked"),
                         F.count(F.when(F.col("link_status") == "REVIEW_PENDING", 1)).alias("pending"), F.countDistinct(F.when(F.col("link_status") == "REVIEW_PENDING", F.col("master_patient_id"))).alias("pending_masters")).first()
    auto = found.decisions.where("decision_source = 'AUTOMATED_RULE'")
    statuses, rules = by(found.queue, "review_status"), by(auto, "decision_rule")
    n_auto, n_review, accepted, pairs = sum(rules.values()), sum(statuses.values()), statuses.get("ACCEPTED", 0), found.candidates.count()
    return {"rule_version": IDENTITY_RULES, "input_patients": m["rows"], "source_counts": by(found.master, "source_system"), "candidate_pairs_generated": pairs, "auto_matches": n_auto,
            "human_accepted_matches": accepted, "review_candidates": n_review, "review_status_counts": statuses, "master_patient_rows": m["rows"], "unique_master_patients": m["unique"],
            "linked_source_rows": m["linked"], "review_pending_source_rows": m["pending"], "pending_masters": m["pending_masters"], "unlinked_source_rows": m["rows"] - m["linked"],
            "auto_rule_counts": rules, "review_rule_counts": by(found.queue, "decision_rule"), "low_confidence_pairs_not_queued": pairs - n_auto - n_review,
            "one_to_one_constraint_passed": m["linked"] == 2 * (n_auto + accepted)}


def workload(audit_: dict) -> dict:
    """Automatic links, reviews sent and their outcomes, reconciled."""
    statuses, review = audit_["review_status_counts"], audit_["review_candidates"]
    done = {k: statuses.get(k.upper(), 0) for k in ("accepted", "rejected", "abstained")}
    pending = review - sum(done.values())
    require(audit_["human_accepted_matches"] == done["accepted"] and pending >= 0, "identity review counts do not reconcile")
    return {"automatic_matches": audit_["auto_matches"], "sent_for_human_review": review, "human_review_outcomes": {**done, "pending": pending}}
