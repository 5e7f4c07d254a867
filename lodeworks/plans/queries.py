"""The registered queries: operators applied to the star-schema tables.

Orders stand in for stays (an order's customer, or pair of customers, is the
entity), line items for events, customers and suppliers for the two sources of
records.  Each query reads its whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats, text, times
from ..operators import aggregates, answers, features, identity, learn, quality
from ..sources.scratch import stash
from . import release

#: The last order date at every scale; stays are observed until then.
OBSERVED = dt.date(2001, 8, 1)
CUTOFF = dt.date(1998, 1, 1)
#: A key for tests only: it may stand in a plan.
TEST_KEY = b"0123456789abcdef0123456789abcdef"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stays(spark: SparkSession, sf_dir: str, pair: bool = True) -> DataFrame:
    """Orders as stays of the customer, or of the pair of customers."""
    k = F.col("o_orderkey")
    entity = F.floor(F.col("o_custkey") / 2) if pair else F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("stay_id"), entity.cast("long").alias("entity"), F.col("o_orderpriority").alias("site"), F.to_date("o_orderdate").alias("admitted"),
        F.date_add(F.to_date("o_orderdate"), (k % 10).cast("int")).alias("left"), F.concat(F.lit("G"), F.lpad((k % 23).cast("string"), 2, "0")).alias("grp"),
        F.when(F.col("o_orderstatus") == "F", "home").when(F.col("o_orderstatus") == "O", "transferred").otherwise("died").alias("status"), F.col("o_custkey").alias("local_id"))


def cohort(spark: SparkSession, sf_dir: str, pair: bool = True) -> DataFrame:
    """Labelled stays with the columns that the breakdowns use."""
    rows = features.history(features.label(stays(spark, sf_dir, pair), F.lit(OBSERVED)))
    return rows.select(
        F.col("stay_id").alias("admission_id"), F.col("entity").alias("master_patient_id"), F.col("site").alias("hospital"), F.when(F.col("local_id") % 2 == 0, "M").otherwise("F").alias("sex"),
        (F.col("local_id") % 100).cast("int").alias("age_at_admit"), F.col("grp").alias("diagnosis_group"), F.col("status").alias("discharge_status"), "prior_completed_admission_count",
        F.datediff("left", "admitted").alias("length_of_stay_days"), F.col("admitted").alias("admit_date"), F.col("left").alias("discharge_date"), "readmitted_30d", "label_status", "local_id")


@query
def profile_columns(spark, sf_dir):
    return quality.profile(table(spark, sf_dir, "customer"))


@query
def exact_duplicate_rows(spark, sf_dir):
    return quality.exact_duplicates(table(spark, sf_dir, "documents").select("text", "lang"))


@query
def date_parse_reasons(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    raw = (F.when(k % 6 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 6 == 1, F.date_format(d, "d/M/yyyy")).when(k % 6 == 2, " ").when(k % 6 == 3, F.concat(F.lit("31/02/"), F.year(d)))
           .when(k % 6 == 4, F.concat(F.lit(" "), F.date_format(d, "dd/MM/yyyy"), F.lit("\t"))).otherwise(F.date_format(d, "yyyyMMdd")))
    value, reason = times.parse_date(F.col("raw"), "order_date", "dmy")
    return table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw")).select("o_orderkey", value.cast("string").alias("order_date"), F.coalesce(reason, F.lit("")).alias("reason"))


@query
def timestamp_normalise(spark, sf_dir):
    k, t = F.col("event_id"), F.col("ts")
    raw = F.when(k % 4 == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).when(k % 4 == 1, F.concat(F.date_format(t, "yyyy-MM-dd'T'HH:mm"), F.lit("+02:00"))).when(k % 4 == 2, F.date_format(t, "d/M/yyyy HH:mm")).otherwise(F.date_format(t, "yyyy-MM-dd"))
    value, offset, reason = times.parse_timestamp(F.col("raw"), "ts", "dmy")
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).select("event_id", value.alias("v"), offset.alias("o"), F.coalesce(reason, F.lit("")).alias("reason"))
    return rows.select("event_id", times.format_timestamp(F.col("v"), F.coalesce("o", F.lit(False))).alias("at_utc"), "reason")


@query
def code_normalise(spark, sf_dir):
    k = F.col("p_partkey")
    raw = F.concat(F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (k % 26 + 1).cast("int"), F.lit(1)), (k % 90 + 10).cast("string"), F.when(k % 4 == 0, ".5").when(k % 4 == 1, "").when(k % 4 == 2, " 7x").otherwise("-"))
    return table(spark, sf_dir, "part").select("p_partkey", text.icd10(raw).alias("code"), text.diagnosis_group(text.icd10(raw)).alias("code_group"))


@query
def id_source_predicate(spark, sf_dir):
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 4 == 0, F.concat(F.lit("LG-"), F.lpad(k.cast("string"), 6, "0"))).when(k % 4 == 1, F.concat(F.lit("RS"), F.lpad(k.cast("string"), 5, "0"))).when(k % 4 == 2, "").otherwise(F.concat(F.lit("LG-"), k.cast("string"))).alias("pid"),
                                                   F.when(k % 5 == 0, "XX").when(k % 4 == 1, "rs ").otherwise(" LG").alias("src"))
    pid, src = text.strip(F.col("pid")), F.upper(text.strip(F.col("src")))
    bad = (src == "LG") & ~pid.rlike(r"\ALG-[0-9]{6}\z") | (src == "RS") & ~pid.rlike(r"\ARS[0-9]{5}\z")
    codes = text.sorted_codes((pid == "", "missing_patient_id"), (~src.isin("LG", "RS"), "invalid_source_system"), (bad, "patient_id_source_mismatch"))
    return rows.select("c_custkey", F.array_join(codes, ";").alias("reasons"))


@query
def unit_convert(spark, sf_dir):
    k = F.col("p_partkey")
    tests, units = ["Glucose", "HEMOGLOBIN", "creatinine", "sodium"], ["mg/dL", "mmol/L", "g/L", "µmol/L", "g/dl"]
    pick = lambda xs, m: F.element_at(F.array(*map(F.lit, xs)), (m % len(xs) + 1).cast("int"))
    value = F.when(k % 17 == 0, "NaN").when(k % 19 == 0, "-1").otherwise(F.concat(F.col("p_size").cast("string"), F.lit("."), (k % 100).cast("string")))
    got = stats.convert_lab(pick(tests, k), value, pick(units, F.floor(k / 4)))
    return table(spark, sf_dir, "part").select("p_partkey", got["test"].alias("test"), F.when(got["reason"].isNull(), got["value"].cast("double")).alias("value"), got["unit"].alias("unit"), got["label"].alias("conversion"), F.coalesce(got["reason"], F.lit("")).alias("reason"))


@query
def text_fold_ascii(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.fold(F.col("p_name")).alias("folded"))


@query
def phone_normalise(spark, sf_dir):
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit("0"), F.lpad(k.cast("string"), 10, "8"))).when(k % 3 == 1, F.concat(F.lit("+234 "), F.lpad(k.cast("string"), 10, "7"))).otherwise(F.concat(F.lit("("), k.cast("string"), F.lit(")")))
    return table(spark, sf_dir, "customer").select("c_custkey", text.phone(raw).alias("phone"))


@query
def dedup_duplicate_record(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("k"))
    return quality.duplicate_reasons(rows, "k", ["k"], F.col("doc_id")).where("_duplicate IS NOT NULL").select("doc_id", F.col("_duplicate").alias("reason"))


@query
def dedup_pk_conflict(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("k", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    columns = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]
    found = quality.duplicate_reasons(rows, "k", columns, F.col("l_partkey"))
    return found.groupBy(F.coalesce("_duplicate", F.lit("")).alias("reason")).agg(F.count("*").alias("rows"))


def _lines(spark, sf_dir) -> DataFrame:
    """Line items with the reasons that their orders give them."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("admit")).where("o_orderkey % 13 != 0")
    rows = quality.references(table(spark, sf_dir, "lineitem"), "l_orderkey", orders.withColumn("key", F.col("o_orderkey").cast("string")), "key", ("admit",))
    day = F.to_date("l_shipdate")
    return quality.with_reasons(rows, [F.when(~F.col("_known"), "unknown_admission_id"), F.when(day < F.col("_p_admit"), "result_before_admission"), F.when(day > F.date_add("_p_admit", 90), "result_after_discharge"), F.when(F.col("l_quantity") > 45, "invalid_result_value")])


@query
def chronology_reasons(spark, sf_dir):
    return _lines(spark, sf_dir).groupBy(F.array_join(quality.REASONS, ";").alias("reasons")).agg(F.count("*").alias("rows"))


@query
def reason_histogram(spark, sf_dir):
    return quality.reason_histogram(_lines(spark, sf_dir))


@query
def accept_quarantine_reconcile(spark, sf_dir):
    rows = _lines(spark, sf_dir)
    return rows.agg(F.count("*").alias("source_rows"), F.count(F.when(F.size(quality.REASONS) == 0, 1)).alias("accepted_rows"), F.count(F.when(F.size(quality.REASONS) > 0, 1)).alias("quarantined_rows"))


@query
def fk_cascade(spark, sf_dir):
    """A refused customer refuses its orders, and those their line items."""
    people = quality.with_reasons(table(spark, sf_dir, "customer").withColumn("ck", F.col("c_custkey").cast("string")), [F.when(F.col("c_acctbal") < 0, "invalid_balance")])
    orders = quality.references(table(spark, sf_dir, "orders").withColumn("ok", F.col("o_orderkey").cast("string")), "o_custkey", quality.accepted(people), "ck")
    orders = quality.with_reasons(orders, [F.when(~F.col("_known"), "unknown_patient_id"), F.when(F.col("o_orderstatus") == "P", "invalid_discharge_status")])
    lines = quality.references(table(spark, sf_dir, "lineitem"), "l_orderkey", quality.accepted(orders), "ok")
    lines = quality.with_reasons(lines, [F.when(~F.col("_known"), "unknown_admission_id")])
    level = lambda df, n: df.agg(F.lit(n).alias("level"), F.count(F.when(F.size(quality.REASONS) == 0, 1)).alias("accepted_rows"), F.count(F.when(F.size(quality.REASONS) > 0, 1)).alias("quarantined_rows"))
    return level(people, "customer").unionByName(level(orders, "orders")).unionByName(level(lines, "lineitem"))


@query
def history_features(spark, sf_dir):
    return features.history(stays(spark, sf_dir)).select("stay_id", "prior_completed_admission_count", "prior_admission_30d_count", "prior_admission_365d_count", "prior_same_diagnosis_group_count", "prior_distinct_hospital_count", "days_since_prior_discharge")


@query
def event_summary_pivot(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("v", F.col("l_extendedprice").cast("decimal(18,2)"))
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "v", "l_quantity", "l_discount", "l_tax", "l_linestatus"]
    got = features.event_summary(rows, "l_orderkey", "l_returnflag", ["A", "N", "R"], "v", order)
    return got.select("l_orderkey", *[(F.col(c).cast("double") if not c.endswith("count") else F.col(c)).alias(c.lower()) for c in got.columns if c != "l_orderkey"])


@query
def readmission_label(spark, sf_dir):
    return features.label(stays(spark, sf_dir), F.lit(OBSERVED)).select("stay_id", "label_status", "readmitted_30d")


@query
def label_status_counts(spark, sf_dir):
    one = lambda p: features.label(stays(spark, sf_dir, p), F.lit(OBSERVED)).groupBy("label_status").agg(F.count("*").alias("rows")).withColumn("entity", F.lit("pair" if p else "custkey"))
    return one(True).unionByName(one(False)).select("entity", "label_status", "rows")


@query
def follow_up_exists(spark, sf_dir):
    rows = features.follow_up(stays(spark, sf_dir, False), F.lit(dt.date(9999, 1, 1)))
    return rows.agg(F.count(F.when(F.col("followed"), 1)).alias("followed"), F.count("*").alias("stays"))


@query
def completed_years(spark, sf_dir):
    born = F.date_add(F.lit(dt.date(1930, 2, 28)), (F.col("o_custkey") * 7 % 20000).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", times.completed_years(born, F.to_date("o_orderdate")).alias("age"))


@query
def bands(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(stats.age_band((k % 100).cast("int")).alias("age_band"), stats.stay_band((k % 20).cast("int")).alias("stay_band"), stats.prior_band((k % 4).cast("int")).alias("prior_band"))
    return rows.groupBy("age_band", "stay_band", "prior_band").agg(F.count("*").alias("rows"))


@query
def overall_metrics(spark, sf_dir):
    return aggregates.overall(aggregates.eligible(cohort(spark, sf_dir)), "master_patient_id")


@query
def breakdowns_suppressed(spark, sf_dir):
    return aggregates.breakdowns(aggregates.eligible(cohort(spark, sf_dir)), aggregates.dimension_columns())


@query
def labels_breakdown_suppressed(spark, sf_dir):
    """Small cells: quality by toxic over the label table."""
    rows = table(spark, sf_dir, "labels")
    return aggregates.breakdowns(rows, {"quality": F.col("quality"), "bucket": F.col("doc_id") % 7}, 11, "toxic")


@query
def excluded_status_suppression(spark, sf_dir):
    return aggregates.excluded_statuses(cohort(spark, sf_dir), 200)


@query
def top_released_category(spark, sf_dir):
    return aggregates.top_category(breakdowns_suppressed(spark, sf_dir), "diagnosis_group").select("category", "eligible_admissions", "readmitted_admissions", "readmission_rate_pct")


@query
def breakdown_page(spark, sf_dir):
    return aggregates.page(breakdowns_suppressed(spark, sf_dir), "discharge_month", 10, 5)[0].select("dimension", "category", "eligible_admissions", "suppression_reason")


@query
def contract_violations(spark, sf_dir):
    return release.contract_violations(breakdowns_suppressed(spark, sf_dir))


@query
def gold_row_rules(spark, sf_dir):
    """How many rows break each rule of the feature table (these tables break some)."""
    rows = cohort(spark, sf_dir).withColumn("observation_end_date", F.lit(OBSERVED)).withColumn("feature_rule_version", F.lit("v"))
    rules = aggregates.gold_rules()
    counted = rows.agg(*[F.count(F.when(c, 1)).alias(f"r{i}") for i, c in enumerate(rules.values())])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(f"r{i}").alias("rows")) for i, k in enumerate(rules)])).alias("x")).select("x.*").where("rows > 0")


@query
def before_after_matching(spark, sf_dir):
    local = stays(spark, sf_dir, False).select(F.col("stay_id").alias("admission_id"), F.col("entity").alias("patient_id"), F.col("admitted").alias("admit_date"), F.col("left").alias("discharge_date"))
    got = answers.matching_impact(cohort(spark, sf_dir), local, F.lit(OBSERVED), check=False)
    return got.select(*[F.col(c).cast("double").alias(c) if c.endswith(("pct", "change")) else c for c in got.columns])


@query
def breakdown_reconciliation(spark, sf_dir):
    rows = cohort(spark, sf_dir)
    return answers.reconcile_breakdown(breakdowns_suppressed(spark, sf_dir), rows, "diagnosis_group")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as records of source LG, suppliers of source RS."""
    def side(name, p, source, mult, phone):
        k = F.col(f"{p}_{'cust' if p == 'c' else 'supp'}key")
        return table(spark, sf_dir, name).select(
            F.concat(F.lit(f"{source}-"), k).alias("patient_id"), F.lit(source).alias("source_system"), F.concat(F.lit("Ann "), k % 12).alias("first_name"), F.concat(F.lit("Fam-"), k * mult % 9).alias("last_name"),
            F.date_add(F.lit(dt.date(1960, 1, 1)), (k * 37 % 700).cast("int")).alias("date_of_birth"), F.when(k % 2 == 0, "M").otherwise("F").alias("sex"),
            F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("080"), F.lpad((phone(k)).cast("string"), 8, "0"))).alias("phone"), F.col(f"{p}_nationkey").cast("string").alias("state"))

    return side("customer", "c", "LG", 1, lambda k: k * 3).unionByName(side("supplier", "s", "RS", 4, lambda k: k * 30))


@query
def block_candidates(spark, sf_dir):
    return identity.candidates(identity.normalise(people(spark, sf_dir)))


@query
def deletion_block_pairs(spark, sf_dir):
    rows = identity.normalise(people(spark, sf_dir), text.fold_ascii).where("phone != ''").select("patient_id", "source_system", F.explode(identity.deletion_signatures(F.col("phone"))).alias("s"))
    l, r = (rows.where(F.col("source_system") == s).select(F.col("patient_id").alias(n), "s") for s, n in (("LG", "lg_patient_id"), ("RS", "rs_patient_id")))  # noqa: E741
    return l.join(r, "s").select("lg_patient_id", "rs_patient_id").distinct()


def _scored(spark, sf_dir) -> DataFrame:
    rows = identity.normalise(people(spark, sf_dir), text.fold_ascii)
    return identity.score(identity.candidates(rows), rows)


@query
def pair_scoring(spark, sf_dir):
    got = _scored(spark, sf_dir)
    return got.select(*identity.PAIR, "match_score", F.array_join("evidence_codes", ";").alias("evidence_codes"), F.array_join("conflict_codes", ";").alias("conflict_codes"), "decision_rule", "auto_eligible", "review_eligible")


@query
def one_to_one_links(spark, sf_dir):
    """One-to-one filter over candidate pairs of equal phones."""
    pairs = block_candidates(spark, sf_dir)
    return identity.with_degrees(pairs, *identity.PAIR).groupBy("one_to_one").agg(F.count("*").alias("pairs"))


@query
def master_tokens(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.token(TEST_KEY, "MP", F.concat(F.lit("LG:"), F.col("c_name")), length=24).alias("token"))


@query
def master_tokens_builtin(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.token_in_plan(TEST_KEY, "RV", F.col("c_name"), F.col("c_mktsegment")).alias("token"))


@query
def link_status(spark, sf_dir):
    found = identity.resolve(people(spark, sf_dir), TEST_KEY, fold=text.fold_ascii, check=False)
    return found.master.groupBy("link_status").agg(F.count("*").alias("rows"), F.countDistinct("master_patient_id").alias("masters"))


@query
def review_decisions_apply(spark, sf_dir):
    """Reviews by a fixed rule over the queue: its outcomes change the masters."""
    rows = people(spark, sf_dir)
    _, review = identity.split_decisions(stash(_scored(spark, sf_dir), "scored"))
    n = F.regexp_extract("lg_patient_id", "([0-9]+)", 1).cast("long") % 3
    reviews = identity.with_degrees(review, *identity.PAIR).select(
        text.token(TEST_KEY, "RV", *map(F.col, identity.PAIR)).alias("review_case_id"), F.when(n == 0, F.when(F.col("one_to_one"), "ACCEPT")).when(n == 1, "REJECT").otherwise("ABSTAIN").alias("decision"),
        F.lit("reviewer").alias("reviewer_id"), F.lit("2024-01-01T00:00:00Z").alias("reviewed_at_utc"), F.lit("").alias("review_notes")).where("decision IS NOT NULL")
    found = identity.resolve(rows, TEST_KEY, reviews, fold=text.fold_ascii, check=False)
    return found.master.groupBy("link_status").agg(F.count("*").alias("rows"), F.countDistinct("master_patient_id").alias("masters"))


@query
def publish_parity(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    b = table(spark, sf_dir, "orders").where("o_orderkey % 10 != 0").select("o_custkey", "o_orderstatus").unionByName(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("F").alias("o_orderstatus")))
    return release.multiset_difference(a, b)


@query
def coverage_check(spark, sf_dir):
    return features.coverage(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


@query
def identifier_scan(spark, sf_dir):
    return release.identifier_leaks(table(spark, sf_dir, "customer").select("c_name"), "c_name", '{"rows": ["Customer#000000007", "Customer#000000011x", "none"]}')


@query
def temporal_split_counts(spark, sf_dir):
    rows = aggregates.eligible(cohort(spark, sf_dir)).where(F.date_add("discharge_date", 30) <= F.lit(OBSERVED))
    return learn.split_counts(rows, CUTOFF)


@query
def class_balance(spark, sf_dir):
    return learn.class_balance(table(spark, sf_dir, "labels"), "toxic")


@query
def classifier_metrics(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    return learn.metrics(rows.select("quality", (F.col("n_chars") / F.lit(2.0**17)).alias("p")), "quality", "p")


@query
def freshness_status(spark, sf_dir):
    now = F.lit(dt.datetime(2024, 1, 20)).cast("timestamp_ntz")
    return table(spark, sf_dir, "events").groupBy(times.freshness(F.col("ts"), now).alias("freshness")).agg(F.count("*").alias("rows"))


def _labelled(spark, sf_dir) -> tuple[DataFrame, list]:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang"), "doc_id")
    mean, dev = rows.agg(F.avg("n_chars"), F.stddev_pop("n_chars")).first()
    return rows, [(F.col("n_chars") - mean) / dev, *[(F.col("lang") == x).cast("double") for x in ("en", "de", "fr")]]


@query
def logistic_fit(spark, sf_dir):
    """Rows only: probabilities of a fit over labelled documents (logistic_optimum checks it)."""
    rows, columns = _labelled(spark, sf_dir)
    return learn.fit_logistic(rows, columns, "quality")(rows).select("doc_id", "probability")


@query
def logistic_optimum(spark, sf_dir):
    """Is the fit the optimum?  Each derivative of the objective, against the number of rows."""
    rows, columns = _labelled(spark, sf_dir)
    predict = learn.fit_logistic(rows, columns, "quality")
    slopes, n = learn.gradient(rows, columns, predict, "quality"), rows.count()
    return spark.createDataFrame([(i, bool(abs(g) < 1e-4 * n)) for i, g in enumerate(slopes)], "weight int, at_optimum boolean")
