"""Release gate, publication and integrity checks of snapshots."""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EngineError, require
from ..operators.aggregates import released
from ..operators.quality import REASONS
from ..schemas import ANALYTICS_RULES, BREAKDOWN, DIMENSIONS, GOLD_RULES, METRICS, RELEASE_RULES
from ..sources import delimited, sinks

#: The names of the gate's checks, in order.
CHECKS = ("phase_evidence_files", "phase_evidence_index", "package_version", "sensitive_output_ignore_rules", "gold_hash_lineage", "analytics_output_hashes", "gold_row_uniqueness", "gold_label_audit_reconciliation",
          "gold_analytics_reconciliation", "breakdown_csv_json_reconciliation", "suppression_integrity", "identifier_exclusion", "rule_version_chain")


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows (with repeats) of each side that the other lacks."""
    columns = left.columns
    both = left.select(*columns, F.lit(1).alias("_s")).unionByName(right.select(*columns, F.lit(-1).alias("_s")))
    # one shuffle instead of two set differences; nulls are equal
    groups = both.groupBy(*columns).agg(F.sum("_s").alias("_s"))
    return groups.agg(F.coalesce(F.sum(F.when(F.col("_s") > 0, F.col("_s"))), F.lit(0)).alias("left_only"), F.coalesce(F.sum(F.when(F.col("_s") < 0, -F.col("_s"))), F.lit(0)).alias("right_only"))


def fingerprint(df: DataFrame) -> dict:
    """Order-free content hash of a table.

    Each row is spelled with its column names and nulls and hashed by SHA-256;
    two sums of sixty bits each of all row hashes, the number of rows and the
    schema are hashed again.  Equal tables, repeats included, have equal hashes.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    bits = [F.conv(F.substring("_h", at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)]
    got = df.select(row.alias("_h")).agg(F.count("*").alias("n"), *[F.coalesce(F.sum(b), F.lit(0)).alias(f"s{i}") for i, b in enumerate(bits)]).first()
    schema = [[f.name, f.dataType.simpleString()] for f in df.schema.fields]
    text = json.dumps([got["n"], str(got["s0"]), str(got["s1"]), schema])
    return {"rows": got["n"], "hash": hashlib.sha256(text.encode()).hexdigest(), "columns": list(df.columns)}


def identifier_leaks(ids: DataFrame, column: str, text: str) -> DataFrame:
    """The identifiers that occur in a published text.  The text, a report of
    bounded size, goes to the rows; the rows never come to the driver."""
    return ids.where((F.col(column) != "") & F.contains(F.lit(text), F.col(column))).select(column)


def contract_violations(report: DataFrame, least: int = 11) -> DataFrame:
    """(rule, rows): what breaks the response contract."""
    shown = F.col("suppression_reason") == ""
    n, p, q, r, lo, hi = (F.col(m) for m in METRICS)
    rules = {
        "unknown dimension": ~F.col("dimension").isin(*DIMENSIONS), "blank category": F.coalesce(F.col("category"), F.lit("")) == "",
        "unknown reason": ~F.col("suppression_reason").isin("", "primary_small_cell", "complementary_suppression"),
        "suppressed metric shown": ~shown & F.coalesce(*[F.col(m).cast("double") for m in METRICS]).isNotNull(),
        "small cell shown": shown & (F.least(n, p, q) < least), "counts do not add up": shown & (n != p + q),
        "rate differs": shown & (F.abs(r - F.lit(100.0) * p / n) > 0.00501), "interval misses the rate": shown & ~((lo <= r) & (r <= hi)), "metric missing": shown & F.greatest(*[F.col(m).isNull().cast("int") for m in METRICS]).cast("boolean")}
    counted = report.agg(*[F.count(F.when(c, 1)).alias(f"r{i}") for i, c in enumerate(rules.values())])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(f"r{i}").alias("rows")) for i, k in enumerate(rules)])).alias("x")).select("x.*")


def breakdown_order() -> list[Column]:
    """Dimensions in their fixed order, categories by name."""
    place = F.array_position(F.array(*map(F.lit, DIMENSIONS)), F.col("dimension"))
    return [place, F.col("category")]


def write_report(spark: SparkSession, folder: str, report: DataFrame) -> dict[str, str]:
    """The report as a delimited table and as a JSON object by dimension, both
    in order; their paths."""
    paths = {"csv": f"{folder}/breakdowns_csv", "json": f"{folder}/breakdowns.json"}
    sinks.write_delimited(report.orderBy(*breakdown_order()), paths["csv"])
    rows = [r.asDict() for r in report.orderBy(*breakdown_order()).collect()]  # a published report: nine dimensions
    sinks.write_json(spark, paths["json"], {"breakdowns": {d: [r for r in rows if r["dimension"] == d] for d in DIMENSIONS}})
    return paths


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """The delimited report, read by its contract; blanks are null again."""
    types = {m: "bigint" if i < 3 else "double" for i, m in enumerate(METRICS)}
    rows = delimited.read_contract(spark, path, BREAKDOWN)
    return rows.select(*[F.when(F.col(c) != "", F.col(c).cast(types[c])).alias(c) if c in types else F.col(c) for c in BREAKDOWN])


def report_files_agree(spark: SparkSession, paths: dict[str, str], report: DataFrame) -> bool:
    """Do both files hold exactly the rows of the report?"""
    same = {"left_only": 0, "right_only": 0}
    by_dimension = delimited.read_json_object(spark, paths["json"])["breakdowns"]
    rows = [tuple(r[c] for c in BREAKDOWN) for part in by_dimension.values() for r in part]
    typed = report.select(*[F.col(m).cast("bigint" if m in METRICS[:3] else "double").alias(m) if m in METRICS else m for m in BREAKDOWN])
    found = read_report_csv(spark, paths["csv"]), spark.createDataFrame(rows, typed.schema)
    return all(multiset_difference(typed, f).first().asDict() == same for f in found)


#: The phases whose evidence the gate asks for, in order.
PHASES = ("ingestion", "silver", "identity", "gold", "analytics")


def write_evidence(spark: SparkSession, folder: str, version: str, phases: dict[str, dict]) -> str:
    """One JSON file for each phase (counts and hashes only), and an index that
    pins their SHA-256 and the engine's version.  An ignore file keeps the
    run's tables, which hold identifiers, out of version control."""
    where = f"{folder}/evidence"
    hashes = {p: sinks.write_json(spark, f"{where}/{p}.json", facts) for p, facts in phases.items()}
    sinks.write_json(spark, f"{where}/index.json", {"version": version, "phases": {p: {"status": "complete", "sha256": h} for p, h in hashes.items()}})
    sinks.write_bytes(spark, f"{folder}/.gitignore", b"*\n")
    return where


def evidence_checks(spark: SparkSession, folder: str, version: str) -> dict[str, Callable[[], bool]]:
    """The gate's first four checks, over what :func:`write_evidence` wrote."""
    where = f"{folder}/evidence"

    def index() -> dict:
        return delimited.read_json_object(spark, f"{where}/index.json")

    def pinned() -> bool:
        phases = index().get("phases", {})
        return set(phases) == set(PHASES) and all(
            phases[p].get("status") == "complete" and phases[p].get("sha256") == hashlib.sha256(delimited.read_file(f"{where}/{p}.json", spark)).hexdigest() for p in PHASES)

    def ignored() -> bool:
        path = f"{folder}/.gitignore"
        return sinks.exists(spark, path) and b"*" in sinks.read_bytes(spark, path).split()

    return {CHECKS[0]: lambda: all(sinks.exists(spark, f"{where}/{p}.json") for p in (*PHASES, "index")), CHECKS[1]: pinned, CHECKS[2]: lambda: index().get("version") == version, CHECKS[3]: ignored}


#: What each check that passed has shown, in order of the checks.
DETAILS = ("evidence of every phase exists", "the index pins the evidence of every phase", "the engine's version is the recorded one", "the run's tables are kept out of version control",
           "the features are those that were aggregated", "the reports are those of the audit", "one row for each admission", "labels and statuses equal the audit", "features and totals agree",
           "both report files hold the report", "suppressed cells show nothing", "no identifier is published", "every stage used its rules")


def run_gate(gold: DataFrame, gold_audit: dict, analytics: dict[str, DataFrame], analytics_audit: dict, evidence: dict[str, Callable[[], bool]], reports: dict[str, str]) -> DataFrame:
    """(check, status, detail) of all thirteen checks; the first failure aborts
    and no partial report exists.

    ``evidence`` must hold the first four checks, those of the run around the
    data; ``reports`` are the paths of the written report; the others compare the
    tables with the audits that were recorded when they were made.
    """
    require(set(evidence) == set(CHECKS[:4]), "the gate needs evidence for its first four checks")
    spark = gold.sparkSession
    report = analytics["breakdowns"]
    got = gold.agg(F.count("*").alias("n"), F.countDistinct("admission_id").alias("ids"), *[F.count(F.when(F.col("readmitted_30d") == v, 1)).alias(f"y{v}") for v in (0, 1)]).first()
    statuses = {r[0]: r[1] for r in gold.groupBy("label_status").count().collect()}  # five statuses
    labels = {k: v for k, v in (("positive", got["y1"]), ("negative", got["y0"]), ("unlabeled", got["n"] - got["y0"] - got["y1"])) if v}
    total = analytics["overall"].first()
    suppressed = report.where("suppression_reason != ''")
    text = json.dumps([r.asDict() for r in report.collect()], default=str)  # a published report: nine dimensions
    ids = gold.select(F.explode(F.array("admission_id", "master_patient_id")).alias("id"))
    checks = {
        **evidence,
        "gold_hash_lineage": lambda: analytics_audit.get("gold") == fingerprint(gold),
        "analytics_output_hashes": lambda: analytics_audit.get("breakdowns") == fingerprint(report) and analytics_audit.get("overall") == fingerprint(analytics["overall"]),
        "gold_row_uniqueness": lambda: got["n"] == got["ids"] == gold_audit.get("gold_rows"),
        "gold_label_audit_reconciliation": lambda: labels == gold_audit.get("label_counts") and statuses == gold_audit.get("label_status_counts"),
        "gold_analytics_reconciliation": lambda: total[METRICS[1]] == got["y1"] and total[METRICS[2]] == got["y0"] and total[METRICS[0]] == got["y0"] + got["y1"],
        "breakdown_csv_json_reconciliation": lambda: report_files_agree(spark, reports, report),
        "suppression_integrity": lambda: suppressed.where(F.coalesce(*[F.col(m).cast("double") for m in METRICS]).isNotNull()).isEmpty() and suppressed.count() == analytics_audit.get("suppressed_breakdown_rows"),
        "identifier_exclusion": lambda: identifier_leaks(ids, "id", text).isEmpty(),
        "rule_version_chain": lambda: gold_audit.get("rule_version") == GOLD_RULES and analytics_audit.get("rule_version") == ANALYTICS_RULES and analytics_audit.get("gold_rule_version") == GOLD_RULES,
    }
    passed = []
    for name, detail in zip(CHECKS, DETAILS):
        if not checks[name]():
            raise EngineError(f"validation check failed: {name}")
        passed.append((name, "PASS", detail, RELEASE_RULES))
    return spark.createDataFrame(passed, "check string, status string, detail string, rule_version string")


def analytics_audit(gold: DataFrame, analytics: dict[str, DataFrame], least: int = 11, known: dict[str, dict] | None = None) -> dict:
    """What the reports were made from.  ``known`` gives the fingerprints that
    were taken when the tables (gold, breakdowns, overall) were written."""
    report = analytics["breakdowns"]
    known = known or {"gold": fingerprint(gold), "breakdowns": fingerprint(report), "overall": fingerprint(analytics["overall"])}
    return {"rule_version": ANALYTICS_RULES, "gold_rule_version": GOLD_RULES, "minimum_cell_size": least, **known,
            "breakdown_rows": report.count(), "suppressed_breakdown_rows": report.where("suppression_reason != ''").count()}


def verify_publication(report: DataFrame, total: DataFrame, gate: DataFrame, audit: dict, gold_audit: dict, reports: dict[str, str]) -> None:
    """A release needs all thirteen checks passed, hashes that are still those
    of the audit, a threshold of 11, whole contracts, equal files, and totals
    that equal the features' counts."""
    least = audit.get("minimum_cell_size", 0)
    require(least >= 11, "a release needs at least 11 in every cell")
    got = sorted((r["check"], r["status"]) for r in gate.collect())  # thirteen rows
    require(got == sorted((c, "PASS") for c in CHECKS), "the release gate has not passed")
    require(audit.get("breakdowns") == fingerprint(report) and audit.get("overall") == fingerprint(total), "the reports are not those that were audited")
    require(list(report.columns) == list(BREAKDOWN), "the report does not have its columns")
    require(report.groupBy("dimension", "category").count().where("count > 1").isEmpty(), "a category repeats")
    require(contract_violations(report, least).where("rows > 0").isEmpty(), "the report breaks its contract")
    require(report_files_agree(report.sparkSession, reports, report), "the report's files differ from it")
    row = total.first()
    require(min(row[m] for m in METRICS[:3]) >= least and row[METRICS[0]] == row[METRICS[1]] + row[METRICS[2]], "the overall counts break their contract")
    labels = gold_audit.get("label_counts", {})
    require((row[METRICS[1]], row[METRICS[2]]) == (labels.get("positive"), labels.get("negative")), "the overall counts are not those of the features")


def publish(spark: SparkSession, folder: str, tables: dict[str, DataFrame], run_id: str) -> dict[str, dict]:
    """Write each table to a new snapshot, read it back and compare both as
    multisets; returns name -> fingerprint.  Existing snapshots are refused."""
    paths = {k: f"{folder}/{sinks.snapshot_name('release', k, run_id).replace('.', '/')}" for k in tables}
    sinks.guard(spark, list(paths.values()))
    out = {}
    for name, df in tables.items():
        sinks.write_table(df, paths[name])
        back = spark.read.schema(df.schema).parquet(paths[name])
        require(multiset_difference(df, back).first().asDict() == {"left_only": 0, "right_only": 0}, "a published table differs from its source")
        out[name] = {"path": paths[name], **fingerprint(back)}
    return out


def register(spark: SparkSession, registry: str, manifest: dict, run_id: str, published_at: datetime) -> None:
    """Verify every snapshot again and then append the release."""
    for entry in manifest.values():
        back = fingerprint(spark.read.parquet(entry["path"]))
        require({k: entry[k] for k in back} == back, "a snapshot changed before it was registered")
    sinks.append_registry(spark, registry, {"run_id": run_id, "published_at_utc": published_at.isoformat(), "tables": len(manifest)})


def read_snapshot(spark: SparkSession, entry: dict, max_bytes: int = 64 << 20, least: int = 11) -> DataFrame:
    """A pinned snapshot: size, content, schema and, of a report, the contract
    are checked on every read."""
    require(valid("digest", entry.get("hash")), "the snapshot's hash is malformed")
    df = spark.read.parquet(entry["path"])
    p, fs = sinks._path(spark, entry["path"])
    require(fs.getContentSummary(p).getLength() <= max_bytes, "the snapshot is too large")
    require({k: entry[k] for k in ("rows", "hash", "columns")} == fingerprint(df), "the snapshot is not the one that was pinned")
    if set(BREAKDOWN) <= set(df.columns):
        require(contract_violations(df, least).where("rows > 0").isEmpty(), "the snapshot breaks the report's contract")
    return df


def freshness(run_at: datetime, now: datetime) -> str:
    age = (now - run_at).total_seconds()
    return "INVALID" if age < 0 else "STALE" if age > 86_400 else "FRESH"


def export_bundle(report: DataFrame, total: DataFrame, manifest: dict, run_at: datetime, published_at: datetime, now: datetime) -> dict:
    """Unsuppressed aggregates with the proof of their lineage; times must be in order."""
    require(run_at <= published_at <= now, "run, publication and now are out of order")
    rows = [r.asDict() for r in released(report).drop("suppression_reason").orderBy(*breakdown_order()).collect()]  # released cells only
    return {"overall": {k: v for k, v in total.first().asDict().items() if k in METRICS}, "breakdowns": rows, "lineage": {k: {"rows": v["rows"], "hash": v["hash"]} for k, v in manifest.items()},
            "run_at_utc": run_at.isoformat(), "published_at_utc": published_at.isoformat(), "exported_at_utc": now.isoformat(), "freshness": freshness(run_at, now)}


def _wilson(p: int, n: int) -> tuple[float, float]:
    z, share = 1.96, p / n
    middle, half = share + z * z / (2 * n), z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return 100 * (middle - half) / (1 + z * z / n), 100 * (middle + half) / (1 + z * z / n)


def _check_cell(row: dict, least: int) -> None:
    n, p, q, rate, low, high = (row[m] for m in METRICS)
    require(all(isinstance(x, int) and not isinstance(x, bool) for x in (n, p, q)) and all(isinstance(x, float) for x in (rate, low, high)), "a bundle cell has a value of another type")
    require(n == p + q and min(n, p, q) >= least, "a bundle cell breaks its contract")
    bounds = _wilson(p, n)
    require(abs(rate - 100 * p / n) <= 0.00501 and abs(low - bounds[0]) <= 0.00501 and abs(high - bounds[1]) <= 0.00501, "a bundle cell's rate or interval does not follow from its counts")


def check_bundle(bundle: dict, least: int = 11) -> None:
    """A bundle's own contract: fields, types, unique cells, sums, threshold,
    rates and intervals, released cells within the total, times in order, and a
    freshness that follows from them."""
    fields = {"overall", "breakdowns", "lineage", "run_at_utc", "published_at_utc", "exported_at_utc", "freshness"}
    require(isinstance(bundle, dict) and set(bundle) == fields and set(bundle["overall"]) == set(METRICS), "a bundle has other fields")
    _check_cell(bundle["overall"], least)
    seen, sums = set(), {}
    for row in bundle["breakdowns"]:
        require(set(row) == set(BREAKDOWN) - {"suppression_reason"}, "a bundle row has other fields")
        require((row["dimension"], row["category"]) not in seen and row["dimension"] in DIMENSIONS, "a bundle cell repeats or is unknown")
        seen.add((row["dimension"], row["category"]))
        _check_cell(row, least)
        sums[row["dimension"]] = sums.get(row["dimension"], 0) + row[METRICS[0]]
    require(all(n <= bundle["overall"][METRICS[0]] for n in sums.values()), "a dimension of a bundle holds more than the total")
    require(all(valid("digest", v["hash"]) for v in bundle["lineage"].values()), "a bundle's lineage has a malformed hash")
    times = [datetime.fromisoformat(bundle[k]) for k in ("run_at_utc", "published_at_utc", "exported_at_utc")]
    require(times == sorted(times), "a bundle's times are out of order")
    require(bundle["freshness"] == freshness(times[0], times[2]), "a bundle's freshness does not follow from its times")


def read_bundle(spark: SparkSession, path: str, least: int = 11) -> dict:
    """One bundle file, checked."""
    bundle = delimited.read_json_object(spark, path)
    check_bundle(bundle, least)
    return bundle


def evidence_export(status: dict, allowed: dict) -> dict:
    """The allow-listed scalars of a nested status: ``allowed`` maps a name to
    True for a scalar, or to the allow-list of the object below it."""
    out = {}
    for k, rule in allowed.items():
        value = status.get(k)
        if isinstance(rule, dict):
            if isinstance(value, dict):
                out[k] = evidence_export(value, rule)
        elif isinstance(value, (str, int, float, bool)):
            out[k] = value
    return out


#: The shapes of validated text.
SHAPES = {"digest": r"[0-9a-f]{64}", "uuid": r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "commit": r"[0-9a-f]{40}", "identifier": r"[a-z][a-z0-9_]{0,62}",
          "host": r"(?=.{1,253}\Z)([a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?)(\.[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?)*"}


def valid(shape: str, value) -> bool:
    """Is ``value`` a text of that shape, whole?"""
    return isinstance(value, str) and re.fullmatch(SHAPES[shape], value) is not None


def pipeline_status(manifest: dict, now: datetime) -> dict:
    """The status answer: run, times, freshness and counts; no values of records."""
    at = datetime.fromisoformat(manifest["created_at_utc"].replace("Z", "+00:00"))
    return {"run_id": manifest["run_id"], "created_at_utc": manifest["created_at_utc"], "freshness": freshness(at, now), "stages": len(manifest["stages"]), "published": "published" in manifest,
            "rows": {k: v["rows"] for k, v in sorted(manifest["stages"].items())}}


def data_quality(classified: dict[str, DataFrame]) -> DataFrame:
    """The data-quality answer: (table_name, source, accepted, quarantined,
    reason, rows), a row for each reason of each table, and one with a blank
    reason for tables that refuse nothing."""
    out = None
    for name, df in classified.items():
        n = F.size(REASONS)
        total = df.agg(F.count("*").alias("source"), F.count(F.when(n == 0, 1)).alias("accepted"), F.count(F.when(n > 0, 1)).alias("quarantined"))
        reasons = df.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))
        rows = total.withColumn("_k", F.lit(1)).join(reasons.withColumn("_k", F.lit(1)), "_k", "left").drop("_k")
        rows = rows.select(F.lit(name).alias("table_name"), "source", "accepted", "quarantined", F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce("rows", F.lit(0)).alias("rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


def released_view(report: DataFrame, name: str = "released_breakdowns") -> None:
    """Register the released cells as a view."""
    released(report).createOrReplaceTempView(sinks.identifier(name))


def error_class(error: BaseException) -> dict[str, str]:
    """A Spark error's condition and state, never its text."""
    condition = getattr(error, "getCondition", None) or getattr(error, "getErrorClass", None)
    state = getattr(error, "getSqlState", None)
    return {"type": type(error).__name__, "condition": (condition() if condition else None) or "UNKNOWN", "sqlstate": (state() if state else None) or "UNKNOWN"}
