"""The whole batch: ingest, standardise, link, derive, aggregate, check, learn, publish."""

from __future__ import annotations

import uuid
from dataclasses import asdict
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..errors import require
from ..operators import aggregates, answers, features, identity, learn, quality
from ..schemas import ADMISSIONS, LABS, LINEAGE, PATIENTS
from ..sources import delimited, sinks
from . import release

TABLES = {"patients": PATIENTS, "admissions": ADMISSIONS, "lab_results": LABS}


def run_batch(spark: SparkSession, inputs: dict[str, str], folder: str, key: bytes, observation_end: date, cutoff: date, *, config: quality.SilverConfig = quality.SilverConfig(), source_system: str = "delivery",
              reviews: DataFrame | None = None, least: int = 11, run_id: str | None = None, now: datetime | None = None) -> dict:
    """Run every stage into a new folder and return the manifest.

    Each stage's tables are written before the next begins, so a lost executor
    repeats tasks of one stage only, and a failed check leaves no release.
    """
    require(set(inputs) == set(TABLES), "inputs are patients, admissions and lab_results")
    require(len(key) >= 32, "the key must have at least 32 bytes")
    require(observation_end > cutoff, "the observation must end after the cutoff")
    run_id, now = run_id or str(uuid.uuid4()), now or datetime.now(timezone.utc)
    sinks.guard(spark, [folder], list(inputs.values()))
    manifest: dict = {"run_id": run_id, "created_at_utc": delimited.utc_text(now), "stages": {}}

    def keep(df: DataFrame, name: str) -> DataFrame:
        sinks.write_table(df, f"{folder}/{name}")
        manifest["stages"][name] = release.fingerprint(df := spark.read.schema(df.schema).parquet(f"{folder}/{name}"))
        return df

    raw = {}
    for name, columns in TABLES.items():
        good, bad, record = delimited.ingest(spark, inputs[name], source_system, run_id=run_id, ingested_at=now)
        require(tuple(good.columns) == (*columns, *LINEAGE), "a delivery's header does not match its contract")
        raw[name] = keep(good, f"bronze/{name}")
        if record.quarantined_rows:
            keep(bad, f"bronze_quarantine/{name}")
        manifest[f"ingest_{name}"] = asdict(record)
    silver = quality.build_silver(raw["patients"], raw["admissions"], raw["lab_results"], config, keep=lambda df, name: keep(df, f"classified/{name}"))
    manifest["silver"] = {k: quality.reconcile(v) for k, v in silver.classified.items()}
    manifest["transformations"] = quality.transformation_counts(silver)
    clean = {k: keep(v, f"silver/{k}") for k, v in silver.accepted.items()}
    for k, v in silver.quarantine.items():
        keep(v, f"silver_quarantine/{k}")
    found = identity.resolve(clean["patients"], key, reviews, keep=lambda df, name: keep(df, f"identity_work/{name}"))
    found = identity.Identity(keep(found.master, "identity/master"), keep(found.decisions, "identity/decisions"), keep(found.queue, "identity/queue"), keep(found.candidates, "identity/candidates"))
    manifest["identity"] = identity.audit(found)
    gold = keep(features.build_gold(clean["patients"], clean["admissions"], clean["lab_results"], found.master, observation_end, keep=lambda df, name: keep(df, f"gold_work/{name}")), "gold/features")
    manifest["gold"] = features.gold_audit(gold)
    analytics = {k: keep(v, f"analytics/{k}") for k, v in aggregates.build_analytics(gold, least).items()}
    known = {"gold": manifest["stages"]["gold/features"], **{k: manifest["stages"][f"analytics/{k}"] for k in ("breakdowns", "overall")}}
    audit = release.analytics_audit(gold, analytics, least, known)
    manifest["answers"] = answers.core_answers(gold, clean["admissions"], analytics, manifest["identity"], F.lit(observation_end))
    reports = release.write_report(spark, f"{folder}/release", analytics["breakdowns"])
    phases = {"ingestion": {k: manifest[f"ingest_{k}"] for k in TABLES}, "silver": manifest["silver"], "identity": manifest["identity"], "gold": manifest["gold"], "analytics": audit}
    release.write_evidence(spark, folder, __version__, phases)
    gate = keep(release.run_gate(gold, manifest["gold"], analytics, audit, release.evidence_checks(spark, folder, __version__), reports), "release/gate")
    pins = {"master": manifest["stages"]["identity/master"], "gold": manifest["stages"]["gold/features"]}
    learn.check_lineage(gold, found.master, manifest["gold"], manifest["identity"], pins)
    manifest["experiment"] = learn.run_experiment(gold, found.master, cutoff)
    if least >= 11:
        release.verify_publication(analytics["breakdowns"], analytics["overall"], gate, audit, manifest["gold"], reports)
        tables = release.publish(spark, f"{folder}/published", {"breakdowns": analytics["breakdowns"], "overall": analytics["overall"]}, run_id)
        release.register(spark, f"{folder}/registry", tables, run_id, now)
        manifest["published"] = tables
    verify_run(spark, folder, manifest, inputs)
    sinks.write_json(spark, f"{folder}/manifest.json", manifest)
    return manifest


def verify_run(spark: SparkSession, folder: str, manifest: dict, inputs: dict[str, str] | None = None) -> None:
    """Every table of a run still is what its manifest says, no other table
    stands beside them, and the delivery, if given, has not changed."""
    for name, known in manifest["stages"].items():
        require(release.fingerprint(spark.read.parquet(f"{folder}/{name}")) == known, f"table {name} is not what the manifest says")
    published = {v["path"].removeprefix(f"{folder}/") for v in manifest.get("published", {}).values()}
    allowed = {*manifest["stages"], *published, "registry", "release/breakdowns_csv"}
    require(set(sinks.tables(spark, folder)) <= allowed, "the run's folder holds a table that is not in the manifest")
    for name, path in (inputs or {}).items():
        require(delimited.file_digest(spark, path) == manifest[f"ingest_{name}"]["source_sha256"], f"the delivery of {name} changed during the run")
