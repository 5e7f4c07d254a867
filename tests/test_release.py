"""Suppression, gate, publication, answers, learning and the whole batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodeworks import EngineError, __version__
from lodeworks.operators import aggregates, learn, quality
from lodeworks.plans import pipeline, release
from lodeworks.sources import generator, sinks

KEY = b"an identity key of 32 bytes or so"


def cells(spark, groups, least=11):
    rows = [(c, y) for c, p, n in groups for y in [1] * p + [0] * n]
    got = aggregates.breakdowns(spark.createDataFrame(rows, "c string, readmitted_30d int"), {"diagnosis_group": F.col("c")}, least)
    return {r["category"]: r for r in got.collect()}


def test_suppression(spark):
    got = cells(spark, [("I50", 2, 3), ("E11", 15, 15), ("J18", 15, 15)])
    assert {k: r["suppression_reason"] for k, r in got.items()} == {"I50": "primary_small_cell", "E11": "complementary_suppression", "J18": ""}
    assert got["J18"]["eligible_admissions"] == 30 and got["E11"]["eligible_admissions"] is None
    two = cells(spark, [("A", 1, 1), ("B", 1, 1), ("C", 20, 20)])
    assert two["C"]["suppression_reason"] == ""
    one = cells(spark, [("A", 1, 1)])
    assert one["A"]["suppression_reason"] == "primary_small_cell"


def test_metrics(spark):
    r = cells(spark, [("A", 10, 30)], 1)["A"]
    assert (r["eligible_admissions"], r["readmission_rate_pct"], r["wilson_95_lower_pct"], r["wilson_95_upper_pct"]) == (40, 25.0, 14.19, 40.19)


def test_contract_catches_leaks(spark):
    report = aggregates.breakdowns(spark.createDataFrame([("x", 1)] * 20 + [("x", 0)] * 20, "c string, readmitted_30d int"), {"sex": F.col("c")})
    assert release.contract_violations(report).where("rows > 0").isEmpty()
    for change in ({"suppression_reason": F.lit("primary_small_cell")}, {"readmission_rate_pct": F.lit(51.0)}, {"readmitted_admissions": F.lit(5).cast("long")}, {"dimension": F.lit("name")}, {"wilson_95_lower_pct": F.lit(None).cast("double")}):
        assert not release.contract_violations(report.withColumns(change)).where("rows > 0").isEmpty()


def test_multiset_difference(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert tuple(release.multiset_difference(a, a).first()) == (0, 0)
    assert tuple(release.multiset_difference(a, a.limit(0).unionByName(a.where("a = 2"))).first()) == (2, 0)


def test_pages(spark):
    rows = spark.createDataFrame([("sex", c, "") for c in "abc"], "dimension string, category string, suppression_reason string")
    got, total = aggregates.page(rows, "sex", 2, 1)
    assert [r["category"] for r in got.collect()] == ["b", "c"] and total == 3
    for bad in ({"limit": 0}, {"limit": 101}, {"offset": 10_001}, {"dimension": "name"}):
        with pytest.raises(EngineError):
            aggregates.page(rows, **bad)


def brute_metrics(y, p):
    pos, neg = [q for t, q in zip(y, p) if t], [q for t, q in zip(y, p) if not t]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        tp, fp = sum(a >= t for a in pos), sum(b >= t for b in neg)
        ap, last = ap + (tp / len(pos) - last) * tp / (tp + fp), tp / len(pos)
    return round(auc, 6), round(ap, 6)


def test_classifier_metrics(spark):
    import random

    r = random.Random(3)
    rows = [(int(r.random() < 0.4), round(r.random(), 2)) for _ in range(500)]
    got = learn.metrics(spark.createDataFrame(rows, "y int, p double"), "y", "p").first()
    assert (got["roc_auc"], got["average_precision"]) == brute_metrics(*zip(*rows))


def test_split(spark):
    d = dt.date
    rows = [("t", d(2024, 1, 1), d(2024, 1, 2), 1), ("t", d(2025, 2, 1), d(2025, 2, 2), 0), ("u", d(2025, 2, 1), d(2025, 2, 3), 1), ("v", d(2024, 12, 20), d(2024, 12, 25), 0)]
    df = spark.createDataFrame(rows, "master_patient_id string, admit_date date, discharge_date date, readmitted_30d int")
    got = learn.split_counts(df, d(2025, 1, 1)).first()
    assert (got["train_admissions"], got["test_admissions"], got["future_returning_rows_excluded"], got["boundary_rows_excluded"]) == (1, 1, 1, 1)
    train, test = learn.temporal_split(df, d(2025, 1, 1))
    assert [r["master_patient_id"] for r in train.collect()] == ["t"] and [r["master_patient_id"] for r in test.collect()] == ["u"]


def test_whole_batch(spark, tmp_path):
    inputs = {}
    for name, df in generator.delivery(spark, 320, defects=True).items():
        path = tmp_path / f"{name}.csv"
        df.toPandas().to_csv(path, index=False)
        inputs[name] = str(path)
    out = str(tmp_path / "run")
    manifest = pipeline.run_batch(spark, inputs, out, KEY, dt.date(2025, 12, 31), dt.date(2025, 1, 1), config=quality.SilverConfig("dmy"))
    assert {k: v["quarantined"] for k, v in manifest["silver"].items()} == {"patients": 1, "admissions": 1, "lab_results": 1}
    assert manifest["gold"]["label_counts"] == {"negative": 320, "positive": 80}
    assert manifest["answers"]["matching_impact"]["after_rate_pct"] == 20.0
    split = manifest["experiment"]["split"]
    assert split["train_positives"] == 40 and split["test_positives"] == 40
    gate = spark.read.parquet(f"{out}/release/gate")
    assert sorted(r["check"] for r in gate.collect()) == sorted(release.CHECKS)
    with pytest.raises(EngineError):  # never into an existing folder
        pipeline.run_batch(spark, inputs, out, KEY, dt.date(2025, 12, 31), dt.date(2025, 1, 1))
    entry = manifest["published"]["breakdowns"]
    report = release.read_snapshot(spark, entry)
    bundle = release.export_bundle(report, spark.read.parquet(f"{out}/analytics/overall"), manifest["published"], *[dt.datetime(2025, 1, d, tzinfo=dt.timezone.utc) for d in (1, 1, 4)])
    release.check_bundle(bundle)
    assert bundle["freshness"] == "STALE" and "ADM-" not in str(bundle)
    with pytest.raises(EngineError):
        release.read_snapshot(spark, {**entry, "hash": "0"})
    gold = spark.read.parquet(f"{out}/gold/features")
    analytics = {k: spark.read.parquet(f"{out}/analytics/{k}") for k in ("overall", "breakdowns", "excluded")}
    check_gate(spark, out, gold, manifest, analytics)
    check_run(spark, out, inputs, manifest, gold)
    check_bundles(spark, str(tmp_path), bundle)


def check_gate(spark, out, gold, manifest, analytics):
    """Each of the thirteen checks fails alone, and publication needs them all."""
    audit, facts = release.analytics_audit(gold, analytics), manifest["gold"]
    reports = {"csv": f"{out}/release/breakdowns_csv", "json": f"{out}/release/breakdowns.json"}
    evidence = release.evidence_checks(spark, out, __version__)
    gate = release.run_gate(gold, facts, analytics, audit, evidence, reports)
    assert [(r["check"], r["status"]) for r in gate.collect()] == [(c, "PASS") for c in release.CHECKS]
    report, total = analytics["breakdowns"], analytics["overall"]
    release.verify_publication(report, total, gate, audit, facts, reports)
    other = {**analytics, "breakdowns": report.where("dimension != 'sex'")}
    shown = {**analytics, "breakdowns": report.withColumn("suppression_reason", F.when(F.col("dimension") == "hospital", "primary_small_cell").otherwise(F.col("suppression_reason")))}
    leaky = {**analytics, "breakdowns": report.withColumn("category", F.when(F.col("dimension") == "sex", gold.first()["admission_id"]).otherwise(F.col("category")))}
    off = {**analytics, "overall": total.withColumn("readmitted_admissions", F.lit(1).cast("long"))}
    prints = lambda a: release.analytics_audit(gold, a)
    files = lambda a: release.write_report(spark, f"{out}-{len(a['breakdowns'].head(1))}-{id(a)}", a["breakdowns"])
    cases = {name: (gold, facts, analytics, audit, {**evidence, name: lambda: False}, reports) for name in release.CHECKS[:4]} | {
        "gold_hash_lineage": (gold.limit(3), facts, analytics, audit, evidence, reports),
        "analytics_output_hashes": (gold, facts, other, audit, evidence, reports),
        "gold_row_uniqueness": (gold, {**facts, "gold_rows": 1}, analytics, audit, evidence, reports),
        "gold_label_audit_reconciliation": (gold, {**facts, "label_counts": {}}, analytics, audit, evidence, reports),
        "gold_analytics_reconciliation": (gold, facts, off, prints(off), evidence, reports),
        "breakdown_csv_json_reconciliation": (gold, facts, other, prints(other), evidence, reports),
        "suppression_integrity": (gold, facts, shown, prints(shown), evidence, files(shown)),
        "identifier_exclusion": (gold, facts, leaky, prints(leaky), evidence, files(leaky)),
        "rule_version_chain": (gold, {**facts, "rule_version": "other"}, analytics, audit, evidence, reports)}
    assert set(cases) == set(release.CHECKS)
    for name, case in cases.items():
        with pytest.raises(EngineError, match=name):
            release.run_gate(*case)
    with pytest.raises(EngineError, match="evidence"):  # no check passes unasked
        release.run_gate(gold, facts, analytics, audit, {}, reports)
    with pytest.raises(EngineError, match="gate"):
        release.verify_publication(report, total, gate.where("check != 'package_version'"), audit, facts, reports)
    with pytest.raises(EngineError, match="audited"):
        release.verify_publication(other["breakdowns"], total, gate, audit, facts, reports)
    with pytest.raises(EngineError, match="11"):
        release.verify_publication(report, total, gate, {**audit, "minimum_cell_size": 10}, facts, reports)


def check_run(spark, out, inputs, manifest, gold):
    """A moved null, a table too many and a changed delivery are all found."""
    pipeline.verify_run(spark, out, manifest, inputs)
    a, b = (spark.createDataFrame(rows, "a int, b int") for rows in ([(None, 1), (2, 2)], [(1, None), (2, 2)]))
    assert release.fingerprint(a) != release.fingerprint(b) and release.fingerprint(a) == release.fingerprint(a.repartition(3))
    assert release.fingerprint(a) != release.fingerprint(a.unionByName(a)) != release.fingerprint(a.withColumn("b", F.col("b").cast("long")))
    path = inputs["patients"]
    text = open(path).read()
    with open(path, "w") as f:
        f.write(text.replace("Lagos", "Kano", 1))
    with pytest.raises(EngineError, match="delivery of patients"):
        pipeline.verify_run(spark, out, manifest, inputs)
    with open(path, "w") as f:
        f.write(text)
    gold.limit(1).write.parquet(f"{out}/gold/extra")
    with pytest.raises(EngineError, match="not in the manifest"):
        pipeline.verify_run(spark, out, manifest, inputs)


def check_bundles(spark, folder, bundle):
    sinks.write_json(spark, f"{folder}/bundle.json", bundle)
    assert release.read_bundle(spark, f"{folder}/bundle.json") == bundle
    cell = bundle["breakdowns"][0]
    wrong = [{"freshness": "FRESH"}, {"published_at_utc": "2030-01-01T00:00:00+00:00"}, {"breakdowns": [cell, cell]}, {"breakdowns": [{**cell, "extra": 1}]},
             {"breakdowns": [{**cell, "readmission_rate_pct": 50.5}]}, {"breakdowns": [{**cell, "wilson_95_upper_pct": 99.9}]}, {"lineage": {"x": {"rows": 1, "hash": "0"}}}, {"more": 1}]
    for change in wrong:
        with pytest.raises(EngineError):
            release.check_bundle({**bundle, **change})
    status = {"run": {"id": "x", "secret": "y", "n": 3}, "list": [1], "ok": True}
    assert release.evidence_export(status, {"run": {"id": True, "n": True}, "list": True, "ok": True, "absent": True}) == {"run": {"id": "x", "n": 3}, "ok": True}


@pytest.mark.parametrize("shape,good,bad", [
    ("digest", "0" * 64, "0" * 63), ("uuid", "123e4567-e89b-12d3-a456-426614174000", "123e4567"), ("commit", "a" * 40, "A" * 40), ("identifier", "a_1", "1a"), ("host", "a.example-b.org", "-a.org")])
def test_shapes(shape, good, bad):
    assert release.valid(shape, good) and not release.valid(shape, bad) and not release.valid(shape, good + "\n") and not release.valid(shape, None)


def test_errors_and_views(spark):
    rows = spark.createDataFrame([("sex", "M", ""), ("sex", "F", "primary_small_cell")], "dimension string, category string, suppression_reason string")
    release.released_view(rows, "some_view")
    assert [r["category"] for r in spark.table("some_view").collect()] == ["M"]
    try:
        spark.sql("SELECT * FROM no_such_table_here").collect()
    except Exception as error:
        told = release.error_class(error)
    assert told["condition"] == "TABLE_OR_VIEW_NOT_FOUND" and "no_such" not in str(told)


def test_features_are_finite(spark):
    row = {**{c: 1.0 for c in learn.NUMERIC}, **{c: "x" for c in learn.CATEGORICAL}}
    learn.check_features(spark.createDataFrame([row]))
    for bad in (float("nan"), float("inf"), -1.0):
        with pytest.raises(EngineError):
            learn.check_features(spark.createDataFrame([{**row, "age_at_admit": bad}]))
