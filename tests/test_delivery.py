"""The delivery's queries against DuckDB, over the smallest test tables."""

import math
import os

import pytest
from pyspark.sql import functions as F

from lodeworks.operators import identity, quality
from lodeworks.plans import delivery, delivery_oracles
from lodeworks.schemas import PATIENTS
from lodeworks.sources.scratch import stash

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the test tables are not there")


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    return str(value) if isinstance(value, (str, bool)) else f"{float(value):.9g}"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in ("customer", "orders", "lineitem"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(delivery.QUERIES) == set(delivery_oracles.ORACLES)


@pytest.mark.parametrize("name", sorted(delivery.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = delivery.QUERIES[name](spark, FOLDER)
    want = duck.sql(delivery_oracles.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("far", (range(40_000, 40_120), (20_002, 20_003, 200_020, 200_021)), ids=("birth dates repeat", "six digits"))
def test_persons_share_no_block(spark, tmp_path, far):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE TABLE customer AS SELECT unnest({[*range(120), *far]}) AS c_custkey")
    con.sql(f"COPY customer TO '{tmp_path}/customer.parquet'")
    want = dict(con.sql(f"SELECT counter, rows FROM ({delivery_oracles.ORACLES['identity_counters']})").fetchall())
    rows = stash(quality.accepted(quality.classify_patients(delivery.raw_patients(spark, str(tmp_path)), delivery.CONFIG)), "patients")
    rows = stash(identity.normalise(rows.select(*[F.col(f"s_{c}").alias(c) for c in PATIENTS])), "normalised")
    assert (rows.count(), identity.candidates(rows).count()) == (want["input_patients"], want["candidate_pairs_generated"])
