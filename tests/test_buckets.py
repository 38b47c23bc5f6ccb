"""Header and item tables in buckets of the key: one shuffle for the sums per issuer."""

from __future__ import annotations

import uuid

import pytest
from conftest import SF_SMALL

from fiscalflow.operators import records, reports
from fiscalflow.plans import catalog, pipeline
from fiscalflow.sources import star
from fiscalflow.sources.messages import FileLog


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The same notes in two databases: {buckets: database}."""
    log = FileLog(str(tmp_path_factory.mktemp("buckets") / "log"))
    log.write(records.to_messages(star.records(star.Tables(spark, SF_SMALL))))
    out = {}
    for n in (None, 8):
        db = out[n] = "buckets_" + uuid.uuid4().hex[:8]
        pipeline.run_persist(spark, log, db=db, buckets=n)
        pipeline.run_persist(spark, log, db=db, buckets=n)     # replaced by itself
    yield out
    for db in out.values():
        catalog.drop_database(spark, db)


def check(spark, db):
    return reports.conferencia_emitente(*(catalog.read_table(spark, t, db) for t in (pipeline.NOTAS_TABLE, pipeline.ITENS_TABLE)))


def shuffles(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return sum("Exchange hashpartitioning" in line for line in final.splitlines())


def test_one_shuffle_and_the_same_rows(spark, tables):
    plain, dealt = check(spark, tables[None]), check(spark, tables[8])
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, dealt.collect()))
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(check(spark, tables[8])) == 1 and shuffles(check(spark, tables[None])) >= 3
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")


def test_a_file_for_each_bucket(spark, tables):
    for t in (pipeline.NOTAS_TABLE, pipeline.ITENS_TABLE):
        assert len(catalog.read_table(spark, t, tables[8]).inputFiles()) <= 8
