"""Writers that die at any step leave a readable table (S8, compaction)."""

from __future__ import annotations

import uuid

import pytest

from fiscalflow.plans import catalog
from fiscalflow.session import list_folders
from fiscalflow.streaming import incremental


@pytest.fixture()
def db(spark):
    name = "swap_" + uuid.uuid4().hex[:8]
    catalog.ensure_database(spark, name)
    yield name
    catalog.drop_database(spark, name)


def values(spark, db, name="t"):
    return sorted(r[0] for r in catalog.read_table(spark, name, db).collect())


def dies(*_):
    raise RuntimeError("driver lost")


def test_replaced_by_one_catalog_change(spark, db, monkeypatch):
    catalog.save_table(spark.range(3), "t", db)
    first = catalog.location(spark, "t", db)
    with monkeypatch.context() as m:
        m.setattr(catalog, "_point", dies)                      # written, but not pointed to
        with pytest.raises(RuntimeError):
            catalog.save_table(spark.range(10), "t", db)
    assert values(spark, db) == [0, 1, 2] and catalog.location(spark, "t", db) == first
    with monkeypatch.context() as m:
        m.setattr(catalog, "remove_folder", dies)               # pointed to, old folder left
        with pytest.raises(RuntimeError):
            catalog.save_table(spark.range(5), "t", db)
    assert values(spark, db) == [0, 1, 2, 3, 4]
    again = catalog.read_table(spark, "t", db)
    catalog.save_table(again.selectExpr("id + 100 AS id"), "t", db)     # from itself
    assert values(spark, db) == [100, 101, 102, 103, 104]
    assert catalog.remove_unused_versions(spark, "t", db) == 1
    base = catalog.location(spark, "t", db).rsplit("/", 1)[0]
    catalog.drop_table(spark, "t", db)
    assert not [f for f in list_folders(spark, base) if catalog.VERSION in f]


@pytest.mark.parametrize("step", [1, 2])
def test_a_swap_by_renames_is_finished(spark, db, monkeypatch, step):
    catalog.save_table(spark.range(3), "t", db)

    def half(spark_, target, new, old):
        catalog._rename(spark_, target, old)
        if step == 2:
            catalog._rename(spark_, new, target)
        dies()

    with monkeypatch.context() as m:
        m.setattr(catalog, "_swap", half)
        with pytest.raises(RuntimeError):
            catalog.save_table(spark.range(4).selectExpr("id", "'x' AS more"), "t", db)     # other columns
    assert values(spark, db) == [0, 1, 2, 3]
    catalog.save_table(spark.range(2), "t", db)
    assert values(spark, db) == [0, 1]


def test_partitioned_tables(spark, db):
    for n in (4, 7):
        catalog.save_table(spark.range(n).selectExpr("id", "id % 2 AS p"), "t", db, partition_by=["p"])
        assert values(spark, db) == list(range(n))


@pytest.mark.parametrize("step", [0, 1, 2, 3])
def test_a_compaction_that_died(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "tables")
    notes = "string(id) AS chNFe, id AS v, timestamp'2024-01-01' AS timestamp, 1L AS batch, 0 AS partition, id AS offset, {} AS epoch"
    for e in (0, 1):
        for name in ("nfe_notas", "nfe_itens"):
            spark.range(5).selectExpr(*[x.strip() for x in notes.format(f"{e}L").split(", ")]).write.partitionBy("epoch").mode("append").parquet(f"{root}/{name}")
    want = sorted(map(tuple, incremental.latest_notas(spark, root).collect()))
    calls = []

    def counted(real):
        def run(*args):
            if len(calls) == step:
                dies()
            calls.append(1)
            return real(*args)
        return run

    with monkeypatch.context() as m:
        m.setattr(incremental, "rename_folder", counted(incremental.rename_folder))
        with pytest.raises(RuntimeError):
            incremental.compact(spark, root)
    assert sorted(map(tuple, incremental.latest_notas(spark, root).collect())) == want
    assert incremental.latest_itens(spark, root).count() == 5
    incremental.compact(spark, root)
    assert sorted(map(tuple, incremental.latest_notas(spark, root).collect())) == want and incremental.latest_itens(spark, root).count() == 5
