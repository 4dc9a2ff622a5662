"""Files of tables: ranges that do not overlap, repeated loads under published tables, run names."""

import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_pipeline import deliver, person

from claimloom.plans import catalog
from claimloom.plans.pipeline import Warehouse
from claimloom.sources.paths import Folder
from claimloom.sources.store import Store, clustered

D1, D2 = datetime.date(2024, 1, 31), datetime.date(2024, 2, 1)


def claims(spark, n):
    """A third of the rows share one day, some have none."""
    day = F.expr("CASE WHEN id % 3 = 0 THEN 20240105 WHEN id % 50 <> 1 THEN 20240100 + id % 31 END").cast("int")
    return spark.range(n).select(F.col("id").alias("claim_id"), day.alias("day")).repartition(5, "claim_id")


def written(spark, folder, rows, rows_per_file=100):
    store = Store(spark, str(folder), rows_per_file)
    store.write("t", clustered(rows, ["day", "claim_id"]), "1")
    store.note_ranges("t", ["day", "claim_id"])
    return store


def test_files_do_not_overlap_also_where_one_value_fills_several(spark, tmp_path):
    store = written(spark, tmp_path, claims(spark, 3000))
    ranges = store.file_ranges("t").collect()
    assert len(ranges) >= 30 and sum(r.rows for r in ranges) == 3000 and max(r.rows for r in ranges) <= 100
    order = sorted(((r.low.day or 0, r.low.claim_id), (r.high.day or 0, r.high.claim_id)) for r in ranges)
    assert all(high < low for (_, high), (low, _) in zip(order, order[1:]))


def test_a_look_up_opens_only_the_files_it_needs(spark, tmp_path):
    rows = claims(spark, 3000)
    store = written(spark, tmp_path, rows)
    for low, high in ((20240109, 20240109), (20240105, 20240105), (20240120, 20240122), (20250101, 20250102)):
        found = store.read_between("t", rows.schema, "day", low, high)
        want = rows.filter(F.col("day").between(low, high))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
        assert len(found.inputFiles()) <= 2 + want.count() / 100
    assert len(store.read("t", rows.schema).inputFiles()) >= 30


def test_without_noted_ranges_everything_is_read(spark, tmp_path):
    store, rows = Store(spark, str(tmp_path)), claims(spark, 200)
    assert store.file_ranges("t") is None and store.read_between("t", rows.schema, "day", 1, 2).collect() == []
    store.write("t", rows, "1")
    assert store.read_between("t", rows.schema, "day", 20240105, 20240105).count() == rows.filter("day = 20240105").count()


def test_attempts_replace_one_another_and_go_when_nothing_points_to_them(spark, tmp_path):
    store, schema = Store(spark, str(tmp_path)), spark.range(0).schema
    store.write("t", spark.range(3), "1")
    store.write("t", spark.range(4), "2")
    store.note_published("t", ["2"])
    for n in (5, 6):
        store.write("t", spark.range(n), "2")
        store.drop_superseded("t")
        assert store.read("t", schema).count() == n and store.read("t", schema, before="2").count() == 3
        assert spark.read.parquet(store.path("t", "2")).count() == 4  # what is published stays
    assert store.runs("t") == ["1", "2.again-2"]
    store.note_published("t", ["2.again-2"])
    store.drop_superseded("t")
    assert sorted(f.name for f in (tmp_path / "t").iterdir()) == ["run=1", "run=2.again-2"]
    (tmp_path / "t" / "run=2.again-2" / "_SUCCESS").unlink()
    assert store.last_attempt("t", "2") is None and store.begin("t", "2").endswith("run=2.again-3")
    assert not (tmp_path / "t" / "run=2.again-2").exists()


def test_readers_of_published_tables_see_a_repeated_load_only_when_it_is_published(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    inbox = deliver(tmp_path / "in", [person(10, "F"), person(11, "")])
    warehouse.run(inbox, D1, D1, row_floor=1)
    catalog.publish(warehouse, D1)
    tables = ("staging.stg_claims", "warehouse.fact_claim", "warehouse.fact_payment", "warehouse.dim_claimant")
    before = {t: spark.table(t).count() for t in tables}
    assert min(before.values()) > 0
    inbox = deliver(tmp_path / "more", [person(10, "F"), person(11, ""), person(12, "")])
    seen = []

    def watched(*args, write=warehouse.store.write, **more):
        seen.append({t: spark.sql(f"SELECT count(*) FROM {t}").first()[0] for t in tables})
        write(*args, **more)

    warehouse.store.write = watched
    for _ in range(2):
        warehouse.run(inbox, D1, D1, row_floor=1)
    assert len(seen) > 6 and all(s == before for s in seen)
    assert warehouse.table("dim_claimant").count() == 3 == before["warehouse.dim_claimant"] + 1
    catalog.publish(warehouse, D1)
    assert spark.table("warehouse.dim_claimant").count() == 3
    folders = [f.name for f in (tmp_path / "root/tables/fact_claim").iterdir()]
    assert len(folders) == 1 and len(list((tmp_path / "root/landing/claims").iterdir())) == 1


def test_named_runs_are_numbered_like_others(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    noted = lambda run: warehouse.store.write("schema_registry", spark.range(1), run)
    names = []
    for name, day in ((None, D1), ("backfill", D1), ("backfill", D2), (None, D1), ("000003_2024-01-31_2024-01-31", D2), (None, D2)):
        names.append(warehouse.run_id(day, day, name))
        noted(names[-1])
    assert names == [
        "000001_2024-01-31_2024-01-31", "000002_backfill", "000002_backfill", "000003_2024-01-31_2024-01-31",
        "000003_2024-01-31_2024-01-31", "000004_2024-02-01_2024-02-01",
    ]
    with pytest.raises(ValueError, match="later than"):
        noted("000002_backfill")


def test_files_are_moved_into_place_by_the_tasks_that_wrote_them(spark, tmp_path, monkeypatch):
    given, option = {}, DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: given.update({k: v}) or option(self, k, v))
    store = Store(spark, str(tmp_path), rows_per_file=10)
    store.write("t", spark.range(0, 100, 1, 2), "1")
    assert given["mapreduce.fileoutputcommitter.algorithm.version"] == "2"
    assert spark.read.parquet(store.path("t", "1")).count() == 100
    # Files that a run has left without ending it are not seen, and go when it is repeated.
    Folder(spark, store.path("t", "1")).child("_SUCCESS").delete()
    assert store.runs("t") == []
    store.write("t", spark.range(3), "1")
    assert spark.read.parquet(store.path("t", store.runs("t")[-1])).count() == 3
