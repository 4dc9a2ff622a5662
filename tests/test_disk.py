"""What a run leaves on disk: compressed deliveries, no inbox that was copied, no shuffle files."""

import datetime
import gzip
import hashlib
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_deliveries import DAY, HEADER, put
from test_pipeline import D1, deliver, person

import __spark_entry__ as entry
from claimloom.plans.pipeline import Warehouse
from claimloom.sources import deliveries
from claimloom.sources.paths import shared_folder, shuffles_removed

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_compressed_parts_are_copied_as_they_are_and_read(spark, tmp_path):
    inbox, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    lines = {"a": "1,1,2024-02-01,5.5,medical,\n", "b": "2,3,2024-02-02,6.5,medical,\n" * 5000}
    parts = {name: gzip.compress(f"{HEADER}\n{rows}".encode()) for name, rows in lines.items()}
    for name, part in parts.items():
        put(inbox, f"payments.csv/{name}.csv.gz", part)
    files, _ = deliveries.list_files(spark, inbox)
    deliveries.check_contract(deliveries.contract_report(deliveries.file_headers(spark, files)))
    manifest = deliveries.copy_to_raw(spark, files, raw, DAY).collect()
    want = {(f"{name}.csv.gz", hashlib.md5(part).hexdigest(), len(part)) for name, part in parts.items()}
    assert {(Path(r.path).name, r.md5, r.length) for r in manifest} == want
    assert {(p.name, hashlib.md5(p.read_bytes()).hexdigest(), p.stat().st_size) for p in Path(raw).rglob("*.gz")} == want
    rows = deliveries.read_raw(spark, raw, DAY, ["payments.csv"])["payments.csv"]
    assert {(r.payment_id, r["count"]) for r in rows.groupBy("payment_id").count().collect()} == {("1", 1), ("2", 5000)}


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {p for folder in disk.localDirsString() for p in Path(folder).rglob("shuffle_*")}


def test_a_run_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    spark.range(100).groupBy((F.col("id") % 5).alias("k")).count().write.parquet(str(tmp_path / "before"))
    before, found = shuffle_files(spark), {}

    def noting(step):
        does = getattr(Warehouse, step)

        def noted(*given):
            found[step] = spark.conf.get(SETTING)
            return does(*given)

        return noted

    for step in ("extract", "transform", "load", "check"):
        monkeypatch.setattr(Warehouse, step, noting(step))
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    warehouse.run(deliver(tmp_path / "in", [person(10, "F"), person(11, "")]), D1, D1, row_floor=1)
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:  # they go beside the next query
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert found == dict.fromkeys(("extract", "transform", "load", "check"), "true")
    assert spark.conf.get(SETTING) == "false"


def test_the_setting_is_given_back_when_all_are_done(spark):
    spark.conf.set(SETTING, "false")
    try:
        with shuffles_removed(spark):
            with pytest.raises(KeyError), shuffles_removed(spark):
                raise KeyError
            assert spark.conf.get(SETTING) == "true"
        assert spark.conf.get(SETTING) == "false"
    finally:
        spark.conf.unset(SETTING)


@pytest.fixture
def tables(spark, tmp_path):
    """A few rows of every table the deliveries are made of."""
    day = datetime.datetime(1997, 5, 1)
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "AFRICA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "KENYA", 0)]),
        "customer": (
            "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double",
            [(i, f"c{i}", "BUILDING", 1.0 - i % 2) for i in range(24)],
        ),
        "supplier": (
            "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
            [(i, f"s{i}", 0, 1.0) for i in range(3)],
        ),
        "part": ("p_partkey bigint, p_size int, p_retailprice double", [(i, 6 + i % 30, 10.0) for i in range(20)]),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string, "
            "o_orderstatus string, o_totalprice double",
            [(i, i % 24, day, "1-URGENT", "O", 200.0 + i) for i in range(60)],
        ),
        "lineitem": (
            "l_orderkey bigint, l_linenumber int, l_shipdate timestamp_ntz, l_extendedprice double, "
            "l_returnflag string, l_linestatus string",
            [(i % 60, i // 60, day, 5.0, "A", "O") for i in range(180)],
        ),
    }
    for name, (schema, content) in rows.items():
        spark.createDataFrame(content, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_a_delivery_is_compressed_and_goes_once_it_is_copied(spark, tables, monkeypatch):
    monkeypatch.setattr(entry, "PART_ROWS", 100)
    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.glob("inbox*"))
    results = []
    warehouse = entry._two_days(spark, tables, results=results)
    assert [r.landed_rows["payments"] for r in results] == [180, 180]
    assert set(shared.glob("inbox*")) == before
    raw = [p for p in Path(warehouse.raw.removeprefix("file:")).rglob("part-*")]
    assert raw and all(p.name.endswith(".csv.gz") for p in raw)
    payments = [p for p in raw if "payments.csv" in p.parts]
    lines = {p: len(gzip.open(p).readlines()) - 1 for p in payments}
    assert max(lines.values()) <= 100 and sum(lines.values()) == 2 * 180


def test_outcomes_of_runs_leave_no_deliveries(spark, tables):
    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = {*shared.glob("inbox*"), *shared.glob("broken*")}
    outcomes = {r.case_name: r.outcome for r in entry._run_outcomes(spark, tables).collect()}
    assert "missing columns ['claim_id']" in outcomes["broken delivery"]
    assert {*shared.glob("inbox*"), *shared.glob("broken*")} == before
