import datetime

import pytest
from pyspark.sql import functions as F

from claimloom.operators import staging
from claimloom.schemas import STAGING, WAREHOUSE, no_rows
from claimloom.sources.paths import shared_folder
from claimloom.sources.store import Store

SCHEMA = "id bigint"


def ids(df):
    return sorted(r.id for r in df.collect())


def schema(spark):
    return spark.range(0).schema


def test_last_committed_run_is_read(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert ids(store.read("t", schema(spark))) == []
    store.write("t", spark.range(3), "2024-01-01")
    store.write("t", spark.range(5), "2024-01-02")
    assert ids(store.read("t", schema(spark))) == [0, 1, 2, 3, 4]
    assert ids(store.read("t", schema(spark), before="2024-01-02")) == [0, 1, 2]
    assert len(ids(store.read_all("t", schema(spark)))) == 8


def test_unfinished_run_is_invisible(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write("t", spark.range(3), "1")
    store.write("t", spark.range(5), "2")
    (tmp_path / "t" / "run=2" / "_SUCCESS").unlink()
    assert ids(store.read("t", schema(spark))) == [0, 1, 2]


def test_run_is_replaced_by_itself_but_not_by_an_earlier_one(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write("t", spark.range(3), "1")
    store.write("t", spark.range(5), "2")
    store.write("t", spark.range(7), "2")
    assert len(ids(store.read_all("t", schema(spark)))) == 10
    with pytest.raises(ValueError, match="later than 1"):
        store.write("t", spark.range(1), "1")
    with pytest.raises(ValueError, match="not a run name"):
        store.write("t", spark.range(1), "a/b")


def test_superseded_runs_can_be_dropped(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for run in "123":
        store.write("t", spark.range(int(run)), run)
    store.drop_superseded("t", keep=1)
    assert store.runs("t") == ["3"]


def changes(spark, rows):
    """rows: (key, current)"""
    empty = no_rows(spark, WAREHOUSE["dim_policy"])
    keyed = spark.createDataFrame(rows, "policy_key bigint, is_current boolean")
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema if f.name not in keyed.columns]
    return keyed.select("*", *rest).select(*empty.columns)


def dim(store, before=None):
    rows = store.read_dimension("dim_policy", WAREHOUSE["dim_policy"], before).collect()
    return sorted((r.policy_key, r.is_current) for r in rows)


def test_dimension_is_open_rows_of_last_run_and_closed_rows_of_all(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert dim(store) == []
    store.write_changes("dim_policy", changes(spark, [(1, True), (2, True)]), "1", ["policy_id"])
    store.write_changes("dim_policy", changes(spark, [(1, False), (2, True), (3, True)]), "2", ["policy_id"])
    store.write_changes("dim_policy", changes(spark, [(2, False), (3, True), (4, True)]), "3", ["policy_id"])
    assert dim(store) == [(1, False), (2, False), (3, True), (4, True)]
    assert dim(store, before="3") == [(1, False), (2, True), (3, True)]


def test_filter_on_open_rows_reads_only_their_folder(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write_changes("dim_policy", changes(spark, [(1, False), (2, True)]), "1", ["policy_id"])
    open_rows = store.read_dimension("dim_policy", WAREHOUSE["dim_policy"]).filter("is_current")
    plan = open_rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1, plan
    assert [r.policy_key for r in open_rows.collect()] == [2]


def test_whole_rewrite_takes_over(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write_changes("dim_policy", changes(spark, [(1, False), (2, True)]), "1", ["policy_id"])
    store.write_changes("dim_policy", changes(spark, [(2, False), (3, True)]), "2", ["policy_id"])
    repaired = changes(spark, [(1, False), (3, True)])
    store.write_whole("dim_policy", changes(spark, []), ["policy_id"])
    assert dim(store) == []
    store.write_whole("dim_policy", repaired, ["policy_id"])
    assert dim(store) == [(1, False), (3, True)]
    store.write_changes("dim_policy", changes(spark, [(3, False), (4, True)]), "3", ["policy_id"])
    assert dim(store) == [(1, False), (3, False), (4, True)]
    assert dim(store, before="2") == [(1, False), (2, True)]


def test_many_loads_leave_few_folders_and_files(spark, tmp_path):
    store, schema, order = Store(spark, str(tmp_path)), WAREHOUSE["dim_policy"], ["policy_id"]
    for load in range(1, 9):  # each closes the row of the load before
        rows = [(load, True)] + ([(load - 1, False)] if load > 1 else [])
        store.write_changes("dim_policy", changes(spark, rows), f"{load:02d}", order)
        store.gather("dim_policy", schema, order, every=3)
        store.drop_superseded_parts("dim_policy")
        assert dim(store) == sorted([(k, False) for k in range(1, load)] + [(load, True)])
        assert dim(store, f"{load:02d}") == sorted([(k, False) for k in range(1, load - 1)] + [(load - 1, True)][: load - 1])
        assert len(list(tmp_path.glob("dim_policy/*/is_current=true"))) <= 2
        assert len(list(tmp_path.glob("dim_policy/*/is_current=false"))) <= 6
        assert len(list(tmp_path.glob("dim_policy/*/*/*.parquet"))) <= 24
    store.write_changes("dim_policy", changes(spark, [(9, True)]), "08", order)  # the last load again
    assert dim(store) == [(k, False) for k in range(1, 7)] + [(9, True)]


def test_last_key_is_that_of_the_last_run_or_unknown(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.last_key("dim_policy", "1") is None
    store.write_changes("dim_policy", changes(spark, [(7, True)]), "1", ["policy_id"])
    assert store.last_key("dim_policy", "2") is None  # the run died before it was noted
    store.note_last_key("dim_policy", 7, "1")
    store.write_whole("dim_policy", changes(spark, [(7, True)]), ["policy_id"])
    assert store.last_key("dim_policy", "2") == 7 and store.last_key("dim_policy", "1") is None


def test_staging_selects_by_name_and_reports_what_does_not_fit(spark):
    landed = spark.createDataFrame(
        [("x" * 60, 1, datetime.date(2024, 1, 1)), ("ok", None, None), (None, 3, None)],
        "payment_type string, payment_id bigint, payment_date date",
    )
    rows = staging.staged(landed, STAGING["payments"])
    assert rows.columns == STAGING["payments"].fieldNames()
    out = {r.payment_id: r.faults for r in staging.rejects(rows, STAGING["payments"]).collect()}
    assert out == {1: ["payment_type is longer than 50"], None: ["payment_id is NULL"]}
    assert rows.filter(staging.is_faulty(STAGING["payments"])).count() == 2
    with pytest.raises(staging.LoadError, match="payment_id"):
        staging.staged(landed.drop("payment_id"), STAGING["payments"])


class _Session:
    """A session without spark.checkpoint.dir."""

    def __init__(self, master, configured=None):
        self.conf = self
        self.sparkContext = self
        self.master, self.configured, self.chosen = master, configured, None

    def get(self, key, default):
        return self.configured

    def getCheckpointDir(self):
        return self.chosen

    def setCheckpointDir(self, path):
        self.chosen = path


def test_shared_folder_is_the_clusters_own():
    assert shared_folder(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"))
    local = _Session("local[2]")
    assert shared_folder(local) == shared_folder(local) == local.chosen
