import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import resharding
from claimloom.llm.resharding import ShardedTable, equal_capacities, min_cost_flow

SCHEMA = "doc_id bigint, text string"


def flows(supply, capacity):
    """Every way to place the supplies."""
    if not supply:
        yield []
        return
    for parts in itertools.product(*[range(min(supply[0], c) + 1) for c in capacity]):
        if sum(parts) == supply[0]:
            for rest in flows(supply[1:], [c - p for c, p in zip(capacity, parts)]):
                yield [parts, *rest]


def test_flow_against_every_flow():
    draw = random.Random(1)
    for _ in range(60):
        n, m = draw.randint(1, 3), draw.randint(1, 3)
        supply = [draw.randint(0, 3) for _ in range(n)]
        capacity = [draw.randint(0, 4) for _ in range(m)]
        cost = np.array([[draw.randint(0, 9) for _ in range(m)] for _ in range(n)])
        if sum(capacity) < sum(supply):
            with pytest.raises(ValueError, match="do not fit"):
                min_cost_flow(supply, capacity, cost)
            continue
        flow = min_cost_flow(supply, capacity, cost)
        assert flow.sum(axis=1).tolist() == supply and (flow.sum(axis=0) <= capacity).all() and (flow >= 0).all()
        assert (flow * cost).sum() == min((np.array(f) * cost).sum() for f in flows(supply, capacity))


def test_flow_moves_the_surplus_only():
    old, new = [500, 100, 300], equal_capacities(900, 4)
    flow = min_cost_flow(old, new, 1 - np.eye(3, 4))
    assert flow.sum() - np.trace(flow) == sum(max(0, o - c) for o, c in zip(old, new))


def table_of(spark, sizes, folder, shard="doc_id % 3", shards=3):
    rows = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(sizes)], SCHEMA)
    rows.write.parquet(folder)
    rows = spark.read.parquet(folder)
    return ShardedTable.create(rows, F.expr(shard), F.length("text"), shards)


def contents(table):
    return sorted((r.row.doc_id, r.row.text) for r in table.rows().collect())


def slots_without_gaps(table):
    found = {}
    for r in table.rows().collect():
        found.setdefault(r.shard, []).append(r.slot)
    return all(sorted(slots) == list(range(len(slots))) for slots in found.values())


def test_resharding_keeps_rows_and_moves_little(spark, tmp_path):
    draw = random.Random(2)
    table = table_of(spark, [draw.randint(1, 40) for _ in range(900)], str(tmp_path / "t"))
    for shards in (5, 8, 2):
        capacity = equal_capacities(sum(table.sizes()), shards)
        least = sum(table.sizes()) - sum(min(a, b) for a, b in itertools.zip_longest(table.sizes(), capacity, fillvalue=0))
        after = table.reshard(capacity)
        assert max(after.sizes()) - min(after.sizes()) <= 40
        assert after.moved_bytes <= least + 40 * (shards + table.shards)
        assert contents(after) == contents(table) and slots_without_gaps(after)
        table = after


def test_untouched_files_are_kept(spark, tmp_path):
    table = table_of(spark, [10] * 90, str(tmp_path / "t"))
    after = table.reshard([400, 200, 300])
    assert after.sizes() == [400, 200, 300] and after.moved_bytes == 100
    own = [f for f in table.files() if "shard=2" in f]
    assert own and set(own) <= set(after.files())
    assert table.reshard([300, 300, 300]).files() == table.files()


def test_blocks_in_several_files(spark, tmp_path):
    table = table_of(spark, [10] * 3000, str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for shards in (4, 3, 7):
            after = table.reshard(equal_capacities(30_000, shards))
            assert contents(after) == contents(table) and slots_without_gaps(after)
            table = after
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_costs_decide_where_bytes_go(spark, tmp_path):
    table = table_of(spark, [10] * 30, str(tmp_path / "t"), "0", 1)
    after = table.reshard([100, 100, 300], np.array([[0, 5, 1]]))
    assert after.sizes() == [100, 0, 200]


def test_text_larger_than_a_share_stays_whole(spark, tmp_path):
    table = table_of(spark, [5000] + [1] * 200, str(tmp_path / "t"))
    after = table.reshard(equal_capacities(5200, 4))
    assert sorted(after.sizes())[-1] == 5000 and max(sorted(after.sizes())[:3]) - min(after.sizes()) <= 1


def query(spark, df, folder):
    df.write.parquet(folder)
    return resharding.grow_documents(spark.read.parquet(folder)).collect()


def test_documents(spark, tmp_path):
    texts = [None, "", "é", "same"] + ["same"] * 400 + [f"text {k} " * (k % 30) for k in range(600)]
    rows = [(None if k % 50 == 0 else k // 2, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "2 AS shard", "3 AS block", "4 AS place")
    found = query(spark, df, str(tmp_path / "d"))
    expected = sorted(repr((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in rows)
    assert sorted(repr((r.doc_id, r["size"], r.text_crc32)) for r in found) == expected
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    load = [sum(r["size"] for r in found if r.shard == s) for s in range(16)]
    assert max(load) - min(load) <= max(r["size"] for r in found)
    for s in range(16):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_empty_table(spark, tmp_path):
    assert query(spark, spark.createDataFrame([], SCHEMA), str(tmp_path / "d")) == []


def test_registered_query_on_the_given_table(spark):
    from claimloom.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    found = queries.QUERIES["op12_resharding"](spark, "/root/testdata/sf0.01").collect()
    assert sorted((r.doc_id, r["size"]) for r in found) == sorted((d.doc_id, len((d.text or "").encode()) + 1) for d in docs)
    load = [sum(r["size"] for r in found if r.shard == s) for s in range(16)]
    assert max(load) - min(load) <= 0.01 * sum(load) / 16
