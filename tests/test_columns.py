"""Columns added to dimensions, dropped from published tables, and their declared types."""

import datetime

import pytest
from test_pipeline import deliver, person

from claimloom.plans import catalog
from claimloom.plans.pipeline import Warehouse
from claimloom.schemas import FILE_HEADERS

D1, D2, D3 = (datetime.date(2024, 1, 31), datetime.date(2024, 2, 1), datetime.date(2024, 2, 2))
EMAIL = {"claimants.csv": FILE_HEADERS["claimants.csv"] + ",email,age"}
STEPS = ("extraction", "transformation", "loading")


def rows(warehouse, columns):
    found = warehouse.table("dim_claimant").select(*columns).collect()
    return sorted(map(tuple, found), key=repr)


def test_added_attributes_reach_the_dimension_and_dropped_columns_stay_away(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    warehouse.run(deliver(tmp_path / "1", [person(10, "F"), person(11, "F")]), D1, D1, steps=STEPS)
    catalog.publish(warehouse, D1)
    catalog.add_column(warehouse, "warehouse.dim_claimant", "email", "string", tracked=True)
    catalog.add_column(warehouse, "warehouse.dim_claimant", "age", "int")
    assert {r.email for r in spark.table("warehouse.dim_claimant").collect()} == {None}
    people = [person(10, "M") + ",a@b,30", person(11, "F") + ",c@d,31", person(12, "F") + ", e@f ,old"]
    warehouse.run(deliver(tmp_path / "2", people, headers=EMAIL), D2, D2, steps=STEPS)
    want = [(10, None, None, False), (10, "a@b", 30, True), (11, None, None, True), (12, "e@f", None, True)]
    assert rows(warehouse, ["claimant_id", "email", "age", "is_current"]) == sorted(want, key=repr)
    # A change from one e-mail to another opens a version; one from or to nothing does not.
    people[0] = person(10, "M") + ",x@y,30"
    warehouse.run(deliver(tmp_path / "3", people, headers=EMAIL), D3, D3, steps=STEPS)
    found = rows(warehouse, ["email", "age", "is_current"])
    assert ("a@b", 30, False) in found and ("x@y", 30, True) in found and len(found) == 5
    catalog.publish(warehouse, D3)
    table = spark.table("warehouse.dim_claimant")
    assert sorted(map(repr, table.select("claimant_id", "email", "age", "is_current").collect())) == sorted(
        map(repr, warehouse.table("dim_claimant").select("claimant_id", "email", "age", "is_current").collect())
    )

    spark.sql("ALTER TABLE warehouse.dim_claimant SET TBLPROPERTIES ('kept' = 'yes')")
    for dropped in ("warehouse.dim_claimant", "staging.stg_claimants"):
        before = spark.table(dropped).count()
        catalog.drop_column(warehouse, dropped, "last_name")
        for date in (D3, D1, D3):
            assert "last_name" not in spark.table(dropped).columns
            catalog.publish(warehouse, date)
        assert spark.table(dropped).count() == before > 0
    assert "kept" in str(spark.sql("SHOW TBLPROPERTIES warehouse.dim_claimant").collect())
    assert spark.sql("SELECT count(*) FROM warehouse.dim_claimant WHERE is_current").first()[0] == 3
    catalog.add_column(warehouse, "staging.stg_claimants", "last_name", "string")
    assert {r.last_name for r in spark.table("staging.stg_claimants").collect()} == {"Lee"}
    with pytest.raises(ValueError, match="not without claimant_id"):
        catalog.drop_column(warehouse, "warehouse.dim_claimant", "claimant_id")
    with pytest.raises(ValueError, match="a view reads coverage_type"):
        catalog.drop_column(warehouse, "warehouse.dim_policy", "coverage_type")

    kinds = {r.col_name: r.data_type for r in spark.sql("DESCRIBE warehouse.dim_claimant").collect()}
    assert kinds["first_name"] == "varchar(100)" and kinds["gender"] == "varchar(10)"
    assert dict(spark.table("warehouse.dim_claimant").dtypes)["gender"] == "string"
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|length limitation"):
        spark.sql("INSERT INTO staging.stg_payments (payment_id, payment_type) VALUES (1, repeat('x', 51))")


