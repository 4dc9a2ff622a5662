"""Lines that no entity takes are kept with their file, and counted."""

import datetime
import os

import pytest
from test_pipeline import T, deliver, person

from claimloom.plans import catalog
from claimloom.plans.pipeline import StepError, Warehouse
from claimloom.schemas import FILE_HEADERS
from claimloom.sources import deliveries

D1, D2 = datetime.date(2024, 1, 31), datetime.date(2024, 2, 1)


def test_lines_with_more_or_fewer_fields_are_kept_apart(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b,c\n1,2,3\n4,5\n6,7,8,9\n,,\n"x,y",2,\n')
    scan = deliveries.read_csv(spark, {str(path): ["a", "b", "c"]})
    good = deliveries.well_formed(scan)
    assert good.columns == ["a", "b", "c"]
    assert sorted(map(str, map(tuple, good.collect()))) == ["('1', '2', '3')", "('x,y', '2', None)", "(None, None, None)"]
    assert good.select("b").filter("a = '1'").collect() == [("2",)]  # the same when few columns are read
    bad = deliveries.quarantine(scan, "payments.csv", D1).collect()
    assert sorted((r.line, r.fault) for r in bad) == [
        ("4,5", "not as many fields as the header"), ("6,7,8,9", "not as many fields as the header"),
    ]
    assert {(r.name, r.entity, os.path.basename(r.file), r.ingestion_date) for r in bad} == {
        ("payments.csv", "payments", "x.csv", D1)
    }


def test_a_run_counts_what_it_leaves_out(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    people = [person(10, "F"), "11,cut off", person(12, "M") + ",surplus", person("", "F"), person("x7", "F")]
    inbox = deliver(tmp_path / "in", people)
    result = warehouse.run(inbox, D1, D1, steps=("extraction", "transformation"))
    assert result.landed_rows["claimants"] == 1 and result.quarantined == {"claimants.csv": 4}
    kept = sorted((r.fault, r.line) for r in warehouse.quarantine().collect())
    rest = f"Ann,Lee,1990-01-01,F,2015-01-01,7,{T},{T}"
    assert kept == [
        ("no readable key", "," + rest), ("no readable key", "x7," + rest),
        ("not as many fields as the header", "11,cut off"),
        ("not as many fields as the header", people[2]),
    ]
    # The delivery mended and run again: nothing is left of its first attempt.
    again = warehouse.run(deliver(tmp_path / "in", people[:1]), D1, D1, steps=("extraction", "transformation"))
    assert again.run_id == result.run_id and again.quarantined == {} and warehouse.quarantine().count() == 0


def test_parts_of_one_file_and_days_are_told_apart(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    for day, lines in ((D1, ["1,2"]), (D2, ["3", "4,5,6"])):
        inbox = tmp_path / str(day)
        deliver(inbox, [], drop=("claimants.csv",))
        os.makedirs(inbox / "claimants.csv")
        for i, line in enumerate([*lines, person(10, "F")]):
            text = FILE_HEADERS["claimants.csv"] + "\n" + line + "\n"
            (inbox / "claimants.csv" / f"part-{i}.csv").write_text(text)
        assert warehouse.run(str(inbox), day, day, row_floor=1, steps=("extraction", "transformation")).quarantined == {
            "claimants.csv": len(lines)
        }
    found = {(r.ingestion_date, os.path.basename(r.file), r.line) for r in warehouse.quarantine().collect()}
    assert found == {(D1, "part-0.csv", "1,2"), (D2, "part-0.csv", "3"), (D2, "part-1.csv", "4,5,6")}
    warehouse.run("", D2, D2, row_floor=1, steps=("loading",))
    catalog.publish(warehouse, D2)
    assert spark.sql("SELECT count(*) FROM staging.quarantine GROUP BY run ORDER BY 1").collect() == [(1,), (2,)]


def test_files_without_faulty_lines_are_not_read_for_the_quarantine(spark, tmp_path, monkeypatch):
    read = []
    quarantine = deliveries.quarantine
    monkeypatch.setattr(deliveries, "quarantine", lambda scan, name, *rest: read.append(name) or quarantine(scan, name, *rest))
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    steps = ("extraction", "transformation")
    people = [person(10, "F"), person("x7", "F")]
    inbox = deliver(tmp_path / "in", people, claims2=["5,cut off"])
    result = warehouse.run(inbox, D1, D1, steps=steps)
    assert sorted(read) == ["claimants.csv", "claims_v2.csv"]
    assert result.quarantined == {"claimants.csv": 1, "claims_v2.csv": 1} and result.landed_rows["claims"] == 2
    read.clear()
    assert warehouse.run(deliver(tmp_path / "in", people[:1]), D2, D2, steps=steps).quarantined == {}
    assert read == [] and warehouse.quarantine().count() == 2


def test_lines_are_kept_apart_where_a_landing_fails(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    without_key = f",11,100,2024-01-07,2024-01-08,medical,CLOSED,20,10,{T},{T},high"
    inbox = deliver(tmp_path / "in", [person(10, "F"), "11,cut off"], claims2=[without_key])
    with pytest.raises(StepError, match="claims: 1 rows do not fit"):
        warehouse.run(inbox, D1, D1, steps=("extraction", "transformation"))
    assert [r.line for r in warehouse.quarantine().collect()] == ["11,cut off"]
