"""Steps repeated alone, late deliveries, damaged copies."""

import datetime
import os

import pytest
from test_pipeline import content, deliver, person

from claimloom.__main__ import arguments
from claimloom.plans.pipeline import RunResult, StepError, Warehouse
from claimloom.schemas import FILE_HEADERS
from claimloom.sources import deliveries

D1, D2, D3 = (datetime.date(2024, 1, 31), datetime.date(2024, 2, 1), datetime.date(2024, 2, 3))


def test_load_alone_keeps_the_logged_events(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    warehouse.run(deliver(tmp_path / "in1", [person(10, "F"), person(11, "")]), D1, D1, row_floor=1)
    email = {"claimants.csv": FILE_HEADERS["claimants.csv"] + ",email"}
    inbox = deliver(tmp_path / "in2", [person(10, "M") + ",a@b", person(11, "") + ","], headers=email)
    run = warehouse.run(inbox, D2, D2, row_floor=1).run_id

    def state():  # the keys of facts are given anew by every load
        return {n: content(df.drop("claim_key", "payment_key")) for n, df in warehouse.tables().items()}

    before = state()
    assert len(before["schema_evolution_log"]) == 1
    warehouse.load(D2, D2, RunResult(run))
    assert state() == before
    again = warehouse.run("", D2, D2, row_floor=1, steps=("loading", "checks"))
    assert again.run_id == run and state() == before
    with pytest.raises(StepError, match="loading failed: run 000003.* has not been transformed"):
        warehouse.run("", D1, D3, steps=("loading",))


def test_a_late_delivery_is_a_run_of_its_own(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    first = warehouse.run(deliver(tmp_path / "in1", [person(10, "F"), person(11, "")]), D3, D3, row_floor=1)
    late = warehouse.run(deliver(tmp_path / "in2", [person(10, "F"), person(12, "F"), person(11, "")]), D1, D3, row_floor=1)
    assert first.run_id < late.run_id
    assert sorted(r.claimant_id for r in warehouse.table("dim_claimant").collect()) == [10, 11, 12]


def test_a_part_lost_after_the_copy_is_noticed(spark, tmp_path):
    inbox = tmp_path / "in"
    deliver(inbox, [], drop=("claimants.csv",))
    parts = inbox / "claimants.csv"
    os.makedirs(parts)
    for i in range(3):
        (parts / f"part-{i}.csv").write_text(FILE_HEADERS["claimants.csv"] + "\n" + person(10 + i, "F") + "\n")
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    assert warehouse.run(str(inbox), D1, D1, steps=("extraction", "transformation")).landed_rows["claimants"] == 3
    raw = f"{warehouse.raw}/claimants/{D1}/claimants.csv"
    whole = (parts / "part-1.csv").read_text()
    for damage, mend in ((None, whole), (whole[:-5], whole)):
        if damage is None:
            os.remove(f"{raw}/part-1.csv")
        else:
            (tmp_path / "root/raw/claimants" / str(D1) / "claimants.csv" / "part-1.csv").write_text(damage)
        with pytest.raises(StepError, match="1 files of 2024-01-31 are not as they were copied, among them .*part-1.csv"):
            warehouse.run("", D1, D1, steps=("transformation",))
        (tmp_path / "root/raw/claimants" / str(D1) / "claimants.csv" / "part-1.csv").write_text(mend)
    warehouse.run("", D1, D1, steps=("transformation",))
    (tmp_path / "root/manifest" / str(D1) / "_SUCCESS").unlink()
    with pytest.raises(StepError, match="has not been copied whole"):
        warehouse.run("", D1, D1, steps=("transformation",))


def test_a_faulty_landing_is_not_loaded(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    warehouse.run(deliver(tmp_path / "a", [person(10, "F")]), D1, D1, row_floor=1)
    inbox = deliver(tmp_path / "b", [person(10, "sixteen letters!")])
    with pytest.raises(StepError, match="gender is longer"):
        warehouse.run(inbox, D2, D2)
    with pytest.raises(StepError, match="loading failed"):
        warehouse.run(inbox, D2, D2, steps=("loading",))
    with pytest.raises(Exception, match="has not been landed completely"):
        warehouse.staged("claimants", D2)
    assert [r.gender for r in warehouse.table("dim_claimant").collect()] == ["F"]


def test_steps_on_the_command_line(capsys):
    given = arguments(["--root", "r", "--step", "loading", "--step", "checks"])
    assert given.step == ("loading", "checks") and given.inbox is None
    with pytest.raises(SystemExit):
        arguments(["--root", "r"])
    assert "--inbox" in capsys.readouterr().err


def test_files_are_dealt_one_to_a_task(spark):
    dealt = deliveries._one_file_per_task(spark, [(str(i),) for i in range(50)], "path string")
    assert dealt.rdd.glom().map(len).collect() == [1] * 50
