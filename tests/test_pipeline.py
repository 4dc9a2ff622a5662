import datetime
import os

import pytest
from pyspark.sql import functions as F

from claimloom.operators import repair
from claimloom.operators.quality import QualityError
from claimloom.plans import catalog
from claimloom.plans.pipeline import StepError, Warehouse
from claimloom.schemas import CLAIMANT, FILE_HEADERS

D1, D2 = datetime.date(2024, 1, 31), datetime.date(2024, 2, 1)
T = "2024-01-01 00:00:00"


def deliver(folder, claimants, claims2=(), drop=(), headers=None):
    files = {
        "claimants.csv": claimants,
        "employers.csv": ['7,"Acme, Inc",Retail,Here,1,' + f"{T},{T}"],
        "policies.csv": [f"100,P100,Full,2020-01-01,2021-01-01,99.5,{T},{T}"],
        "claims_v1.csv": [
            f"1,10,100,2024-01-05,2024-01-06,medical, Open,50.5,,{T},{T}",
            f"2,10,,2024-01-05,2024-01-06,medical,open,50.5,1.0,{T},{T}",
        ],
        "claims_v2.csv": [f"3,11,100.0,2024-01-07,2024-01-08,medical,CLOSED,20,10,{T},{T},high", *claims2],
        "payments.csv": [f"1,1,2024-02-01,5.5,medical,{T}", f"1,1,2024-02-01,5.5,medical,{T}",
                         f"2,3,2024-02-02,6.5,medical,{T}"],
    }
    os.makedirs(folder, exist_ok=True)
    for name, lines in files.items():
        if name not in drop:
            header = (headers or {}).get(name, FILE_HEADERS[name])
            with open(f"{folder}/{name}", "w") as file:
                file.write("\n".join([header, *lines]) + "\n")
    return str(folder)


def person(key, gender):
    return f"{key},Ann,Lee,1990-01-01,{gender},2015-01-01,7,{T},{T}"


def content(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    warehouse = Warehouse(spark, str(base / "root"))
    first = warehouse.run(deliver(base / "in1", [person(10, "F"), person(11, "")]), D1, D1, row_floor=2)
    changed = FILE_HEADERS["claimants.csv"] + ",email"
    inbox2 = deliver(base / "in2", [person(10, "M") + ",a@b", person(11, "") + ",", person(12, "F") + ","],
                     headers={"claimants.csv": changed})
    second = warehouse.run(inbox2, D2, D2, row_floor=2)
    return warehouse, inbox2, first, second


def test_run_report(two_days):
    _, _, first, second = two_days
    assert first.landed_rows == {"claimants": 2, "claims": 2, "employers": 1, "payments": 2, "policies": 1}
    assert first.claims_without_policy == 1
    assert first.placed_rows == {"fact_claim": 2, "fact_payment": 2}
    assert first.manifest.count() == 6 and first.absent_files == [] and first.evolution_events == []
    assert [(e["entity"], e["added_columns"]) for e in second.evolution_events] == [("claimants", '["email"]')]
    assert {r.result for r in second.checks} == {"PASS"}


def test_tables_after_two_days(two_days):
    warehouse, *_ = two_days
    dim = warehouse.table("dim_claimant").select(
        "claimant_key", "claimant_id", "gender", "effective_from", "effective_to", "is_current"
    )
    start = datetime.date(2024, 1, 1)
    assert sorted((tuple(r) for r in dim.collect()), key=lambda r: r[0]) == [
        (1, 10, "F", start, D1, False),
        (2, 11, "Unknown", start, None, True),
        (3, 10, "M", D2, None, True),
        (4, 12, "F", start, None, True),
    ]
    claim = warehouse.table("fact_claim").orderBy("claim_id").collect()
    assert [(r.claim_id, r.claim_status, r.claim_severity, str(r.approved_amount)) for r in claim] == [
        (1, "open", "unknown", "0.00"), (3, "closed", "high", "10.00"),
    ]
    assert len({r.claim_key for r in claim}) == 2
    claim_of = {r.claim_key: r.claim_id for r in claim}
    payment = warehouse.table("fact_payment").collect()
    assert sorted((r.payment_id, claim_of[r.claim_key]) for r in payment) == [(1, 1), (2, 3)]
    summary = {r.claim_status: r for r in warehouse.claims_summary().collect()}
    assert (summary["open"].company_name, summary["open"].total_claims) == ("Acme, Inc", 1)
    log = warehouse.schema_evolution_history().collect()
    assert [(r.entity, r.detection_date, r.previous_version, r.removed_columns) for r in log] == [
        ("claimants", D2, "2024-01-31", "[]")
    ]


def test_a_delivery_is_loaded_after_the_next_was_transformed(two_days, spark, tmp_path):
    _, inbox2, first, second = two_days
    taken_in, rest = ("extraction", "transformation"), ("loading", "checks")
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    one = warehouse.run(deliver(tmp_path / "in1", [person(10, "F"), person(11, "")]), D1, D1, steps=taken_in)
    two = warehouse.run(inbox2, D2, D2, steps=taken_in)
    assert warehouse.run("", D1, D1, row_floor=2, steps=rest, earlier=one) is one
    assert warehouse.run("", D2, D2, row_floor=2, steps=rest, earlier=two) is two
    for result, want in ((one, first), (two, second)):
        assert (result.run_id, result.landed_rows, result.placed_rows) == (want.run_id, want.landed_rows, want.placed_rows)
        assert result.evolution_events == want.evolution_events and result.checks == want.checks
    assert warehouse.store.runs("fact_claim") == [first.run_id, second.run_id]
    versions = warehouse.table("dim_claimant").select("claimant_key", "claimant_id", "gender", "is_current")
    assert content(versions) == content(two_days[0].table("dim_claimant").select(versions.columns))


def test_repeating_a_run_changes_nothing(two_days):
    warehouse, inbox2, _, second = two_days

    def state():  # the keys of facts are given anew by every load
        return {n: content(df.drop("claim_key", "payment_key")) for n, df in warehouse.tables().items()}

    before = state()
    again = warehouse.run(inbox2, D2, D2, row_floor=2)
    assert state() == before
    assert again.evolution_events == second.evolution_events


def test_published_tables_and_views(two_days, spark):
    warehouse, *_ = two_days
    catalog.publish(warehouse, D2)
    assert spark.sql("SELECT count(*) FROM staging.stg_claims").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM warehouse.dim_claimant").first()[0] == 4
    assert spark.sql("SELECT count(*) FROM warehouse.dim_claimant WHERE is_current").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM warehouse.schema_evolution_log").first()[0] == 1
    view = spark.table("analytics.claims_summary")
    assert content(view) == content(warehouse.claims_summary().select(*view.columns))
    assert spark.table("analytics.schema_evolution_history").count() == 1
    catalog.publish(warehouse, D2)  # again, over what is there
    catalog.add_column(warehouse, "staging.stg_claimants", "email", "string")
    spark.sql("ALTER TABLE warehouse.dim_claimant SET TBLPROPERTIES ('kept' = 'yes')")
    for _ in range(2):
        emails = spark.sql("SELECT email FROM staging.stg_claimants").collect()
        assert sorted(str(r.email) for r in emails) == ["None", "None", "a@b"]
        catalog.publish(warehouse, D2)
    assert "kept" in str(spark.sql("SHOW TBLPROPERTIES warehouse.dim_claimant").collect())  # not dropped in between
    spark.sql("DROP TABLE staging.stg_claimants")
    catalog.publish(warehouse, D2)  # as on a catalog that never had it
    assert "email" in spark.table("staging.stg_claimants").columns
    catalog.publish(warehouse, D1)
    assert spark.sql("SELECT count(*) FROM staging.stg_claimants").first()[0] == 2
    catalog.publish(warehouse, D2)
    assert spark.sql("SELECT count(*) FROM staging.stg_claimants").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM warehouse.dim_claimant WHERE is_current").first()[0] == 3


def test_repair_of_a_stored_dimension(two_days):
    warehouse, *_ = two_days
    fix = lambda df: repair.correct_versions(df, F.col("claimant_key") == 1, "last_name", F.lit("Lea"))
    assert warehouse.repair_dimension(CLAIMANT, fix).collect() == []
    names = {r.claimant_key: r.last_name for r in warehouse.table("dim_claimant").collect()}
    assert names == {1: "Lea", 2: "Lee", 3: "Lee", 4: "Lee"}
    doubled = lambda df: df.withColumn("is_current", F.lit(True))
    assert [tuple(r) for r in warehouse.repair_dimension(CLAIMANT, doubled).collect()] == [(10, 2)]
    latest = lambda df: repair.keep_latest_current(df, CLAIMANT, D1)
    assert warehouse.repair_dimension(CLAIMANT, latest).collect() == []


def test_failed_steps_are_named_and_leave_tables_alone(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    with pytest.raises(StepError, match="extraction failed: claimants.csv: missing columns"):
        warehouse.run(deliver(tmp_path / "a", [], headers={"claimants.csv": "claimant_id"}), D1, D1)
    with pytest.raises(StepError, match="transformation failed: .*payments.csv has not been delivered"):
        warehouse.run(deliver(tmp_path / "b", [person(10, "F")], drop=("payments.csv",)), D1, D1)
    with pytest.raises(StepError, match="transformation failed: claimants: 1 rows do not fit.*gender is longer"):
        warehouse.run(deliver(tmp_path / "c", [person(10, "not a short word")]), D1, D1)
    assert warehouse.store.runs("dim_claimant") == []
    with pytest.raises(ValueError, match="inbox is required"):
        warehouse.run("")


def test_gate_fails_the_run(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    with pytest.raises(QualityError, match="fact_claim row count"):
        warehouse.run(deliver(tmp_path / "in", [person(10, "F"), person(11, "M")]), D1, D1)


def test_publishing_before_the_first_run_gives_empty_tables(spark, tmp_path):
    catalog.publish(Warehouse(spark, str(tmp_path / "root")), D1)
    for table in ("staging.stg_claims", "warehouse.dim_policy", "warehouse.fact_claim", "analytics.claims_summary",
                  "warehouse.schema_evolution_log"):
        assert spark.table(table).count() == 0
