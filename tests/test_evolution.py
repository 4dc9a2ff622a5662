import datetime
import json

from claimloom.operators import evolution

DAY = datetime.date(2024, 2, 1)


def snap(spark, columns, day=DAY, entity="claims"):
    return evolution.delivered_columns(spark, {entity: columns.split()}, day)


def test_first_delivery_and_same_columns_are_no_event(spark):
    nothing = evolution.delivered_columns(spark, {}, DAY)
    assert evolution.changes(nothing, snap(spark, "a b")).count() == 0
    assert evolution.changes(snap(spark, "b a"), snap(spark, "a b")).count() == 0


def test_added_and_removed_columns_keep_their_order(spark):
    found = evolution.changes(snap(spark, "a x b y", datetime.date(2024, 1, 1)), snap(spark, "d a c b"))
    assert [r.asDict() for r in found.collect()] == [{
        "entity": "claims",
        "detection_date": DAY,
        "previous_version": "2024-01-01",
        "current_version": "2024-02-01",
        "previous_columns": '["a", "x", "b", "y"]',
        "current_columns": '["d", "a", "c", "b"]',
        "added_columns": '["d", "c"]',
        "removed_columns": '["x", "y"]',
    }]


def test_names_that_need_escaping(spark):
    odd = evolution.delivered_columns(spark, {"claims": ["a", 'b"c', "d,e", "[f]"]}, DAY)
    (event,) = evolution.changes(snap(spark, "a"), odd).collect()
    assert json.loads(event.added_columns) == ['b"c', "d,e", "[f]"] and event.removed_columns == "[]"


def test_registry_round_trip_and_log(spark):
    old = snap(spark, "p", datetime.date(2024, 1, 31), "payments").unionByName(snap(spark, "a", DAY))
    after = {r.entity: (r.columns, r.as_of) for r in evolution.registry_after(old, snap(spark, "a b")).collect()}
    assert after == {"payments": (["p"], "2024-01-31"), "claims": (["a", "b"], "2024-02-01")}
    events = None
    for name, days in (("policies", 0), ("claims", 0), ("employers", 5)):
        day = DAY - datetime.timedelta(days=days)
        found = evolution.changes(snap(spark, "a", day, name), snap(spark, "a b", day, name))
        events = found if events is None else events.unionByName(found)
    log = evolution.log_entries(events, 40)
    assert [(r.log_id, r.entity) for r in log.orderBy("log_id").collect()] == [
        (41, "claims"), (42, "employers"), (43, "policies")
    ]
    view = evolution.history_view(log)
    assert [r.entity for r in view.collect()] == ["claims", "policies", "employers"]
    assert view.columns == [
        "entity", "detection_date", "previous_version", "current_version", "added_columns", "removed_columns"
    ]
