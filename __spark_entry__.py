"""

Each query runs an operator of ``claimloom`` on the claims business that
``fixture_sql`` derives from the given tables; ``oracle_sql`` says the same in plain
SQL.  Decimals leave as doubles on both sides, so that the comparison does not depend
on how either engine hands out decimals.
"""

from __future__ import annotations

import datetime
import os
import sys
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import fixture_sql as fx  # noqa: E402
import oracle  # noqa: E402
from claimloom.operators import calendar, evolution, quality, repair, scd2, staging, versions  # noqa: E402
from claimloom.operators.keys import number_rows  # noqa: E402
from claimloom.plans import catalog, entities, facts, views  # noqa: E402
from claimloom.plans.pipeline import RunResult, StepError, Warehouse, at_once  # noqa: E402
from claimloom.schemas import (  # noqa: E402
    CLAIMANT,
    CLUSTER_COLUMNS,
    DIMENSIONS,
    EMPLOYER,
    FILE_ENTITY,
    POLICY,
    STAGING,
    WAREHOUSE,
    Dimension,
)
from claimloom.sources import deliveries  # noqa: E402
from claimloom.sources.paths import Folder, land, work_folder  # noqa: E402
from claimloom.sources.store import Store  # noqa: E402

try:  # the operators of a training-data pipeline are there or not
    import corpus_pipeline
    from claimloom.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

DAY1, DAY2 = oracle.DAY1, oracle.DAY2
#: Rows in a part of a delivered file.
PART_ROWS = 250_000


def _plain(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema]
    )


# Entities -----------------------------------------------------------------------


def _entity(spark: SparkSession, sf_dir: str, name: str, day: int | None = None) -> DataFrame:
    raw = fx.source_on(spark, sf_dir, name, day) if day else fx.source(spark, sf_dir, name)
    return getattr(entities, name)(raw, DAY1)


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.claims(fx.source(spark, sf_dir, "claims_v1"), fx.source(spark, sf_dir, "claims_v2"))


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities.payments(fx.source(spark, sf_dir, "payments"))


def _claims_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = entities.all_claims(fx.source(spark, sf_dir, "claims_v1"), fx.source(spark, sf_dir, "claims_v2"))
    return claims.groupBy("claim_severity").agg(
        F.count(F.lit(1)).alias("claims"), F.count_if(F.col("policy_id").isNull()).alias("without_policy")
    )


def _newest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_names = fx.source(spark, sf_dir, "claimants").withColumn(
        "first_name", F.expr("repeat(trim(first_name), CAST(1 + claimant_id % 7 AS INT))")
    )
    rows = entities.claimants(long_names, DAY1)
    return staging.newest_rejects(rows, STAGING["claimants"], "updated_at").select(
        "claimant_id", "updated_at", F.concat_ws("; ", "faults").alias("faults")
    )


# Dimensions ---------------------------------------------------------------------


def _two_loads(spark: SparkSession, sf_dir: str, spec: Dimension) -> tuple[DataFrame, DataFrame]:
    """The dimension after the first load and the second delivery, both landed."""
    first, second = (_entity(spark, sf_dir, spec.entity, day) for day in (1, 2))
    return tuple(
        at_once(
            [
                lambda: land(scd2.merge(None, first, spec, DAY1), work_folder(spark, spec.name)),
                lambda: land(second, work_folder(spark, spec.entity)),
            ]
        )
    )


def _merge(spark: SparkSession, sf_dir: str, spec: Dimension) -> DataFrame:
    dim, staged = _two_loads(spark, sf_dir, spec)
    return _plain(scd2.merge(dim, staged, spec, DAY2))


def _merge_step(spark: SparkSession, sf_dir: str, spec: Dimension, step: str) -> DataFrame:
    dim, staged = _two_loads(spark, sf_dir, spec)
    return _plain(scd2.merge_steps(dim, staged, spec, DAY2)[step])


def _surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = _payments(spark, sf_dir).select("payment_id", "claim_id")
    return number_rows(payments, "payment_key", 1000, ["payment_id"])


# Facts, views, checks -----------------------------------------------------------


def _star(spark: SparkSession, sf_dir: str, ordered: bool = False) -> dict[str, DataFrame]:
    staged = [_entity(spark, sf_dir, spec.entity) for spec in DIMENSIONS]
    dims = at_once([partial(scd2.merge, None, s, spec, DAY1) for s, spec in zip(staged, DIMENSIONS)])
    star = {spec.name: dim for spec, dim in zip(DIMENSIONS, dims)}
    placed = facts.place_claims(_claims(spark, sf_dir), star["dim_claimant"], star["dim_policy"], star["dim_employer"])
    return {**star, "fact_claim": facts.fact_claim(placed, ordered=ordered)}


def _fact_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_star(spark, sf_dir, ordered=True)["fact_claim"])


def _fact_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = facts.place_payments(_payments(spark, sf_dir), _star(spark, sf_dir, ordered=True)["fact_claim"])
    return _plain(facts.fact_payment(placed, ordered=True))


def _fact_claim_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claims as a load writes them, without the key each load gives anew."""
    return _plain(_star(spark, sf_dir)["fact_claim"].drop("claim_key"))


def _fact_payment_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments as a load writes them, their claims looked up by the keys it gave."""
    claim = _star(spark, sf_dir)["fact_claim"]
    payment = facts.fact_payment(facts.place_payments(_payments(spark, sf_dir), claim))
    found = payment.join(claim.select("claim_key", "claim_id"), "claim_key")
    return _plain(found.drop("payment_key", "claim_key"))


def _claims_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return _plain(views.claims_summary(star["fact_claim"], star["dim_employer"], star["dim_policy"]))


def _checked_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    star = _star(spark, sf_dir)
    star["fact_payment"] = facts.fact_payment(facts.place_payments(_payments(spark, sf_dir), star["fact_claim"]))
    star["dim_date"] = calendar.dim_date(spark)
    return star


def _quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(_checked_star(spark, sf_dir))


def _quality_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on a star with every fault the checks are there for: each of them fails."""
    return quality.report(_with_faults(_checked_star(spark, sf_dir)), 1_000_000_000)


def _with_faults(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    faulty = dict(star)
    for name, where in fx.REPEATED.items():
        rows = star[name].unionByName(star[name].filter(where))
        columns = {c: F.expr(sql) for c, sql in fx.FAULTS.get(name, {}).items()}
        faulty[name] = rows.withColumns(columns) if columns else rows
    return faulty


def _dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = entities.all_claims(fx.source(spark, sf_dir, "claims_v1"), fx.source(spark, sf_dir, "claims_v2"))
    per_day = claims.groupBy(F.col("incident_date").alias("full_date")).agg(F.count(F.lit(1)).alias("incidents"))
    return calendar.dim_date(spark).join(per_day, "full_date", "left").fillna(0, ["incidents"])


# Repair -------------------------------------------------------------------------


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.source(spark, sf_dir, "history")


def _duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.duplicate_current(_history(spark, sf_dir), CLAIMANT)


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.history_gaps(_history(spark, sf_dir), CLAIMANT)


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.overlaps(_history(spark, sf_dir), CLAIMANT)


def _latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _history(spark, sf_dir)
    order = [F.col("effective_from").desc(), F.col("claimant_key").desc()]
    return versions.keep_newest(history, "claimant_id", order)


def _version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.version_history(_history(spark, sf_dir), CLAIMANT, F.col("claimant_key").isNotNull())


def _close_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.close_versions(_history(spark, sf_dir), F.col("claimant_key") == 101, DAY2)


def _close_natural(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_rows = (F.col("claimant_id") == 77) & F.col("is_current")
    return repair.close_versions(_history(spark, sf_dir), open_rows, DAY1)


def _fix_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.correct_versions(_history(spark, sf_dir), F.col("claimant_key") == 101, "gender", F.lit("corrected"))


def _repair_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.keep_latest_current(_history(spark, sf_dir), CLAIMANT, DAY2)


# Schema evolution ---------------------------------------------------------------


def _two_schemas(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Two deliveries: claims gain a column, payments lose one, policies rename one."""
    v1, v2 = (fx.source(spark, sf_dir, f"claims_v{i}") for i in (1, 2))
    payments, policies = fx.source(spark, sf_dir, "payments"), fx.source(spark, sf_dir, "policies")
    employers = fx.source(spark, sf_dir, "employers")
    first = {
        "claims": entities.claims(v1, v2),
        "employers": entities.employers(employers, DAY1),
        "payments": entities.payments(payments.withColumn("channel", F.col("payment_type"))),
        "policies": entities.policies(policies.withColumn("broker", F.lit("a")), DAY1),
    }
    second = {
        "claims": entities.claims(v1, v2.withColumn("adjuster", F.col("claim_type"))),
        "employers": entities.employers(employers, DAY1),
        "payments": entities.payments(payments),
        "policies": entities.policies(policies.withColumn("agent", F.lit("a")), DAY1),
    }
    return first, second


def _schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history view of the second delivery, with the rows it landed per entity."""
    first, second = _two_schemas(spark, sf_dir)
    before, now = (
        evolution.delivered_columns(spark, {entity: df.columns for entity, df in delivery.items()}, day)
        for delivery, day in ((first, DAY1), (second, DAY2))
    )
    log = evolution.log_entries(evolution.changes(before, now), 0)
    landed = None
    for entity, df in second.items():
        rows = df.agg(F.lit(entity).alias("entity"), F.count(F.lit(1)).alias("landed_rows"))
        landed = rows if landed is None else landed.unionByName(rows)
    return evolution.history_view(log).join(landed, "entity")


# Deliveries and the whole run ---------------------------------------------------


def _damaged(df: DataFrame) -> DataFrame:
    """Lines of a CSV file, under its header; some lack fields, have too many or an unreadable key."""
    turn = F.col("claim_id") % 50
    fields = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    cut = F.when(turn == 0, F.slice(fields, 1, 3)).when(turn == 1, F.concat(fields, F.array(F.lit("more"))))
    cut = cut.when(turn == 2, F.concat(F.array(F.lit("no key")), F.slice(fields, 2, len(df.columns) - 1)))
    return df.select(F.array_join(cut.otherwise(fields), ",").alias(",".join(df.columns)))


def _write_csv(df: DataFrame, path: str, **options: str) -> None:
    """A delivered file as a folder of compressed parts; as none can be split, they are small."""
    parts = df.write.option("header", True).option("maxRecordsPerFile", PART_ROWS)
    parts.option("zlib.compress.level", "BEST_SPEED").options(**options).csv(path, compression="gzip")


def _deliver(
    spark: SparkSession,
    sf_dir: str,
    inbox: str,
    day: int | None = None,
    currency: bool = True,
    damaged: bool = False,
    email: bool = False,
) -> None:
    """Write the sources as CSV folders, the way a large delivery comes in."""
    writes = []
    for name in ("claimants", "claims_v1", "claims_v2", "employers", "payments", "policies"):
        dated = day and (name, day) in fx.DAYS
        df = fx.source_on(spark, sf_dir, name, day) if dated else fx.source(spark, sf_dir, name)
        if name == "payments" and currency:  # a column the contract does not know
            df = df.withColumn("currency", F.lit("USD"))
        if name == "claimants" and email:
            df = df.withColumn("email", F.concat(F.lit("c"), "claimant_id", F.lit("@x")))
        options = {}
        if name == "payments" and damaged:
            df, options = _damaged(df), {"sep": "\x01", "quote": ""}
        writes.append(partial(_write_csv, df, f"{inbox}/{name}.csv", **options))
    at_once(writes)


def _delivery_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header check, raw copy and CSV scan of one delivery, summed up per file name."""
    inbox, raw, path = (work_folder(spark, part) for part in ("inbox", "raw", "manifest"))
    _deliver(spark, sf_dir, inbox)
    files, _ = deliveries.list_files(spark, inbox)
    report = deliveries.contract_report(deliveries.file_headers(spark, files))
    deliveries.check_contract(report)
    manifest = deliveries.copy_to_raw(spark, files, raw, DAY1)
    manifest.write.parquet(path)

    part = F.element_at(F.split("path", "/"), -1)
    delivered = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(inbox)
    delivered = delivered.select(part.alias("part"), F.md5("content").alias("delivered_md5"))
    copied = spark.read.schema(manifest.schema).parquet(path).withColumn("part", part)
    intact = copied.join(delivered, "part", "left").groupBy("name", "entity").agg(
        F.every(F.coalesce(F.col("md5") == F.col("delivered_md5"), F.lit(False))).alias("intact")
    )
    new = report.groupBy("name").agg(
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("extra")))), ",").alias("new_columns")
    )
    rows = None
    for name, df in deliveries.read_raw(spark, raw, DAY1, list(FILE_ENTITY)).items():
        count = df.agg(F.lit(name).alias("name"), F.count("*").alias("rows"))
        rows = count if rows is None else rows.unionByName(count)
    return intact.join(new, "name").join(rows, "name")


def _two_days(
    spark: SparkSession,
    sf_dir: str,
    rows_per_file: int = 0,
    email: bool = False,
    steps: tuple[str, ...] = ("extraction", "transformation", "loading"),
    results: list[RunResult] | None = None,
) -> Warehouse:
    """Two daily runs from CSV to the warehouse; the second brings a new column of payments.

    With ``email`` it also brings one of claimants, which their dimension has been given.
    """
    warehouse = Warehouse(spark, work_folder(spark, "warehouse"), rows_per_file)
    inboxes = [work_folder(spark, f"inbox{day}") for day in (1, 2)]

    def some(day: int, *wanted: str, earlier: RunResult | None = None) -> RunResult:
        date = (DAY1, DAY2)[day - 1]
        chosen = tuple(step for step in wanted if step in steps)
        return warehouse.run(inboxes[day - 1], date, date, steps=chosen, earlier=earlier)

    def copied(day: int) -> RunResult:
        result = some(day, "extraction")
        Folder(spark, inboxes[day - 1]).delete()  # what comes next reads the copy in raw
        return result

    def second_comes_in() -> None:
        _deliver(spark, sf_dir, inboxes[1], 2, email=email)
        copied(2)

    # The steps of each run follow one another; those of the second go on beside those of the first.
    _deliver(spark, sf_dir, inboxes[0], 1, currency=False)
    first, _ = at_once([lambda: some(1, "transformation", earlier=copied(1)), second_comes_in])
    _, second = at_once([partial(some, 1, "loading", earlier=first), partial(some, 2, "transformation")])
    if email:
        warehouse.columns.add("warehouse.dim_claimant", "email", "string")
    some(2, "loading", earlier=second)
    if results is not None:
        results += [first, second]
    return warehouse


def _dim_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claimants after a second load that brought a column their dimension had been given."""
    dim = _two_days(spark, sf_dir, email=True).table("dim_claimant")
    return dim.select("claimant_key", "claimant_id", "email", "is_current")


def _dropped_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published tables without a column that was dropped, after two more publications."""
    warehouse = _two_days(spark, sf_dir)
    catalog.publish(warehouse, DAY2)
    tables = {"staging.stg_payments": "payment_type", "warehouse.dim_policy": "premium_amount"}
    for table, column in tables.items():
        catalog.drop_column(warehouse, table, column)
    seen = None
    for date in (DAY1, DAY2):
        catalog.publish(warehouse, date)
        for table, column in tables.items():
            rows = spark.table(table).agg(F.count("*").alias("rows"))
            rows = rows.select(F.lit(table).alias("name"), F.lit(date).alias("published"), "rows")
            rows = rows.withColumn("shows_column", F.lit(column in spark.table(table).columns))
            rows = land(rows, work_folder(spark, "published"))
            seen = rows if seen is None else seen.unionByName(rows)
    return seen


def _landing_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per entity and date of the landing catalogue, and those with a value in the column that came later."""
    warehouse = _two_days(spark, sf_dir, steps=("extraction", "transformation"))
    catalog.create_databases(warehouse)
    catalog.publish_landings(warehouse)
    found = None
    for entity in STAGING:
        table = spark.table(f"landing.{entity}")
        later = F.count("currency") if "currency" in table.columns else F.lit(0).cast("bigint")
        per_date = table.groupBy("ingestion_date").agg(F.count("*").alias("rows"), later.alias("with_currency"))
        # Landed, as the next run points the tables elsewhere.
        rows = land(per_date.select(F.lit(entity).alias("entity"), "*"), work_folder(spark, "dates"))
        found = rows if found is None else found.unionByName(rows)
    return found


def _columns_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known of the columns of two entities on each of three days, with the rows landed by then."""
    warehouse = _two_days(spark, sf_dir, steps=("extraction", "transformation"))
    landed = None
    for entity in ("payments", "policies"):
        for date in (DAY1, DAY2):
            rows = warehouse.staged(entity, date).agg(F.count("*").alias("landed_rows"))
            rows = rows.select(F.lit(entity).alias("entity"), F.lit(date.isoformat()).alias("as_of"), "landed_rows")
            landed = rows if landed is None else landed.unionByName(rows)
    found = None
    for day in (DAY1, DAY2, DAY2 + datetime.timedelta(days=9)):
        known = warehouse.columns_as_of(day).withColumn("columns", F.array_join(F.array_sort("columns"), ","))
        known = known.withColumn("on_day", F.lit(day))
        found = known if found is None else found.unionByName(known)
    return found.join(landed, ["entity", "as_of"])


def _run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that two runs have taken beside their writes."""
    results: list[RunResult] = []
    _two_days(spark, sf_dir, results=results)
    rows = []
    for day, result in enumerate(results, 1):
        rows += [(day, f"landed {name}", n) for name, n in result.landed_rows.items()]
        rows += [(day, f"placed {name}", n) for name, n in result.placed_rows.items()]
        rows.append((day, "claims without policy", result.claims_without_policy))
    return spark.createDataFrame(rows, "day int, counted string, rows bigint")


def _published_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary as SQL users see it."""
    catalog.publish(_two_days(spark, sf_dir), DAY2)
    return _plain(land(spark.sql("SELECT * FROM analytics.claims_summary"), work_folder(spark, "view")))


def _missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments of a delivery that lacks two of the columns of their table."""
    return entities.payments(fx.source(spark, sf_dir, "payments").drop("payment_type", "payment_amount"))


def _run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How runs end: without an inbox, on a broken delivery, on failed checks, repeated, named."""
    warehouse = Warehouse(spark, work_folder(spark, "warehouse"))
    inbox, broken = work_folder(spark, "inbox"), work_folder(spark, "broken")
    _deliver(spark, sf_dir, inbox)
    _write_csv(fx.source(spark, sf_dir, "payments").drop("claim_id"), f"{broken}/payments.csv")
    rows = []
    for case, folder, floor in (("no inbox", "", 1), ("broken delivery", broken, 1), ("whole run", inbox, 10**9)):
        try:
            warehouse.run(folder, DAY1, DAY1, row_floor=floor)
        except (ValueError, StepError, quality.QualityError) as error:
            rows.append((case, str(error).split(" (")[0].split("; failed: ")[-1]))
        if folder:
            Folder(spark, folder).delete()  # not needed any more
    ids = [warehouse.run_id(DAY1, DAY1), warehouse.run_id(DAY1, DAY1, "backfill"), warehouse.run_id(DAY2, DAY2)]
    rows.append(("run ids", ", ".join(ids)))
    last = warehouse.check_trend().filter("result = 'FAIL'").select("check_name").collect()
    rows.append(("kept failures", ", ".join(sorted(r.check_name for r in last))))
    rows.append(("claims loaded", str(warehouse.table("fact_claim").count())))
    return spark.createDataFrame(rows, "case_name string, outcome string")


def _check_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept reports of three runs, the second on a star with faults, the third with a floor too high."""
    store = Store(spark, work_folder(spark, "tables"))
    star = {name: land(df, work_folder(spark, name)) for name, df in _checked_star(spark, sf_dir).items()}
    for run, day, tables, floor in (
        ("1", DAY1, star, 1), ("2", DAY2, _with_faults(star), 10**9), ("3", DAY2, star, 10**9)
    ):
        store.write("check_history", quality.kept(quality.report(tables, floor), run, day), run)
    schema = spark.createDataFrame([], quality.HISTORY_SCHEMA).schema
    return quality.trend(store.read_all("check_history", schema))


def _fact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fact the key ranges of its files, and the rows of a month as a look-up by range finds them."""
    warehouse = _two_days(spark, sf_dir, rows_per_file=500)
    found = None
    for name, by in CLUSTER_COLUMNS.items():
        files = warehouse.store.file_ranges(name)
        before = F.lag("high").over(Window.orderBy(F.col("low").asc_nulls_first()))  # a row per file
        ranges = files.withColumn("overlaps", F.coalesce(before >= F.col("low"), F.lit(False))).agg(
            F.sum("rows").alias("rows"),
            F.min(f"low.{by[0]}").alias("first_day"),
            F.max(f"high.{by[0]}").alias("last_day"),
            F.count_if("overlaps").alias("overlapping_files"),
            (F.max("rows") <= 500).alias("within_limit"),
        )
        month = warehouse.store.read_between(name, WAREHOUSE[name], by[0], 20220601, 20220630)
        rows = ranges.crossJoin(month.agg(F.count(F.lit(1)).alias("month_rows"))).select(F.lit(name).alias("name"), "*")
        found = rows if found is None else found.unionByName(rows)
    return found


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery of payments with cut and surplus fields and unreadable keys: what lands, what is kept apart."""
    inbox = work_folder(spark, "inbox")
    _deliver(spark, sf_dir, inbox, damaged=True)
    warehouse = Warehouse(spark, work_folder(spark, "warehouse"))
    warehouse.run(inbox, DAY1, DAY1, steps=("extraction", "transformation"))
    kept = warehouse.quarantine().groupBy("entity", "fault").agg(F.count(F.lit(1)).alias("lines"))
    good = warehouse.staged("payments", DAY1).agg(F.count(F.lit(1)).alias("lines"))
    return kept.unionByName(good.select(F.lit("payments").alias("entity"), F.lit("none").alias("fault"), "lines"))


def _pipeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_two_days(spark, sf_dir).claims_summary())


def _evolution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after two runs, the load of the second repeated alone, with the rows that run landed."""
    warehouse = _two_days(spark, sf_dir)
    warehouse.run("", DAY2, DAY2, steps=("loading",))
    landed = None
    for entity in STAGING:
        rows = warehouse.staged(entity, DAY2).agg(F.lit(entity).alias("entity"), F.count(F.lit(1)).alias("landed_rows"))
        landed = rows if landed is None else landed.unionByName(rows)
    return warehouse.table("schema_evolution_log").join(landed, "entity")


def _added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column added to a published table, as readers see it after each of two more publications."""
    warehouse = _two_days(spark, sf_dir)
    catalog.publish(warehouse, DAY2)
    catalog.add_column(warehouse, "staging.stg_payments", "currency", "string")
    seen = None
    for date in (DAY1, DAY2):
        catalog.publish(warehouse, date)
        rows = spark.table("staging.stg_payments").groupBy("payment_type", "currency").agg(F.count("*").alias("payments"))
        # Landed, as the next publication points the table elsewhere.
        rows = land(rows.withColumn("published", F.lit(date)), work_folder(spark, "published"))
        seen = rows if seen is None else seen.unionByName(rows)
    return seen


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "claims_unified": _claims,
        "claims_dropped": _claims_dropped,
        "claimants_versions": partial(_entity, name="claimants"),
        "employers_versions": partial(_entity, name="employers"),
        "policies_versions": partial(_entity, name="policies"),
        "payments_dedup": _payments,
        "dim_date": _dim_date,
        "surrogate_keys": _surrogate_keys,
        "fact_claim": _fact_claim,
        "fact_payment": _fact_payment,
        "fact_claim_loaded": _fact_claim_loaded,
        "fact_payment_loaded": _fact_payment_loaded,
        "claims_summary": _claims_summary,
        "quality_report": _quality_report,
        "quality_faults": _quality_faults,
        "scd2_duplicates": _duplicates,
        "scd2_gaps": _gaps,
        "scd2_overlaps": _overlaps,
        "scd2_latest_version": _latest_version,
        "scd2_version_history": _version_history,
        "scd2_close_key": _close_key,
        "scd2_close_natural": _close_natural,
        "scd2_fix_attribute": _fix_attribute,
        "scd2_repair_current": _repair_current,
        "schema_evolution_history": _schema_evolution,
        "delivery_contract": _delivery_contract,
        "reject_top10": _newest_rejects,
        "pipeline_claims_summary": _pipeline_summary,
        "fact_files": _fact_files,
        "quarantine": _quarantine,
        "dim_added_column": _dim_added_column,
        "dropped_column": _dropped_column,
        "landing_by_date": _landing_by_date,
        "columns_as_of": _columns_as_of,
        "run_counts": _run_counts,
        "published_view": _published_view,
        "missing_columns": _missing_columns,
        "check_trend": _check_trend,
        "run_outcomes": _run_outcomes,
        "evolution_log": _evolution_log,
        "added_column": _added_column,
    }
    for spec in (CLAIMANT, POLICY, EMPLOYER):
        short = spec.name.removeprefix("dim_")
        registered[f"scd2_merge_{short}"] = partial(_merge, spec=spec)
        for step in ("expired", "new", "changed"):
            registered[f"scd2_{step}_{short}"] = partial(_merge_step, spec=spec, step=step)
    if llm_queries is not None:
        registered |= llm_queries.QUERIES
        registered["pipeline"] = corpus_pipeline.run
    return registered


def oracle_sql() -> dict[str, str]:
    statements = oracle.statements()
    if llm_queries is not None:
        statements |= llm_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            statements["pipeline"] = corpus_pipeline.ORACLE_SQL
    return statements


def entry(spark: SparkSession) -> DataFrame:
    """Claims per company, coverage and status on the smallest test data."""
    return _claims_summary(spark, "/root/testdata/sf0.001")
