"""The daily run: extraction, transformation, loading, quality checks.

Every step reads what the step before has committed.  Each table is one write job;
nothing is cached or counted a second time, row counts are observed while writing.
Repeating a run (same ``run_id``) starts from the state before it and replaces it.
"""

from __future__ import annotations

import datetime
import logging
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.operators import calendar, evolution, quality, repair, scd2, staging
from claimloom.plans import entities, facts, views
from claimloom.plans.columns import ColumnLog
from claimloom.schemas import CLUSTER_COLUMNS, DIMENSIONS, FILE_ENTITY, SORT_COLUMNS, STAGING, WAREHOUSE, Dimension, no_rows
from claimloom.sources import deliveries
from claimloom.sources.paths import Folder, shuffles_removed, work_folder
from claimloom.sources.store import Store, clustered, run_name

log = logging.getLogger("claimloom.pipeline")

STEPS = ("extraction", "transformation", "loading", "checks")


class StepError(Exception):
    """A step of the run failed; its message names the step."""


def at_once(calls: list[Callable]) -> list:
    """Run independent Spark writes side by side, so small ones do not wait for large ones."""
    with ThreadPoolExecutor(len(calls)) as pool:
        return [future.result() for future in [pool.submit(call) for call in calls]]


@dataclass
class RunResult:
    run_id: str
    manifest: DataFrame | None = None
    absent_files: list[str] = field(default_factory=list)
    landed_rows: dict[str, int] = field(default_factory=dict)
    claims_without_policy: int = 0
    quarantined: dict[str, int] = field(default_factory=dict)
    placed_rows: dict[str, int] = field(default_factory=dict)
    evolution_events: list[dict] = field(default_factory=list)
    checks: list = field(default_factory=list)


class Warehouse:
    """One root folder: raw, landing and the tables, and the steps that fill them."""

    def __init__(self, spark: SparkSession, root: str, rows_per_file: int = 0):
        self.spark = spark
        self.root = root.rstrip("/")
        self.raw = f"{self.root}/raw"
        self.store = Store(spark, f"{self.root}/tables", rows_per_file)
        self.landings = Store(spark, f"{self.root}/landing", rows_per_file)
        self.columns = ColumnLog(spark, self.root)

    def landing(self, entity: str, ingestion_date: datetime.date) -> str | None:
        """Where the last landing of an entity and date lies; None if there is none or it is not whole."""
        return self.landings.last_attempt(entity, ingestion_date.isoformat())

    # Reading --------------------------------------------------------------------

    def table(self, name: str, before: str | None = None) -> DataFrame:
        """A table as it is, or was before a run; rows older than an added attribute have NULL there."""
        schema = WAREHOUSE[name]
        for spec in DIMENSIONS:
            if name == spec.name:
                return self.store.read_dimension(name, self.columns.widened(spec).schema, before)
        if name == "schema_evolution_log":
            return self.store.read_all(name, schema, before)
        return self.store.read(name, schema, before)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in WAREHOUSE}

    def staged(self, entity: str, ingestion_date: datetime.date, schema: T.StructType | None = None) -> DataFrame:
        """Landed rows of one date under the declared schema of their entity, or a wider one."""
        path = self.landing(entity, ingestion_date)
        if path is None:
            raise staging.LoadError(f"{entity} of {ingestion_date} has not been landed completely")
        return staging.staged(self.spark.read.parquet(path), schema or STAGING[entity])

    def claims_summary(self) -> DataFrame:
        return views.claims_summary(self.table("fact_claim"), self.table("dim_employer"), self.table("dim_policy"))

    def schema_evolution_history(self) -> DataFrame:
        return evolution.history_view(self.table("schema_evolution_log"))

    # Steps ----------------------------------------------------------------------

    def extract(self, inbox: str, ingestion_date: datetime.date, result: RunResult) -> None:
        """Check all headers first, then copy: a broken delivery leaves no trace in raw."""
        files, result.absent_files = deliveries.list_files(self.spark, inbox)
        if len(result.absent_files) == len(FILE_ENTITY):
            raise FileNotFoundError(f"none of the expected files is in {inbox}")
        deliveries.check_contract(deliveries.contract_report(deliveries.file_headers(self.spark, files)))
        path = self.manifest_path(ingestion_date)
        # Without a manifest nothing is read from raw: a copy that dies half way is no delivery.
        Folder(self.spark, path).delete()
        deliveries.copy_to_raw(self.spark, files, self.raw, ingestion_date).write.parquet(path)
        result.manifest = self.manifest(ingestion_date)

    def manifest_path(self, ingestion_date: datetime.date) -> str:
        return f"{self.root}/manifest/{ingestion_date.isoformat()}"

    def manifest(self, ingestion_date: datetime.date) -> DataFrame:
        """One row for each file that was copied."""
        path = self.manifest_path(ingestion_date)
        if not Folder(self.spark, path).is_complete():
            raise FileNotFoundError(f"{path} is not there: the delivery has not been copied whole")
        return self.spark.read.schema(deliveries.MANIFEST_SCHEMA).parquet(path)

    def delivered(self, ingestion_date: datetime.date) -> dict[str, DataFrame]:
        """The files of one date as they were copied, with the lines that are malformed."""
        deliveries.check_raw(self.spark, self.raw, ingestion_date, self.manifest(ingestion_date))
        return deliveries.scan_raw(self.spark, self.raw, ingestion_date, list(FILE_ENTITY))

    @staticmethod
    def transformed(
        scans: dict[str, DataFrame], as_of: datetime.date, work: str, claims_v2_again: DataFrame | None = None
    ) -> dict[str, Callable[[], DataFrame]]:
        """What makes the entities of one date.  Claims still hold those without a policy.

        Every scan is read once if ``claims_v2_again`` gives the ids of claims_v2.csv anew.
        """
        raw = {name: deliveries.well_formed(scan) for name, scan in scans.items()}
        again = None if claims_v2_again is None else deliveries.well_formed(claims_v2_again)
        return {
            "claimants": partial(entities.claimants, raw["claimants.csv"], as_of, f"{work}/claimants"),
            "claims": partial(entities.all_claims, raw["claims_v1.csv"], raw["claims_v2.csv"], again),
            "employers": partial(entities.employers, raw["employers.csv"], as_of, f"{work}/employers"),
            "payments": partial(entities.payments, raw["payments.csv"]),
            "policies": partial(entities.policies, raw["policies.csv"], as_of, f"{work}/policies"),
        }

    def transform(self, ingestion_date: datetime.date, as_of: datetime.date, result: RunResult) -> None:
        """Land every entity as Parquet and record how its columns have changed."""
        run, work = result.run_id, work_folder(self.spark, "transform")
        registry = self.store.read("schema_registry", evolution.REGISTRY_SCHEMA, before=run)
        try:
            scans = self.delivered(ingestion_date)
            # Lines for the quarantine are counted as the entities read them: files without any are not read again.
            keys = {name: entities.delivered_key(scan, FILE_ENTITY[name]) for name, scan in scans.items()}
            counted = {name: deliveries.count_faults(scan, keys[name]) for name, scan in scans.items()}
            read = {name: scan for name, (scan, _) in counted.items()}
            transformed = self.transformed(read, as_of, work, scans["claims_v2.csv"])
            landings = [partial(self._land, e, rows, ingestion_date, result) for e, rows in transformed.items()]
            try:
                columns = dict(zip(transformed, at_once(landings)))
            except Exception:
                self._quarantine(scans, keys, ingestion_date, result)
                raise
            # A count that is not known, as Spark has left out its scan, is looked for.
            faulty = {name: scan for name, scan in scans.items() if counted[name][1].get.get("n", 1)}
            self._quarantine(faulty, keys, ingestion_date, result)
        finally:
            Folder(self.spark, work).delete()
        delivered = evolution.delivered_columns(self.spark, columns, ingestion_date)
        # The load reads the events from here, whoever runs it.
        self.store.write("schema_changes", evolution.changes(registry, delivered), run)
        self.store.write("schema_registry", evolution.registry_after(registry, delivered), run)
        self.store.write("schema_snapshots", delivered.select("*", F.lit(run).alias("run")), run)
        for table in ("schema_changes", "schema_registry"):
            self.store.drop_superseded(table)
        self._keep_few("schema_snapshots", evolution.SNAPSHOT_SCHEMA)
        result.evolution_events = [r.asDict() for r in self._changes(run).collect()]  # one row per entity at most
        for e in result.evolution_events:
            log.warning("schema of %s changed: +%s -%s", e["entity"], e["added_columns"], e["removed_columns"])

    def _keep_few(self, table: str, schema: T.StructType) -> None:
        """Bound the folders of a table that is appended to by every run."""
        self.store.fold(table, schema)
        self.store.drop_replaced(table)

    def columns_as_of(self, day: datetime.date) -> DataFrame:
        """entity, columns, as_of: what was last delivered of each entity up to a day."""
        return evolution.columns_as_of(self.store.read_all("schema_snapshots", evolution.SNAPSHOT_SCHEMA), day)

    def _quarantine(
        self,
        scans: dict[str, DataFrame],
        keys: dict[str, Column | None],
        ingestion_date: datetime.date,
        result: RunResult,
    ) -> None:
        """Keep the lines of some files that no entity takes, and count them per delivered file name."""
        parts = [deliveries.quarantine(scan, name, ingestion_date, keys[name]) for name, scan in scans.items()]
        found = reduce(DataFrame.union, parts) if parts else no_rows(self.spark, deliveries.QUARANTINE_SCHEMA)
        self.store.write("quarantine", found, result.run_id)
        kept = self.store.read_run("quarantine", deliveries.QUARANTINE_SCHEMA, result.run_id)
        result.quarantined = {r.name: r["count"] for r in kept.groupBy("name").count().collect()}
        for name, count in sorted(result.quarantined.items()):
            log.warning("%s: %d lines in quarantine", name, count)
        self._keep_few("quarantine", deliveries.QUARANTINE_SCHEMA)

    def quarantine(self) -> DataFrame:
        """Lines of all deliveries that no entity has taken, with their file and what is wrong."""
        return self.store.read_all("quarantine", deliveries.QUARANTINE_SCHEMA)

    def _changes(self, run: str) -> DataFrame:
        found = self.store.read_run("schema_changes", evolution.EVENT_SCHEMA, run)
        if found is None:
            raise staging.LoadError(f"run {run} has not been transformed")
        return found

    def _land(
        self, entity: str, make: Callable[[], DataFrame], ingestion_date: datetime.date, result: RunResult
    ) -> list[str]:
        """Land what ``make`` returns; the columns it has."""
        rows = make()
        columns = rows.columns
        if entity == "claims":
            no_policy = Observation("claims_without_policy")
            rows = rows.observe(no_policy, F.count_if(F.col("policy_id").isNull()).alias("n"))
            rows = rows.filter(F.col("policy_id").isNotNull())
        seen = Observation(f"landed_{entity}")
        rows = rows.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(staging.is_faulty(STAGING[entity])).alias("faulty"),
        )
        path = self.landings.begin(entity, ingestion_date.isoformat(), ordered=False)
        rows.write.parquet(path)
        result.landed_rows[entity] = seen.get["rows"]
        log.info("landed %s: %d rows", entity, seen.get["rows"])
        if entity == "claims":
            result.claims_without_policy = no_policy.get["n"]
            log.info("claims: dropped %d rows without policy_id", result.claims_without_policy)
        if seen.get["faulty"]:
            newest = "created_at" if entity == "payments" else "updated_at"
            Folder(self.spark, path).child("_SUCCESS").delete()  # no load takes it
            # The feature is a top-10 report of what is wrong.
            shown = staging.newest_rejects(self.spark.read.parquet(path), STAGING[entity], newest).collect()
            raise staging.LoadError(
                f"{entity}: {seen.get['faulty']} rows do not fit the table, newest: "
                + "; ".join(f"{r[STAGING[entity].fieldNames()[0]]}: {', '.join(r.faults)}" for r in shown)
            )
        self.landings.drop_replaced(entity)
        return columns

    def load_dimension(self, spec: Dimension, ingestion_date: datetime.date, as_of: datetime.date, run: str) -> None:
        path, store = work_folder(self.spark, spec.name), self.store
        spec = self.columns.widened(spec)
        before = self.table(spec.name, before=run) if store.runs(spec.name, before=run) else None
        last_key = store.last_key(spec.name, before=run)
        if last_key is None and before is not None:
            last_key = before.agg(F.max(spec.surrogate_key)).first()[0]
        seen = Observation(f"keys_{spec.name}")
        try:
            staged = self.staged(spec.entity, ingestion_date, spec.staging)
            changes = scd2.load_changes(before, staged, spec, as_of, path, last_key)
            changes = changes.observe(seen, F.max(spec.surrogate_key).alias("key"))
            store.write_changes(spec.name, changes, run, SORT_COLUMNS[spec.name])
        finally:
            Folder(self.spark, path).delete()
        store.note_last_key(spec.name, max(last_key or 0, seen.get["key"] or 0), run)
        store.gather(spec.name, spec.schema, SORT_COLUMNS[spec.name])
        store.drop_superseded_parts(spec.name)

    def load_facts(self, ingestion_date: datetime.date, run: str, result: RunResult) -> None:
        """Claims before payments, which take their claim_key from the committed claims."""
        placed = facts.place_claims(
            self.staged("claims", ingestion_date),
            self.table("dim_claimant"),
            self.table("dim_policy"),
            self.table("dim_employer"),
        )
        self._load_fact("fact_claim", placed, facts.claim_rows, run, result)
        placed = facts.place_payments(self.staged("payments", ingestion_date), self.table("fact_claim"))
        self._load_fact("fact_payment", placed, facts.payment_rows, run, result)

    def _load_fact(self, name: str, placed: DataFrame, build: Callable, run: str, result: RunResult) -> None:
        seen = Observation(f"placed_{name}")
        # Counted and numbered after they are dealt out: finding the ranges reads the rows once more.
        rows = build(clustered(placed, CLUSTER_COLUMNS[name])).observe(seen, F.count(F.lit(1)).alias("rows"))
        self.store.write(name, rows, run)
        self.store.note_ranges(name, CLUSTER_COLUMNS[name])
        self.store.drop_superseded(name)
        result.placed_rows[name] = seen.get["rows"]
        log.info("%s: %d rows found their dimensions", name, seen.get["rows"])

    def load_log(self, run: str) -> None:
        """Append the events the transformation of this run has stored; a repeated load replaces its own.

        Events that do not fit the log are warned of and left out; the rest is loaded.
        """
        events = self._changes(run)
        stored = self.spark.read.parquet(self.store.last_attempt("schema_changes", run)).schema
        if faults := staging.unfit(stored, evolution.EVENT_SCHEMA):
            log.warning("schema evolution events of %s are not loaded: %s", run, "; ".join(faults))
            return
        if events.isEmpty():
            log.info("no schema evolution events")
            if self.store.last_attempt("schema_evolution_log", run):
                self.store.write("schema_evolution_log", no_rows(self.spark, WAREHOUSE["schema_evolution_log"]), run)
            return
        last = self.table("schema_evolution_log", before=run).agg(F.max("log_id")).first()[0] or 0
        entries = evolution.log_entries(events, last)
        self.store.write("schema_evolution_log", entries, run)
        self._keep_few("schema_evolution_log", WAREHOUSE["schema_evolution_log"])

    def load(self, ingestion_date: datetime.date, as_of: datetime.date, result: RunResult) -> None:
        run = result.run_id
        self.load_log(run)
        if not self.store.runs("dim_date"):
            self.store.write("dim_date", calendar.dim_date(self.spark), run, SORT_COLUMNS["dim_date"])
        at_once([partial(self.load_dimension, spec, ingestion_date, as_of, run) for spec in DIMENSIONS])
        self.load_facts(ingestion_date, run, result)

    def repair_dimension(self, spec: Dimension, fix: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Rewrite a dimension with one of the repair operators, then look for duplicates again.

        Returns the keys that still have several open rows: none after a good repair.
        """
        self.store.write_whole(spec.name, fix(self.table(spec.name)), SORT_COLUMNS[spec.name])
        return repair.duplicate_current(self.table(spec.name), spec).orderBy(spec.natural_key)

    def check(self, run: str, day: datetime.date, row_floor: int = quality.ROW_FLOOR) -> list:
        """Check the tables, keep the report, and raise if a check has failed."""
        found = quality.kept(quality.report(self.tables(), row_floor), run, day)
        self.store.write("check_history", found, run, ordered=False)
        report = self.store.read_run("check_history", found.schema, run).drop("run", "checked_on")
        self._keep_few("check_history", found.schema)
        return quality.gate(report)

    def check_trend(self) -> DataFrame:
        """The kept reports of all runs, each row beside that of the run before."""
        schema = self.spark.createDataFrame([], quality.HISTORY_SCHEMA).schema
        return quality.trend(self.store.read_all("check_history", schema))

    def run_id(self, ingestion_date: datetime.date, as_of: datetime.date, name: str | None = None) -> str:
        """A number that counts up, then ``name`` or the two dates: runs follow one another as they were started.

        The name or dates of the last run, or its whole id, name that run again, so it is
        repeated, whole or from the step that failed; any other, earlier dates too, begin a
        new run.
        """
        name = name or f"{as_of.isoformat()}_{ingestion_date.isoformat()}"
        last = max(map(run_name, self.store.runs("schema_registry")), default="")
        number = re.match(r"(\d{6})_", last)
        if last == name or number and last[number.end() :] == name:
            return last
        return f"{int(number[1]) + 1 if number else 1:06d}_{name}"

    def run(
        self,
        inbox: str,
        ingestion_date: datetime.date | None = None,
        as_of: datetime.date | None = None,
        run_id: str | None = None,
        row_floor: int = quality.ROW_FLOOR,
        steps: tuple[str, ...] = STEPS,
        earlier: RunResult | None = None,
    ) -> RunResult:
        """The four steps in order, or some of them.

        ``ingestion_date`` names the delivery, ``as_of`` is the day versions open and
        close on; both default to today.  ``run_id`` names the run; see ``Warehouse.run_id``.
        ``earlier`` is what the steps before have returned: the same run goes on, though another
        may have been transformed since.  So one delivery can be loaded while the next is taken in.
        """
        if not inbox and "extraction" in steps:
            raise ValueError("inbox is required: the folder the delivery lies in")
        as_of = as_of or datetime.date.today()
        ingestion_date = ingestion_date or as_of
        result = earlier or RunResult(self.run_id(ingestion_date, as_of, run_id))
        work = {
            "extraction": lambda: self.extract(inbox, ingestion_date, result),
            "transformation": lambda: self.transform(ingestion_date, as_of, result),
            "loading": lambda: self.load(ingestion_date, as_of, result),
        }
        with shuffles_removed(self.spark):
            for name, step in work.items():
                if name not in steps:
                    continue
                try:
                    step()
                except Exception as error:
                    raise StepError(f"{name} failed: {error}") from error
                log.info("%s done", name)
            if "checks" in steps:
                result.checks = self.check(result.run_id, as_of, row_floor)
        return result
