"""Databases, tables and views for SQL users, over the committed files."""

from __future__ import annotations

import datetime
from urllib.parse import unquote

from pyspark.sql import types as T

from claimloom.plans.pipeline import Warehouse
from claimloom.schemas import DIMENSIONS, ENTITIES, STAGING, WAREHOUSE
from claimloom.sources.deliveries import QUARANTINE_SCHEMA
from claimloom.sources.paths import Folder
from claimloom.sources.store import Store, attempt_of, run_name

DATABASES = ("landing", "staging", "warehouse", "analytics")
_ROOT = "claimloom.root"
#: Columns that the published views read, beside keys.
_VIEWED = {
    "warehouse.fact_claim": ["claim_type", "claim_status", "claim_severity", "claim_amount", "approved_amount"]
    + ["employer_key", "policy_key"],
    "warehouse.dim_employer": ["company_name", "industry"],
    "warehouse.dim_policy": ["coverage_type"],
    "warehouse.schema_evolution_log": ["previous_version", "current_version", "added_columns", "removed_columns"],
}


def _type(field: T.StructField) -> str:
    """The declared type: text with a limit is VARCHAR, which Spark holds writers to and reads as text."""
    limit = field.metadata.get("max_length")
    return f"varchar({limit})" if limit else field.dataType.simpleString()


def _columns(schema: T.StructType, without: tuple[str, ...] = ()) -> str:
    return ", ".join(f"`{f.name}` {_type(f)}" for f in schema.fields if f.name not in without)


def _shown(schema: T.StructType, dropped: set[str]) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name.lower() not in dropped])


def create_databases(warehouse: Warehouse) -> None:
    for name in DATABASES:
        warehouse.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def _complete(warehouse: Warehouse, name: str, schema: T.StructType, added: list[tuple[str, str]]) -> None:
    """Give a published table the columns it lacks."""
    spark = warehouse.spark
    there = {column.lower() for column in spark.table(name).columns}
    wanted = [(f.name, _type(f)) for f in schema.fields] + added
    missing = ", ".join(f"`{column}` {kind}" for column, kind in wanted if column.lower() not in there)
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({missing})")


def _point(warehouse: Warehouse, name: str, schema: T.StructType, location: str, added: list[tuple[str, str]]) -> None:
    """A table of the files at ``location``; one that is there is pointed to it, never dropped."""
    spark = warehouse.spark
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING parquet LOCATION '{location}'")
    _complete(warehouse, name, schema, added)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.sql(f"REFRESH TABLE {name}")


def _properties(warehouse: Warehouse, name: str) -> dict[str, str]:
    return {row.key: row.value for row in warehouse.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _partitioned(
    warehouse: Warehouse,
    name: str,
    schema: T.StructType,
    keys: dict[str, str],
    partitions: list[tuple[dict[str, str], str]],
    added: list[tuple[str, str]],
) -> None:
    """A table made of folders given one by one, each a partition: (partition values, folder).

    Partitions that are not wanted any more go, their files stay; then the others come.
    """
    spark = warehouse.spark
    root = f"{warehouse.store.root}/{name.rsplit('.', 1)[1]}"
    by = ", ".join(f"{key} {kind}" for key, kind in keys.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema, tuple(keys))}) USING parquet"
        f" PARTITIONED BY ({by}) LOCATION '{root}'"
    )
    _complete(warehouse, name, schema, added)

    def spec(values: dict[str, str]) -> str:
        return "PARTITION (" + ", ".join(f"{key}='{value}'" for key, value in values.items()) + ")"

    wanted = {"/".join(f"{k}={v}" for k, v in values.items()): (values, folder) for values, folder in partitions}
    there = {unquote(row[0]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    kept = there & set(wanted)
    if _properties(warehouse, name).get(_ROOT) != warehouse.root:  # partitions of another warehouse, whatever their names
        kept = set()
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_ROOT}' = '{warehouse.root}')")
    for old in sorted(there - kept):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {spec(dict(part.split('=', 1) for part in old.split('/')))}")
    new = [f"{spec(wanted[key][0])} LOCATION '{wanted[key][1]}'" for key in sorted(set(wanted) - kept)]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new)}")
    spark.sql(f"REFRESH TABLE {name}")


def publish(warehouse: Warehouse, ingestion_date: datetime.date) -> None:
    """Bring all tables and views to the last committed run; what is there is altered, not dropped.

    A landed column without a place in the staging schema is not shown there; see
    ``add_column``.
    """
    create_databases(warehouse)
    store: Store = warehouse.store
    added, dropped = warehouse.columns.added(), warehouse.columns.dropped()
    for entity in ENTITIES:
        name, landings = f"staging.stg_{entity}", warehouse.landings
        landed = warehouse.landing(entity, ingestion_date)
        schema = _shown(STAGING[entity], dropped.get(name, set()))
        _point(warehouse, name, schema, landed or f"{landings.root}/{entity}/run=none", added.get(name, []))
    publish_landings(warehouse)
    runs = store.appended("quarantine")
    parts = [({"run": run}, store.path("quarantine", run)) for run in runs]
    _partitioned(warehouse, "staging.quarantine", QUARANTINE_SCHEMA, {"run": "string"}, parts, [])
    store.note_published("quarantine", runs)
    store.drop_replaced("quarantine")
    for name, schema in WAREHOUSE.items():
        runs, table = store.runs(name), f"warehouse.{name}"
        schema, more = _shown(schema, dropped.get(table, set())), added.get(table, [])
        if name in {d.name for d in DIMENSIONS}:
            open_folders, closed_folders = store.dimension_parts(name)
            parts = [({"run": _run_of(p), "is_current": "true"}, p) for p in open_folders]
            parts += [({"run": _run_of(p), "is_current": "false"}, p) for p in closed_folders]
            _partitioned(warehouse, table, schema, {"run": "string", "is_current": "boolean"}, parts, more)
            store.note_published(name, sorted({_run_of(p) for _, p in parts}))
            store.drop_superseded_parts(name)
        elif name == "schema_evolution_log":
            runs = store.appended(name)
            parts = [({"run": run}, store.path(name, run)) for run in runs]
            _partitioned(warehouse, table, schema, {"run": "string"}, parts, more)
            store.note_published(name, runs)
            store.drop_replaced(name)
        else:
            # Before the first run there is nothing at its place, and the table is empty.
            _point(warehouse, table, schema, f"{store.root}/{name}/run={runs[-1] if runs else 'none'}", more)
            store.note_published(name, runs[-1:])
            store.drop_superseded(name, keep=len(runs) if name == "dim_date" else 2)
    create_views(warehouse)


def publish_landings(warehouse: Warehouse) -> None:
    """landing.<entity>: all that has landed, a partition per date, with the columns of every date.

    The schema of a date is read from its files once, when the date comes; dates that are
    there are stay as they are, unless they are those of another warehouse.  A column a date
    lacks is NULL in it.  A column that comes with another type than it has is refused.
    """
    spark, landings = warehouse.spark, warehouse.landings
    keys = {"ingestion_date": "date", "attempt": "int"}
    for entity in ENTITIES:
        name, runs = f"landing.{entity}", landings.runs(entity)
        known = spark.table(name).schema if spark.catalog.tableExists(name) else T.StructType()
        own = known.fields and _properties(warehouse, name).get(_ROOT) == warehouse.root
        there = {unquote(r[0]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} if own else set()
        schema = T.StructType([f for f in known if f.name not in keys])
        parts = []
        for run in runs:
            values = {"ingestion_date": run_name(run), "attempt": str(attempt_of(run))}
            parts.append((values, landings.path(entity, run)))
            if "/".join(f"{k}={v}" for k, v in values.items()) not in there:
                schema = _merged(name, schema, spark.read.parquet(parts[-1][1]).schema)
        if schema.fields:
            _partitioned(warehouse, name, schema, keys, parts, [])
        landings.note_published(entity, runs)
        landings.drop_replaced(entity)


def _merged(name: str, schema: T.StructType, more: T.StructType) -> T.StructType:
    kinds = {f.name.lower(): f.dataType for f in schema}
    for f in more:
        if kinds.setdefault(f.name.lower(), f.dataType) != f.dataType:
            raise ValueError(f"{name}: {f.name} is {f.dataType.simpleString()}, not {kinds[f.name.lower()].simpleString()}")
    missing = [f for f in more if f.name.lower() not in {g.name.lower() for g in schema}]
    return T.StructType([*schema.fields, *missing])


def _run_of(folder: str) -> str:
    """The run in .../run=<run>/is_current=<flag>."""
    return folder.rsplit("/", 2)[1].removeprefix("run=")


def create_views(warehouse: Warehouse) -> None:
    spark = warehouse.spark
    spark.sql(
        """
        CREATE OR REPLACE VIEW analytics.claims_summary AS
        WITH per_key AS (
            SELECT employer_key, policy_key, claim_type, claim_status, claim_severity,
                   count(*) AS claims, sum(claim_amount) AS claimed,
                   count(claim_amount) AS amounts, sum(approved_amount) AS approved
            FROM warehouse.fact_claim
            GROUP BY ALL
        )
        SELECT company_name, industry, coverage_type, claim_type, claim_status, claim_severity,
               sum(claims) AS total_claims,
               CAST(sum(claimed) AS DECIMAL(38,2)) AS total_claimed,
               CAST(sum(approved) AS DECIMAL(38,2)) AS total_approved,
               CAST(try_divide(CAST(sum(claimed) AS DECIMAL(38,2)), CAST(sum(amounts) AS DECIMAL(20,0)))
                    AS DECIMAL(16,6)) AS avg_claim_amount
        FROM per_key
        JOIN (SELECT * FROM warehouse.dim_employer WHERE is_current) USING (employer_key)
        JOIN (SELECT * FROM warehouse.dim_policy WHERE is_current) USING (policy_key)
        GROUP BY company_name, industry, coverage_type, claim_type, claim_status, claim_severity
        """
    )
    spark.sql(
        """
        CREATE OR REPLACE VIEW analytics.schema_evolution_history AS
        SELECT entity, detection_date, previous_version, current_version, added_columns, removed_columns
        FROM warehouse.schema_evolution_log
        """
    )


def add_column(warehouse: Warehouse, table: str, column: str, data_type: str, tracked: bool = False) -> None:
    """Show a new source column in a published table, now and after every later publication.

    Rows landed before it read NULL.  A dimension takes the column over from its staged
    versions with the next load; a change in a ``tracked`` one opens a new version.
    """
    warehouse.columns.add(table, column, data_type, tracked)
    _complete(warehouse, table, T.StructType(), [(column, data_type)])


def drop_column(warehouse: Warehouse, table: str, column: str) -> None:
    """Do not show a column any more, now and after every later publication; its values stay in the files.

    Spark cannot take a column from a Parquet table, so one without it takes its place
    under its name, with the same files, partitions and properties.
    """
    spark, name = warehouse.spark, table.rsplit(".", 1)[1]
    declared = {**{f"stg_{e}": s for e, s in STAGING.items()}, **WAREHOUSE}[name]
    if any(f.name.lower() == column.lower() and not f.nullable for f in declared.fields):
        raise ValueError(f"{table} is not without {column}")
    if column.lower() in _VIEWED.get(table, ()):
        raise ValueError(f"a view reads {column} of {table}")
    warehouse.columns.drop(table, column)
    there = spark.table(table)
    if column.lower() not in {c.lower() for c in there.columns}:
        return
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    keys = [r[0] for r in spark.sql(f"DESCRIBE TABLE {table}").collect()]
    keys = keys[keys.index("# col_name") + 1 :] if "# col_name" in keys else []
    kept = [c for c in there.columns if c.lower() != column.lower()]
    types = ", ".join(f"`{c}` {described[c]}" for c in kept if c not in keys)
    by = f"PARTITIONED BY ({', '.join(f'`{k}` {described[k]}' for k in keys)})" if keys else ""
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    spark.sql(f"CREATE TABLE {table}__next ({types}) USING parquet {by} LOCATION '{described['Location']}'")
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items() if k != _ROOT and not k.startswith("transient"))
    if listed:
        spark.sql(f"ALTER TABLE {table}__next SET TBLPROPERTIES ({listed})")
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table}").collect() if keys else []:
        values = "PARTITION (" + ", ".join("{}='{}'".format(*part.split("=", 1)) for part in unquote(spec).split("/")) + ")"
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {values}").collect()
        place = next(r[1] for r in detail if r[0] == "Location")  # of the partition; that of the table follows
        spark.sql(f"ALTER TABLE {table}__next ADD {values} LOCATION '{place}'")
    if _ROOT in properties:
        spark.sql(f"ALTER TABLE {table}__next SET TBLPROPERTIES ('{_ROOT}' = '{properties[_ROOT]}')")
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__before")
    spark.sql(f"ALTER TABLE {table}__next RENAME TO {table}")
    spark.sql(f"DROP TABLE {table}__before")
