"""Warehouse tables as committed runs of Parquet files.

A table is a folder with one sub-folder per run.  A run is visible once Spark has
committed it (``_SUCCESS``), so a reader sees the previous state until the new one
is whole, and a job that dies half way changes nothing.  Runs are ordered by name.
A run that is repeated is an attempt of its own, beside the one it replaces; what a
published table points to stays until the table points elsewhere.

Plain tables hold their whole content in each run.  Dimensions hold per run the open
rows and the rows that run closed (``is_current=true|false``): history is written
once and never rewritten by a load.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.schemas import no_rows
from claimloom.sources.paths import Folder

_NAME = re.compile(r"[0-9A-Za-z_-]+")
# run=<name>; .again-<n> for its nth repetition, .whole-<n> for the nth rewrite of the whole dimension.
_FOLDER = re.compile(r"run=([0-9A-Za-z_-]+)(?:\.again-(\d+))?(?:\.whole-(\d+))?")
_PUBLISHED = "_PUBLISHED"
_RANGES = "_ranges"
_LAST_KEY = T.StructType([T.StructField("last_key", T.LongType())])


def _order(run: str) -> tuple[str, int, int]:
    name, attempt, rewrite = _FOLDER.fullmatch(f"run={run}").groups()
    return name, int(attempt or 0), int(rewrite or 0)


def run_name(run: str) -> str:
    """The name a run was given, whichever attempt it is."""
    return _order(run)[0]


def attempt_of(run: str) -> int:
    return _order(run)[1]


def clustered(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows dealt out and sorted by ranges of ``by``: the files written from them do not overlap.

    ``by`` ends in a unique column, so a value that many rows share is spread over files.
    """
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)


class Store:
    """``rows_per_file`` ends a file after so many rows; 0 leaves one per task and folder."""

    def __init__(self, spark: SparkSession, root: str, rows_per_file: int = 0):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rows_per_file = rows_per_file

    def _table(self, table: str) -> Folder:
        return Folder(self.spark, f"{self.root}/{table}")

    def _folders(self, table: str) -> list[str]:
        """All runs there are, also those not committed, oldest first."""
        names = [n.removeprefix("run=") for n in self._table(table).children() if _FOLDER.fullmatch(n)]
        return sorted(names, key=_order)

    def _committed(self, table: str) -> list[str]:
        return [r for r in self._folders(table) if self._run(table, r).is_complete()]

    def runs(self, table: str, before: str | None = None) -> list[str]:
        """Committed runs, the last attempt of each, oldest first; only those earlier than ``before`` if given."""
        committed = [r for r in self._committed(table) if before is None or run_name(r) < before]
        last = {run_name(r): _order(r)[1] for r in committed}
        return [r for r in committed if _order(r)[1] == last[run_name(r)]]

    def _run(self, table: str, run: str) -> Folder:
        return self._table(table).child(f"run={run}")

    def path(self, table: str, run: str) -> str:
        return self._run(table, run).path

    def begin(self, table: str, run: str, ordered: bool = True) -> str:
        """The folder of a run about to be written: a new attempt if there are some.

        Runs follow one another by name, unless ``ordered`` is given up.  What an attempt
        that died has left goes; a committed one stays for its readers.
        """
        if not _NAME.fullmatch(run):
            raise ValueError(f"not a run name: {run!r}")
        existing, committed = self._folders(table), set(self._committed(table))
        later = [r for r in committed if run_name(r) > run]
        if ordered and later:
            raise ValueError(f"{table} already holds run {max(later, key=_order)}, later than {run}")
        own = [r for r in existing if run_name(r) == run]
        for died in set(own) - committed:
            self._run(table, died).delete()
        attempt = max((_order(r)[1] for r in own), default=-1) + 1
        return self.path(table, f"{run}.again-{attempt}" if attempt else run)

    def last_attempt(self, table: str, run: str) -> str | None:
        """The folder of the last attempt of a run; None if there is none or it has not been committed."""
        own = [r for r in self._folders(table) if run_name(r) == run]
        return self.path(table, own[-1]) if own and self._run(table, own[-1]).is_complete() else None

    # Publication --------------------------------------------------------------

    def note_published(self, table: str, runs: list[str]) -> None:
        """From now on a published table points to these runs; others may go."""
        for run in self._committed(table):
            mark = self._run(table, run).child(_PUBLISHED)
            if run in runs and not mark.exists():
                mark.touch()
            elif run not in runs and mark.exists():
                mark.delete()

    def _is_free(self, table: str, run: str) -> bool:
        return not self._run(table, run).child(_PUBLISHED).exists()

    # Plain tables -------------------------------------------------------------

    def write(
        self, table: str, df: DataFrame, run: str, sort: list[str] | None = None, ordered: bool = True
    ) -> None:
        path = self.begin(table, run, ordered)
        self._writer(df.sortWithinPartitions(*sort) if sort else df).parquet(path)

    def _writer(self, df: DataFrame) -> DataFrameWriter:
        # Each task moves its files into place as it ends, not the driver all of them one after another:
        # a run is seen once it is whole, by its _SUCCESS marker, so what is there before does no harm.
        moved_by_tasks = df.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        return moved_by_tasks.option("maxRecordsPerFile", self.rows_per_file)

    def note_ranges(self, table: str, by: list[str]) -> None:
        """Note for each file of the last run the first and last values of ``by`` in it, and its rows."""
        folder = self._run(table, self.runs(table)[-1])
        rows = self.spark.read.parquet(folder.path)
        key = F.struct(*by)
        ranges = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("rows")
        )
        ranges.coalesce(1).write.parquet(folder.child(_RANGES).path)

    def file_ranges(self, table: str) -> DataFrame | None:
        """file, low, high, rows for each file of the last run, None if they have not been noted."""
        runs = self.runs(table)
        folder = self._run(table, runs[-1]).child(_RANGES) if runs else None
        return self.spark.read.parquet(folder.path) if folder and folder.is_complete() else None

    def read_between(self, table: str, schema: T.StructType, column: str, low: object, high: object) -> DataFrame:
        """Rows of the last run whose ``column`` lies between two values, both included.

        ``column`` is the first the table is clustered by: only files whose range meets
        the wanted one are opened, and only their names reach the driver.
        """
        within = F.col(column).between(low, high)
        ranges = self.file_ranges(table)
        if ranges is None:
            return self.read(table, schema).filter(within)
        meets = (F.col(f"low.{column}") <= F.lit(high)) & (F.col(f"high.{column}") >= F.lit(low))
        root = self.path(table, self.runs(table)[-1])
        files = [f"{root}/{r.file}" for r in ranges.filter(meets).select("file").collect()]
        if not files:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*sorted(files)).filter(within)

    def read(self, table: str, schema: T.StructType, before: str | None = None) -> DataFrame:
        """The table as of its last run (before the given one)."""
        runs = self.runs(table, before)
        if not runs:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self._run(table, runs[-1]).path)

    def read_run(self, table: str, schema: T.StructType, run: str) -> DataFrame | None:
        """What one run has written, None if it has not."""
        path = self.last_attempt(table, run)
        return self.spark.read.schema(schema).parquet(path) if path else None

    def read_all(self, table: str, schema: T.StructType, before: str | None = None) -> DataFrame:
        """Every run of a table that is appended to."""
        paths = [self.path(table, r) for r in self.appended(table, before)]
        if not paths:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def appended(self, table: str, before: str | None = None) -> list[str]:
        """The runs a table that is appended to is made of: the last that was folded, and those after it."""
        runs = self.runs(table, before)
        folded = [i for i, r in enumerate(runs) if _order(r)[2]]
        return runs[folded[-1] if folded else 0 :]

    def fold(self, table: str, schema: T.StructType, every: int = 30) -> None:
        """Bring all but the last run of a table that is appended to into one folder, once there are so many.

        The last run stays apart, as it may be repeated.  Folders that were folded before go,
        those just folded stay for who reads them until the next time.
        """
        runs = self.appended(table)
        if len(runs) <= every:
            return
        name, attempt, rewrite = _order(runs[-2])
        folder = self._run(table, f"{name}{f'.again-{attempt}' if attempt else ''}.whole-{rewrite + 1}")
        folder.delete()  # what an attempt that died may have left
        earlier = [self.path(table, r) for r in runs[:-1]]
        self._writer(self.spark.read.schema(schema).parquet(*earlier).hint("rebalance")).parquet(folder.path)
        needed = {*runs, *self.appended(table)}
        for run in self._committed(table):
            if run not in needed and self._is_free(table, run):
                self._run(table, run).delete()

    def drop_superseded(self, table: str, keep: int = 2) -> None:
        """Delete what newer runs and attempts of a plain table have replaced and no published table points to."""
        kept = set(self.runs(table)[-keep:])
        for run in self._committed(table):
            if run not in kept and self._is_free(table, run):
                self._run(table, run).delete()

    def drop_replaced(self, table: str) -> None:
        """Delete the attempts that later ones of the same run have replaced and no published table points to."""
        last = set(self.runs(table))
        for run in self._committed(table):
            if run not in last and self._is_free(table, run):
                self._run(table, run).delete()

    # Dimensions ---------------------------------------------------------------

    def write_changes(self, table: str, changes: DataFrame, run: str, sort: list[str]) -> None:
        """Open rows and newly closed rows of one load."""
        self._write_split(changes, self.begin(table, run), sort)

    def write_whole(self, table: str, rows: DataFrame, sort: list[str]) -> None:
        """All rows anew, after a repair of history or to gather many runs in one folder.

        Belongs to the last run and takes its place once complete.
        """
        name, attempt, rewrite = _order(self.runs(table)[-1])
        folder = self._run(table, f"{name}{f'.again-{attempt}' if attempt else ''}.whole-{rewrite + 1}")
        folder.delete()  # what an attempt that died may have left
        self._write_split(clustered(rows, ["is_current", *sort]), folder.path, sort)

    def gather(self, table: str, schema: T.StructType, sort: list[str], every: int = 30) -> None:
        """Every so many loads, bring the rows they closed from their small files into few large ones."""
        if len(self.dimension_parts(table)[1]) > every:
            self.write_whole(table, self.read_dimension(table, schema), sort)

    def drop_superseded_parts(self, table: str) -> None:
        """Delete the folders that neither a dimension's state nor that before the last run nor a published table is made of."""
        runs = self.runs(table)
        if not runs:
            return
        last = run_name(runs[-1])
        states = [runs, self.runs(table, before=last)]
        newest = {state[-1] for state in states if state}
        needed = {path for before in (None, last) for side in self.dimension_parts(table, before) for path in side}
        for run in self._committed(table):
            if not self._is_free(table, run):
                continue
            sides = [self._run(table, run).child(f"is_current={flag}") for flag in ("true", "false")]
            for side in sides:
                if side.path not in needed:
                    side.delete()
            if run not in newest and not any(side.exists() for side in sides):
                self._run(table, run).delete()

    def last_key(self, table: str, before: str) -> int | None:
        """The greatest key given up to the last run, if that run has noted it."""
        runs, noted = self.runs(table, before), self.runs(f"{table}_last_key", before)
        if not runs or not noted or run_name(runs[-1]) != run_name(noted[-1]):
            return None
        return self.read(f"{table}_last_key", _LAST_KEY, before).first()[0]

    def note_last_key(self, table: str, key: int, run: str) -> None:
        self.write(f"{table}_last_key", self.spark.range(key, key + 1).select(F.col("id").alias("last_key")), run)
        self.drop_superseded(f"{table}_last_key")

    def _write_split(self, rows: DataFrame, path: str, sort: list[str]) -> None:
        self._writer(rows.sortWithinPartitions("is_current", *sort)).partitionBy("is_current").parquet(path)

    def dimension_parts(self, table: str, before: str | None = None) -> tuple[list[str], list[str]]:
        """Folders of the open rows and folders of the closed rows of a dimension."""
        runs = self.runs(table, before)
        if not runs:
            return [], []
        whole = [i for i, r in enumerate(runs) if _order(r)[2]]
        first = whole[-1] if whole else 0

        def folders(run: str, flag: str) -> list[str]:
            folder = self._run(table, run).child(f"is_current={flag}")
            return [folder.path] if folder.exists() else []

        return folders(runs[-1], "true"), [p for r in runs[first:] for p in folders(r, "false")]

    def read_dimension(self, table: str, schema: T.StructType, before: str | None = None) -> DataFrame:
        """Open rows of the last run and the rows all runs closed.

        ``is_current`` is a constant of each side, so a filter on it skips the other.
        """
        stored = T.StructType([f for f in schema.fields if f.name != "is_current"])
        sides = [
            self.spark.read.schema(stored).parquet(*paths).withColumn("is_current", F.lit(flag))
            for flag, paths in zip((True, False), self.dimension_parts(table, before))
            if paths
        ]
        if not sides:
            return no_rows(self.spark, schema)
        both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        return both.select(*schema.fieldNames())

