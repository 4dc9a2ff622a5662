"""What several operators share: reading columns, intermediate tables, hashed words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.sources.paths import Folder, land, work_folder

#: ``[^\x20\x09-\x0D]+`` is what ``bytes.split()`` returns: it knows these six bytes only.
SPACES = " \t\n\x0b\x0c\r"
#: Words a worker keeps the result of; beyond it the store starts afresh (results stay the same).
KEPT_WORDS = 200_000
SLICE_ROWS = 512
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def columns(df: DataFrame, **named: str | Column) -> DataFrame:
    """Only the named columns: others cannot clash with what an operator adds."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(name) for name, c in named.items()])


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go when it ends: what follows reads the table it has written."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Scratch:
    """Intermediate tables of one operator, in a folder of their own below the shared one."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = work_folder(spark, f"llm-{purpose}")

    def land(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write a table, in a folder for each value of ``by`` if given, and go on from its files."""
        path = f"{self.root}/{name}"
        with _shuffles_dropped(self.spark):
            if by is None:
                return land(df, path)
            df.write.partitionBy(by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            Folder(self.spark, f"{self.root}/{name}").delete()


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows: what a worker turns into Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_rows(
    df: DataFrame, function: Callable[[Iterable[tuple]], Iterable[tuple]], schema: str, rows: int = 2000
) -> DataFrame:
    """``function`` turns an iterator over a partition's rows (text as bytes) into rows.

    Rows come and go in Arrow batches; ``rows`` bounds what a batch going out holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def incoming() -> Iterator[tuple]:
            for batch in slices(batches):
                cast = [c.cast(pa.binary()) if pa.types.is_string(c.type) else c for c in batch.columns]
                yield from zip(*[c.to_pylist() for c in cast])

        held: list[tuple] = []
        for row in function(incoming()):
            held.append(row)
            if len(held) >= rows:
                yield _batch(held, fields)
                held = []
        if held:
            yield _batch(held, fields)

    parsed = df.sparkSession.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    fields = [(f.name, _arrow(f.dataType.simpleString())) for f in parsed.fields]
    return df.mapInArrow(run, parsed)


def _arrow(kind: str) -> pa.DataType:
    plain = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    plain |= {"binary": pa.binary(), "boolean": pa.bool_()}
    if kind.startswith("array<"):
        return pa.list_(_arrow(kind[6:-1]))
    return plain[kind]


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    arrays = [pa.array(values, kind) for values, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


class WordHashes:
    """64-bit hashes of words, kept for words that come again."""

    def __init__(self, kept: int = KEPT_WORDS):
        self._known: dict[bytes, int] = {}
        self._kept = kept

    def of(self, words: list[bytes]) -> np.ndarray:
        known, look = self._known, xxhash.xxh3_64_intdigest
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > self._kept:
                known.clear()
            for word in words:
                if word not in known:
                    known[word] = look(word)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo; NULL counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
