"""Deliveries: folders of CSV files, their contract check, raw copy and reading.

A delivered file is ``<name>.csv``, or for large entities a folder of that name with
part files in it; every part carries its own header.  Parts may be compressed, as their
names say (``.csv.gz``): they are copied as they are and read as Spark reads such files.
"""

from __future__ import annotations

import datetime
import hashlib
import logging
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.schemas import FILE_ENTITY, FILE_HEADERS
from claimloom.sources.paths import Folder

log = logging.getLogger("claimloom.deliveries")

CHUNK_BYTES = 8 * 1024 * 1024
#: A header line is not longer than this.
HEADER_BYTES = 16 * 1024 * 1024

# The file helpers travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ContractError(Exception):
    """A delivered file lacks columns its contract asks for."""


@dataclass(frozen=True)
class DeliveredFile:
    name: str  # name in the contract, e.g. claims_v1.csv
    path: str

    @property
    def entity(self) -> str:
        return FILE_ENTITY[self.name]


def list_files(spark: SparkSession, inbox: str) -> tuple[DataFrame, list[str]]:
    """(name, path, uri, length) of the expected files that are there, and the names of those that are not.

    Spark lists the folders, so no path passes through Python.  Its partitions hold files
    of a bounded number of bytes, or one larger file: what reads or copies them does so a
    partition at a time.
    """
    places = {name: f"{inbox.rstrip('/')}/{name}" for name in FILE_ENTITY}
    there = [name for name, path in places.items() if Folder(spark, path).exists()]
    listed = _listed(spark, [places[name] for name in there])
    absent = [name for name in FILE_ENTITY if name not in {r.name for r in listed.select("name").distinct().collect()}]
    for name in absent:
        log.warning("expected file %s is not in %s, skipped", name, inbox)
    return listed, absent


_LISTED = "name string, path string, uri string, length long"


def _listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files at or below some paths, each of them named by the contract."""
    if not paths:
        return spark.createDataFrame([], _LISTED)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    path = F.col("path")
    own = [F.when(path.endswith(f"/{name}") | path.contains(f"/{name}/"), F.lit(name)) for name in FILE_ENTITY]
    return found.select(F.coalesce(*own).alias("name"), "path", F.col("_metadata.file_path").alias("uri"), "length")


def find_files(spark: SparkSession, inbox: str) -> tuple[list[DeliveredFile], list[str]]:
    """As ``list_files``, as a list: for deliveries of few files."""
    listed, absent = list_files(spark, inbox)
    return [DeliveredFile(r.name, r.path) for r in listed.orderBy("name", "path").collect()], absent


def _as_listed(spark: SparkSession, files: DataFrame | list[DeliveredFile]) -> DataFrame:
    if isinstance(files, DataFrame):
        return files
    return _one_file_per_task(spark, [(f.name, f.path, f.path, None) for f in files], _LISTED)


def store_settings(spark: SparkSession) -> dict[str, str]:
    """What Hadoop is told of its object store, for the tasks that read and copy files themselves."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    names = ("endpoint", "endpoint.region", "access.key", "secret.key", "session.token", "path.style.access")
    names += ("connection.ssl.enabled",)
    return {name: conf.get(f"fs.s3a.{name}") for name in names if conf.get(f"fs.s3a.{name}")}


def _open(path: str, settings: dict[str, str] | None = None) -> tuple[fs.FileSystem, str]:
    # Hadoop and Arrow name two schemes differently.
    uri = path.replace("s3a://", "s3://", 1)
    uri = "file://" + uri[len("file:"):] if uri.startswith("file:/") and not uri.startswith("file://") else uri
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    if uri.startswith("file://"):  # a path of Hadoop, not an encoded URI
        return fs.LocalFileSystem(), uri[len("file://") :]
    if uri.startswith("s3://") and settings:
        given = {
            "access_key": settings.get("access.key"),
            "secret_key": settings.get("secret.key"),
            "session_token": settings.get("session.token"),
            "endpoint_override": settings.get("endpoint"),
            "region": settings.get("endpoint.region", "us-east-1"),
            "scheme": "http" if settings.get("connection.ssl.enabled") == "false" else "https",
            "force_virtual_addressing": settings.get("path.style.access") == "false",
        }
        return fs.S3FileSystem(**{k: v for k, v in given.items() if v is not None}), uri[len("s3://") :]
    return fs.FileSystem.from_uri(uri)


def _first_line(path: str, settings: dict[str, str] | None = None) -> str:
    file_system, name = _open(path, settings)
    line = b""
    with file_system.open_input_stream(name, compression="detect") as stream:  # by the end of the name
        while b"\n" not in line:
            block = stream.read(65536)
            if not block:
                break
            line += block
            if len(line) > HEADER_BYTES and b"\n" not in line:
                raise ContractError(f"{path}: no end of the header in its first {HEADER_BYTES} bytes")
    return line.split(b"\n")[0].decode("utf-8")


def _copy(source: str, target: str, settings: dict[str, str] | None = None) -> tuple[str, int]:
    """Copy in chunks; the file appears under its name only when it is whole.

    Each attempt writes its own file, hidden from readers, so a task that is repeated
    or run twice at a time does no harm.
    """
    from_fs, from_name = _open(source, settings)
    to_fs, to_name = _open(target, settings)
    folder, name = to_name.rsplit("/", 1)
    unfinished = f"{folder}/_{name}.{uuid.uuid4().hex}"
    digest, size = hashlib.md5(), 0
    to_fs.create_dir(folder, recursive=True)
    # Byte for byte: a compressed file is not unpacked on its way.
    with from_fs.open_input_stream(from_name, compression=None) as read:
        with to_fs.open_output_stream(unfinished, compression=None) as write:
            while block := read.read(CHUNK_BYTES):
                digest.update(block)
                size += len(block)
                write.write(block)
    if to_fs.get_file_info(to_name).type == fs.FileType.File:
        to_fs.delete_file(unfinished)
    else:
        to_fs.move(unfinished, to_name)
    return digest.hexdigest(), size


def _one_file_per_task(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows dealt by position, one to a partition: a hash would put some together."""
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, max(1, len(rows))), schema)


def file_headers(spark: SparkSession, files: DataFrame | list[DeliveredFile]) -> DataFrame:
    """(name, path, columns, uri, header): the header of every listed file, read by tasks of many files."""
    settings = store_settings(spark)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(header=[_first_line(path, settings) for path in batch["path"]])

    listed = _as_listed(spark, files).select("name", "path", "uri")
    columns = F.transform(F.split("header", ","), lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""))
    return listed.mapInPandas(read, "name string, path string, uri string, header string").select(
        "name", "path", columns.alias("columns"), "uri", "header"
    )


def contract_report(headers: DataFrame) -> DataFrame:
    """(name, path, columns, missing, extra); a file without a contract has neither.

    Columns may come in any order and with blanks around their names.
    """
    contract = F.create_map(
        *[F.lit(x) for name, line in FILE_HEADERS.items() for x in (name, line)]
    )
    expected = F.split(F.try_element_at(contract, F.col("name")), ",")
    nothing = F.array().cast("array<string>")
    return headers.select(
        "name",
        "path",
        "columns",
        F.coalesce(F.array_except(expected, "columns"), nothing).alias("missing"),
        F.coalesce(F.array_except("columns", expected), nothing).alias("extra"),
    )


def check_contract(report: DataFrame) -> dict[str, list[list[str]]]:
    """Raise if any file lacks columns, warn of new ones; returns the headers seen per name.

    Files with the same header are one row by the time they reach the driver.
    """
    by_header = report.groupBy("name", "columns", "missing", "extra").agg(
        F.count(F.lit(1)).alias("files"), F.min("path").alias("first")
    )
    rows = by_header.collect()
    faults = [f"{r.name}: missing columns {sorted(r.missing)} ({r.files} files, {r.first})" for r in rows if r.missing]
    if faults:
        raise ContractError("; ".join(sorted(faults)))
    headers: dict[str, list[list[str]]] = {}
    for r in sorted(rows, key=lambda r: (r.name, r.columns)):
        headers.setdefault(r.name, []).append(list(r.columns))
        if r.extra:
            log.warning("new columns in %s (%d files): %s", r.name, r.files, sorted(r.extra))
    return headers


def raw_path(raw: str, entity: str, ingestion_date: datetime.date, name: str) -> str:
    return f"{raw.rstrip('/')}/{entity}/{ingestion_date.isoformat()}/{name}"


def copy_to_raw(
    spark: SparkSession,
    files: DataFrame | list[DeliveredFile],
    raw: str,
    ingestion_date: datetime.date,
    source: str = "inbox",
) -> DataFrame:
    """Copy listed files into the raw zone, byte for byte, and return their manifest.

    (name, entity, path, md5, length, ingestion_date, source).  Files are read in chunks, so
    one of any size passes; repeating a task is harmless.
    """
    settings, listed = store_settings(spark), _as_listed(spark, files)
    names = {r.name for r in listed.select("name").distinct().collect()}
    for name in names:  # parts of an earlier delivery must not linger
        Folder(spark, raw_path(raw, FILE_ENTITY[name], ingestion_date, name)).delete()
    whole = F.create_map(*[F.lit(x) for n in FILE_ENTITY for x in (n, raw_path(raw, FILE_ENTITY[n], ingestion_date, n))])
    entity = F.create_map(*[F.lit(x) for pair in FILE_ENTITY.items() for x in pair])
    # A part file keeps its name below the folder.
    is_part = ~F.expr("endswith(path, concat('/', name))")
    part = F.when(is_part, F.concat(F.lit("/"), F.element_at(F.split("path", "/"), -1))).otherwise("")
    rows = listed.select(
        "name", entity[F.col("name")].alias("entity"), "path", F.concat(whole[F.col("name")], part).alias("target")
    )

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            copied = [_copy(s, t, settings) for s, t in zip(batch["path"], batch["target"])]
            yield batch.assign(md5=[c[0] for c in copied], length=[c[1] for c in copied])

    return rows.mapInPandas(
        copy, "name string, entity string, path string, target string, md5 string, length long"
    ).select(
        "name",
        "entity",
        F.col("target").alias("path"),
        "md5",
        "length",
        F.lit(ingestion_date).alias("ingestion_date"),
        F.lit(source).alias("source"),
    )


#: What a scan adds to the delivered columns.
LINE, FILE = "_malformed_line", "_delivered_file"

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("fault", T.StringType()),
        T.StructField("ingestion_date", T.DateType()),
    ]
)


def well_formed(scan: DataFrame) -> DataFrame:
    """The delivered columns of the lines that have as many fields as their header."""
    # True of every row, but no scan is asked for LINE alone, which Spark does not allow (as a count would).
    column = F.col(f"`{scan.columns[0]}`")
    any_row = column.isNull() | (F.length(column) >= 0)
    return scan.filter(F.col(LINE).isNull() & any_row).drop(LINE, FILE)


def _fault(key: Column | None) -> Column:
    """Why no entity takes a line, NULL if one does."""
    malformed = F.when(F.col(LINE).isNotNull(), F.lit("not as many fields as the header"))
    return malformed if key is None else malformed.when(key.isNull(), F.lit("no readable key"))


def count_faults(scan: DataFrame, key: Column | None = None) -> tuple[DataFrame, Observation]:
    """The scan, with the number ``n`` of lines for the quarantine counted as something else reads it."""
    seen = Observation()
    return scan.observe(seen, F.count(_fault(key)).alias("n")), seen


def quarantine(scan: DataFrame, name: str, ingestion_date: datetime.date, key: Column | None = None) -> DataFrame:
    """Lines of a delivered file that no entity takes: malformed ones and, where ``key`` is given, those it is NULL for.

    A malformed line is as it was delivered, another one is written anew from its fields.
    """
    delivered = [c for c in scan.columns if c not in (LINE, FILE)]
    line = F.coalesce(LINE, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in delivered])))
    found = scan.select(F.col(FILE).alias("file"), line.alias("line"), _fault(key).alias("fault")).filter("fault IS NOT NULL")
    own = {"name": F.lit(name), "entity": F.lit(FILE_ENTITY[name]), "ingestion_date": F.lit(ingestion_date)}
    return found.withColumns(own).select(*QUARANTINE_SCHEMA.fieldNames())


def read_csv(spark: SparkSession, columns_by_path: dict[str, list[str]]) -> DataFrame:
    """The rows of some CSV files, or folders of such, all columns as text.

    No inference pass: names come from the headers, types from the entity schemas.
    Paths with the same header are one scan; columns a path lacks are NULL.  A line with
    more or fewer fields than its header is in ``LINE``, NULL for others; ``FILE`` is the
    file a row comes from.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, columns in columns_by_path.items():
        groups.setdefault(tuple(columns), []).append(path)
    frames = [
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in (*columns, LINE)]))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .csv(sorted(paths))
        .withColumn(FILE, F.col("_metadata.file_path"))
        for columns, paths in sorted(groups.items())
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


MANIFEST_SCHEMA = (
    "name string, entity string, path string, md5 string, length long, ingestion_date date, source string"
)


class RawError(Exception):
    """The raw zone does not hold what the manifest says was copied."""


def check_raw(spark: SparkSession, raw: str, ingestion_date: datetime.date, manifest: DataFrame) -> None:
    """Raise unless raw holds the files of the manifest, all of them, as long as they were, and no other.

    Spark lists the folders; files are compared where they are listed, and only those
    that differ reach the driver, ten of them by name.
    """
    folders = [f"{raw.rstrip('/')}/{entity}/{ingestion_date.isoformat()}" for entity in sorted(set(FILE_ENTITY.values()))]
    there = [folder for folder in folders if Folder(spark, folder).exists()]

    def place(path: str) -> Column:  # the last two parts: unique within the folders of one date
        return F.concat_ws("/", F.slice(F.split(path, "/"), -2, 2))

    copied = manifest.select(place("path").alias("place"), F.col("length").alias("copied"))
    if there:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there)
    else:
        found = spark.createDataFrame([], "path string, length long")
    found = found.select(place("path").alias("place"), F.col("length").alias("found"))
    differs = copied.join(found, "place", "full").filter(~F.col("copied").eqNullSafe(F.col("found")))
    first = [r.place for r in differs.orderBy("place").limit(10).collect()]
    if first:
        n = differs.count()
        raise RawError(f"{n} files of {ingestion_date} are not as they were copied, among them {', '.join(first)}")


def read_raw(
    spark: SparkSession, raw: str, ingestion_date: datetime.date, names: list[str]
) -> dict[str, DataFrame]:
    """Well-formed rows of the delivered files of one date; all headers in one job."""
    return {name: well_formed(scan) for name, scan in scan_raw(spark, raw, ingestion_date, names).items()}


def scan_raw(
    spark: SparkSession, raw: str, ingestion_date: datetime.date, names: list[str]
) -> dict[str, DataFrame]:
    """Delivered files of one date, as they lie in the raw zone, with ``LINE`` and ``FILE``."""
    whole = {name: raw_path(raw, FILE_ENTITY[name], ingestion_date, name) for name in names}
    for path in whole.values():
        if not Folder(spark, path).exists():
            raise FileNotFoundError(f"{path} has not been delivered")
    headers = file_headers(spark, _listed(spark, list(whole.values())))
    seen: dict[str, list] = {name: [] for name in names}
    for r in headers.select("name", "columns", "header").distinct().collect():  # one row per header, not per file
        seen[r.name].append(r)
    for name, path in whole.items():
        if not seen[name]:
            raise FileNotFoundError(f"{path} has not been delivered")
    scans = {}
    for name, found in seen.items():
        if len({tuple(r["columns"]) for r in found}) == 1:
            scans[name] = read_csv(spark, {whole[name]: list(found[0]["columns"])})
        else:
            scans[name] = _read_mixed(spark, whole[name], headers.filter(F.col("name") == name), found)
    return scans


def _read_mixed(spark: SparkSession, folder: str, headers: DataFrame, seen: list) -> DataFrame:
    """The rows of a folder whose files differ in their headers: each line is parsed by the header of its file.

    The driver knows the distinct headers, not the files.  Lines equal to the header of
    their file are no rows.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(folder)
    lines = lines.select("value", F.col("_metadata.file_path").alias(FILE)).filter("trim(value) != ''")
    known = headers.select(F.col("uri").alias(FILE), "header")
    own = lines.join(known, FILE).filter(F.rtrim("value", F.lit("\r")) != F.rtrim("header", F.lit("\r")))
    result = None
    for r in sorted(seen, key=lambda r: r.header):
        fields = ", ".join(f"`{c.replace('`', '``')}` string" for c in (*r["columns"], LINE))
        parsed = F.from_csv("value", fields, {"columnNameOfCorruptRecord": LINE, "mode": "PERMISSIVE"})
        rows = own.filter(F.col("header") == r.header).select(parsed.alias("row"), FILE).select("row.*", FILE)
        result = rows if result is None else result.unionByName(rows, allowMissingColumns=True)
    return result
