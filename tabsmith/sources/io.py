"""Sources and sinks: raw scans with projection, multi-file unions, writes."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tabsmith.functions.naming import strip_table_prefix
from tabsmith.functions.nulls import nulls_for_nan

SOURCE_COLUMN = "__source_file"


def _headers(spark: SparkSession, path: str, pattern: str | None = None) -> list[tuple[str, list[str]]]:
    """(header line, files that have it) of the CSV files under a path.

    Every split is a task of its own that takes one line and stops, so only the
    first bytes of each are read; a file's header is the line of its first split.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    text = own.read.format("text")
    if pattern:
        text = text.option("pathGlobFilter", pattern)
    lines = text.load(path).select("value", F.col("_metadata.file_path").alias("file"),
                                   F.col("_metadata.file_block_start").alias("block"))

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    found = lines.mapInArrow(first, lines.schema).where("block = 0")
    rows = found.groupBy("value").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("value").collect()
    return [(r["value"], r["files"]) for r in rows]


def _read_csv(spark: SparkSession, path: str, schema: StructType | None, pattern: str | None = None,
              corrupt: str | None = None) -> DataFrame:
    """CSV files with headers, columns matched by name in every file.

    Spark takes the names of one file (or of the schema) for all and reads by
    position, so files are grouped by their header line: one read per distinct
    header, united by name.  A column that a file lacks is null.  ``corrupt`` names
    a column for lines that don't fit their header or the declared types.
    """
    types = {strip_table_prefix(f.name): f.dataType for f in schema.fields} if schema is not None else None
    parts, groups = [], _headers(spark, path, pattern)
    for header, files in groups:
        names = next(csv.reader([header.lstrip("\ufeff")]))
        own = StructType([StructField(n, types.get(strip_table_prefix(n), StringType()) if types else StringType())
                          for n in names])
        reader = spark.read.option("header", True).option("enforceSchema", False)
        if corrupt:
            own = own.add(corrupt, StringType())
            reader = reader.option("columnNameOfCorruptRecord", corrupt)
        if pattern and len(groups) == 1:
            reader = reader.option("pathGlobFilter", pattern)
        # One header for all: the path itself, no list of files.
        part = reader.schema(own).csv(path if len(groups) == 1 else files)
        # United under plain names; a file that has a name both ways keeps both.
        plain = [strip_table_prefix(c) for c in part.columns]
        shown = [p if plain.count(p) == 1 else c for p, c in zip(plain, part.columns)]
        parts.append(part.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(part.columns, shown)],
                                 F.col("_metadata.file_path").alias(SOURCE_COLUMN)))
    if not parts:
        return spark.createDataFrame([], (schema or StructType()).add(SOURCE_COLUMN, "string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _select(df: DataFrame, columns: Sequence[str], path: str) -> list:
    """Each column by its own or its prefixed name."""
    present = {strip_table_prefix(c): c for c in reversed(df.columns)} | {c: c for c in df.columns}
    out = []
    for c in columns:
        plain = strip_table_prefix(c)
        src = present.get(c, present.get(plain))
        if src is None:
            raise KeyError(f"column {c!r} not in {path}")
        out.append(F.col(f"`{src}`").alias(plain))
    return out


def scan_project(spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "parquet",
                 schema: StructType | None = None, header: bool = True, corrupt: str | None = None) -> DataFrame:
    """Read only ``columns``; a ``t.`` prefix is stripped by name; NaN is null.

    The file may carry either the prefixed or the plain header: each requested
    column is matched by name, per file, so neither the order of the config nor
    that of a header mislabels columns.  ``corrupt`` adds a column of that name
    with the CSV lines that fit neither their header nor the declared types.
    """
    if fmt == "csv" and header:
        df = _read_csv(spark, path, schema, corrupt=corrupt)
        columns = [*columns, corrupt] if corrupt else columns
    else:
        reader = spark.read.format(fmt)
        df = (reader.schema(schema) if schema is not None else reader).load(path)
    return nulls_for_nan(df.select(*_select(df, columns, path)))


def scan_directory(spark: SparkSession, directory: str, fmt: str = "csv", pattern: str | None = None,
                   columns: Sequence[str] | None = None, schema: StructType | None = None,
                   corrupt: str | None = None) -> DataFrame:
    """All files of a folder as one table with a ``source`` column (file path).

    Spark already skips names starting with ``.`` or ``_``.  Per-file
    semantics downstream (sampling, splits) group on ``source``.
    """
    if fmt == "csv":
        df = _read_csv(spark, directory, schema, pattern, corrupt)
        source = F.col(SOURCE_COLUMN)
    else:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        if pattern:
            reader = reader.option("pathGlobFilter", pattern)
        df = reader.load(directory)
        source = F.col("_metadata.file_path")
    wanted = columns or [f.name for f in (schema.fields if schema is not None else df.schema.fields)
                         if f.name not in (SOURCE_COLUMN, corrupt)]
    wanted = [*wanted, corrupt] if corrupt and fmt == "csv" else wanted
    return nulls_for_nan(df.select(*_select(df, wanted, directory), source.alias("source")))


def union_sources(frames: Mapping[str, DataFrame], mapping: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Union tables that carry the same fields under different names, tagged with ``source``."""
    parts = []
    for name, df in frames.items():
        if mapping is not None:
            if len(mapping[name]) != len(df.columns):
                raise ValueError(f"{name}: {len(mapping[name])} names for {len(df.columns)} columns")
            df = df.toDF(*mapping[name])
        parts.append(df.withColumn("source", F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b), parts)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> str:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", True)
    return r.load(path)


SPLIT_TABLES = ("X_train", "X_test", "y_train", "y_test")


def split_tables(df: DataFrame, flag: str, label: str, keys: Sequence[str]) -> dict[str, DataFrame]:
    """X and y of both halves by a 1 / 0 flag.  y carries ``keys``, which stand for
    the reference's positional alignment; rows without a flag are in no half."""
    halves = {"train": df.filter(F.col(flag) == 1), "test": df.filter(F.col(flag) == 0)}
    return {f"{kind}_{half}": rows.drop(label) if kind == "X" else rows.select(*keys, label)
            for kind in ("X", "y") for half, rows in halves.items()}


def write_split_tables(df: DataFrame, path: str, flag: str, label: str, keys: Sequence[str],
                       fmt: str = "parquet") -> dict[str, str]:
    """Write the clean table (partitioned by the flag) and the four split tables
    made of it; table name -> path."""
    paths = {"clean": write_table(df, f"{path}/clean", fmt, partition_by=[flag])}
    clean = read_table(df.sparkSession, paths["clean"], fmt)
    for name, part in split_tables(clean, flag, label, keys).items():
        paths[name] = write_table(part, f"{path}/{name}", fmt)
    return paths


def run_folder(folder: str) -> str:
    """A folder's place for the predictions of one run, stamped with its UTC time."""
    return f"{folder}/predictions_{datetime.now(timezone.utc).strftime('%Y%m%d_%H%M%S_%f')}"


def write_predictions(df: DataFrame, folder: str, fmt: str = "parquet") -> str:
    """Write all rows to a folder of their own, stamped with the UTC time of the
    run; an earlier run's folder is never overwritten."""
    return write_table(df, run_folder(folder), fmt, mode="errorifexists")


def write_batch(df: DataFrame, run: str, batch_id: int, fmt: str = "parquet") -> str:
    """Write one batch of a run to its own folder.  A batch that comes again (a stream
    that restarts) replaces itself and adds no row."""
    return write_table(df, f"{run}/batch_id={batch_id}", fmt, mode="overwrite")
