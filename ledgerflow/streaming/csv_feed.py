"""CSV landing folders as Structured Streaming sources.

The file source plus its checkpoint replaces hand-made file discovery: each
file is taken exactly once across runs.  The stream carries file paths; a
micro-batch reads its files by the names in their own headers, so columns may
come in any order, be missing (NULL) or be new (they join the bronze table).

A row that doesn't fit its file's header fails the batch, or, if asked for, is
kept with its file's name in ``<table>_rejects`` while the others land.

Writes go through ``foreachBatch`` into the table store, which keeps (stream
id, micro-batch) with the data it commits: a micro-batch replayed after a
crash is skipped, and one of another stream, or of a stream with a new
checkpoint, never is.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import conform

MISFIT, FILE = "_misfit", "_file"
FILES = "path string, modificationTime timestamp, length long, content binary"


def csv_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming frame of the paths of the files in a landing folder (contents aren't read)."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("path")


def read_csv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], misfits: bool = False) -> DataFrame:
    """The files' rows as strings: ``columns`` (NULL where a file lacks one),
    then any further columns of their headers.

    A header without any of ``columns``, or with a name twice, fails.  A row
    that doesn't fit its header (too few or too many values) fails too, or with
    ``misfits`` is marked: ``_misfit`` holds its line and ``_file`` its file, both
    NULL in rows that fit.
    """
    wanted = [c.strip().lower() for c in columns]
    lines = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    by_header: dict[str, list[str]] = {}
    for row in first.orderBy("file").collect():  # a row for each file of one trigger
        by_header.setdefault(row["header"], []).append(row["file"])
    extra = [MISFIT, FILE] if misfits else []
    out = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in [*wanted, *extra]]))
    for header, files in by_header.items():
        names = [n.strip().lower() for n in next(csv.reader([header.removeprefix("﻿")]))]
        if len(set(names)) < len(names) or not set(names) & set(wanted):
            raise ValueError(f"header {header!r} of {files[0]} does not fit the columns {wanted}")
        if misfits and set(names) & set(extra):
            raise ValueError(f"header {header!r} of {files[0]} uses a reserved name")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *extra[:1]]])
        reader = spark.read.schema(schema).option("header", True)
        if misfits:
            # the header's check is the one above; without it a file's own names decide
            rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MISFIT).option("enforceSchema", True).csv(files)
            rows = rows.withColumn(FILE, F.when(F.col(MISFIT).isNotNull(), F.col("_metadata.file_path")))
        else:
            rows = reader.option("mode", "FAILFAST").csv(files)
        out = out.unionByName(rows, allowMissingColumns=True)
    return out


def _drain(feed: DataFrame, checkpoint: str, on_batch: Callable[[list[str], tuple[str, int]], int]) -> int:
    """Takes what is available; gives the sum of what ``on_batch`` stored."""
    stored = []

    def each(batch: DataFrame, batch_id: int) -> None:
        # the id that Spark keeps in the checkpoint: a new checkpoint is another stream
        record = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0]
        paths = [r["path"] for r in batch.collect()]
        stored.append(on_batch(paths, (json.loads(record)["id"], batch_id)) if paths else 0)

    feed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return sum(stored)


def land_stream(
    store, layer: str, table: str, feed: DataFrame, columns: Sequence[str], run_id: int, checkpoint: str, *,
    keys: Sequence[str] | None = None, latest_by: Sequence[str] | None = None, order: tuple[str, T.DataType] | None = None, rejects: bool = False,
) -> int:
    """Lands every new file's rows in ``layer.table``; gives the rows stored.

    They are appended, or with ``keys`` merged, micro-batch by micro-batch (see
    ``TableStore.upsert`` for latest_by and order).  rejects: rows that don't fit their
    file's header go to ``<table>_rejects``, each batch's once, as the others do.
    """

    def on_batch(paths: list[str], stream: tuple[str, int]) -> int:
        rows = read_csv(store.spark, paths, columns, misfits=rejects)
        if rejects:
            rows, *_ = store.stage(layer, f"{table}_read", rows)  # read once: what fits and what doesn't
            bad = rows.where(F.col(MISFIT).isNotNull()).select(MISFIT, FILE)
            store.append(layer, f"{table}_rejects", bad, run_id, stream=stream)
            rows = rows.where(F.col(MISFIT).isNull()).drop(MISFIT, FILE)
        if keys:
            return store.upsert(layer, table, rows, list(keys), run_id, latest_by=latest_by and list(latest_by), stream=stream, order=order)
        return store.append(layer, table, rows, run_id, stream=stream)

    return _drain(feed, checkpoint, on_batch)


def upsert_stream(store, layer: str, table: str, feed: DataFrame, keys: Sequence[str], schema: T.StructType, checkpoint: str) -> int:
    """Micro-batch upsert of a feed straight into a typed (silver) table; gives the rows taken."""

    def on_batch(paths: list[str], stream: tuple[str, int]) -> int:
        rows = conform(read_csv(store.spark, paths, [f.name for f in schema.fields]), schema)
        return store.upsert(layer, table, rows, list(keys), stream=stream)

    return _drain(feed, checkpoint, on_batch)
