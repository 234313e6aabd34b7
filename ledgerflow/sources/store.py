"""Parquet tables in a shared folder, each with one small state record.

    <root>/<layer>/<table>/v=<n>/       the n-th state of a snapshot table (FULL, gold, control)
    <root>/<layer>/<table>/load=<n>/    the n-th load of an append table
    <root>/<layer>/<table>/key_part=<k>/  the rows of a keyed table (MERGE) by blocks of keys
    <root>/_state/<layer>/<table>/<k>   state records; the highest number holds
    <root>/_work/<layer>/<table>/       the batch being merged, and what it makes of the parts it touches

A write goes to a folder that nobody reads yet; only the new state record (a
small file, renamed into place) makes it visible, together with everything
that must move with it: the mark reached, the loads taken from the table
before, the stream batches taken.  A crash before it leaves the old state; the
next try writes the same folder again.  Folders and records that neither the
present nor the last state uses are removed.  A table has one writer at a time.

A keyed table is merged by touched partitions.  What the batch makes of them is
written beside the table; the state record that names it commits the merge, and
Spark's dynamic partition overwrite then puts it into the table.  If that is cut
off, the next read or write does it again from the same rows.  With ``order`` the
rows of a partition are sorted by a mark column's typed key, which stands beside
them in the files (it is no column of the table), so that rows past a mark are
read without the files and row groups below it.

Rows and marks are observed while they are written; nothing is read back for them.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregate import latest_per_key
from ..operators.conform import empty_like
from ..operators.merge import KEY_PART, key_part, merge_upsert
from ..operators.watermark import may_be_past, order_key, order_name

LOAD = "load"
#: a keyed table has a partition for so many rows of its first batch, and so many at least
PART_ROWS = 1_000_000
LEAST_PARTS = 64


@dataclass(frozen=True)
class State:
    kind: str  # snapshot | append | keyed
    number: int  # the snapshot's number, the last load's, or the last merge's
    schema: dict  # Spark's JSON form: an empty table has a schema too
    rows: int  # of the snapshot's last batch, or of the last load
    run_id: int | None = None  # of the last load that wasn't a stream's
    mark: str | None = None  # the highest value of the mark column loaded
    taken: int = 0  # loads of the table before (an append table) that are in here
    streams: dict[str, int] = field(default_factory=dict)  # stream id -> last micro-batch taken
    parts: int = 0  # of a keyed table: the partitions that keys are dealt to
    pending: bool = False  # the last merge is committed, but not yet in the table's folder
    order: dict | None = None  # of a keyed table: the field (Spark's JSON form) that its partitions are sorted by

    def struct(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)

    def hidden(self) -> list[T.StructField]:
        """The fields of a keyed table's files that are no columns of the table."""
        order = [T.StructField.fromJson(self.order)] if self.order else []
        return [*order, T.StructField(KEY_PART, T.IntegerType())]


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    # ------------------------------------------------------ state records
    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, path: str, prefix: str = "") -> list[int]:
        """The numbers in the names ``<prefix><n>`` in a folder; none if there is no folder."""
        folder, fs = self._hadoop(path)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())

    def _records(self, layer: str, table: str) -> str:
        return f"{self.root}/_state/{layer}/{table}"

    def state(self, layer: str, table: str) -> State | None:
        """The committed state; None for a table that was never written.

        Only a folder that isn't there means "never written": any other
        failure to read is raised.
        """
        folder = self._records(layer, table)
        numbers = self._numbers(folder)
        if not numbers:
            return None
        record, fs = self._hadoop(f"{folder}/{numbers[-1]}")
        stream = fs.open(record)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return State(**json.loads(text))

    def commit(self, layer: str, table: str, state: State) -> None:
        """Makes ``state`` the table's: a new record, then removal of what is no longer used."""
        folder = self._records(layer, table)
        numbers = self._numbers(folder)
        number = (numbers[-1] if numbers else 0) + 1
        draft, fs = self._hadoop(f"{folder}/_draft")
        out = fs.create(draft, True)
        try:
            out.write(json.dumps(asdict(state)).encode())
        finally:
            out.close()
        if not fs.rename(draft, self._hadoop(f"{folder}/{number}")[0]):
            raise OSError(f"cannot commit {layer}.{table}: {folder}/{number}")
        # the state before stays: frames that were read from it may still be in use
        for n in numbers:
            if n < number - 1:
                fs.delete(self._hadoop(f"{folder}/{n}")[0], False)
        if state.kind == "snapshot":
            for n in self._numbers(self.path(layer, table), "v="):
                if n < state.number - 1:
                    fs.delete(self._hadoop(f"{self.path(layer, table)}/v={n}")[0], True)

    def exists(self, layer: str, table: str) -> bool:
        return self.state(layer, table) is not None

    # --------------------------------------------------------------- read
    def read(self, layer: str, table: str, after_load: int = 0, past: tuple[str, T.DataType, str] | None = None) -> DataFrame | None:
        """The committed rows, of an append table those of loads after
        ``after_load``; None for a table that was never written.

        past: (mark column, its type, mark).  Of a keyed table that is ordered
        by the column, files and row groups without a row past the mark are
        skipped; rows that aren't past it may still come, none that is stays out.
        """
        state = self._settled(layer, table)
        if state is None:
            return None
        if state.kind == "snapshot":
            return self._frame(f"{self.path(layer, table)}/v={state.number}", state.struct())
        if state.kind == "keyed":
            rows = self._parts(layer, table, state)
            if past and order_name(*past[:2]) in rows.columns:
                rows = rows.where(may_be_past(*past))
            return rows.select(*state.struct().names)
        schema = T.StructType([*state.struct().fields, T.StructField(LOAD, T.LongType())])
        rows = self._frame(self.path(layer, table), schema)
        return rows.where((F.col(LOAD) > after_load) & (F.col(LOAD) <= state.number)).drop(LOAD)

    def _frame(self, path: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)

    # -------------------------------------------------------------- write
    def _of_kind(self, layer: str, table: str, kind: str) -> State | None:
        state = self.state(layer, table)
        if state is not None and state.kind != kind:
            raise ValueError(f"{layer}.{table} is a {state.kind} table: a {kind} load would hide its rows")
        return state

    @staticmethod
    def _seen(state: State | None, stream: tuple[str, int] | None) -> bool:
        """A micro-batch that was committed before, replayed after a crash."""
        return state is not None and stream is not None and state.streams.get(stream[0], -1) >= stream[1]

    @staticmethod
    def _observed(df: DataFrame, mark: Column | None) -> tuple[DataFrame, Observation]:
        """``df`` that counts its rows and takes the mark while it is written.

        Write it as it is: in the last stage each partition is counted once,
        however often its task is tried.
        """
        seen = Observation()
        reached = F.max(F.lit(None).cast("string")) if mark is None else mark.cast("string")
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), reached.alias("mark")), seen

    def _next(self, old: State | None, kind: str, number: int, schema: T.StructType, rows: int, run_id, mark, taken, stream) -> State:
        state = old or State(kind, 0, {}, 0)
        return replace(
            state,
            number=number,
            schema=json.loads(schema.json()),
            rows=rows,
            run_id=state.run_id if run_id is None or stream else int(run_id),
            mark=state.mark if mark is None else mark,
            taken=state.taken if taken is None else taken,
            streams=state.streams | ({stream[0]: stream[1]} if stream else {}),
        )

    def stage(self, layer: str, table: str, df: DataFrame, mark: Column | None = None) -> tuple[DataFrame, int, str | None]:
        """``df`` written once beside the table, so that all later reads see the same rows; its rows and mark."""
        path = f"{self._work(layer, table)}/batch"
        counted, seen = self._observed(df, mark)
        counted.write.mode("overwrite").parquet(path)
        return self._frame(path, df.schema), seen.get["rows"], seen.get["mark"]

    def write_snapshot(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        run_id: int | None = None,
        *,
        mark: Column | None = None,
        taken: int | None = None,
        stream: tuple[str, int] | None = None,
    ) -> int:
        """Replaces the table by ``df``; gives its rows.

        mark: an aggregate over the same rows, kept with the state; taken: the
        last load taken from the table before; stream: (id, batch) of a
        micro-batch, which is skipped if it was committed before.
        """
        old = self._of_kind(layer, table, "snapshot")
        if self._seen(old, stream):
            return 0
        number = (old.number if old else 0) + 1
        path = f"{self.path(layer, table)}/v={number}"
        counted, seen = self._observed(df, mark)
        counted.write.mode("overwrite").parquet(path)
        self.commit(layer, table, self._next(old, "snapshot", number, df.schema, seen.get["rows"], run_id, seen.get["mark"], taken, stream))
        return seen.get["rows"]

    # ------------------------------------------------------- keyed tables
    def _work(self, layer: str, table: str) -> str:
        return f"{self.root}/_work/{layer}/{table}"

    def _parts(self, layer: str, table: str, state: State) -> DataFrame:
        return self._frame(self.path(layer, table), T.StructType([*state.struct().fields, *state.hidden()]))

    @staticmethod
    def _sorted(rows: DataFrame, state: State) -> DataFrame:
        return rows.sortWithinPartitions(KEY_PART, state.order["name"]) if state.order else rows

    def _settled(self, layer: str, table: str) -> State | None:
        """The state, after a merge that was committed is in the table's folder."""
        state = self.state(layer, table)
        if state is None or not state.pending:
            return state
        schema = T.StructType([*state.struct().fields, *state.hidden()])
        merged = self._sorted(self._frame(f"{self._work(layer, table)}/merge={state.number}", schema), state)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(KEY_PART).parquet(self.path(layer, table))
        state = replace(state, pending=False)
        self.commit(layer, table, state)
        folder, fs = self._hadoop(f"{self._work(layer, table)}/merge={state.number}")
        fs.delete(folder, True)
        return state

    def upsert(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        keys: list[str],
        run_id: int | None = None,
        *,
        latest_by: list[str] | None = None,
        mark: Column | None = None,
        taken: int | None = None,
        stream: tuple[str, int] | None = None,
        order: tuple[str, T.DataType] | None = None,
    ) -> int:
        """Merges ``df`` into a table partitioned by blocks of ``keys``; gives its rows.

        Only partitions that hold keys of the batch are read and written.
        latest_by: of several rows of a key the latest is taken.  A batch that
        was merged before may be merged again; a micro-batch of ``stream`` that
        was committed before is skipped.  order: the mark column, and the type
        that its values have, by which the written partitions are sorted.
        """
        old = self._of_kind(layer, table, "keyed")
        if self._seen(old, stream):
            return 0
        old = self._settled(layer, table)
        batch, rows, reached = self.stage(layer, table, df, mark)
        parts = old.parts if old else max(LEAST_PARTS, -(-rows // PART_ROWS))
        source = latest_per_key(batch, keys, latest_by).select(*batch.columns) if latest_by else batch
        part = key_part(keys, parts)
        touched = sorted(r[0] for r in source.select(part.alias("p")).distinct().collect())  # at most parts + 1
        base = self._parts(layer, table, old).where(F.col(KEY_PART).isin(touched)).select(*old.struct().names) if old else empty_like(batch)
        merged = merge_upsert(base, source, keys, evolve=True)
        number = (old.number if old else 0) + 1
        state = self._next(old, "keyed", number, merged.schema, rows, run_id, reached, taken, stream)
        files, by = merged.withColumn(KEY_PART, part), None
        if order:
            files = files.withColumn(order_name(*order), order_key(F.col(order[0]), order[1]))
            by = json.loads(files.schema[order_name(*order)].json())
        state = replace(state, parts=parts, pending=True, order=by)
        self._sorted(files.repartition(KEY_PART), state).write.mode("overwrite").partitionBy(KEY_PART).parquet(f"{self._work(layer, table)}/merge={number}")
        self.commit(layer, table, state)
        self._settled(layer, table)
        return rows

    # ------------------------------------------------------------ catalog
    def publish(self, layer: str, table: str) -> str:
        """Names the committed rows ``<layer>.<table>`` in the session catalog; gives the name.

        The database has an empty folder of its own.  A snapshot table's name is pointed at the committed folder by one
        ``ALTER TABLE .. SET LOCATION``; of an append table the committed loads
        become partitions, of a keyed one all that are there.  The tables are
        external: dropping a name leaves the rows.
        """
        state = self._settled(layer, table)
        if state is None:
            raise ValueError(f"{layer}.{table} was never written")
        name, fields, path = f"`{layer}`.`{table}`", state.struct().fields, self.path(layer, table)
        column = {"append": (LOAD, T.LongType()), "keyed": (KEY_PART, T.IntegerType())}.get(state.kind)
        fields = [*fields, *([T.StructField(*column)] if column else [])]
        where = path if column else f"{path}/v={state.number}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{self.root}/_catalog/{layer}'")
        known = self.spark.catalog.tableExists(name) and self.spark.table(name).schema == T.StructType([T.StructField(f.name, f.dataType) for f in fields])
        if known and not column:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")
            self.spark.catalog.refreshTable(name)
            return name
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        by = f"PARTITIONED BY (`{column[0]}`)" if column else ""
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {by} LOCATION '{where}'")
        if state.kind == "append":
            for n in range(1, state.number + 1):
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({LOAD}={n}) LOCATION '{path}/{LOAD}={n}'")
        elif column:
            self.spark.catalog.recoverPartitions(name)
        return name

    # ------------------------------------------------------------- append

    def append(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        run_id: int,
        *,
        mark: Column | None = None,
        taken: int | None = None,
        stream: tuple[str, int] | None = None,
    ) -> int:
        """Adds ``df`` as the next load; gives its rows.

        Skipped where it was committed before: a replayed micro-batch of
        ``stream``, loads of the table before up to ``taken``, else a second
        load of the same run.  New columns join the table's schema (NULL in
        earlier loads); a column of another type is refused.
        """
        old = self._of_kind(layer, table, "append")
        if stream:
            done = self._seen(old, stream)
        elif taken is not None:
            done = old is not None and taken <= old.taken
        else:
            done = old is not None and old.run_id == int(run_id)
        if done:
            return 0 if stream or taken is not None else old.rows
        number = (old.number if old else 0) + 1
        fields = {f.name: f for f in (old.struct().fields if old else [])}
        for f in df.schema.fields:
            if f.name in fields and fields[f.name].dataType != f.dataType:
                raise ValueError(f"{layer}.{table}.{f.name}: {f.dataType.simpleString()}, was {fields[f.name].dataType.simpleString()}")
            fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
        # dynamic overwrite: a load that was written but not committed is replaced, the others stay
        counted, seen = self._observed(df, mark)
        counted.withColumn(LOAD, F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD).parquet(self.path(layer, table))
        self.commit(layer, table, self._next(old, "append", number, T.StructType(list(fields.values())), seen.get["rows"], run_id, seen.get["mark"], taken, stream))
        return seen.get["rows"]
