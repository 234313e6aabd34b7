"""The medallion jobs: source -> bronze -> silver -> gold, driven by the registry.

* bronze: extract (partitioned JDBC with pushed-down projection and mark
  predicate, a CSV feed, or any DataFrame source) past the mark that bronze
  itself has reached, land as strings, load by type (FULL snapshot, MERGE
  upsert on the key, APPEND load).
* silver: take the bronze loads it hasn't taken yet (or of the bronze snapshot
  the rows past its own mark, by a typed key that the scan skips by), cast to the contract, add audit timestamps, load by type.
* gold: build every registered mart from silver, each on its own, write it,
  record its count.

The mark reached and the bronze loads taken are committed in one record with
the rows (``TableStore``), so a failure anywhere neither loses nor repeats
rows: the next run goes on from the committed state.  The control table of
marks is a copy for people to read, and the starting point of a new table.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.aggregate import account_totals, transaction_totals
from ..operators.conform import add_audit_columns, conform, land_as_string, reject_reason
from ..operators.merge import merge_upsert
from ..operators.watermark import watermark_filter, watermark_upsert
from ..session import checkpoint_dir
from ..sources.jdbc import extract_full, extract_incremental
from ..streaming.csv_feed import land_stream
from . import gold, registry
from .registry import TableConfig

Extractor = Callable[[TableConfig], DataFrame]
META = "metadata"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class _Silver(dict):
    """Silver tables by name; a missing one fails only what asks for it."""

    def __missing__(self, name):
        raise ValueError(f"silver table {name} does not exist")


class Pipeline:
    """Runs the three hops against a ``TableStore``.

    ``extractors`` maps a source system name (``oracledb``, ``sqlserver``,
    ``blob``, ...) to a function returning the extract for a table config;
    unknown systems raise.
    """

    def __init__(self, spark: SparkSession, store, extractors: dict[str, Extractor],
                 run_ts: str | None = None, gold_parallelism: int = 5):
        self.spark = spark
        self.store = store
        self.extractors = {k.lower(): v for k, v in extractors.items()}
        self.run_ts = run_ts
        self.gold_parallelism = gold_parallelism

    # ------------------------------------------------------- control
    def seed(self) -> None:
        """Create the control tables with their seed rows if absent."""
        for name, df in registry.seed_control_tables(self.spark).items():
            if not self.store.exists(META, name):
                self.store.write_snapshot(META, name, df)

    def control(self) -> dict[str, DataFrame]:
        return {n: self.store.read(META, n) for n in schemas.CONTROL_TABLES}

    def start_run(self) -> int:
        ctl = self.control()
        run_id = registry.next_run_id(ctl["run_execution_details"]).collect()[0]["run_id"]
        start = _now()
        row = self.spark.createDataFrame([(str(run_id), start, None, None)], schemas.RUN_EXECUTION_DETAILS)
        self.store.write_snapshot(META, "run_execution_details",
                                  ctl["run_execution_details"].unionByName(row))
        return int(run_id)

    def _audit(self, run_id: int, layer: str, **kw) -> None:
        self._audit_rows([registry.audit_row(self.spark, run_id, layer, **kw)])

    def _audit_rows(self, rows: list[DataFrame]) -> None:
        """One upsert (one new version of the audit table) for several entries."""
        new = rows[0]
        for r in rows[1:]:
            new = new.unionByName(r)
        runs = self.store.read(META, "pipeline_runs")
        self.store.write_snapshot(META, "pipeline_runs", registry.run_audit_upsert(runs, new))

    # -------------------------------------------------------- bronze
    def bronze(self, table_id: int, run_id: int) -> int:
        cfg = registry.load_config(self.control(), table_id)
        start = _now()
        try:
            rows = self._bronze(cfg, run_id)
        except Exception as e:
            self._audit(run_id, "BRONZE", table_id=table_id, start=start, end=_now(), status="FAILED", error=str(e))
            raise
        self._audit(run_id, "BRONZE", table_id=table_id, start=start, end=_now(), records=rows)
        return rows

    def _bronze(self, cfg: TableConfig, run_id: int) -> int:
        layer, table = cfg.bronze_schema, cfg.table_name
        extract = self.extractors.get(cfg.source_system)
        if extract is None:
            raise ValueError(f"no extractor for source system {cfg.source_system!r}")
        state = self.store.state(layer, table)
        if state is not None and state.mark is not None:
            cfg.last_watermark_value = state.mark  # what has landed isn't extracted again
        src = extract(cfg)
        if src.isStreaming:
            # File feed: the stream's checkpoint decides which files are new.
            # A MERGE feed is upserted on its key, micro-batch by micro-batch.
            merged = cfg.load_type == "MERGE" and cfg.primary_key
            return land_stream(
                self.store, layer, table, src, cfg.columns, run_id, f"{self.store.root}/_streams/{layer}/{table}",
                keys=[cfg.primary_key.strip().lower()] if merged else None,
                latest_by=self._latest(cfg) if merged else None,
                order=self._order(cfg),
                rejects=cfg.bad_rows == "quarantine",
            )
        if state is not None and state.run_id == run_id and cfg.load_type != "FULL":
            return state.rows  # landed by an earlier try of this run
        mark = None
        if cfg.load_type != "FULL" and cfg.watermark_column:
            src = extract_incremental(src, cfg.columns, cfg.watermark_column, cfg.last_watermark_value)
            name = cfg.watermark_column.lower()
            mark = F.max(F.col(name).try_cast(src.schema[name].dataType))
        else:
            src = extract_full(src, cfg.columns)
        return self._load(layer, cfg, land_as_string(src), run_id, mark, order=self._order(cfg))

    def _load(self, layer: str, cfg: TableConfig, df: DataFrame, run_id: int, mark: Column | None, taken: int | None = None, order=None) -> int:
        table = cfg.table_name
        if cfg.load_type == "FULL":
            return self.store.write_snapshot(layer, table, df, run_id, mark=mark, taken=taken)
        if cfg.load_type == "APPEND":
            return self.store.append(layer, table, df, run_id, mark=mark, taken=taken)
        # MERGE on the primary key; opt-in: of several source rows per key the latest
        key = cfg.primary_key.strip().lower()
        return self.store.upsert(layer, table, df, [key], run_id, latest_by=self._latest(cfg), mark=mark, taken=taken, order=order)

    @staticmethod
    def _order(cfg: TableConfig) -> tuple[str, T.DataType] | None:
        """What a landed MERGE table is ordered by: the mark column, as the contract types it."""
        contract, name = schemas.ENTITIES[cfg.table_name], (cfg.watermark_column or "").lower()
        return (name, contract[name].dataType) if cfg.load_type == "MERGE" and name in contract.names else None

    @staticmethod
    def _latest(cfg: TableConfig) -> list[str] | None:
        return [cfg.watermark_column.lower()] if cfg.merge_dedupe == "latest" and cfg.watermark_column else None

    # -------------------------------------------------------- silver
    def silver(self, table_id: int, run_id: int) -> int:
        ctl = self.control()
        cfg = registry.load_config(ctl, table_id)
        start = _now()
        try:
            rows = self._silver(cfg, run_id)
        except Exception as e:
            self._audit(run_id, "SILVER", table_id=table_id, start=start, end=_now(), status="FAILED", error=str(e))
            raise
        self._audit(run_id, "SILVER", table_id=table_id, start=start, end=_now(), records=rows)
        mark = self.store.state(cfg.silver_schema, cfg.table_name).mark
        if mark is not None and mark != cfg.last_watermark_value:
            new = self.spark.createDataFrame([(table_id, mark)], "table_id int, mark string")
            marks = watermark_upsert(ctl["table_watermarks"], new, run_id=run_id, updated_at=F.current_timestamp())
            self.store.write_snapshot(META, "table_watermarks", marks)
        return rows

    def _silver(self, cfg: TableConfig, run_id: int) -> int:
        landed, here = self.store.state(cfg.bronze_schema, cfg.table_name), self.store.state(cfg.silver_schema, cfg.table_name)
        if landed is None and cfg.source_system == "blob":
            return self._load(cfg.silver_schema, cfg, self._typed(cfg, None), run_id, None, 0)  # no file has come yet
        if landed is None:
            raise ValueError(f"bronze table {cfg.bronze_schema}.{cfg.table_name} does not exist")
        loads = landed.kind == "append"
        taken = landed.number if loads else None
        since = here.mark if here and here.mark is not None else cfg.last_watermark_value
        # rejects are those of the whole snapshot, so they need all of it
        past = self._order(cfg) if since and since.strip() and cfg.bad_rows != "quarantine" else None
        bronze = self.store.read(cfg.bronze_schema, cfg.table_name, after_load=here.taken if here and loads else 0, past=past and (*past, since))
        contract = schemas.ENTITIES[cfg.table_name]
        if cfg.bad_rows == "quarantine":
            # Rows that do not fit the contract go, as landed text and with
            # the failing column names, to <table>_rejects; the rest load.
            # Default: fail fast (ANSI cast).
            flagged = bronze.withColumn("_reject", reject_reason(bronze, contract))
            rejects, name = flagged.where(F.col("_reject").isNotNull()), f"{cfg.table_name}_rejects"
            if loads:
                self.store.append(cfg.silver_schema, name, rejects, run_id, taken=taken)
            else:
                self.store.write_snapshot(cfg.silver_schema, name, rejects, run_id)
            bronze = flagged.where(F.col("_reject").isNull()).drop("_reject")
        typed, mark = self._typed(cfg, bronze), None
        wm = cfg.watermark_column.lower() if cfg.watermark_column else None
        if cfg.load_type != "FULL" and wm:
            typed = watermark_filter(typed, wm, since)
        if wm:
            mark = F.max(wm)
        return self._load(cfg.silver_schema, cfg, typed, run_id, mark, taken)

    def _typed(self, cfg: TableConfig, bronze: DataFrame | None) -> DataFrame:
        contract = schemas.ENTITIES[cfg.table_name]
        if bronze is None:
            bronze = self.spark.createDataFrame([], schemas.bronze_schema(cfg.table_name))
        ts = F.lit(self.run_ts).cast("timestamp") if self.run_ts else F.current_timestamp()
        return add_audit_columns(conform(bronze, contract), ts)

    # ---------------------------------------------------------- gold
    def silver_tables(self) -> dict[str, DataFrame]:
        out = _Silver()
        for name in schemas.ENTITIES:
            df = self.store.read("silver", name)
            if df is not None:
                out[name] = df.select(*[f.name for f in schemas.ENTITIES[name].fields])
        return out

    def gold(self, run_id: int) -> dict[str, int]:
        """Builds and writes every registered mart; one that fails is audited
        as FAILED and doesn't stop the others."""
        silver = self.silver_tables()
        checkpoint_dir(self.spark, shared=f"{self.store.root}/_checkpoints")
        kpis = self.control()["gold_layer_kpi"].orderBy("kpi_id").collect()
        lock, shared = threading.Lock(), {}

        def totals() -> tuple[DataFrame, DataFrame]:
            # per-customer totals feed two marts: computed once, by the first that asks
            with lock:
                if not shared:
                    acct = account_totals(silver["accounts"]).checkpoint()
                    shared["both"] = acct, transaction_totals(silver["transactions"], silver["accounts"]).checkpoint()
            return shared["both"]

        def write(k):
            start = _now()
            try:
                if k.kpi_name not in gold.MARTS:
                    raise ValueError(f"no builder for mart {k.kpi_name!r}")
                rows = self.store.write_snapshot("gold", k.kpi_name, gold.build(k.kpi_name, silver, totals), run_id)
                return k, rows, registry.audit_row(self.spark, run_id, "GOLD", kpi_id=k.kpi_id, start=start, end=_now(), records=rows)
            except Exception as e:
                return k, None, registry.audit_row(self.spark, run_id, "GOLD", kpi_id=k.kpi_id, start=start, end=_now(), status="FAILED", error=str(e))

        # The marts are independent: their jobs are submitted from parallel
        # driver threads, so that the cluster runs them side by side.
        with ThreadPoolExecutor(max_workers=max(1, min(self.gold_parallelism, len(kpis)))) as pool:
            results = list(pool.map(write, kpis))
        counts = {k.kpi_name: rows for k, rows, _ in results}
        audit = [row for _, _, row in results]
        if audit:
            self._audit_rows(audit)
        return counts

    def marts(self) -> dict[str, DataFrame]:
        return {n: self.store.read("gold", n) for n in gold.MARTS}

    # ----------------------------------------------------------- all
    def finish_run(self, run_id: int) -> None:
        """Record the run's end time and duration (upsert keyed on run_id)."""
        details = self.store.read(META, "run_execution_details")
        start = (details.where(F.col("run_id") == str(run_id)).agg(F.min("run_start")).collect()[0][0])
        end = _now()
        duration = int((end - start).total_seconds()) if start else None
        row = self.spark.createDataFrame([(str(run_id), start, end, duration)], schemas.RUN_EXECUTION_DETAILS)
        self.store.write_snapshot(META, "run_execution_details",
                                  merge_upsert(details, row, ["run_id"], keep_from_target=()))

    def run(self) -> int:
        self.seed()
        run_id = self.start_run()
        order = [r.table_id for r in registry.active_tables(self.control()["tables"]).collect()]
        for tid in order:
            self.bronze(tid, run_id)
            self.silver(tid, run_id)
        self.gold(run_id)
        self.finish_run(run_id)
        return run_id
