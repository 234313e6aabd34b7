"""Pipeline and table-store state: runs, reruns, crashes, streams, JDBC."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerflow.functions.scalars import for_comparison
from ledgerflow.plans import gold
from ledgerflow.plans.pipeline import Pipeline
from ledgerflow.sources import testdata
from ledgerflow.sources.store import TableStore
from ledgerflow.streaming.csv_feed import csv_stream, land_stream, upsert_stream


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in for_comparison(df).collect())


def _make_pipeline(spark, root, landing):
    ents = testdata.silver_tables(spark, SF_SMALL)

    def relational(cfg):
        return ents[cfg.table_name]

    def blob(cfg):
        return csv_stream(spark, f"{landing}/{cfg.source_path}")

    store = TableStore(spark, root)
    return Pipeline(spark, store, {"oracledb": relational, "sqlserver": relational, "blob": blob},
                    run_ts="2025-01-01 00:00:00"), ents


def _land_csv(df, path):
    df.select([F.col(c).cast("string") for c in df.columns]).coalesce(1).write.mode("append") \
        .option("header", True).csv(path)


def test_full_run_then_idempotent_rerun(spark, scratch):
    landing = os.path.join(scratch, "landing")
    pipe, ents = _make_pipeline(spark, os.path.join(scratch, "store"), landing)
    _land_csv(ents["credit_bureau_reports"], f"{landing}/credit_bureau_reports/")
    _land_csv(ents["payment_gateway_logs"], f"{landing}/payment_gateway_logs/")

    run1 = pipe.run()
    marts = pipe.marts()
    for name in ("customer_360", "branch_performance", "transaction_channel_summary"):
        assert _rows(marts[name]) == _rows(gold.MARTS[name](ents)), name
    silver = pipe.silver_tables()
    assert silver["transactions"].count() == ents["transactions"].count()
    assert silver["credit_bureau_reports"].count() == ents["credit_bureau_reports"].select("customer_id").distinct().count()

    runs = pipe.store.read("metadata", "pipeline_runs").where(F.col("run_id") == run1)
    assert runs.where("status <> 'COMPLETED'").count() == 0
    assert runs.count() == 6 * 2 + 5  # bronze + silver per table, one row per mart
    marks = {r.table_id: r.last_watermark_value for r in pipe.store.read("metadata", "table_watermarks").collect()}
    assert marks[3] == str(ents["transactions"].agg(F.max("txn_timestamp")).collect()[0][0])

    details = {r.run_id: r for r in pipe.store.read("metadata", "run_execution_details").collect()}
    assert details[str(run1)].run_end is not None and details[str(run1)].run_duration is not None

    # Second run, no new source data: nothing new lands, gold unchanged.
    run2 = pipe.run()
    assert run2 == run1 + 1
    r2 = {(r.layer, r.table_id): r.number_of_records
          for r in pipe.store.read("metadata", "pipeline_runs").where(F.col("run_id") == run2).collect()}
    assert r2[("SILVER", 3)] == 0 and r2[("BRONZE", 5)] == 0 and r2[("BRONZE", 3)] == 0 and r2[("SILVER", 1)] == 0
    assert _rows(pipe.marts()["customer_360"]) == _rows(marts["customer_360"])


def test_crash_before_commit_keeps_old_version(spark, scratch):
    store = TableStore(spark, scratch)
    df = spark.range(5).withColumnRenamed("id", "k")
    store.write_snapshot("silver", "t", df, run_id=1)
    # a writer that dies after writing files but before its commit
    df.where("k < 2").write.mode("overwrite").parquet(f"{store.path('silver', 't')}/v=2")
    assert store.read("silver", "t").count() == 5
    # the retry reuses the uncommitted version number and then commits
    store.write_snapshot("silver", "t", df.where("k < 3"), run_id=2)
    assert store.read("silver", "t").count() == 3
    # the same for a load
    store.append("bronze", "t", df, run_id=1)
    df.write.parquet(f"{store.path('bronze', 't')}/load=2")
    assert store.read("bronze", "t").count() == 5
    store.append("bronze", "t", df.where("k < 2"), run_id=2)
    assert store.read("bronze", "t").count() == 7


def test_store_keeps_two_states(spark, scratch):
    store = TableStore(spark, scratch)
    for n in range(1, 6):
        before = store.read("gold", "t")
        assert store.write_snapshot("gold", "t", spark.range(n), run_id=n) == n
        assert before is None or before.count() == n - 1  # a frame of the last state can still be read
    assert sorted(os.listdir(f"{scratch}/gold/t")) == ["v=4", "v=5"]
    assert sorted(x for x in os.listdir(f"{scratch}/_state/gold/t") if not x.startswith(".")) == ["4", "5"]


def test_only_a_missing_folder_means_never_written(spark, scratch):
    store = TableStore(spark, scratch)
    assert store.state("silver", "t") is None and store.read("silver", "t") is None
    store.write_snapshot("silver", "t", spark.range(2))
    with open(f"{scratch}/_state/silver/t/2", "w") as f:
        f.write("{not json")
    with pytest.raises(ValueError):
        store.state("silver", "t")


def test_append_of_one_run_counts_once(spark, scratch):
    store = TableStore(spark, scratch)
    df = spark.range(4).withColumnRenamed("id", "k")
    assert [store.append("bronze", "t", df, run_id=7) for _ in range(2)] == [4, 4]
    assert store.read("bronze", "t").count() == 4
    store.append("bronze", "t", df, run_id=8)
    assert store.read("bronze", "t").count() == 8
    assert store.read("bronze", "t", after_load=1).count() == 4
    later = spark.createDataFrame([("x", 9)], "extra string, k long")
    store.append("bronze", "t", later, run_id=9)
    assert store.read("bronze", "t").columns == ["k", "extra"] and store.read("bronze", "t").where("extra = 'x' and k = 9").count() == 1
    with pytest.raises(ValueError, match="was bigint"):
        store.append("bronze", "t", spark.createDataFrame([("x",)], "k string"), run_id=10)


def test_empty_first_load_is_readable(spark, scratch):
    store = TableStore(spark, scratch)
    none = spark.createDataFrame([], "k long, v string")
    assert store.append("silver", "a", none, run_id=1) == 0 and store.write_snapshot("silver", "s", none) == 0
    for t in ("a", "s"):
        assert store.read("silver", t).schema.simpleString() == "struct<k:bigint,v:string>" and store.read("silver", t).count() == 0


def test_kinds_are_not_mixed(spark, scratch):
    store = TableStore(spark, scratch)
    store.append("bronze", "a", spark.range(3), run_id=1)
    store.write_snapshot("bronze", "s", spark.range(5))
    with pytest.raises(ValueError, match="append table"):
        store.write_snapshot("bronze", "a", spark.range(3))
    with pytest.raises(ValueError, match="snapshot table"):
        store.append("bronze", "s", spark.range(3), run_id=2)
    assert store.read("bronze", "a").count() == 3 and store.read("bronze", "s").count() == 5


LOGS = "txn_id string, gateway_name string"


def test_ordinary_load_then_stream_then_new_checkpoint(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "store"))
    store.append("bronze", "logs", spark.createDataFrame([("0", "z")], LOGS), run_id=1)
    taken = 0
    for n, (landing, ckpt) in enumerate([("in1", "c1"), ("in1", "c1"), ("in2", "c2")], start=2):
        _land_csv(spark.createDataFrame([(str(n), "a")], LOGS), os.path.join(scratch, landing))
        feed = csv_stream(spark, os.path.join(scratch, landing))
        taken += land_stream(store, "bronze", "logs", feed, ["TXN_ID", "GATEWAY_NAME"], n, os.path.join(scratch, ckpt))
    assert taken == 3
    assert sorted(r.txn_id for r in store.read("bronze", "logs").collect()) == ["0", "2", "3", "4"]


def test_replayed_micro_batch_is_stored_once(spark, scratch):
    store = TableStore(spark, scratch)
    df = spark.createDataFrame([("1", "a")], LOGS)
    assert store.append("bronze", "logs", df, 1, stream=("s", 0)) == 1
    assert store.append("bronze", "logs", df, 2, stream=("s", 0)) == 0
    assert store.append("bronze", "logs", df, 2, stream=("t", 0)) == 1
    assert store.append("bronze", "logs", df, 2, stream=("s", 1)) == 1
    assert store.read("bronze", "logs").count() == 3


def test_stream_count_covers_every_micro_batch(spark, scratch):
    """More micro-batches than Spark keeps progress entries of."""
    store = TableStore(spark, os.path.join(scratch, "store"))
    landing = os.path.join(scratch, "in")
    os.makedirs(landing)
    for i in range(8):
        with open(os.path.join(landing, f"{i}.csv"), "w") as f:
            f.write(f"txn_id,gateway_name\n{i},a\n{i},b\n")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        feed = csv_stream(spark, landing, max_files_per_trigger=1)
        n = land_stream(store, "bronze", "logs", feed, ["TXN_ID", "GATEWAY_NAME"], 1, os.path.join(scratch, "ckpt"))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert n == 16 == store.read("bronze", "logs").count()


def _feed_run(pipe, fail_silver=False):
    run = pipe.start_run()
    pipe.bronze(6, run)
    return None if fail_silver else pipe.silver(6, run)


def test_feed_rows_survive_a_failed_silver(spark, scratch):
    landing = os.path.join(scratch, "landing")
    pipe, ents = _make_pipeline(spark, os.path.join(scratch, "store"), landing)
    pipe.seed()
    logs = ents["payment_gateway_logs"]
    cut = logs.agg(F.expr("percentile_approx(processed_timestamp, 0.5)")).first()[0]
    _land_csv(logs.where(F.col("processed_timestamp") <= F.lit(cut)), f"{landing}/payment_gateway_logs/")
    _feed_run(pipe, fail_silver=True)
    _land_csv(logs.where(F.col("processed_timestamp") > F.lit(cut)), f"{landing}/payment_gateway_logs/")
    assert _feed_run(pipe) == logs.count()
    assert _feed_run(pipe) == 0
    assert _rows(pipe.silver_tables()["payment_gateway_logs"]) == _rows(logs)


def test_relational_rows_survive_a_failed_silver(spark, scratch):
    pipe, ents = _make_pipeline(spark, os.path.join(scratch, "store"), scratch)
    pipe.seed()
    whole = dict(ents)
    for tid, name, col in ((3, "transactions", "txn_timestamp"), (2, "accounts", "updated_at")):
        cut = whole[name].agg(F.max(col)).first()[0]
        ents[name] = whole[name].where(F.col(col) < F.lit(cut))
        run = pipe.start_run()
        pipe.bronze(tid, run)  # silver never comes
        ents[name] = whole[name]
        run = pipe.start_run()
        assert pipe.bronze(tid, run) == whole[name].where(F.col(col) == F.lit(cut)).count()
        pipe.silver(tid, run)
        pipe.silver(tid, run)
        columns = [c for c in whole[name].columns if (name, c) != ("transactions", "created_at")]  # not in the registry's list
        assert _rows(pipe.silver_tables()[name].select(columns)) == _rows(whole[name].select(columns)), name


def test_failure_between_silver_and_mark_repeats_nothing(spark, scratch, monkeypatch):
    pipe, ents = _make_pipeline(spark, os.path.join(scratch, "store"), scratch)
    pipe.seed()
    run = pipe.start_run()
    pipe.bronze(3, run)
    with monkeypatch.context() as m:
        def dies(*a, **k):
            raise RuntimeError("killed")

        m.setattr(pipe, "_audit", dies)
        with pytest.raises(RuntimeError):
            pipe.silver(3, run)
    run = pipe.start_run()
    pipe.bronze(3, run)
    assert pipe.silver(3, run) == 0
    assert pipe.silver_tables()["transactions"].count() == ents["transactions"].count()
    marks = {r.table_id: r.last_watermark_value for r in pipe.store.read("metadata", "table_watermarks").collect()}
    assert marks[3] == str(ents["transactions"].agg(F.max("txn_timestamp")).first()[0])


def test_empty_first_extract(spark, scratch):
    pipe, ents = _make_pipeline(spark, os.path.join(scratch, "store"), scratch)
    pipe.seed()
    whole = ents["transactions"]
    ents["transactions"] = whole.limit(0)
    run = pipe.start_run()
    assert pipe.bronze(3, run) == 0 and pipe.silver(3, run) == 0
    assert pipe.silver_tables()["transactions"].count() == 0
    ents["transactions"] = whole
    run = pipe.start_run()
    pipe.bronze(3, run)
    assert pipe.silver(3, run) == whole.count()


def test_merge_without_watermark_extracts_in_full(spark, scratch):
    pipe, ents = _make_pipeline(spark, os.path.join(scratch, "store"), scratch)
    pipe.seed()
    params = pipe.store.read("metadata", "table_parameters")
    pipe.store.write_snapshot("metadata", "table_parameters", params.where("not (table_id = 2 and parameter_name = 'watermark_column')"))
    whole = ents["accounts"]
    for batch in (whole.where("account_id % 2 = 0"), whole.withColumn("status", F.lit("NEW"))):
        ents["accounts"] = batch
        run = pipe.start_run()
        assert pipe.bronze(2, run) == batch.count()
        pipe.silver(2, run)
    assert _rows(pipe.silver_tables()["accounts"]) == _rows(whole.withColumn("status", F.lit("NEW")))


def test_merge_reads_the_source_once(spark, scratch):
    pipe, ents = _make_pipeline(spark, os.path.join(scratch, "store"), scratch)
    pipe.seed()
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    n = ents["accounts"].count()
    for _ in range(2):
        ents["accounts"] = ents["accounts"].mapInArrow(counted, ents["accounts"].schema).withColumn("updated_at", F.col("updated_at") + F.expr("interval 1 day"))
        before = read.value
        pipe.bronze(2, pipe.start_run())
        assert read.value - before in (n, 2 * n)  # each round's frame holds those before
    assert read.value == 3 * n


def test_gold_isolates_failures(spark, scratch):
    pipe, ents = _make_pipeline(spark, os.path.join(scratch, "store"), scratch)
    pipe.seed()
    run = pipe.start_run()
    for tid in (2, 3):  # customers, branches and credit reports are absent
        pipe.bronze(tid, run)
        pipe.silver(tid, run)
    counts = pipe.gold(run)
    audit = {r.kpi_id: (r.status, r.error_message) for r in pipe.store.read("metadata", "pipeline_runs").where("layer = 'GOLD'").collect()}
    assert audit[5][0] == "COMPLETED" and counts["transaction_channel_summary"] == 3
    assert [audit[i][0] for i in (1, 2, 3, 4)] == ["FAILED"] * 4 and all("does not exist" in audit[i][1] for i in (1, 2, 3, 4))
    assert _rows(pipe.marts()["transaction_channel_summary"]) == _rows(gold.transaction_channel_summary(ents))


def test_marts_are_written_from_threads(spark, scratch):
    store = TableStore(spark, scratch)
    threads = [threading.Thread(target=store.write_snapshot, args=("gold", f"t{i}", spark.range(i))) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [store.read("gold", f"t{i}").count() for i in range(4)] == [0, 1, 2, 3]


def test_csv_stream_exactly_once(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "store"))
    landing = os.path.join(scratch, "in")
    cols = ["TXN_ID", "GATEWAY_NAME"]
    first = spark.createDataFrame([("1", "a"), ("2", "b")], "txn_id string, gateway_name string")
    _land_csv(first, landing)
    ckpt = os.path.join(scratch, "ckpt")
    n1 = land_stream(store, "bronze", "logs", csv_stream(spark, landing), cols, 1, ckpt)
    n2 = land_stream(store, "bronze", "logs", csv_stream(spark, landing), cols, 2, ckpt)
    assert (n1, n2) == (2, 0)
    _land_csv(spark.createDataFrame([("3", "c")], "txn_id string, gateway_name string"), landing)
    n3 = land_stream(store, "bronze", "logs", csv_stream(spark, landing), cols, 3, ckpt)
    assert n3 == 1
    assert sorted(r.txn_id for r in store.read("bronze", "logs").collect()) == ["1", "2", "3"]


def test_stream_upsert_into_silver(spark, scratch):
    from ledgerflow.schemas import BRANCHES

    store = TableStore(spark, os.path.join(scratch, "store"))
    landing = os.path.join(scratch, "in")
    cols = [f.name for f in BRANCHES.fields]
    rows = [("BR1", "Main", "c", "s", "r", "2020-01-01 00:00:00"), ("BR2", "Side", "c", "s", "r", None)]
    schema = ", ".join(f"{c} string" for c in cols)
    _land_csv(spark.createDataFrame(rows, schema), landing)
    ckpt = os.path.join(scratch, "ckpt")
    upsert_stream(store, "silver", "branches", csv_stream(spark, landing), ["branch_code"], BRANCHES, ckpt)
    _land_csv(spark.createDataFrame([("BR2", "Renamed", "c", "s", "r", None)], schema), landing)
    upsert_stream(store, "silver", "branches", csv_stream(spark, landing), ["branch_code"], BRANCHES, ckpt)
    out = {r.branch_code: r.branch_name for r in store.read("silver", "branches").collect()}
    assert out == {"BR1": "Main", "BR2": "Renamed"}


def test_jdbc_partitioned_extract_pushes_predicate(spark):
    from ledgerflow.sources.jdbc import extract_incremental, jdbc_table

    url = "jdbc:derby:memory:ledgerflow_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    accounts = testdata.accounts(spark, SF_SMALL).select(
        "account_id", "customer_id", "balance", F.col("updated_at").cast("timestamp").alias("updated_at"))
    (accounts.write.format("jdbc").option("url", url).option("dbtable", "accounts")
     .option("driver", props["driver"]).mode("overwrite").save())
    src = jdbc_table(spark, url, "accounts", partition_column="account_id", num_partitions=4, properties=props)
    assert src.rdd.getNumPartitions() == 4
    mark = "1998-01-01 00:00:00"
    got = extract_incremental(src, ["ACCOUNT_ID", "BALANCE", "UPDATED_AT"], "updated_at", mark)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "updated_at" in plan.split("PushedFilters")[1][:200]
    expected = accounts.where(F.col("updated_at") > F.lit(mark).cast("timestamp")).count()
    assert got.count() == expected
    assert got.columns == ["account_id", "balance", "updated_at"]


def _logs_pipeline(spark, scratch, quarantine):
    from ledgerflow import schemas

    landing = os.path.join(scratch, "landing")
    store = TableStore(spark, os.path.join(scratch, "store"))
    pipe = Pipeline(spark, store, {"blob": lambda cfg: csv_stream(spark, f"{landing}/{cfg.source_path}")})
    pipe.seed()
    if quarantine:
        params = store.read("metadata", "table_parameters")
        extra = spark.createDataFrame([(6, "bad_rows", "quarantine", None)], schemas.TABLE_PARAMETERS)
        store.write_snapshot("metadata", "table_parameters", params.unionByName(extra))
    cols = [f.name for f in schemas.PAYMENT_GATEWAY_LOGS.fields]
    rows = [("1", "upi", "SUCCESS", "200", "15", "MOBILE", "IN", "2024-01-01 00:00:01"),
            ("2", "upi", "SUCCESS", "200", "abc", "MOBILE", "IN", "2024-01-01 00:00:02"),
            ("3", "upi", "FAILED", "500", "7", "MOBILE", "IN", "not a time")]
    _land_csv(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)),
              f"{landing}/payment_gateway_logs/")
    return pipe


def test_quarantine_splits_bad_rows(spark, scratch):
    pipe = _logs_pipeline(spark, scratch, quarantine=True)
    run = pipe.start_run()
    assert pipe.bronze(6, run) == 3
    assert pipe.silver(6, run) == 1
    rejects = {r.txn_id: r._reject for r in pipe.store.read("silver", "payment_gateway_logs_rejects").collect()}
    assert rejects == {"2": "processing_time_ms", "3": "processed_timestamp"}
    assert [r.txn_id for r in pipe.store.read("silver", "payment_gateway_logs").collect()] == [1]


def test_bad_rows_fail_fast_and_are_audited(spark, scratch):
    pipe = _logs_pipeline(spark, scratch, quarantine=False)
    run = pipe.start_run()
    pipe.bronze(6, run)
    with pytest.raises(Exception):
        pipe.silver(6, run)
    audit = pipe.store.read("metadata", "pipeline_runs").where("layer = 'SILVER'").collect()
    assert [a.status for a in audit] == ["FAILED"] and audit[0].error_message


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_headers_are_mapped_by_name_and_may_grow(spark, scratch):
    store = TableStore(spark, os.path.join(scratch, "store"))
    landing, ckpt, cols = os.path.join(scratch, "in"), os.path.join(scratch, "ckpt"), ["TXN_ID", "GATEWAY_NAME"]
    _write(f"{landing}/a.csv", "gateway_name,TXN_ID\nx,1\n")
    _write(f"{landing}/b.csv", 'txn_id,gateway_name,"fee"\n2,"a, b",5\n')
    assert land_stream(store, "bronze", "logs", csv_stream(spark, landing), cols, 1, ckpt) == 2
    _write(f"{landing}/c.csv", "txn_id\n3\n")
    _write(f"{landing}/d.csv", "txn_id,gateway_name\n")
    assert land_stream(store, "bronze", "logs", csv_stream(spark, landing), cols, 2, ckpt) == 1
    got = sorted((r.txn_id, r.gateway_name, r.fee) for r in store.read("bronze", "logs").collect())
    assert got == [("1", "x", None), ("2", "a, b", "5"), ("3", None, None)]


@pytest.mark.parametrize("text", ["other,names\nx,1\n", "txn_id,txn_id\n1,2\n", "txn_id,gateway_name\n1\n"])
def test_csv_that_does_not_fit_fails_loudly(spark, scratch, text):
    _write(f"{scratch}/in/a.csv", text)
    store = TableStore(spark, os.path.join(scratch, "store"))
    with pytest.raises(Exception):
        land_stream(store, "bronze", "logs", csv_stream(spark, f"{scratch}/in"), ["TXN_ID", "GATEWAY_NAME"], 1, f"{scratch}/ckpt")
    assert store.read("bronze", "logs") is None


def test_pipeline_reads_relational_source_over_jdbc(spark, scratch):
    from ledgerflow.sources.jdbc import jdbc_extractor

    url = "jdbc:derby:memory:ledgerflow_pipe;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    ents = testdata.silver_tables(spark, SF_SMALL)
    for name in ("customers", "accounts"):
        (ents[name].write.format("jdbc").option("url", url).option("dbtable", name)
         .option("driver", props["driver"]).mode("overwrite").save())
    store = TableStore(spark, scratch)
    ext = jdbc_extractor(spark, url, props, num_partitions=3)
    pipe = Pipeline(spark, store, {"oracledb": ext, "sqlserver": ext}, run_ts="2025-01-01 00:00:00")
    pipe.seed()
    run = pipe.start_run()
    for tid in (1, 2):
        pipe.bronze(tid, run)
        pipe.silver(tid, run)
    silver = pipe.silver_tables()
    for name in ("customers", "accounts"):
        assert _rows(silver[name]) == _rows(ents[name]), name


def _sizes(df):
    return [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]


def test_jdbc_splits_past_the_mark_and_by_text_keys(spark):
    from ledgerflow.plans.registry import TableConfig
    from ledgerflow.sources.jdbc import extract_incremental, jdbc_extractor

    url = "jdbc:derby:memory:ledgerflow_splits;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(1000).selectExpr("id as account_id", "concat('K', lpad(cast(id % 700 as string), 4, '0')) as code",
                                        "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, cast(id as int)) as updated_at")
    rows.write.format("jdbc").option("url", url).option("dbtable", "accounts").option("driver", props["driver"]).option(
        "createTableColumnTypes", "code VARCHAR(20)").mode("overwrite").save()
    mark = "2024-01-01 14:59:00"  # the last hundred rows have the highest keys

    def config(key, kind, wm):
        return TableConfig(2, "accounts", "sqlserver", ["ACCOUNT_ID", "CODE", "UPDATED_AT"], "accounts", None, "bronze", "silver", kind, key, wm, mark)

    extract = jdbc_extractor(spark, url, props, num_partitions=4)
    new = extract_incremental(extract(config("account_id", "APPEND", "updated_at")), ["account_id", "updated_at"], "updated_at", mark)
    assert sum(_sizes(new)) == 100 and len(_sizes(new)) == 4 and max(_sizes(new)) <= 30
    by_text = extract(config("code", "FULL", None))
    assert sum(_sizes(by_text)) == 1000 and len(_sizes(by_text)) == 4 and max(_sizes(by_text)) <= 300
    assert sorted(r[0] for r in by_text.select("account_id").collect()) == list(range(1000))


def test_report_prints_all_rows(spark, scratch, capsys, monkeypatch):
    from ledgerflow import __main__ as cli
    from ledgerflow import session

    monkeypatch.setattr(session, "build_session", lambda **k: spark)
    store = TableStore(spark, scratch)
    days = spark.range(120).selectExpr("date_add(date'2024-01-01', cast(id as int)) as txn_date", "cast(id as decimal(18,2)) as total_transaction_amount")
    for name in gold.MARTS:
        store.write_snapshot("gold", name, days)
    assert cli.main(["report", "--store", scratch, "report_daily_amount"]) == 0
    assert len(capsys.readouterr().out.split()) == 121
    assert cli.main(["report", "--store", scratch, "report_daily_amount", "--limit", "3"]) == 0
    assert len(capsys.readouterr().out.split()) == 4
    assert cli.main(["report", "--store", scratch, "report_daily_amount", "--out", f"{scratch}/out"]) == 0
    assert spark.read.option("header", True).csv(f"{scratch}/out").count() == 120
