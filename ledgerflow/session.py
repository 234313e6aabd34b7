"""Session helpers.

Library code never assumes a particular session: every builder takes the
``SparkSession`` it is given.  ``build_session`` is for tests, the bench and
the command-line runner; it sets only what a local run needs and leaves
cluster-provided settings (``spark.checkpoint.dir`` above all) alone.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the plans this package builds.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime size check for broadcast: AQE turns a join into a broadcast
    # only when the *measured* build side is below this threshold; larger
    # sides stay sort-merge joins.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # checkpoints that no frame uses any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    app: str = "ledgerflow",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**PLAN_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, shared: str | None = None) -> str:
    """Return the checkpoint folder, preferring the one the session names.

    ``spark.checkpoint.dir`` (a shared folder on a cluster) is used as is.
    Only when it is unset: ``shared`` (a folder every executor can reach,
    e.g. the table store's root) is used; failing that, a local session
    (tests) gets a scratch folder, and a cluster session is refused rather
    than pointed at a machine-local path.  Spark adds a unique
    per-application subfolder itself.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if shared is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for checkpoints")
        shared = os.path.join(os.environ.get("LEDGERFLOW_SCRATCH") or tempfile.gettempdir(),
                              "ledgerflow-checkpoints")
    sc.setCheckpointDir(shared)
    return sc.getCheckpointDir() or shared
