"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zlib

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: the white space between words of the ``[^\x20\x09-\x0D]+`` kind
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A session without one gets a temporary folder, on a local master only; on
    a cluster that folder would be on one machine, so it is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again.

    Cuts the lineage: what was computed is not computed again, also when an
    executor is lost.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


def sent(spark: SparkSession, value) -> Broadcast:
    """A broadcast of ``value`` that brings the code of its class along; tasks call ``pickle.loads`` on it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores behind those that ``df`` has a column of (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def words_of(text: Column) -> Column:
    """The words ``[^\x20\x09-\x0D]+`` of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, also where ``body``
    uses it in a lambda function."""
    return F.transform(F.array(value), body)[0]


def smallest_hashes(rows: DataFrame, col: str, n: int, total: int) -> DataFrame:
    """The ``n`` rows (fewer only if there are fewer) of the smallest hashes of ``col``, in that order.

    total: about how many rows there are.  A bound that twice as many rows are
    expected under is applied first, so that the task that orders what all
    others found doesn't gather n rows from each.
    """
    h = F.xxhash64(col)
    if total > 4 * n:
        rows = rows.where(h < F.lit(-(2**63) + 2**64 * 2 * n // total))
    return rows.orderBy(h, col).limit(n)


def crc32_mod(doc_id: Column, n: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def crc32_of(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())
