"""WARC archives by way of a chunked record table.

Writing: a payload becomes rows (record identifier, chunk number); the first
chunk of a record is its WARC record, each further one a ``continuation``
record (WARC segmentation), so no row or record holds more than ``chunk_bytes``
of payload.  Spark's text writer puts the records one after the other, with the
CR LF CR LF that ends a record as line separator, into gzip files: each is a
WARC file, written by Spark's commit protocol to whatever store the path names.

Reading: a gzip file is one stream, since gzip can't be split.  The reader follows
Content-Length, gives a row for each chunk as it comes, and carries the
incremental SHA-256 of the payload so far.  Of a segmented record, as written
here, no more than a chunk is held; of another one no more than what stands
between two empty lines, which is the unit that Spark's text reader gives.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shared_dir, written

END = b"\r\n\r\n"
#: how a page's id is written in WARC-Record-ID
URN = "urn:page:"
CHUNKS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("chunk_no", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("declared_digest", T.StringType()),
        T.StructField("chunk", T.BinaryType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("digest_so_far", T.StringType()),
        T.StructField("last_chunk", T.BooleanType()),
    ]
)


def with_duplicates(pages: DataFrame, id_col: str, uri_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """``(id, uri, payload, bytes, digest, first)`` of the pages; first is the id to refer to, else null."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload")).withColumns(
        {"bytes": F.length("payload").cast("long"), "digest": F.sha2("payload", 256)}
    )
    firsts = rows.where(F.col("bytes") >= min_bytes).groupBy(F.col("digest").alias("equal")).agg(F.min("id").alias("first"), F.count("*").alias("n"))
    joined = rows.join(firsts.where("n > 1").drop("n"), F.col("digest") == F.col("equal"), "left").drop("equal")
    return joined.withColumn("first", F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first")))


def _field(name: str, value: Column) -> Column:
    """A header line; null where the value is."""
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _urn(id_text: Column) -> Column:
    return F.concat(F.lit(f"<{URN}"), F.coalesce(id_text, F.lit("")), F.lit(">"))


def _clean(uri: Column) -> Column:
    """A URI can't break a header line: control characters and blanks are percent-encoded."""
    parts = F.regexp_extract_all(uri, F.lit(r"(?s)[\x00-\x20\x7F]|[^\x00-\x20\x7F]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike(r"^[\x00-\x20\x7F]"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(x)), 2, "0"))).otherwise(x)), "")


def records(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", chunk_bytes: int = 1 << 20, min_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """``value``: the WARC records of the pages, chunk by chunk in order, without the CR LF CR LF after each.

    Of equal payloads of at least ``min_bytes`` bytes those with the smallest
    id are responses, the others ``revisit`` records without a payload; smaller
    ones are all responses.  A null payload is empty; a null URI is left out.
    Rows with a null id have an empty id and are never referred to.
    """
    rows = with_duplicates(pages, id_col, uri_col, payload_col, min_bytes)
    revisit = F.col("first").isNotNull()
    chunks = F.greatest(F.lit(1), F.ceil(F.col("bytes") / chunk_bytes)).cast("int")
    rows = rows.withColumn("chunks", F.when(revisit, 1).otherwise(chunks))
    rows = rows.withColumn("no", F.explode(F.sequence(F.lit(1), F.col("chunks"))))
    payload = F.when(revisit, F.lit(b"")).otherwise(F.substring("payload", (F.col("no") - 1) * chunk_bytes + 1, F.lit(chunk_bytes)))
    head, more = F.col("no") == 1, F.col("chunks") > 1
    http = F.when(head, F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _field("Content-Length", F.col("bytes").cast("string")), F.lit("\r\n"))).otherwise("")
    none = F.lit("")
    record_id = _urn(F.col("id").cast("string"))
    segment = F.concat(F.lit(f"<{URN}"), F.coalesce(F.col("id").cast("string"), none), F.lit("/"), F.col("no").cast("string"), F.lit(">"))
    lines = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(~head, "continuation").when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", F.when(head, record_id).otherwise(segment)),
        _field("WARC-Date", F.lit(date)),
        F.when(head, F.coalesce(_field("WARC-Target-URI", _clean(F.col("uri"))), none)).otherwise(none),
        F.when(head, _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest"))).otherwise(none),
        F.when(revisit, F.concat(_field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), _field("WARC-Refers-To", _urn(F.col("first").cast("string"))))).otherwise(none),
        F.when(more, _field("WARC-Segment-Number", F.col("no").cast("string"))).otherwise(none),
        F.when(~head, _field("WARC-Segment-Origin-ID", record_id)).otherwise(none),
        F.when(more & (F.col("no") == F.col("chunks")), _field("WARC-Segment-Total-Length", F.col("bytes").cast("string"))).otherwise(none),
        F.when(head, "Content-Type: application/http;msgtype=response\r\n").otherwise(none),
        _field("Content-Length", (F.length(http) + F.length(payload)).cast("string")),
        F.lit("\r\n"),
        http,
    )
    return rows.select(F.concat(lines.cast("binary"), payload).cast("string").alias("value"))


def write_archives(pages: DataFrame, path: str, **options) -> None:
    """The records of ``pages`` as gzip WARC files in the folder ``path``."""
    records(pages, **options).write.option("lineSep", END.decode()).option("compression", "gzip").text(path)


class _Reader:
    """Chunks from the bytes of one file, fed piece by piece."""

    def __init__(self, chunk_bytes: int) -> None:
        self.most = chunk_bytes
        self.buffer, self.block = bytearray(), bytearray()
        self.state, self.left, self.http = "header", 0, False
        self.head: dict[str, str] = {}
        self.record: dict = {}

    def feed(self, piece: bytes) -> Iterator[dict]:
        """piece: what stood before the next CR LF CR LF, which is a border of
        the file's lines but not always one of its records."""
        self.buffer += piece
        self.buffer += END
        while True:
            if self.state == "header":
                if (at := self.buffer.find(END)) < 0:
                    return
                self._begin(bytes(self.buffer[:at]))
                del self.buffer[: at + len(END)]
                self.state = "block"
            elif self.state == "block":
                if self.http:  # the HTTP header ends at its first empty line
                    if (at := self.buffer.find(END)) < 0:
                        return
                    self._take(at + len(END))
                    self.http = False
                self.block += self._take(min(self.left, len(self.buffer)))
                while len(self.block) > self.most:
                    yield self._chunk(self.most, False)
                if self.left:
                    return
                whole = "WARC-Segment-Number" not in self.head or "WARC-Segment-Total-Length" in self.head
                yield self._chunk(len(self.block), whole)
                self.state = "end"
            else:
                if len(self.buffer) < len(END):
                    return
                if not self.buffer.startswith(END):
                    raise ValueError(f"a record is longer than its Content-Length: {self.head}")
                del self.buffer[: len(END)]
                self.state = "header"

    def close(self) -> None:
        """At the file's end: raises if a record isn't complete."""
        if self.state != "header" or self.record and not self.done:
            raise ValueError(f"the file ends inside a record: {self.head}")

    def _take(self, n: int) -> bytes:
        if n > self.left:
            raise ValueError(f"a record is shorter than its HTTP header: {self.head}")
        data = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.left -= n
        return data

    def _begin(self, piece: bytes) -> None:
        first, *lines = piece.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC header: {piece[:80]!r}")
        self.head = dict(line.split(": ", 1) for line in lines)
        self.left, kind = int(self.head["Content-Length"]), self.head["WARC-Type"]
        self.http = "application/http" in self.head.get("Content-Type", "")
        if kind != "continuation":
            refers = self.head.get("WARC-Refers-To", "")
            self.record = {
                "record_id": self.head["WARC-Record-ID"].strip("<>").removeprefix(URN),
                "record_type": kind,
                "target_uri": self.head.get("WARC-Target-URI"),
                "refers_to": refers.strip("<>").removeprefix(URN) or None,
                "declared_digest": self.head.get("WARC-Payload-Digest", "").removeprefix("sha256:"),
            }
            self.digest, self.total, self.number = hashlib.sha256(), 0, 0
        elif self.head["WARC-Segment-Origin-ID"].strip("<>").removeprefix(URN) != self.record.get("record_id"):
            raise ValueError(f"a segment without its record: {self.head}")

    def _chunk(self, n: int, last: bool) -> dict:
        data = bytes(self.block[:n])
        del self.block[:n]
        self.digest.update(data)
        self.total += len(data)
        self.number += 1
        self.done = last
        return self.record | {"chunk_no": self.number, "chunk": data, "payload_bytes": self.total, "digest_so_far": self.digest.hexdigest(), "last_chunk": last}


def read_archives(spark: SparkSession, path: str, chunk_bytes: int = 1 << 20) -> DataFrame:
    """The chunks of all records in the folder's archives (schema ``CHUNKS``).

    payload_bytes and digest_so_far cover the payload up to and with the chunk;
    on the row with ``last_chunk`` they are the whole payload's.  A revisit has
    one empty chunk; declared_digest is its payload's.  No archives give no
    rows; a damaged record raises.  Other writers' archives must be gzip files,
    which Spark reads as a whole: an uncompressed one may be split in a record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, reader, at = [], 0, _Reader(chunk_bytes), None
        for batch in batches:
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                if (name := name.as_py()) != at:
                    reader.close()
                    reader, at = _Reader(chunk_bytes), name
                for row in reader.feed(value.as_py()):
                    rows.append(row)
                    held += len(row["chunk"]) + 512
                    if held >= 4 * chunk_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        reader.close()
        yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary(), T.BooleanType(): pa.bool_()}
    schema = pa.schema([(f.name, kinds[f.dataType]) for f in CHUNKS])
    lines = spark.read.schema("value string").option("lineSep", END.decode()).text(path)
    return lines.select(F.col("_metadata.file_path"), F.col("value").cast("binary").alias("value")).mapInArrow(run, CHUNKS)


def resolved(chunks: DataFrame) -> DataFrame:
    """A row for each record: record_id, record_type, target_uri, refers_to,
    payload_bytes, payload_digest; a revisit has those of the response with the
    id that it refers to and its digest.

    Records that share an id are kept one by one.  A revisit whose response
    isn't there has null payload_bytes and payload_digest.  An empty id, which a
    null one is written as, is null.  A payload whose digest isn't the declared
    one raises.  No records give no rows.
    """
    ends = written(chunks.where("last_chunk").drop("chunk", "last_chunk"), "warc-records")
    agree = F.col("digest_so_far") == F.col("declared_digest")
    responses = ends.where("record_type = 'response'").withColumn(
        "payload_digest", F.when(agree, F.col("digest_so_far")).otherwise(F.raise_error(F.concat(F.lit("damaged payload: "), "record_id")))
    )
    origin = responses.groupBy(F.col("record_id").alias("origin"), F.col("payload_digest").alias("found")).agg(F.max("payload_bytes").alias("n"))
    same = (F.col("refers_to") == F.col("origin")) & (F.col("declared_digest") == F.col("found"))
    revisits = ends.where("record_type = 'revisit'").join(origin, same, "left").withColumns({"payload_bytes": F.col("n"), "payload_digest": F.col("found")})
    names = [F.nullif("record_id", F.lit("")).alias("record_id"), "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest"]
    return responses.select(names).unionByName(revisits.select(names))


def round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Writes the archives (into a new folder of the shared one by default) and gives ``read_archives`` of them."""
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, **options)
    return read_archives(spark, path)
