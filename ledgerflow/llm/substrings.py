"""Substring dedup by sliding sentence spans.

A text's pieces are its sentences; a long sentence is cut further after words
that a checksum picks, so that a passage that was put into the middle of other
text has the same pieces inside, wherever it stands.  A span is a run of
consecutive pieces with enough words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, written

#: up to and with a run of ends (and the blanks after it), or the rest of the text
SENTENCE = re.compile(rb"[^.!?\n]*[.!?\n]+[\x20\x09-\x0D]*|[^.!?\n]+")
_WORD = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
#: a span key that holds more than one of so many spans is spread
HOT_SHARE = 2000
SPREAD = 64


class Pieces:
    """Cuts texts into pieces; remembers up to ``most`` words."""

    def __init__(self, long_sentence: int, most: int = 200_000) -> None:
        self.long_sentence, self.most = long_sentence, most
        self.ends: dict[bytes, bool] = {}

    def _cuts_after(self, word: bytes) -> bool:
        if (found := self.ends.get(word)) is None:
            if len(self.ends) >= self.most:
                self.ends.clear()
            found = self.ends[word] = hashlib.md5(word).digest()[0] < 0x20  # one word in eight
        return found

    def __call__(self, raw: bytes) -> list[tuple[bytes, list[bytes]]]:
        """The pieces with their words, in order; joined they are the text."""
        out = []
        for sentence in SENTENCE.findall(raw):
            words = sentence.split()
            if len(words) <= self.long_sentence:
                out.append((sentence, words))
                continue
            start, parts = 0, _WORD.findall(sentence)
            for k, word in enumerate(words, 1):
                if k == len(words) or self._cuts_after(word):
                    out.append((b"".join(parts[start:k]), words[start:k]))
                    start = k
        return out


def spans_of(pieces: list[tuple[bytes, list[bytes]]], min_words: int) -> Iterator[tuple[int, int, bytes]]:
    """``(pos, size, digest)``: from each piece with words on, the shortest run of
    pieces that has ``min_words`` words, where there is one; equal words have an equal digest."""
    import xxhash

    normal = [b" ".join(words) for _, words in pieces]
    sizes = [len(words) for _, words in pieces]
    end = total = 0
    for i, n in enumerate(sizes):
        if n == 0:
            continue
        while end < len(sizes) and total < min_words:
            total += sizes[end]
            end += 1
        if total < min_words:
            return
        yield i, end - i, xxhash.xxh3_128_digest(b" ".join(normal[i:end]))
        total -= n


def _spans(docs: DataFrame, id_col: str, text_col: str, min_words: int, long_sentence: int) -> DataFrame:
    """``(id, text_hash, pos, size, h1, h2)`` of every span of every row."""
    columns = [("id", docs.schema[id_col].dataType), ("text_hash", T.LongType()), ("pos", T.IntegerType()), ("size", T.IntegerType()), ("h1", T.LongType()), ("h2", T.IntegerType())]
    schema = T.StructType([T.StructField(*c) for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        cut = Pieces(long_sentence)

        def out(batch: pa.RecordBatch, rows: list[int], pos: list[int], size: list[int], digests: list[bytes]) -> pa.RecordBatch:
            hashes = np.frombuffer(b"".join(digests), np.dtype([("h1", "<i8"), ("h2", "<i4"), ("rest", "<i4")]))
            taken = pa.array(rows, pa.int32())
            arrays = [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(pos, pa.int32()), pa.array(size, pa.int32()), pa.array(hashes["h1"].copy()), pa.array(hashes["h2"].copy())]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            held: tuple[list, list, list, list] = ([], [], [], [])
            for row, raw in enumerate(batch.column(2).cast(pa.binary())):
                for found in spans_of(cut(raw.as_py() or b""), min_words):
                    for column, value in zip(held, (row, *found), strict=True):
                        column.append(value)
                if len(held[0]) > 200_000:
                    yield out(batch, *held)
                    held = ([], [], [], [])
            yield out(batch, *held)

    return docs.select(F.col(id_col), F.xxhash64(text_col), F.col(text_col)).mapInArrow(run, schema)


def repeated_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20, long_sentence: int = 16) -> DataFrame:
    """``(id, text_hash, removed)``: the places of the pieces of a document that a
    non-first repeated span covers; documents without any are left out.

    Spans are equal if their words are (by 96 hash bits), whatever the blanks
    between them.  The first of equal spans is the one with the smallest (id,
    hash of the text, place).  Rows of equal id and text are one document.  A
    null id comes first.  A text of fewer than ``min_words`` words has no span.

    Spans are dealt by their hash, those of a hot hash (by a look at the spans
    of one document in 64, which decides nothing else) to 64 groups first,
    whose first spans are then compared.
    """
    columns = docs.select(id_col, text_col)
    looked = _spans(columns.where(F.pmod(F.xxhash64(id_col, text_col), F.lit(SPREAD)) == 0), id_col, text_col, min_words, long_sentence)
    counts = written(looked.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 10"), "span-counts")
    bound = (counts.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE
    hot = counts.where(F.col("n") > F.lit(bound)).select("h1", "h2", F.lit(SPREAD).alias("spread"))  # fewer than HOT_SHARE rows
    place = F.struct("id", "text_hash", "pos")
    spans = _spans(columns, id_col, text_col, min_words, long_sentence).join(F.broadcast(hot), ["h1", "h2"], "left")
    salt = F.pmod(F.xxhash64("id", "text_hash"), F.coalesce("spread", F.lit(1)))
    ranked = spans.withColumn("salt", salt.cast("int")).withColumn("rank", F.rank().over(Window.partitionBy("h1", "h2", "salt").orderBy("id", "text_hash", "pos")))
    found = written(ranked.where("rank > 1 OR spread IS NOT NULL").select("id", "text_hash", "pos", "size", F.when((F.col("rank") == 1) & F.col("spread").isNotNull(), F.struct("h1", "h2")).alias("key")), "repeated-spans")
    # the first span of each of a hot hash's groups; all others are repeats
    first = found.where("key IS NOT NULL").groupBy("key").agg(F.min(place).alias("first"))
    later = found.where("key IS NULL").select("id", "text_hash", "pos", "size").unionByName(
        found.where("key IS NOT NULL").join(F.broadcast(first), "key").where(~place.eqNullSafe(F.col("first"))).select("id", "text_hash", "pos", "size")
    )
    covered = later.groupBy("id", "text_hash").agg(F.collect_set(F.struct("pos", "size")).alias("spans"))
    removed = F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda x: F.sequence(x["pos"], x["pos"] + x["size"] - 1)))))
    return covered.select(F.col("id").alias(id_col), "text_hash", removed.alias("removed"))


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 20, long_sentence: int = 16, counts: bool = False) -> DataFrame:
    """``docs`` with the repeated pieces cut out of their texts; all rows and columns stay.

    counts: adds n_sentences (the pieces) and n_removed, under names that the
    table lacks.  A null text stays null; a text of which nothing is left is
    empty; an empty table gives no rows.  See ``repeated_pieces``.
    """
    key, hashed, gone = free_names(docs, "gone_id", "gone_hash", "gone")
    added = free_names(docs, "n_sentences", "n_removed") if counts else []
    found = repeated_pieces(docs, id_col, text_col, min_words, long_sentence).select(F.col(id_col).alias(key), F.col("text_hash").alias(hashed), F.col("removed").alias(gone))
    joined = docs.join(found, docs[id_col].eqNullSafe(F.col(key)) & (F.xxhash64(docs[text_col]) == F.col(hashed)), "left").select(*[docs[c] for c in docs.columns], gone)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(x, T.IntegerType()) for x in added]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Pieces(long_sentence)
        for batch in batches:
            texts, n_pieces, n_removed = [], [], []
            for raw, removed in zip(batch.column(at).cast(pa.binary()), batch.column(len(batch.columns) - 1), strict=True):
                text, places = raw.as_py(), removed.as_py() or ()
                pieces = cut(text or b"") if added or places else []
                if places:
                    without = set(places)
                    text = b"".join([p for i, (p, _) in enumerate(pieces) if i not in without])
                texts.append(text)
                n_pieces.append(len(pieces))
                n_removed.append(len(places))
            arrays = [pa.array(texts, pa.binary()).cast(c.type) if i == at else c for i, c in enumerate(batch.columns[:-1])]
            arrays += [pa.array(n_pieces, pa.int32()), pa.array(n_removed, pa.int32())] if added else []
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return joined.mapInArrow(run, schema)
