"""Benchmark decontamination by a broadcast set of normalised test n-grams.

The windows of the benchmark are broadcast as sorted hash arrays, in blocks of a
checked size: one block in one map stage; of several, each is built, sent and
released before the next, with the findings written between.  Nothing is
shuffled.  A window whose hash is found is verified by its words.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, sent, written

#: bytes: A-Z to a-z, and all but 0-9, a-z and \x80-\xFF to a blank
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: of the polynomial that makes a window's hash of its words'
_BASE = 0x9E3779B97F4A7C15
_SPAN = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("stop", T.LongType())]))
_FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", _SPAN), T.StructField("items", T.ArrayType(T.StringType()))])


def words_of(raw: bytes | None) -> list[bytes]:
    """The words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased (A-Z) UTF-8 text."""
    return (raw or b"").translate(WORD_BYTES).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of ``size`` words, from those of the words."""
    out = hashes[size - 1 :].copy()
    for k in range(size - 1):
        out += hashes[k : len(hashes) - size + 1 + k] * np.uint64(pow(_BASE, size - 1 - k, 1 << 64))
    return out


class Windows:
    """The windows of a block of benchmark texts, as arrays.

    For each window length: the windows' hashes in order, the place of each
    among the block's words, and its item.  The words themselves are one byte
    string with the places where they begin, to verify a hit by; about
    thirty bytes a word in all.
    """

    def __init__(self, items: list[tuple[str, bytes]], n: int) -> None:
        self.names = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.names)}
        parts, begins, at, count = [], [], 0, 0
        found: dict[int, list[tuple[np.ndarray, int, int]]] = {}
        for name, raw in items:
            words = words_of(raw)
            if not words:
                continue
            hashes = word_hashes(words)
            size = min(n, len(words))
            found.setdefault(size, []).append((window_hashes(hashes, size), count, place[name]))
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            begins.append((at + np.cumsum(lengths) - lengths).astype(np.uint32))
            parts.append(b" ".join(words) + b" ")
            at += len(parts[-1])
            count += len(words)
        self.text = b"".join(parts)
        self.begins = np.append(np.concatenate(begins), np.uint32(at)) if begins else np.zeros(1, np.uint32)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        while found:
            size, of = found.popitem()
            hashes = np.concatenate([h for h, _, _ in of])
            places = np.concatenate([np.arange(first, first + len(h), dtype=np.uint32) for h, first, _ in of])
            owner = np.repeat(np.array([i for _, _, i in of], np.uint32), [len(h) for h, _, _ in of])
            order = np.lexsort((owner, hashes))
            hashes, places, owner = hashes[order], places[order], owner[order]
            # a window that comes again in its item is kept once, unless other words share its hash
            again = np.append(False, (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]))
            for i in np.flatnonzero(again).tolist():
                again[i] = self._words(places[i], size) == self._words(places[i - 1], size)
            self.by_length[size] = hashes[~again], places[~again], owner[~again]
        # one byte for each value of a hash's last bits, which most windows of a text miss
        self.bits = max(10, min(22, 3 + count.bit_length()))
        self.seen = np.zeros(1 << self.bits, bool)
        for hashes, _, _ in self.by_length.values():
            self.seen[self._slot(hashes)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def _words(self, place: int, size: int) -> bytes:
        return self.text[self.begins[place] : self.begins[int(place) + size] - 1]

    def scan(self, raw: bytes | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """The number of words, the hit spans (merged) and the names of the items found."""
        words = words_of(raw)
        hashes = word_hashes(words)
        starts: list[tuple[int, int]] = []
        found: set[int] = set()
        for size, (windows, places, owner) in self.by_length.items():
            if len(words) < size:
                continue
            own = window_hashes(hashes, size)
            for i in np.flatnonzero(self.seen[self._slot(own)]).tolist():
                first = int(np.searchsorted(windows, own[i]))
                while first < len(windows) and windows[first] == own[i]:
                    if self._words(places[first], size) == b" ".join(words[i : i + size]):
                        found.add(int(owner[first]))
                        if not starts or starts[-1] != (i, i + size):
                            starts.append((i, i + size))
                    first += 1
        return len(words), _joined(starts), [self.names[i] for i in sorted(found)]


def _joined(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that meet as one."""
    out: list[tuple[int, int]] = []
    for begin, stop in sorted(found):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((begin, stop))
    return out


def benchmark_pieces(benchmark: DataFrame, id_col: str, text_col: str, n: int, piece_bytes: int) -> DataFrame:
    """``(name, piece, raw, size)``: the items' words, joined by one blank; an item of
    more than ``piece_bytes`` in pieces that share n - 1 words, so that no window is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0), batch.column(1), strict=True):
                words = words_of(raw.as_py())
                names, numbers, pieces, first = [], [], [], 0
                while first < len(words):
                    end, size = first, 0
                    while end < len(words) and (size < piece_bytes or end - first < 2 * n):
                        size += len(words[end]) + 1
                        end += 1
                    names.append(name.as_py())
                    numbers.append(len(pieces))
                    pieces.append(b" ".join(words[first:end]))
                    first = end if end == len(words) else end - n + 1
                    if end == len(words):
                        break
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(numbers, pa.int64()), pa.array(pieces, pa.binary()), pa.array([len(p) for p in pieces], pa.int64())], names=["name", "piece", "raw", "size"])

    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.col(text_col).cast("binary").alias("raw")).where("raw is not null")
    return rows.mapInArrow(run, "name string, piece long, raw binary, size long")


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, n: int, block_bytes: int) -> Iterator[Windows]:
    """The benchmark's windows in blocks of at most ``block_bytes`` of text, built one at a time.

    One block if the whole fits; else pieces are dealt by a hash of their name
    and number into as many blocks as it takes until the largest fits.
    """
    pieces = benchmark_pieces(benchmark, id_col, text_col, n, max(1, block_bytes // 8))
    total = pieces.agg(F.sum("size")).first()[0]
    if not total:
        yield Windows([], n)
        return
    blocks = -(-total // block_bytes)
    if blocks > 1:
        pieces = written(pieces, "benchmark-pieces")
        while True:
            dealt = F.pmod(F.xxhash64("name", "piece"), F.lit(blocks))
            largest = pieces.groupBy(dealt.alias("block")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).agg(F.max(F.when(F.col("n") > 1, F.col("size")))).first()[0]
            if not largest or largest <= block_bytes or blocks > 64 * -(-total // block_bytes):
                break
            blocks *= 2
        pieces = pieces.withColumn("block", dealt)
    for k in range(blocks):
        rows = (pieces.where(F.col("block") == k) if blocks > 1 else pieces).collect()
        if rows:
            yield Windows([(r["name"], bytes(r["raw"])) for r in rows], n)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    n: int = 10,
    block_bytes: int = 16 << 20,
    into: str = "found",
) -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, spans of hit words
    (begin, stop), and the names of the items found (sorted as strings).

    A window is ``n`` consecutive words of an item, or all words of a shorter
    one; null and wordless texts, of items and of documents, have none.  A
    null item id is the empty name; items that share an id count once.  All
    columns and rows stay, repeated rows too.
    """
    spark = docs.sparkSession
    (into,) = free_names(docs, into)
    schema = T.StructType([*docs.schema.fields, T.StructField(into, _FOUND)])
    at, out, shared = docs.columns.index(text_col), docs.withColumn(into, F.lit(None).cast(_FOUND)), None
    for block in benchmark_blocks(benchmark, item_col, item_text, n, block_bytes):
        if shared is not None:  # the block before has been scanned when the next one is sent
            out = written(out, "contamination")
            shared.destroy()
        shared = sent(spark, block)
        del block

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            windows = pickle.loads(shared.value)
            for batch in batches:
                found = []
                for raw, old in zip(batch.column(at).cast(pa.binary()), batch.column(-1), strict=True):
                    n_words, spans, items = windows.scan(raw.as_py())
                    if (old := old.as_py()) is not None:
                        spans, items = _joined([(x["begin"], x["stop"]) for x in old["spans"]] + spans), sorted({*old["items"], *items})
                    found.append({"n_words": n_words, "spans": [{"begin": b, "stop": s} for b, s in spans], "items": items})
                new = pa.array(found, pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))), ("items", pa.list_(pa.string()))]))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], new], names=schema.names)

        out = out.mapInArrow(run, schema)
    return out


def hit_words(found: Column) -> Column:
    """The number of words inside the spans of ``contamination``'s column."""
    return F.aggregate(found["spans"], F.lit(0).cast("long"), lambda total, x: total + x["stop"] - x["begin"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with
    the hit words, and what stands between them, cut out of the texts.

    A clean document, null texts included, stays as it is.
    """
    marked = contamination(docs, benchmark, text_col, into="found", **options)
    into = marked.columns[-1]
    clean = F.size(marked[into]["spans"]) == 0
    if remove == "documents":
        return marked.where(clean).drop(into)
    if remove != "spans":
        raise ValueError("remove: documents or spans")
    word = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    # pieces: a word and what follows it; the first also has what stands before
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(rf"(?s)^[^0-9A-Za-z\x{{80}}-\x{{10FFFF}}]*{word}[^0-9A-Za-z\x{{80}}-\x{{10FFFF}}]*|{word}[^0-9A-Za-z\x{{80}}-\x{{10FFFF}}]*"), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.exists(marked[into]["spans"], lambda s: (s["begin"] <= i) & (i < s["stop"])))
    return marked.withColumn(text_col, F.when(clean, F.col(text_col)).otherwise(F.array_join(kept, ""))).drop(into)
