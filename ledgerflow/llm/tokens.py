"""Token counts by a map-side two-tier lookup of pre-token lengths.

A first pass keeps, in each task, a bounded summary of the most frequent
pre-tokens (Misra-Gries, over all texts); the summaries, not the pre-tokens,
are summed by one small shuffle.  The ``table_entries`` most frequent ones are
encoded once and broadcast as a hash table from pre-token to its number of
tokens.  The second pass looks every pre-token up there, then in the worker's
own cache; only what neither has is encoded.  The tables are caches: results
don't depend on what they hold.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: longer pre-tokens are encoded each time; with the entry counts this bounds the tables
KEY_CHARS = 48
#: a run of blanks and the word after it, or a line feed and the rest of its word
PRE_TOKEN = re.compile(r" +[^ \n]*|\n[^ \n]*")


class Encoder:
    """Token counts of pre-tokens for a SentencePiece model without a
    normaliser, as its library would give them inside a text.

    Exact if no piece has a character before a blank, and none a line feed:
    no merge then crosses a pre-token's border.  ``__init__`` checks both.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        if any("\n" in p or re.search("[^▁]▁", p) for p in pieces) or self.model.encode(" a  b ", out_type=str)[0] != "▁":
            raise ValueError(f"{path}: pre-tokens can't be encoded on their own")

    @staticmethod
    def split(text: str) -> list[str]:
        """The pre-tokens; the blank before a text stands for the prefix that the library adds."""
        return PRE_TOKEN.findall(" " + text.replace("▁", " ")) if text else []

    def lengths(self, pre_tokens: list[str]) -> list[int]:
        """The library adds a blank: it stands for the first blank, or, before a
        line feed, is a token of its own."""
        found = self.model.encode([p[1:] if p[0] == " " else p for p in pre_tokens], num_threads=1)
        # a lone blank is the prefix of an empty rest, for which the library gives no token
        return [len(ids) - (p[0] == "\n") if p != " " else 1 for p, ids in zip(pre_tokens, found, strict=True)]


def _pruned(counts: Counter, most: int) -> Counter:
    """The most frequent, each less the first count that is left out: so much it may be short."""
    if len(counts) <= most:
        return counts
    ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    less = ranked[most][1]
    return Counter({k: n - less for k, n in ranked[:most] if n > less})


def frequent_pre_tokens(docs: DataFrame, text_col: str, task_entries: int) -> DataFrame:
    """``(pre_token, n)``: summed summaries; n is at most ``texts' pre-tokens / task_entries`` too low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(p for p in Encoder.split(text.as_py() or "") if len(p) <= KEY_CHARS)
                if len(held) > 16 * task_entries:
                    held = _pruned(held, 4 * task_entries)
        held = _pruned(held, task_entries)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["pre_token", "n"])

    return docs.select(text_col).mapInArrow(run, "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, entries: int) -> list[str]:
    """At most ``entries`` pre-tokens: all above a count that a small histogram
    gives, so that no task orders the candidates of all others."""
    step = F.floor(8 * F.log2("n")).alias("step")
    least, total = None, 0
    for row in counted.groupBy(step).count().orderBy(F.desc("step")).collect():  # 8 a power of two
        total += row["count"]
        if total > entries:
            break
        least = row["step"]
    if least is None:
        return []
    return sorted(r["pre_token"] for r in counted.where(step >= least).select("pre_token").collect())


def token_counts(
    docs: DataFrame,
    model: str,
    text_col: str = "text",
    id_col: str = "doc_id",
    table_entries: int = 65_536,
    task_entries: int = 8_192,
    cache_entries: int = 400_000,
) -> DataFrame:
    """``(id, n_bytes, n_tokens, n_misses)`` of every whole text.

    model: path of a ``.model`` file that every executor has.  n_tokens counts
    what the library's ``encode`` gives; n_misses the pre-tokens that the
    broadcast table lacks.  A null or empty text has 0 bytes and 0 tokens;
    repeated rows are counted each; no rows give none.  The broadcast table
    has at most ``table_entries`` keys of 48 characters, the worker's
    cache at most ``cache_entries``.
    """
    spark = docs.sparkSession
    known = most_frequent(written(frequent_pre_tokens(docs, text_col, task_entries), "pre-tokens"), table_entries)
    table = spark.sparkContext.broadcast(dict(zip(known, Encoder(model).lengths(known), strict=True)) if known else {})
    schema = T.StructType(
        [docs.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_misses", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, cache, encoder = table.value, {}, Encoder(model)
        for batch in batches:
            tokens, misses = [], []
            for text in batch.column(2):
                pre_tokens = Encoder.split(text.as_py() or "")
                lengths = list(map(first.get, pre_tokens))
                total, rest = 0, []
                if None in lengths:
                    rest = [p for p, n in zip(pre_tokens, lengths, strict=True) if n is None]
                    total = sum(n for n in lengths if n is not None)
                    new = [p for p in dict.fromkeys(rest) if p not in cache]
                    found = dict(zip(new, encoder.lengths(new), strict=True)) if new else {}
                    total += sum(found[p] if p in found else cache[p] for p in rest)
                    if len(cache) + len(found) > cache_entries:
                        cache = {}
                    cache.update((p, n) for p, n in found.items() if len(p) <= KEY_CHARS)
                    if len(cache) > cache_entries:
                        cache = {}
                else:
                    total = sum(lengths)
                tokens.append(total)
                misses.append(len(rest))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, pa.int64()), pa.array(misses, pa.int64())], names=schema.names)

    n_bytes = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    return docs.select(id_col, n_bytes.alias("n_bytes"), text_col).mapInArrow(run, schema)
