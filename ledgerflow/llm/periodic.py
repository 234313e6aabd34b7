"""Periodic runs of words by an enhanced suffix array.

Documents are put behind one another, each with symbols of its own and a
closing symbol that occurs once, so one suffix array serves many documents and
no common prefix crosses a border.  For each cut of an LCP interval (an
interval of several children is cut pairwise) the suffixes of the smaller side
are looked up: with ``d`` the interval's depth, suffix ``i`` starts a branching
square of period ``d`` if ``i + d`` stands on the other side, by ISA, and so
does ``i - d``.  A branching square is the last one of its run: rotating it to
the left gives the run.  No tree nodes are built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])
_FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed", T.StringType())])
#: lookups at once
CHUNK = 1 << 20


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(sa, depth)`` of the suffixes whose first symbol occurs again, in order;
    depth is the common prefix with the suffix before, 0 where the first
    symbols differ.  The last symbol of ``s`` must occur once.

    Prefix doubling; only suffixes that share their prefix so far are sorted on.
    """
    n = len(s)
    sa = np.argsort(s, kind="stable")
    new = np.append(True, s[sa[1:]] != s[sa[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = first
    levels, h = [rank.astype(np.int32)], 1
    shared = ~(new & np.append(new[1:], True))
    slots, group = np.flatnonzero(shared), first[shared]
    listed, border = slots, new[slots]
    while len(slots):
        at = sa[slots]
        key = group * n + rank[at + h]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[slots] = at
        new = np.append(True, key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(new, slots, 0))
        rank[at] = first
        levels.append(rank.astype(np.int32))
        shared = ~(new & np.append(new[1:], True))
        slots, group = slots[shared], first[shared]
        h *= 2
    sa = sa[listed]
    depth = np.zeros(len(sa), np.int64)
    cuts = np.flatnonzero(~border)
    a, b = sa[cuts - 1], sa[cuts]
    common = np.zeros(len(cuts), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        common += (levels[k][a + common] == levels[k][b + common]).astype(np.int64) << k
    depth[cuts] = common
    return sa, depth


def cut_ranges(depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each cut ``k``, the range ``left <= k < right`` of ranks that it parts at its depth."""
    values = depth.tolist()
    left, right, open_ = [0] * len(values), [len(values)] * len(values), []
    for k, x in enumerate(values):
        while open_ and values[open_[-1]] >= x:
            right[open_.pop()] = k
        left[k] = open_[-1] if open_ else 0
        open_.append(k)
    return np.array(left, np.int64), np.array(right, np.int64)


def branching_squares(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(start, period)`` of the squares that the symbol after them does not continue."""
    sa, depth = suffix_array(s)
    isa = np.full(len(s) + 1, -1, np.int64)
    isa[sa] = np.arange(len(sa))
    left, right = cut_ranges(depth)
    cuts = np.flatnonzero(depth)
    left, right, depth = left[cuts], right[cuts], depth[cuts]
    by_left = cuts - left <= right - cuts
    low, size = np.where(by_left, left, cuts), np.where(by_left, cuts - left, right - cuts)
    other, other_end = np.where(by_left, cuts, left), np.where(by_left, right, cuts)
    before = np.append(0, np.cumsum(size))
    starts, periods, k = [], [], 0
    while k < len(cuts):
        m = max(k + 1, int(np.searchsorted(before, before[k] + CHUNK, "right")) - 1)
        cut = np.repeat(np.arange(k, m), size[k:m])
        i = sa[np.arange(before[m] - before[k]) + (low - before[:-1] + before[k])[cut]]
        d = depth[cut]
        for at, start in ((i + d, i), (i - d, i - d)):
            rank = isa[np.clip(at, -1, len(s))]
            hit = (rank >= other[cut]) & (rank < other_end[cut])
            starts.append(start[hit])
            periods.append(d[hit])
        k = m
    return (np.concatenate(starts), np.concatenate(periods)) if starts else (np.empty(0, np.int64), np.empty(0, np.int64))


def _rotated(s: np.ndarray, i: int, d: int) -> int:
    """The start of the run of the square of period ``d`` at ``i``."""
    step = 32
    while i > 0:
        low = max(0, i - step)
        differ = np.flatnonzero(s[low:i] != s[low + d : i + d])
        if len(differ):
            return low + int(differ[-1]) + 1
        i, step = low, 4 * step
    return i


def runs_of(s: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, end, smallest period)`` of the maximal repetitions of two periods or more."""
    starts, periods = branching_squares(s)
    ends = starts + 2 * periods
    runs, end, begins = [], -1, 0
    for k in np.lexsort((periods, ends)).tolist():
        i, d = int(starts[k]), int(periods[k])
        if ends[k] != end:
            end, begins = int(ends[k]), len(s)
        if i < begins:  # else the square lies in a run of a period that divides its own
            begins = _rotated(s, i, d)
            runs.append((begins, end, d))
    return runs


def document_runs(texts: list[list[bytes]], min_exponent: int, min_length: int) -> list[list[tuple[int, int, int]]]:
    """For each document, a list of words, its runs ``(start, length, period)`` by start and period."""
    symbols: list[int] = []
    begins = []
    for words in texts:
        begins.append(base := len(symbols))
        numbers: dict[bytes, int] = {}
        symbols.extend([base + numbers.setdefault(w, len(numbers)) for w in words])
        symbols.append(base + len(words))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if symbols:
        runs = [x for x in runs_of(np.array(symbols, np.int64)) if x[1] - x[0] >= max(min_length, min_exponent * x[2])]
        at = np.searchsorted(begins, [x[0] for x in runs], "right") - 1
        for doc, (start, end, period) in zip(at.tolist(), runs, strict=True):
            found[doc].append((start - begins[doc], end - start, period))
    return [sorted(set(x), key=lambda r: (r[0], r[2])) for x in found]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def periodic_runs(docs: DataFrame, text_col: str = "text", min_exponent: int = 4, min_length: int = 6, into: str = "found", block_words: int = 200_000) -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, runs (start, length,
    period; by start, then period) and collapsed, the text's words with only
    the first period of each run kept, joined by one blank.

    Words are ``[^\x20\x09-\x0D]+``.  A run is a stretch of words of smallest
    period p, of ``min_length`` words and ``min_exponent`` periods at least,
    that no neighbouring word extends.  A null, empty or blank text has no
    words, no runs and an empty collapsed text.  All rows and columns stay,
    repeated rows too; no rows give none.  Documents of up to ``block_words``
    words together share an array; a longer one has its own.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent: 2 or more")
    while into in docs.columns:
        into += "_"
    schema = T.StructType([*docs.schema.fields, T.StructField(into, _FOUND)])
    at = docs.columns.index(text_col)
    arrow = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[int] = []
            runs: list[list[tuple[int, int, int]]] = []
            texts: list[bytes] = []
            held: list[list[bytes]] = []
            size = 0

            def flush() -> None:
                for words, found in zip(held, document_runs(held, min_exponent, min_length), strict=True):
                    counts.append(len(words))
                    runs.append(found)
                    texts.append(_collapsed(words, found))
                held.clear()

            for raw in batch.column(at).cast(pa.binary()):
                words = (raw.as_py() or b"").split()
                if held and size + len(words) > block_words:
                    flush()
                    size = 0
                held.append(words)
                size += len(words)
            flush()
            sizes = np.append(0, np.cumsum([len(x) for x in runs])).astype(np.int32)
            flat = np.array([r for x in runs for r in x], np.int64).reshape(-1, 3)
            items = pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], fields=list(arrow.field("runs").type.value_type))
            column = pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(sizes), items), pa.array(texts, pa.binary()).cast(pa.string())], names=["n_words", "runs", "collapsed"])
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=schema.names)

    return docs.mapInArrow(run, schema)


def longest(runs: Column) -> Column:
    """The run of greatest length, of these the one of smallest start, then period; null without runs."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(ranked)


def listed(runs: Column) -> Column:
    """The runs as text, ``start,length,period`` and a line feed each."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
