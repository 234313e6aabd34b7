"""SimHash near-dedup with BK-trees over shards of the fingerprints.

Two 64-bit fingerprints that differ in at most ``radius`` bits agree on at
least two of ``radius + 2`` equal blocks of the 64 bits.  The distinct
fingerprints are dealt into shards by each pair of blocks, so that any two
linked fingerprints meet in a shard.  A shard has a BK-tree (children keyed
by their Hamming distance to the parent); a search follows only the edges
within the radius.  A shard of more than ``shard_rows`` fingerprints is cut
into parts; the tree of each part is sent to all parts with smaller or equal
numbers' queries, so no tree exceeds ``shard_rows`` nodes.  What a task emits
is a spanning forest of the links it has found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, written
from .components import connected_components

SEED = 42
#: shingles hashed at a time, (query, node) pairs searched at a time, rows gathered for a forest
BLOCK, FRONTIER, GATHER = 1 << 15, 1 << 16, 1 << 16


def simhash(raw: bytes | None, shingle_words: int) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text (see ``fingerprints``)."""
    words = (raw or b"").lower().split()  # bytes: only A-Z, and the white space \x20 \x09-\x0D
    if not words:
        return 0
    n, joined = max(1, len(words) - shingle_words + 1), b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[:n], ends[-n:]
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist(), strict=True)
        packed = np.frombuffer(b"".join([digest(joined[i:j], SEED) for i, j in spans]), np.uint8)
        counts += np.unpackbits(packed).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """``(id, fp, text_hash)`` of every whole text.

    A-Z are lower-cased; the words are ``[^\x20\x09-\x0D]+``; the shingles of
    ``shingle_words`` words, repeats included, are hashed by XXH64 (seed 42); a
    bit of ``fp`` is 1 if it is set in over half of the hashes.  A text of
    fewer words is one shingle; one without words, or null, has fp 0.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).cast(pa.binary())
            fps = pa.array([simhash(x.as_py(), shingle_words) for x in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], names=schema.names)

    return docs.select(id_col, F.xxhash64(text_col).alias("text_hash"), text_col).mapInArrow(run, schema)


class BkForest:
    """The BK-trees of many shards in arrays; ``shard`` is ascending."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray) -> None:
        self.fp = fp
        self.shards, first, of = np.unique(shard, return_index=True, return_inverse=True)
        self.root, at = first, first[of]
        left = np.flatnonzero(at != np.arange(len(fp)))
        keys, nodes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while left.size:  # one level a turn: the first of each (parent, distance) becomes that child
            key = at[left] * 65 + np.bitwise_count(fp[left] ^ fp[at[left]])
            edge, chosen, group = np.unique(key, return_index=True, return_inverse=True)
            child = left[chosen]
            keys.append(edge)
            nodes.append(child)
            at[left] = child[group]
            left = left[at[left] != left]
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.argsort(key, kind="stable")
        self.edge, self.child = key[order], node[order]

    def search(self, shard: np.ndarray, fp: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (query, node) positions within the radius, in the query's own shard."""
        place = np.searchsorted(self.shards, shard)
        known = np.flatnonzero((place < len(self.shards)) & (self.shards[np.minimum(place, len(self.shards) - 1)] == shard))
        stack = [(known, self.root[place[known]])] if known.size else []
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER:
                stack.append((q[FRONTIER:], node[FRONTIER:]))
                q, node = q[:FRONTIER], node[:FRONTIER]
            d = np.bitwise_count(fp[q] ^ self.fp[node]).astype(np.int64)
            if (near := d <= radius).any():
                yield q[near], node[near]
            low = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0))
            n = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), "right") - low
            if total := int(n.sum()):
                offsets = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
                stack.append((np.repeat(q, n), self.child[np.repeat(low, n) + offsets]))


def _union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the components of a[i] and b[i]; every entry of root stays its component's least."""
    while (apart := root[a] != root[b]).any():
        a, b = a[apart], b[apart]
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root])[...].tobytes() != root.tobytes():
            root = up
    return root


def _forest(shard: np.ndarray, fp: np.ndarray, in_tree: np.ndarray, is_query: np.ndarray, radius: int):
    """A spanning forest of the links between queries and trees of equal shards."""
    tree, query = np.flatnonzero(in_tree), np.flatnonzero(is_query)
    root = np.arange(len(fp))
    if tree.size and query.size:
        for q, node in BkForest(shard[tree], fp[tree]).search(shard[query], fp[query], radius):
            root = _union(root, query[q], tree[node])
    linked = np.flatnonzero(root != np.arange(len(fp)))
    return fp[linked].view(np.int64), fp[root[linked]].view(np.int64)


def _pair_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: np.ndarray) -> pa.RecordBatch:
            key, part, other, mine, fp = rows
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1]) | (other[1:] != other[:-1])
            a, b = _forest(np.cumsum(new), fp.view(np.uint64), mine == part, mine == other, radius)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        held = np.empty((5, 0), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.int64)], axis=1)
            if held.shape[1] >= GATHER:  # all but the last, perhaps unfinished, shard
                full = np.flatnonzero((held[:3] != held[:3, -1:]).any(axis=0))
                cut = full[-1] + 1 if full.size else 0
                if cut:
                    yield links(np.ascontiguousarray(held[:, :cut]))
                    held = held[:, cut:].copy()
        if held.shape[1]:
            yield links(held)

    return run


def near_links(prints: DataFrame, radius: int = 2, shard_rows: int = 16_384) -> DataFrame:
    """Links ``(a, b)`` that join all distinct ``fp`` of at most ``radius``
    differing bits into the components that all such pairs would give.

    Empty input gives no links; null fingerprints are ignored.
    """
    blocks = radius + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [F.shiftrightunsigned("fp", low).bitwiseAND((1 << (high - low)) - 1) for low, high in zip(edges, edges[1:])]
    width = max(h - l for l, h in zip(edges, edges[1:]))
    if 2 * width > 58:
        raise ValueError("a radius of 1 or more is needed")
    shards = [
        F.shiftleft(part[i], width).bitwiseOR(part[j]).bitwiseOR(F.lit(n).cast("long") * F.lit(1 << (2 * width)))
        for n, (i, j) in enumerate(combinations(range(blocks), 2))
    ]
    keyed = prints.where("fp is not null").select("fp").distinct().select("fp", F.explode(F.array(*shards)).alias("shard"))
    parts = F.ceil(F.col("n") / shard_rows).cast("long")
    large = keyed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1").select("shard", parts.alias("parts"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts"))
    cells = (
        keyed.join(large, "shard")
        .select("shard", "fp", "parts", mine.alias("mine"))
        .select("shard", "fp", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("with"))
        .select("shard", F.least("mine", "with").alias("part"), F.greatest("mine", "with").alias("other"), "mine", "fp")
        .repartition("shard", "part", "other")
        .sortWithinPartitions("shard", "part", "other", "fp")
    )
    return cells.mapInArrow(_pair_links(radius), "a long, b long")


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, radius: int = 2, shard_rows: int = 16_384
) -> DataFrame:
    """``(id, text_hash, fp, component_id, component_fp)`` for every row of ``docs``.

    Texts whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest id that links reach, the row's own
    included.  Equal texts, and all texts without words (null too), share a
    fingerprint and so a component.  Rows with a null id take part; their id
    is never the smallest (a component of null ids only has a null id).
    ``component_fp`` is the component's smallest fingerprint, which no other
    component has; ids may repeat, so ``component_id`` doesn't tell components
    apart.  Repeated rows give repeated results; no rows give none.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    nodes = prints.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = connected_components(near_links(prints, radius, shard_rows))
    at = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    at = written(at, "simhash-roots")
    smallest = at.groupBy("root").agg(F.min("least").alias("component_id"))
    named = at.join(smallest, "root").select("fp", "component_id", F.col("root").alias("component_fp"))
    return prints.join(named, "fp").select(id_col, "text_hash", "fp", "component_id", "component_fp")


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, radius: int = 2, shard_rows: int = 16_384
) -> DataFrame:
    """One row of each component of ``docs``; all columns stay.

    It is the one of the smallest ``(id, fp, text_hash)``, null ids last.
    Rows that repeat the id and the text of a kept row are dropped as copies;
    rows that share only the id, or have none, are told apart by their texts.
    """
    found = near_components(docs, id_col, text_col, shingle_words, radius, shard_rows)
    best = found.groupBy("component_fp").agg(
        F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "fp", "text_hash")).alias("best")
    )
    key, hashed, text_hash = free_names(docs, "kept_id", "kept_hash", "text_hash")
    keep = best.select(F.col("best.id").alias(key), F.col("best.text_hash").alias(hashed))
    rows = docs.withColumn(text_hash, F.xxhash64(docs[text_col]))
    same = rows[id_col].eqNullSafe(F.col(key)) & (rows[text_hash] == F.col(hashed))
    return rows.join(keep, same, "left_semi").dropDuplicates([id_col, text_hash]).drop(text_hash)
