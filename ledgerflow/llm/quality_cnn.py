"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Learned filters run over a chunk; a filter sees the learned embeddings of eight
bytes and, for each lag, how many bytes from there on equal the byte that many
places before.  ReLU and max-pooling over the chunk give its features, a dense
layer its logit; mean and least of the chunks' logits are combined into the
text's probability.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc32_mod, sent, smallest_hashes

CHUNK, STEP = 256, 192
WIDTH, STRIDE = 8, 4
EMBED, FILTERS = 8, 24
#: distances at which a byte is compared with an earlier one
LAGS = range(2, 22)
#: bytes over which the equal ones are counted
SPAN = 16
#: a filter starts at each group of STRIDE bytes but the last and sees this and the next one
GROUPS = CHUNK // STRIDE
POSITIONS = GROUPS - WIDTH // STRIDE + 1
PART = STRIDE * EMBED
INPUTS = WIDTH * EMBED + len(LAGS)
#: chunks that go through the network at a time
BLOCK = 64


def chunked(raw: bytes) -> Iterator[np.ndarray]:
    """(n, CHUNK) bytes, some at a time: chunks every STEP bytes, the last one ends with the text; short texts are padded by 0."""
    data = np.frombuffer(raw, np.uint8)
    if len(data) <= CHUNK:
        yield np.pad(data, (0, CHUNK - len(data)))[None]
        return
    starts = np.append(np.arange(0, len(data) - CHUNK, STEP), len(data) - CHUNK)
    view = np.lib.stride_tricks.sliding_window_view(data, CHUNK)
    for at in range(0, len(starts), BLOCK):
        yield view[starts[at : at + BLOCK]]


def _inputs(chunks: np.ndarray, embedding: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The embedded bytes of each group, (n, GROUPS, PART); the bytes of each
    group that equal earlier ones, by lag, (lags, n, GROUPS) as shares of SPAN."""
    n = len(chunks)
    groups = embedding.take(chunks, axis=0).reshape(n, GROUPS, PART)
    equal = np.empty((len(LAGS), n, GROUPS), np.float32)
    same, some = np.zeros((n, CHUNK), np.uint8), (chunks != 0).view(np.uint8)
    for k, lag in enumerate(LAGS):
        same[:, :lag] = 0
        np.equal(chunks[:, lag:], chunks[:, :-lag], out=same[:, lag:].view(bool))
        same &= some
        equal[k] = np.bitwise_count(same.view(np.uint32))
    equal *= 1 / SPAN
    return groups, equal


def _spanned(x: np.ndarray) -> np.ndarray:
    """Along the last axis, the sum of an entry and the next ones up to SPAN bytes; for the filters' positions."""
    out = x[..., :POSITIONS].copy()
    for i in range(1, SPAN // STRIDE):
        part = x[..., i : i + POSITIONS]
        out[..., : part.shape[-1]] += part
    return out


@dataclass
class Network:
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    offset: float
    combine: tuple[float, float, float] = (0.0, 1.0, 0.0)

    @classmethod
    def new(cls, seed: int) -> Network:
        r = np.random.default_rng(seed)
        f = np.float32
        return cls(
            r.normal(0, 0.5, (256, EMBED)).astype(f),
            r.normal(0, (2 / INPUTS) ** 0.5, (INPUTS, FILTERS)).astype(f),
            np.zeros(FILTERS, f),
            r.normal(0, 0.1, FILTERS).astype(f),
            0.0,
        )

    def _responses(self, groups: np.ndarray, equal: np.ndarray) -> np.ndarray:
        """(FILTERS, n, POSITIONS): each filter at each place."""
        n = len(groups)
        halves = np.concatenate([self.filters[:PART], self.filters[PART : 2 * PART]], axis=1)
        seen = (halves.T @ groups.reshape(-1, PART).T).reshape(2 * FILTERS, n, GROUPS)
        out = _spanned((self.filters[2 * PART :].T @ equal.reshape(len(LAGS), -1)).reshape(FILTERS, n, GROUPS))
        out += seen[:FILTERS, :, :-1]
        out += seen[FILTERS:, :, 1:]
        return out

    def logits(self, chunks: np.ndarray) -> np.ndarray:
        """Of each chunk, in blocks of bounded memory."""
        out = np.empty(len(chunks), np.float32)
        for at in range(0, len(chunks), BLOCK):
            block = chunks[at : at + BLOCK]
            pooled = np.maximum(self._responses(*_inputs(block, self.embedding)).max(axis=2).T + self.bias, 0)
            out[at : at + BLOCK] = pooled @ self.dense + self.offset
        return np.clip(out, -12, 12)

    def score(self, logits: np.ndarray) -> float:
        """The probability from all chunks' logits: the mean, and the least (the worst part)."""
        a, mean, least = self.combine
        z = a + mean * float(logits.mean()) + least * float(logits.min())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def gradients(self, chunks: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        groups, equal = _inputs(chunks, self.embedding)
        pre = self._responses(groups, equal)
        best = pre.argmax(axis=2).T  # n, FILTERS
        top = pre.max(axis=2).T + self.bias
        pooled = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-(pooled @ self.dense + self.offset)))
        d = ((p - y) * weight / weight.sum()).astype(np.float32)
        d_top = d[:, None] * self.dense[None] * (top > 0)  # n, FILTERS
        row = np.arange(len(chunks))[:, None]
        chosen = np.concatenate([groups[row, best], groups[row, best + 1], _spanned(equal).transpose(1, 2, 0)[row, best]], axis=2)  # n, FILTERS, INPUTS
        d_filters = np.einsum("nfi,nf->if", chosen, d_top, optimize=True)
        d_input = self.filters[: WIDTH * EMBED].T[None] * d_top[:, :, None]
        places = best[:, :, None] * STRIDE + np.arange(WIDTH)  # n, FILTERS, WIDTH
        seen = np.take_along_axis(chunks, places.reshape(len(chunks), -1), axis=1).ravel()
        d_embedding = np.stack([np.bincount(seen, d, 256) for d in d_input.reshape(-1, EMBED).T], axis=1).astype(np.float32)
        return [d_embedding, d_filters, d_top.sum(axis=0), pooled.T @ d, np.float32(d.sum())]


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Regularised logistic regression by Newton's method; x has a column of ones first."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [1e-1] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(texts: list[list[bytes]], labels: list[int], epochs: int = 6, batch: int = 64, rate: float = 4e-3, seed: int = 7) -> Network:
    """Fits a network on documents given as lists of byte excerpts.

    Chunk weights make both labels, and all documents of a label, count alike;
    the combination is fitted on the documents as they are distributed.
    Without both labels the score is the share of label 1 (0.5 without any).
    """
    net = Network.new(seed)
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    if len(set(labels)) < 2:
        net.combine = (float(np.log(share / (1 - share))), 0.0, 0.0)
        return net
    parts = [np.concatenate([c for e in t or [b""] for c in chunked(e)]) for t in texts]
    of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    x, y = np.concatenate(parts), np.array(labels, np.float32)
    weight = (1 / np.array([len(p) for p in parts], np.float32) / np.where(y > 0, y.sum(), (1 - y).sum()))[of]
    weight /= weight.mean()
    params = [net.embedding, net.filters, net.bias, net.dense, np.zeros(1, np.float32)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    r, t, rounds = np.random.default_rng(seed), 0, epochs * -(-len(x) // batch)
    for _ in range(epochs):
        order = r.permutation(len(x))
        for at in range(0, len(x), batch):
            t, pick = t + 1, order[at : at + batch]
            g = net.gradients(x[pick], y[of[pick]], weight[pick])
            for i, (p, d) in enumerate(zip(params, g, strict=True)):
                m[i] += 0.1 * (d - m[i])
                v[i] += 0.001 * (d * d - v[i])
                p -= (rate * (1 - 0.9 * t / rounds)) * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
            net.offset = float(params[4][0])
    logits = net.logits(x)
    ends = np.cumsum([len(p) for p in parts])
    cuts = np.split(logits, ends[:-1])
    w = _logistic(np.array([[1, c.mean(), c.min()] for c in cuts], np.float64), y.astype(np.float64))
    net.combine = (float(w[0]), float(w[1]), float(w[2]))
    return net


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int, excerpts: int) -> tuple[list[list[bytes]], list[int]]:
    """A bounded sample of labelled documents: those of the ``rows`` smallest
    hashes of the id, crc32(id as text) mod 5 not 0; of a text of more than
    ``excerpts`` chunks, so many excerpts spread evenly over all of it.  Of the
    texts of a repeated id the one with the smallest pieces is taken."""
    kept = labels.where(F.col(label_col).isNotNull() & (crc32_mod(F.col(id_col), 5) != 0))
    kept = kept.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    few = smallest_hashes(kept, "id", rows, labels.count() * 4 // 5)
    raw, n = F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")), F.lit(excerpts)
    length = F.length(raw)

    def excerpt(i: Column) -> Column:
        return F.substring(raw, (F.floor((length - CHUNK) * i / F.greatest(n - 1, F.lit(1))) + 1).cast("int"), F.lit(CHUNK))

    pieces = F.when(length <= excerpts * CHUNK, F.array(raw)).otherwise(F.transform(F.sequence(F.lit(0), n - 1), excerpt))
    found = docs.select(F.col(id_col).alias("id"), pieces.alias("pieces")).join(few, "id").groupBy("id").agg(F.min("pieces").alias("pieces"), F.max("label").alias("label")).orderBy("id").collect()
    return [[bytes(p) for p in r["pieces"]] for r in found], [r["label"] for r in found]


def scored(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text; a null text scores as an empty one."""
    shared = sent(docs.sparkSession, net)
    while into in docs.columns:
        into += "_"
    schema, at = T.StructType([*docs.schema.fields, T.StructField(into, T.DoubleType())]), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = pickle.loads(shared.value)
        for batch in batches:
            raws = (x.as_py() or b"" for x in batch.column(at).cast(pa.binary()))
            scores: list[float] = []
            held: list[np.ndarray] = []
            counts: list[int] = []

            def flush() -> None:
                logits = network.logits(np.concatenate(held))
                scores.extend(network.score(part) for part in np.split(logits, np.cumsum(counts)[:-1]))
                held.clear()
                counts.clear()

            for raw in raws:
                if len(raw) > BLOCK * STEP:  # block after block, no text's chunks stand in memory at once
                    if held:
                        flush()
                    scores.append(network.score(np.concatenate([network.logits(c) for c in chunked(raw)])))
                    continue
                held += chunked(raw)  # short texts, of one block each, go through the network together
                counts.append(len(held[-1]))
                if sum(counts) >= BLOCK:
                    flush()
            if held:
                flush()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = 3_000, excerpts: int = 8, **options) -> Network:
    """A network fitted to at most ``rows`` labelled documents (see ``training_rows``), the same for the same rows."""
    return train(*training_rows(docs, labels, id_col, text_col, label_col, rows, excerpts), **options)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row.

    held_out: crc32(id as text) mod 5 is 0; the labels of those rows are never
    learned, labels without a document or value neither.  A null id isn't
    held out.  Only a text's bytes enter its score; equal texts score alike.
    """
    net = fit(docs, labels, id_col, text_col, **options)
    rows = scored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), net, "id", "text")
    return rows.select(
        F.col("id").alias(id_col),
        F.coalesce(crc32_mod(F.col("id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject; all columns stay."""
    rows = scored(docs, fit(docs, labels, id_col, text_col, **options), id_col, text_col, "__score")
    into = rows.columns[-1]
    return rows.where(F.col(into) >= threshold).drop(into)
