"""Language identification by Bayesian fusion of evidence.

For each page the log posterior of a language is the sum of

* the text's log likelihood under byte trigram profiles, fitted to labelled
  documents and damped, since a byte is in three trigrams;
* log P(declared markup language | language) and log P(address suffix hint |
  language), both estimated by grouped sums over all pages;
* the log prior of the page's host: the sums of the other pages' text
  posteriors on the host, smoothed towards those of its domain, and these
  towards those of all pages.
"""

from __future__ import annotations

import html as markup
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let, sent, written

BUCKETS = 1 << 14
#: a host with more than one of so many pages meets its prior by broadcast
HOT_HOSTS = 1000
MARKUP = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
#: country codes and the language that an address under them hints at, besides codes that are languages themselves
COUNTRIES = {"at": "de", "ch": "de", "us": "en", "uk": "en", "au": "en", "ca": "en", "nz": "en", "ie": "en", "mx": "es", "ar": "es", "co": "es", "cl": "es", "pe": "es", "be": "fr", "lu": "fr"}


def visible(raw: bytes | None) -> bytes:
    """The text of a page without scripts, styles, comments and tags, entities resolved, A-Z lower-cased."""
    text = MARKUP.sub(b" ", raw or b"")
    if b"&" in text:
        text = markup.unescape(text.decode("utf-8", "replace")).encode("utf-8", "replace")
    return text.lower()


def trigrams(text: bytes) -> np.ndarray:
    """The hash bucket of each byte trigram."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    mixed = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
    return ((mixed ^ (mixed >> np.uint32(15))) % BUCKETS).astype(np.int64)


@dataclass
class Profiles:
    """languages in order; log P(trigram bucket | language) as (BUCKETS, languages)."""

    languages: list[str]
    log_p: np.ndarray

    def likelihoods(self, raw: bytes | None, damping: float) -> np.ndarray:
        """Damped log likelihoods, the best one 0."""
        found = np.zeros(len(self.languages))
        buckets = trigrams(visible(raw))
        for at in range(0, len(buckets), 1 << 16):
            found += self.log_p[buckets[at : at + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return (found - found.max()) * damping if len(found) else found


def profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", rows: int = 500) -> Profiles:
    """Profiles of every language that a document is labelled with, each from
    the ``rows`` documents with the smallest hashes of id and text (all of each
    text; fewer where there are fewer), counted by language and bucket in Spark.
    Null labels and texts are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, raw in zip(batch.column(0), batch.column(1), strict=True):
                here = counts.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
                np.add.at(here, trigrams(visible(raw.as_py())), 1)
        for lang, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(n[some])], names=["lang", "bucket", "n"])

    rows_of = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("raw"), F.xxhash64(id_col, text_col).alias("h"))
    # a row for each language; about twice as many documents as are wanted pass its bound, before any shuffle
    counts = {r["lang"]: r["count"] for r in rows_of.groupBy("lang").count().collect()}
    bounds = {lang: -(2**63) + 2**64 * 2 * rows // n for lang, n in counts.items() if n > 4 * rows}
    few = rows_of
    if bounds:
        bound = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(bounds.items()) for x in pair]), F.col("lang"))
        few = rows_of.where(F.col("h") <= F.coalesce(bound, F.lit(2**63 - 1)))
    few = few.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h", "raw"))).where(F.col("place") <= rows).select("lang", "raw")
    found = few.repartition(8).mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r["lang"] for r in found})
    counts = np.full((BUCKETS, len(languages)), 0.5)
    for r in found:
        counts[r["bucket"], languages.index(r["lang"])] += r["n"]
    return Profiles(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def _code(text: Column, languages: list[str], others: dict[str, str] | None = None) -> Column:
    """The language of a tag or hint: one of ``languages``, "other", or "none"."""
    known = F.create_map(*[F.lit(x) for pair in ({k: v for k, v in (others or {}).items() if v in languages} | {x: x for x in languages}).items() for x in pair])
    tag = F.regexp_extract(F.lower(F.coalesce(text, F.lit(""))), r"^\s*([a-z]{2,3})(?![a-z])", 1)
    return F.when(tag == "", "none").otherwise(F.coalesce(F.element_at(known, tag), F.lit("other")))


def evidence(pages: DataFrame, model: Profiles, id_col: str, url_col: str, html_col: str, damping: float) -> DataFrame:
    """id, host, domain, declared, hint, ll (array by language) of every page."""
    shared, languages = sent(pages.sparkSession, model), model.languages
    url, html = F.coalesce(F.col(url_col), F.lit("")), F.coalesce(F.col(html_col), F.lit(""))
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    domain = F.regexp_extract(host, r"([^.]*\.?[^.]*)\.?\z", 1)
    path = F.regexp_extract(url, r"://[^/?#]+/([A-Za-z]{2})(?:[/?#-]|\z)", 1)
    suffix = F.regexp_extract(F.coalesce(host, F.lit("")), r"\.([a-z]{2})\.?\z", 1)
    # the attributes of the first html tag, and the meta tags, however long
    declared = F.regexp_extract(F.regexp_extract(html, r"(?i)<html\b([^>]*+)", 1), r"(?i)(?:^|[\s\"'])(?:xml:)?lang\s*=\s*[\"']?([A-Za-z-]{2,20})", 1)
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*+"), F.lit(0)), lambda m: m.rlike(r"(?i)http-equiv\s*=\s*[\"']?content-language"))
    meta = F.regexp_extract(F.coalesce(F.get(metas, F.lit(0)), F.lit("")), r"(?i)\scontent\s*=\s*[\"']?([A-Za-z-]{2,20})", 1)
    rows = pages.select(
        F.col(id_col).alias("id"),
        host.alias("host"),
        domain.alias("domain"),
        _code(F.when(declared != "", declared).otherwise(meta), languages).alias("declared"),
        _code(F.when(path != "", path).otherwise(suffix), languages, COUNTRIES).alias("hint"),
        F.col(html_col).cast("binary").alias("raw"),
    )
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("ll", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = pickle.loads(shared.value)
        for batch in batches:
            ll = [profiles.likelihoods(raw.as_py(), damping).tolist() for raw in batch.column(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(ll, pa.list_(pa.float64()))], names=schema.names)

    return rows.mapInArrow(run, schema)


def _softmax(ll: Column) -> Column:
    powers = let(F.array_max(ll), lambda top: F.transform(ll, lambda x: F.exp(x - top)))
    return let(powers, lambda p: let(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(p, lambda x: x / total)))


def _sums(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """The sums of the text posteriors by key, as an array; partial sums before the shuffle."""
    return rows.groupBy(key).agg(F.array(*[F.sum(F.col("q")[i]) for i in range(n)]).alias(name))


def _table(rows: DataFrame, key: str, languages: list[str], own: float = 4.0) -> Column:
    """log P(value of key | language) as a map column from the value to an
    array; at most languages + 2 values.  Pseudo-counts: 1, and ``own`` where the value is the language."""
    values = [*languages, "other", "none"]
    found = {r[key]: r["s"] for r in _sums(rows, key, len(languages), "s").collect()}
    counts = np.array([[(found[v][j] or 0.0) if v in found else 0.0 for j in range(len(languages))] for v in values])
    counts = np.round(counts, 6) + 1 + own * (np.array(values)[:, None] == np.array(languages)[None])
    logs = np.log(counts / counts.sum(axis=0))
    return F.create_map(*[x for v, row in zip(values, logs, strict=True) for x in (F.lit(v), F.array(*[F.lit(float(p)) for p in row]))])


def _smoothed(counts: Column, base: Column, strength: float) -> Column:
    """(counts + strength * base) / their sum."""
    total = F.aggregate(counts, F.lit(strength), lambda a, x: a + x)
    return F.zip_with(counts, base, lambda c, b: (c + strength * b) / total)


def identify(
    pages: DataFrame, model: Profiles, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", damping: float = 0.1, strength: float = 8.0
) -> DataFrame:
    """``(id, lang, probability, text_lang, declared, hint, host)`` of every row.

    lang: the language of the highest posterior (the first in code point order
    if equal); text_lang: the one that the text alone suggests (null without
    three bytes of visible text, as for null pages).  declared and hint are a
    language, "other" or "none".  A null or malformed address has no host and
    takes the prior of all pages.  A page's own text never enters its prior.
    Without labelled languages all results are null.  Repeated rows count each.
    """
    languages, n = model.languages, len(model.languages)
    if not n:
        none = F.lit(None).cast("string")
        return pages.select(F.col(id_col), none.alias("lang"), F.lit(None).cast("double").alias("probability"), *[none.alias(c) for c in ("text_lang", "declared", "hint", "host")])
    rows = written(evidence(pages, model, id_col, url_col, html_col, damping).withColumn("q", _softmax(F.col("ll"))), "language")
    everything = [round(x or 0.0, 6) for x in rows.agg(*[F.sum(F.col("q")[i]) for i in range(n)]).first()]
    total = sum(everything)
    overall = F.array(*[F.lit((x + 1) / (total + n)) for x in everything])
    hosts = _sums(rows.where("host is not null").select("host", "q"), "host", n, "host_sums")
    domains = _sums(rows.where("host is not null").select("domain", "q"), "domain", n, "domain_sums")
    of_host = written(rows.where("host is not null").select("host", "domain").distinct().join(hosts, "host").join(domains, "domain").select(F.col("host").alias("of_host"), "host_sums", "domain_sums"), "language-hosts")
    # a page's posterior sums to 1, so a host's sums count its pages: fewer than HOT_HOSTS hosts are hot
    pages_of = F.aggregate("host_sums", F.lit(0.0), lambda a, x: a + x)
    hot = F.broadcast(of_host.where(pages_of > total / HOT_HOSTS))
    same = rows["host"] == F.col("of_host")
    rest = rows.join(hot.select("of_host"), same, "left_anti")
    joined = rows.join(hot, same).unionByName(rest.where("host is not null").join(of_host, rest["host"] == of_host["of_host"]))
    joined = joined.unionByName(rest.where("host is null"), allowMissingColumns=True)

    def others(sums: str) -> Column:
        """The sums without the page's own part; nothing where there is no host."""
        return F.when(F.col(sums).isNull(), F.array(*[F.lit(0.0)] * n)).otherwise(F.zip_with(sums, "q", lambda s, q: F.greatest(s - q, F.lit(0.0))))

    prior = _smoothed(others("host_sums"), _smoothed(others("domain_sums"), overall, strength), strength)
    told, hinted = _table(rows, "declared", languages), _table(rows, "hint", languages)
    parts = [F.col("ll"), F.transform(prior, lambda p: F.log(p)), F.element_at(told, F.col("declared")), F.element_at(hinted, F.col("hint"))]
    fused = F.transform(F.arrays_zip(*[p.alias(f"e{i}") for i, p in enumerate(parts)]), lambda z: z["e0"] + z["e1"] + z["e2"] + z["e3"])
    names = F.array(*map(F.lit, languages))

    def best(values: Column) -> Column:
        return F.get(names, (F.array_position(values, F.array_max(values)) - 1).cast("int"))

    out = joined.withColumn("posterior", _softmax(fused))
    silent = F.array_min("ll") == F.array_max("ll")
    return out.select(
        F.col("id").alias(id_col),
        best(F.col("posterior")).alias("lang"),
        F.array_max("posterior").alias("probability"),
        F.when(~silent, best(F.col("ll"))).alias("text_lang"),
        "declared",
        "hint",
        "host",
    )

