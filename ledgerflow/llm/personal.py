"""Personal data by bootstrapped contextual extraction.

Seed entities (e-mail and IP addresses, card and phone numbers, long hexadecimal
secrets) are found by their form.  The words that stand right before and after
them are lexical patterns.  Patterns and the identifier-like strings they stand
with are a graph that Spark scores in rounds: a pattern is as good as the part
of all places with its words that hold a trusted string, a string is as good as
its patterns together.  Strings of other forms beside a trusted pattern are
identifiers too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

#: kinds in the order of their spans; the first four are found by form alone
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "context")
#: the filter of patterns has 2 ** FILTER_BITS bits
FILTER_BITS = 24

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match always begins where its digits begin; saying so keeps long runs of digits linear
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{32,}")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_PUNCTUATION = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())
_PUNCTUATION_BYTES = _PUNCTUATION.encode()
#: bytes of a context: A-Z to a-z, digits to 0
_FORM = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind, then start; code points, end exclusive.

    Of each kind the leftmost matches that don't overlap; one that fails its
    further conditions is dropped, and the search goes on behind it.
    """
    found = [("email", *x) for x in _emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return found


def _hash(*parts: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(b"\0".join(parts)) - (1 << 63)


def _form(s: str) -> bytes:
    return s.encode().translate(_FORM)


class Mention:
    """An identifier-like string in a text: its place, kind (None: not a seed) and patterns."""

    __slots__ = ("start", "end", "kind", "patterns", "instance")

    def __init__(self, text: str, tokens: list[tuple[int, int]], first: int, last: int, start: int, end: int, kind: str | None) -> None:
        self.start, self.end, self.kind = start, end, kind
        self.instance = _hash(text[start:end].encode())
        self.patterns = []
        # between a neighbouring word and the string there is nothing but punctuation
        opening, closing = text[tokens[first][0] : start], text[end : tokens[last][1]]
        if first > 0 and not opening.strip(_PUNCTUATION):
            self.patterns.append(_hash(b"<", _form(text[slice(*tokens[first - 1])]), opening.encode()))
        if last + 1 < len(tokens) and not closing.strip(_PUNCTUATION):
            self.patterns.append(_hash(b">", _form(text[slice(*tokens[last + 1])]), closing.encode()))


def mentions(text: str, base: list[tuple[str, int, int]], min_length: int) -> list[Mention]:
    """The base spans, and the other words of ``min_length`` letters and digits, two digits at least, without the punctuation around them."""
    if not base and not _DIGIT.search(text):
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    out, spans, k = [], sorted({(start, end): kind for kind, start, end in base}.items()), 0
    held = 0  # spans before this place have been passed
    for i, (a, b) in enumerate(tokens):
        seeded = a < held
        while k < len(spans) and spans[k][0][0] < b:
            (start, end), kind = spans[k]
            k += 1
            seeded = True
            if start >= held:  # of overlapping spans the first
                last = i
                while tokens[last][1] < end:
                    last += 1
                out.append(Mention(text, tokens, i, last, start, end, kind))
            held = max(held, end)
        if seeded:
            continue
        token = text[a:b]
        core = token.strip(_PUNCTUATION)
        if len(core) >= min_length and len(_DIGIT.findall(core)) >= 2:
            start = a + len(token) - len(token.lstrip(_PUNCTUATION))
            out.append(Mention(text, tokens, i, i, start, start + len(core), "secret" if _SECRET.fullmatch(core) else None))
    return out


def _count_contexts(raw: bytes, held: Counter) -> None:
    """Adds the places of each pattern: a word with the punctuation that opens
    the word after it, or that closes the word before it."""
    forms, words = raw.translate(_FORM).split(), raw.split()
    opening = [w[: len(w) - len(w.lstrip(_PUNCTUATION_BYTES))] for w in words]
    closing = [w[len(w.rstrip(_PUNCTUATION_BYTES)) :] for w in words]
    held.update(zip([b"<"] * len(words), forms, opening[1:]))  # noqa: B905
    held.update(zip([b">"] * len(words), forms[1:], closing))  # noqa: B905


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_MENTIONS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("instance", T.LongType()), T.StructField("patterns", T.ArrayType(T.LongType()))]))


def marked(docs: DataFrame, id_col: str, text_col: str, min_length: int) -> DataFrame:
    """``(row, id, text_hash, base, mentions)``: one row, with a number of its own, for each row of ``docs``."""
    names = ["row", "id", "text_hash", "base", "mentions"]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, [T.LongType(), docs.schema[id_col].dataType, T.LongType(), _SPANS, _MENTIONS], strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            base, found = [], []
            for raw in batch.column(2).cast(pa.binary()):
                text = (raw.as_py() or b"").decode()
                spans = base_spans(text)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
                found.append([{"kind": m.kind, "start": m.start, "end": m.end, "instance": m.instance, "patterns": m.patterns} for m in mentions(text, spans, min_length)])
            numbers = pa.array(range(row, row + len(base)), pa.int64())
            row += len(base)
            yield pa.RecordBatch.from_arrays([numbers, batch.column(0), batch.column(1), pa.array(base, arrow.field("base").type), pa.array(found, arrow.field("mentions").type)], schema=arrow)

    return docs.select(id_col, F.xxhash64(text_col).alias("text_hash"), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(run, schema)


def _slot(pattern: Column) -> Column:
    return F.shiftrightunsigned(pattern, 64 - FILTER_BITS)


def pattern_filter(patterns: DataFrame) -> np.ndarray:
    """A bit for each value of a pattern's first ``FILTER_BITS`` bits, 1 where one of ``patterns`` has it.

    Put together by a grouped aggregation, so that its size bounds what the driver sees.
    """
    word, bit = F.shiftright(_slot(F.col("pattern")), 6), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(pattern, {64 - FILTER_BITS}) & 63 AS INT))")
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for r in patterns.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toLocalIterator():
        bits[r["word"]] = np.uint64(r["bits"] & (2**64 - 1))
    return bits


def places_of(docs: DataFrame, text_col: str, patterns: DataFrame, task_entries: int) -> DataFrame:
    """``(pattern, places)``: how often each of ``patterns``' words stand in all texts.

    A task counts all contexts, and hands on those that pass a filter of
    bounded size; what passes it in error is left out by the join.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pattern_filter(patterns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held = shared.value, Counter()

        def counted() -> pa.RecordBatch:
            found = np.fromiter((_hash(*x) for x in held), np.int64, len(held))
            n = np.fromiter(held.values(), np.int64, len(held))
            slot = found.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
            passed = (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
            return pa.RecordBatch.from_arrays([pa.array(found[passed]), pa.array(n[passed])], names=["pattern", "n"])

        for batch in batches:
            for raw in batch.column(0).cast(pa.binary()):
                _count_contexts(raw.as_py() or b"", held)
                if len(held) > task_entries:
                    yield counted()
                    held.clear()
        yield counted()

    counts = docs.select(F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(run, "pattern long, n long")
    return counts.groupBy("pattern").agg(F.sum("n").alias("places")).join(patterns, "pattern", "left_semi")


def trusted_patterns(marks: DataFrame, docs: DataFrame, text_col: str, min_confidence: float, min_support: int, rounds: int, task_entries: int) -> DataFrame:
    """``(pattern, confidence)`` of the patterns that the graph's scores trust.

    confidence: the scores of the strings at a pattern's places, over the
    number of all its places and one more.  Seeds score 1, another string
    1 - product(1 - confidence) over its trusted patterns.  A pattern is trusted
    with ``min_confidence`` and ``min_support`` different strings that score as
    much.  Each round's trusted strings support patterns of the next.
    """
    each = marks.where(F.size("mentions") > 0).select(F.explode("mentions").alias("m"))
    edges = each.select(F.explode("m.patterns").alias("pattern"), "m.instance", F.col("m.kind").isNotNull().cast("double").alias("seed"))
    edges = written(edges.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed")), "pii-edges")
    most = written(edges.groupBy("pattern").agg(F.sum("n").alias("most"), F.count("*").alias("strings")).where(F.col("strings") >= min_support).select("pattern", "most"), "pii-candidates")
    places = places_of(docs, text_col, most.select("pattern"), task_entries)
    # even with every string trusted the others can't reach the bounds
    able = most.join(places, "pattern").where(F.col("most") >= min_confidence * (F.col("places") + 1))
    edges = written(edges.join(able.select("pattern", "places"), "pattern").withColumn("score", F.col("seed")), "pii-edges")
    trusted, before = None, None
    for _ in range(rounds):
        scored = edges.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / (F.first("places") + 1)).alias("confidence"),
            F.count(F.when(F.col("score") >= min_confidence, 1)).alias("support"),
        )
        trusted = written(scored.where((F.col("confidence") >= min_confidence) & (F.col("support") >= min_support)).select("pattern", "confidence"), "pii-patterns")
        now = trusted.count()
        if now == before or now == 0:
            break
        before = now
        doubt = F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))
        scores = edges.join(trusted, "pattern").groupBy("instance").agg((1 - doubt).alias("now"))
        edges = written(edges.join(scores, "instance", "left").select("pattern", "instance", "n", "seed", "places", F.when(F.col("seed") == 1, F.lit(1.0)).otherwise(F.coalesce("now", F.lit(0.0))).alias("score")), "pii-edges")
    return trusted


def personal_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 6,
    min_confidence: float = 0.8,
    min_support: int = 3,
    rounds: int = 3,
    task_entries: int = 400_000,
) -> DataFrame:
    """``(id, text_hash, base, spans)`` for each row of ``docs``, repeated rows too.

    base: the spans (kind, start, end) found by form; spans: these, the secrets
    and the strings beside trusted patterns (kind ``context``); both by kind
    in the order of ``KINDS``, then start, in code points.  A null or empty text
    has none.  Further columns are not read; no rows give no rows.
    """
    rows = written(marked(docs, id_col, text_col, min_length), "pii-marks")
    trusted = trusted_patterns(rows, docs, text_col, min_confidence, min_support, rounds, task_entries)
    others = rows.where(F.size("mentions") > 0).select("row", F.explode(F.filter("mentions", lambda m: m["kind"].isNull())).alias("m"))
    beside = others.select("row", "m.start", "m.end", F.explode("m.patterns").alias("pattern")).join(trusted.select("pattern"), "pattern")
    more = beside.groupBy("row").agg(F.array_sort(F.collect_set(F.struct(F.lit("context").alias("kind"), "start", "end"))).alias("more"))
    secrets = F.transform(F.filter("mentions", lambda m: m["kind"] == "secret"), lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    spans = F.concat("base", secrets, F.coalesce("more", F.slice(F.col("base"), 1, 0)))
    return rows.join(more, "row", "left").select(F.col("id").alias(id_col), "text_hash", "base", spans.alias("spans"))


def listed(spans: Column) -> Column:
    """The spans as text, ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each stretch that spans cover replaced by ``[kind]`` of the
    span that starts first (of these the first kind); all rows and columns stay."""
    found = personal_spans(docs, id_col, text_col, **options).where(F.size("spans") > 0)
    taken = ["key", "hash", "spans"]
    while set(taken) & set(docs.columns):
        taken = [f"{x}_" for x in taken]
    key, hashed, spans = taken
    found = found.select(F.col(id_col).alias(key), F.col("text_hash").alias(hashed), F.col("spans").alias(spans)).dropDuplicates([key, hashed])
    joined = docs.join(found, docs[id_col].eqNullSafe(F.col(key)) & (F.xxhash64(docs[text_col]) == F.col(hashed)), "left")
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].cast("int").alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"), s["end"].cast("int").alias("end"), s["kind"].alias("kind"))))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(s: Column, x: Column) -> Column:
        tail = F.concat(docs[text_col].substr(s["at"] + 1, x["start"] - s["at"]), F.lit("["), x["kind"], F.lit("]"))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] < s["at"], s["done"]).otherwise(F.concat(s["done"], tail)).alias("done"))

    text = F.aggregate(by_start, state, step, lambda s: F.concat(s["done"], docs[text_col].substr(s["at"] + 1, F.length(docs[text_col]))))
    return joined.select(*[F.when(F.col(key).isNull() & F.col(spans).isNull(), docs[c]).otherwise(text).alias(c) if c == text_col else docs[c] for c in docs.columns])
