"""Licence scan by ordered signature rules, with DataFrame functions only.

A rule's gate, a literal, is looked for first, in a lower-cased copy with one
blank for each run of white space; only rules whose gate that has are tried, on
the text itself.  A detection inside the interval of another one of the same or
a stronger priority is suppressed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let
from .license_rules import Rule, rules

#: what separates words, once A-Z are lower-cased
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: the runs of white space (a regex's \s+) that aren't one blank
WRAPPED = r"[\t\n\x0B\f\r]\s*| \s+"
#: phrases and their base labels
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
_DETECTION = "array<struct<begin:bigint,neg_stop:bigint,priority:int,label:string,confidence:double>>"


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, n: total + n)


def _running(lengths: Column) -> Column:
    """The sum of all entries before each; in blocks, so that n entries take n ** 1.5 steps."""

    def whole(x: Column) -> Column:
        block = F.ceil(F.sqrt(F.size(x))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / block).cast("int")), lambda b: _sum(F.slice(x, b * block + 1, block)))
        starts = let(blocks, lambda s: F.transform(s, lambda _, b: _sum(F.slice(s, F.lit(1), b))))
        return let(
            F.struct(starts.alias("starts"), block.alias("block")),
            lambda s: F.transform(
                x,
                lambda _, i: F.get(s["starts"], F.floor(i / s["block"]).cast("int"))
                + _sum(F.slice(x, (i - F.pmod(i, s["block"])) + 1, F.pmod(i, s["block"]))),
            ),
        )

    return let(lengths, lambda x: F.when(F.size(x) > 0, whole(x)).otherwise(F.array().cast("array<bigint>")))


def _matches(text: Column, rule: Column) -> Column:
    """All places of a rule's regex in a text."""
    both = F.struct(F.split(text, rule["regex"], -1).alias("between"), F.regexp_extract_all(text, rule["regex"], F.lit(0)).alias("found"))

    def placed(x: Column) -> Column:
        steps = F.transform(x["found"], lambda m, i: (F.char_length(m) + F.char_length(F.get(x["between"], i))).cast("long"))
        return F.transform(
            F.arrays_zip(_running(steps).alias("before"), x["found"].alias("m")),
            lambda z, i: F.struct(
                (z["before"] + F.char_length(F.get(x["between"], i))).alias("begin"),
                (-(z["before"] + F.char_length(F.get(x["between"], i)) + F.char_length(z["m"]))).cast("bigint").alias("neg_stop"),
                rule["priority"].alias("priority"),
                rule["label"].alias("label"),
                rule["confidence"].alias("confidence"),
            ),
        )

    return F.when(F.rlike(text, rule["regex"]), let(both, placed)).otherwise(F.array().cast(_DETECTION))


def detections(text: Column, signatures: list[Rule]) -> Column:
    """array of (begin, neg_stop, priority, label, confidence), sorted: what contains a detection stands before it."""
    gates = F.array(*[F.lit(g) for g in sorted({r.gate for r in signatures})])
    table = F.array(
        *[
            F.struct(F.lit(r.gate).alias("gate"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(r.confidence).alias("confidence"), F.lit(r.regex).alias("regex"))
            for r in signatures
        ]
    )
    open_gates = let(F.regexp_replace(F.lower(text), WRAPPED, " "), lambda low: F.filter(gates, lambda g: F.contains(low, g)))

    def tried(open_: Column) -> Column:
        chosen = F.filter(table, lambda r: F.array_contains(open_, r["gate"]))
        return F.sort_array(F.flatten(F.transform(chosen, lambda r: _matches(text, r))))

    return let(open_gates, lambda g: F.when(F.size(g) > 0, tried(g)).otherwise(F.array().cast(_DETECTION)))


def kept(found: Column) -> Column:
    """struct of labels (distinct), n (detections that stay), confidence (the highest): one sweep with the furthest end of each priority."""
    start = F.struct(
        F.array(*[F.lit(0).cast("long")] * 3).alias("ends"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0).cast("long").alias("n"),
        F.lit(0.0).alias("confidence"),
    )

    def step(at: Column, d: Column) -> Column:
        stop = -d["neg_stop"]
        inside = F.array_max(F.slice(at["ends"], F.lit(1), d["priority"])) >= stop
        return F.struct(
            F.transform(at["ends"], lambda e, i: F.when(i + 1 == d["priority"], F.greatest(e, stop)).otherwise(e)).alias("ends"),
            F.when(inside, at["labels"]).otherwise(F.array_union(at["labels"], F.array(d["label"]))).alias("labels"),
            F.when(inside, at["n"]).otherwise(at["n"] + 1).alias("n"),
            F.when(inside, at["confidence"]).otherwise(F.greatest(at["confidence"], d["confidence"])).alias("confidence"),
        )

    return F.aggregate(found, start, step)


def _places(text: Column) -> Column:
    """struct of n_base, first_word, last_word and base labels from a text that has a phrase, perhaps."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # " mit license mit ": one blank before, between and after words
    padded = F.concat(F.lit(" "), F.regexp_replace(F.concat(F.lit(" "), F.translate(text, upper, lower), F.lit(" ")), NO_WORD, " "), F.lit(" "))
    padded = F.regexp_replace(padded, "^ +| +\\z", " ")

    def blanks(x: Column) -> Column:
        return F.char_length(x) - F.char_length(F.replace(x, F.lit(" "), F.lit("")))

    def of(p: Column) -> Column:
        rows = []
        for phrase, label in PHRASES.items():
            here = F.contains(p, F.lit(f" {phrase} "))
            size = len(phrase.split())
            rows.append(
                F.when(
                    here,
                    F.struct(
                        F.size(F.regexp_extract_all(p, F.lit(f" {phrase}(?= )"), F.lit(0))).cast("long").alias("n"),
                        blanks(F.substring_index(p, f" {phrase} ", 1)).cast("long").alias("first"),
                        # the blanks before the last place: all, less those of the phrase and behind it
                        (blanks(p) - 1 - size - blanks(F.substring_index(p, f" {phrase} ", -1))).cast("long").alias("last"),
                        F.lit(label).alias("label"),
                    ),
                )
            )
        return F.filter(F.array(*rows), lambda x: x.isNotNull())

    def summed(x: Column) -> Column:
        return F.struct(
            _sum(F.transform(x, lambda r: r["n"])).alias("n_base"),
            F.array_min(F.transform(x, lambda r: r["first"])).alias("first_word"),
            F.array_max(F.transform(x, lambda r: r["last"])).alias("last_word"),
            F.transform(x, lambda r: r["label"]).alias("labels"),
        )

    return let(let(padded, of), summed)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """``(id, n_words, n_base, first_word, last_word, base_labels, labels, n_detections, score)`` of every row.

    Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased (A-Z) text.
    Base: where the words of a phrase stand one after the other.  labels also
    has those of the detections that stay; score is the highest confidence
    (0.5 at least with a base label, 0 with none).  Null and empty texts have
    no words, null places and empty labels; repeated rows are scanned each.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.size(F.regexp_extract_all(text, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))).cast("long")
    none = F.struct(F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"), F.lit(None).cast("long").alias("last_word"), F.array().cast("array<string>").alias("labels"))
    maybe = text.rlike(rf"(?i)(?:mit|apache|general{NO_WORD}public){NO_WORD}license")
    rows = docs.select(
        F.col(id_col),
        words.alias("n_words"),
        F.when(maybe, _places(text)).otherwise(none).alias("base"),
        kept(detections(text, signatures or rules())).alias("kept"),
    )
    joined = F.sort_array(F.array_union(F.col("base.labels"), F.col("kept.labels")))
    return rows.select(
        id_col,
        "n_words",
        F.col("base.n_base"),
        F.col("base.first_word"),
        F.col("base.last_word"),
        F.array_join(F.sort_array(F.col("base.labels")), ",").alias("base_labels"),
        F.array_join(joined, ",").alias("labels"),
        F.col("kept.n").alias("n_detections"),
        F.greatest(F.col("kept.confidence"), F.when(F.col("base.n_base") > 0, 0.5).otherwise(0.0)).alias("score"),
    )
