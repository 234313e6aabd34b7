"""Quality rules combined by weak supervision.

Each rule votes good (1) or bad (-1) or abstains (0).  Expectation-maximisation
over the counted vote patterns estimates, for each rule, how often it is right
about good documents and about each kind of bad ones; the posterior probability
of "good" then decides, instead of a filter that every rule must pass.  Only DataFrame
functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, let, words_of, written

#: very common words of the languages that the corpus has
COMMON_WORDS = (
    "the of and to in a is that for it with as was on be by at from this are or an "
    "der die das und zu den von mit ist auf für ein eine nicht sich des dem im "
    "le la les et de des un une du en que pour est dans sur par au qui "
    "el los las y del por con para una se su al lo como"
).split()

SYMBOLS = r"[#*$%&|<>]+"


def _covered(words: Column) -> Column:
    """The number of words inside 3-word windows that the text has twice or more."""
    windows = F.when(
        F.size(words) >= 3,
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))

    def repeated(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(ordered, lambda s: F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        gaps = let(starts, lambda p: F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))))
        return F.aggregate(gaps, F.lit(0), lambda total, n: total + n)

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h)))


def _removed(text: Column, pattern: str) -> Column:
    """The characters of a text that a pattern takes."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, measures..)`` of every whole text; a null text measures as an empty one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\f\r"))) > 0)

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n_words"),
            F.char_length(F.array_join(w, "")).alias("word_chars"),
            _covered(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).alias("n_distinct_words"),
            F.size(F.array_intersect(w, F.array(*map(F.lit, COMMON_WORDS)))).alias("n_common_words"),
        )

    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    counted = docs.select(
        F.col(id_col),
        let(words_of(F.col(text_col)), of_words).alias("w"),
        of_lines.alias("l"),
        _removed(text, SYMBOLS).alias("n_symbols"),
        _removed(text, r"\p{Lu}+").alias("n_upper"),
        _removed(text, "[!?]+").alias("n_shouts"),
    )
    names = [("w", n) for n in ("n_words", "word_chars", "n_repeat_words", "n_distinct_words", "n_common_words")] + [("l", "n_lines"), ("l", "n_dup_lines")]
    return counted.select(id_col, *[F.col(f"{s}.{n}").cast("long").alias(n) for s, n in names], *[F.col(n).cast("long") for n in ("n_symbols", "n_upper", "n_shouts")])


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules over ``measures``; a text without words gets no vote but the first's."""
    n, some = F.col("n_words"), F.col("n_words") > 0

    def share(part: str, whole: str, bad: float, good: float) -> Column:
        ratio = F.col(part) / F.col(whole)
        return F.when(F.col(whole) > 0, _vote(ratio > bad, ratio < good)).otherwise(0)

    return {
        "length": _vote(n < 20, n >= 80),
        "symbols": share("n_symbols", "n_words", 0.1, 0.02),
        "repeated_lines": F.when(F.col("n_lines") > 1, share("n_dup_lines", "n_lines", 0.3, 0.05)).otherwise(0),
        "repeated_words": share("n_repeat_words", "n_words", 0.3, 0.1),
        "word_length": F.when(some, _vote((F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n), F.col("word_chars").between(3.5 * n, 7.5 * n))).otherwise(0),
        "capitals": share("n_upper", "word_chars", 0.3, 0.1),
        "shouting": share("n_shouts", "n_words", 0.2, 0.02),
        "common_words": F.when(n >= 20, _vote(F.col("n_common_words") == 0, F.col("n_common_words") >= 3)).otherwise(0),
        "variety": F.when(n >= 20, _vote(F.col("n_distinct_words") < 0.15 * n, F.col("n_distinct_words") > 0.35 * n)).otherwise(0),
    }


@dataclass(frozen=True)
class Model:
    """Latent classes: good documents, then one kind of bad ones for each rule.

    share[c]: of the documents; bad[c][j]: how often rule j, where it votes,
    votes bad on class c.  1 - bad[0][j] is its accuracy on good documents,
    bad[j + 1][j] that on its own kind of bad ones.
    """

    share: tuple[float, ...]
    bad: tuple[tuple[float, ...], ...]

    @classmethod
    def start(cls, n: int) -> Model:
        return cls((1 - 0.02 * n, *[0.02] * n), ((0.05,) * n, *[tuple(0.9 if j == k else 0.1 for j in range(n)) for k in range(n)]))

    def classes(self, rules: list[str]) -> Column:
        """array of the probability of each class, from the vote columns."""
        logs = F.array(*[F.struct(F.lit(math.log(s)).alias("share"), *[F.array(*[F.lit(math.log(f(x))) for x in b]).alias(k) for k, f in (("bad", float), ("good", lambda x: 1 - x))]) for s, b in zip(self.share, self.bad, strict=True)])
        votes = F.array(*[F.col(r).cast("int") for r in rules])

        def joint(c: Column) -> Column:
            said = F.arrays_zip(votes.alias("v"), c["bad"].alias("b"), c["good"].alias("g"))
            return F.aggregate(said, c["share"], lambda total, x: total + F.when(x["v"] < 0, x["b"]).when(x["v"] > 0, x["g"]).otherwise(0.0))

        powers = let(F.transform(logs, joint), lambda x: F.transform(x, lambda y: F.exp(y - F.array_max(x))))
        return let(powers, lambda p: let(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(p, lambda x: x / total)))

    def posterior(self, rules: list[str]) -> Column:
        """The probability of "good"."""
        return self.classes(rules)[0]


def fit(voted: DataFrame, rules: list[str], rounds: int = 80, tolerance: float = 5e-4, belief: float = 0.005) -> Model:
    """EM over the counted vote patterns (at most 3 ** rules rows).

    A round is one grouped aggregation over the patterns, in a fixed order so
    that reruns agree.  Shares and accuracies are free: the starting belief
    (``Model.start``) counts as ``belief`` times the documents do, at every
    size, and only tells the classes apart.  So a rule that also fires on
    documents that all others like is learned to raise false alarms and can be
    outvoted; rules that fire together do so within one kind of bad documents,
    and count there once.  Without documents the starting belief stays.
    """
    n = len(rules)
    patterns = checkpointed(voted.groupBy(*rules).agg(F.count("*").alias("n")).repartition(1).sortWithinPartitions(*rules))
    model = before = Model.start(n)

    def free(found: float, of: float, start: float, weight: float) -> float:
        return round(min(max((found + weight * start) / (of + weight), 1e-9), 1 - 1e-9), 9)

    for _ in range(rounds):
        by_class = patterns.select("n", F.array(*rules).alias("votes"), F.posexplode(model.classes(rules)).alias("c", "p"))
        by_rule = by_class.select("c", (F.col("n") * F.col("p")).alias("w"), F.posexplode("votes").alias("j", "vote"))
        sums = by_rule.groupBy("c", "j").agg(
            F.sum("w").alias("all"), F.sum(F.when(F.col("vote") != 0, F.col("w")).otherwise(0.0)).alias("voted"), F.sum(F.when(F.col("vote") < 0, F.col("w")).otherwise(0.0)).alias("bad")
        )
        found = {(r["c"], r["j"]): r for r in sums.collect()}
        if not found:
            break
        total = sum(found[c, 0]["all"] for c in range(n + 1))
        weight = belief * total
        bad = tuple(tuple(free(found[c, j]["bad"], found[c, j]["voted"], before.bad[c][j], weight) for j in range(n)) for c in range(n + 1))
        new = Model(tuple(free(found[c, 0]["all"], total, before.share[c], weight) for c in range(n + 1)), bad)
        moved = max(abs(x - y) for a, b in zip((new.share, *new.bad), (model.share, *model.bad), strict=True) for x, y in zip(a, b, strict=True))
        model = new
        if moved < tolerance:
            break
    return model


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``(id, measures.., votes.., base_failed, posterior, kept)`` of every row.

    base_failed: fewer than 50 words, or over half of them in repeated 3-word
    windows.  kept: not base_failed, and the posterior is at least
    ``threshold``.  Null and empty texts fail the base; repeated rows vote
    and count each; no rows give none.
    """
    rules = votes()
    voted = written(measures(docs, id_col, text_col).select("*", *[v.cast("tinyint").alias(f"vote_{r}") for r, v in rules.items()]), "quality-votes")
    columns = [f"vote_{r}" for r in rules]
    model = fit(voted, columns)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = voted.withColumns({"base_failed": failed, "posterior": model.posterior(columns)})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
