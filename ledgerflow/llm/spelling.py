"""Spelling variants by finite-state composition.

Two words at one edit are a path of ``A o E o A``: the minimised acceptor of the
vocabulary, a transducer that makes one edit, the acceptor again.  Up to the
edit both sides read the same letters, so the states of the composition are
pairs ``(p, p)`` before the edit and ``(p, q)`` after it.  A partition is one
initial state: the state that a fixed first part of the words leads to,
together with the last part that must follow, and the places between in which
the edit may fall.  The two halves of the places of a word give two partitions;
one with too many words is opened further, down to a single place.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: bytes: A-Z to a-z, all else as it is
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def counted_words(docs: DataFrame, runs: str, spelt, min_length: int, id_col: str = "doc_id", text_col: str = "text", task_entries: int = 200_000) -> DataFrame:
    """``(word, n)`` of the words of at least ``min_length`` code points of all whole texts.

    runs: pattern of a run.  spelt(id, run): the word that a run (A-Z
    lower-cased) of this document stands for.  A task adds up at most about
    ``task_entries`` words at a time before it hands them on, so that a
    frequent word costs a row or few a task.  A null text has no words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        pattern, held = re.compile(runs), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                for r, n in Counter(pattern.findall((raw.as_py() or b"").translate(LOWER).decode())).items():
                    if len(r) >= min_length and len(w := spelt(doc, r)) >= min_length:
                        held[w] += n
                if len(held) > task_entries:
                    yield out()
                    held.clear()
        yield out()

    columns = docs.select(F.col(id_col).cast("string"), F.coalesce(F.col(text_col), F.lit("")))
    return columns.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def with_lost_letters(doc: str | None, run: str, one_in: int = 31) -> str:
    """The run without one code point, for one in ``one_in`` of the (document, run)s
    by their checksum; a null id counts as empty."""
    h = zlib.crc32(f"{doc or ''}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % one_in == 0 else run


class Acceptor:
    """The minimal acyclic acceptor of a set of words, built from their sorted list.

    States are numbered; ``arcs[p]`` leads from letters to states, ``final[p]``
    tells whether a word ends.  State 0 is the initial one.
    """

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        path: list[tuple[int, str, int]] = []  # the arcs to the last word whose states may still change
        last = ""

        def settle(depth: int) -> None:
            while len(path) > depth:
                parent, letter, state = path.pop()
                same = known.setdefault((self.final[state], tuple(self.arcs[state].items())), state)
                self.arcs[parent][letter] = same

        for word in words:
            shared = 0
            while shared < min(len(word), len(last)) and word[shared] == last[shared]:
                shared += 1
            settle(shared)
            state = path[-1][2] if path else 0
            for letter in word[shared:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[state][letter] = len(self.arcs) - 1
                path.append((state, letter, len(self.arcs) - 1))
                state = len(self.arcs) - 1
            self.final[state] = True
            last = word
        settle(0)


def near_pairs(words: list[str], places: int) -> Iterator[tuple[str, str]]:
    """Each pair of words with exactly one code point inserted or replaced whose
    first difference is at one of the first ``places`` places, once; the
    shorter, or of two replaced the smaller, word first.

    words: without repeats, in order.  The pairs are the accepted paths of the
    composition, enumerated from its initial state.
    """
    acceptor = Acceptor(words)
    arcs, final = acceptor.arcs, acceptor.final
    shared: dict[tuple[int, int], tuple[str, ...]] = {}

    def rests(p: int, q: int) -> tuple[str, ...]:
        """The words that lead from both states to an end."""
        todo = [(p, q)]
        while todo:
            a, b = todo[-1]
            both = [(letter, (to, arcs[b][letter])) for letter, to in arcs[a].items() if letter in arcs[b]]
            if missing := [pair for _, pair in both if pair not in shared]:
                todo.extend(missing)
                continue
            here = ("",) if final[a] and final[b] else ()
            shared[todo.pop()] = here + tuple(letter + x for letter, pair in both for x in shared[pair])
        return shared[p, q]

    def edits(p: int) -> list[tuple[str, str]]:
        """The two sides' rests, where the edit comes next in state ``p``."""
        out = []
        letters = sorted(arcs[p])
        for k, x in enumerate(letters):
            for y in letters[k + 1 :]:
                out.extend((x + r, y + r) for r in rests(arcs[p][x], arcs[p][y]))
            # x inserted; a rest that starts with x itself would differ further on
            out.extend((r, x + r) for r in rests(p, arcs[p][x]) if r[:1] != x)
        return out

    at: dict[int, list[tuple[str, str]]] = {}
    todo = [(0, "")]
    while todo:
        p, before = todo.pop()
        if p not in at:
            at[p] = edits(p)
        yield from ((before + x, before + y) for x, y in at[p])
        if len(before) + 1 < places:
            todo.extend((to, before + letter) for letter, to in arcs[p].items())


def _opened(rows: DataFrame, middle) -> DataFrame:
    """The two partitions that parting the places of each row's partition gives."""
    parted = rows.withColumn("m", middle)
    halves = F.array(F.struct(F.col("i").alias("i"), F.col("m").alias("j")), F.struct(F.col("m").alias("i"), F.col("j").alias("j")))
    return parted.withColumn("half", F.explode(halves)).select("word", "n", "size", F.col("half.i").alias("i"), F.col("half.j").alias("j")).where("i < j")


def _keyed(rows: DataFrame) -> DataFrame:
    """With the parts of the word that a partition fixes: ``i`` letters, and those
    that follow the last place (``size`` letters has the shorter of two words)."""
    tail = F.greatest(F.lit(0), F.col("size") - F.col("j"))
    return rows.withColumns({"head": F.expr("substring(word, 1, i)"), "tail": F.when(tail == 0, "").otherwise(F.expr("right(word, greatest(0, size - j))"))})


_KEY = ["size", "i", "j", "head", "tail"]


def partitions(words: DataFrame, most: int = 16_384, most_places: int = 64) -> DataFrame:
    """``(size, i, j, head, tail, words)``: the initial states and their words ``(word, n)``.

    ``words`` holds the words of ``size`` letters and of one more that start
    with ``head`` and end with ``tail``; their pairs differ first at a place
    from ``i`` up to ``j``.  Each pair of near words is in one partition.  A
    partition of more than ``most`` words or ``most_places`` places is opened
    into two.  With one place words differ in at most two letters, so there are
    at most as many as pairs of letters, whatever the input.
    """
    length = F.length("word")
    # a word is the shorter (or equal) one of its own size and the longer one of the size below
    sized = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("size"), F.lit(0).alias("i"))
    rows = written(_keyed(_opened(sized.withColumn("j", F.col("size") + 1), F.greatest(F.lit(1), F.floor(F.col("size") / 2).cast("int")))), "spelling-states")
    done = None
    while True:
        counts = rows.groupBy(*_KEY).agg(F.count("*").alias("many"), F.min(F.length("word") - F.col("size")).alias("shortest"))
        # words that are all of the longer kind make no pair here
        places = F.col("j") - F.col("i")
        hot = (places > most_places) | ((F.col("many") > most) & (places > 1))
        counts = counts.where((F.col("many") > 1) & (F.col("shortest") == 0)).select(*_KEY, hot.alias("hot"))
        marked = written(rows.join(counts, _KEY), "spelling-states")
        cool = marked.where(~F.col("hot")).drop("hot")
        done = cool if done is None else done.unionByName(cool)
        hot = marked.where("hot")
        if hot.isEmpty():
            break
        rows = written(_keyed(_opened(hot, F.floor((F.col("i") + F.col("j")) / 2).cast("int"))), "spelling-states")
    return done.groupBy(*_KEY).agg(F.collect_list(F.struct("word", "n")).alias("words"))


def near_words(words: DataFrame, most: int = 16_384) -> DataFrame:
    """``(word, n, near, near_n)``: every ordered pair of near words.

    words: ``(word, n)``, each word once.  Two words are near if exactly one
    code point is inserted, deleted or replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()) * 2, strict=True)], names=["word", "n", "near", "near_n"])

        for batch in batches:
            rows: list[tuple] = []
            for part in batch.to_pylist():
                counts = {x["word"]: x["n"] for x in part["words"]}
                head, tail = part["head"], part["tail"]
                middles = sorted(w[len(head) : len(w) - len(tail)] for w in counts)
                for x, y in near_pairs(middles, part["j"] - part["i"]):
                    x, y = head + x + tail, head + y + tail
                    # two words of the longer kind have a partition of their own size
                    if len(x) == part["size"]:
                        rows += [(x, counts[x], y, counts[y]), (y, counts[y], x, counts[x])]
                if len(rows) > 100_000:
                    yield out(rows)
                    rows = []
            yield out(rows)

    return partitions(words, most).mapInArrow(run, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for each word that has a form: the last of its chain of forms.

    A form is at least ``ratio`` times as frequent, so a chain has few words;
    each round doubles the distance that is covered.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = written(reached.join(on, "root", "left"), "spelling-roots")
        if joined.where("further is not null").isEmpty():
            return joined.select("word", "root")
        reached = joined.select("word", F.coalesce("further", "root").alias("root"))


def variants(words: DataFrame, ratio: int = 10, most: int = 16_384) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of each word.

    words: ``(word, n)``, each word once.  form: the near word of the largest n
    (of equal ones the first by code points) if that is ``ratio`` times the
    word's or more, else null; root: the last of the chain of forms, the word
    itself without one.  No words give no rows.
    """
    if ratio < 2:
        raise ValueError("ratio: 2 or more, so that forms lead to an end")
    near = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    found = written(found, "spelling-forms")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, runs: str, spelt, min_length: int = 7, min_count: int = 2, ratio: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of all texts that have ``min_length`` code points
    and ``min_count`` occurrences; see ``counted_words`` for runs and spelt.

    Null and empty texts have no words; each of repeated rows counts; further
    columns are not read; an empty table gives no rows.
    """
    words = counted_words(docs, runs, spelt, min_length, id_col, text_col).where(F.col("n") >= min_count)
    return variants(written(words, "spelling-words"), ratio)
