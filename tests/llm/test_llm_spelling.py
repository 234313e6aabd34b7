"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import pytest

from ledgerflow.llm import queries, spelling


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=10):
    forms, rows = {}, []
    for w in counts:
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            forms[w] = best
        rows.append((w, len(others)))

    def root(w):
        while w in forms:
            w = forms[w]
        return w

    return sorted((w, forms.get(w), root(w), counts[w], n, counts.get(forms.get(w))) for w, n in rows)


def vocabulary(r, n, letters="abé", longest=9):
    return {"".join(r.choice(letters) for _ in range(r.randint(1, longest))): r.choice([2, 3, 25, 300, 4000]) for _ in range(n)}


def test_acceptor_is_minimal_and_pairs_are_complete():
    r = random.Random(3)
    for _ in range(300):
        words = sorted(vocabulary(r, r.randint(0, 25), "ab", 6))
        a = spelling.Acceptor(words)
        live, todo = set(), [(0, "")]
        accepted = []
        while todo:
            p, before = todo.pop()
            live.add(p)
            accepted += [before] if a.final[p] else []
            todo += [(to, before + x) for x, to in a.arcs[p].items()]
        assert sorted(accepted) == words
        # no two states have the same rests
        rests = {}
        for p in live:
            found, todo = set(), [(p, "")]
            while todo:
                q, before = todo.pop()
                found |= {before} if a.final[q] else set()
                todo += [(to, before + x) for x, to in a.arcs[q].items()]
            rests[p] = frozenset(found)
        assert len(set(rests.values())) == len(live)
        pairs = list(spelling.near_pairs(words, 10))
        assert len(pairs) == len(set(pairs))
        assert {frozenset(x) for x in pairs} == {frozenset((x, y)) for x in words for y in words if near(x, y)}


@pytest.mark.parametrize("most", [16_384, 3])
def test_variants(spark, most):
    r = random.Random(4)
    counts = vocabulary(r, 220)
    counts |= {"y" * 200: 5, "y" * 201: 50, "y" * 199 + "z": 500, "z" + "y" * 199: 9, "q" * 3000: 2, "q" * 3001: 30}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(words, most=most).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == brute_variants(counts)


def test_no_words(spark):
    words = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(words).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(words, ratio=1)


def test_query_on_awkward_rows(spark, scratch):
    r = random.Random(5)
    names = ["Tegucigalpa", "tegucigalp", "straßenbahn", "Éclairage", "éclairage", "ÉCLAIRAGE", "abcdefg", "abcdefgh", "short", "×÷×÷×÷×÷", "y" * 5000]
    texts = [None, "", "  ", "123 456", *[" ".join(r.choice(names) + r.choice(["", ".", "1", "-x"]) for _ in range(r.choice([1, 5, 200]))) for _ in range(40)]]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, texts[8], None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n string, size long").repartition(4)
    docs.write.parquet(f"{scratch}/documents.parquet")
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    got = queries.op12_spelling_variants(spark, scratch)
    assert sorted(map(tuple, got.collect())) == brute_variants(counts)
    assert len(counts) > 8
    docs.limit(0).write.parquet(f"{scratch}/none/documents.parquet")
    assert queries.op12_spelling_variants(spark, f"{scratch}/none").count() == 0


def test_a_task_hands_on_what_it_holds(spark):
    docs = spark.createDataFrame([(i, f"word{'x' * i} common") for i in range(50)], "doc_id long, text string").coalesce(1)
    got = spelling.counted_words(docs, "[a-z]+", lambda _, run: run, 1, task_entries=3)
    assert {x.word: x.n for x in got.collect()} == Counter(w for x in docs.collect() for w in x.text.split())
