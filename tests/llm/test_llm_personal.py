"""Personal data: spans found by form against plain regular expressions, bootstrapping against a brute-force version."""

import hashlib
import math
import random
import re
import time
from collections import defaultdict

import pytest

from ledgerflow.llm import personal, queries


def luhn(digits):
    total = sum(int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def brute_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans():
    r = random.Random(6)
    pieces = ["a@b.c", "@", "x.y+z@mail", ".example.com", "1.2.3.4", "256.1.1.1", "0001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (663) 555-6869", "+", "é", " ", "\n", "-", ".", "12", "9" * 20, "b@c.d@e.f", "5", "%"]
    for _ in range(4000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(0, 9)))
        assert personal.base_spans(text) == brute_base(text), text


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("x" * 300_000, "1" * 300_000, "+1" * 100_000, "1." * 100_000, "a@" * 100_000, "+" + "1 " * 100_000, "9" * 5000 + ".1.1.1"):
        personal.base_spans(text)
    assert time.time() - start < 20


def brute_mentions(text, min_length=6):
    """(kind, start, end, string, contexts)"""
    base = sorted({(s, e): k for k, s, e in brute_base(text)}.items())
    tokens = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    punct = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
    chosen, end = [], 0
    for (s, e), k in base:
        if s >= end:
            chosen.append((k, s, e))
        end = max(end, e)
    for a, b in tokens:
        if any(s < b and a < e for (s, e), _ in base):
            continue
        core = text[a:b].strip(punct)
        if len(core) >= min_length and len(re.findall("[0-9]", core)) >= 2:
            s = text.index(core, a)
            secret = re.fullmatch("[0-9a-f]{32,}", core) and re.search("[a-f]", core)
            chosen.append(("secret" if secret else None, s, s + len(core)))
    for k, s, e in chosen:
        first = max(i for i, t in enumerate(tokens) if t[0] <= s)
        last = min(i for i, t in enumerate(tokens) if t[1] >= e)
        opening, closing = text[tokens[first][0] : s], text[e : tokens[last][1]]
        form = lambda t: re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), text[slice(*t)]))
        contexts = []
        if first and all(c in punct for c in opening):
            contexts.append(("<", form(tokens[first - 1]), opening))
        if last + 1 < len(tokens) and all(c in punct for c in closing):
            contexts.append((">", form(tokens[last + 1]), closing))
        yield k, s, e, text[s:e], contexts


def brute_context_spans(texts, min_confidence=0.8, min_support=3, rounds=3):
    """Per text the set of (start, end) beside trusted patterns."""
    punct = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
    places, edges, seeds = defaultdict(int), defaultdict(int), set()
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        forms = [re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), w)) for w in words]
        for i in range(len(words) - 1):
            places["<", forms[i], words[i + 1][: len(words[i + 1]) - len(words[i + 1].lstrip(punct))]] += 1
            places[">", forms[i + 1], words[i][len(words[i].rstrip(punct)) :]] += 1
        for kind, _, _, string, contexts in brute_mentions(text):
            for c in contexts:
                edges[c, string] += 1
                if kind:
                    seeds.add((c, string))
    score = {e: float(e in seeds) for e in edges}
    trusted, before = {}, None
    for _ in range(rounds):
        mass, support = defaultdict(float), defaultdict(int)
        for (c, string), n in edges.items():
            mass[c] += n * score[c, string]
            support[c] += score[c, string] >= min_confidence
        trusted = {c: m / (places[c] + 1) for c, m in mass.items() if m / (places[c] + 1) >= min_confidence and support[c] >= min_support}
        if not trusted or len(trusted) == before:
            break
        before = len(trusted)
        doubt = defaultdict(float)
        for c, string in edges:
            if c in trusted:
                doubt[string] += math.log(1 - min(trusted[c], 0.999))
        score = {e: 1.0 if e in seeds else 1 - math.exp(doubt[e[1]]) if e[1] in doubt else 0.0 for e in edges}
    return [{(s, e) for k, s, e, _, contexts in brute_mentions(text) if k is None and any(c in trusted for c in contexts)} for text in texts]


def corpus():
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6)))
    prose = lambda: " ".join(word() for _ in range(r.randint(3, 30)))
    card = lambda: next(c for c in iter(lambda: "4" + "".join(r.choice("0123456789") for _ in range(15)), None) if luhn(c))
    hexa = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    texts = []
    for k in range(60):
        texts.append(f"{prose()} token = \"{hexa(40)}\" {prose()} Card-No: {card()}; {prose()}")
        if k % 6 == 0:
            texts.append(f"{prose()} token = \"Zx{r.randrange(10**6):06}-Q\" held {prose()} card-no: {r.randrange(10**11):011} {prose()}")
        if k % 5 == 0:
            texts.append(f"serial Zx{r.randrange(10**6):06}-Q and part 12345678 {prose()} on 2024-05-17. the {card()} {prose()}")
    # a second hop: strings first trusted beside "badge#" make "holder" a pattern
    for k in range(24):
        texts.append(f"{prose()} badge# {hexa(32)}a1 {prose()} badge# ID-{k:04}-77 {prose()} holder: ID-{k:04}-77 {prose()}")
        texts.append(" ".join(f"{prose()} badge# {hexa(33)}b2" for _ in range(8)))
    texts.append(f"{prose()} holder: XQ-991122 {prose()}")
    return texts + [None, "", " \n ", "12345678", "é" * 40 + " a1b2c3d4", texts[0], texts[1]]


def test_query_against_brute_force(spark, scratch):
    texts = corpus()
    rows = [(i, t, "own", None) for i, t in enumerate(texts)]
    rows += [rows[1], rows[1], (None, texts[2], None, None), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pattern string, mentions string").repartition(5)
    docs.write.parquet(f"{scratch}/documents.parquet")
    contexts = brute_context_spans([x[1] or "" for x in rows])
    want = []
    for (doc, text, *_), more in zip(rows, contexts, strict=True):
        base = brute_base(text or "")
        secrets = [("secret", s, e) for k, s, e, _, _ in brute_mentions(text or "") if k == "secret"]
        spans = base + secrets + [("context", s, e) for s, e in sorted(more)]
        sha, said = (",".join(f"{k}:{s}:{e}" for k, s, e in x) for x in (base, spans))
        want.append((doc, *(sum(k == kind for k, _, _ in base) for kind in personal.BASE), hashlib.sha256(sha.encode()).hexdigest(), said))
    got = queries.op11_personal_data(spark, scratch)
    columns = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(want, key=repr)
    found = {text[s:e] for (_, text, *_), more in zip(rows, contexts, strict=True) for s, e in more}
    assert any(x.startswith("Zx") for x in found) and "XQ-991122" in found, found  # in one and in two hops
    assert not found & {"12345678", "2024-05-17"}
    # the same strings stay where no trusted pattern stands
    assert all("serial" not in t or not m for t, m in zip((x[1] or "" for x in rows), contexts, strict=True))
    docs.limit(0).write.parquet(f"{scratch}/none/documents.parquet")
    assert queries.op11_personal_data(spark, f"{scratch}/none").count() == 0


def test_masked(spark):
    rows = [(1, "mail a.b@c.de or +1 (663) 555-6869, 1.2.3.4", "x"), (1, "mail a.b@c.de or +1 (663) 555-6869, 1.2.3.4", "y"), (2, "nothing", "z"), (None, "é 1.2.3.4 é", None), (None, None, None), (3, "", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    want = [(d, t and {"m": "mail [email] or [phone], [ip]", "é": "é [ip] é"}.get(t[0], t), k) for d, t, k in rows]
    got = personal.masked(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert personal.masked(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rounds", [1, 2])
def test_rounds(spark, rounds):
    texts = [t for t in corpus() if t]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: {(s.start, s.end) for s in x.spans if s.kind == "context"} for x in personal.personal_spans(docs, rounds=rounds, task_entries=10).collect()}
    assert [got[i] for i in range(len(texts))] == brute_context_spans(texts, rounds=rounds)
