"""Scores against independent loops: the fused posterior of languages, the network; memory of decontamination's blocks."""

import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, language, quality_cnn


def brute_posteriors(rows, languages, ll, damping, strength=8.0):
    """rows: (url, declared, hint, host, domain); ll: damped log likelihoods by row."""
    n = len(languages)

    def softmax(x):
        p = np.exp(x - x.max())
        return p / p.sum()

    q = np.array([softmax(x) for x in ll])
    overall = (q.sum(axis=0).round(6) + 1) / (q.sum() + n)

    def table(column):
        values = [*languages, "other", "none"]
        counts = np.array([[sum(q[i][j] for i, r in enumerate(rows) if r[column] == v) for j in range(n)] for v in values])
        for k, lang in enumerate(languages):
            counts[k][k] += 4
        counts += 1
        return {v: np.log(c) for v, c in zip(values, counts / counts.sum(axis=0))}

    told, hinted, out = table(0), table(1), []
    for i, (declared, hint, host, domain) in enumerate(rows):
        prior = overall
        for column, key in ((3, domain), (2, host)):
            others = sum((q[k] for k in range(len(rows)) if rows[k][column] == key and rows[k][2] is not None and k != i), np.zeros(n)) if host else np.zeros(n)
            prior = (others + strength * prior) / (others.sum() + strength)
        out.append(softmax(ll[i] + np.log(prior) + told[declared] + hinted[hint]))
    return out


@pytest.mark.parametrize("hot", [1, 1000])
def test_fused_posterior(spark, monkeypatch, hot):
    """hot 1: no host is hot, 1000: all are."""
    monkeypatch.setattr(language, "HOT_HOSTS", hot)
    r = random.Random(12)
    voices = {"aa": "ba bo bi", "bb": "ba ku ke", "cc": "ze zo zi"}
    train = [(i, " ".join(r.choice(voices[x].split()) for _ in range(50)), x) for i, x in enumerate(list(voices) * 15)]
    model = language.profiles(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    pages, facts = [], []
    for i in range(60):
        lang, host = r.choice(list(voices)), r.choice(["aa.x.org", "b.x.org", "c.y.cc", None])
        told = r.choice([lang, "qq", None])
        text = " ".join(r.choice(voices[lang].split()) for _ in range(r.choice([0, 2, 5])))
        url = f"http://{host}/{r.choice(['p', lang + '/p'])}" if host else "nowhere"
        pages.append((i, url, (f"<html class='{'x' * 3000}' lang={told}>" if told else "<html>") + text))
        hint = url.split("/")[3] if url.count("/") > 3 else (host or "").rsplit(".", 1)[-1]
        facts.append(({"qq": "other", None: "none"}.get(told, told), hint if hint in voices else "other" if len(hint) == 2 else "none", host, ".".join(host.split(".")[-2:]) if host else None))
    ll = [model.likelihoods(h.encode(), 0.1) for _, _, h in pages]
    want = brute_posteriors(facts, model.languages, ll, 0.1)
    got = {x.page_id: x for x in language.identify(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), model).collect()}
    assert len(got) == len(pages)
    for i, p in enumerate(want):
        assert (got[i].declared, got[i].hint, got[i].host) == facts[i][:3]
        assert abs(got[i].probability - p.max()) < 1e-5 and (got[i].lang == model.languages[p.argmax()] or sorted(p)[-1] - sorted(p)[-2] < 1e-5)


def test_declared_languages_of_all_forms(spark):
    far = "x" * 5000
    pages = [
        f'<html data-a="{far}" lang="cc">',
        '<HTML xml:lang="cc" class=a>',
        f'<meta name="{far}" http-equiv="Content-Language" content="cc-DE">',
        '<meta content="cc" http-equiv=content-language>',
        '<html data-lang="aa"><body lang="aa">',
        "<html" * 20_000,
        "<meta" * 20_000 + ' content="aa"',
    ]
    model = language.Profiles(["aa", "cc"], np.zeros((language.BUCKETS, 2), np.float32))
    rows = spark.createDataFrame([(i, "http://h.example/", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    got = {x.page_id: x.declared for x in language.identify(rows, model).collect()}
    assert got == {0: "cc", 1: "cc", 2: "cc", 3: "cc", 4: "none", 5: "none", 6: "none"}


def test_a_rare_language_has_a_profile(spark):
    rows = [(i, "ba bo bi " * 5, "aa") for i in range(3000)] + [(5000, "ze zo zi " * 5, "cc"), (5001, None, "dd"), (5002, "x y z", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.profiles(docs, rows=20)
    assert model.languages == ["aa", "cc"]
    same = language.profiles(docs.repartition(7), rows=20)
    assert np.array_equal(model.log_p, same.log_p)


def loop_score(net, raw):
    chunk, step = quality_cnn.CHUNK, quality_cnn.STEP
    starts = [0] if len(raw) <= chunk else [*range(0, len(raw) - chunk, step), len(raw) - chunk]
    logits = []
    for at in starts:
        data = list(raw[at : at + chunk]) + [0] * (chunk - len(raw[at : at + chunk]))
        best = [0.0] * quality_cnn.FILTERS
        for p in range(quality_cnn.POSITIONS):
            first = p * quality_cnn.STRIDE
            inputs = [float(x) for b in data[first : first + quality_cnn.WIDTH] for x in net.embedding[b]]
            for lag in quality_cnn.LAGS:
                span = range(first, min(chunk, first + quality_cnn.SPAN))
                # a group of four bytes counts only where a filter can start
                span = [i for i in span if i // quality_cnn.STRIDE < p + quality_cnn.SPAN // quality_cnn.STRIDE]
                inputs.append(sum(i >= lag and data[i] == data[i - lag] and data[i] != 0 for i in span) / quality_cnn.SPAN)
            for f in range(quality_cnn.FILTERS):
                best[f] = max(best[f], sum(x * float(w) for x, w in zip(inputs, net.filters[:, f])) + float(net.bias[f]))
        logits.append(min(12.0, max(-12.0, sum(b * float(d) for b, d in zip(best, net.dense)) + net.offset)))
    a, mean, least = net.combine
    return 1 / (1 + math.exp(-(a + mean * sum(logits) / len(logits) + least * min(logits))))


def test_network_against_a_loop(spark):
    net = quality_cnn.Network.new(3)
    net.bias += np.linspace(-0.3, 0.3, quality_cnn.FILTERS).astype(np.float32)
    net.offset, net.combine = 0.2, (0.1, 0.7, 0.4)
    r = random.Random(4)
    texts = ["", "a", "abab" * 30, "".join(r.choice("abc é") for _ in range(700)), "x" * 300, None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.score for x in quality_cnn.scored(rows, net).collect()}
    for i, t in enumerate(texts):
        assert abs(got[i] - loop_score(net, (t or "").encode())) < 1e-4, i


def test_a_repeated_id_pushes_no_other_out(spark):
    docs = spark.createDataFrame([(1, f"copy {i}", None) for i in range(50)] + [(i, f"text {i}", None) for i in range(2, 9)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, quality int")
    kept = [i for i in range(1, 9) if zlib.crc32(str(i).encode()) % 5]
    pieces, y = quality_cnn.training_rows(docs, labels, "doc_id", "text", "quality", 100, 8)
    assert len(pieces) == len(y) == len(kept) and y == [i % 2 for i in kept]


def test_blocks_bound_memory(spark):
    """Six blocks and an item larger than a block: one block's arrays at a time in the driver, the same result as one block."""
    r = random.Random(5)
    words = lambda n: " ".join(f"w{r.randrange(60_000)}" for _ in range(n))
    items = [(str(i), words(200)) for i in range(400)] + [("big", words(60_000)), ("big", "short one"), (None, "tiny"), ("none", None), ("blank", " .")]
    size = 128 << 10
    bench = spark.createDataFrame(items, "item_id string, text string")
    big = items[400][1].split()
    texts = [f"a b {' '.join(big[k : k + 14])} c" for k in range(0, 60_000, 1700)] + [words(30) + " " + items[7][1][50:300], "tiny thing", None, "", "a short one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tracemalloc.start()
    sizes = [len(w.text) for w in decontaminate.benchmark_blocks(bench, "item_id", "text", 10, size)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(sizes) >= 4 and max(sizes) <= size * 1.1 and sum(sizes) > 5 * size
    assert peak < 24 * size + (4 << 20)
    columns = ["doc_id", "found.n_words", "found.spans", F.sort_array("found.items").alias("items")]
    many, one = (sorted(decontaminate.contamination(docs, bench, block_bytes=b).select(columns).collect()) for b in (size, 1 << 26))
    assert many == one and sum(len(x.items) > 0 for x in one) >= 38
