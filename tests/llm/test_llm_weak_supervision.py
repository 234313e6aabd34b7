"""The estimates of the quality rules against a numpy version, and what they decide."""

import random

import numpy as np
from pyspark.sql import functions as F

from ledgerflow.llm import quality_rules


def numpy_em(votes, rounds=80, tolerance=5e-4, belief=0.005):
    """votes: (documents, rules) of -1, 0, 1; share and bad as of ``Model``."""
    n = votes.shape[1]
    bad, good = (votes == -1).astype(float), (votes == 1).astype(float)
    rate = start = np.array([[0.05] * n] + [[0.9 if j == k else 0.1 for j in range(n)] for k in range(n)])
    share = first = np.array([1 - 0.02 * n] + [0.02] * n)
    weight = belief * len(votes)
    for _ in range(rounds):
        logs = np.log(share) + bad @ np.log(rate).T + good @ np.log(1 - rate).T
        q = np.exp(logs - logs.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        rate, old = (q.T @ bad + weight * start) / (q.T @ (bad + good) + weight), rate
        share, before = (q.sum(axis=0) + weight * first) / (len(votes) + weight), share
        if max(abs(rate - old).max(), abs(share - before).max()) < tolerance:
            break
    return share, rate


def noisy_votes(r, n=3000):
    """Rule a fires on one document in twelve whatever it is; b and d, and c and d, fire together on a kind of junk each."""
    rows = []
    for _ in range(n):
        kind = r.choices(["good", "b", "cd"], [0.86, 0.08, 0.06])[0]
        a = -1 if r.random() < 0.08 else 1
        b = -1 if r.random() < (0.95 if kind == "b" else 0.01) else 1
        c = -1 if r.random() < (0.9 if kind == "cd" else 0.01) else 1
        d = -1 if r.random() < {"cd": 0.9, "b": 0.8, "good": 0.01}[kind] else 1
        rows.append((kind, a, r.choice([b, b, b, 0]), c, d))
    return rows


def test_em_equals_numpy_and_outvotes_a_noisy_rule(spark):
    rows = noisy_votes(random.Random(13))
    rules = ["a", "b", "c", "d"]
    voted = spark.createDataFrame(rows, "kind string, a int, b int, c int, d int").repartition(3)
    model = quality_rules.fit(voted, rules)
    share, rate = numpy_em(np.array([x[1:] for x in rows]))
    assert np.allclose(model.share, share, atol=1e-4) and np.allclose(model.bad, rate, atol=1e-4)
    assert 0.05 < model.bad[0][0] < 0.12 and model.bad[0][1] < 0.04 and model.bad[2][1] > 0.85
    got = voted.select("*", model.posterior(rules).alias("p")).collect()
    alone = [x for x in got if x.a == -1 and min(x.b, x.c, x.d) > 0]
    assert alone and all(x.p > 0.5 for x in alone)  # all-must-pass would reject them
    assert all(x.p < 0.5 for x in got if x.d == -1 and -1 in (x.b, x.c))
    verdicts = [(x.p >= 0.5, x.kind == "good") for x in got]
    must_pass = [(min(x.a, x.b, x.c, x.d) >= 0, x.kind == "good") for x in got]
    wrong = lambda v: sum(a != b for a, b in v)
    assert wrong(verdicts) < wrong(must_pass) / 2


def test_the_belief_behaves_alike_at_every_size(spark):
    rows = noisy_votes(random.Random(14), 800)
    voted = spark.createDataFrame(rows, "kind string, a int, b int, c int, d int")
    some, more = (quality_rules.fit(x, ["a", "b", "c", "d"]) for x in (voted, voted.crossJoin(spark.range(7)).drop("id")))
    assert np.allclose(some.bad, more.bad, atol=1e-6) and np.allclose(some.share, more.share, atol=1e-6)


def test_no_documents_leave_the_belief(spark):
    voted = spark.createDataFrame([], "a int, b int")
    assert quality_rules.fit(voted, ["a", "b"]) == quality_rules.Model.start(2)


def test_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    scored = quality_rules.quality(spark.read.parquet(f"{sf}/documents.parquet")).join(docs.select("doc_id", "quality"), "doc_id").where(~F.col("base_failed")).collect()
    bad, good = ([x for x in scored if x.quality == q] for q in (0, 1))
    assert sum(not x.kept for x in bad) >= 0.8 * len(bad) and sum(x.kept for x in good) >= 0.99 * len(good)
