"""The operators against brute-force versions, on small fixtures with awkward rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerflow.llm import components, decontaminate, language, license_rules, licenses, mixing, quality_cnn, quality_rules, simhash, substrings, tokens, warc
from ledgerflow.llm.common import crc32_of

WORDS = re.compile("[^\x20\x09-\x0D]+")
TERMS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: columns that the operators use inside, and others
CLASHING = ["fp", "root", "least", "size", "found", "score", "position", "epoch", "value", "n", "text_hash", "removed", "id", "A", "lang"]


def prose(r, n, vocabulary=300):
    out, left = [], 0
    for _ in range(n):
        word = "".join(r.choice(["th", "en", "ou", "ré", "st", "a"]) for _ in range(r.randint(1, 4))) + str(r.randrange(vocabulary))
        out.append(word + (r.choice([". ", ".\n", "! "]) if left == 0 else " "))
        left = r.randint(3, 9) if left == 0 else left - 1
    return "".join(out)


def awkward_texts():
    r = random.Random(5)
    base = [prose(r, 120) for _ in range(12)]
    near = [base[0] + "x", base[0].upper(), base[1].replace(" ", "\t", 3)]
    passage = "One shared passage stands here. It has several sentences of some length. They come again elsewhere, word by word. And so on."
    shared = [f"{prose(r, 40)}\n{passage}\n{prose(r, 40)}" for _ in range(4)]
    odd = [None, "", " \t\n", "one", "one two", "a a a a a a", "é" * 50, "The MIT License. mit license mit license", "x" * 5000, "\x00 null \x1f control", "▁low  line▁ \n\n end ", " lead", "ﬁ①　ｗｉｄｅ <s></s> tab\tend\r\n"]
    long = prose(r, 30_000)
    return base + near + shared + odd + [long, base[0], base[0], None]


@pytest.fixture(scope="module")
def docs(spark):
    texts = awkward_texts()
    rows = [(i, t, f"src{i % 3}" if i % 7 else None) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, texts[3], "src1"), (None, None, None)]
    out = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return out.withColumns({c: F.lit(f"own {c}") for c in CLASHING}).persist()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def pairs(rows):
    return sorted(rows, key=repr)


def brute_fingerprint(text):
    words = WORDS.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius):
    root = list(range(len(values)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, x in enumerate(values):
        for j in range(i):
            if bin(x ^ values[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash_matches_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_fingerprint(x.text) for x in rows]
    roots = brute_components(prints, 2)
    least = {}
    for x, root in zip(rows, roots, strict=True):
        if x.doc_id is not None:
            least[root] = min(least.get(root, x.doc_id), x.doc_id)
    want = pairs((x.doc_id, p, least.get(root)) for x, p, root in zip(rows, prints, roots, strict=True))
    got = simhash.near_components(docs).collect()
    assert pairs((x.doc_id, x.fp % 2**64, x.component_id) for x in got) == want


@pytest.mark.parametrize("shard_rows", [3, 16_384])
def test_near_links_keep_every_component(spark, shard_rows):
    r = np.random.default_rng(3)
    centres = r.integers(0, 2**63, 6, dtype=np.uint64) * 2 + 1
    values = []
    for c in centres:
        for _ in range(60):
            x = int(c)
            for b in r.choice(64, r.integers(0, 5), replace=False):
                x ^= 1 << int(b)
            values.append(x)
    values = list(dict.fromkeys([*values, *map(int, r.integers(0, 2**63, 200)), 0, 2**64 - 1]))
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed * 2, "fp long"), 2, shard_rows)
    found = components.connected_components(links).collect()
    of = {x.node % 2**64: x.root % 2**64 for x in found}
    groups = {}
    for v, root in zip(values, brute_components(values, 2), strict=True):
        groups.setdefault(root, set()).add(v)
    got = {}
    for v in values:
        got.setdefault(of.get(v, v), set()).add(v)
    assert pairs(map(sorted, got.values())) == pairs(map(sorted, groups.values()))
    # a forest from each task, not pairs: fewer links than two for each fingerprint and shard
    assert links.count() < 12 * len(values)


def test_bk_forest_finds_all_and_no_more(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 64)
    r = np.random.default_rng(1)
    shard = np.sort(r.integers(0, 4, 400))
    fp = (r.integers(0, 2**10, 400).astype(np.uint64)) << np.uint64(3)
    found = {(int(q), int(n)) for qs, ns in simhash.BkForest(shard, fp).search(shard, fp, 2) for q, n in zip(qs, ns, strict=True)}
    want = {(i, j) for i in range(400) for j in range(400) if shard[i] == shard[j] and bin(int(fp[i] ^ fp[j])).count("1") <= 2}
    assert found == want  # equal values are a chain of distance-0 children


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (None, 3), (2000, 1999)], "a long, b long")
    got = {x.node: x.root for x in components.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {1000 + i: 1000 for i in range(1, 200)} | {2000: 1999}


def test_near_dedup_keeps_one_of_each_group(docs):
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    found = simhash.near_components(docs).select("component_id").distinct().collect()
    ids = [x.doc_id for x in kept.select("doc_id").collect()]
    assert sorted(ids) == sorted(x.component_id for x in found)


def test_near_dedup_tells_rows_without_own_ids_apart(spark):
    r = random.Random(9)
    texts = [prose(r, 80) for _ in range(9)]
    kept = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (1, texts[3]), (1, texts[4]), (2, texts[5]), (3, texts[6]), (3, texts[7]), (4, None)]
    copies = [(None, texts[0]), (None, texts[5]), (1, texts[4]), (5, texts[3]), (None, None), (None, texts[6].replace(" ", "\t"))]
    docs = spark.createDataFrame(kept + copies, "doc_id long, text string").repartition(3)
    assert pairs(map(tuple, simhash.near_dedup(docs).collect())) == pairs(kept)


def test_token_counts_equal_the_library(docs):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    want = pairs((x.doc_id, len((x.text or "").encode()), len(model.encode(x.text or ""))) for x in docs.select("doc_id", "text").collect())
    for options in ({}, {"table_entries": 5, "task_entries": 4, "cache_entries": 3}):
        got = tokens.token_counts(docs, path, **options).collect()
        assert pairs((x.doc_id, x.n_bytes, x.n_tokens) for x in got) == want


def test_token_counts_of_random_texts(spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, encoder, r = sentencepiece.SentencePieceProcessor(model_file=path), tokens.Encoder(path), random.Random(2)
    for _ in range(3000):
        text = "".join(r.choice(["a", "the", " ", "  ", "\n", "\t", "▁", "é", "日本", "\U0001f600", "\x00", "\r", ".", "ing", "\xa0"]) for _ in range(r.randrange(12)))
        assert sum(encoder.lengths(encoder.split(text)) if text else []) == len(model.encode(text)), repr(text)


def brute_rules(text):
    words = WORDS.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        covered |= {i, i + 1, i + 2} if n[g] > 1 else set()
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(docs, spark):
    got = quality_rules.quality(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    assert pairs((x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in got) == pairs((x.doc_id, *brute_rules(x.text)) for x in rows)
    for x in got:
        assert x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words)
        assert 0 <= x.posterior <= 1 and x.kept == (not x.base_failed and x.posterior >= 0.8)


def test_quality_rules_learn_kinds_of_junk(spark):
    r = random.Random(1)
    common = ["the", "of", "and", "to", "in"]
    good = [" ".join(f"{w} {r.choice(common)}" if r.random() < 0.2 else w for w in prose(r, 200).split()) for _ in range(150)]
    junk = [" ".join(f"{w}###" for w in prose(r, 200).split()) for _ in range(15)]
    rows = [(i, t) for i, t in enumerate(good + junk)]
    got = {x.doc_id: x.kept for x in quality_rules.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] for i in range(150)) and not any(got[i] for i in range(150, 165))


def brute_targets(sizes):
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    target, pot, free = dict.fromkeys(sizes, 0.0), 1.5 * sum(sizes.values()), set(sizes)
    while pot > 1e-9 and free:
        total, excess = sum(weights[s] for s in free), 0.0
        for s in list(free):
            target[s] += pot * weights[s] / total
            if target[s] >= 2 * sizes[s]:
                excess += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                free.discard(s)
        pot = excess
    return target


def test_mixing(docs):
    got = mixing.curriculum(docs).collect()
    sizes = Counter()
    for x in docs.select("source", "text").collect():
        sizes[x.source] += len(WORDS.findall(x.text or ""))
    want, taken = brute_targets(sizes), Counter()
    assert len(got) == docs.count()
    for x in got:
        taken[x.source] += x.taken
        assert x.taken <= 2 * x.size and x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source])
        assert x.taken == sum(p.words for p in x.positions) and [p.position for p in x.positions] == sorted(p.position for p in x.positions)
    for source, n in taken.items():
        assert abs(n - want[source]) <= 1
    again = mixing.curriculum(docs.repartition(7)).collect()
    assert pairs((x.doc_id, x.taken, x.positions) for x in got) == pairs((x.doc_id, x.taken, x.positions) for x in again)


def test_mixing_follows_the_schedules(spark):
    rows = [(i, "w " * 50, f"s{i % 3}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = mixing.training_mix(docs).collect()
    assert [x.position for x in mix] == sorted(x.position for x in mix)
    half, early = len(mix) // 2, Counter()
    for x in mix[:half]:
        early[x.source] += x.words
    whole = Counter()
    for x in mix:
        whole[x.source] += x.words
    # by half of the demand the falling source is ahead of the steady one, the rising one behind
    assert early["s0"] / whole["s0"] > early["s1"] / whole["s1"] > early["s2"] / whole["s2"]
    assert mix[-1].position <= sum(whole.values())


def test_rows_that_share_an_id_are_read_in_the_order_of_their_texts(spark, monkeypatch):
    """Small buckets: each id's rows lie in many; the order is that of md5 over id and text, with no id too."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    data = [(i, f"{'w ' * (n % 5 + 1)}{n}", "s") for i in (None, 7) for n in range(100)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.curriculum(docs, repeat=1, share=1.0, schedules=((1.0, 1.0),), carry=("text",)).collect()
    assert len(got) == 200 and all(r.taken == r.size for r in got)
    want = sorted(data, key=lambda r: hashlib.md5(f"{'' if r[0] is None else r[0]}\n{r[1]}".encode()).hexdigest())
    assert [(r.doc_id, r.text) for r in sorted(got, key=lambda r: r.positions[0].position)] == [r[:2] for r in want]


def test_mix_keeps_columns(docs):
    mix = mixing.training_mix(docs)
    assert mix.columns == [*docs.columns, "mix_epoch", "words", "mix_position"]
    assert mix.select("text", "size").where("text is null or size <> 'own size'").count() == 0


HTML = ["", "a", "x\r\n\r\ny" * 40, "tail\r\n" * 30, "\r\n\r\n" * 60, "\r" * 101 + "\n", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc" * 9, "é€😀" * 90, "p" * 5_000, "q" * 99, "q" * 100, "end\r\n\r", None]


@pytest.mark.parametrize("chunk_bytes", [7, 64, 1 << 20])
def test_warc_round_trip(spark, scratch, chunk_bytes):
    r = random.Random(chunk_bytes)
    texts = HTML + ["".join(r.choice(["\r", "\n", "\r\n", "a"]) for _ in range(r.randrange(300))) for _ in range(60)]
    rows = [(i, "http://a.example/ \r\nx" if i % 2 else None, t) for i, t in enumerate(texts)]
    rows += [(100 + i, "u", t) for i, t in enumerate(HTML)] + [(100, "u", HTML[0]), (None, "u", HTML[8])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"value": F.lit("own"), "record_id": F.lit("own")}).repartition(3)
    warc.write_archives(pages, f"{scratch}/w", chunk_bytes=chunk_bytes)
    chunks = warc.read_archives(spark, f"{scratch}/w", chunk_bytes).collect()
    payloads, first = {}, {}
    for c in sorted((c for c in chunks if c.record_id), key=lambda c: (c.record_id, c.chunk_no)):
        assert len(c.chunk) <= chunk_bytes
        if c.record_id != "100":
            payloads[c.record_id] = payloads.get(c.record_id, b"") + bytes(c.chunk)
            assert c.digest_so_far == hashlib.sha256(payloads[c.record_id]).hexdigest() and c.payload_bytes == len(payloads[c.record_id])
    got = warc.resolved(warc.read_archives(spark, f"{scratch}/w", chunk_bytes)).collect()
    for i, _, t in rows:
        raw = (t or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    want = []
    for i, _, t in rows:
        raw = (t or "").encode()
        refers = first.get(raw) if first.get(raw) != i else None
        want.append((None if i is None else str(i), len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", None if refers is None else str(refers)))
    assert pairs((x.record_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in got) == pairs(want)


def test_warc_repeated_ids_and_missing_responses(spark, scratch):
    import glob
    import gzip
    import os

    a, b = "a" * 200, "b" * 200
    rows = [(1, "u", a), (1, "u", b), (2, "u", a), (3, "u", b), (None, "u", a), (None, None, None), (4, "u", a), (4, "u", a)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("own") for c in ("__first", "first", "digest", "bytes", "__payload", "id")})
    sha = {t: hashlib.sha256((t or "").encode()).hexdigest() for t in (a, b, None)}
    want = [("1", 200, sha[a], None), ("1", 200, sha[b], None), ("2", 200, sha[a], "1"), ("3", 200, sha[b], "1"), (None, 200, sha[a], "1"), (None, 0, sha[None], None)] + 2 * [("4", 200, sha[a], "1")]
    got = warc.resolved(warc.round_trip(pages)).collect()
    assert pairs((x.record_id, x.payload_bytes, x.payload_digest, x.refers_to) for x in got) == pairs(want)
    # revisits alone: their payload is unknown
    warc.write_archives(pages.coalesce(1), f"{scratch}/w")
    records = gzip.open(glob.glob(f"{scratch}/w/*.gz")[0]).read().split(b"WARC/1.1\r\n")
    os.makedirs(f"{scratch}/v")
    with gzip.open(f"{scratch}/v/x.gz", "wb") as f:
        f.write(b"".join(b"WARC/1.1\r\n" + x for x in records if x.startswith(b"WARC-Type: revisit")))
    got = warc.resolved(warc.read_archives(spark, f"{scratch}/v")).collect()
    assert len(got) == 5 and {(x.payload_bytes, x.payload_digest, x.refers_to) for x in got} == {(None, None, "1")}


def test_warc_files_are_plain_archives(spark, scratch):
    import glob
    import gzip

    warc.write_archives(spark.createDataFrame([(1, "http://a/", "body")], "page_id long, url string, html string"), f"{scratch}/w")
    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{scratch}/w/*.gz"))
    head, http, rest = raw.split(b"\r\n\r\n", 2)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and rest == b"body\r\n\r\n"
    assert int(re.search(rb"Content-Length: (\d+)$", head)[1]) == len(http) + 4 + 4


def test_warc_damage_raises(spark, scratch):
    import gzip
    import os

    os.makedirs(f"{scratch}/w")
    with gzip.open(f"{scratch}/w/x.gz", "wb") as f:
        f.write(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")
    with pytest.raises(Exception, match="ends inside|longer than"):
        warc.read_archives(spark, f"{scratch}/w").collect()


def brute_hits(text, items, n=10):
    words = TERMS.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for name, item in items:
        w = TERMS.findall((item or "").translate(LOWER))
        size = min(n, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(words) - size + 1):
            if w and tuple(words[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add("" if name is None else str(name))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [60, 8 << 20])
def test_contamination(spark, docs, block_bytes):
    long = awkward_texts()[0]
    bench = [(1, " ".join(long.split()[20:45])), (2, "one two"), (2, "shared passage stands"), (10, "a A, a"), (None, "null: control"), (3, None), (4, "!?"), (5, " ".join(long.split()[25:36]))]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    marked = decontaminate.contamination(docs, benchmark, block_bytes=block_bytes)
    into = marked.columns[-1]
    got = marked.select("doc_id", f"{into}.n_words", decontaminate.hit_words(F.col(into)), f"{into}.items").collect()
    rows = docs.select("doc_id", "text").collect()
    assert pairs((x[0], x[1], x[2], sorted(x[3])) for x in got) == pairs((x.doc_id, *brute_hits(x.text, bench)) for x in rows)


def test_decontaminate_removes(spark):
    docs = spark.createDataFrame([(1, "Keep this. THE test item, here! and this"), (2, "clean text"), (3, None), (4, "the test item here")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, "the test item here")], "item_id long, text string")
    assert sorted(x.doc_id for x in decontaminate.decontaminate(docs, benchmark).collect()) == [2, 3]
    cut = {x.doc_id: x.text for x in decontaminate.decontaminate(docs, benchmark, remove="spans").collect()}
    assert cut == {1: "Keep this. and this", 2: "clean text", 3: None, 4: ""}


def brute_pieces(text, long_sentence=16):
    out = []
    for sentence in re.findall("[^.!?\n]*[.!?\n]+[\x20\x09-\x0D]*|[^.!?\n]+", text or ""):
        parts = re.findall("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", sentence)
        if len(parts) <= long_sentence:
            out.append(sentence)
            continue
        piece = ""
        for k, part in enumerate(parts):
            piece += part
            if k == len(parts) - 1 or hashlib.md5(WORDS.findall(part)[0].encode()).hexdigest()[0] in "01":
                out.append(piece)
                piece = ""
    return out


def brute_dedup(rows, min_words=20):
    """rows: distinct (id, text), in order; -> {(id, text): rest}"""
    spans, pieces = {}, {}
    for key in rows:
        pieces[key] = brute_pieces(key[1])
        words = [WORDS.findall(p) for p in pieces[key]]
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1) if words[i] else []:
                run = sum(words[i:j], [])
                if len(run) >= min_words:
                    spans.setdefault(" ".join(run), []).append((key, i, j))
                    break
    gone = {}
    for places in spans.values():
        for key, i, j in places[1:]:
            gone.setdefault(key, set()).update(range(i, j))
    return {k: None if k[1] is None else "".join(x for i, x in enumerate(p) if i not in gone.get(k, ())) for k, p in pieces.items()}


HELPERS = ["__id", "__hash", "__text_hash", "__removed", "__gone_id", "__whole", "__first", "gone", "gone_id", "gone_hash", "kept_id", "kept_hash", "text_hash", "n_removed", "n_sentences", "spread", "rank", "salt", "h1", "pos"]


def test_substring_dedup(docs):
    rows = {(x.doc_id, x.text) for x in docs.where("doc_id is not null").select("doc_id", "text").collect()}
    want = brute_dedup(sorted(rows, key=lambda x: x[0]))
    assert any(v != k[1] for k, v in want.items())
    frame = docs.where("doc_id is not null").withColumn("whole", F.col("text")).withColumns({c: F.lit(f"own {c}") for c in HELPERS})
    out = substrings.dedup_spans(frame)
    assert out.columns == frame.columns
    got = out.collect()
    assert len(got) == frame.count()
    for x in got:
        assert x.text == want[x.doc_id, x.whole], x.doc_id
        assert all(x[c] == f"own {c}" for c in HELPERS)
    assert substrings.dedup_spans(frame, counts=True).columns == [*frame.columns, "n_sentences_", "n_removed_"]


def test_hot_spans_are_spread(spark):
    r = random.Random(11)
    line = " ".join(f"word{i}" for i in range(25)) + "."
    texts = [f"{prose(r, 30)}\n{line}\n{prose(r, 10)}" for _ in range(900)] + [line] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert substrings._spans(docs, "doc_id", "text", 20, 16).where("h1 is not null").groupBy("h1", "h2").count().where("count > 900").count() == 1
    got = {x.doc_id: x.text for x in substrings.dedup_spans(docs).collect()}
    want = brute_dedup(list(enumerate(texts)))
    assert got == {i: t for (i, _), t in want.items()} and line in got[0] and all(line not in got[i] for i in range(1, 930))


def test_near_dedup_and_stages_keep_own_columns(spark, scratch):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, f"text number {i} " * 30, "s") for i in range(4)] + [(None, None, None), (9, "", "s"), (9, "", "s")], "doc_id long, text string, source string")
    frame = docs.withColumns({c: F.lit(f"own {c}") for c in HELPERS})
    out = simhash.near_dedup(frame)
    assert out.columns == frame.columns and all(x[c] == f"own {c}" for x in out.collect() for c in HELPERS)
    out = corpus_pipeline.substring_dedup(spark, frame, scratch)
    assert out.columns == frame.columns and out.count() == 7 and all(x[c] == f"own {c}" for x in out.collect() for c in HELPERS)


def planted(r, words, n, size):
    """n pairs of documents, the second with ``size`` words of the first put in at a word's place."""
    texts = []
    for _ in range(n):
        a, b = (prose(r, 300, words).split(" ") for _ in range(2))
        at, to = r.randrange(len(a) - size), r.randrange(len(b))
        texts += [" ".join(a), " ".join(b[:to] + a[at : at + size] + b[to:])]
    return texts


def test_substring_dedup_removes_planted_passages(spark):
    r = random.Random(8)
    texts = planted(r, 300, 60, 60)
    got = {x.doc_id: x.text for x in substrings.dedup_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(got[i] == texts[i] for i in range(0, 120, 2))
    assert sum(got[i] != texts[i] for i in range(1, 120, 2)) >= 58
    clean = [prose(r, 150) for _ in range(30)]
    assert {x.text for x in substrings.dedup_spans(spark.createDataFrame(list(enumerate(clean)), "doc_id long, text string")).collect()} == set(clean)


def test_pipeline_stage_drops_what_is_empty(spark):
    import corpus_pipeline

    r = random.Random(10)
    words = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    one, own = f"{words(14)}. {words(15)}. {words(16)}. ", [f"{words(12)}. {words(9)}. " for _ in range(2)]
    texts = [one, own[0] + one + own[1], one, "", None, f"{words(12)}. "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = {0: one, 1: own[0] + own[1], 3: "", 4: None, 5: texts[5]}
    assert {x.doc_id: x.text for x in corpus_pipeline.substring_dedup(spark, docs, "").collect()} == want


PHRASES = {"mit": ["mit", "license"], "apache": ["apache", "license"], "gpl": ["general", "public", "license"]}


def brute_phrases(text):
    words = TERMS.findall((text or "").translate(LOWER))
    places = sorted((i, label) for label, p in PHRASES.items() for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p)
    return len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places}))


def test_license_base(docs, spark):
    more = ["MIT-License, the GNU General; Public\nLicense general public license. apache license", "mit license", "MİT LICENSE K mit Licenses", "xmit license mit licensex", "apache license apache license mit license"]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    got = licenses.license_scan(rows).collect()
    assert pairs((x.doc_id, x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) for x in got) == pairs((x.doc_id, *brute_phrases(x.text)) for x in rows.collect())
    for x in got:
        assert set(filter(None, x.base_labels.split(","))) <= set(x.labels.split(",")) and 0 <= x.score <= 1


def brute_detections(text, rules):
    found = []
    for r in rules:
        if r.gate in text.lower():
            found += [(m.start(), m.end(), r.priority, r.label) for m in re.finditer(r.regex, text, re.A)]
    kept = [d for d in set(found) if not any(o != d and o[0] <= d[0] and o[1] >= d[1] and (o[2] < d[2] or o[2] == d[2] and (o[:2] != d[:2] or o[3] < d[3])) for o in set(found))]
    return sorted({d[3] for d in kept}), kept


def test_license_detections(spark):
    texts = [
        "This file is licensed under the Apache License, Version 2.0 (the terms).\nSPDX-License-Identifier: Apache-2.0",
        "Released under the MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy",
        "licensed under CC BY-NC 4.0. All rights reserved. Copyright (c) 2020 A. " * 3,
        "GNU Lesser General Public License v2.1 or the GNU General Public License, version 3",
        "nothing here", "", "MIT License\n" * 500,
        "https://creativecommons.org/licenses/by-sa/4.0 and BSD 3-clause, three-clause BSD license",
    ]
    rows = license_rules.rules()
    assert len(rows) >= 200 and all(r.gate == r.gate.lower() and not re.search(r.regex, "") for r in rows)
    got = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", licenses.kept(licenses.detections(F.col("text"), rows)).alias("k")).collect()
    for x in got:
        labels, kept = brute_detections(texts[x.i], rows)
        assert sorted(x.k.labels) == labels, texts[x.i]
        if x.i != 6:
            assert x.k.n == len(kept)
    assert dict((x.i, x.k.n) for x in got)[6] == 500


def sample(r, parsed):
    """A text that a parsed regex matches, its look-arounds aside; white space comes in runs of any kind."""
    out = []
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out.append(r.choice([chr(arg).lower(), chr(arg).upper()]))
        elif op == "IN":
            members = [(str(kind), value) for kind, value in arg]
            if members[0][0] == "NEGATE":
                out.append("q")
                continue
            kind, value = r.choice(members)
            named = {"CATEGORY_SPACE": " \t\n\r\f\v", "CATEGORY_DIGIT": "0123456789", "CATEGORY_WORD": "aZ_9", "CATEGORY_NOT_SPACE": "q.-"}
            out.append(chr(value) if kind == "LITERAL" else chr(r.randint(*value)) if kind == "RANGE" else r.choice(named[str(value)]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = arg
            out += [sample(r, body) for _ in range(r.randint(low, min(int(high), low + 2)))]
        elif op == "SUBPATTERN":
            out.append(sample(r, arg[3]))
        elif op == "BRANCH":
            out.append(sample(r, r.choice(arg[1])))
        elif op == "NOT_LITERAL":
            out.append("q")
        else:
            assert op in ("AT", "ASSERT", "ASSERT_NOT"), op
    return "".join(out)


def test_license_gates_drop_no_match(spark):
    r, signatures, texts = random.Random(12), license_rules.rules(), []
    for rule in signatures:
        found = [m[0] for m in (re.search(rule.regex, sample(r, re._parser.parse(rule.regex)), re.A) for _ in range(60)) if m]
        assert found, rule
        for text in found:
            assert rule.gate in re.sub(r"\s+", " ", text.lower(), flags=re.A), (rule, text)
        texts.append(f"Notice:\n{found[0]} applies")
    texts += ["GNU General\nPublic License, version 2.0", "Permission is  hereby\tgranted, free of charge, to any\r\nperson obtaining a copy", "the PSF License", "https://www.mozilla.org/en-US/MPL/2.0"]
    wrapped = ["GNU Lesser General Public License v2.1, or the GNU General Public License, version 3", "PROVIDED WITHOUT ANY WARRANTY under the PNG Reference Library License", "you may not use this file except in compliance with the Licence"]
    texts += [re.sub(" ", blank, t) for t in wrapped for blank in ("\n", "\t", "\r", "\f", "\v")]
    everywhere = [rule._replace(gate="") for rule in signatures]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(8).select("i", licenses.kept(licenses.detections(F.col("text"), signatures)).alias("k")).collect()
    for x in got:
        labels, kept = brute_detections(texts[x.i], everywhere)
        assert labels and (sorted(x.k.labels), x.k.n) == (labels, len(kept)), texts[x.i]


def labelled(spark, n=300):
    r = random.Random(4)
    good = [(i, prose(r, r.randint(5, 400)), 1) for i in range(n)]
    junk = [(n + i, " ".join(f"{w}{r.choice(['###', '%%%'])}" for w in prose(r, r.randint(5, 400)).split()) if i % 2 else " ".join([r.choice(["ba", "dorem", "x"])] * 150), 0) for i in range(n // 3)]
    rows = good + junk
    return spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string"), spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int"), {i: q for i, _, q in rows}


def test_classifier_held_out(spark):
    docs, labels, truth = labelled(spark)
    got = quality_cnn.classify(docs, labels, rows=250).collect()
    assert all(x.held_out == (crc32_of(x.doc_id) % 5 == 0) and x.predicted == int(x.score >= 0.3) for x in got)
    held = [x for x in got if x.held_out]
    right = sum(x.predicted == truth[x.doc_id] for x in held)
    assert len(held) > 50 and right / len(held) > 0.93
    # labels of held-out rows are never learned
    flipped = labels.withColumn("quality", F.when(quality_cnn.crc32_mod(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert pairs((x.doc_id, x.score) for x in quality_cnn.classify(docs, flipped, rows=250).collect()) == pairs((x.doc_id, x.score) for x in got)


def test_classifier_awkward_rows(spark, docs, empty):
    _, labels, _ = labelled(spark, 20)
    got = quality_cnn.classify(docs, labels.withColumn("fp", F.lit(1)), rows=50, epochs=1).collect()
    assert len(got) == docs.count() and all(0 <= x.score <= 1 for x in got)
    by_text = {}
    for x in quality_cnn.scored(docs, quality_cnn.Network.new(1)).collect():
        assert by_text.setdefault(x.text, x[-1]) == pytest.approx(x[-1], abs=1e-6)
    assert quality_cnn.keep_good(docs, labels.limit(0)).columns == docs.columns
    assert quality_cnn.classify(empty, labels).count() == 0


def test_network_gradients():
    r = np.random.default_rng(2)
    net = quality_cnn.Network.new(3)
    for name in ("embedding", "filters", "bias", "dense"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    chunks, y, w = r.integers(90, 110, (5, quality_cnn.CHUNK)).astype(np.uint8), np.array([0, 1, 1, 0, 1.0]), np.ones(5)

    def loss():
        pooled = np.maximum(net._responses(*quality_cnn._inputs(chunks, net.embedding)).max(axis=2).T + net.bias, 0)
        p = 1 / (1 + np.exp(-(pooled @ net.dense + net.offset)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, d in zip(("embedding", "filters", "bias", "dense"), net.gradients(chunks, y, w), strict=False):
        p = getattr(net, name)
        for at in {tuple(r.integers(0, s) for s in p.shape) for _ in range(6)} | {np.unravel_index(np.abs(d).argmax(), d.shape)}:
            old, eps = p[at], 1e-5
            p[at] = old + eps
            up = loss()
            p[at] = old - eps
            down = loss()
            p[at] = old
            assert (up - down) / (2 * eps) == pytest.approx(float(d[at]), abs=2e-4)


def test_chunks_cover_the_text():
    for n in (0, 1, 255, 256, 257, 448, 449, 20_000, 100_001):
        raw = bytes(np.arange(n) % 251)
        parts = np.concatenate(list(quality_cnn.chunked(raw)))
        at, step = 0, quality_cnn.STEP
        for i, p in enumerate(parts[:-1] if n > quality_cnn.CHUNK else []):
            assert bytes(p) == raw[i * step : i * step + quality_cnn.CHUNK]
            at = i * step + quality_cnn.CHUNK
        assert bytes(parts[-1]).rstrip(b"\0") == raw[-quality_cnn.CHUNK :].rstrip(b"\0") and (n <= quality_cnn.CHUNK or at >= n - quality_cnn.CHUNK)


VOICES = {"aa": "ba bo bi bu dada", "cc": "ze zo zi zu xuxu"}


def language_pages(r, n):
    rows = []
    for i in range(n):
        lang = r.choice(list(VOICES))
        body = " ".join(r.choice(VOICES[lang].split()) for _ in range(40))
        rows.append((i, f"http://{lang}{i % 3}.site.org/{lang}/{i}", f'<html lang="{lang}"><script>{VOICES["aa"] * 30}</script><p>{body}</p></html>', lang))
    return rows


def test_language(spark):
    r = random.Random(6)
    train = spark.createDataFrame([(i, h.split("<p>")[1], lang) for i, _, h, lang in language_pages(r, 60)], "doc_id long, text string, lang string")
    model = language.profiles(train)
    assert model.languages == ["aa", "cc"]
    rows = language_pages(r, 200)
    # silent pages follow their markup, address and host; loud ones their text, whatever they declare
    rows += [(900, "http://cc1.site.org/cc/1", '<html lang="cc"></html>', "cc"), (901, "http://cc2.site.org/", "", "cc"), (902, "http://x.org/", f'<html lang="aa"><p>{"ze zo zi xuxu " * 60}', "cc")]
    rows += [(903, None, None, None), (None, "not an address", "<html lang='aa'>&eacute;<script>x", None), rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, truth string").withColumns({c: F.lit("own") for c in ("id", "host", "q", "ll", "lang")})
    got = language.identify(pages, model).collect()
    assert len(got) == len(rows)
    by_id = {x.page_id: x for x in got}
    for i, *_, lang in rows:
        if lang:
            assert by_id[i].lang == lang, by_id[i]
    assert by_id[903].lang in VOICES and by_id[903].text_lang is None and by_id[903].host is None and 0 < by_id[903].probability <= 1
    assert all(x.lang is None for x in language.identify(pages, language.profiles(train.limit(0))).collect())


def test_empty_tables(spark, empty):
    import public_tokenizers

    pages = spark.createDataFrame([], "page_id long, url string, html string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert simhash.near_components(empty).count() == simhash.near_dedup(empty).count() == 0
    assert tokens.token_counts(empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert quality_rules.quality(empty).count() == mixing.curriculum(empty).count() == mixing.training_mix(empty).count() == 0
    assert warc.resolved(warc.round_trip(pages)).count() == 0
    assert decontaminate.contamination(empty, bench).count() == substrings.dedup_spans(empty).count() == licenses.license_scan(empty).count() == 0
    model = language.Profiles(["aa"], np.zeros((language.BUCKETS, 1), np.float32))
    assert language.identify(pages, model).count() == 0


def test_no_benchmark_hits_nothing(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(docs, bench).count() == docs.count()
