"""The registered queries ``opN_<name>`` and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, licenses, mixing, periodic, personal, quality_cnn, quality_rules, simhash, spelling, substrings, tokens, warc
from .common import let, table, words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(table(spark, sf_dir, "documents"), shingle_words=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "pages"), language.profiles(table(spark, sf_dir, "documents")))


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"), "n_misses")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality(table(spark, sf_dir, "documents"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(*base, "base_failed", "kept", "posterior")


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.curriculum(table(spark, sf_dir, "documents"))
    placed = plan.select("doc_id", "size", "source_size", "target", "taken", F.get("positions", F.lit(0))["position"].alias("first_position"), F.get("positions", F.lit(1))["position"].alias("second_position"))
    return placed.orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.resolved(warc.round_trip(table(spark, sf_dir, "pages")))
    page, refers = F.col("record_id"), F.col("refers_to")
    return records.select(page.cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", refers.cast("long").alias("refers_to"))


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), n=10)
    found = F.col("found")
    n_hit = decontaminate.hit_words(found)
    items = F.array_join(F.array_sort(found["items"]), ",")
    return marked.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = substrings.dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return docs.select("doc_id", "n_sentences", "n_removed", "text")


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query
def op10_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.personal_spans(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter(F.col("base.kind"), lambda x: x == kind)).cast("long").alias(f"n_{kind}") for kind in personal.BASE]
    return found.select("doc_id", *counts, F.sha2(personal.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), personal.listed(F.col("spans")).alias("spans"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.spelling_variants(table(spark, sf_dir, "documents"), "[A-Za-z\u00C0-\u00FF]+", spelling.with_lost_letters, min_length=7, min_count=2, ratio=10)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the texts, by the checksum of the id, become periodic from a word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic_from(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        return F.when(n > 0, F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + F.pmod(i - a, p)).cast("int")))), " "))

    return docs.withColumn("text", F.when(F.pmod(h, F.lit(10)) == 0, let(words_of(F.col("text")), periodic_from)).otherwise(F.col("text")))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.periodic_runs(docs.select("doc_id", "text"), min_exponent=4, min_length=6)
    runs, best = F.col("found.runs"), periodic.longest(F.col("found.runs"))
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(periodic.listed(runs).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: words between the blanks of the contracts, and lower-cased A-Z, in DuckDB
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE: dict[str, str] = {
    "op5_mixing": f"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, CASE i % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS wt, 2 * ss AS cap, sum(ss) OVER () AS everything FROM s),
f AS (SELECT *, (everything * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / wt, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(wt) OVER (ORDER BY cap / wt, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
l AS (SELECT arg_min(level, (cap / wt, i)) AS level FROM f WHERE level * wt <= cap),
t AS (SELECT f.source, ss, CASE WHEN l.level IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, l.level * wt) END AS target,
             CASE i % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0 ELSE 0.5 END AS a,
             CASE i % 3 WHEN 0 THEN -1.0::DOUBLE WHEN 1 THEN 0.0 ELSE 1.0 END AS b FROM f, l),
g AS (SELECT *, floor(target + 0.5)::BIGINT AS goal FROM t),
h AS (SELECT *, sum(goal * a) OVER () AS all_a, sum(goal * b) OVER () AS all_b FROM g),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS o FROM d),
x AS (SELECT p.doc_id, size, ss AS source_size, target, goal, a, b, all_a, all_b, o, o + ss AS o2,
             greatest(0, least(size, goal - o))::BIGINT AS n1, greatest(0, least(size, goal - o - ss))::BIGINT AS n2
      FROM p JOIN h ON p.source IS NOT DISTINCT FROM h.source),
y AS (SELECT *, CASE WHEN n1 > 0 THEN CASE WHEN b = 0 THEN (o / goal) / a ELSE (sqrt(a * a + 2 * b * (o / goal)) - a) / b END END AS t1,
             CASE WHEN n2 > 0 THEN CASE WHEN b = 0 THEN (o2 / goal) / a ELSE (sqrt(a * a + 2 * b * (o2 / goal)) - a) / b END END AS t2 FROM x)
SELECT doc_id, size, source_size, target, n1 + n2 AS taken,
       floor(all_a * t1 + all_b * t1 * t1 / 2)::BIGINT AS first_position, floor(all_a * t2 + all_b * t2 * t2 / 2)::BIGINT AS second_position
FROM y""",
    "op6_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS id FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, n AS payload_bytes, p.h AS payload_digest,
       CASE WHEN f.id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.id < page_id THEN f.id END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h""",
    "op7_decontaminate": f"""
WITH b AS (SELECT item_id, {_TERMS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, list_slice(w, i, i + least(10, len(w)) - 1) AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
dw AS (SELECT doc_id, i, m, list_slice(w, i, i + m - 1) AS win
       FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.m = bw.m),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS j FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.items, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_substring_dedup": r"""
WITH e AS (SELECT doc_id, text, list_filter(regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+[\x20\x09-\x0D]*|[^.!?\n]+'), lambda x: x <> '') AS p FROM documents),
d AS (SELECT doc_id, text, flatten(list_transform(p, lambda s: CASE WHEN len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) <= 16 THEN [s] ELSE
        list_transform(list_filter(range(1, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) + 1), lambda i: i = len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) OR left(md5(regexp_extract_all(s, '[^\x20\x09-\x0D]+')[i]), 1) IN ('0', '1')),
          lambda b, k: array_to_string(list_slice(regexp_extract_all(s, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*'),
            1 + coalesce(list_filter(range(1, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) + 1), lambda i: i = len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) OR left(md5(regexp_extract_all(s, '[^\x20\x09-\x0D]+')[i]), 1) IN ('0', '1'))[k - 1], 0), b), '')) END)) AS p FROM e),
t AS (SELECT *, list_transform(p, lambda x: array_to_string(regexp_extract_all(x, '[^\x20\x09-\x0D]+'), ' ')) AS s FROM d),
q AS (SELECT doc_id, i, w, sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS c
      FROM (SELECT doc_id, unnest(generate_series(1, len(s))) AS i, unnest(list_transform(s, lambda x: len(regexp_extract_all(x, '[^ ]+')))) AS w FROM t) WHERE w > 0),
r AS (SELECT a.doc_id, a.i, b.i AS j FROM q a ASOF JOIN q b ON a.doc_id = b.doc_id AND a.c - a.w + 20 <= b.c),
k AS (SELECT r.doc_id, i, j, array_to_string(list_slice(s, i, j), ' ') AS run FROM r JOIN t ON r.doc_id = t.doc_id),
f AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS n FROM k),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, j)) AS x FROM f WHERE n > 1),
g AS (SELECT doc_id, list(x) AS gone FROM c GROUP BY doc_id)
SELECT t.doc_id, len(p)::INT AS n_sentences, coalesce(len(gone), 0)::INT AS n_removed,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(p, lambda x, i: NOT list_contains(gone, i)), '') END AS text
FROM t LEFT JOIN g USING (doc_id)""",
    "op12_spelling_variants": r"""
WITH RECURSIVE r AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
      FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)),
c AS (SELECT d, run, count(*) AS n, hex(encode(d || ':' || run)) AS b FROM r WHERE length(run) >= 7 GROUP BY d, run),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, length(b), 2), lambda i: ('0x' || substr(b, i + 1, 2))::BIGINT)),
               lambda x, y: list_reduce(list_concat([xor(x, y)], range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))) AS h FROM c),
s AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM s WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
x AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM w)),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS m FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, a.n, w.word, w.n FROM x a JOIN w ON a.rest = w.word
      UNION SELECT w.word, w.n, a.word, a.n FROM x a JOIN w ON a.rest = w.word),
g AS (SELECT word, any_value(n) AS n, count(*) AS n_near, max(m) AS m, arg_min(near, (-m, near)) AS near FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * w.n THEN near END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n FROM w LEFT JOIN g USING (word)),
t AS (SELECT word, word AS root FROM f WHERE form IS NULL UNION ALL SELECT f.word, t.root FROM t JOIN f ON f.form = t.word)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM f JOIN t USING (word)""",
}
