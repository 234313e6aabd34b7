"""Mixing sources to target weights along a time-varying curriculum.

Training time t runs from 0 to 1.  A source's schedule is a rate that changes
linearly from ``start`` to ``end`` (scaled to integrate to 1); its integral
F(t) = a t + b t^2 / 2 is the share of its target that is due by t.  A
document's place among its source's demanded words is inverted through F to
the time, and the demand of all sources up to that time is its training
position.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import words_of

#: weights of the sources in code point order, repeating
WEIGHTS = (3, 1, 2)
#: (start, end) rates of the sources in code point order, repeating: early, steady, late
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
#: documents that a bucket of a source's reading order holds on average
BUCKET_ROWS = 4_096
_BUCKET_DIGITS = 7


def _cycled(values: tuple, index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, repeat: int = 2, schedules: tuple = SCHEDULES) -> DataFrame:
    """A row for each source: source, source_size, target, and the schedule's a and b.

    sizes: source, size.  Sources in code point order, null last, weigh
    ``weights``, repeating, and share ``share`` of all sizes; a target stops at
    ``repeat`` times its source's size and the rest is shared again by weight.
    That is a water level: sources in order of capacity by weight are full
    until the level of the others is no higher than the next one's capacity.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = F.sum("source_size").over(W.partitionBy())
    index = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = totals.select("source", "source_size", everything.alias("everything"), index.alias("index"))
    rows = rows.withColumn("weight", _cycled(weights, F.col("index"))).withColumn("capacity", F.col("source_size") * repeat)
    fill = W.orderBy(F.col("capacity") / F.col("weight"), "index")
    full = F.coalesce(F.sum("capacity").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    weight = F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("level", (F.col("everything") * F.lit(float(share)) - full) / weight)
    fits = F.col("level") * F.col("weight") <= F.col("capacity")
    level = F.min(F.when(fits, F.struct(F.col("capacity") / F.col("weight"), "index", "level"))).over(W.partitionBy())["level"]
    start, end = _cycled(tuple(s for s, _ in schedules), F.col("index")), _cycled(tuple(e for _, e in schedules), F.col("index"))
    return rows.withColumn("water", level).select(
        "source",
        "source_size",
        # no level: every source is full
        F.when(F.col("water").isNull(), F.col("capacity").cast("double"))
        .otherwise(F.least(F.col("capacity").cast("double"), F.col("water") * F.col("weight")))
        .alias("target"),
        (start * 2 / (start + end)).alias("a"),
        ((end - start) * 2 / (start + end)).alias("b"),
    )


def _time(due: Column, a: Column, b: Column) -> Column:
    """The t at which F(t) = due, between 0 and 1."""
    return F.when(b == 0, due / a).otherwise((F.sqrt(a * a + 2 * b * due) - a) / b)


def curriculum(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    share: float = 1.5,
    repeat: int = 2,
    schedules: tuple = SCHEDULES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, source, carry.., size, source_size, target, taken, positions)`` of every row of ``docs``.

    size: the words ``[^\x20\x09-\x0D]+`` of the text (null: 0).  A source is
    read in the order of a hash of id and text, again from the beginning after its
    end, until its target, rounded, is reached; the last document gives only
    the words that lack.  taken: the words read, at most ``repeat`` times the
    size; positions: array of (epoch, words, position) for each reading, where
    position counts the words that all sources are due before it.  Empty
    documents and those not reached have no positions.  A null source is a
    source, the last; equal rows stay rows of their own; no rows give none.
    Reruns agree: order and ties depend on id and text only.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.size(words_of(F.col(text_col))).cast("long").alias("size"),
        # of both: rows that share an id, or have none, are spread over the buckets by their texts
        F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("\n"), F.coalesce(F.col(text_col), F.lit(""))).cast("binary")).alias("order"),
        *[F.col(c).alias(f"carry{i}") for i, c in enumerate(carry)],
    )
    count = docs.count()
    digits = 0
    while 16**digits * BUCKET_ROWS < count and digits < _BUCKET_DIGITS:
        digits += 1
    rows = rows.withColumn("bucket", F.substring("order", 1, digits))
    # prefix sums: over a source's buckets (a small table), then inside each bucket
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))
    targets = source_targets(buckets.select("source", F.col("n").alias("size")), weights, share, repeat, schedules)
    demand = targets.withColumn("goal", F.floor(F.col("target") + 0.5).cast("long"))
    demand = demand.withColumns({"all_a": F.sum(F.col("goal") * F.col("a")).over(W.partitionBy()), "all_b": F.sum(F.col("goal") * F.col("b")).over(W.partitionBy())})
    b = buckets.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), F.coalesce(before, F.lit(0)).alias("bucket_start"))
    d = demand.withColumnRenamed("source", "d_source")
    starts = b.join(d, F.col("b_source").eqNullSafe(F.col("d_source"))).drop("d_source")
    inside = W.partitionBy("source", "bucket").orderBy("order", "id").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
        .withColumn("start", F.col("bucket_start") + F.col("inside"))
    )

    def reading(epoch: int) -> Column:
        offset = F.col("start") + F.col("source_size") * epoch
        words = F.greatest(F.lit(0).cast("long"), F.least("size", F.col("goal") - offset))
        t = _time(offset / F.col("goal"), F.col("a"), F.col("b"))
        position = F.floor(F.col("all_a") * t + F.col("all_b") * t * t / 2).cast("long")
        return F.when(words > 0, F.struct(F.lit(epoch).alias("epoch"), words.alias("words"), position.alias("position")))

    positions = F.filter(F.array(*map(reading, range(repeat))), lambda x: x.isNotNull())
    return placed.withColumn("positions", positions).select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        *[F.col(f"carry{i}").alias(c) for i, c in enumerate(carry)],
        "size",
        "source_size",
        "target",
        F.aggregate("positions", F.lit(0).cast("long"), lambda total, x: total + x["words"]).alias("taken"),
        "positions",
    )


def training_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix: a row for each reading, range-sorted by training position.

    All columns of ``docs``, then epoch (from 0), words (of the text's
    beginning; fewer than the size at a source's end only) and position.
    """
    rest = tuple(c for c in docs.columns if c not in (id_col, source_col))
    plan = curriculum(docs, id_col, text_col, source_col, carry=rest, **options)
    # by place: columns of docs may be called like the plan's own
    names = [id_col, source_col, *rest]
    readings = plan.toDF(*[f"c{i}" for i in range(len(names))], "size", "source_size", "target", "taken", "positions").withColumn("reading", F.explode("positions"))
    own = [F.col(f"c{names.index(c)}").alias(c) for c in docs.columns]
    extra = [F.col(f"reading.{c}").alias(f"mix_{c}" if c in docs.columns else c) for c in ("epoch", "words", "position")]
    return readings.orderBy("reading.position", "c0", "reading.epoch").select(*own, *extra)
