"""Keyed upsert with SQL MERGE semantics, as DataFrame operations.

``MERGE INTO t USING s ON t.k = s.k WHEN MATCHED THEN UPDATE SET * WHEN NOT
MATCHED THEN INSERT *`` gives, per row:

* a target row no source row matches is kept;
* a target row matched by exactly one source row is replaced by it (each
  duplicate target row is replaced, so the source row appears once per
  matched target row);
* a target row matched by several source rows is an error
  (MERGE_CARDINALITY_VIOLATION);
* a source row that matches no target row is inserted, duplicates and NULL
  keys included (NULL never equals anything).

Plan: the source is reduced to one row per key (``groupBy`` with partial
aggregation, so a hot key costs one row per map task), the target likewise but
only where a source key matches (semi join below the aggregate), and then

    result = target LEFT ANTI JOIN source-keys
             UNION ALL
             source LEFT JOIN key-statistics  (filter / replicate / check)
             UNION ALL
             source rows with a NULL key  (they meet no join)

The source is used several times: give it as a written table (the pipeline
stages each batch), not as a query against a moving source.

No row-level full outer join, no per-key row buffering, and the cardinality
check is an expression inside the same plan: it fails the write job before
anything is committed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_SRC = "_merge_n_source"
N_TGT = "_merge_n_target"
KEEP = "_merge_keep_"
#: the partition column of a table that is merged by touched partitions
KEY_PART = "key_part"


def key_part(keys: Sequence[str], parts: int) -> Column:
    """The partition, of ``parts``, that a row's block of keys is dealt to.

    A block is the first key's text without its last three characters, so that
    neighbouring keys, which batches bring together, share partitions.  Rows
    with a NULL key, which match nothing, are in partition -1.
    """
    text = F.col(keys[0]).cast("string")
    block = F.substring(text, F.lit(1), F.greatest(F.lit(0), F.length(text) - 3))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return F.when(null_key, -1).otherwise(F.pmod(F.xxhash64(block), F.lit(parts)).cast("int"))


def _renamed_keys(keys: Sequence[str]) -> list[str]:
    return [f"_merge_k_{i}" for i in range(len(keys))]


def _on(left: DataFrame, keys: Sequence[str], right: DataFrame, right_keys: Sequence[str], null_safe: bool):
    conds: list[Column] = []
    for k, rk in zip(keys, right_keys):
        conds.append(left[k].eqNullSafe(right[rk]) if null_safe else left[k] == right[rk])
    return conds


def _key_stats(df: DataFrame, keys: Sequence[str], count_name: str, keep: Sequence[str] = (),
               null_safe: bool = False) -> DataFrame:
    rk = _renamed_keys(keys)
    if not null_safe:
        # NULL keys can never match; leave them out of the statistics.
        all_set = F.col(keys[0]).isNotNull()
        for k in keys[1:]:
            all_set = all_set & F.col(k).isNotNull()
        df = df.where(all_set)
    return df.groupBy(*[F.col(k).alias(r) for k, r in zip(keys, rk)]).agg(
        F.count(F.lit(1)).alias(count_name), *[F.min(c).alias(KEEP + c) for c in keep]
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] | str,
    *,
    update: bool = True,
    insert: bool = True,
    keep_from_target: Sequence[str] = ("insert_timestamp",),
    null_safe: bool = False,
    check_cardinality: bool = True,
    evolve: bool = False,
) -> DataFrame:
    """New state of ``target`` after merging ``source`` on ``keys``.

    ``update=False`` is insert-only (WHEN NOT MATCHED only), ``insert=False``
    update-only.  Columns in ``keep_from_target`` (present in both) keep the
    target's value on update, e.g. the first insert time; pass ``()`` to
    take every column from the source.  ``null_safe`` makes NULL keys match
    each other (used for control tables keyed on nullable ids).  Output has
    the target's columns; missing source columns become NULL.  With
    ``evolve`` the source's extra columns are added to the target first
    (NULL in old rows), as after ``ALTER TABLE ADD COLUMN``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if evolve:
        from .conform import add_column

        for f in source.schema.fields:
            if f.name not in target.columns:
                target = add_column(target, f.name, f.dataType)
    keep = [c for c in keep_from_target if c in target.columns and c in source.columns] if update else []
    rk = _renamed_keys(keys)
    tcols = target.columns

    null_key = F.lit(False)
    if not null_safe:
        for k in keys:
            null_key = null_key | F.col(k).isNull()
    keyless, source = source.where(null_key), source.where(~null_key)
    src_stats = _key_stats(source, keys, N_SRC, null_safe=null_safe)
    met = target.select(*dict.fromkeys([*keys, *keep])).join(src_stats, _on(target, keys, src_stats, rk, null_safe), "left_semi")
    tgt_stats = _key_stats(met, keys, N_TGT, keep, null_safe=null_safe)

    # Target rows that survive: not matched by any source row (or all of
    # them, for insert-only).
    if update:
        kept = target.join(src_stats, _on(target, keys, src_stats, rk, null_safe), "left_anti")
    else:
        kept = target

    # Source rows with the statistics of their key (unique per key).
    if update:
        t_side = tgt_stats.select(*[F.col(r).alias(r + "_t") for r in rk], N_TGT, *[KEEP + c for c in keep])
        stats = src_stats.join(
            t_side, _on(src_stats, rk, t_side, [r + "_t" for r in rk], null_safe), "inner"
        ).drop(*[r + "_t" for r in rk])
    else:
        stats = tgt_stats
    s = source.join(stats, _on(source, keys, stats, rk, null_safe), "left").drop(*rk)
    matched = F.col(N_TGT).isNotNull()

    if not insert:
        s = s.where(matched)
    elif not update:
        s = s.where(~matched)

    if update:
        if check_cardinality:
            # A filter predicate is always evaluated (a projection of an
            # unused column would be pruned away with its check).
            s = s.where(
                F.when(
                    matched & (F.col(N_SRC) > 1),
                    F.raise_error(
                        F.concat(
                            F.lit("MERGE_CARDINALITY_VIOLATION: several source rows match one target row, key="),
                            F.to_json(F.struct(*keys)),
                        )
                    ),
                ).otherwise(F.lit(True))
            )
        # One copy per matched target row (duplicate target keys).
        copies = F.greatest(F.coalesce(F.col(N_TGT), F.lit(1)), F.lit(1))
        s = s.withColumn("_merge_copy", F.explode(F.sequence(F.lit(1), copies)))
        for c in keep:
            s = s.withColumn(c, F.when(matched, F.col(KEEP + c)).otherwise(F.col(c)))

    def emitted(rows: DataFrame) -> DataFrame:
        return rows.select(
            *[(F.col(c) if c in rows.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in tcols]
        )

    out = kept.select(*tcols).unionByName(emitted(s))
    return out if null_safe or not insert else out.unionByName(emitted(keyless))


def merge_conflicts(target: DataFrame, source: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Keys where several source rows would update one target row.

    Output: the key columns and ``source_rows`` (how many source rows share
    the key).  Empty when a MERGE of ``source`` into ``target`` is valid.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rk = _renamed_keys(keys)
    src_stats = _key_stats(source, keys, N_SRC).where(F.col(N_SRC) > 1)
    tgt_keys = _key_stats(target, keys, N_TGT).select(rk)
    return src_stats.join(tgt_keys, rk, "left_semi").select(
        *[F.col(r).alias(k) for r, k in zip(rk, keys)], F.col(N_SRC).alias("source_rows")
    )


def latest_then_merge(target: DataFrame, source: DataFrame, keys: Sequence[str] | str,
                      order_by: Sequence[str], **kw) -> DataFrame:
    """Opt-in cure for ambiguous merges: keep the latest source row per key first.

    Rows with a NULL key collapse into one as well (they form one group).
    """
    from .aggregate import latest_per_key

    keys = [keys] if isinstance(keys, str) else list(keys)
    return merge_upsert(target, latest_per_key(source, keys, order_by).select(*source.columns), keys, **kw)
