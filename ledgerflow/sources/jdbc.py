"""Relational extracts over JDBC.

One reader for every relational source system.  The column list and the
mark predicate are DataFrame operations, which Spark pushes into the SQL it
sends (``PushedFilters`` / pruned ``ReadSchema`` in the plan).  The scan is
split into range queries on the key over the rows past the mark: by its
bounds if it is a number, else at quantiles that the database gives in its own
order by one window query, so no single task (and never the driver) fetches the
whole table.  The number of ranges follows from the rows that the database counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import project
from ..operators.watermark import watermark_filter

NUMBERS = (T.IntegerType, T.LongType, T.ShortType, T.DecimalType)
#: a range query for so many rows, where the caller names no number of ranges
ROWS_A_RANGE = 500_000
MOST_RANGES = 1_000


def ranges_for(rows: int) -> int:
    return min(MOST_RANGES, max(1, -(-rows // ROWS_A_RANGE)))


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    num_partitions: int = 8,
    bounds: tuple[int, int] | None = None,
    fetch_size: int = 10000,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table, in ranges of a numeric column (its bounds are asked for where they aren't given)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", str(fetch_size)).option("pushDownAggregate", "true")
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        lo, hi = bounds or key_bounds(reader.load(), partition_column)
        if lo is not None and hi is not None:
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", str(lo))
                .option("upperBound", str(hi + 1))
                .option("numPartitions", str(max(1, num_partitions)))
            )
    return reader.load()


def key_bounds(rows: DataFrame, column: str) -> tuple[int | None, int | None]:
    """MIN/MAX of the split column, aggregated by the database (one row back)."""
    return _bounds_and_count(rows, column)[:2]


def _bounds_and_count(rows: DataFrame, column: str) -> tuple[int | None, int | None, int]:
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
    return (None if low is None else int(low), None if high is None else int(high), n)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'  # as the database spells it


def past_mark_sql(field: T.StructField, last_value: str | None) -> str | None:
    """``<mark column> > <last mark>`` with a literal that JDBC drivers translate."""
    if last_value is None:
        return None
    text = str(last_value).replace("'", "''")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        literal = "{ts '" + text + "'}"
    elif isinstance(field.dataType, T.DateType):
        literal = "{d '" + text + "'}"
    else:
        literal = text if isinstance(field.dataType, T.NumericType) else f"'{text}'"
    return f"{_quoted(field.name)} > {literal}"


def quantile_query(table: str, column: str, parts: int, where: str | None, rows: int | None = None) -> str:
    """One query for the least key of each of ``parts`` equal shares of the rows, in the database's order.

    rows: for a database without NTILE, the number of rows; they are numbered
    in the order of a subquery then.
    """
    column = _quoted(column)
    kept = f"{column} IS NOT NULL" + (f" AND {where}" if where else "")
    if rows is None:
        return f"SELECT tile, MIN({column}) AS cut FROM (SELECT {column}, NTILE({parts}) OVER (ORDER BY {column}) AS tile FROM {table} WHERE {kept}) tiles GROUP BY tile"
    step = max(1, -(-rows // parts))
    ordered = f"SELECT {column} FROM {table} WHERE {kept} ORDER BY {column}"
    numbered = f"SELECT ROW_NUMBER() OVER () AS place, {column} AS cut FROM ({ordered}) ordered_keys"
    return f"SELECT place / {step} + 1 AS tile, cut FROM ({numbered}) numbered_keys WHERE MOD(place, {step}) = 1 OR {step} = 1"


def key_ranges(spark: SparkSession, url: str, table: str, column: str, parts: int, where: str | None = None,
               properties: dict[str, str] | None = None, rows: int | None = None) -> list[str]:
    """Predicates that split the rows of ``where`` at quantiles of a text key.

    Equal quantiles give one range.  NULL keys are in the first range.
    """
    query = quantile_query(table, column, parts, where, rows)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) quantiles")
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    found = [cut for _, cut in sorted((r[0], r[1]) for r in reader.load().collect())]  # one a range
    cuts = [c for c in dict.fromkeys(found) if c != found[0]]
    quoted = ["'" + str(c).replace("'", "''") + "'" for c in cuts]
    column = _quoted(column)
    if not quoted:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(quoted, quoted[1:])]
    return [f"{column} < {quoted[0]} OR {column} IS NULL", *inner, f"{column} >= {quoted[-1]}"]


def extract_full(source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``SELECT <columns> FROM table``."""
    return project(source, columns)


def extract_incremental(source: DataFrame, columns: Sequence[str], watermark_column: str,
                        last_value: str | None) -> DataFrame:
    """``SELECT <columns> FROM table WHERE <mark column> > <last mark>``."""
    return project(watermark_filter(source, _resolve(source, watermark_column), last_value), columns)


def _resolve(df: DataFrame, name: str) -> str:
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise ValueError(f"watermark column {name!r} not in {df.columns}")


def jdbc_extractor(spark: SparkSession, url: str, properties: dict[str, str] | None = None,
                   num_partitions: int | None = None, fetch_size: int = 10000):
    """Pipeline extractor for any relational source system.

    The registry's ``source_table`` (or the table name) is read over JDBC in
    ranges of the primary key, ``num_partitions`` of them or as many as its
    rows ask for.  A numeric key is split between its bounds among the rows past
    the mark, so an incremental load of new, high keys is spread over all tasks;
    a text key at quantiles among the same rows.  The pipeline adds the column
    list and the mark predicate, which Spark pushes into the SQL.
    """

    def extract(cfg) -> DataFrame:
        table = cfg.source_table or cfg.table_name
        plain = jdbc_table(spark, url, table, fetch_size=fetch_size, properties=properties)
        by_lower = {f.name.lower(): f for f in plain.schema.fields}
        field = by_lower.get((cfg.primary_key or "").strip().lower())
        if field is None:
            return plain
        past, where = plain, None
        if cfg.load_type != "FULL" and cfg.watermark_column:
            mark = _resolve(plain, cfg.watermark_column)
            past = watermark_filter(plain, mark, cfg.last_watermark_value)
            where = past_mark_sql(plain.schema[mark], cfg.last_watermark_value)
        if isinstance(field.dataType, NUMBERS):
            low, high, rows = _bounds_and_count(past, field.name)
            if low is None:
                return plain
            return jdbc_table(spark, url, table, partition_column=field.name, num_partitions=num_partitions or ranges_for(rows),
                              bounds=(low, high), fetch_size=fetch_size, properties=properties)
        rows = past.agg(F.count(field.name)).first()[0]
        numbered = rows if url.startswith("jdbc:derby:") else None  # has no NTILE
        ranges = key_ranges(spark, url, table, field.name, num_partitions or ranges_for(rows), where, properties, numbered)
        return spark.read.jdbc(url, table, predicates=ranges, properties={"fetchsize": str(fetch_size), **(properties or {})})

    return extract
