"""Shaping of answers: caps, samples, text values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assocspark.operators import views

# Rows per answer by default and at most, rows per sample at most.
DEFAULT_ROWS = 1_000
MAX_ROWS = 100_000
MAX_SAMPLE_ROWS = 100


def capped(df: DataFrame, max_rows: int = DEFAULT_ROWS, order: Sequence[Column | str] = ()) -> DataFrame:
    """At most ``max_rows`` rows, each with ``total_rows`` of the whole answer and ``truncated``; the query runs here.

    The answer is computed once: rows are counted on their way into a top-n, for which each task keeps its first ``max_rows``
    rows and no more. ``order`` sorts the answer; without it rows come in the order the frame has. Only the capped rows,
    MAX_ROWS at most, reach the driver. An answer without rows gives one row of NULLs with a total of 0.
    """
    if not 1 <= max_rows <= MAX_ROWS:
        raise ValueError(f"max_rows must lie between 1 and {MAX_ROWS}")
    counted = Observation()
    # Of a frame that cannot exceed the cap Spark would drop the limit, sort in two passes, and count twice. It knows no
    # bound for a generated column.
    unbounded = df.select("*", F.explode(F.array(F.lit(True))).alias("_one")).drop("_one")
    watched = unbounded.observe(counted, F.count(F.lit(1)).alias("total_rows"))
    # the task and the place in it, so that a sorted frame stays sorted
    keys = list(order) or [F.monotonically_increasing_id()]
    rows = watched.orderBy(*keys).limit(max_rows).collect()
    total = counted.get["total_rows"]
    loose = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema])
    found = df.sparkSession.createDataFrame(rows or [(None,) * len(loose)], loose)
    return found.withColumns({"total_rows": F.lit(total).cast("bigint"), "truncated": F.lit(total > max_rows)})


def capped_flag(df: DataFrame, max_rows: int = DEFAULT_ROWS) -> tuple[DataFrame, bool]:
    """The capped rows and whether more exist, without counting the whole answer."""
    if not 1 <= max_rows <= MAX_ROWS:
        raise ValueError(f"max_rows must lie between 1 and {MAX_ROWS}")
    more = df.limit(max_rows + 1).count() > max_rows
    return df.limit(max_rows), more


def sample_rows(df: DataFrame, limit: int = 10) -> DataFrame:
    """Any few rows, between 1 and 100."""
    if not 1 <= limit <= MAX_SAMPLE_ROWS:
        raise ValueError(f"limit must lie between 1 and {MAX_SAMPLE_ROWS}")
    return df.limit(limit)


def _quoted(text: Column) -> Column:
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    double = text.contains("'") & ~text.contains('"')
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(single)


def stringify(df: DataFrame) -> DataFrame:
    """Dates and arrays as text, ``[1, 2]`` or ``['a', 'b']``; plain values stay as they are."""

    def shown(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            text = isinstance(field.dataType.elementType, T.StringType)
            items = F.transform(column, lambda x: F.coalesce(_quoted(x) if text else x.cast("string"), F.lit("None")))
            return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")).alias(field.name)
        plain = (T.StringType, T.LongType, T.IntegerType, T.DoubleType, T.BooleanType)
        return column if isinstance(field.dataType, plain) else column.cast("string").alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


def answer(df: DataFrame, max_rows: int = DEFAULT_ROWS, order: Sequence[Column | str] = ()) -> DataFrame:
    """A query result as it is handed out: capped, with dates and arrays as text."""
    return capped(stringify(df), max_rows, order)


def ask(
    spark: SparkSession, frames: Mapping[str, DataFrame], sql: str, max_rows: int = DEFAULT_ROWS, order: Sequence[Column | str] = ()
) -> DataFrame:
    """The answer to SQL text over the views of the given tables, under their base and view names.

    ``order`` is cheaper than ORDER BY in the text, which sorts the whole answer before it is cut.
    """
    views.register(spark, dict(frames))
    return answer(spark.sql(sql), max_rows, order)
