"""Profiling and exploration; each profile is one scan where possible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType, FractionalType, NumericType

from lakeops.operators.ordered import exact_quantiles


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-NULL and NULL count, from one aggregate."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_c{i}") for i, c in enumerate(df.columns)]
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"_c{i}").alias("non_null_count"),
            (F.col("_rows") - F.col(f"_c{i}")).alias("null_count"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counted.select(F.inline(F.array(*rows)))


def describe(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """Per numeric column: count, mean, std, min, quartiles, max.

    Quartiles come from a sketch in the same scan; ``exact`` computes them by
    interpolation, those of all columns in three jobs.
    """
    columns = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)])
    quarters = (0.25, 0.5, 0.75)
    aggs, rows = [], []
    found = exact_quantiles(df, {c: quarters for c in columns}) if exact else {}
    for i, c in enumerate(columns):
        aggs += [
            F.count(c).alias(f"n{i}"), F.avg(c).alias(f"avg{i}"), F.stddev_samp(c).alias(f"sd{i}"),
            F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}"),
        ]
        if exact:
            marks = [F.lit(found[c, q]).cast("double") for q in quarters]
        else:
            aggs.append(F.percentile_approx(F.col(c).cast("double"), list(quarters)).alias(f"q{i}"))
            marks = [F.get(F.col(f"q{i}"), j) for j in range(3)]
        rows.append(
            F.struct(
                F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"avg{i}").alias("mean"),
                F.col(f"sd{i}").alias("std"), F.col(f"lo{i}").alias("min"), marks[0].alias("q25"),
                marks[1].alias("q50"), marks[2].alias("q75"), F.col(f"hi{i}").alias("max"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def quality_metrics(df: DataFrame) -> DataFrame:
    """One row: rows, columns, duplicate rows, missing values, columns with missing values.

    Every repetition of a row beyond its first counts as a duplicate. Rows are
    told apart by a 256-bit digest, so that digests are shuffled instead of whole
    rows; copies of a row are folded on the map side.
    """
    def comparable(f):
        c = F.col(f.name)
        if isinstance(f.dataType, FractionalType) and not isinstance(f.dataType, DecimalType):
            c = F.when(c == 0, F.lit(0.0)).otherwise(c)  # -0.0 equals 0.0
        return c.alias(f.name)

    row = F.struct(*map(comparable, df.schema.fields))
    digest = F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in df.columns])
    folded = df.groupBy(digest.alias("_row"), nulls.alias("_nulls")).agg(F.count("*").alias("_copies"))
    missing = [
        F.coalesce(
            F.sum(F.when(F.substring("_nulls", i + 1, 1) == "1", F.col("_copies"))), F.lit(0)
        ).alias(f"_m{i}")
        for i in range(len(df.columns))
    ]
    sums = folded.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("_distinct"),
        *missing,
    )
    cells = [F.col(f"_m{i}") for i in range(len(df.columns))]
    return sums.select(
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        (F.col("total_rows") - F.col("_distinct")).alias("duplicate_rows"),
        sum(cells[1:], cells[0]).alias("missing_values"),
        sum([(c > 0).cast("int") for c in cells[1:]], (cells[0] > 0).cast("int")).alias(
            "columns_with_missing"
        ),
    )


def missing_by_column(df: DataFrame) -> DataFrame:
    """Columns that have NULLs, with their count."""
    return profile(df).filter("null_count > 0").select("column", F.col("null_count").alias("missing_count"))


def column_profile(df: DataFrame, column: str) -> DataFrame:
    """One row: non-NULL count, distinct values (without NULL), missing, type."""
    counted = df.groupBy(column).agg(F.count("*").alias("_n"))
    value = F.col(column)
    return counted.agg(
        F.lit(column).alias("column"),
        F.coalesce(F.sum(F.when(value.isNotNull(), F.col("_n"))), F.lit(0)).alias("count"),
        F.count(value).alias("unique_values"),
        F.coalesce(F.sum(F.when(value.isNull(), F.col("_n"))), F.lit(0)).alias("missing"),
        F.lit(df.schema[column].dataType.simpleString()).alias("type"),
    )


def value_counts(df: DataFrame, column: str, top: int = 20, max_distinct: int = 50) -> DataFrame:
    """The ``top`` most frequent values, only if the column has fewer than
    ``max_distinct`` of them (no rows otherwise). NULL is not a value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    distinct = counted.agg(F.count("*")).scalar()
    return counted.filter(distinct < max_distinct).orderBy(F.desc("count"), column).limit(top)


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty bins included."""
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    bounds = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    raw = F.coalesce(F.width_bucket(F.col("v"), lo, hi, F.lit(bins)), F.lit(1))
    counted = (
        values.groupBy(F.least(raw, F.lit(bins)).cast("bigint").alias("bin"))
        .agg(F.count("*").alias("_n"))
    )
    step = (hi - lo) / bins
    return (
        df.sparkSession.range(1, bins + 1)
        .withColumnRenamed("id", "bin")
        .join(counted, "bin", "left")
        .select(
            "bin",
            (lo + step * (F.col("bin") - 1)).alias("bin_start"),
            (lo + step * F.col("bin")).alias("bin_end"),
            F.coalesce("_n", F.lit(0)).alias("count"),
        )
    )


def ad_hoc_sql(text: str, **frames: DataFrame) -> DataFrame:
    """SQL over the given frames, referred to by ``{name}`` in the text."""
    if not frames:
        raise ValueError("name at least one frame")
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(text, **frames)
