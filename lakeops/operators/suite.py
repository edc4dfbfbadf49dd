"""Running suites and checkpoints; every result is a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lakeops.functions.timeparts import Moment, instant, moment
from lakeops.operators import checks
from lakeops.operators.checks import Expectation, Suite
from lakeops.operators.ordered import exact_quantiles, order_violations

RESULT_SCHEMA = (
    "suite string, position int, expectation string, column string, success boolean, "
    "element_count bigint, unexpected_count bigint, unexpected_percent double, observed string"
)
_COLUMNS = [part.split()[0] for part in RESULT_SCHEMA.split(", ")]


def _result(suite: str, at: int, e: Expectation, success, elements, unexpected, observed) -> list[Column]:
    percent = F.try_divide(unexpected.cast("double") * 100, elements.cast("double"))
    return [
        F.lit(suite).alias("suite"),
        F.lit(at).alias("position"),
        F.lit(e.name).alias("expectation"),
        F.lit(e.column).cast("string").alias("column"),
        success.cast("boolean").alias("success"),
        elements.cast("bigint").alias("element_count"),
        unexpected.cast("bigint").alias("unexpected_count"),
        percent.alias("unexpected_percent"),
        observed.cast("string").alias("observed"),
    ]


def _mostly(good: Column, total: Column, mostly: float) -> Column:
    """At least ``mostly`` of the tested values are as expected; true if none was tested."""
    return (total == 0) | (good.cast("double") / F.nullif(total, F.lit(0)) >= mostly)


def _within(value: Column, low=None, high=None) -> Column:
    return F.coalesce(checks._between(value, low, high), F.lit(False))


def _measures(suite: Suite, wanted: list[tuple[int, Expectation]], verdict: Callable[[int, Expectation], Column], measured: Callable[[str], Column]):
    """Aggregates of all map, row-count, mean and stdev checks, and the result rows over
    them. ``verdict`` and ``measured`` give the column of a check and of a measure."""
    aggs, rows = [F.count(F.lit(1)).alias("rows")], []
    for at, e in wanted:
        name = f"e{at}"
        if e.name in checks.MAP_EXPECTATIONS:
            ok = verdict(at, e)
            aggs += [F.count(ok).alias(f"{name}_n"), F.count_if(~ok).alias(f"{name}_bad")]
            n, bad = F.col(f"{name}_n"), F.col(f"{name}_bad")
            cells = _result(suite.name, at, e, _mostly(n - bad, n, e.mostly), n, bad, F.lit(None))
        elif e.name == "row_count_between":
            ok = _within(F.col("rows"), **e.kwargs)
            cells = _result(suite.name, at, e, ok, F.col("rows"), F.lit(None), F.col("rows"))
        else:
            measure = F.avg if e.name == "mean_between" else F.stddev_samp
            aggs += [measure(measured(e.column)).alias(f"{name}_v"), F.count(measured(e.column)).alias(f"{name}_n")]
            value = F.col(f"{name}_v")
            cells = _result(
                suite.name, at, e, _within(value, **e.kwargs), F.col(f"{name}_n"), F.lit(None), value
            )
        rows.append(F.struct(*cells))
    return aggs, rows


def _one_pass(df: DataFrame, suite: Suite, wanted: list[tuple[int, Expectation]]) -> DataFrame:
    """All map, row-count, mean and stdev checks from a single aggregate.

    Predicates are projected first, so that each is computed once per row although
    it is counted twice.
    """
    measured = {e.column for _, e in wanted if e.name in checks.AGGREGATE_EXPECTATIONS}
    verdicts = [
        checks.is_expected(e).alias(f"e{at}") for at, e in wanted if e.name in checks.MAP_EXPECTATIONS
    ]
    judged = df.select(*verdicts, *[F.col(c).alias(f"m_{c}") for c in sorted(measured)])
    aggs, rows = _measures(suite, wanted, lambda at, _: F.col(f"e{at}"), lambda c: F.col(f"m_{c}"))
    return judged.agg(*aggs).select(F.inline(F.array(*rows)))


def _unique(df: DataFrame, suite: Suite, at: int, e: Expectation) -> DataFrame:
    """Rows in duplicate groups, from key counts (map-side combined)."""
    counted = df.filter(F.col(e.column).isNotNull()).groupBy(e.column).agg(F.count("*").alias("n"))
    sums = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("bad"),
    )
    n, bad = F.col("n"), F.col("bad")
    return sums.select(*_result(suite.name, at, e, _mostly(n - bad, n, e.mostly), n, bad, F.lit(None)))


def _increasing(df: DataFrame, suite: Suite, at: int, e: Expectation) -> DataFrame:
    sums = order_violations(df, e.column, **e.kwargs)
    n, bad = F.col("element_count"), F.col("unexpected_count")
    return sums.select(*_result(suite.name, at, e, _mostly(n - bad, n, e.mostly), n, bad, F.lit(None)))


def _median(df: DataFrame, suite: Suite, at: int, e: Expectation, median: float | None) -> DataFrame:
    value = F.lit(median).cast("double")
    counted = df.agg(F.count(e.column).alias("n"))
    return counted.select(
        *_result(suite.name, at, e, _within(value, **e.kwargs), F.col("n"), F.lit(None), value)
    )


def _from_schema(df: DataFrame, e: Expectation) -> tuple[bool, str]:
    """Checks answered from the schema alone: (success, observed)."""
    names = df.columns
    if e.name == "columns_match_ordered_list":
        return names == list(e.kwargs["columns"]), ",".join(names)
    if e.name == "columns_match_set":
        return set(names) == set(e.kwargs["columns"]), ",".join(sorted(names))
    if e.name == "column_exists":
        return e.column in names, ",".join(names)
    if e.column not in names:
        return False, "missing"
    kind = df.schema[e.column].dataType
    accepted = e.kwargs["types"] if e.name == "type_in_list" else [e.kwargs["type"]]
    return any(checks.accepted_type(kind, t) for t in accepted), checks.type_name(kind)


_ONE_PASS = (*checks.AGGREGATE_EXPECTATIONS, "row_count_between")


def _is_one_pass(e: Expectation) -> bool:
    return e.name in checks.MAP_EXPECTATIONS or e.name in _ONE_PASS


def _other_parts(df: DataFrame, suite: Suite) -> list[DataFrame]:
    """Results of the expectations that one aggregate can't give."""
    parts = []
    medians = {e.column: [0.5] for e in suite.expectations if e.name == "median_between"}
    found = exact_quantiles(df, medians) if medians else {}
    for at, e in enumerate(suite.expectations):
        if _is_one_pass(e):
            continue
        if e.name == "unique":
            parts.append(_unique(df, suite, at, e))
        elif e.name == "increasing":
            parts.append(_increasing(df, suite, at, e))
        elif e.name == "median_between":
            parts.append(_median(df, suite, at, e, found[e.column, 0.5]))
        elif e.name in checks.TABLE_EXPECTATIONS:
            success, observed = _from_schema(df, e)
            row = (suite.name, at, e.name, e.column, success, None, None, None, observed)
            parts.append(df.sparkSession.createDataFrame([row], RESULT_SCHEMA))
        else:
            raise ValueError(f"unknown expectation {e.name!r}")
    return parts


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """One result row per expectation, in suite order (``position``).

    Everything that is a plain count or moment shares one scan; uniqueness and
    order checks add one shuffle each, medians three jobs together; schema checks read
    no data.
    """
    one_pass = [(at, e) for at, e in enumerate(suite.expectations) if _is_one_pass(e)]
    parts = [_one_pass(df, suite, one_pass)] if one_pass else []
    return reduce(DataFrame.unionByName, parts + _other_parts(df, suite)).select(*_COLUMNS)


def write_checked(df: DataFrame, suite: Suite, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run_suite`` on what ``write`` writes, with the plain counts and moments taken while the
    rows are written: they cost no scan.

    ``write`` gets the frame, writes it with one action and returns the table that it
    wrote, on which the other expectations (uniqueness, order, medians) run.
    """
    one_pass = [(at, e) for at, e in enumerate(suite.expectations) if _is_one_pass(e)]
    aggs, rows = _measures(suite, one_pass, lambda _, e: checks.is_expected(e), F.col)
    observation = Observation(f"suite {suite.name}")
    written = write(df.observe(observation, *aggs))
    seen = observation.get
    kinds = df.agg(*aggs).schema  # analysed only
    counts = df.sparkSession.createDataFrame([tuple(seen[f.name] for f in kinds.fields)], kinds)
    parts = [counts.select(F.inline(F.array(*rows)))] if one_pass else []
    return reduce(DataFrame.unionByName, parts + _other_parts(written, suite)).select(*_COLUMNS)


def run_checkpoint(
    spark: SparkSession,
    validations: Sequence[tuple[str, DataFrame, Suite]],
    run_at: Moment,
    history_path: str | None = None,
) -> DataFrame:
    """Results of several ``(dataset, frame, suite)``, stamped with the run.

    With ``history_path`` the results are stored there, one partition per run, and that
    partition is read back, so that callers of the returned frame do not run the
    checks again. A repeated run replaces its partition.
    """
    results = reduce(
        DataFrame.unionByName,
        [
            run_suite(df, suite).select(
                F.lit(dataset).alias("dataset"), "*", instant(run_at).alias("run_at")
            )
            for dataset, df, suite in validations
        ],
    )
    if history_path is None:
        return results
    run = moment(run_at).strftime("%Y%m%dT%H%M%S%f")
    (
        results.withColumn("run", F.lit(run)).coalesce(1).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(history_path)
    )
    schema = results.schema.add("run", "string")
    return spark.read.schema(schema).parquet(history_path).filter(F.col("run") == run).drop("run")


def checkpoint_outcome(results: DataFrame) -> DataFrame:
    """One row: ``success`` (all passed), evaluated, successful, unsuccessful."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count("*").alias("evaluated"),
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("unsuccessful"),
    )


def quality_summary(history: DataFrame) -> DataFrame:
    """One row over a result history: totals, pass rate in percent, datasets, last run."""
    return history.agg(
        F.count("*").alias("total_validations"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        (F.try_divide(F.count_if("success").cast("double"), F.count("*")) * 100).alias("success_rate"),
        F.countDistinct("dataset").alias("datasets"),
        F.max("run_at").alias("last_check"),
    )


def quality_trend(history: DataFrame) -> DataFrame:
    """Passed and failed checks per day."""
    return (
        history.groupBy(F.to_date("run_at").alias("date"))
        .agg(F.count_if("success").alias("passed"), F.count_if(~F.col("success")).alias("failed"))
        .orderBy("date")
    )


def failures_by_dataset(history: DataFrame) -> DataFrame:
    return (
        history.filter(~F.col("success"))
        .groupBy("dataset")
        .agg(F.count("*").alias("failures"))
        .orderBy(F.desc("failures"), "dataset")
    )


def freshness(
    df: DataFrame, ts: str, as_of: Moment, warn_hours: float = 24, error_hours: float = 48
) -> DataFrame:
    """One row: newest timestamp, its age in hours and ``pass`` / ``warn`` / ``error``.

    A table without any timestamp is an error.
    """
    newest = df.agg(F.max(ts).cast("timestamp_ntz").alias("newest"))
    seconds = F.unix_micros(F.lit(moment(as_of).isoformat(sep=" ")).cast("timestamp")) - F.unix_micros(
        F.col("newest").cast("timestamp")
    )
    age = seconds / F.lit(3_600_000_000.0)
    return newest.withColumn("age_hours", age).withColumn(
        "status",
        F.when(age.isNull() | (age > error_hours), "error")
        .when(age > warn_hours, "warn")
        .otherwise("pass"),
    )


def schema_changes(spark: SparkSession, old: DataFrame, new: DataFrame) -> DataFrame:
    """``column_name, change_type, details`` between two schemas (no data is read)."""
    def described(df: DataFrame, name: str) -> DataFrame:
        rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        return spark.createDataFrame(rows, f"column_name string, {name} string")

    both = described(old, "before").join(described(new, "after"), "column_name", "full")
    before, after = F.col("before"), F.col("after")
    change = (
        F.when(before.isNull(), "Column Added")
        .when(after.isNull(), "Column Removed")
        .when(before != after, "Type Changed")
    )
    details = F.concat_ws(" -> ", before, after)
    return both.select("column_name", change.alias("change_type"), details.alias("details")).filter(
        "change_type IS NOT NULL"
    )


def observe_run(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they flow to whatever action follows, without a second scan."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def run_record(
    spark: SparkSession, run_id: str, job: str, status: str, started_at: Moment, ended_at: Moment,
    rows_read: int | None, rows_written: int | None, inputs: Sequence[str], outputs: Sequence[str],
    error: str | None = None,
) -> DataFrame:
    """One lineage row for the runs table."""
    row = (
        run_id, job, status, moment(started_at), moment(ended_at), rows_read, rows_written,
        list(inputs), list(outputs), error,
    )
    return spark.createDataFrame(
        [row],
        "run_id string, job string, status string, started_at timestamp_ntz, ended_at timestamp_ntz, "
        "rows_read bigint, rows_written bigint, inputs array<string>, outputs array<string>, "
        "error_message string",
    )
