"""Operators that need row order, written so that one hot key cannot fill a task.

A plain ``lag`` over a key sends all rows of that key to one task. Here a key is
cut into chunks along its order (a day, a month); rows are compared inside a
chunk, and one edge row per chunk carries the value across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F



def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row per key by ``order_by`` (all columns kept).

    An aggregate, not a window: ``max_by`` combines on the map side, so a hot
    key shuffles one row per input partition. Name enough columns in
    ``order_by`` for a total order; NULL sorts first.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order_by)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)


def neighbor(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Column,
    order_by: Sequence[str],
    value: str,
    out: str,
    previous: bool = True,
) -> DataFrame:
    """``lag`` (or ``lead``) of ``value`` per key over ``order_by``, in chunks.

    One shuffle of the rows: the value that crosses a chunk border arrives as an
    extra row of the same window, not by a join. ``chunk`` must grow with ``order_by`` (a truncated date of its first column).
    ``order_by`` must be a total order within a key.
    """
    chunked = df.withColumn("_chunk", chunk)
    pick = F.max_by if previous else F.min_by
    toward = (lambda c: F.col(c).asc()) if previous else (lambda c: F.col(c).desc())
    edges = chunked.groupBy(*keys, "_chunk").agg(
        pick(F.struct(F.col(value).alias("v")), F.struct(*order_by)).alias("_edge")
    )
    along = Window.partitionBy(*keys).orderBy(toward("_chunk"))
    # one extra row opens each chunk and carries the neighbour from the chunk before
    carriers = edges.select(
        *keys, "_chunk", F.lag("_edge").over(along)["v"].alias(value), F.lit(0).alias("_row")
    )
    rows = chunked.withColumn("_row", F.lit(1)).unionByName(carriers, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_chunk").orderBy("_row", *map(toward, order_by))
    return rows.withColumn(out, F.lag(value).over(inside)).filter("_row = 1").drop("_chunk", "_row")


def order_violations(
    df: DataFrame, value: str, order_by: str, strictly: bool = False, partitions: int | None = None
) -> DataFrame:
    """One row ``(element_count, unexpected_count)`` for "values increase".

    Rows are compared in ``order_by`` order, ties by value; NULL values are
    skipped. A row is unexpected if it is below (strictly: not above) the row
    before it. Rows with one ``order_by`` value are folded into one aggregate
    first, so a hot order value is one row. The folded rows are range-partitioned,
    compared inside each range, and one edge row per range is compared at the end.
    """
    present = df.filter(F.col(value).isNotNull()).select(
        F.col(order_by).alias("_at"), F.col(value).alias("_v"), F.lit(1).alias("_n")
    )
    if strictly:  # equal values of one _at are neighbours: fold them, then count what was folded
        present = present.groupBy("_at", "_v").agg(F.sum("_n").alias("_n"))
    groups = present.groupBy("_at").agg(
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
        F.sum("_n").alias("_rows"),
        F.count("*").alias("_values"),
    )
    ranged = (
        groups.repartitionByRange(partitions, "_at") if partitions else groups.repartitionByRange("_at")
    ).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range").orderBy("_at")

    def breaks(before: Column) -> Column:
        bad = (F.col("_lo") <= before) if strictly else (F.col("_lo") < before)
        return F.when(bad, 1).otherwise(0)

    equal_neighbours = (F.col("_rows") - F.col("_values")) if strictly else F.lit(0)
    per_range = (
        ranged.withColumn("_bad", breaks(F.lag("_hi").over(inside)) + equal_neighbours)
        .groupBy("_range")
        .agg(
            F.sum("_rows").alias("_rows"),
            F.sum("_bad").alias("_bad"),
            F.min_by("_lo", "_at").alias("_lo"),
            F.max_by("_hi", "_at").alias("_hi"),
        )
    )
    # one row per shuffle partition is left, so this window is small by construction
    edge = breaks(F.lag("_hi").over(Window.orderBy("_range")))
    return per_range.withColumn("_edge", edge).agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("element_count"),
        F.coalesce(F.sum(F.col("_bad") + F.col("_edge")), F.lit(0)).alias("unexpected_count"),
    )


# Of the sketches that bracket a quantile: with this size a rank is off by less than
# RANK_ERROR (a share of the rows) in 99 of 100 cases; brackets are four times as wide.
SKETCH = 16_384
RANK_ERROR = 0.0004


def exact_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]]) -> dict[tuple[str, float], float | None]:
    """Exact quantiles (linear interpolation) of numeric columns: (column, q) -> value,
    ``None`` for a column without values. NaN is greater than any number.

    Spark's exact ``percentile`` keeps every distinct value in one task. Here three jobs
    do for any number of columns and ranks: mergeable KLL sketches bracket all ranks in
    one scan; a second one counts what lies below each bracket; a third folds the values
    inside the brackets, ranks them in range partitions and picks. A bracket that misses
    its rank is replaced by the whole column, so results are exact in any case.
    """
    columns = list(wanted)
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    sketched = [F.when(F.col(c).isNotNull(), F.coalesce(value[c], F.lit(float("inf")))) for c in columns]  # sketches take no NaN
    sums = df.agg(
        *(F.count(c).alias(f"n{i}") for i, c in enumerate(columns)), *(F.count(value[c]).alias(f"m{i}") for i, c in enumerate(columns)),
        *(F.kll_sketch_agg_double(v, SKETCH).alias(f"s{i}") for i, v in enumerate(sketched)))
    width, marks = 4 * RANK_ERROR, []
    for i, c in enumerate(columns):
        for j, q in enumerate(wanted[c]):
            ends = {"lo": max(0.0, q - width), "hi": min(1.0, q + width)}
            marks += [F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", F.lit(r))).alias(f"{side}{i}_{j}") for side, r in ends.items()]
    found = sums.select(*(F.col(f"{x}{i}") for i in range(len(columns)) for x in "nm"), *marks).first()

    out: dict[tuple[str, float], float | None] = {}
    brackets = []  # (column, q, rank of the lower neighbour, of the upper one, share of it, lo, hi)
    for i, c in enumerate(columns):
        n, m = found[f"n{i}"], found[f"m{i}"]
        for j, q in enumerate(wanted[c]):
            rank = q * (n - 1)
            low, high = int(rank), min(int(rank) + 1, n - 1)
            if n == 0:
                out[c, q] = None
            elif high >= m:
                out[c, q] = float("nan")
            else:
                brackets.append((c, q, low, high, rank - low, found[f"lo{i}_{j}"], found[f"hi{i}_{j}"]))
    if not brackets:
        return out

    counts = df.agg(*(F.count_if(value[c] < lo).alias(f"under{k}") for k, (c, *_, lo, _) in enumerate(brackets)),
                    *(F.count_if(value[c].between(lo, hi)).alias(f"kept{k}") for k, (c, *_, lo, hi) in enumerate(brackets))).first()
    below, cells, keep = [], [], F.lit(False)
    for k, (c, _, low, high, _, lo, hi) in enumerate(brackets):
        if not counts[f"under{k}"] <= low or high >= counts[f"under{k}"] + counts[f"kept{k}"]:
            lo, hi = float("-inf"), float("inf")
        below.append(0 if lo == float("-inf") else counts[f"under{k}"])
        inside = value[c].between(lo, hi)
        keep = keep | F.col(c).cast("double").between(lo, hi)  # reaches the scan
        cells.append(F.when(inside, F.struct(F.lit(k).alias("k"), value[c].alias("v"))))
    folded = df.filter(keep).select(F.explode(F.array_compact(F.array(*cells))).alias("x")).select("x.*").groupBy("k", "v").count()
    ranged = folded.repartitionByRange("k", "v").withColumn("part", F.spark_partition_id())
    parts = ranged.groupBy("part", "k").agg(F.sum("count").alias("size"))  # a few rows per range
    before = F.coalesce(F.sum("size").over(Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = parts.select("part", "k", before.alias("before"))
    upto = F.col("before") + F.sum("count").over(Window.partitionBy("part", "k").orderBy("v"))
    ranked = ranged.join(base, ["part", "k"]).withColumn("upto", upto)
    lows, highs = (F.get(F.array(*(F.lit(b[x] - under) for b, under in zip(brackets, below))), "k") for x in (2, 3))
    picked = ranked.groupBy("k").agg(
        F.min(F.when(F.col("upto") > lows, F.col("v"))).alias("a"), F.min(F.when(F.col("upto") > highs, F.col("v"))).alias("b"))
    for r in picked.collect():  # a row per column and rank
        c, q, _, _, share, _, _ = brackets[r["k"]]
        out[c, q] = r["a"] + (r["b"] - r["a"]) * share
    return out


def exact_quantile(df: DataFrame, column: str, q: float = 0.5) -> float | None:
    """One of ``exact_quantiles``."""
    return exact_quantiles(df, {column: [q]})[column, q]


def islands(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap_seconds: int,
    aggregates: dict[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Gap-based sessions per key: ``session_start, session_end, event_count``.

    Two rows of one key belong together if they are at most ``gap_seconds``
    apart. Rows inside one slot as wide as the gap always do, so they are folded
    by a map-side aggregate before anything is ordered: the window then sees at
    most one row per key and slot, however hot the key.

    ``aggregates`` maps an output name to (``sum``/``min``/``max``, expression).
    """
    aggregates = aggregates or {}
    fold = {"sum": F.sum, "min": F.min, "max": F.max}
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slots = (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*keys, F.floor(micros / F.lit(gap_seconds * 1_000_000)).alias("_slot"))
        .agg(
            F.min(ts).alias("_from"),
            F.max(ts).alias("_to"),
            F.count("*").alias("_n"),
            *[fold[how](expr).alias(name) for name, (how, expr) in aggregates.items()],
        )
    )
    along = Window.partitionBy(*keys).orderBy("_slot")
    gap = F.unix_micros(F.col("_from").cast("timestamp")) - F.unix_micros(
        F.lag("_to").over(along).cast("timestamp")
    )
    opens = F.when(gap.isNull() | (gap > gap_seconds * 1_000_000), 1).otherwise(0)
    numbered = slots.withColumn("_opens", opens).withColumn(
        "session_no", F.sum("_opens").over(along)
    )
    return numbered.groupBy(*keys, "session_no").agg(
        F.min("_from").alias("session_start"),
        F.max("_to").alias("session_end"),
        F.sum("_n").alias("event_count"),
        *[fold[how](F.col(name)).alias(name) for name, (how, _) in aggregates.items()],
    )
