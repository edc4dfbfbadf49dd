"""Vector retrieval: exact top-k search over a corpus of embeddings.

Vector records: ``id``, ``values array<float>``, ``metadata map<string,string>``.
Queries: ``query_id``, ``values``.

Search is exact and pruned. The corpus is dealt into cells around seeded pivots, each
with the largest distance of its vectors from the pivot, and cells that lie together
make up ``SECTORS`` of about as many vectors. A query first visits the sectors of the
cells that promise most, until they hold k vectors; its k-th score then rules out every
cell whose bound (triangle inequality, or Cauchy-Schwarz for products) can't beat it, and
the sectors of the others are visited in a second step. Both steps are the same block
join: a sector is cut into blocks of vectors and its visitors into tiles of queries by
their measured numbers, pairs are never rows, and a task multiplies one tile with one
block and keeps the best k per query. So a query is sent to each sector at most, and a
vector to each tile. Vectors of another length than the query have no score. Scores
are compared at ``SCORE_DECIMALS``, so that the order of float additions cannot decide a
tie; ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from lakeops.functions.similarity import METRICS
from lakeops.operators.ordered import latest_per_key
from lakeops.session import scratch_dir

SCORE_DECIMALS = 12
PIVOTS = 64  # go to the driver and to every task
SECTORS = 16
TILE_QUERIES = 32_768
BLOCK_VECTORS = 65_536
_VALUES = 2**22  # of a tile or block of long vectors
_STRIPE = 256  # queries multiplied at a time, bounds the score matrix
_BATCH = 4096  # vectors multiplied at a time
_PAIRS = 2**20  # values of the pairs that get a score at a time


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Fixed-length list column as a 2-d double array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", m, m))


class _Best:
    """The k best (score, id) per query so far; higher is better.

    Products are first taken in single precision, with a bound on their error. Only pairs that may
    reach the ``floor``, the least score that a query still needs, get a score in double precision.
    Vectors with a query's id in ``own`` are left out.
    """

    def __init__(self, queries: np.ndarray, k: int, metric: str, floor: np.ndarray, own: np.ndarray | None = None):
        self.q, self.k, self.metric = queries, k, metric
        self.q_norm = _norms(queries)
        self.floor = floor.copy()
        self.own = own
        self.scored = ~np.isnan(self.q_norm)
        if metric == "cosine":
            self.scored &= self.q_norm > 0
        self.owner = np.empty(0, dtype=np.int64)
        self.score = np.empty(0)
        self.ids = None
        self.new = []  # not merged yet

    def _scores(self, rows: np.ndarray, vectors: np.ndarray, v_norm: np.ndarray) -> np.ndarray:
        q = self.q[rows]
        with np.errstate(divide="ignore", invalid="ignore"):
            if self.metric == "euclidean":
                score = -_norms(vectors - q)  # differences, not norms: exact for near copies
            else:
                score = np.einsum("ij,ij->i", q, vectors)
                if self.metric == "cosine":
                    score /= self.q_norm[rows] * v_norm
        score = np.round(score, SCORE_DECIMALS)
        return np.where(np.isnan(score), -np.inf, score)

    def _screen(self, vectors: np.ndarray, v_norm: np.ndarray):
        """Scaled vectors, one a column, and a function of rows: their queries scaled likewise, the least
        product that may reach the floor, and how far below the k-th product of a batch its k-th score may lie."""
        slack = (vectors.shape[1] + 8) * 2.0**-23  # of a product of vectors of length 1 at most
        tie = 10.0**-SCORE_DECIMALS
        finite = np.isfinite(v_norm)
        plain = np.where(finite[:, None], vectors, 0.0)
        if self.metric == "euclidean":
            # with x, y from a centre: x.y - |y|^2 / 2 >= (|x|^2 - distance^2) / 2
            o = plain.mean(axis=0)
            y = plain - o
            r = _norms(y)
            m = max(r.max(), 1e-6 * max(v_norm[finite].max(initial=0.0), np.sqrt(o @ o))) or 1.0
            columns = np.column_stack([y / m, -((r / m) ** 2) / 2])

            def left(rows):
                x = self.q[rows] - o
                d, far = _norms(x), tie - self.floor[rows]
                odd, t = ~np.isfinite(d), np.maximum(d, m)
                need = ((d - far) * (d + far) - 1e-15 * (d * d + far * far)) / (2 * t * m) - 2 * slack
                x = np.where(odd[:, None], 0.0, np.column_stack([x / t[:, None], m / t]))
                return x, np.where(odd, -np.inf, need), np.where(odd, np.inf, 4 * slack + 4 * tie / m)
        else:
            m = 1.0 if self.metric == "cosine" else v_norm[finite].max(initial=0.0) or 1.0
            columns = _unit(plain, "cosine") if self.metric == "cosine" else plain / m

            def left(rows):
                d = self.q_norm[rows]
                odd = ~np.isfinite(d)
                d = np.where(odd | (d == 0), 1.0, d)
                scale = 1.0 if self.metric == "cosine" else d * m
                need = np.where(odd, -np.inf, (self.floor[rows] - tie) / scale - slack)
                return np.where(odd[:, None], 0.0, self.q[rows] / d[:, None]), need, np.where(odd, np.inf, 2 * slack + tie / scale)

        return np.ascontiguousarray(columns.T, dtype=np.float32), ~finite, left

    def add(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        if self.ids is None:
            self.ids = ids[:0]
        v_norm = _norms(vectors)
        scored = ~np.isnan(v_norm)
        if self.metric == "cosine":
            scored &= v_norm > 0
        if not scored.all():
            ids, vectors, v_norm = ids[scored], vectors[scored], v_norm[scored]
        rows = rows[self.scored[rows]]
        if not len(ids) or not len(rows):
            return
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            columns, odd, left = self._screen(vectors, v_norm)
            enough = self.k if self.own is None else self.k + np.unique(ids, return_counts=True)[1].max()
            for lo in range(0, len(rows), _STRIPE):
                part = rows[lo: lo + _STRIPE]
                x, need, margin = left(part)
                product = x.astype(np.float32) @ columns
                product[:, odd] = -np.inf
                fresh = self.floor[part] == -np.inf
                if len(ids) > enough and fresh.any():
                    cut = len(ids) - enough
                    need[fresh] = np.maximum(need[fresh], np.partition(product[fresh], cut, axis=1)[:, cut] - margin[fresh])
                product[:, odd] = np.inf
                row, col = np.divmod(np.flatnonzero(product >= need.astype(np.float32)[:, None]), len(ids))
                self._score(part[row], col, ids, vectors, v_norm)
        if len(self.owner) < len(self.q) * self.k and (self.floor[rows] == -np.inf).any():
            self._merge()

    def _score(self, owner: np.ndarray, col: np.ndarray, ids: np.ndarray, vectors: np.ndarray, v_norm: np.ndarray) -> None:
        step = max(1, _PAIRS // vectors.shape[1])
        for lo in range(0, len(owner), step):
            rows, at = owner[lo: lo + step], col[lo: lo + step]
            score = self._scores(rows, vectors[at], v_norm[at])
            keep = (score >= self.floor[rows]) & (score > -np.inf)  # ids decide among equal ones
            if self.own is not None:
                keep &= self.own[rows] != ids[at]
            self.new.append((rows[keep], score[keep], ids[at[keep]]))
        if sum(len(x[0]) for x in self.new) > _STRIPE * _BATCH // 4:
            self._merge()

    def _merge(self) -> None:
        if not self.new:
            return
        owner, score, id_ = (np.concatenate(x) for x in zip((self.owner, self.score, self.ids), *self.new))
        self.new = []
        order = np.lexsort((id_, -score, owner))
        owner, score, id_ = owner[order], score[order], id_[order]
        starts = np.searchsorted(owner, np.arange(len(self.q)))
        keep = np.arange(len(owner)) - starts[owner] < self.k
        self.owner, self.score, self.ids = owner[keep], score[keep], id_[keep]
        starts = np.searchsorted(self.owner, np.arange(len(self.q)))
        full = np.bincount(self.owner, minlength=len(self.q)) == self.k
        self.floor[full] = np.maximum(self.floor[full], self.score[starts[full] + self.k - 1])

    def table(self, query_ids: pa.Array, schema: pa.Schema) -> pa.Table:
        if self.ids is None:
            return schema.empty_table()
        self._merge()
        score = -self.score if self.metric == "euclidean" else self.score
        return pa.table(
            [
                query_ids.take(pa.array(self.owner)).cast(schema.field(0).type),
                pa.array(self.ids, type=schema.field(1).type),
                pa.array(score, type=pa.float64()),
            ],
            schema=schema,
        )


def _ids(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = column.to_numpy(zero_copy_only=False)
    return out if out.dtype.kind in "iu" else out.astype(str)


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    return pa.int64() if df.schema[name].dataType.simpleString() in ("bigint", "int", "smallint") else pa.string()


def _id_ddl(df: DataFrame, name: str) -> str:
    return "bigint" if _arrow_type(df, name) == pa.int64() else "string"


def _unit(m: np.ndarray, metric: str) -> np.ndarray:
    """The vectors in which a metric's bounds are taken; a zero vector has no cosine."""
    return m / np.maximum(_norms(m), 1e-300)[:, None] if metric == "cosine" else m


@dataclass
class _Cells:
    """Written vectors with ``length``, ``cell``, ``block``, and what is known of the cells:
    (length, cell) -> (vectors, radius, sector)."""

    vectors: DataFrame | None
    pivots: dict[int, np.ndarray]
    stats: dict[tuple[int, int], tuple[int, float, int]]
    metric: str

    def bounds(self, q: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Cells of the queries' length, and the best score that each may hold for each query."""
        length = q.shape[1]
        cells = sorted(c for n, c in self.stats if n == length)
        out = np.full((len(q), len(cells)), np.inf)
        if length in self.pivots:
            q, p = _unit(q, self.metric), self.pivots[length][cells]
            r = np.array([self.stats[length, c][1] for c in cells])
            if self.metric == "euclidean":
                far = np.stack([_norms(q - x) for x in p], axis=1)
                out = -np.maximum(far - r, 0.0)
            else:
                out = q @ p.T + _norms(q)[:, None] * r
            out += 1e-9 * (1 + np.abs(out))
        return cells, np.where(np.isnan(out), np.inf, out)


def _sectors(sizes: dict[int, int], pivots: np.ndarray | None) -> dict[int, int]:
    """The sector of each cell; cells near the same one of the first pivots follow each other."""
    cells = sorted(sizes)
    if pivots is not None:
        first = pivots[cells[:SECTORS]]
        cells.sort(key=lambda c: (int(np.argmin(_norms(first - pivots[c]))), c))
    total, before, out = sum(sizes.values()), 0, {}
    for c in cells:
        out[c] = before * SECTORS // total
        before += sizes[c]
    return out


def _cells(corpus: DataFrame, metric: str) -> _Cells:
    """Deal vectors to the nearest of ``PIVOTS`` of them, drawn by hash."""
    spark = corpus.sparkSession
    drawn = corpus.filter(F.size("values") > 0).orderBy(F.xxhash64("id", "values"), "id").limit(PIVOTS).select("values").collect()
    pivots: dict[int, list] = {}
    for r in drawn:
        pivots.setdefault(len(r["values"]), []).append(r["values"])
    near = {n: _unit(np.array(x, dtype=np.float64), metric) for n, x in pivots.items()}
    shared = spark.sparkContext.broadcast(near)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column(1))
            for n in pa.compute.unique(lengths).to_pylist():
                own = batch.filter(pa.compute.equal(lengths, n))
                cell, far = np.zeros(own.num_rows, dtype=np.int32), np.full(own.num_rows, np.inf)
                if n in shared.value:
                    m = _unit(_matrix(own.column(1)), metric)
                    for i, p in enumerate(shared.value[n]):
                        d = _norms(m - p)
                        closer = d < far
                        cell[closer], far[closer] = i, d[closer]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(np.full(own.num_rows, n, dtype=np.int32)), pa.array(cell), pa.array(far)], ["id", "values", "length", "cell", "far"])

    schema = StructType([*corpus.schema.fields]).add("length", "integer").add("cell", "integer").add("far", "double")
    path = scratch_dir(spark, "cells")
    corpus.mapInArrow(deal, schema).write.parquet(path)
    vectors = spark.read.schema(schema).parquet(path)
    # a row per length and pivot
    found = vectors.groupBy("length", "cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
    sectors = {n: _sectors({r["cell"]: r["n"] for r in found if r["length"] == n}, near.get(n)) for n in {r["length"] for r in found}}
    stats = {(r["length"], r["cell"]): (r["n"], r["far"], sectors[r["length"]][r["cell"]]) for r in found}
    return _Cells(vectors, near, stats, metric)


def _visits(queries: DataFrame, cells: _Cells, k: int, rest: bool) -> DataFrame:
    """A row per query: ``q_id``, ``q_values``, ``floor``, ``length``, the ``sectors`` it visits and the ``pairs``
    compared there. Visited are those of the cells of the best bounds that hold k vectors, or with
    ``rest`` the others with cells that can beat the query's ``floor``."""
    shared = queries.sparkSession.sparkContext.broadcast((cells.pivots, cells.stats, cells.metric))
    schema = StructType([StructField("q_id", queries.schema["query_id"].dataType), StructField("q_values", queries.schema["values"].dataType)])
    schema = schema.add("floor", "double").add("length", "integer").add("sectors", ArrayType(IntegerType())).add("pairs", "long")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Cells(None, *shared.value)
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column(1))
            for n in pa.compute.unique(lengths).to_pylist():
                own = batch.filter(pa.compute.equal(lengths, n))
                names, bound = known.bounds(_matrix(own.column(1)))
                if not names:
                    continue
                size, sector = (np.array([known.stats[n, c][i] for c in names]) for i in (0, 2))
                order = np.argsort(-bound, axis=1, kind="stable")
                first = np.cumsum(size[order], axis=1) - size[order] < k  # those before hold fewer than k
                row, at = np.nonzero(first)
                home = np.zeros((own.num_rows, sector.max() + 1), dtype=bool)
                home[row, sector[order[row, at]]] = True
                chosen = home[:, sector]
                if rest:
                    chosen = ~chosen & (bound >= own.column(2).to_numpy(zero_copy_only=False)[:, None])
                met = np.zeros_like(home)
                row, at = np.nonzero(chosen)
                met[row, sector[at]] = True
                ends = np.concatenate([[0], np.cumsum(met.sum(axis=1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(np.full(own.num_rows, n, dtype=np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(met)[1].astype(np.int32))), pa.array(chosen @ size)],
                    schema.names)

    return queries.select("query_id", "values", "floor").mapInArrow(visit, schema)


def _block_join(visits: DataFrame, cells: _Cells, ids: DataFrame, k: int, others: bool) -> DataFrame:
    """Best k per query and block of the sectors that it visits."""
    spark = visits.sparkSession
    path = scratch_dir(spark, "visits")
    visits.write.parquet(path)
    visits = spark.read.schema(visits.schema).parquet(path).withColumn("sector", F.explode("sectors"))
    met = visits.groupBy("length", "sector").count().collect()  # a row per length and sector
    held = {}
    for (n, _), (size, _, sector) in cells.stats.items():
        held[n, sector] = held.get((n, sector), 0) + size
    parts = lambda rows, most, n: math.ceil(rows / max(1, min(most, _VALUES // max(1, n))))
    sizes = {(n, x): (parts(q, TILE_QUERIES, n), parts(held[n, x], BLOCK_VECTORS, n)) for n, x, q in met}
    q_sizes = spark.createDataFrame([(*at, *x) for at, x in sizes.items()], "length int, sector int, tiles int, blocks int")
    c_sizes = spark.createDataFrame([(n, c, x[2], *sizes[n, x[2]]) for (n, c), x in cells.stats.items() if (n, x[2]) in sizes],
                                    "length int, cell int, sector int, tiles int, blocks int")
    slot = lambda name, values, n: F.pmod(F.xxhash64(name, values), F.col(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q_cells = visits.join(F.broadcast(q_sizes), ["length", "sector"]).select(
        "length", "sector", slot("q_id", "q_values", "tiles").alias("tile"), copies("blocks").alias("block"), "q_id", "q_values", "floor")
    c_cells = cells.vectors.join(F.broadcast(c_sizes), ["length", "cell"]).select(
        "length", "sector", copies("tiles").alias("tile"), slot("id", "values", "blocks").alias("block"), "id", "values", "cell")
    arrow = pa.schema([("query_id", _arrow_type(ids, "query_id")), ("id", _arrow_type(ids, "id")), ("score", pa.float64())])
    shared = spark.sparkContext.broadcast((cells.pivots, cells.stats, cells.metric))

    def meet(q: pa.Table, c: pa.Table) -> pa.Table:
        if not len(q) or not len(c):
            return arrow.empty_table()
        known = _Cells(None, *shared.value)
        queries, c = _matrix(q["q_values"]), c.sort_by("cell")
        best = _Best(queries, k, known.metric, q["floor"].to_numpy(), _ids(q["q_id"]) if others else None)
        names, bound = known.bounds(queries)
        ids, cell = _ids(c["id"]), c["cell"].to_numpy()
        for i, name in enumerate(names):
            start, end = np.searchsorted(cell, [name, name + 1])
            for lo in range(start, end, _BATCH):
                hi = min(lo + _BATCH, end)
                best.add(np.flatnonzero(bound[:, i] >= best.floor), ids[lo:hi], _matrix(c["values"].slice(lo, hi - lo)))
        return best.table(q["q_id"].combine_chunks(), arrow)

    by = ("length", "sector", "tile", "block")
    return q_cells.groupBy(*by).cogroup(c_cells.groupBy(*by)).applyInArrow(meet, ids.schema)


def _search(
    queries: DataFrame, corpus: DataFrame, k: int, metric: str, others: bool = False
) -> tuple[DataFrame, list[DataFrame], _Cells]:
    """(candidates, the two steps' visits, cells). With ``others`` a query's own id is no candidate."""
    q_id, c_id = _id_ddl(queries, "query_id"), _id_ddl(corpus, "id")
    queries = queries.select(F.col("query_id").cast(q_id), "values").filter("values IS NOT NULL")
    corpus = corpus.select(F.col("id").cast(c_id), "values").filter("values IS NOT NULL")
    spark = corpus.sparkSession
    ids = spark.createDataFrame([], f"query_id {q_id}, id {c_id}, score double")
    cells = _cells(corpus, metric)
    home = _visits(queries.withColumn("floor", F.lit(float("-inf"))), cells, k, rest=False)
    path = scratch_dir(spark, "near")
    _block_join(home, cells, ids, k, others).write.parquet(path)
    near = spark.read.schema(ids.schema).parquet(path)
    higher = -F.col("score") if metric == "euclidean" else F.col("score")
    kth = _ranked(near, k, lowest_first=metric == "euclidean").filter(F.col("rank") == k).select("query_id", higher.alias("floor"))
    floors = queries.join(kth, "query_id", "left").select("query_id", "values", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    rest = _visits(floors, cells, k, rest=True)
    return near.unionByName(_block_join(rest, cells, ids, k, others)), [home, rest], cells


def _candidates(queries: DataFrame, corpus: DataFrame, k: int, metric: str, others: bool = False) -> DataFrame:
    return _search(queries, corpus, k, metric, others)[0]


def pairs_compared(queries: DataFrame, corpus: DataFrame, k: int = 10, metric: str = "cosine") -> DataFrame:
    """One row: the ``pairs`` of query and vector that a search compares, of ``all_pairs``."""
    _, visits, cells = _search(queries, corpus, k, metric)
    spark = corpus.sparkSession
    sizes = spark.createDataFrame([(n, c, x[0]) for (n, c), x in cells.stats.items()], "length int, cell int, n bigint")
    total = queries.filter("values IS NOT NULL").groupBy(F.size("values").alias("length")).agg(F.count("*").alias("q")).join(
        sizes.groupBy("length").agg(F.sum("n").alias("n")), "length").agg(F.coalesce(F.sum(F.col("q") * F.col("n")), F.lit(0)).alias("all_pairs"))
    pairs = visits[0].unionByName(visits[1]).agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))
    return pairs.withColumn("_one", F.lit(1)).join(total.withColumn("_one", F.lit(1)), "_one").drop("_one")


def _ranked(candidates: DataFrame, k: int, score: str = "score", lowest_first: bool = False) -> DataFrame:
    order = F.asc(score) if lowest_first else F.desc(score)
    best = Window.partitionBy("query_id").orderBy(order, F.asc("id"))
    return candidates.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def vector_top_k(queries: DataFrame, corpus: DataFrame, k: int = 10, metric: str = "cosine") -> DataFrame:
    """``query_id, id, score, rank`` of the k best vectors per query, for any number of queries."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
    found = _candidates(queries, corpus, k, metric)
    return _ranked(found, k, lowest_first=metric == "euclidean")


def _with_corpus(found: DataFrame, corpus: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Join results with corpus columns; AQE broadcasts them where they turn out small."""
    return corpus.select("id", *columns).join(found, "id")


def filter_metadata(corpus: DataFrame, wanted: dict[str, str] | None) -> DataFrame:
    """Rows whose metadata has all the given values."""
    for key, value in (wanted or {}).items():
        corpus = corpus.filter(F.try_element_at("metadata", F.lit(key)) == value)
    return corpus


def semantic_search(
    queries: DataFrame, corpus: DataFrame, k: int = 10, filter: dict[str, str] | None = None,
    threshold: float | None = 0.0, metric: str = "cosine",
) -> DataFrame:
    """Top-k with text: the metadata filter applies before, the threshold after top-k.
    It is the least score, for the euclidean metric the largest distance; None: none.

    Returns ``query_id, rank, id, score, text, metadata``.
    """
    corpus = filter_metadata(corpus, filter)
    found = _candidates(queries, corpus, k, metric)
    near = F.col("score") <= threshold if metric == "euclidean" else F.col("score") >= threshold
    hits = _ranked(found, k, lowest_first=metric == "euclidean")
    hits = hits if threshold is None else hits.filter(near)
    return _with_corpus(hits, corpus, ["metadata"]).select(
        "query_id", "rank", "id", "score", F.try_element_at("metadata", F.lit("text")).alias("text"), "metadata"
    )


def hybrid_search(
    queries: DataFrame, corpus: DataFrame, k: int = 10, semantic_weight: float = 0.7
) -> DataFrame:
    """Re-rank the 2k nearest vectors by vector score and keyword share.

    ``queries`` also carries ``keywords array<string>``; the keyword score is the
    share of keywords found in the text, ignoring case, 0 without keywords.
    ``total_results`` is the number of candidates of the query.
    """
    found = _candidates(queries, corpus, 2 * k, "cosine")
    words = queries.select(F.col("query_id").cast(_id_ddl(queries, "query_id")), "keywords")
    near = _ranked(found, 2 * k).drop("rank").join(words, "query_id")
    text = F.coalesce(F.try_element_at("metadata", F.lit("text")), F.lit(""))

    def share(lowered: Column) -> Column:
        matched = F.size(F.filter("keywords", lambda w: F.contains(lowered, F.lower(w))))
        return F.when(F.size("keywords") > 0, matched / F.size("keywords")).otherwise(F.lit(0.0))

    # a one-element array binds the lowered text, so that it is computed once per row
    keyword_score = F.get(F.transform(F.array(F.lower(text)), share), F.lit(0))
    # texts are joined once for the keywords and again for the results, and pass no window;
    # an id that occurs with several texts finds its own by their hash
    own_text = F.try_element_at("metadata", F.lit("text"))
    scored = (
        _with_corpus(near, corpus, ["metadata"])
        .withColumn("_hash", F.xxhash64(own_text))
        .withColumn("keyword_score", F.coalesce(keyword_score, F.lit(0.0)))
        .drop("metadata", "keywords")
        .withColumn("semantic_score", F.col("score"))
        .withColumn(
            "hybrid_score",
            F.round(
                F.col("score") * semantic_weight + F.col("keyword_score") * (1 - semantic_weight),
                SCORE_DECIMALS,
            ),
        )
        .withColumn("total_results", F.count("*").over(Window.partitionBy("query_id")))
    )
    best = _ranked(scored, k, score="hybrid_score")
    texts = corpus.select("id", own_text.alias("text")).groupBy("id", F.xxhash64("text").alias("_hash")).agg(F.first("text").alias("text"))
    return texts.join(best, ["id", "_hash"]).select(
        "query_id", "rank", "id", "hybrid_score", "semantic_score", "keyword_score", "text", "total_results"
    )


def find_similar(corpus: DataFrame, ids: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest other vectors of each given id (column ``id``).

    All vectors of a query's id are left out of the search, however many there are. Ids
    that the corpus does not have are reported by ``joins.missing_ids``.
    """
    wanted = ids.select("id").distinct()
    queries = corpus.join(wanted, "id", "left_semi").select(F.col("id").alias("query_id"), "values")
    return _ranked(_candidates(queries, corpus, k, "cosine", others=True), k)


def rag_context(queries: DataFrame, corpus: DataFrame, k: int = 3) -> DataFrame:
    """One context text per query from its k nearest documents, in rank order."""
    found = _candidates(queries, corpus, k, "cosine")
    hits = _with_corpus(_ranked(found, k), corpus, ["metadata"])
    line = F.format_string(
        "[Document %d] (Similarity: %.3f)\n%s",
        F.col("rank"),
        F.col("score"),
        F.coalesce(F.try_element_at("metadata", F.lit("text")), F.lit("")),
    )
    # at most k entries per query are gathered
    ordered = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return hits.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda e: e["line"]), "\n\n").alias("context"),
        F.count("*").alias("documents"),
    )


def vector_records(items: DataFrame, model: str, created_at: str) -> DataFrame:
    """Records from ``id, text, values`` and optional ``metadata``.

    Items without id or text are skipped. Caller metadata overrides the defaults
    ``text``, ``model`` and ``created_at``.
    """
    kept = items.filter((F.col("id").cast("string") != "") & (F.col("text") != ""))
    own = F.col("metadata") if "metadata" in items.columns else F.lit(None)
    own = F.coalesce(own.cast("map<string,string>"), F.create_map().cast("map<string,string>"))
    defaults = F.create_map(
        F.lit("text"), F.col("text"), F.lit("model"), F.lit(model), F.lit("created_at"), F.lit(created_at)
    )
    unset = F.map_filter(defaults, lambda key, _: ~F.map_contains_key(F.col("_own"), key))
    return kept.withColumn("_own", own).select(
        "id", F.col("values").cast("array<float>").alias("values"), F.map_concat(unset, "_own").alias("metadata")
    )


def upsert_vectors(
    target: DataFrame, items: DataFrame, model: str, created_at: str
) -> DataFrame:
    """Insert or replace by id. Among items with one id the last in content-hash
    order wins, so that a retried task agrees."""
    fresh = vector_records(items, model, created_at).withColumn("_side", F.lit(1))
    both = target.select("id", "values", "metadata").withColumn("_side", F.lit(0)).unionByName(fresh)
    tie = F.xxhash64(F.to_json(F.struct("values", "metadata")))
    return latest_per_key(both.withColumn("_tie", tie), ["id"], ["_side", "_tie"]).drop("_side", "_tie")


def index_stats(corpus: DataFrame) -> DataFrame:
    """One row: dimension and number of vectors."""
    return corpus.agg(F.max(F.size("values")).alias("dimension"), F.count("*").alias("vector_count"))
