"""Merkle manifest of a table: a postorder append log, and proofs read from it.

Rows are leaves. The leaves of a group (``lang``) ascend by key and form a tree: every
two neighbours become a node, a last one without neighbour becomes one alone, until one
is left, the group's subroot. The subroots, in order of their groups, form one more
tree, whose top is the root.

1. Leaves are numbered per group by range partitions, so no task sorts a group.
2. Aligned builders: a task takes the leaves of one block of 2**``BITS`` neighbours and
   appends nodes to the block's segment of the log as they are completed, that is in
   postorder. The tops of the blocks are the leaves of the next tier, until a tree has
   one block. Tiers grow with the logarithm of the table.
3. Postorder positions have a closed form. Before leaf i come 2 i - popcount(i) nodes;
   a full subtree of height l ends 2**(l + 1) - 2 nodes after its first leaf; nodes
   that are not full are the last ones, in order of height. So a segment is an array of
   digests, and the sibling of a node at any height is read from its position.
4. Proofs go down the tiers: a block's path to the root is attached to its segment once,
   and each leaf's path is what its segment adds below.

Digests are lowercase hex SHA-256 of concatenated inputs (digests as hex text); a segment
holds them as 32 bytes each. The segments of a log are a table in the shared folder.

Defined results: a null value reads ``-``, any other its UTF-8 byte count, a colon and the
value. A null group comes first, a null key first in its group. Rows of one key are in
order of their digests; equal rows are a leaf each. A group of one leaf has that leaf as
subroot. An empty table has no leaf and no root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeops.llm import common

BITS = 10
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
DAMAGED = 7  # the query's check damages leaves whose key has a CRC-32 that this divides

_SIDES = "array<struct<left: string, right: string>>"
_SIDES_ARROW = pa.struct([("left", pa.string()), ("right", pa.string())])
_SEGMENT = T.StructType([
    T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("own", T.LongType()), T.StructField("height", T.LongType()), T.StructField("top", T.StringType()),
    T.StructField("nodes", T.BinaryType())])


def field(value: Column) -> Column:
    """How a value enters its leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(values: list[Column]) -> Column:
    """The leaf of some values."""
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def _joined(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_height(n: int) -> int:
    return max(n - 1, 0).bit_length()


def positions(level: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
    """Postorder position of node ``index`` of height ``level`` in a tree of ``n`` leaves."""
    first = index << level
    full = 2 * first - np.bitwise_count(first) + (2 << level) - 2
    zeros = (n & -n).bit_length() - 1
    return np.where((index + 1) << level <= n, full, 2 * n - n.bit_count() + level - zeros - 1)


def segment(leaves: list[str], height: int) -> list[str]:
    """All nodes over ``leaves`` up to ``height``, in order of completion."""
    log: list[str] = []
    waiting: list[str] = []  # full left siblings, the highest first
    for i, node in enumerate(leaves):
        log.append(node)
        while i & 1:
            node = _joined(waiting.pop(), node)
            log.append(node)
            i >>= 1
        waiting.append(node)
    n = len(leaves)
    node = waiting.pop()
    for level in range((n & -n).bit_length() - 1, height):
        # the last node of a level is a right child where its index is odd
        node = _joined(waiting.pop(), node) if (n - 1 >> level) & 1 else _joined(node)
        log.append(node)
    return log


def _tier(leaves: DataFrame, bits: int) -> DataFrame:
    """Segments over ``tree``, ``place``, ``n`` (leaves of the whole tree) and ``digest``."""

    def build(block: pa.Table) -> pa.Table:
        block = block.sort_by("place")
        n, first = block["n"][0].as_py(), block["place"][0].as_py()
        height = min(bits, tree_height(n))
        log = segment(block["digest"].to_pylist(), height)
        row = [block["tree"][0].as_py(), first >> bits, n, block.num_rows, height, log[-1], bytes.fromhex("".join(log))]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.table([pa.array([v], kind) for v, kind in zip(row, kinds)], names=_SEGMENT.names)

    rows = leaves.select("tree", "place", "n", "digest")
    return rows.groupBy("tree", F.shiftright("place", bits).alias("block")).applyInArrow(build, _SEGMENT)


def grow(leaves: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """The log of each tree: written segments, one table per tier."""
    tiers, most = [], leaves.agg(F.max("n")).first()[0] or 0
    while True:
        tiers.append(common.written(_tier(leaves, bits), "segments"))
        if most <= 1 << bits:
            return tiers
        most = -(-most >> bits)
        higher = tiers[-1].filter(F.col("n") > 1 << bits)
        leaves = higher.select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / (1 << bits)).alias("n"), F.col("top").alias("digest"))


def tops(tiers: list[DataFrame], bits: int = BITS) -> DataFrame:
    """``tree`` and ``top``, the digest on top of each tree."""
    out = None
    for tier in tiers:
        part = tier.filter(F.col("n") <= 1 << bits).select("tree", "top")
        out = part if out is None else out.unionByName(part)
    return out


def sides(nodes: bytes, own: int, height: int, wanted: np.ndarray, above: list[dict]) -> pa.Array:
    """For each wanted leaf of a segment what stands left and right of its path, level by
    level: read from the segment by position, then what is ``above`` the segment."""
    hexed = nodes.hex()
    digests = [hexed[a: a + 64] for a in range(0, len(hexed), 64)]
    none, base = len(digests), len(digests) + 1
    pool = [*digests, "", *(s[side] for s in above for side in ("left", "right"))]
    level = np.arange(height)
    index = wanted[:, None] >> level
    sibling = index ^ 1
    there = sibling << level < own
    at = np.where(there, positions(level, np.where(there, sibling, 0), own), none)
    up = np.broadcast_to(base + np.arange(2 * len(above)), (len(wanted), 2 * len(above)))
    left = np.concatenate([np.where(index & 1, at, none), up[:, ::2]], axis=1)
    right = np.concatenate([np.where(index & 1, none, at), up[:, 1::2]], axis=1)
    values = pa.array(pool, pa.string())
    flat = pa.StructArray.from_arrays([values.take(pa.array(x.ravel(), pa.int64())) for x in (left, right)], fields=list(_SIDES_ARROW))
    steps = height + len(above)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(wanted) + 1) * steps, pa.int32()), flat)


def _expanded(known: DataFrame, bits: int) -> DataFrame:
    """``tree``, ``place`` and ``path`` of every leaf of segments with ``path``, their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, block, own, height, nodes, path in zip(*(b.column(i).to_pylist() for i in range(6))):
                places = np.arange(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * own, pa.string()), pa.array((block << bits) + places, pa.int64()), sides(nodes, own, height, places, path)],
                    ["tree", "place", "path"])

    return known.select("tree", "block", "own", "height", "nodes", "path").mapInArrow(run, f"tree string, place bigint, path {_SIDES}")


def paths(tiers: list[DataFrame], above: DataFrame, leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """``leaves`` with ``path``, the steps to the root. ``above`` has ``tree`` and ``path``:
    the steps from a tree's top."""
    known, upper = None, None
    for tier in reversed(tiers):
        known = tier.filter(F.col("n") <= 1 << bits).join(above, "tree")
        if upper is not None:
            lower = tier.filter(F.col("n") > 1 << bits).join(upper.withColumnsRenamed({"place": "block"}), ["tree", "block"])
            known = known.unionByName(lower)
        if tier is not tiers[0]:
            upper = common.written(_expanded(known, bits), "paths")
    out = T.StructType([*leaves.schema.fields, T.StructField("path", T.DataType.fromDDL(_SIDES))])
    names = leaves.columns

    def prove(own: pa.Table, block: pa.Table) -> pa.Table:
        row = {c: block[c][0].as_py() for c in ("own", "height", "nodes", "path")}
        wanted = own["place"].to_numpy() & (1 << bits) - 1
        return own.select(names).append_column("path", sides(row["nodes"], row["own"], row["height"], wanted, row["path"]))

    grouped = leaves.withColumn(common.fresh(names, "block"), F.shiftright("place", bits))
    ones = grouped.groupBy("tree", grouped.columns[-1])
    return ones.cogroup(known.select("tree", "block", "own", "height", "nodes", "path").groupBy("tree", "block")).applyInArrow(prove, out)


@dataclass
class Manifest:
    """``leaves``: ``key``, ``tree`` (the group), ``place``, ``n``, ``digest`` and any columns asked
    for. ``log``: segments, by tier. ``subroots``: ``tree``, ``place``, ``n``, ``digest`` and
    ``group``. ``upper``: the log over subroots."""

    leaves: DataFrame
    log: list[DataFrame]
    subroots: DataFrame
    upper: list[DataFrame]
    bits: int

    def roots(self) -> DataFrame:
        """``root``, one row; none for an empty table."""
        return tops(self.upper, self.bits).select(F.col("top").alias("root"))

    def proofs(self) -> DataFrame:
        """``leaves`` with ``subroot``, ``root``, and ``path``: for each level up to the root
        the digests on the ``left`` and on the ``right`` (empty where none stands)."""
        start = tops(self.upper, self.bits).select("tree", F.col("top").alias("root"), F.array().cast(_SIDES).alias("path"))
        upper = paths(self.upper, start.drop("root"), self.subroots, self.bits).join(start.select("tree", "root"), "tree")
        upper = common.written(upper.select("group", F.col("digest").alias("subroot"), "root", "path"), "subroot-paths")
        above = upper.select(F.col("group").alias("tree"), "path")
        of = upper.select(F.col("group").alias("tree"), "subroot", "root")
        return paths(self.log, above, self.leaves, self.bits).join(of, "tree")


def _tree_places(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``place`` in their tree, and ``n``, how many rows it has."""
    placed = common.numbered(rows, ["tree", *order], "place", label)
    trees = placed.groupBy("tree").agg(F.min("place").alias("begin"), F.count("*").alias("n"))
    return placed.join(trees, "tree").withColumn("place", F.col("place") - F.col("begin")).drop("begin")


def manifest(docs: DataFrame, *, key: str = "doc_id", group: str = "lang", columns: tuple[str, ...] = COLUMNS,
             also: dict[str, Column] | None = None, bits: int = BITS) -> Manifest:
    """Number the leaves and write the log. ``also`` names more columns of the leaves."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null sorts first
    leaf = digest([F.col(c) for c in columns])
    rows = docs.select(F.col(key).alias("key"), tree.alias("tree"), leaf.alias("digest"), *(c.alias(n) for n, c in (also or {}).items()))
    leaves = common.written(_tree_places(common.written(rows, "rows"), ["key", "digest"], "leaves"), "placed")
    log = grow(leaves, bits)
    groups = tops(log, bits).select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("top").alias("digest"))
    subroots = common.written(_tree_places(groups, ["group"], "groups"), "subroots")
    return Manifest(leaves, log, subroots, grow(subroots, bits), bits)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    tampered = digest([more if c == "n_chars" else F.col(c) for c in COLUMNS])
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % DAMAGED == 0, tampered)
    proofs = manifest(docs, also={"altered": altered}).proofs()
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    out = proofs.select(
        F.col("key").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.coalesce("altered", "digest"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string in DuckDB, half a byte at a time."""
    table = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        table.append(x)
    halves = f"flatten(list_transform(string_split({text}, ''), lambda d: [(ascii(d) & 15)::BIGINT, (ascii(d) >> 4)::BIGINT]))"
    return f"xor(list_reduce(list_prepend(4294967295, {halves}), lambda s, x: xor(s >> 4, {table}[(xor(s, x) & 15) + 1])), 4294967295)"


def _leaf_sql(n_chars: str = "n_chars") -> str:
    values = [f"({n_chars if c == 'n_chars' else c})::VARCHAR" for c in COLUMNS]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


SQL = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, lang, {_leaf_sql()} AS leaf, CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % {DAMAGED} = 0 THEN {_leaf_sql("n_chars + 1")} END AS altered
    FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
node AS (
    SELECT lang, 0 AS lvl, i, leaf AS d, n FROM leaves
    UNION ALL
    SELECT lang, lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (max(n) + 1) // 2 FROM node WHERE n > 1 GROUP BY lang, lvl, i // 2),
subroots AS (SELECT lang, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
    SELECT 0 AS lvl, i, d, n FROM subroots
    UNION ALL
    SELECT lvl + 1, i // 2, sha256(string_agg(d, '' ORDER BY i)), (max(n) + 1) // 2 FROM top WHERE n > 1 GROUP BY lvl, i // 2),
step AS (
    SELECT l.doc_id, 0 AS part, h.lvl, (l.i >> h.lvl) & 1 AS odd, coalesce(s.d, '') AS d
    FROM leaves l JOIN (SELECT DISTINCT lang, lvl FROM node WHERE n > 1) h ON h.lang IS NOT DISTINCT FROM l.lang
    LEFT JOIN node s ON s.lang IS NOT DISTINCT FROM l.lang AND s.lvl = h.lvl AND s.i = xor(l.i >> h.lvl, 1)
    UNION ALL
    SELECT l.doc_id, 1, h.lvl, (r.i >> h.lvl) & 1, coalesce(s.d, '')
    FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang CROSS JOIN (SELECT DISTINCT lvl FROM top WHERE n > 1) h
    LEFT JOIN top s ON s.lvl = h.lvl AND s.i = xor(r.i >> h.lvl, 1)),
proof AS (
    SELECT doc_id, string_agg(d, '' ORDER BY part, lvl) AS siblings, list(CASE odd WHEN 1 THEN 'L' ELSE 'R' END || d ORDER BY part, lvl) AS steps
    FROM step GROUP BY doc_id)
SELECT doc_id, leaf, r.d AS subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM (
    SELECT l.*, siblings, (SELECT d FROM top WHERE n = 1) AS root,
        list_reduce(list_prepend(coalesce(altered, leaf), coalesce(steps, [])),
            lambda node, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || node ELSE node || s[2:] END)) AS folded_root
    FROM leaves l LEFT JOIN proof USING (doc_id)) x JOIN subroots r ON r.lang IS NOT DISTINCT FROM x.lang"""
