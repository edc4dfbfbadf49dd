"""Merkle manifest against trees built level by level."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from lakeops.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(leaves, height=None):
    """All levels of a tree, up to its top or ``height``."""
    out = [list(leaves)]
    while len(out[-1]) > 1 or (height is not None and len(out) <= height):
        out.append([H(*out[-1][i: i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def postorder(tree, level, index):
    if level:
        for child in (2 * index, 2 * index + 1):
            if child < len(tree[level - 1]):
                yield from postorder(tree, level - 1, child)
    yield level, index


@pytest.mark.parametrize("n", [*range(1, 36), 64, 77, 128])
@pytest.mark.parametrize("more", [0, 2])
def test_positions_and_segments(n, more):
    leaves = [H(str(i)) for i in range(n)]
    height = M.tree_height(n) + more
    tree = levels(leaves, height)
    order = list(postorder(tree, height, 0))
    assert M.segment(leaves, height) == [tree[a][b] for a, b in order]
    level, index = (np.array(x) for x in zip(*order))
    assert M.positions(level, index, n).tolist() == list(range(len(order)))


def encode(row):
    text = "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)
    return hashlib.sha256(text.encode()).hexdigest()


def sibling_steps(tree, i):
    for level in tree[:-1]:
        pair = level[i & ~1: (i & ~1) + 2]
        yield ("", "".join(pair[1:])) if i % 2 == 0 else (pair[0], "")
        i >>= 1


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text); sorted result rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, encode(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = levels([x[2] for x in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(groups[g]):
            steps = [*sibling_steps(trees[g], i), *sibling_steps(top, place)]
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                node = encode((*r[:3], r[3] + 1, r[4]))
            for left, right in steps:
                node = H(left, node, right)
            root = top[-1][0]
            out.append((r[0], leaf, trees[g][-1][0], root, H(*(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=str)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def run(spark, rows, monkeypatch, tmp_path, schema=SCHEMA, parts=3):
    spark.createDataFrame(rows, schema).repartition(parts).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in M.query(spark, str(tmp_path)).collect()), key=str)


@pytest.mark.parametrize("bits, n, seed", [(10, 60, 1), (2, 130, 2), (1, 37, 3)])
def test_trees_of_several_tiers(spark, monkeypatch, tmp_path, bits, n, seed):
    monkeypatch.setattr(M.manifest, "__kwdefaults__", {**M.manifest.__kwdefaults__, "bits": bits})
    rnd = random.Random(seed)
    langs = ["de", "en", "en", "en", None, "é", "z", "=a", "", *(f"l{i}" for i in range(6))]
    rows = [(i, rnd.choice(["web", None, "é"]), rnd.choice(langs), rnd.choice([None, i]), rnd.choice([None, "", "é1:", f"text {i}"])) for i in range(n)]
    assert run(spark, rows, monkeypatch, tmp_path, parts=7) == brute(rows)


def test_nulls_repeats_and_extra_columns(spark, monkeypatch, tmp_path):
    rows = [(None, "s", "en", 3, "a"), (None, None, None, None, None), (1, "s", "en", 2**63 - 1, "b"), (1, "s", "en", 4, "c"), (7, "s", "de", 4, "x" * 300_000),
            (5, "s", "fr", 1, "same"), (5, "s", "fr", 1, "same"), (5, "s", "fr", 1, "same")]
    got = run(spark, [(*r, "p", 1, "t") for r in rows], monkeypatch, tmp_path, SCHEMA + ", path string, n int, tree string")
    assert got == brute(rows)


def test_empty_and_lone(spark, monkeypatch, tmp_path):
    assert run(spark, [], monkeypatch, tmp_path) == []
    rows = [(4, "s", "en", 1, "only")]
    got = run(spark, rows, monkeypatch, tmp_path)
    assert got == brute(rows) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == H()


def test_one_group_over_many_partitions(spark, monkeypatch, tmp_path):
    rows = [(i // 2, "s", "en", i, f"text {i % 3}") for i in range(5_000)]  # ties in the key
    got = run(spark, rows, monkeypatch, tmp_path, parts=13)
    assert got == brute(rows)
    assert sum(not r[-1] for r in got) == sum(zlib.crc32(str(r[0]).encode()) % 7 == 0 for r in rows)
    log = M.manifest(spark.createDataFrame(rows, SCHEMA)).log
    assert log[0].count() == 5 and max(r.own for r in log[0].collect()) == 1 << M.BITS
