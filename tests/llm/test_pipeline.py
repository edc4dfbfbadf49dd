"""Every stage against a brute-force version of itself, on what its predecessor kept."""

import importlib.util
from pathlib import Path

from lakeops.llm import common, langid

import corpus_pipeline


def sibling(name):
    spec = importlib.util.spec_from_file_location(name, Path(__file__).with_name(f"{name}.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows, out = docs.columns, {r.doc_id: r for r in docs.collect()}, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        out[name] = {r.doc_id: r for r in docs.collect()} if name != "packing" else docs.collect()
        if name != "packing":
            assert docs.columns == columns and docs.count() == len(out[name])
    model = langid.train(langid.learn_from(spark.read.parquet(f"{sf}/documents.parquet")))
    import pyarrow as pa

    lang, score = model.predict(pa.array([r.text for r in rows.values()], pa.large_string()))
    assert set(out["language_id"]) == {d for d, x, s in zip(rows, lang, score) if x != "und" and s > 0}
    assert len(out["language_id"]) > 0.95 * len(rows)

    before = out["language_id"]
    lines = sibling("test_linededup").brute([(d, r.text) for d, r in before.items()])
    want = {d: text for d, (text, n, gone) in lines.items() if gone == 0 or gone < n}
    assert {d: r.text for d, r in out["line_dedup"].items()} == want
    assert all(r.n_chars == len(r.text) for r in out["line_dedup"].values())

    # a document is linked by what is left of it or by its whole text
    left = [(d, r.text) for d, r in out["line_dedup"].items()]
    whole = [(-d, rows[d].text) for d, text in left if rows[d].text != text]
    near = sibling("test_minhash").brute([*left, *whole])
    root = {d: d for d, _ in left}

    def find(x):
        return x if root[x] == x else find(root[x])

    first = {}
    for d, (_, c) in near.items():
        d = abs(d)
        a, b = sorted((find(d), find(first.setdefault(c, d))))
        root[b] = a
    assert set(out["near_dedup"]) == {d for d, _ in left if find(d) == d}

    scan = sibling("test_decontaminate")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    hits = {d: scan.brute(r.text, items) for d, r in out["near_dedup"].items()}
    assert set(out["decontamination"]) == {d for d, (n, hit, _) in hits.items() if not (hit and 20 * len(hit) >= n)}

    texts = {d: r.text for d, r in out["decontamination"].items()}
    cols = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length")
    sibling("test_packing").check_contract([tuple(r[c] for c in cols) for r in out["packing"]], texts, 4096)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, k string, gone int, hash string"


def run_stages(spark, sf, tmp_path, rows):
    """The stages over some rows, with columns of names that the operators use."""
    folder = str(tmp_path)
    spark.createDataFrame([(*r, "k", 1, "h") for r in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert name == "packing" or docs.columns == columns
        docs = common.written(docs, name)
        out[name] = docs.collect()
    return out


def test_nulls_repeated_ids_and_extra_columns(spark, sf, tmp_path):
    some = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(120).collect()]
    long = next(r for r in some if r[2] and r[1] and 400 < len(r[1]) < 3000)
    rows = [
        *some, (None, "A text without an id, in words of its own.", None, None, None), (None, None, None, None, None), (9_000, None, "en", "s", 0), (9_001, "", "en", "s", 0),
        (9_002, "!!! ... 123", "en", "s", 11), some[0], some[0], (some[0][0], "Another text under the same number.", "en", "s", 35), (9_003, *long[1:]),
        (9_004, " ".join(long[1].split() * 60), long[2], "s", 1)]
    out = run_stages(spark, sf, tmp_path, rows)
    ids = {name: {r.doc_id for r in rows_} for name, rows_ in out.items()}
    assert not ids["language_id"] & {9_000, 9_001, 9_002}  # no letter
    assert all(r.text for name in ids if name != "packing" for r in out[name])
    assert 9_003 not in ids["near_dedup"] and ids["packing"] <= ids["decontamination"]
    pieces = {}
    for r in out["packing"]:
        pieces.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in pieces.values():
        assert sum(n for _, n in p) <= 4096 and [o for o, _ in sorted(p)] == [sum(n for _, n in sorted(p)[:i]) for i in range(len(p))]


def test_empty_table(spark, sf, tmp_path):
    assert all(rows == [] for rows in run_stages(spark, sf, tmp_path, []).values())


def test_run(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 0
