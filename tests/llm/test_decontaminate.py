"""The automaton against a scan of every window, and its spans in the original text."""

import re

from hypothesis import given, settings, strategies as st

from lakeops.llm import decontaminate as D

word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text, items):
    words = word.findall(lower(text))
    hit, found = set(), set()
    for name, item in items:
        w = word.findall(lower(item))
        if not w:
            continue
        n = min(13, len(w))
        for i in range(len(w) - n + 1):
            for j in range(len(words) - n + 1):
                if words[j: j + n] == w[i: i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(name) if name is not None else "null")
    return len(words), hit, sorted(found)


vocabulary = st.sampled_from(["a", "B", "é", "9", "A", "b.", "-", "_", "ab", "’x"])
text = st.lists(vocabulary, max_size=30).map(" ".join)


@settings(max_examples=80, deadline=None)
@given(text, st.lists(st.tuples(st.integers(0, 3), text), max_size=4))
def test_hits_equal_brute_force(doc, items):
    block = {}
    for name, item in items:
        for w, n in D.item_windows(item):
            names = block.setdefault(w, (n, []))[1]
            if str(name) not in names:
                names.append(str(name))
    got = D.scan_text(doc, D._automaton(block))
    n, hit, found = brute(doc, items)
    assert got["n_words"] == n and got["items"] == found
    assert {i for h in got["hits"] for i in range(h["first"], h["last"] + 1)} == hit
    for h in got["hits"]:
        assert len(word.findall(lower(doc[h["start"]: h["end"]]))) == h["last"] - h["first"] + 1


QUESTION = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def frames(spark):
    docs = spark.createDataFrame(
        [(1, "Say: ONE two, three four five six seven eight nine ten eleven twelve thirteen!", "x", 1),
         (1, None, "x", 1), (2, "", "x", 2), (3, "short ANSWER here", "y", None), (3, "short ANSWER here", "y", None),
         (4, "w " * 20000 + QUESTION, "y", None), (None, "nothing of it", "y", None)],
        "doc_id bigint, text string, hits string, n_words int")
    items = spark.createDataFrame([(7, QUESTION), (10, "short answer"), (None, "..."), (7, None)], "item_id bigint, text string")
    return docs, items


def test_operator_and_blocks(spark):
    docs, items = frames(spark)
    for size in (D.BLOCK_BYTES, 1):  # one automaton, or one per window
        out = D.with_hits(docs, items, "found", block_bytes=size)
        got = sorted(((r.doc_id or 0, r.found["n_words"], len(r.found["hits"]), r.found["items"]) for r in out.collect()), key=str)
        assert got == sorted([
            (1, 14, 1, ["7"]), (1, 0, 0, []), (2, 0, 0, []), (3, 3, 1, ["10"]), (3, 3, 1, ["10"]), (4, 20014, 1, ["7"]), (0, 3, 0, []),
        ], key=str)
    kept = D.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted((r for r in docs.collect() if r.doc_id in (2, 4, None) or r.text is None), key=str)


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert D.with_hits(docs.limit(0), items, "h").collect() == []
    assert D.without_contaminated(docs, items.limit(0)).count() == docs.count()
