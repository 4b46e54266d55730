"""Line dedup against a loop over lines."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from threadsift.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(docs, min_docs=2, min_chars=10):
    """docs: texts in order of their keys; gives (lines, dropped, kept text) of each."""
    holders = defaultdict(set)
    split = [(t or "").split("\n") for t in docs]
    for i, lines in enumerate(split):
        for line in lines:
            holders[key(line)].add(i)
    out = []
    for i, lines in enumerate(split):
        stays = [not (len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and i != min(holders[key(x)])) for x in lines]
        out.append((len(lines), stays.count(False), "\n".join(x for x, s in zip(lines, stays) if s)))
    return out


def corpus():
    rng = random.Random(3)
    pool = [f"shared line number {i}" for i in range(12)] + ["short", "ÉÈ grüße über alle", "exactly10!", "nine char", "", "  ", "\r", "a line with odd space "]
    docs = []
    for i in range(80):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"own line {i} {j}" for j in range(rng.randint(0, 12))]
        lines = [rng.choice(["", " ", "\t\x0b"]) + (x.upper() if rng.random() < 0.3 else x) + rng.choice(["", "\r", " \x0c"]) for x in lines]
        docs.append("\n".join(lines))
    docs += [None, "", "\n", "\n\n\n", "shared line number 1\n" * 2000, "own\n" * 3 + "only here, twice\nonly here, twice", "only here, twice"]
    return docs


@pytest.mark.parametrize("hot", [1, 1 << 16])
def test_equals_brute_force(documents, monkeypatch, hot):
    """With hot = 1 no line is shipped, with 65,536 all are."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    docs = corpus()
    frame = documents(list(enumerate(docs)), {"k": F.lit(9), "position": F.lit("p"), "hash": F.lit("h"), "kept": F.lit(0)})
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.digests(frame).collect()}
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, (n, d, t) in enumerate(brute(docs))}
    assert got == want
    assert sum(d for _, d, _ in got.values()) > 100


def test_other_thresholds(documents):
    docs = corpus()
    rows = line_dedup.deduplicated(documents(list(enumerate(docs))), min_docs=5, min_chars=3).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in rows} == dict(enumerate(brute(docs, 5, 3)))


def test_repeated_and_missing_ids_are_documents_of_their_own(documents):
    pairs = [(None, "a line of text\nb"), (None, "A line of text"), (3, "a line of text"), (3, "a line of text"), (1, None)]
    rows = line_dedup.deduplicated(documents(pairs)).collect()
    got = sorted(((r.doc_id, r.kept) for r in rows), key=repr)
    # Nulls come first, by text: the upper-case row holds the line.
    assert got == sorted([(None, "A line of text"), (None, "b"), (1, ""), (3, ""), (3, "")], key=repr)


def test_cleaned_keeps_all_columns(documents):
    frame = documents([(1, "the same words\nx"), (2, "y\nThe Same Words \nz")], {"n_dropped": F.lit("keep"), "row": F.lit(5)})
    rows = line_dedup.cleaned(frame)
    assert rows.columns == frame.columns
    assert [(r.doc_id, r.text, r.n_dropped, r.row) for r in rows.orderBy("doc_id").collect()] == [(1, "the same words\nx", "keep", 5), (2, "y\nz", "keep", 5)]


def test_empty_table(documents):
    assert line_dedup.digests(documents([])).collect() == []


def test_plan_has_no_python_and_no_cross_join(documents):
    plan = line_dedup.digests(documents(list(enumerate(corpus()))))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
