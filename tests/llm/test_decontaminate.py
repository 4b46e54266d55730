"""Containment search against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from threadsift.llm import decontaminate


def shingle_set(text):
    words = [w for w in re.split(r"[ \t-\r]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, items):
    out = []
    for d, text in docs:
        own = shingle_set(text)
        for i, item in items:
            parts = shingle_set(item)
            if parts and 100 * len(parts & own) >= 80 * len(parts):
                out.append((d, i, len(parts & own), len(parts)))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["É", "Ab"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(40)]
    items += [(50, None), (51, ""), (52, " \n"), (53, "one two"), (54, items[3][1]), (54, items[4][1])]
    docs = []
    for i in range(120):
        w = rng.choices(words, k=rng.randint(0, 400))
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items[:40])[1] or "").split(" ")
            for _ in range(rng.randint(0, 3)):
                part[rng.randrange(len(part))] = rng.choice(words)
            at = rng.randint(0, len(w))
            w[at:at] = part
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(w).upper() if i % 5 == 0 else " ".join(w)))
    docs += [(500, None), (501, ""), (502, "One\nTwo"), (502, "One\nTwo"), (None, items[0][1]), (503, items[1][1] * 500)]
    return docs, items


@pytest.mark.parametrize("rows", [0, 200_000])
def test_equals_brute_force(documents, spark, monkeypatch, rows):
    monkeypatch.setattr(decontaminate, "SIGNATURE_ROWS", rows)
    docs, items = corpus(rows)
    frame = documents(docs, {"item": F.lit("x"), "value": F.lit(1)})
    found = decontaminate.contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    got = sorted([(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in found.collect()], key=repr)
    assert got == brute(docs, items) and len(got) > 40


def test_clean_documents_stay_with_all_columns(documents, spark):
    docs, items = corpus(9)
    frame = documents(docs, {"k": F.lit("x"), "item": F.lit(2)})
    kept = decontaminate.clean(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == frame.columns
    hit = {d for d, *_ in brute(docs, items)}
    assert sorted([r.doc_id for r in kept.collect()]) == sorted(d for d, _ in docs if d not in hit)


def test_empty_tables(documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.contaminated(documents([(1, "a b c d e f")]), none).collect() == []
    assert decontaminate.contaminated(documents([]), some).collect() == []
    assert decontaminate.clean(documents([(1, "a b c d e f")]), none).count() == 1


def test_no_python_in_the_plan(documents, spark):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    plan = decontaminate.contaminated(documents([(1, "a b c d e f g")]), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
