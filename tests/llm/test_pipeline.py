"""The pipeline against the stages' brute-force versions, in plain Python."""

import random

import corpus_pipeline
import pytest
from test_decontaminate import brute as brute_contained
from test_jaccard import brute as brute_linked
from test_packing import check as check_packing

from threadsift.llm import packing, quality


def cut_repeats(pairs, size=100):
    """Texts without the bytes of strings that stand earlier; characters that lose a byte go whole."""
    seen, out = set(), []
    for doc_id, text in sorted(pairs, key=lambda p: p[0]):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - size + 1):
            piece = raw[i : i + size]
            if piece in seen:
                gone[i : i + size] = [True] * size
            seen.add(piece)
        at, kept = 0, []
        for char in text or "":
            n = len(char.encode())
            if not any(gone[at : at + n]):
                kept.append(char)
            at += n
        out.append((doc_id, text if text is None else "".join(kept)))
    return out


@pytest.fixture()
def folder(spark, documents, tmp_path):
    rng = random.Random(8)
    words = [f"word{i}" for i in range(500)] + ["naïve", "Straße"]
    passage = " ".join(rng.choices(words, k=40))
    items = [(i, " ".join(rng.choices(words, k=30))) for i in range(3)]
    pairs = []
    for i in range(60):
        text = " ".join(rng.choices(words, k=rng.randint(5, 80))) + "."
        if i % 7 == 0:
            text += " " + passage
        if i % 11 == 0:
            text += " " + items[i % 3][1]
        if i % 6 == 5:
            text = pairs[-1][1] + " extra"
        if i % 10 == 9:
            text = "### $$$ BUY!! %%% " * rng.randint(3, 9)
        pairs.append((i, text))
    pairs += [(90, None), (91, ""), (92, pairs[0][1]), (93, "q " * 4000)]
    frame = documents(pairs)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    marks = [(i, 0 if i % 10 == 9 else 1, 0) for i in range(60)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path), frame, pairs, items


def test_run_equals_brute_force(spark, folder):
    path, frame, pairs, items = folder
    labels = spark.read.parquet(f"{path}/labels.parquet")
    model = quality.fit_on_learning_part(frame, labels)
    scores = {r.doc_id: r.score for r in quality.scores(frame, model).collect()}
    docs = [(i, t) for i, t in pairs if scores[i] >= 0.5]
    assert 30 < len(docs) < len(pairs)
    heads = {c for _, _, c in brute_linked(docs)}
    docs = cut_repeats([(i, t) for i, t in docs if i in heads])
    hit = {d for d, *_ in brute_contained(docs, items)}
    docs = [(i, t) for i, t in docs if i not in hit]
    assert hit
    rows = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in docs}
    check_packing(rows, docs, packing.LENGTH)


def test_stages_keep_the_columns_of_documents(spark, folder):
    path, frame, _, _ = folder
    docs = frame
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.schema.names == frame.schema.names
        assert docs.count() <= frame.count()
