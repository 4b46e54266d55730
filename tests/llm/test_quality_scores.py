"""The compression classifier: held-out accuracy and edge cases."""

import pytest
from pyspark.sql import functions as F

from threadsift.llm import quality
from threadsift.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op1_quality_scores"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = rows.filter("held_out").join(labels, "doc_id").select("predicted", "quality", "score").collect()
    assert len(held) > 80
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in held)
    assert rows.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


@pytest.fixture()
def labelled(documents, spark):
    good = [(i, f"the river ran past house number {i} and then into the quiet sea beyond. " * 3) for i in range(40)]
    bad = [(100 + i, f"BUY!! ### {i} $$$ CHEAP!! %%% *** NOW!! " * 5) for i in range(40)]
    marks = [(i, 1, 0) for i, _ in good] + [(i, 0, 1) for i, _ in bad] + [(5, 0, 0), (None, 0, 0), (7777, 1, 0), (3, None, 0)]
    return documents(good + bad), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_scores_nulls_repeats_and_long_texts(documents, labelled):
    model = quality.fit(*labelled)
    odd = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "the quiet sea " * 9), (9, "BUY!! $$$ " * 50_000)]
    rows = quality.scores(documents(odd, {"score": F.lit("s"), "held_out": F.lit(7)}), model).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[None].predicted == 1 and by[None].held_out is False and by[9].predicted == 0
    assert by[1].score == by[2].score


def test_rejected_documents_go_with_all_columns_kept(documents, labelled):
    model = quality.fit(*labelled)
    frame = documents([(1, "the river ran past the house and then into the sea."), (2, "CHEAP!! $$$ %%% BUY!! ***" * 4)], {"score": F.lit(1)})
    kept = quality.accepted(frame, model)
    assert kept.columns == frame.columns and [r.doc_id for r in kept.collect()] == [1]


def test_without_labels_of_both_classes(documents, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(documents([(1, "a")]), none) is None
    rows = quality.scores(documents([(1, "a")]), None).collect()
    assert rows[0].score == 0.5 and rows[0].predicted == 1
    assert quality.scores(documents([]), None).collect() == []


def test_scores_are_those_of_a_loop_over_pieces(documents, labelled):
    """Each piece compressed by itself with a compressor made for it, the curve written out."""
    import math

    import zstandard

    model = quality.fit(*labelled)
    texts = ["the river ran past", "", None, "BUY!! $$$", "é" * 3000, "mixed words $$$ and the sea " * 400]

    def size(raw, dictionary):
        words = zstandard.ZstdCompressionDict(dictionary)
        return len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=words, write_content_size=False, write_dict_id=False).compress(raw))

    def plain(text):
        raw = (text or "").encode()
        cut = [raw[i : i + quality.PIECE_BYTES] for i in range(0, len(raw), quality.PIECE_BYTES)]
        good, bad = (sum(size(p, d) for p in cut) for d in (model.good, model.bad))
        whole = len(raw) + quality.SHORT
        d, s, short = 10 * (bad - good) / whole, good / whole, quality.SHORT / whole
        z = sum(w * x for w, x in zip(model.weights, [1, d, s, short, d * s, d * d, s * s, d * short]))
        return 1 / (1 + math.exp(-min(30, max(-30, z))))

    rows = {r.doc_id: r.score for r in quality.scores(documents(list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        assert abs(rows[i] - plain(text)) < 1e-9


def test_pieces_come_from_all_over_a_text(spark):
    from threadsift.llm.common import spread_pieces

    text = "".join(f"{i:04d}" for i in range(2500))
    frame = spark.range(50).withColumn("text", F.lit(text))
    rows = frame.select(spread_pieces(F.col("text"), F.col("id"), 100, 4).alias("p")).collect()
    starts = {int(p[:4]) for r in rows for p in r.p}
    assert all(len(r.p) == 4 and r.p == sorted(r.p) and all(p in text for p in r.p) for r in rows)
    assert min(starts) < 300 and max(starts) > 2200 and len(starts) > 60
    short = spark.createDataFrame([("",), ("ab",), ("é" * 250,)], "text string").select(spread_pieces(F.col("text"), F.lit(1), 100, 4).alias("p")).collect()
    assert [r.p for r in short] == [[""], ["ab"], ["é" * 100, "é" * 100, "é" * 50]]
