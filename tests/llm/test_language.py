"""The byte network: held-out accuracy, training, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from threadsift.llm import language
from threadsift.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op7_language_id"](spark, folder).collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_edge_cases(documents):
    texts = [(i, "the cat sat on the mat and the dog ran by " * 3) for i in range(30)]
    other = [(100 + i, "le chat est sur la table et le chien part " * 3) for i in range(30)]
    frame = documents(texts).unionByName(documents(other).withColumn("lang", F.lit("fr")))
    net = language.fit(frame)
    odd = [(1, None), (2, ""), (3, "12 34 --"), (4, "é"), (None, "the mat and the dog"), (5, "le chien et la table " * 20_000), (5, "le chien")]
    rows = language.predict(documents(odd, {"found": F.lit(1), "score": F.lit("x")}), net).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.lang_pred)
    assert by[1] == by[2] == by[3] == ["und"] and by[None] == ["en"] and by[5] == ["fr", "fr"] and len(rows) == 7
    assert language.fit(documents([])) is None
    assert [r.lang_pred for r in language.predict(documents([(1, "abc")]), None).collect()] == ["und"]
    assert language.predict(documents([]), net).collect() == []


def test_windows_cover_the_whole_text():
    texts = [b"", b"a" * 300, "é".encode() * 64, b"x"]
    matrix, text, length = language.windows_of(texts)
    assert text.tolist() == [1, 1, 1, 2, 3] and length.tolist() == [128, 128, 44, 128, 1]
    assert b"".join(m[:n].tobytes() for m, n in zip(matrix, length)) == b"".join(texts)


def test_pooling_is_the_same_with_and_without_places():
    rng = np.random.default_rng(1)
    matrix = rng.integers(0, 256, (70, language.WINDOW)).astype(np.uint8)
    net = language.train(matrix[:8], np.zeros(8, dtype=int), ["a", "b"])
    assert np.allclose(net.pooled(matrix)[0], net.strongest(matrix), atol=1e-5)


def test_scores_are_those_of_plain_sums(documents):
    """Every filter at every position of every window, one product after the other."""
    rng = np.random.default_rng(7)
    texts = ["the cat sat on the mat", "le chien part, é", "x" * 300 + " abc", "a", "mixed le the " * 30, "ÀÉ 日本 ok"]
    net = language.train(rng.integers(32, 122, (40, language.WINDOW)).astype(np.uint8), np.arange(40) % 3, ["de", "en", "fr"])

    def plain(text):
        raw, total, weight = text.encode(), np.zeros(3), 0
        for begin in range(0, len(raw), language.WINDOW):
            part = raw[begin : begin + language.WINDOW]
            window = part.ljust(language.WINDOW, b"\0")
            hidden = []
            for table in net.tables:
                for f in range(language.FILTERS):
                    sums = [sum(float(table[j, window[at + j], f]) for j in range(len(table))) for at in range(language.WINDOW - len(table) + 1)]
                    hidden.append(max(0.0, max(sums) + float(net.bias[len(hidden)])))
            z = [sum(h * float(net.dense[i, c]) for i, h in enumerate(hidden)) + float(net.offset[c]) for c in range(3)]
            e = np.exp(np.array(z) - max(z))
            total += e / e.sum() * len(part)
            weight += len(part)
        return net.languages[int(total.argmax())], total.max() / weight

    rows = {r.doc_id: r for r in language.predict(documents(list(enumerate(texts))), net).collect()}
    for i, text in enumerate(texts):
        name, score = plain(text)
        assert rows[i].lang_pred == name and abs(rows[i].score - score) < 1e-4


def test_learns_from_all_parts_of_a_text_and_from_repeated_rows(documents):
    """What stands only at the end of long texts is learnt; a third of all rows may be one row."""
    tail = "zwölf boxkämpfer jagen viktor quer über den großen sylter deich " * 40
    head = "0123 4567 " * 100
    german = [(i, head + tail) for i in range(40)]
    english = [(100 + i, head + "the quick brown fox jumps over the lazy dog near the river " * 40) for i in range(40)]
    frame = documents(english).unionByName(documents(german + [(None, tail)] * 2000).withColumn("lang", F.lit("de")))
    net = language.fit(frame, rows=50)
    found = {r.doc_id: r.lang_pred for r in language.predict(documents([(1, "über den großen deich"), (2, "over the lazy dog near")]), net).collect()}
    assert found == {1: "de", 2: "en"}
