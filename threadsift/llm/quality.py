"""Quality classifier by compression with two dictionaries.

A zstandard dictionary is trained on text labelled good and one on text labelled bad. A
text, cut into pieces so that it cannot teach itself for long, is compressed with both;
how many bytes the good dictionary saves against the bad one, for each byte of text, is
the evidence. A logistic curve over the evidence and the compressed size itself, fitted
on labelled texts that built no dictionary, turns it into a score from 0 to 1.

The model is fitted on at most SAMPLE labelled rows of each class, those with the least
hash of their id, and on PIECES pieces of each of them at most, taken by hash from all over
its text. Scoring always reads the whole text.

Edge cases: a null or empty text has evidence 0 and a size of 0 and gets the score of
that point. Labels that are null, or of documents that are not there, are ignored; if a
document has several labels the highest counts. Without labels of both classes every
score is 0.5. Repeated rows and null ids are scored like any other row. Columns other
than doc_id, text and the label are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.common import spread_pieces

#: Labelled rows of each class that the model is fitted on.
SAMPLE = 3000
#: Pieces of a labelled text, in characters, that the model is fitted on; scoring has no such bound.
PIECES = 4
PIECE_CHARS = 2000
PIECE_BYTES = 2048
SHORT = 40
DICTIONARY_BYTES = 96 * 1024
LEVEL = 3


def pieces(raw: bytes) -> list[bytes]:
    return [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: list[float]

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for raw in (self.good, self.bad):
            words = zstandard.ZstdCompressionDict(raw)
            words.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_content_size=False, write_dict_id=False))
        return made


def evidence(texts: list[str | None], compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """For each text: bytes saved by the good dictionary, bytes needed with it, and the weight of SHORT bytes.

    All are shares of the text's bytes plus SHORT, so that a few bytes more or less decide
    nothing in a very short text; an empty text has (0, 0, 1).
    """
    good, bad = compressors
    out = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        g = b = 0
        for piece in pieces(raw):
            g += len(good.compress(piece))
            b += len(bad.compress(piece))
        out[i] = np.array([b - g, g, SHORT]) / (len(raw) + SHORT)
    return out


def _design(x: np.ndarray) -> np.ndarray:
    d, size, short = x[:, 0] * 10, x[:, 1], x[:, 2]
    return np.stack([np.ones(len(x)), d, size, short, d * size, d * d, size * size, d * short], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, steps: int = 60) -> np.ndarray:
    """Newton's method for a logistic curve with a small penalty; a step that does not gain is halved."""

    def gain(w: np.ndarray) -> float:
        z = x @ w
        return float((y * z - np.logaddexp(0, z)).sum() - ridge / 2 * w @ w)

    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        while gain(w + step) < gain(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(texts: list[str]) -> bytes:
    samples = [p for t in texts for p in pieces(t.encode()) if len(p) >= 8]
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples for the trainer: their bytes are the dictionary
        return b"".join(samples)[-size:] or b" " * 8


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """Fit on labelled documents; labels: doc_id and a column of 0 and 1. None without both classes."""
    marked = labels.groupBy("doc_id").agg(F.max(label).alias("label")).filter("doc_id IS NOT NULL")
    chosen = None
    for value in (0, 1):
        part = marked.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * sample rows by construction.
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    part = F.concat_ws("", spread_pieces(F.col("text"), F.col("doc_id"), PIECE_CHARS, PIECES))
    rows = texts.select("doc_id", "label", part.alias("text")).limit(4 * sample).toPandas()
    rows = rows.sort_values(["doc_id", "text"])
    good, bad = (rows[rows.label == v].text.tolist() for v in (1, 0))
    if not good or not bad:
        return None
    model = Model(_dictionary(good[::2]), _dictionary(bad[::2]), [])
    held = good[1::2] or good, bad[1::2] or bad
    x = evidence(held[0] + held[1], model.compressors())
    y = np.repeat([1.0, 0.0], [len(held[0]), len(held[1])])
    model.weights = _logistic(_design(x), y).tolist()
    return model


def score(text: Column, model: Model | None) -> Column:
    """The score of a column of texts."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = model.compressors()
        w = np.array(model.weights)
        for texts in batches:
            x = _design(evidence(texts.tolist(), compressors))
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))))

    return scored(text)


def held_out(doc_id: Column) -> Column:
    """The third of the documents that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit_on_learning_part(documents: DataFrame, labels: DataFrame) -> Model | None:
    return fit(documents, labels.filter(~held_out(F.col("doc_id"))))


def scores(documents: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    got = documents.select(
        F.col("doc_id").cast("long"), held_out(documents["doc_id"]).alias("held_out"), score(documents["text"], model).alias("score")
    )
    return got.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def accepted(documents: DataFrame, model: Model | None) -> DataFrame:
    """The documents, all columns, that score 0.5 or more."""
    return documents.filter(score(documents["text"], model) >= 0.5)
