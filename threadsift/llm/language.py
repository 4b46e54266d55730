"""Language identification by a byte convolutional network, in numpy.

A text is cut into windows of WINDOW bytes, which stack up to a matrix. Filters of several
widths run over the bytes, each filter's greatest response in a window is kept (max
pooling), and a softmax layer turns these into probabilities of the languages. A text's
probabilities are the mean of those of all its windows, weighted by their lengths.

A filter over bytes sums one weight per position and byte value, so a response is a sum of
table rows. The network is trained in numpy by Adam on at most SAMPLE windows for each
language: pieces taken by hash from all over the labelled texts with the least hashes,
PIECES of a text and ROWS texts of a language at most. Which these are is found from the
hashes alone, in two steps over salted languages. Prediction reads whole texts.

Edge cases: a text that is null or has no letter is `und` with score 0; so is every text
when nothing is labelled. Labels that are null are not learnt from. Ties go to the first
language in order. Repeated rows and null ids are predicted like any other row. Other columns are
not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.common import spread_pieces
from threadsift.operators.ranking import first_n_per_key

WINDOW = 128
WIDTHS = (2, 3, 4, 5)
FILTERS = 12
#: Labelled rows of each language that are read, pieces of WINDOW characters of each of them, and windows learnt from.
ROWS = 600
PIECES = 12
SAMPLE = 2500
EPOCHS = 8
LEAST_STEPS = 300
RATE = 0.01
UNKNOWN = "und"


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows as a matrix of bytes padded with zeros, text of each, length of each)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    per = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(texts)), per)
    padded = b"".join(t.ljust(int(p) * WINDOW, b"\0") for t, p in zip(texts, per))
    matrix = np.frombuffer(padded, dtype=np.uint8).reshape(-1, WINDOW)
    first = np.cumsum(per) - per
    length = np.minimum(WINDOW, sizes[text] - (np.arange(len(text)) - first[text]) * WINDOW)
    return matrix, text, length


@dataclass
class Network:
    languages: list[str]
    tables: list[np.ndarray]  # for each width: width x 256 x FILTERS
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def pooled(self, matrix: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The greatest response of every filter in every window, and where it is."""
        out, where = [], []
        for table in self.tables:
            n = WINDOW - len(table) + 1
            response = table[0][matrix[:, :n]]
            for j in range(1, len(table)):
                response += table[j][matrix[:, j : j + n]]
            at = response.argmax(axis=1)
            out.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0, :])
            where.append(at)
        return np.concatenate(out, axis=1), where

    def strongest(self, matrix: np.ndarray) -> np.ndarray:
        """The same responses without their places, some windows at a time."""
        out = np.empty((len(matrix), len(self.bias)), dtype=np.float32)
        for a in range(0, len(matrix), 64):
            part = np.ascontiguousarray(matrix[a : a + 64].T)
            f = 0
            for table in self.tables:
                n = WINDOW - len(table) + 1
                response = table[0][part[:n]]
                for j in range(1, len(table)):
                    response += table[j][part[j : j + n]]
                out[a : a + 64, f : f + FILTERS] = response.max(axis=0)
                f += FILTERS
        return out

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        hidden = np.maximum(pooled + self.bias, 0)
        z = hidden @ self.dense + self.offset
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def train(matrix: np.ndarray, target: np.ndarray, languages: list[str], seed: int = 1) -> Network:
    """Adam on the cross entropy of windows, in batches of 64."""
    rng = np.random.default_rng(seed)
    tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    total = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        tables,
        np.zeros(total, np.float32),
        rng.normal(0, 0.3, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    values = [*net.tables, net.bias, net.dense, net.offset]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step = 0
    # Few windows are gone through more often.
    epochs = max(EPOCHS, -(-LEAST_STEPS * 64 // len(matrix)))
    for epoch in range(epochs):
        order = rng.permutation(len(matrix))
        for a in range(0, len(order), 64):
            rows = order[a : a + 64]
            x, y = matrix[rows], target[rows]
            pooled, where = net.pooled(x)
            hidden = np.maximum(pooled + net.bias, 0)
            slope = net.probabilities(pooled)
            slope[np.arange(len(rows)), y] -= 1
            slope /= len(rows)
            back = (slope @ net.dense.T) * (hidden > 0)
            gradients = []
            for i, table in enumerate(net.tables):
                g = np.zeros_like(table)
                part = back[:, i * FILTERS : (i + 1) * FILTERS]
                for j in range(len(table)):
                    seen = np.take_along_axis(x, where[i] + j, axis=1)
                    np.add.at(g[j], (seen, np.arange(FILTERS)[None, :].repeat(len(rows), 0)), part)
                gradients.append(g)
            gradients += [back.sum(axis=0), hidden.T @ slope, slope.sum(axis=0)]
            step += 1
            rate = RATE / (1 + epoch * EPOCHS / epochs)
            for v, g, m, s in zip(values, gradients, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def fit(documents: DataFrame, rows: int = ROWS) -> Network | None:
    """Learn from text and lang of documents; None if none has a language."""
    marked = documents.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    least = first_n_per_key(marked.select("lang", "h"), ["lang"], [F.col("h")], rows, "h")
    borders = least.groupBy("lang").agg(F.max("h").alias("most")).collect()  # a row for each language the network knows
    if not borders:
        return None
    chosen = reduce(or_, ((F.col("lang") == r.lang) & (F.col("h") <= r.most) for r in borders))
    # Only equal rows share a hash; of these no more than so many are of use.
    taken = marked.filter(chosen).limit(2 * rows * len(borders))
    found = taken.select("lang", "h", F.concat_ws("", spread_pieces(F.col("text"), F.col("h"), WINDOW, PIECES)).alias("text")).toPandas()
    languages = sorted(found["lang"].unique())
    parts = [found[found["lang"] == name].sort_values(["h", "text"])[:rows] for name in languages]
    sample, target = [], []
    rng = np.random.default_rng(0)
    for number, part in enumerate(parts):
        matrix, _, length = windows_of([t.encode() for t in part["text"]])
        matrix = matrix[length >= min(40, WINDOW)] if (length >= 40).any() else matrix
        matrix = matrix[rng.permutation(len(matrix))[:SAMPLE]]
        # Half of them are cut short, so that short texts look like something learnt.
        cut = np.where(rng.random(len(matrix)) < 0.5, rng.integers(8, WINDOW, len(matrix)), WINDOW)
        matrix = np.where(np.arange(WINDOW)[None, :] < cut[:, None], matrix, 0).astype(np.uint8)
        sample.append(matrix)
        target.append(np.full(len(matrix), number))
    matrix, target = np.concatenate(sample), np.concatenate(target)
    return train(matrix, target, languages) if len(matrix) else None


def held_out(doc_id: Column) -> Column:
    """The quarter of the documents that is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def predict(documents: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""

    @F.pandas_udf("lang string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            raw = [t.encode() for t in texts]
            shares = np.zeros((len(raw), len(net.languages)))
            done = 0
            while done < len(raw):
                end, size = done, 0
                while end < len(raw) and (end == done or size < 1 << 20):
                    size += len(raw[end])
                    end += 1
                matrix, text, length = windows_of(raw[done:end])
                if len(matrix):
                    p = net.probabilities(net.strongest(matrix)) * length[:, None]
                    np.add.at(shares, done + text, p)
                done = end
            best = shares.argmax(axis=1)
            total = np.maximum(shares.sum(axis=1), 1)
            yield pd.DataFrame({"lang": [net.languages[i] for i in best], "score": shares[np.arange(len(raw)), best] / total})

    text = F.col("text")
    base = documents.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    if net is None:
        return base.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = base.withColumn("found", predicted(text))
    lettered = text.rlike("\\p{L}")
    return found.select(
        "doc_id",
        "held_out",
        F.when(lettered, F.col("found.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(lettered, F.col("found.score")).otherwise(0.0).alias("score"),
    )


def languages(documents: DataFrame) -> DataFrame:
    """Predictions of every document by a network fitted on those that are not held out."""
    return predict(documents, fit(documents.filter(~held_out(F.col("doc_id")))))
