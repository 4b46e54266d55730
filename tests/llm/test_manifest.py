"""The Merkle manifest against lists in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from threadsift.llm import manifest
from tests.llm.conftest import DOCUMENTS


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        nodes = out[-1]
        out.append([h("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)])
    return out


def path(tree, at):
    """(left, right) siblings on each level."""
    out = []
    for nodes in tree[:-1]:
        first = at // 8 * 8
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 8])))
        at //= 8
    return out


def fold(node, steps):
    for left, right in steps:
        node = h(left + node + right)
    return node


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text); gives the query's rows."""
    parts = {}
    for row in rows:
        parts.setdefault(row[2], []).append(row)
    order = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees, members = {}, {}
    for lang in order:
        members[lang] = sorted(parts[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in members[lang]])
    top = levels([trees[lang][-1][0] for lang in order])
    root = top[-1][0]
    out = []
    for i, lang in enumerate(order):
        for at, row in enumerate(members[lang]):
            steps = path(trees[lang], at) + path(top, i)
            claimed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                claimed = (*row[:4], lowered(row[4]))
            folded = fold(leaf(claimed), steps)
            out.append((row[0], leaf(row), trees[lang][-1][0], root, h("".join(a + b for a, b in steps)), folded, folded == root))
    return sorted(out, key=repr)


def rows_of(seed, sizes):
    rng = random.Random(seed)
    rows = []
    for lang, n in sizes.items():
        for i in rng.sample(range(10 * n), n):
            rows.append((i, rng.choice(["src", "", None, "é"]), lang, rng.choice([None, 0, -3, 17]), rng.choice([None, "", "-", "Text A", "low é", "ÀB", "x" * 5000])))
    rng.shuffle(rows)
    return rows


def got(spark, table, **extra):
    frame = spark.createDataFrame([(d, t, g, s, n) for d, s, g, n, t in table], DOCUMENTS)
    for name, value in extra.items():
        frame = frame.withColumn(name, value)
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in manifest.digests(frame).collect()), key=repr)


@pytest.mark.parametrize("stride", [1, 2, 3])
def test_equals_brute_force(spark, monkeypatch, stride):
    """Partitions of one row, of a full run, of one more, of several stored levels; null and empty ones."""
    monkeypatch.setattr(manifest, "STRIDE", stride)
    sizes = {None: 9, "": 1, "de": 8, "en": 700 if stride < 3 else 1300, "es": 65, "Z": 64, "é": 2, "zz": 3, "q": 1, "r": 1}
    rows = rows_of(stride, sizes)
    found = got(spark, rows, key=F.lit("k"), position=F.lit(0), digest=F.lit("x"), rows=F.lit(1))
    assert found == brute(rows)
    changed = [r for r in found if not r[-1]]
    assert 0 < len(changed) < len(found) / 2


def test_repeated_rows_and_missing_ids(spark):
    rows = [(1, "s", "en", 1, "A")] * 9 + [(None, "s", "en", 1, "B"), (None, None, None, None, None), (1, "s", "en", 1, "b")]
    assert got(spark, rows) == brute(rows)


def test_one_row_and_no_row(spark):
    rows = [(7, "s", None, 1, "Only")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []


def test_null_differs_from_empty_and_from_its_sign(spark):
    frame = spark.createDataFrame([(None,), ("",), ("-",)], "v string")
    assert [r[0] for r in frame.select(manifest.framed(F.col("v"))).collect()] == ["-", "0:", "1:-"]


def test_only_every_third_level_is_written(spark):
    leaves = spark.range(5000).select(F.lit("k").alias("key"), F.col("id").alias("position"), F.lit(5000).cast("long").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    tree = manifest.Tree(leaves)
    assert [level.select(F.sum(F.size("rows"))).first()[0] for level in tree.levels] == [5000, 10]
    assert tree.roots().collect()[0].digest == levels([h(str(i)) for i in range(5000)])[-1][0]
