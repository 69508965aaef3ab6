from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import SF_DIRS, compare, duck_connection

from pulsegrid.llm import merkle as M

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, root string"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, low=False):
    text = r[1] if r[1] is None or not low else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
    values = (r[0], r[3], r[2], r[4], text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """All levels of a tree over hashes, from the leaves to the last node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][a : a + 8])) for a in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 8 * 8
        out.append((level[a:i], level[i + 1 : a + 8]))
        i //= 8
    return out


def brute(rows):
    """The contract written plainly: (doc_id, leaf, subroot, root, proof, folded root, verified) of every row."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for lang in langs}
    climbed = {lang: climb([leaf(r) for r in trees[lang]]) for lang in langs}
    top = climb([climbed[lang][-1][0] for lang in langs])
    out = []
    for at, lang in enumerate(langs):
        for i, r in enumerate(trees[lang]):
            path = siblings(climbed[lang], i) + siblings(top, at)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = leaf(r, tampered)
            for left, right in path:
                node = H("".join([*left, node, *right]))
            proof = H("".join("".join(left + right) for left, right in path))
            out.append((r[0], leaf(r), climbed[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def found(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(M, "read_table", lambda *_: docs)
    return [tuple(r) for r in M.query(spark, "").collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


EDGES = [
    (1, "One TWO", "en", "s", 7), (2, None, "en", None, None), (3, "", "en", "s", 0), (4, "É ÀB 日本", "de", "s", 7), (5, "x" * 100_000 + "Y", "de", "", 9),
    (6, "Again", "en", "s", 5), (6, "Again", "en", "s", 5), (6, "Other", "en", "s", 5), (None, "No id", "en", "s", 5), (None, None, None, None, None),
    (7, "no Lang", None, "s", 7), (8, "empty Lang", "", "s", 10),
]


def test_edge_rows(spark, monkeypatch):
    rows = [(*r, "t", "r") for r in EDGES]
    assert order(found(spark, rows, monkeypatch)) == order(brute(rows))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_one_tree(spark, monkeypatch, n):
    rows = [(i, f"Text {i}", "en", "s", i, None, None) for i in range(n)]
    assert order(found(spark, rows, monkeypatch)) == order(brute(rows))


def test_several_layers_and_trees(spark, monkeypatch):
    """Blocks of 8 leaves, so that the rows and the trees over their subroots take three layers."""
    monkeypatch.setattr(M, "HEIGHT", 1)
    monkeypatch.setattr(M, "SPAN", 8)
    rng = np.random.default_rng(5)
    rows = [(int(i), f"Word {i}", "hot" if i % 3 == 0 else f"l{rng.integers(70)}", "s", 1, None, None) for i in rng.permutation(700)]
    assert order(found(spark, rows, monkeypatch)) == order(brute(rows))


def test_no_rows(spark, monkeypatch):
    assert found(spark, [], monkeypatch) == []


@pytest.mark.parametrize("levels", range(1, 6))
def test_addresses(levels):
    places = [M.veb_address(levels, d, np.arange(M.ARITY**d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(M.veb_size(levels))) and places[0][0] == 0
    # the subtrees below half the height are contiguous stretches
    upper = levels // 2
    if upper:
        size = M.veb_size(levels - upper)
        for d in range(upper, levels):
            below = M.ARITY ** (d - upper)
            starts = M.veb_size(upper) + np.arange(M.ARITY**d) // below * size
            assert ((places[d] >= starts) & (places[d] < starts + size)).all()


def test_every_change_is_found():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(100)]
    block = M.Block.build(leaves, 3)
    root = block.level(0)[0].tobytes()
    for i, path in enumerate(block.paths()):
        assert M.fold(leaves[i], path) == root != M.fold(leaves[i - 1], path)


def test_against_sql(spark):
    want = duck_connection(SF_DIRS["0.01"]).execute(M.SQL).df()
    assert compare(M.query(spark, SF_DIRS["0.01"]).toPandas(), want) == []


def test_other_columns_are_ignored(edge_docs):
    leaves = edge_docs.select(M.tree_key(F.col("lang")).alias("tree"), F.col("doc_id").alias("key"), M.row_hash(F.col("text")).alias("leaf"), F.lit(None).cast("binary").alias("carried"), "score")
    rows = M.proofs(M.build_manifest(leaves)).collect()
    assert len(rows) == edge_docs.count() and all(M.fold(bytes(r["leaf"]), bytes(r["path"])) == r["root"] and r["carried"] == r["leaf"] for r in rows)
