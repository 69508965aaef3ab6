"""Merkle manifest of a dataset: aligned blocks of nodes in van Emde Boas order.

Every row is a leaf. The leaves of one tree (a language, say) stand in ascending order of
their key; while several nodes remain, every ``ARITY`` consecutive ones (the last run may
hold fewer, even one) become the hash of their hex texts. A tree's last node is its
subroot, a lone leaf itself; the subroots, in order of their trees' keys, are
the leaves of one more tree whose last node is the root.

Layout. ``ARITY ** HEIGHT`` consecutive leaves are a block: an aligned subtree, one row of
the manifest, with its nodes in one binary column in van Emde Boas order. The subtree is
split at half its height; the upper part comes first, then the lower parts from
left to right, each laid out in the same way. A path from a leaf to the
block's root so crosses few lines or pages of any size, and a node's place follows
from its depth and index by arithmetic alone (:func:`veb_address`): no pointers, no
tables. Building reads the children of a node, proofs its siblings, through that address. The
roots of a layer's blocks are the leaves of the next layer, until a tree has one block.

Spark does the work at scale: leaf hashes are column expressions, texts are never
shuffled; (tree, key, hash) is range-partitioned, so that a tree with a third of
all rows is many tasks, and ranks come from counts per range and tree. A task holds one block at a
time. Proofs go from the top layer down: each block hands its children the siblings
above them, so a row meets its siblings in its own block only.

Rows: a NULL field is ``-``. NULL keys come first, rows of one key are in order of their hashes,
so equal rows are neighbours; each is a leaf of its own. A NULL tree is a tree, the
first. A table without rows has a manifest without blocks and no proofs. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import read_table, stored

ARITY = 8
# a block has ARITY ** HEIGHT leaves: 4,096, about 150 KB of nodes
HEIGHT = 4
SPAN = ARITY**HEIGHT
_DIGEST = 32

NODES = "tree string, block long, n long, height int, nodes binary, root binary"


def veb_size(levels: int) -> int:
    """Nodes of a complete subtree with so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def veb_address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (0: the root) of a subtree of ``levels`` levels in van Emde Boas order."""
    index = np.asarray(index, np.int64)
    base = np.zeros(len(index), np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        depth, lower = depth - upper, levels - upper
        below = ARITY**depth
        base += veb_size(upper) + (index // below) * veb_size(lower)
        index = index % below
        levels = lower
    return base


def node_hash(digests: bytes) -> bytes:
    """The hash over the hex texts of concatenated digests."""
    return hashlib.sha256(digests.hex().encode()).digest()


class Block:
    """An aligned subtree over ``count`` leaves: digests in van Emde Boas order, reached by address."""

    def __init__(self, height: int, count: int, nodes: bytes | np.ndarray):
        self.height, self.count = height, count
        self.nodes = np.frombuffer(nodes, np.uint8).reshape(-1, _DIGEST) if isinstance(nodes, bytes) else nodes

    @classmethod
    def build(cls, leaves: list[bytes], height: int) -> Block:
        block = cls(height, len(leaves), np.zeros((veb_size(height + 1), _DIGEST), np.uint8))
        block._put(height, np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, _DIGEST))
        for depth in range(height - 1, -1, -1):
            below = block.level(depth + 1).tobytes()
            run = ARITY * _DIGEST
            made = b"".join(node_hash(below[a : a + run]) for a in range(0, len(below), run))
            block._put(depth, np.frombuffer(made, np.uint8).reshape(-1, _DIGEST))
        return block

    def _put(self, depth: int, digests: np.ndarray) -> None:
        self.nodes[veb_address(self.height + 1, depth, np.arange(len(digests)))] = digests

    def width(self, depth: int) -> int:
        """Nodes at a depth."""
        return -(-self.count // ARITY ** (self.height - depth))

    def level(self, depth: int) -> np.ndarray:
        """The digests at a depth from left to right."""
        return self.nodes[veb_address(self.height + 1, depth, np.arange(self.width(depth)))]

    def paths(self, above: bytes = b"") -> list[bytes]:
        """Per leaf the siblings at every depth up to the root, then ``above``.

        A step of a path is the number of siblings, the node's place among them (a byte each), and their digests.
        """
        found = [above]
        for depth in range(1, self.height + 1):
            digests = self.level(depth).tobytes()
            out = []
            for a in range(0, self.width(depth), ARITY):
                run = digests[a * _DIGEST : (a + ARITY) * _DIGEST]
                n, rest = len(run) // _DIGEST, found[a // ARITY]
                out += [bytes((n - 1, k)) + run[: k * _DIGEST] + run[(k + 1) * _DIGEST :] + rest for k in range(n)]
            found = out
        return found


def steps(path: bytes) -> Iterator[tuple[int, bytes]]:
    """(place, siblings) of every step of a path."""
    at = 0
    while at < len(path):
        end = at + 2 + path[at] * _DIGEST
        yield path[at + 1], path[at + 2 : end]
        at = end


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for place, siblings in steps(path):
        cut = place * _DIGEST
        leaf = node_hash(siblings[:cut] + leaf + siblings[cut:])
    return leaf


# ---------------------------------------------------------------- leaves


def row_hash(*fields: Column) -> Column:
    """SHA-256 (binary) over the fields' texts, each as its UTF-8 byte count, ``:`` and the value; NULL is ``-``."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def tree_key(column: Column) -> Column:
    """A text that orders as the column's UTF-8 bytes do, NULL first, and is never NULL itself."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text))


# ---------------------------------------------------------------- building


class Tree(NamedTuple):
    """Stored layers of blocks, lowest first; the lowest also holds the leaves' ``keys`` and ``carried`` digests."""

    layers: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, root): the root of the one block that a tree ends in."""
        last = [layer.filter(F.col("n") <= SPAN).select("tree", "root") for layer in self.layers]
        out = last[0]
        for more in last[1:]:
            out = out.union(more)
        return out


class Manifest(NamedTuple):
    """The trees over the rows, and the tree over their subroots."""

    rows: Tree
    top: Tree


def _ranked(leaves: DataFrame, name: str) -> DataFrame:
    """Leaves (tree, key, leaf, carried) with their ``rank`` in their tree, from 0, and its number of leaves ``n``.

    A random number, the last order key, cuts rows that agree in all else into several ranges; they are interchangeable.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("tree", "key", "leaf", "_salt")]
    ordered = (
        leaves.withColumn("_salt", F.rand(17))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("tree", "key", "leaf", "carried", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_place"))
    )
    placed = stored(ordered, f"merkle-{name}-leaves")
    per = placed.groupBy("_range", "tree").agg(F.count(F.lit(1)).alias("_c"), F.min("_place").alias("_first"))
    # a row per range and tree, apart by tree: far fewer than the leaves
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(
        "_range", "tree", "_first", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(of_tree).alias("n")
    )
    rank = F.col("_before") + F.col("_place") - F.col("_first")
    return placed.join(per, ["_range", "tree"]).select("tree", "key", "leaf", "carried", rank.alias("rank"), "n")


def _blocks(nodes: DataFrame, extra: str = "") -> DataFrame:
    """Blocks over nodes (tree, rank, n, leaf); with ``extra`` (their schema) also the leaves' ``keys`` and ``carried``."""
    fields = [f.strip().split(" ")[0] for f in extra.split(",")] if extra else []
    schema = NODES + (", " + extra if extra else "")

    def build(table: pa.Table) -> pa.Table:
        ranks = table.column("rank").to_numpy()
        order = pa.array(np.argsort(ranks))
        table = table.take(order)
        n, first = table.column("n")[0].as_py(), table.column("rank")[0].as_py()
        height = HEIGHT
        while height and n <= ARITY ** (height - 1):
            height -= 1
        leaves = table.column("leaf").to_pylist()
        block = Block.build(leaves, height)
        row = {
            "tree": table.column("tree")[0].as_py(), "block": first // SPAN, "n": n, "height": height,
            "nodes": block.nodes.tobytes(), "root": block.level(0)[0].tobytes(),
        }
        if fields:
            row["keys"] = table.column("key").to_pylist()
            row["carried"] = b"".join(c or leaf for c, leaf in zip(table.column("carried").to_pylist(), leaves, strict=True))
        kinds = {"tree": pa.string(), "block": pa.int64(), "n": pa.int64(), "height": pa.int32(), "nodes": pa.binary(), "root": pa.binary()}
        if fields:
            kinds |= {"keys": pa.list_(table.schema.field("key").type), "carried": pa.binary()}
        return pa.table({k: pa.array([row[k]], kind) for k, kind in kinds.items()})

    wanted = nodes.select("tree", F.floor(F.col("rank") / SPAN).cast("long").alias("block"), "rank", "n", "leaf", *(["key", "carried"] if fields else []))
    return wanted.groupBy("tree", "block").applyInArrow(build, schema)


def _tree(leaves: DataFrame, key_type: str, name: str) -> Tree:
    layers = [stored(_blocks(_ranked(leaves, name), f"keys array<{key_type}>, carried binary"), f"merkle-{name}-0")]
    most = layers[0].agg(F.max("n")).first()[0] or 0
    while most > SPAN:
        most = -(-most // SPAN)
        above = F.ceil(F.col("n") / SPAN).cast("long")
        nodes = layers[-1].select("tree", F.col("block").alias("rank"), above.alias("n"), F.col("root").alias("leaf")).filter(F.col("n") > 1)
        layers.append(stored(_blocks(nodes), f"merkle-{name}-{len(layers)}"))
    return Tree(layers)


def build_manifest(rows: DataFrame) -> Manifest:
    """The manifest of rows (tree string, key long, leaf binary, carried binary).

    ``tree`` as :func:`tree_key` gives it. ``carried`` is a second digest that goes along with its leaf to the
    proofs and has no part in any hash (NULL: the leaf). The layers are written to the shared folder.
    """
    bottom = _tree(rows.select("tree", F.col("key").cast("long").alias("key"), "leaf", "carried"), "long", "rows")
    subroots = bottom.roots().select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("carried"))
    return Manifest(bottom, _tree(subroots, "string", "top"))


# ---------------------------------------------------------------- proofs


_WORDS = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary"}
# rows that go out of a task together
_OUT = 1024


def _down(layer: DataFrame, above: DataFrame, names: list[str], last: dict[str, pa.DataType] | None = None, key_type: pa.DataType | None = None) -> DataFrame:
    """What a layer's leaves get from their blocks (tree, block, last, path and ``names``, handed on).

    Of an upper layer those are blocks again, with their paths; of the lowest (``last``, its further columns) the rows.
    """
    blocks = layer.drop("root").withColumn("last", F.col("n") <= SPAN).join(above, ["tree", "block", "last"])
    kinds = {"tree": pa.string()} | ({"block": pa.int64(), "last": pa.bool_(), "path": pa.binary()} if last is None else {"key": key_type, "leaf": pa.binary()} | last)
    kinds |= dict.fromkeys(names, pa.binary())

    def leaves(row: dict) -> Iterator[tuple]:
        """One tuple, in order of the columns, for each leaf of a block."""
        first = row["block"] * SPAN
        block = Block(row["height"], min(row["n"] - first, SPAN), row["nodes"])
        more = tuple(row[c] for c in names)
        if last is None:
            for k, path in enumerate(block.paths(row["path"])):
                yield (row["tree"], first + k, False, path, *more)
            return
        digests = block.level(block.height).tobytes()
        for k, (key, path) in enumerate(zip(row["keys"], block.paths(row["path"]), strict=True)):
            cut = slice(k * _DIGEST, (k + 1) * _DIGEST)
            carried = row["carried"][cut]
            made = {"carried": lambda: carried, "path": lambda: path, "folded": lambda: fold(carried, path), "proof": lambda: proof_hash(path)}  # noqa: B023
            yield (row["tree"], key, digests[cut], *(made[c]() for c in last), *more)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a block at a time: its row alone is some 300 KB
                found = leaves(batch.slice(at, 1).to_pylist()[0])
                while some := list(islice(found, _OUT)):
                    columns = zip(*some, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    return blocks.mapInArrow(walk, ", ".join(f"`{c}` {_WORDS[kind]}" for c, kind in kinds.items()))


def _paths(tree: Tree, above: DataFrame, names: list[str], last: dict[str, pa.DataType], key_type: pa.DataType) -> DataFrame:
    """(tree, key, leaf, ``last``, ``names``) of all leaves; ``above``: (tree, path, ``names``) of every tree's root."""
    ends = above.select("tree", F.lit(0).cast("long").alias("block"), F.lit(True).alias("last"), "path", *names)
    known = ends
    for layer in reversed(tree.layers[1:]):
        known = ends.union(_down(layer, known, names).select("tree", "block", "last", "path", *names))
    return _down(tree.layers[0], known, names, last, key_type)


def _of_rows(manifest: Manifest, last: list[str]) -> DataFrame:
    whole = manifest.top.roots().select("tree", F.lit(b"").alias("path"), "root")
    subroots = _paths(manifest.top, whole, ["root"], {"path": pa.binary()}, pa.string())
    above = subroots.select(F.col("key").alias("tree"), "path", F.col("leaf").alias("subroot"), "root")
    return _paths(manifest.rows, above, ["subroot", "root"], dict.fromkeys(last, pa.binary()), pa.int64())


def proofs(manifest: Manifest) -> DataFrame:
    """(tree, key, leaf, carried, path, subroot, root) of every row; ``path`` as :func:`fold` takes it.

    The paths of the subroots and of blocks in upper layers are a row for 4,096 leaves each.
    """
    return _of_rows(manifest, ["carried", "path"])


def checked(manifest: Manifest) -> DataFrame:
    """(tree, key, leaf, folded, proof, subroot, root) of every row: the root that its carried digest leads to, and the hash of its proof.

    As :func:`proofs`, but the paths (a KB and more each) are folded where they are read and never leave their block's task.
    """
    return _of_rows(manifest, ["folded", "proof"])


def proof_hash(path: bytes) -> bytes:
    """The hash over all siblings of a path, level by level, left to right."""
    return node_hash(b"".join(siblings for _, siblings in steps(path)))


# ---------------------------------------------------------------- query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# every so many (of the unsigned crc32 of the id's digits) a row is tampered with
TAMPER = 3


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its leaf, subroot, root and proof, and whether the leaf as it is now, tampered with in a third of them, still leads to the root."""
    docs = read_table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPER == 0
    now = F.when(tampered, row_hash(*fields, F.translate("text", UPPER, LOWER)))
    leaves = docs.select(
        tree_key(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("key"), row_hash(*fields, F.col("text")).alias("leaf"), now.alias("carried")
    )
    found = checked(build_manifest(leaves))
    hexed = lambda c: F.lower(F.hex(c))
    return found.select(
        F.col("key").alias("doc_id"), hexed("leaf").alias("leaf"), hexed("subroot").alias("subroot"), hexed("root").alias("root"),
        hexed("proof").alias("proof_sha256"), hexed("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def _sql(levels: int = 8) -> str:
    """DuckDB SQL for :func:`query`; trees of up to ``ARITY ** levels`` leaves."""
    field = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [
        # the table of the checksum: eight shifts of every byte
        "bits0(b, x) as (select range, range from range(256))",
        *(f"bits{k + 1}(b, x) as (select b, case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end from bits{k})" for k in range(8)),
        "crc_table(t) as (select list(x order by b) from bits8)",
        "leaves as (select doc_id, lang, sha256(" + head + f" || {field('text')}) as leaf, sha256(" + head + f" || {field(low)}) as low,"
        " cast(doc_id as varchar) as digits from documents)",
        "summed as (select doc_id, lang, leaf, low, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(digits, ''), lambda c: cast(ascii(c) as bigint))),"
        " lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1])), 4294967295) as crc from leaves, crc_table)",
        f"row0 as (select doc_id, coalesce('1' || lang, '0') as tree, leaf, case when crc % {TAMPER} = 0 then low else leaf end as now from summed)",
        "ranked as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as r from row0)",
    ]

    def levels_of(name: str, source: str) -> None:
        parts.append(f"{name}0 as ({source})")
        for k in range(levels):
            run = f"(partition by tree, r // {ARITY} order by r rows between"
            parts.append(
                f"{name}{k}s as (select tree, r, n, coalesce(string_agg(h, '') over {run} unbounded preceding and 1 preceding), '') as l,"
                f" coalesce(string_agg(h, '') over {run} 1 following and unbounded following), '') as g from {name}{k})"
            )
            parts.append(
                f"{name}{k + 1} as (select tree, r // {ARITY} as r, max((n + {ARITY - 1}) // {ARITY}) as n,"
                f" case when max(n) > 1 then sha256(string_agg(h, '' order by r)) else max(h) end as h from {name}{k} group by tree, r // {ARITY})"
            )

    def walk(name: str, rows: str) -> str:
        """The rows with proof text ``p`` and folded hash ``f`` carried over all levels; their tree and rank are ``tree``, ``r``."""
        for k in range(levels):
            parts.append(
                f"{name}_w{k} as (select d.* exclude (p, f), case when s.n > 1 then d.p || s.l || s.g else d.p end as p,"
                f" case when s.n > 1 then sha256(s.l || d.f || s.g) else d.f end as f"
                f" from {rows} d join {name}{k}s s on s.tree = d.tree and s.r = d.r // {ARITY**k})"
            )
            rows = f"{name}_w{k}"
        return rows

    levels_of("a", "select tree, r, count(*) over (partition by tree) as n, leaf as h from ranked")
    levels_of("b", f"select '' as tree, row_number() over (order by tree) - 1 as r, count(*) over () as n, h, tree as lang from a{levels}")
    parts.append("start as (select doc_id, leaf, tree, r, '' as p, now as f from ranked)")
    low_rows = walk("a", "start")
    parts.append(f"half as (select d.doc_id, d.leaf, s.h as subroot, '' as tree, s.r as r, d.p, d.f from {low_rows} d join b0 s on s.lang = d.tree)")
    done = walk("b", "half")
    return (
        "with " + ",\n".join(parts) + f"\nselect doc_id, leaf, subroot, h as root, sha256(p) as proof_sha256, f as folded_root, f = h as verified from {done} cross join (select h from b{levels})"
    )


SQL = _sql()
