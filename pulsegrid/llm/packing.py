"""Packing of token sequences: exact complements by hashed length sums, then best fit.

1. Pieces. Each document is encoded, ended with an id and, if longer than a sequence, cut into
   pieces of its whole length; every piece is written with its ids, its task (``part``) and its number ``nth``
   among the pieces of its length there.
2. Plan. Packing needs the number of pieces of each length alone, ``capacity`` numbers for any corpus. A
   pattern is a list of lengths for one sequence. It begins with the largest length left; its gap
   is looked up among the sums of one, two and three lengths that are still available. An
   exact complement closes the pattern; else the largest length that fits goes in and the new gap is looked up.
   A closed pattern is consumed as often as the availability counts allow, so each
   one uses up a length. Lengths that find no exact complement are left for the end and go, in
   descending order, to the open sequences that they fit best.
3. Places. The ``r``-th piece of a length (its ``nth`` and the pieces of that length in parts before) belongs to the
   pattern in whose interval ``r`` lies. That is arithmetic on a table of patterns, whose size follows ``capacity``
   and not the corpus, so tasks get it as it is. Pieces are then sorted by sequence and place and
   written as sequences.

Format (Parquet, a row a sequence): ``sequence_id``; ``n_tokens``; ``width`` and ``ids``, the ids as little-endian
unsigned integers of ``width`` bytes; ``pieces``, in their order there, with ``doc_id``, ``piece`` (from 0), ``start`` (ids of its document before it),
``length`` and ``offset`` (place in the sequence).

Rows: a NULL or empty text is the end id alone. Rows with the same or no doc_id are documents of their own. No rows,
no sequences. Further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import read_table, scratch, text_blocks, text_column
from pulsegrid.llm.token_files import WordEncoder
from pulsegrid.session import range_count
from pulsegrid.sources.files import write_bucketed

CAPACITY = 4096
END_ID = 1
# bytes of text that are encoded together, and pieces that leave a task together
_BLOCK = 1 << 22
_OUT = 512


# ---------------------------------------------------------------- plan


class Pattern(NamedTuple):
    """``times`` sequences that hold (length, number) pieces in this order."""

    slots: tuple[tuple[int, int], ...]
    times: int


class _Sums:
    """Which lengths are available, and the sums of two of them; hashed as bits of an integer.

    A sum whose lengths are used up keeps its bit until a look-up misses it; every hit is checked against the counts.
    """

    def __init__(self, counts: np.ndarray):
        self.counts, self.pairs = counts, 0
        self.refresh()
        self._rebuild()

    def refresh(self) -> None:
        """To be called when a length is used up."""
        self.lengths, self.stale = np.flatnonzero(self.counts), True

    def _rebuild(self) -> None:
        self.pairs, self.stale = 0, False
        single = sum(1 << x for x in self.lengths.tolist())
        for x in self.lengths.tolist():
            self.pairs |= single << x
        self.pairs &= (1 << len(self.counts)) - 1

    def left(self, used: dict[int, int], *lengths: int) -> bool:
        """Whether the lengths are there once more, beside those used."""
        return all(self.counts[x] >= used.get(x, 0) + lengths.count(x) for x in lengths)

    def largest(self, most: int, used: dict[int, int]) -> int:
        """The largest available length up to ``most``; 0 for none."""
        for k in range(int(np.searchsorted(self.lengths, most, "right")) - 1, -1, -1):
            if self.left(used, x := int(self.lengths[k])):
                return x
        return 0

    def pair(self, total: int, used: dict[int, int]) -> tuple[int, int] | None:
        """Two available lengths that add up to ``total``, the larger as large as can be."""
        if total < 2 or not self.pairs >> total & 1:
            return None
        big = self.lengths[(self.lengths < total) & (2 * self.lengths >= total)]
        for x in big[self.counts[total - big] > 0][::-1].tolist():
            if self.left(used, x, total - x):
                return x, total - x
        if self.stale:
            self._rebuild()
        return None

    def complement(self, gap: int, used: dict[int, int]) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill the gap exactly, with the largest as large as can be."""
        if self.counts[gap] and self.left(used, gap):
            return (gap,)
        if found := self.pair(gap, used):
            return found
        big = self.lengths[(self.lengths <= gap - 2) & (3 * self.lengths >= gap)]
        for x in big[::-1].tolist():
            if self.pairs >> (gap - x) & 1 and self.left(used, x):
                rest = self.pair(gap - x, used | {x: used.get(x, 0) + 1})
                if rest and rest[0] <= x:
                    return (x, *rest)
        return None


def _slots(used: dict[int, int]) -> tuple[tuple[int, int], ...]:
    return tuple(sorted(used.items(), reverse=True))


def exact_patterns(counts: np.ndarray, capacity: int) -> tuple[list[Pattern], np.ndarray]:
    """Patterns that fill sequences exactly, and the counts by length that found none."""
    counts, rest = counts.copy(), np.zeros_like(counts)
    sums, out = _Sums(counts), []
    while counts.any():
        first = int(np.flatnonzero(counts)[-1])
        used, gap = {first: 1}, capacity - first
        while gap:
            if found := sums.complement(gap, used):
                for x in found:
                    used[x] = used.get(x, 0) + 1
                gap = 0
            elif x := sums.largest(gap, used):
                # a gap of more than three of them has no complement: as many go in at once
                n = max(1, min(int(counts[x]) - used.get(x, 0), (gap - 1) // x - 2))
                used[x] = used.get(x, 0) + n
                gap -= n * x
            else:
                break
        if gap:
            rest[first] += counts[first]
            counts[first] = 0
        else:
            times = min(int(counts[x]) // n for x, n in used.items())
            for x, n in used.items():
                counts[x] -= times * n
            out.append(Pattern(_slots(used), times))
        if any(not counts[x] for x in used):
            sums.refresh()
    return out, rest


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns by best fit in descending order of length: each piece goes to the open sequence with the least room that holds it."""
    # room -> [(slots, times)]: open sequences that are alike are one entry
    rooms: dict[int, list[tuple[dict[int, int], int]]] = {}
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        for room in sorted(r for r in rooms if r >= length):
            # the sequence that took a piece has the least room afterwards, so it takes all that it holds
            each, moved = room // length, []
            while left and rooms[room]:
                used, times = rooms[room].pop()
                full = min(times, left // each)
                if full:
                    moved.append((room - each * length, used | {length: each}, full))
                left -= full * each
                times -= full
                if times and 0 < left < each:
                    moved.append((room - left * length, used | {length: left}, 1))
                    left, times = 0, times - 1
                if times:
                    rooms[room].append((used, times))
            for new, used, times in moved:
                rooms.setdefault(new, []).append((used, times))
            if not left:
                break
        each = capacity // length
        for n, times in ((each, left // each), (left % each, 1)):
            if n and times:
                rooms.setdefault(capacity - n * length, []).append(({length: n}, times))
    return [Pattern(_slots(used), times) for group in rooms.values() for used, times in group]


def plan_patterns(counts: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns for all pieces, given their number by length (index 0 is not used)."""
    exact, rest = exact_patterns(counts, capacity)
    return exact + best_fit(rest, capacity)


class Places:
    """Sequence and offset of the r-th piece of a length. Sequences are numbered pattern by pattern."""

    def __init__(self, patterns: list[Pattern], capacity: int = CAPACITY):
        rows, first = [], 0
        for p in patterns:
            offset = 0
            for length, n in p.slots:
                rows.append((length, n, p.times, first, offset))
                offset += length * n
            first += p.times
        table = np.array(rows, np.int64).reshape(-1, 5)
        table = table[np.argsort(table[:, 0], kind="stable")]
        length, self._each, times, self._sequence, self._offset = table.T
        # pieces in intervals before this one: of all smaller lengths, and of this length
        self._before = np.cumsum(self._each * times) - self._each * times
        lead = np.searchsorted(length, length)
        self._begin = self._before - self._before[lead]
        self._first = np.zeros(capacity + 1, np.int64)
        self._first[length] = self._before[lead]

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of the pieces with these lengths and ranks (from 0) among their length."""
        at = np.searchsorted(self._before, self._first[length] + rank, "right") - 1
        turn, slot = np.divmod(rank - self._begin[at], self._each[at])
        return self._sequence[at] + turn, self._offset[at] + slot * length


# ---------------------------------------------------------------- pieces


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(path)


_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64())]
)
_PIECES_DDL = "doc_id long, piece int, start long, length int, ids binary, part int, nth long"


def cut(doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray, capacity: int) -> dict[str, pa.Array]:
    """The pieces of documents given by their ids end to end."""
    n = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = piece * capacity
    length = np.minimum(sizes[doc] - start, capacity)
    # pieces in order are the ids in order
    bounds = np.concatenate(([0], np.cumsum(length))) * ids.itemsize
    data = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())
    return {"doc_id": doc_ids.take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length, pa.int32()), "ids": data}


def _numbered(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """For each piece the number of pieces of its length before it; ``seen`` counts them on."""
    order = np.argsort(length, kind="stable")
    run = length[order]
    lead = np.searchsorted(run, run)
    out = np.empty(len(length), np.int64)
    out[order] = seen[run] + np.arange(len(run)) - lead
    seen += np.bincount(length, minlength=len(seen))
    return out


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of documents (doc_id, text) with their ids, part and number there."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        kind = np.dtype("<u2" if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else "<u4")
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = batch.column("text")
            offsets = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))))
            for a, b in text_blocks(offsets, _BLOCK):
                ids, counts = encoder(texts.slice(a, b - a))
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(kind)
                found = cut(batch.column("doc_id").slice(a, b - a), ids, counts + 1, capacity)
                found["nth"] = pa.array(_numbered(found["length"].to_numpy(), seen))
                found["part"] = pa.array(np.full(len(found["nth"]), part, np.int32))
                out = pa.RecordBatch.from_arrays([found[c] for c in _PIECES.names], schema=_PIECES)
                for k in range(0, out.num_rows, _OUT):
                    yield out.slice(k, _OUT)
                pa.default_memory_pool().release_unused()

    return slim.mapInArrow(encode, _PIECES_DDL)


# ---------------------------------------------------------------- sequences

_SEQUENCES = "sequence_id long, n_tokens int, width int, ids binary, pieces array<struct<doc_id long, piece int, start long, length int, offset int>>"
_PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("offset", pa.int32())])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences from pieces in order of (sequence_id, offset); one that a batch breaks off waits for the next."""
    held: pa.Table | None = None

    def rows(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        sequence = table.column("sequence_id").to_numpy()
        lead = np.flatnonzero(np.concatenate(([True], sequence[1:] != sequence[:-1])))
        ends = np.append(lead[1:], len(sequence))
        ids = table.column("ids").combine_chunks()
        data = ids.buffers()
        at = np.frombuffer(data[1], np.int32, len(ids) + 1, ids.offset * 4)
        joined = pa.Array.from_buffers(pa.binary(), len(lead), [None, pa.py_buffer(np.append(at[lead], at[-1]).astype(np.int32)), data[2]])
        length = table.column("length").to_numpy()
        total = np.add.reduceat(length, lead)
        width = (np.append(at[lead[1:]], at[-1]) - at[lead]) // total
        structs = pa.StructArray.from_arrays([table.column(f.name).combine_chunks() for f in _PIECE], fields=list(_PIECE))
        lists = pa.ListArray.from_arrays(pa.array(np.append(lead, ends[-1]), pa.int32()), structs)
        out = pa.RecordBatch.from_arrays(
            [pa.array(sequence[lead]), pa.array(total, pa.int32()), pa.array(width, pa.int32()), joined, lists], names=["sequence_id", "n_tokens", "width", "ids", "pieces"]
        )
        for k in range(0, out.num_rows, _OUT):
            yield out.slice(k, _OUT)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        sequence = table.column("sequence_id").to_numpy()
        whole = int(np.flatnonzero(np.append(True, sequence[1:] != sequence[:-1]))[-1])
        if whole:
            yield from rows(table.slice(0, whole))
        held = table.slice(whole)
    if held is not None:
        yield from rows(held)


def pack(docs: DataFrame, path: str, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> int:
    """Pack documents (doc_id, text) into sequences of up to ``capacity`` ids, write them to ``path`` and return their number."""
    spark = docs.sparkSession
    # tasks write their part as a bucket, so that joining the parts' ranks moves no ids
    pieces = write_bucketed(pieces_of(docs, tokenizer, capacity, end_id), scratch(spark, "pack-pieces"), range_count(docs), ["part"], "zstd")
    per = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # at most `capacity` rows, whatever the corpus
    totals = per.groupBy("length").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for r in totals:
        counts[r["length"]] = r["n"]
    patterns = plan_patterns(counts, capacity)
    places = Places(patterns, capacity)

    def listed(table: pa.Table) -> pa.Table:
        """The ranks of a part's pieces as a list by length."""
        known = np.zeros(capacity + 1, np.int64)
        known[table.column("length").to_numpy()] = table.column("before").to_numpy()
        return pa.table({"part": table.column("part").slice(0, 1), "known": pa.array([known], pa.list_(pa.int64()))})

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranks = per.select("part", "length", F.coalesce(before, F.lit(0)).alias("before")).groupBy("part").applyInArrow(listed, "part int, known array<long>")
    placed = pieces.join(ranks.hint("shuffle_hash"), "part").select(
        "doc_id", "piece", "start", "length", "ids", (F.col("nth") + F.get("known", "length")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.place(batch.column("length").to_numpy().astype(np.int64), batch.column("rank").to_numpy())
            arrays = [*batch.columns[:5], pa.array(sequence), pa.array(offset, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:5], "sequence_id", "offset"])

    found = placed.mapInArrow(place, "doc_id long, piece int, start long, length int, ids binary, sequence_id long, offset int")
    ordered = found.repartition(range_count(docs), "sequence_id").sortWithinPartitions("sequence_id", "offset")
    ordered.mapInArrow(_joined, _SEQUENCES).write.option("compression", "zstd").parquet(path)
    return sum(p.times for p in patterns)


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Per piece of the sequences at ``path``: doc_id, piece, start, length, ids_crc32 (of its ids, 32-bit, little-endian), sequence_id, offset."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _OUT):
                some = batch.slice(at, _OUT)
                lists = some.column("pieces")
                pieces, n = lists.flatten(), lists.value_lengths().to_numpy()
                sequence = np.repeat(np.arange(some.num_rows), n)
                data = [np.frombuffer(ids, f"<u{w}").astype("<u4") for ids, w in zip(some.column("ids").to_pylist(), some.column("width").to_pylist(), strict=True)]
                offset, length = pieces.field("offset").to_numpy(), pieces.field("length").to_numpy()
                crc = [zlib.crc32(data[s][a : a + k].tobytes()) for s, a, k in zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pieces.field("doc_id"), pieces.field("piece"), pieces.field("start"), pieces.field("length").cast(pa.int64()),
                     pa.array(crc, pa.int64()), some.column("sequence_id").take(pa.array(sequence)), pieces.field("offset").cast(pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
                )

    return spark.read.schema(_SEQUENCES).parquet(path).mapInArrow(read, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4,096 ids, and their pieces as the written sequences hold them."""
    import public_tokenizers

    path = scratch(spark, "packed")
    pack(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_pieces(spark, path)
