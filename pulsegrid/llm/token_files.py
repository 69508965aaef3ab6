"""Token ids as binary segments with Elias-Fano encoded document boundaries.

File format (Parquet holds the segments, one row each, binary columns):

* ``part``, ``segment``: place of the segment; segments in this order hold the
  documents in ascending order of ``(doc_id, text)``, NULL ids first;
* ``n_docs``, ``n_tokens``, ``n_null``: documents, ids and documents without doc_id;
* ``width``, ``ids``: all ids of the segment concatenated, little-endian
  unsigned integers of ``width`` bytes (2 while the vocabulary fits);
* ``bounds``: Elias-Fano code of the documents' end offsets in ``ids``;
* ``first_id``, ``doc_ids``: Elias-Fano code of ``doc_id - first_id``.

Elias-Fano: of n ascending values up to u, the ``l = floor(log2(u / n))`` low
bits of each are packed, the rest is a bit vector with a one at
``(value >> l) + i``. That is about ``2 + l`` bits a value. ``select(i)`` finds the
i-th one from the number of ones at every 512th bit, with no table of offsets.

Spark does the work at scale: documents are range-partitioned by ``doc_id`` and
sorted, each task encodes its own stretch and cuts it into segments of bounded
size, and the global start offsets are sums over segments, not documents.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import ranges, read_table, scratch, text_blocks, text_column

# ids in a segment, about; a longer document is a segment of its own
SEGMENT_TOKENS = 1 << 20
END_ID = 1
_SAMPLE = 512

SEGMENT_SCHEMA = (
    "part int, segment int, n_docs long, n_tokens long, n_null long, width int, ids binary,"
    " bounds binary, first_id long, doc_ids binary"
)


def ef_encode(values: np.ndarray) -> bytes:
    """Elias-Fano code of ascending non-negative integers (repeats allowed)."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    bits = np.zeros(0, np.uint8)
    if low:
        bits = ((values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    upper = np.zeros((top >> low) + n + 1, np.uint8)
    upper[(values >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    head = np.array([n, low, len(upper)], "<u8").tobytes()
    return head + np.packbits(bits, bitorder="little").tobytes() + np.packbits(upper, bitorder="little").tobytes()


class EliasFano:
    """Reader of :func:`ef_encode`: ``select(i)`` gives the i-th value, ``all()`` every value."""

    def __init__(self, code: bytes):
        n, low, width = (int(x) for x in np.frombuffer(code, "<u8", 3))
        self.n, self.low = n, low
        cut = 24 + (n * low + 7) // 8
        self._lows = np.frombuffer(code, np.uint8)[24:cut]
        self._upper = np.frombuffer(code, np.uint8)[cut:]
        ones = np.bitwise_count(self._upper)
        # number of ones before every _SAMPLE bits: the only extra table, a word for 512 bits
        step = _SAMPLE // 8
        whole = np.add.reduceat(ones.astype(np.int64), np.arange(0, max(len(ones), 1), step)) if len(ones) else np.zeros(0, np.int64)
        self._before = np.concatenate(([0], np.cumsum(whole)))

    def __len__(self) -> int:
        return self.n

    def select(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        block = int(np.searchsorted(self._before, i, "right")) - 1
        start = block * (_SAMPLE // 8)
        bits = np.unpackbits(self._upper[start : start + _SAMPLE // 8], bitorder="little")
        at = block * _SAMPLE + int(np.flatnonzero(bits)[i - int(self._before[block])])
        return ((at - i) << self.low) | self._low(i)

    def _low(self, i: int) -> int:
        a = i * self.low
        raw = int.from_bytes(self._lows[a // 8 : (a + self.low + 7) // 8 + 1].tobytes(), "little")
        return (raw >> (a % 8)) & ((1 << self.low) - 1)

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self._upper, bitorder="little"))[: self.n]
        high = (at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if not self.low:
            return high
        bits = np.unpackbits(self._lows, bitorder="little", count=self.n * self.low).reshape(self.n, self.low)
        return high | (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


# the encoder sees each distinct word of a block once; longer blocks repeat more of them
ENCODE_BLOCK_BYTES = 1 << 22
#: words, and bytes of them and their ids, that an encoder remembers from block to block; beyond that it starts anew
KNOWN_WORDS, KNOWN_BYTES = 1 << 19, 1 << 26
_BATCH = 4096
_PLAIN = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]?$"
_END_OF_WORD = "</w>"


def _byte_characters() -> np.ndarray:
    """The characters that stand for the bytes of UTF-8, as UTF-32; the space stays.

    The byte-level alphabet keeps the printable bytes of Latin-1 and numbers the others from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    stands = np.array([b if b in printable else next(others) for b in range(256)], "<u4")
    stands[32] = 32
    return stands


_BYTE_CHARACTERS = _byte_characters()


def _together(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The lists' ids concatenated, and the number of ids of each."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes


class WordEncoder:
    """Ids of whole texts by the ``tokenizers`` library, each distinct word of a block encoded once.

    The tokenizer drops white space and never merges across it, so the ids of a
    text are those of its space-free words in order (its special strings hold no
    white space either). A word of Latin-1 letters, perhaps with one mark after
    it, is in lower case one or two units of the pre-tokenizer, so the library's
    model takes the letters' bytes directly, many words in one string, and the ids
    that stand for a word's end part them; all other words go through its whole
    pipeline. Words of earlier blocks are remembered with their ids, up to
    ``KNOWN_WORDS`` and ``KNOWN_BYTES``. Equality with the plain call is tested.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self._tokenizer = Tokenizer.from_file(path)
        self._units = Tokenizer(self._tokenizer.model)
        self._units.pre_tokenizer = WhitespaceSplit()
        self.vocabulary = self._tokenizer.get_vocab_size()
        units = self._units.get_vocab()
        self._ends = np.zeros(max(units.values(), default=0) + 1, bool)
        self._ends[[i for t, i in units.items() if t.endswith(_END_OF_WORD)]] = True
        self._forget()

    def _forget(self) -> None:
        self._known, self._flat, self._sizes = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def _letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-case words of letters concatenated, and the number of ids of each."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")
        text = _BYTE_CHARACTERS[np.frombuffer(joined[0].as_buffer(), np.uint8)].tobytes().decode("utf-32-le")
        ids = np.array(self._units.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self._ends[ids])
        if len(ends) == len(words):  # no word has two of them
            return ids, np.diff(ends, prepend=-1)
        lists = [[t.id for t in self._tokenizer.model.tokenize(w)] for w in text.split(" ")]
        return _together(lists)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words concatenated, and the number of ids of each."""
        plain = pc.match_substring_regex(words, _PLAIN).to_numpy(zero_copy_only=False)
        cores = pc.utf8_lower(pc.utf8_rtrim(words.filter(pa.array(plain)), ".,")).dictionary_encode()
        found = [self._letters(cores.dictionary.slice(a, _BATCH)) for a in range(0, len(cores.dictionary), _BATCH)]
        rest = words.filter(pa.array(~plain)).to_pylist()
        others = [*rest, ".", ","]
        for a in range(0, len(others), _BATCH):  # the library's results are far larger than their ids
            lists = [e.ids for e in self._tokenizer.encode_batch_fast(others[a : a + _BATCH], add_special_tokens=False)]
            found.append(_together(lists))
        flat = np.concatenate([ids for ids, _ in found])
        # each word is its unit and then its mark, which for most is the empty unit at the end
        sizes = np.concatenate([*(n for _, n in found), [0]])
        last = len(sizes) - 1
        first = np.cumsum(sizes) - sizes
        unit = np.empty(len(words), np.int64)
        unit[plain] = cores.indices.to_numpy()
        unit[~plain] = len(cores.dictionary) + np.arange(len(rest))
        mark = np.full(len(words), last)
        for k, c in ((2, "."), (1, ",")):
            mark[plain & pc.ends_with(words, c).to_numpy(zero_copy_only=False)] = last - k
        both = np.stack([unit, mark], axis=1).ravel()
        return flat[ranges(first[both], sizes[both])], sizes[unit] + sizes[mark]

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where the words stand among the known ones, to which new ones are added."""
        if len(self._known) > KNOWN_WORDS or self._known.nbytes + self._flat.nbytes > KNOWN_BYTES:
            self._forget()
        found = pc.index_in(words, value_set=self._known)
        new = words.filter(found.is_null())
        at = found.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = len(self._known) + np.arange(len(new))
        if len(new):
            flat, sizes = self._words(new)
            self._known = pa.concat_arrays([self._known, new])
            self._flat, self._sizes = np.concatenate((self._flat, flat)), np.concatenate((self._sizes, sizes))
        return at

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts concatenated, and the number of ids of each text."""
        for space in "\t\n\r":
            texts = pc.replace_substring(texts, space, " ")
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        pieces = lists.flatten().dictionary_encode()
        codes = self._places(pieces.dictionary)[pieces.indices.to_numpy()]
        flat, sizes = self._flat, self._sizes
        first = np.cumsum(sizes) - sizes
        n = sizes[codes]
        total = np.concatenate(([0], np.cumsum(n)))
        offsets = offsets - offsets[0]
        return flat[ranges(first[codes], n)], total[offsets[1:]] - total[offsets[:-1]]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """One encoder for all tasks of a Python worker."""
    return WordEncoder(path)


def _segments(part: int, width: int, docs: Iterator[tuple[list, np.ndarray, np.ndarray]], limit: int):
    """Cut a sorted stream of (doc ids, ids, ids per document) into segment rows."""
    held_ids, held, counts, size, number = [], [], [], 0, 0

    def row():
        doc_ids = np.array([d for d in held_ids if d is not None], np.int64)
        first = int(doc_ids[0]) if len(doc_ids) else None
        ids = np.concatenate(held) if held else np.zeros(0, np.uint32)
        return {
            "part": part, "segment": number, "n_docs": len(held_ids), "n_tokens": len(ids),
            "n_null": len(held_ids) - len(doc_ids), "width": width, "ids": ids.astype(f"<u{width}").tobytes(),
            "bounds": ef_encode(np.cumsum(counts)), "first_id": first,
            "doc_ids": ef_encode((doc_ids - (first or 0)).astype(np.uint64)),
        }

    for doc_ids, ids, sizes in docs:
        ends = np.cumsum(sizes)
        for d, a, b in zip(doc_ids, ends - sizes, ends, strict=True):
            if held_ids and size + (b - a) > limit:
                yield row()
                held_ids, held, counts, size, number = [], [], [], 0, number + 1
            held_ids.append(d)
            held.append(ids[a:b])
            counts.append(int(b - a))
            size += int(b - a)
    if held_ids:
        yield row()


#: characters of a text that order rows of one doc_id; the bounds of the ranges hold no more of any text
_PREFIX = 64


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode ``docs`` (doc_id, text; further columns are ignored) and write the segments to ``path``.

    ``end_id`` ends each document, so an empty or NULL text has one id. Rows with
    the same doc_id are documents of their own, in the order of their texts' first ``_PREFIX``
    characters; so many rows of one doc_id, or without one, are ranges of their own
    (by what the texts begin with, then by a hash of them and the row).
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"), F.monotonically_increasing_id().alias("row"))
    ranged = slim.repartitionByRange("doc_id", F.substring("text", 1, _PREFIX), F.xxhash64("text"), "row")
    ordered = ranged.select("doc_id", "text").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoder(tokenizer)
        width = 2 if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else 4

        def stream():
            for batch in batches:
                texts = batch.column("text")
                size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
                offsets = np.concatenate(([0], np.cumsum(size)))
                for a, b in text_blocks(offsets, ENCODE_BLOCK_BYTES):
                    ids, counts = encoder(texts.slice(a, b - a))
                    pa.default_memory_pool().release_unused()
                    ends = np.cumsum(counts)
                    yield batch.column("doc_id").slice(a, b - a).to_pylist(), np.insert(ids, ends, end_id), counts + 1

        for row in _segments(TaskContext.get().partitionId(), width, stream(), segment_tokens):
            yield pa.RecordBatch.from_pylist([row], schema=_ARROW)

    ordered.mapInArrow(encode, SEGMENT_SCHEMA).write.parquet(path)


_ARROW = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_null", pa.int64()),
     ("width", pa.int32()), ("ids", pa.binary()), ("bounds", pa.binary()), ("first_id", pa.int64()), ("doc_ids", pa.binary())]
)


def decode_segment(row: dict) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, offset within the segment, ids) of each document of a segment row."""
    ids = np.frombuffer(row["ids"], f"<u{row['width']}")
    ends = EliasFano(row["bounds"]).all().astype(np.int64)
    known = EliasFano(row["doc_ids"]).all().astype(np.int64) + (row["first_id"] or 0)
    names = [None] * row["n_null"] + known.tolist()
    start = 0
    for name, end in zip(names, ends.tolist(), strict=True):
        yield name, start, ids[start:end]
        start = end


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files at ``path``: doc_id, start, n_tokens and ids_crc32.

    ``start`` counts the ids of all documents before it: a running sum over the parts (one
    row each), one over the segments of the part, and the Elias-Fano boundary within the segment.
    """
    segments = spark.read.parquet(path)
    sizes = segments.groupBy("part", "segment").agg(F.sum("n_tokens").alias("n_tokens"))
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select("part", before.alias("before"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(parts, "part")
    offsets = offsets.select("part", "segment", (F.col("before") + F.col("within")).alias("offset"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                docs = [(d, s, len(i), zlib.crc32(i.astype("<u4").tobytes())) for d, s, i in decode_segment(row)]
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()),
                     *(pa.array(c, pa.int64()) for c in zip(*docs, strict=True))],
                    names=["part", "segment", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    decoded = segments.mapInArrow(decode, "part int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return decoded.join(offsets, ["part", "segment"]).select(
        "doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_index(spark, path)
