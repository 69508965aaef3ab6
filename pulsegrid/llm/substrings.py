"""Suffix-order removal of byte strings that an earlier document holds: depth-limited radix sort.

A byte is removed if some string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id. Whether two suffixes agree that far needs no full
suffix array: suffixes are ordered by their first ``LENGTH`` bytes only, eight bytes
a pass from the most significant ones on; after each pass suffixes that are alone,
or whose group has one document, leave. The groups that are left after the last pass
are exactly the repeated strings, and each removes the members that are not of
its smallest document.

Spark deals the suffixes out so that equal strings meet:

1. The smallest (hashed) ``GRAM`` bytes within a string decide its bin, so equal strings
   share a bin, and neighbouring strings mostly do too: a run of them travels as
   one piece of text. Grams that too many strings choose are found by a first pass and
   lengthened, to 16 bytes and where need be to 32: the more text there is, the more of
   its grams are common, but longer ones are not, and a run stays a run. Further passes
   find those that are still chosen too often. Strings that choose such a gram of 32 bytes
   travel one by one, dealt by all their bytes: around a passage that many documents
   share, each document's strings go to bins of their own, and only equal strings meet.
2. Pieces that occur in several documents of a block stay with the smallest one; the
   others are settled on the spot. So a passage that a third of all documents
   share travels once for a block of texts, single strings once for a pack of blocks. What a
   text repeats within itself travels once, with all its places.
3. Each bin runs the radix passes and returns byte ranges. Strings that no other of
   the bin can equal, told by one count over their hashes, leave before the first pass.
   Where there are very many bins, neighbouring ones travel together and are sorted one
   after the other, so that what a pack sends to one task stays large enough to compress.
4. Ranges meet their documents in buckets, which cut them out.

All strings are compared byte by byte. Texts are UTF-8 bytes, NULL is empty. A NULL doc_id
counts as larger than any other. Rows with one doc_id don't remove from each
other, and equal rows give equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import as_binary, mix64, prefix_hash, ranges, read_table, release_memory, segment_ids, span_hash, stored, text_blocks, text_column

LENGTH, GRAM = 50, 8
#: bytes of a gram that is lengthened once and twice; the last bits of a chosen gram say how often it was
LONGER = (16, 32)
#: strings of a run that travel together at most; periodic texts would make endless runs
_RUN = 64
# text of one vectorised pass, of the pieces that are packed together, of a bin and of a bucket
_BLOCK, _PACK, _BIN, _BUCKET = 1 << 20, 1 << 24, 1 << 20, 1 << 23
# places whose grams are chosen at once: what this takes fits a core's cache
_CHOOSE = 1 << 16
# keys of a shuffle from which on neighbouring bins and buckets are joined, up to so many of them
_KEYS, _BINS_A_SLOT, _BUCKETS_JOINED = 1 << 10, 16, 4
#: a gram that more than this share of all strings choose is lengthened
HEAVY = 1e-4
#: strings of a gram that go to one bin as pieces, about; beyond so many, or this share of all strings if that is more
#: (at most 1 / HOT_SHARE grams are sent to the tasks), it is lengthened, and those of the longest grams are dealt one by one
HOT, HOT_SHARE = 1 << 18, 1e-7
_NO_ID = 2**63 - 1
_ODD, _MOST = np.uint64(0x9E3779B97F4A7C15), ~np.uint64(0)
# the bits of a chosen gram that are those of a longer one, and those that say how often it was lengthened
_TELL, _LEVEL = np.uint64((1 << 31) - 1), np.uint64(3)


def _words8(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on as one big-endian number; zeros stand after the end."""
    x = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    x = (x[:-1] << np.uint64(8)) | x[1:]
    x = (x[:-2] << np.uint64(16)) | x[2:]
    return ((x[:-4] << np.uint64(32)) | x[4:])[: len(data)]


class _Listed:
    """Tells which values are among some: each stands where its low bits say, those that find that place taken in a table of their own."""

    def __init__(self, values: np.ndarray):
        bits = min(max((len(values) * 16).bit_length(), 8), 22)
        self.shift = np.uint64(2)
        self.mask = np.uint64((1 << bits) - 1)
        # what stands in a free place belongs to another
        self.table = np.zeros(1 << bits, np.uint64)
        self.table[0] = 1 << 2
        at = values >> self.shift & self.mask
        self.table[at] = values
        left = values[self.table[at] != values]
        self.more = _Listed(left) if len(left) else None

    def among(self, values: np.ndarray) -> np.ndarray:
        """Places of the values that are listed."""
        found = self.table[values >> self.shift & self.mask] == values
        if self.more is not None:
            found[self.more.among(values)] = True
        return np.flatnonzero(found)


def _sizes(length: int) -> list[int]:
    """Bytes of a gram, and of one that was lengthened once and twice."""
    return [GRAM] + [size for size in LONGER if size <= length]


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of the ``n`` values from each place on, of fewer at the end."""
    width = 1
    while width < min(n, len(values)):
        by = min(width, n - width)
        out = values.copy()
        np.minimum(values[:-by], values[by:], out=out[: len(out) - by])
        values, width = out, width + by
    return values


def _choose(data: np.ndarray, length: int, heavy: _Listed | None) -> np.ndarray:
    plain = mix64(_words8(data)) >> np.uint64(1)
    key, sizes, longer = plain & ~_LEVEL, _sizes(length), []
    if heavy is not None:
        mixed, place = plain, heavy.among(key)
        for level in range(1, len(sizes)):
            if not len(place):
                break
            longer.append(place)
            # those that reach beyond the end lie in no string
            mixed = plain[place] if level == 1 else mixed
            for step in range(sizes[level - 1], sizes[level], GRAM):
                mixed = mix64(mixed * _ODD + plain[np.minimum(place + step, len(plain) - 1)])
            # a longer gram keeps its turn
            key[place] = (plain[place] & ~_TELL) | (mixed & _TELL & ~_LEVEL) | np.uint64(level)
            still = heavy.among(key[place])
            place, mixed = place[still], mixed[still]
    # a string takes the least of the grams within it: the longer they are, the fewer of its places they can stand at
    fits = [length - size + 1 for size in sizes[: len(longer) + 1]]
    out = _least(key, fits[-1])
    if longer:
        out = out.copy()
    for level in range(len(longer) - 1, -1, -1):
        key[longer[level]] = _MOST
        by = fits[level + 1]
        if by < len(out):
            np.minimum(out[:-by], _least(key, fits[level] - by)[by:], out=out[:-by])
    return out


def chosen_grams(data: np.ndarray, length: int, heavy: np.ndarray) -> np.ndarray:
    """The smallest hashed gram of the string of ``length`` bytes at each place; ``heavy`` ones are lengthened."""
    out, listed = np.empty(len(data), np.uint64), _Listed(heavy) if len(heavy) else None
    for a in range(0, len(data), _CHOOSE):
        b = min(a + _CHOOSE, len(data))
        out[a:b] = _choose(data[a : b + length - 1], length, listed)[: b - a]
    return out


def _string_places(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, text) of every string of ``length`` bytes within a text."""
    n = np.maximum(np.diff(offsets) - length + 1, 0)
    return ranges(offsets[:-1], n), segment_ids(n)


def _sections(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, np.ndarray, int]]:
    """Bounded blocks of texts as (first text, text after the last, offsets of their bytes, bytes of the text before these).

    A text beyond a block comes in several, each with the strings that start in it.
    """
    for a, b in text_blocks(offsets, _BLOCK):
        size = int(offsets[b] - offsets[a])
        if b - a > 1 or size <= 2 * _BLOCK:
            yield a, b, offsets[a : b + 1], 0
        else:
            for at in range(0, size, _BLOCK):
                yield a, b, offsets[a] + np.array([at, min(at + _BLOCK + length - 1, size)]), at


class Pieces:
    """Runs of strings that chose one gram: ``text``, ``start`` in the block, ``count`` of strings, ``gram``.

    Strings that chose one of the ``hot`` grams are pieces by themselves: ``single``, with the hash of all their
    bytes as ``gram``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, heavy: np.ndarray, hot: np.ndarray):
        place, text = _string_places(offsets, length)
        gram = chosen_grams(data, length, heavy)[place]
        alone = np.zeros(len(place), bool)
        if len(hot):
            alone[_Listed(hot).among(gram)] = True
        new = np.ones(len(place), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1]) | alone[1:]
        cuts = np.flatnonzero(new)
        size = np.diff(np.append(cuts, len(place)))
        parts = -(-size // _RUN)
        step = (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)) * _RUN
        first = np.repeat(cuts, parts) + step
        self.text, self.start, self.gram, self.single = text[first], place[first], gram[first], alone[first]
        if len(hot):
            start = self.start[self.single]
            self.gram[self.single] = mix64(span_hash(prefix_hash(data), start, start + length))
        self.count = np.minimum(np.repeat(size, parts) - step, _RUN)


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at a and at b are equal, for each pair."""
    if not len(a):
        return np.zeros(0, bool)
    differ = data[ranges(a, size)] != data[ranges(b, size)]
    return ~np.logical_or.reduceat(differ, np.cumsum(size) - size)


def _leaders(data: np.ndarray, prefix: np.ndarray, start: np.ndarray, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each piece the equal piece with the smallest ``rank`` (itself if it has that), compared byte by byte.

    ``prefix``: the prefix hash of ``data``.
    """
    return _leaders_by(span_hash(prefix, start, start + size), data, start, size, rank)


def _leaders_by(mark: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The same by a hash of each piece."""
    order = np.lexsort((rank, size, mark))
    same = np.zeros(len(order), bool)
    same[1:] = (mark[order][1:] == mark[order][:-1]) & (size[order][1:] == size[order][:-1])
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    out = np.arange(len(start))
    equal = _same_bytes(data, start[order][same], start[lead][same], size[order][same])
    out[order[same]] = np.where(equal, lead[same], order[same])
    return out


def repeated(data: np.ndarray, prefix: np.ndarray, start: np.ndarray, count: np.ndarray, doc: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Of all strings of some pieces, laid out one after the other: whether a smaller document has the same string.

    ``start`` and ``count``: where each piece stands in ``data`` and its strings; ``doc``: its document;
    ``prefix``: the prefix hash of ``data``.
    """
    place, owner = ranges(start, count), np.repeat(doc, count)
    out = np.zeros(len(place), bool)
    # eight bytes from each place on as one big-endian number
    words = np.ndarray(len(data), ">u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    # equal strings share a count, so those that are alone in theirs have no equal
    bits = max(8, (4 * len(place)).bit_length())
    mark = (span_hash(prefix, place, place + length) >> np.uint64(64 - bits)).astype(np.int64)
    live = np.flatnonzero(np.bincount(mark, minlength=1 << bits)[mark] > 1)
    group = np.zeros(len(live), np.int64)
    del mark
    for depth in range(0, length, 8):
        digit = words[place[live] + depth].astype(np.uint64)
        if length - depth < 8:
            digit = digit >> np.uint64(8 * (8 - (length - depth)))
        if depth:
            order = np.lexsort((digit, group))
        else:
            order = np.argsort(digit)
        live, digit, group = live[order], digit[order], group[order]
        new = np.ones(len(live), bool)
        new[1:] = (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])
        first = np.flatnonzero(new)
        if not len(first):
            return out
        size = np.diff(np.append(first, len(live)))
        low, high = np.minimum.reduceat(owner[live], first), np.maximum.reduceat(owner[live], first)
        keep = low < high
        stays = np.repeat(keep, size)
        live, group = live[stays], np.repeat(np.arange(int(keep.sum())), size[keep])
    out[live] = owner[live] > np.repeat(low[keep], size[keep])
    return out


def _settled(
    doc: np.ndarray, key: np.ndarray, start: np.ndarray, count: np.ndarray, data: np.ndarray, more_of: np.ndarray, more: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ranges (doc, key, start, end) that the pieces of a bin lose; ``more``: further places of the pieces ``more_of``."""
    size = count + length - 1
    at = np.cumsum(size) - size
    prefix = prefix_hash(data)
    lead = _leaders(data, prefix, at, size, doc)
    own = np.flatnonzero(lead == np.arange(len(lead)))
    flags = repeated(data, prefix, at[own], count[own], doc[own], length)
    # a piece that equals one of a smaller document goes whole, one of the same document goes like that
    at_flag = np.zeros(len(lead), np.int64)
    at_flag[own] = np.cumsum(count[own]) - count[own]
    # the further places of a piece within its text fare like it
    doc, key, start, count, lead = np.append(doc, doc[more_of]), np.append(key, key[more_of]), np.append(start, more), np.append(count, count[more_of]), np.append(lead, lead[more_of])
    of = np.repeat(np.arange(len(lead)), count)
    gone = flags[ranges(at_flag[lead], count)] | (doc[lead] < doc)[of]
    where = np.flatnonzero(gone)
    # neighbouring strings of a piece as one range
    new = np.ones(len(where), bool)
    new[1:] = (np.diff(where) != 1) | (np.diff(of[where]) != 0)
    first = np.flatnonzero(new)
    last = where[np.append(first, len(where))[1:] - 1]
    first = where[first]
    of = of[first]
    string = start[of] + (first - (np.cumsum(count) - count)[of])
    return doc[of], key[of], string, string + (last - first) + length


def _runs(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of equal keys that touch or overlap as one: (key, start, end)."""
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], end[order]
    if not len(key):
        return key, start, end
    # the end so far within a key, by lifting each key above the one before
    lift = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))).astype(np.int64) * (int(end.max()) + 2)
    far = np.maximum.accumulate(end + lift)
    new = np.ones(len(key), bool)
    new[1:] = start[1:] + lift[1:] > far[:-1]
    first = np.flatnonzero(new)
    return key[first], start[first], (far - lift)[np.append(first[1:], len(key)) - 1]


_ZSTD = pa.Codec("zstd", compression_level=3)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, compressed; the bytes of larger numbers by their place, so the high ones hardly count."""
    out = []
    for x in arrays:
        plain = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes() if x.itemsize > 1 else x.tobytes()
        body = _ZSTD.compress(plain, asbytes=True) if plain else b""
        out += [len(body).to_bytes(4, "little"), len(plain).to_bytes(4, "little"), body]
    return b"".join(out)


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size, plain = (int.from_bytes(blob[at + k : at + k + 4], "little") for k in (0, 4))
        x = np.frombuffer(_ZSTD.decompress(blob[at + 8 : at + 8 + size], plain, asbytes=True) if plain else b"", np.uint8)
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(x.reshape(width, -1).T).view(kind).ravel() if width > 1 else x.view(kind))
        at += 8 + size
    return out


_PIECES, _MARKS = 0, 1
_TRAVEL = "slot long, kind int, body binary"


def _bucket(doc: np.ndarray, key: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(doc.astype(np.uint64) ^ key) % np.uint64(buckets)).astype(np.int64)


def _rows(slot: list, kind: int, bodies: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array([kind] * len(slot), pa.int32()), pa.array(bodies, pa.binary())], names=["slot", "kind", "body"])


def _marks(doc: np.ndarray, key: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Ranges as packed rows, one a bucket."""
    names, which = np.unique(np.stack([doc.astype(np.uint64), key], axis=1), axis=0, return_inverse=True)
    which, start, end = _runs(which.ravel(), start, end)
    doc, key = names[which, 0].astype(np.int64), names[which, 1]
    bucket = _bucket(doc, key, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
        some = order[a:b]
        yield int(bucket[some[0]]), _pack(doc[some], key[some], start[some].astype(np.int64), end[some].astype(np.int64))


def _text_keys(data: np.ndarray, offsets: np.ndarray, needed: bool) -> np.ndarray:
    """A number for each text; rows with equal doc_id and number are one document. Zeros where ids alone tell."""
    if not needed:
        return np.zeros(len(offsets) - 1, np.uint64)
    size = np.diff(offsets).astype(np.uint64)
    return mix64(span_hash(prefix_hash(data), offsets[:-1], offsets[1:]) + size)


def _chosen_counts(texts: DataFrame, length: int, heavy: np.ndarray, share: float) -> DataFrame:
    """How many strings choose each gram, if ``heavy`` ones come last: (kind 0, gram, n); all bytes (kind 1) and strings (kind 2).

    A task reports the grams that hold about ``share`` of its own strings, as any gram
    that holds so many of all must in some task; at most a few / ``share`` of them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, strings, waiting = 0, 0, 0
        held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]

        def merge() -> None:
            gram, at = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
            held[:] = [(gram, np.bincount(at, np.concatenate([n for _, n in held]), len(gram)).astype(np.int64))]

        for batch in batches:
            data, offsets = as_binary(batch.column(0))
            size += int(offsets[-1] - offsets[0])
            for _, _, inner, _ in _sections(offsets, length):
                part, inner = data[inner[0] : inner[-1]], inner - inner[0]
                # no string starts in the last bytes of a text
                starts, rest = np.ones(len(part), bool), np.minimum(np.diff(inner), length - 1)
                starts[ranges(inner[1:] - rest, rest)] = False
                gram = chosen_grams(part, length, heavy)[starts]
                strings += len(gram)
                # neighbours mostly chose alike
                cuts = np.flatnonzero(np.concatenate([gram[:1] == gram[:1], gram[1:] != gram[:-1]]))
                found, at = np.unique(gram[cuts], return_inverse=True)
                n = np.bincount(at, np.diff(np.append(cuts, len(gram))), len(found)).astype(np.int64)
                # rare ones go at once, so what a task holds stays small
                keep = n > share / 4 * len(gram)
                held.append((found[keep], n[keep]))
                waiting += int(keep.sum())
                if waiting > max(len(held[0][0]), 1 << 16):
                    merge()
                    waiting = 0
        merge()
        gram, n = held[0]
        keep = n > share / 2 * strings
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.zeros(keep.sum()), [1, 2]]).astype(np.int32)), pa.array(np.concatenate([gram[keep].view(np.int64), [0, 0]])),
             pa.array(np.concatenate([n[keep], [size, strings]]))], names=["kind", "gram", "n"]
        )
        held.clear()
        release_memory()

    counted = texts.select("text").mapInArrow(count, "kind int, gram long, n long")
    return stored(counted.groupBy("kind", "gram").agg(F.sum("n").alias("n")), "grams")


def _statistics(texts: DataFrame, length: int) -> tuple[int, np.ndarray, np.ndarray]:
    """All bytes of all texts, the grams that are lengthened, and those of the longest whose strings go one by one.

    Shares add up to one, so each pass finds fewer than 1 / HEAVY or 1 / HOT_SHARE.
    """

    def over(totals: DataFrame, least: float) -> np.ndarray:
        rows = totals.filter((F.col("kind") == 0) & (F.col("n") > least)).select("gram").collect()
        return np.array([r["gram"] for r in rows], np.int64).view(np.uint64)

    heavy = hot = np.zeros(0, np.uint64)
    sizes = _sizes(length)
    totals = _chosen_counts(texts, length, heavy, HEAVY)
    whole = {r["kind"]: r["n"] for r in totals.filter("kind > 0").collect()}
    size, strings = int(whole.get(1) or 0), int(whole.get(2) or 0)
    least = max(HOT, strings * HOT_SHARE)
    found = over(totals, min(strings * HEAVY, least) if len(sizes) > 1 else least)
    for turn in range(len(sizes) + 1):
        last = (found & _LEVEL) == np.uint64(len(sizes) - 1)
        heavy, hot = np.concatenate([heavy, found[~last]]), np.concatenate([hot, found[last]])
        # where no gram was lengthened, no string chooses anew
        known = last.all() and (turn or strings * HEAVY <= least)
        if known or strings <= least or turn == len(sizes):
            break
        found = over(_chosen_counts(texts, length, heavy, least / strings), least)
        found = found[~np.isin(found, hot)]
    return size, heavy, hot


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the bytes that are ``kept``."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), text_column().alias("text"))
    total, heavy, hot = _statistics(texts, length)
    again = texts.groupBy("doc_id").count().filter("count > 1").limit(1).count() > 0
    bins, buckets = max(1, -(-total // _BIN)), max(1, -(-total // _BUCKET))
    # neighbouring bins of a slot travel together
    together = min(max(bins // _KEYS, 1), _BINS_A_SLOT)
    buckets = max(1, -(-buckets // min(max(buckets // _KEYS, 1), _BUCKETS_JOINED)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of a pack: its texts (doc, key, place of the first byte), pieces (text, place, count, gram, single), further
        # places (place, piece), and all bytes
        held: list[list[np.ndarray]] = [[] for _ in range(11)]

        def packed() -> Iterator[pa.RecordBatch]:
            docs, keys, begin, text, at, count, gram, single, more, more_of, body = (np.concatenate(h) for h in held)
            for h in held:
                h.clear()
            stays = np.ones(len(text), bool)
            alone = np.flatnonzero(single)
            if len(alone):
                own = docs[text[alone]]
                lead = _leaders_by(gram[alone], body, at[alone], np.full(len(alone), length), own)
                stays[alone] = own[lead] == own
                gone, with_it = np.flatnonzero(~stays), ~stays[more_of]
                of = text[np.concatenate([gone, more_of[with_it]])]
                where = np.concatenate([at[gone] - begin[text[gone]], more[with_it]])
                if len(of):
                    found = list(_marks(docs[of], keys[of], where, where + length, buckets))
                    yield _rows([s for s, _ in found], _MARKS, [m for _, m in found])
                more, more_of = more[~with_it], more_of[~with_it]
            within = (gram % np.uint64(bins)).astype(np.int64)
            # pieces with one gram lie side by side, where they compress well
            order = np.flatnonzero(stays)
            low = 63 - bins.bit_length()
            order = order[np.argsort((within[order] << low) | (gram[order] & np.uint64((1 << low) - 1)).astype(np.int64))]
            slot = within // together
            cuts = np.append(np.flatnonzero(np.diff(slot[order], prepend=-1)), len(order))
            number = np.zeros(len(text), np.int64)
            number[order] = np.arange(len(order))
            turn = np.argsort(number[more_of], kind="stable")
            more, more_of = more[turn], number[more_of][turn]
            more_cuts = np.searchsorted(more_of, cuts)
            for k in range(0, len(cuts) - 1, 64):
                slots, bodies = [], []
                for c in range(k, min(k + 64, len(cuts) - 1)):
                    some, extra = order[cuts[c] : cuts[c + 1]], slice(more_cuts[c], more_cuts[c + 1])
                    of, n = text[some], count[some]
                    slots.append(int(slot[some[0]]))
                    each = np.bincount(within[some] - slots[-1] * together, minlength=together)
                    strings = body[ranges(at[some], n.astype(np.int64) + length - 1)]
                    bodies.append(_pack(each, docs[of], keys[of], at[some] - begin[of], n, strings, more_of[extra] - cuts[c], more[extra]))
                yield _rows(slots, _PIECES, bodies)

        size = n_texts = n_pieces = 0
        for batch in batches:
            data, offsets = as_binary(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            keys, first, known = np.zeros(0, np.uint64), np.zeros(0, bool), None
            for a, b, inner, before in _sections(offsets, length):
                if known != a:
                    whole, own, known = offsets[a : b + 1] - offsets[a], ids[a:b], a
                    keys = _text_keys(data[offsets[a] : offsets[b]], whole, again)
                    # equal rows travel once: their ranges are the same
                    _, one = np.unique(np.stack([own.astype(np.uint64), keys], axis=1), axis=0, return_index=True)
                    first = np.zeros(len(own), bool)
                    first[one] = True
                part, inner = data[inner[0] : inner[-1]], inner - inner[0]
                p = Pieces(part, inner, length, heavy, hot)
                doc = own[p.text]
                lead = _leaders(part, prefix_hash(part), p.start, p.count + length - 1, doc)
                later = doc[lead] < doc
                if later.any():
                    at = p.start[later] - inner[p.text[later]] + before
                    found = list(_marks(doc[later], keys[p.text[later]], at, at + p.count[later] + length - 1, buckets))
                    yield _rows([s for s, _ in found], _MARKS, [m for _, m in found])
                # so do the equal pieces of one text, with all their places
                more = (lead != np.arange(len(lead))) & (p.text[lead] == p.text)
                go = ~later & ~more & first[p.text]
                more &= first[p.text]
                now = (
                    own, keys, inner[:-1] - before + size, (p.text[go] + n_texts).astype(np.int32), p.start[go] + size, p.count[go].astype(np.uint8), p.gram[go], p.single[go],
                    p.start[more] - inner[p.text[more]] + before, (np.cumsum(go) - 1)[lead[more]] + n_pieces, part,
                )
                for h, x in zip(held, now, strict=True):
                    h.append(x)
                size, n_texts, n_pieces = size + len(part), n_texts + len(own), n_pieces + len(now[3])
                if size >= _PACK:
                    yield from packed()
                    release_memory()
                    size = n_texts = n_pieces = 0
        if size:
            yield from packed()
            release_memory()

    def sort_bin(table: pa.Table) -> pa.Table:
        slots, bodies = [], []
        kind, body, slot = table["kind"].to_pylist(), table["body"], table["slot"].to_pylist()
        pieces = []
        for k in range(len(kind)):
            if kind[k] == _MARKS:
                slots.append(slot[k] // 2)
                bodies.append(body[k].as_py())
            else:
                pieces.append(_unpack(body[k].as_py(), "<i8", "<i8", "<u8", "<i8", "u1", "u1", "<i8", "<i8"))
        # where in each row its bins begin: pieces, their text, further places
        cuts = [np.concatenate(([0], np.cumsum(p[0]))) for p in pieces]
        text_cuts = [np.concatenate(([0], np.cumsum(p[4].astype(np.int64) + length - 1)))[c] for p, c in zip(pieces, cuts, strict=True)]
        more_cuts = [np.searchsorted(p[6], c) for p, c in zip(pieces, cuts, strict=True)]
        found = []
        for k in range(together):
            some = [
                [x[c[k] : c[k + 1]] for x in p[1:5]] + [p[5][t[k] : t[k + 1]], p[6][m[k] : m[k + 1]] - c[k], p[7][m[k] : m[k + 1]]]
                for p, c, t, m in zip(pieces, cuts, text_cuts, more_cuts, strict=True)
            ]
            base = np.cumsum([0] + [len(p[0]) for p in some])
            if base[-1]:
                doc, key, start, count, data, _, more = (np.concatenate([p[i] for p in some]) for i in range(7))
                more_of = np.concatenate([p[5] + b for p, b in zip(some, base, strict=False)])
                found.append(_settled(doc, key, start, count.astype(np.int64), data, more_of, more, length))
        if any(len(f[0]) for f in found):
            for s, m in _marks(*(np.concatenate(x) for x in zip(*found, strict=True)), buckets):
                slots.append(s)
                bodies.append(m)
        return pa.table([pa.array(slots, pa.int64()), pa.array(bodies, pa.binary())], names=["bucket", "marks"])

    dealt = texts.mapInArrow(deal, _TRAVEL)
    # marks pass through any task on their way: twice the bucket, and one more for the pieces of a bin
    slotted = dealt.withColumn("slot", F.col("slot") * 2 + F.when(F.col("kind") == _PIECES, 1).otherwise(0))
    marks = slotted.groupBy("slot").applyInArrow(sort_bin, "bucket long, marks binary")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_binary(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            for a, b in text_blocks(offsets, _PACK):
                part, inner, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ids[a:b]
                keys = _text_keys(part, inner, again)
                _, one, copies = np.unique(np.stack([own.astype(np.uint64), keys], axis=1), axis=0, return_index=True, return_counts=True)
                bucket = _bucket(own[one], keys[one], buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                slots, bodies = [], []
                for x, y in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
                    some = one[order[x:y]]
                    size = np.diff(inner)[some]
                    slots.append(int(bucket[order[x]]))
                    bodies.append(_pack(own[some], keys[some], copies[order[x:y]].astype(np.int64), size.astype(np.int64), part[ranges(inner[some], size)]))
                yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(bodies, pa.binary())], names=["place", "texts"])
        release_memory()

    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        where: dict[tuple, list] = {}
        for m in right["marks"].to_pylist():
            for d, k, s, e in zip(*(x.tolist() for x in _unpack(m, "<i8", "<u8", "<i8", "<i8")), strict=True):
                where.setdefault((d, k), []).append((s, e))
        out: list[tuple] = []
        for body in left["texts"].to_pylist():
            doc, keys, copies, size, data = _unpack(body, "<i8", "<u8", "<i8", "<i8", "u1")
            ends = np.cumsum(size)
            for d, k, n, a, b in zip(doc.tolist(), keys.tolist(), copies.tolist(), (ends - size).tolist(), ends.tolist(), strict=True):
                spans = where.get((d, k), [])
                if spans:
                    s, e = np.array(spans, np.int64).T
                    _, s, e = _runs(np.zeros(len(s), np.int64), s, e)
                    keep = np.ones(b - a, bool)
                    keep[ranges(s, e - s)] = False
                    kept, removed, n_spans = data[a:b][keep].tobytes(), int((e - s).sum()), len(s)
                else:
                    kept, removed, n_spans = data[a:b].tobytes(), 0, 0
                out += [(None if d == _NO_ID else d, b - a, removed, n_spans, kept)] * n
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    placed = texts.mapInArrow(place, "place long, texts binary")
    return placed.groupBy("place").cogroup(marks.groupBy("bucket")).applyInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
