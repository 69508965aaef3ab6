"""Piece encoding and decoding with the N best segmentations of whole texts.

The piece model (a sentencepiece file) gives pieces with scores; the best segmentation of
a text is the path through its piece lattice with the largest sum of scores.
Spaces become marks. A piece holds marks at its begin alone (runs of them are pieces
too), so the lattice of a text is that of its units, one after the other: a unit is a
maximal run of blanks with the word after it. Each distinct unit of a block is solved
once; "word" below means such a unit.

* Best path: forward Viterbi scores over the lattices of all distinct words at once, vectorised by place.
* N best: A-star search from a word's end to its start. The heuristic of a place is its
  forward Viterbi score, which is exact, so paths leave the queue in order of
  their scores and no other path is expanded. Of equal ones the path nearest the start
  goes first, and no place is left more than N times, as the many equal ways through a
  long run of blanks would be otherwise.
* N best of a text: only the N - 1 words whose second path costs least can differ
  from their best path. The cost of a word's second path is exact from forward
  and backward scores; the searches run for those words alone and their lists are merged.
  The merge notes which segmentation of each of those words a rank takes, so the ids of all
  N segmentations of a text are written out, not their scores alone.

Characters without a piece are spelled in byte pieces, each below the score of
every piece. The mark itself, where a text holds it, is spelled too, so decoding
gives back every text exactly. Ties go to the longer last piece.

NULL and empty texts have no pieces, score 0 and that one segmentation.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import as_binary, ranges, read_table, release_memory, segment_ids, text_blocks, text_column

MARK = "▁"
NBEST = 4
# the file gives scores below this to pieces for which nothing else stands; they count as spelled characters do
_LAST_RESORT = -1e8
# distinct words whose lattices are solved together
_WORDS = 8_000
# words whose N best segmentations a worker keeps, about 1.5 KB each
_KEPT = 16_384


class PieceModel:
    """Pieces, scores and the prefix tree of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(len(names))]
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes_of: list[bytes] = []
        self.score: dict[str, tuple[float, int]] = {}
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
                self.bytes_of.append(bytes([int(name[3:5], 16)]))
                continue
            self.bytes_of.append(b"" if special[i] else name.replace(MARK, " ").encode())
            if not special[i]:
                # such a piece would reach from one unit into the next
                if MARK in name.lstrip(MARK):
                    raise ValueError(f"piece {name!r} has a mark after another character")
                self.score[name] = (float(model.get_score(i)), i)
        self.unknown = min(s for s, _ in self.score.values() if s > _LAST_RESORT) - 10.0
        self.score = {name: (max(s, self.unknown), i) for name, (s, i) in self.score.items()}
        self.longest = max(map(len, self.score))
        self._tree()
        self._sizes = np.array([len(b) for b in self.bytes_of])
        self._flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self._first = np.cumsum(self._sizes) - self._sizes
        self.pieces = pa.array(self.bytes_of, pa.large_binary())

    def _tree(self) -> None:
        """Edges (node, character) -> node by hashed keys; node 0 is the root."""
        nodes: dict[tuple[int, int], int] = {}
        scores, ids = [np.nan], [-1]
        for name, (score, i) in self.score.items():
            at = 0
            for c in map(ord, name):
                if (at, c) not in nodes:
                    nodes[at, c] = len(scores)
                    scores.append(np.nan)
                    ids.append(-1)
                at = nodes[at, c]
            scores[at], ids[at] = score, i
        keys, child = np.array([(n << 21) | c for n, c in nodes], np.int64), np.array(list(nodes.values()), np.int64)
        # an open table four times as large: a key stands at its hash or at the next free slot after it
        bits = max(len(keys), 1).bit_length() + 2
        self._shift = np.uint64(64 - bits)
        self._keys, self._child = np.full(1 << bits, -1), np.zeros(1 << bits, np.int64)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self._keys[slot[left]] < 0]
            self._keys[slot[free]] = keys[free]
            left = left[self._keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (len(self._keys) - 1)
        self._child[slot] = child
        self._node_score, self._node_id = np.array(scores), np.array(ids, np.int64)
        self._root = np.zeros(0x110000, np.int64)
        for (n, c), child in nodes.items():
            if n == 0:
                self._root[c] = child

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _next(self, keys: np.ndarray) -> np.ndarray:
        """The node that each edge leads to, 0 where there is none."""
        slot = self._slots(keys)
        there = self._keys[slot]
        out = np.where(there == keys, self._child[slot], 0)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self._keys) - 1)
            there = self._keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self._child[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of pieces (with the blank that stands before every text)."""
        return self._flat[ranges(self._first[ids], self._sizes[ids])]

    def spelled(self, c: str) -> list[int]:
        return self.byte_ids[list(c.encode())].tolist()

    def edges(self, chars: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, end, score, id) of all pieces in words laid end to end; id -1 spells a character. ``ends``: of each place's word."""
        place = np.arange(len(chars))
        # blanks are the marks of pieces; a mark is a character of the text
        inner = chars == ord(MARK)
        chars = np.where(chars == ord(" "), ord(MARK), chars)
        node = self._root[chars]
        out = []
        node[inner] = 0
        lone = (node == 0) | (self._node_id[node] < 0)
        out.append((place[lone], np.full(int(lone.sum()), self.unknown), np.full(int(lone.sum()), -1), np.ones(int(lone.sum()), np.int64)))
        live = node > 0
        place, node, depth = place[live], node[live], 1
        while len(place):
            piece = self._node_id[node] >= 0
            out.append((place[piece], self._node_score[node[piece]], self._node_id[node[piece]], np.full(int(piece.sum()), depth)))
            go = place + depth < ends[place]
            place, node = place[go], node[go]
            child = self._next((node << 21) | chars[place + depth])
            hit = (child > 0) & ~inner[place + depth]
            place, node, depth = place[hit], child[hit], depth + 1
        start, score, ids, length = (np.concatenate(x) for x in zip(*out, strict=True))
        return start, start + length, score, ids

    def solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best segmentation of each word: ids concatenated, ids of each, score of each, cost of its second path."""
        words = [_blank_first(w) for w in words]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        last = np.cumsum(sizes)
        first = last - sizes
        start, end, score, ids = self.edges(chars, np.repeat(last, sizes))
        word = segment_ids(sizes)[start]
        # a place is a border between characters; each word has one more border than characters
        a, b = start + word, end + word
        n = len(chars) + len(words)
        zero, goal = first + np.arange(len(words)), last + np.arange(len(words))
        forward = _best(n, zero, a, b, start - first[word], score)
        backward = _best(n, goal, b, a, last[word] - end, score)
        value = forward[a] + score
        through = value + backward[b]
        # the last edge of the best path to each border: edges come in order of their length, and of equal ones the longest counts
        via, best = np.full(n, -1), np.flatnonzero(value == forward[b])
        via[b[best]] = best
        on_path = np.zeros(len(a), bool)
        at, going = goal.copy(), np.flatnonzero(sizes > 0)
        # the edge of the best paths that starts at each place
        edge = np.full(len(chars), -1)
        while len(going):
            edges = via[at[going]]
            on_path[edges] = True
            edge[start[edges]] = edges
            at[going] = a[edges]
            going = going[at[going] != zero[going]]
        edge = edge[edge >= 0]
        flat, per_edge = self._spell(ids[edge], chars[start[edge]])
        counts = np.bincount(word[edge], per_edge, len(words)).astype(np.int64)
        total = forward[goal]
        second = np.full(len(words), -np.inf)
        np.maximum.at(second, word[~on_path], through[~on_path])
        return flat, counts, total, total - second

    def _spell(self, ids: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lone = np.flatnonzero(ids < 0)
        if not len(lone):
            return ids, np.ones(len(ids), np.int64)
        kinds, which = np.unique(chars[lone], return_inverse=True)
        spelled = [self.spelled(chr(c)) for c in kinds]
        size = np.array([len(s) for s in spelled])
        per = np.ones(len(ids), np.int64)
        per[lone] = size[which]
        out = np.repeat(ids, per)
        begin = (np.cumsum(per) - per)[lone]
        out[ranges(begin, size[which])] = np.concatenate(spelled)[ranges((np.cumsum(size) - size)[which], size[which])]
        return out, per

    def word_edges(self, word: str) -> list[list[tuple[int, float, int]]]:
        """Per end the pieces (start, score, id) of one word."""
        chars = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        out: list[list] = [[] for _ in range(len(word) + 1)]
        for s, e, score, i in zip(*(x.tolist() for x in self.edges(chars, np.full(len(chars), len(chars)))), strict=True):
            out[e].append((s, score, i))
        return out

    def nbest(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of a word (score, ids), by A-star from its end."""
        word = _blank_first(word)
        into = self.word_edges(word)
        forward = [0.0] + [-np.inf] * len(word)
        for e in range(1, len(word) + 1):
            forward[e] = max(forward[s] + score for s, score, _ in into[e])
        queue = [(-forward[-1], len(word), 0, 0.0, None)]
        made, out = 1, []
        left = [n] * (len(word) + 1)
        while queue and len(out) < n:
            _, at, _, behind, path = heapq.heappop(queue)
            if at == 0:
                ids: list[int] = []
                while path:
                    (s, i), path = path
                    ids += self.spelled(word[s]) if i < 0 else [i]
                out.append((behind, ids))
                continue
            # paths come to a place in order of what lies behind it: those after the n-th are in no n best
            if not left[at]:
                continue
            left[at] -= 1
            for s, score, i in sorted(into[at]):
                heapq.heappush(queue, (-(forward[s] + score + behind), s, made, score + behind, ((s, i), path)))
                made += 1
        return out


def _blank_first(word: str) -> str:
    """A word may come with the mark in place of its first blank."""
    return " " + word[1:] if word[:1] == MARK else word


def _best(n: int, origin: np.ndarray, a: np.ndarray, b: np.ndarray, step: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Best score from the origins to each border over edges a -> b.

    ``step`` is the distance of a from its word's origin: edges are taken in its order, those of all words
    together. Edges come in order of their length, so those of one step and length lead to different borders.
    """
    best = np.full(n, -np.inf)
    best[origin] = 0.0
    if not len(step):
        return best
    # a stable sort of small numbers is a radix sort
    order = np.argsort(step.astype(np.uint16) if step.max() < 1 << 16 else step, kind="stable")
    step, a, b, score = step[order], a[order], b[order], score[order]
    length = np.abs(b - a)
    cuts = np.flatnonzero((step[1:] != step[:-1]) | (length[1:] != length[:-1])) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(step)], strict=True):
        to = b[lo:hi]
        best[to] = np.maximum(best[to], best[a[lo:hi]] + score[lo:hi])
    return best


def merge_nbest(lists: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` largest sums with one entry of each list (each in descending order), and which entries they take."""
    sums: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for scores in lists:
        sums = heapq.nlargest(n, ((s + x, took + (k,)) for s, took in sums for k, x in enumerate(scores)), key=lambda x: x[0])
    return sums


def _units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units of texts with a blank before each, and the unit and text of each place where one stands."""
    lists = pc.split_pattern(texts, " ")
    bounds = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy().astype(np.int64)
    # no word holds a blank, so all of them travel as one string
    kinds = encoded.dictionary
    plain = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(kinds)], pa.int32()), kinds), " ")[0].as_py().split(" ") if len(kinds) else []
    words = [" " + w for w in plain]
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    # an empty text has no unit, though the split gives a word
    keep = ~pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)[text]
    text, codes = text[keep], codes[keep]
    if "" not in plain or not len(codes):
        return words, codes, text
    # one blank stands before each word; empty words are blanks of the next one, or of the text's end
    ends = np.flatnonzero((codes != plain.index("")) | np.append(text[1:] != text[:-1], True))
    blanks, codes, text = np.diff(ends, prepend=-1), codes[ends], text[ends]
    runs = np.flatnonzero(blanks > 1)
    most = int(blanks.max()) + 1
    kinds, which = np.unique(codes[runs] * most + blanks[runs], return_inverse=True)
    codes[runs] = len(words) + which
    words += [" " * (k % most) + plain[k // most] for k in kinds.tolist()]
    return words, codes, text


class PieceEncoder:
    """Encodes texts: the ``n`` best segmentations and their scores."""

    def __init__(self, path: str, n: int = NBEST):
        self.model, self.n = PieceModel(path), n
        self._word_nbest = lru_cache(maxsize=_KEPT)(lambda w: [(s, np.array(ids, np.int32)) for s, ids in self.model.nbest(w, n)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[float]]]:
        """The best segmentations: all ids concatenated, ids of each text, and its best scores in descending order."""
        ids, sizes, scores = self.segmentations(texts)
        made = np.fromiter(map(len, scores), np.int64, len(scores))
        best = np.cumsum(made) - made
        return ids[ranges((np.cumsum(sizes) - sizes)[best], sizes[best])], sizes[best], scores

    def segmentations(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[float]]]:
        """Ids of all segmentations concatenated, text by text from the best on, ids of each, and the scores of each text's."""
        words, codes, text = _units(texts)
        solved = [self.model.solve(words[k : k + _WORDS]) for k in range(0, len(words), _WORDS)]
        flat, counts, score, cost = (np.concatenate(x) for x in zip(*solved, strict=True)) if solved else [np.zeros(0, np.int64)] * 4
        first = np.cumsum(counts) - counts
        best = np.bincount(text, score[codes], len(texts))
        # the words whose second paths cost least, n - 1 of each text
        order = np.lexsort((np.arange(len(codes)), cost[codes], text))
        rank = np.arange(len(order)) - np.searchsorted(text[order], np.arange(len(texts)))[text[order]]
        order = order[(rank < self.n - 1) & np.isfinite(cost[codes[order]])]
        scores: list[list[float]] = [[float(b)] for b in best]
        cuts = np.searchsorted(text[order], np.arange(len(texts) + 1))
        # (text, rank, place among its units, ids) where a segmentation leaves the best path
        other: list[tuple[int, int, int, np.ndarray]] = []
        units = np.searchsorted(text, np.arange(len(texts) + 1))
        for t in np.flatnonzero(np.diff(cuts)).tolist():
            places = order[cuts[t] : cuts[t + 1]].tolist()
            chosen = [int(codes[p]) for p in places]
            rest = float(best[t]) - sum(float(score[c]) for c in chosen)
            lists = [self._word_nbest(words[c]) for c in chosen]
            merged = merge_nbest([[s for s, _ in found] for found in lists], self.n)
            scores[t] = [rest + s for s, _ in merged]
            for rank, (_, took) in enumerate(merged):
                other += [(t, rank, p - int(units[t]), found[k][1]) for p, found, k in zip(places, lists, took, strict=True) if k]
        made = np.fromiter(map(len, scores), np.int64, len(scores))
        # the units of every segmentation as ranges of ids: those of the best path, then the others
        lengths = np.fromiter((len(x) for *_, x in other), np.int64, len(other))
        begins = len(flat) + np.cumsum(lengths) - lengths
        flat = np.concatenate([flat, *(x for *_, x in other)]).astype(np.int32)
        place = np.array([x[:3] for x in other], np.int64).reshape(-1, 3)
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        # some texts at a time: the units of all their segmentations take far more room than the texts
        for a, b in text_blocks(units * 8 * self.n):
            of = np.repeat(np.arange(a, b), made[a:b])
            n_units = np.diff(units)[of]
            at = codes[ranges(units[of], n_units)]
            begin, size = first[at], counts[at]
            seg, first_unit = np.cumsum(made[a:b]) - made[a:b], np.cumsum(n_units) - n_units
            lo, hi = np.searchsorted(place[:, 0], (a, b))
            swap = first_unit[seg[place[lo:hi, 0] - a] + place[lo:hi, 1]] + place[lo:hi, 2]
            begin[swap], size[swap] = begins[lo:hi], lengths[lo:hi]
            ids.append(flat[ranges(begin, size)])
            sizes.append(np.bincount(segment_ids(n_units), size, len(of)).astype(np.int64))
        return np.concatenate(ids), np.concatenate(sizes), scores

    def round_trip(self, texts: pa.Array, ids: np.ndarray, sizes: np.ndarray, made: np.ndarray | None = None) -> np.ndarray:
        """Whether decoding the ids gives back each text; ``made``: segmentations of each text, one where it is left out."""
        of = np.repeat(np.arange(len(texts)), 1 if made is None else made)
        out = np.empty(len(of), bool)
        data, offsets = as_binary(texts)
        first = np.concatenate(([0], np.cumsum(sizes)))
        # a piece takes an offset of 8 bytes beside its own
        for lo, hi in text_blocks(first * 8):
            decoded, places = as_binary(self.model.pieces.take(pa.array(ids[first[lo] : first[hi]])))
            cuts = places[first[lo : hi + 1] - first[lo]].tolist()
            for k, t, a, b in zip(range(lo, hi), of[lo:hi].tolist(), cuts[:-1], cuts[1:], strict=True):
                plain = decoded[a:b]
                out[k] = np.array_equal(plain[1:], data[offsets[t] : offsets[t + 1]]) and (len(plain) > 0) == (offsets[t + 1] > offsets[t])
        return out


@lru_cache(maxsize=2)
def _encoder(path: str, n: int) -> PieceEncoder:
    """One encoder for all tasks of a Python worker."""
    return PieceEncoder(path, n)


def _lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), values)


def id_width(pieces: int) -> int:
    """Bytes of an id: 2 while the vocabulary fits."""
    return 2 if pieces <= 1 << 16 else 4


def _packed(ids: np.ndarray, sizes: np.ndarray, width: int) -> pa.Array:
    """The ids of each segmentation as little-endian unsigned integers of ``width`` bytes."""
    ends = np.concatenate(([0], np.cumsum(sizes))) * width
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype(f"<u{width}"))]).cast(pa.binary())


def _coded(text: Column, path: str, n: int, with_ids: bool) -> Column:
    """Per text a struct of arrays, one entry for each of the ``n`` best segmentations: scores, digests and, on demand, the ids.

    ``ids`` are bytes (see :func:`id_width`); ``best`` are those of the first as integers. A block of texts is worked on, handed
    out and forgotten before the next one, however many rows come in one batch.
    """
    parts = {"nbest": "array<double>", "n_pieces": "array<long>", "crc32": "array<long>", "round_trip": "array<boolean>"}
    parts |= {"ids": "array<binary>", "best": "array<int>"} if with_ids else {}
    kinds = {"nbest": pa.float64(), "n_pieces": pa.int64(), "crc32": pa.int64(), "round_trip": pa.bool_(), "ids": pa.binary(), "best": pa.int32()}
    fields = [pa.field(name, pa.list_(kinds[name])) for name in parts]

    @F.arrow_udf(", ".join(f"{name} {t}" for name, t in parts.items()))
    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path, n)
        width = id_width(len(encoder.model.bytes_of))
        for texts in batches:
            _, offsets = as_binary(texts)
            for a, b in text_blocks(offsets):
                some = texts.slice(a, b - a)
                ids, sizes, scores = encoder.segmentations(some)
                made = np.fromiter(map(len, scores), np.int64, len(scores))
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(ids[e - s : e].astype("<u4").tobytes()) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                found = {
                    "nbest": _lists(pa.array([s for x in scores for s in x], pa.float64()), made),
                    "n_pieces": _lists(pa.array(sizes), made),
                    "crc32": _lists(pa.array(crc, pa.int64()), made),
                    "round_trip": _lists(pa.array(encoder.round_trip(some, ids, sizes, made)), made),
                }
                if with_ids:
                    first = np.cumsum(made) - made
                    found["ids"] = _lists(_packed(ids, sizes, width), made)
                    found["best"] = _lists(pa.array(ids[ranges((ends - sizes)[first], sizes[first])], pa.int32()), sizes[first])
                out = pa.StructArray.from_arrays([found[name] for name in parts], fields=fields)
                del found, ids
                yield out
                release_memory()

    return pieces(F.coalesce(text.cast("string"), F.lit("")))


def encode(text: Column, path: str, n: int = NBEST) -> Column:
    """Per text a struct with the ``n`` best segmentations: their scores ``nbest``, and ``nbest_ids``, ``nbest_crc32`` and ``nbest_round_trip``.

    ``ids``, ``crc32`` (of the ids, 32-bit, little-endian) and ``round_trip`` are those of the best one. ``nbest_ids`` are bytes, little-endian
    unsigned integers as wide as :func:`id_width` says; :func:`decode` takes them and lists alike. A text with fewer ways has fewer entries.
    """
    named = lambda p: F.struct(
        p["best"].alias("ids"), p["nbest"].alias("nbest"), F.get(p["round_trip"], F.lit(0)).alias("round_trip"), F.get(p["crc32"], F.lit(0)).alias("crc32"),
        p["ids"].alias("nbest_ids"), p["crc32"].alias("nbest_crc32"), p["round_trip"].alias("nbest_round_trip"),
    )
    return F.get(F.transform(F.array(_coded(text, path, n, True)), named), F.lit(0))


def digests(text: Column, path: str, n: int = NBEST) -> Column:
    """Per text a struct of arrays, one entry for each of the ``n`` best segmentations: ``nbest`` scores, ``n_pieces``, ``crc32``, ``round_trip``."""
    return _coded(text, path, n, False)


def decode(ids: Column, path: str, n: int = NBEST) -> Column:
    """The text of a sequence of piece ids, a list or bytes as in ``nbest_ids``; bytes that are no valid UTF-8 become replacement characters."""

    @F.arrow_udf("string")
    def plain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _encoder(path, n).model
        kind = f"<u{id_width(len(model.bytes_of))}"
        numbers = lambda x: np.frombuffer(x, kind).astype(np.int64) if isinstance(x, bytes) else np.array(x, np.int64)
        for lists in batches:
            yield pa.array([None if x is None else model.decode(numbers(x)).tobytes()[1:].decode(errors="replace") for x in lists.to_pylist()], pa.string())

    return plain(ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the N best segmentations: scores, pieces, digests of the ids, and whether they decode to the text; those of the best also alone."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", digests(text_column(), public_tokenizers.path("piece_bpe_32k.model")).alias("_p"))
    best = lambda name: F.get(f"_p.{name}", F.lit(0))
    return coded.select(
        "doc_id", best("n_pieces").alias("n_pieces"), best("nbest").alias("best_score"), F.col("_p.nbest").alias("nbest_scores"),
        best("crc32").alias("ids_crc32"), best("round_trip").alias("round_trip"),
        F.col("_p.n_pieces").alias("nbest_pieces"), F.col("_p.crc32").alias("nbest_crc32"), F.col("_p.round_trip").alias("nbest_round_trip"),
    )
