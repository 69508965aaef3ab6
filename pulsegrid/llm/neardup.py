"""Near-duplicate documents by ProbMinHash over weighted word shingles.

1. A text becomes the set of its five-word shingles, weighted by how often they occur.
   ProbMinHash gives it ``REGISTERS`` registers: every shingle is a Poisson process
   whose rate is its weight, each arrival falls into a random register, and a
   register keeps the shingle of its earliest arrival. Two texts agree in a register with
   the probability Jaccard similarity of their weighted sets. Arrivals are drawn
   in ascending time windows and stop once every register of a text is taken.
2. Texts with equal weighted sets fall into one class at once; only the one with
   the smallest doc_id of each class goes on.
3. Registers are cut into bands. In a bucket (texts with an equal band) all
   members are compared with one centre, then with a second one from those
   that the first left over; comparisons are exact up to 32-bit hashes of shingles. Similar texts join
   one group. Pairs left between groups are told apart by what each has beside the centre and lacks of
   it (:func:`linked`). That loses no similar pair, whatever the weights, and leaves few others
   even among thousands of edited copies; those left are compared where they meet, and each set comes out
   with its number of links and one link to its group, not with every pair.
4. Groups are the connected components of the verified pairs.

Similarity is ``sum over shared i of 1 / sum over j of max(x_j / x_i, y_j / y_i)``; for
weights of one that is the plain Jaccard coefficient.

A text of one to four words is one shingle. Texts without words (NULL and empty
texts too) are not compared: each is a group of its own. Rows that share a
doc_id and words are one document; every input row is returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import Tokens, as_binary, mix64, read_table, release_memory, segment_ids, shingles, stored, text_blocks, text_column

WORDS, SIMILARITY = 5, 0.8
BANDS, BAND = 24, 4
REGISTERS = BANDS * BAND
#: sets, or comparisons of two, that are written together at least
_SETS_A_FILE = 1 << 10
#: stands for a NULL doc_id where the smallest id counts
_NO_ID = 2**63 - 1


def weighted_shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of texts: row, hash and weight of each distinct shingle, by row, then hash."""
    tokens = Tokens(data, offsets)
    found, counts = shingles(tokens.hash, tokens.count, words)
    row = segment_ids(counts)
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(first)
    return row[at], found[at], np.diff(np.append(at, len(found)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def prob_min_hash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """The registers of ``n`` weighted sets (one a row): the element of each earliest arrival, 0 without any.

    Each element's arrivals have exponential gaps drawn from its hash. All arrivals
    up to a time are placed; the rows with an empty register go on to twice that
    time. Later arrivals can't change a full row, so those elements stop early.
    """
    best_time = np.full(n * registers, np.inf)
    best = np.zeros(n * registers, np.uint64)
    if not len(row):
        return best.reshape(n, registers)
    total = np.bincount(row, weight, n)
    limit = np.where(total > 0, registers * (np.log(registers) + 1.0) / np.maximum(total, 1), 0.0)
    rate = 1.0 / weight
    # the next arrival of each element: its number, time and random state
    state = mix64(element ^ np.uint64(0x9E3779B97F4A7C15))
    time = -np.log(_uniform(state)) * rate
    live = np.arange(len(row))
    while len(live):
        due = live[time[live] <= limit[row[live]]]
        while len(due):
            slot = row[due] * registers + (mix64(state[due] + np.uint64(1)) % np.uint64(registers)).astype(np.int64)
            # of several arrivals of this step in one slot the earliest counts; ties go to the smaller element
            order = np.lexsort((element[due], time[due], slot))
            ordered = slot[order]
            lead = order[np.concatenate(([True], ordered[1:] != ordered[:-1]))]
            target, when, who = slot[lead], time[due][lead], element[due][lead]
            better = (when < best_time[target]) | ((when == best_time[target]) & (who < best[target]))
            best_time[target[better]], best[target[better]] = when[better], who[better]
            state[due] = mix64(state[due] + np.uint64(2))
            time[due] += -np.log(_uniform(state[due])) * rate[due]
            due = due[time[due] <= limit[row[due]]]
        empty = np.isinf(best_time.reshape(n, registers)).any(axis=1) & (total > 0)
        live = live[empty[row[live]]]
        limit[empty] *= 2
    return best.reshape(n, registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two weighted sets (ascending elements, weights)."""
    shared, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    x, y = a[1][ia].astype(np.float64), b[1][ib].astype(np.float64)
    return _jaccard(x, y, float(a[1].sum()) - x.sum(), float(b[1].sum()) - y.sum())


def _jaccard(x: np.ndarray, y: np.ndarray, only_x: float, only_y: float) -> float:
    """The similarity from the weights of the shared elements on both sides, and the weight that each side has alone."""
    # for element i, those with a larger x_j / y_j weigh x_j / x_i, the others y_j / y_i
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    larger_x = np.concatenate((np.cumsum(x[::-1])[::-1][1:], [0.0]))
    smaller_y = np.cumsum(y)
    return float((1.0 / ((larger_x + only_x) / x + (smaller_y + only_y) / y)).sum())


def _digest(element: np.ndarray, weight: np.ndarray) -> bytes:
    return hashlib.md5(element.astype("<u8").tobytes() + weight.astype("<u4").tobytes()).digest()


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row, element, weight) of each block of a batch's texts."""
    data, offsets = as_binary(batch.column("text"))
    for a, b in text_blocks(offsets):
        yield a, b - a, *weighted_shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def signatures(docs: DataFrame, key: Column | None = None) -> DataFrame:
    """Per row: doc_id, ``key``, a digest of the weighted shingles (NULL without words) and the hashes of the bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, row, element, weight in _rows_of(batch):
                grouped = prob_min_hash(row, element, weight, n).reshape(n, BANDS, BAND)
                band = np.zeros((n, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for k in range(BAND):
                    band = mix64(band * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
                cuts = np.searchsorted(row, np.arange(n + 1)).tolist()
                digests = [_digest(element[s:e], weight[s:e]) if e > s else None for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, n), batch.column("key").slice(first, n), pa.array(digests, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32()), pa.array(band.ravel().view(np.int64))),
                    ],
                    names=["doc_id", "key", "digest", "bands"],
                )
                release_memory()

    key = F.lit(None) if key is None else key
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"), key.cast("binary").alias("key"))
    return slim.mapInArrow(sign, "doc_id long, key binary, digest binary, bands array<long>")


def weighted_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, elements, weights) of the sets in ``wanted`` (id, doc, digest), read from the texts of their documents.

    Elements are 32-bit shingle hashes, ascending; a false agreement among n
    shingles has the chance n / 2**32 for each of them. Weights that are all one are left empty.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            for first, n, row, element, weight in _rows_of(batch):
                cuts = np.searchsorted(row, np.arange(n + 1)).tolist()
                out = []
                for i, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if _digest(element[s:e], weight[s:e]) == digests[first + i]:
                        # shingles that agree in 32 bits stand side by side and count as one
                        low = (element[s:e] >> np.uint64(32)).astype("<u4")
                        cut = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
                        low, sums = low[cut], np.add.reduceat(weight[s:e], cut)
                        out.append((first + i, low.tobytes(), b"" if (sums == 1).all() else sums.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array([i for i, _, _ in out], pa.int64())), pa.array([x for _, x, _ in out], pa.binary()), pa.array([x for _, _, x in out], pa.binary())],
                    names=["id", "elements", "weights"],
                )

    slim = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), text_column().alias("text"))
    texts = slim.join(wanted.select("id", "doc", "digest"), "doc").distinct()
    return texts.mapInArrow(read, "id long, elements binary, weights binary")


def _not_in(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in ``a`` of what is not in ``b``; both ascending and not empty."""
    return np.flatnonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] != a)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Per pair (id, head) of set ids: similarity, and how ``id`` differs from ``head``.

    ``extras`` lists the shingles of ``id`` that ``head`` lacks; ``extra`` is their share of ``total``, the weight of ``id``, and
    ``top`` the largest of their weights. ``lacks`` lists the shingles of ``head`` that ``id`` lacks, ``missing`` of them.
    ``changed`` lists the shared shingles of unlike weights. ``weights`` has those of the extras, of the lacks (in ``head``), and of the
    changed ones in ``id``, then in ``head``; it is empty where both sets have weights of one alone. ``plain``: ``id`` has.
    """

    def read(elements: pa.Scalar, weights: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        e, w = np.frombuffer(elements.as_buffer(), "<u4"), weights.as_buffer()
        return e, np.frombuffer(w, "<u4") if w.size else np.ones(len(e), np.uint32)

    lists = ["extras", "lacks", "changed", "weights"]

    @F.arrow_udf("similarity double, extra double, missing int, total long, top int, plain boolean, " + ", ".join(f"{c} array<int>" for c in lists))
    def compare(ea: pa.Array, wa: pa.Array, eb: pa.Array, wb: pa.Array) -> pa.Array:
        n = len(ea)
        similarity, extra, missing, total, top = np.zeros(n), np.zeros(n), np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int32)
        plain = np.zeros(n, bool)
        found: dict[str, list[np.ndarray]] = {c: [] for c in lists}
        none = np.zeros(0, np.int32)
        for i in range(n):
            a, b = read(ea[i], wa[i]), read(eb[i], wb[i])
            similarity[i] = probability_jaccard(a, b)
            at, back = _not_in(a[0], b[0]), _not_in(b[0], a[0])
            more = a[1][at]
            total[i] = a[1].sum()
            extra[i], top[i], missing[i], plain[i] = more.sum() / total[i], more.max(initial=0), len(back), not wa[i].as_buffer().size
            found["extras"].append(a[0][at].view(np.int32))
            found["lacks"].append(b[0][back].view(np.int32))
            if plain[i] and not wb[i].as_buffer().size:
                found["changed"].append(none)
                found["weights"].append(none)
                continue
            _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
            unlike = a[1][ia] != b[1][ib]
            found["changed"].append(a[0][ia[unlike]].view(np.int32))
            found["weights"].append(np.concatenate((more, b[1][back], a[1][ia[unlike]], b[1][ib[unlike]])).astype(np.int32))
        ends = lambda x: pa.array(np.concatenate(([0], np.cumsum([len(v) for v in x]))), pa.int32())
        flat = lambda x: pa.ListArray.from_arrays(ends(x), pa.array(np.concatenate([*x, np.zeros(0, np.int32)]).astype(np.int32)))
        columns = {"similarity": similarity, "extra": extra, "missing": missing, "total": total, "top": top, "plain": plain}
        out = pa.StructArray.from_arrays([*map(pa.array, columns.values()), *map(flat, found.values())], names=[*columns, *found])
        del found
        release_memory()
        return out

    side = lambda k, e, w: sets.select(F.col("id").alias(k), F.col("elements").alias(e), F.col("weights").alias(w))
    both = pairs.join(side("id", "_ea", "_wa"), "id").join(side("head", "_eb", "_wb"), "head")
    return both.select("id", "head", compare("_ea", "_wa", "_eb", "_wb").alias("_c")).select("id", "head", "_c.*")


def may_differ(similarity: float) -> float:
    """The most that two similar sets differ by: the share of one's weight that the other lacks, and the other way round, added up.

    With weights p and q of sum one, and a and b what either has alone, an element's term is at most
    ``2 / ((1 + a) / p_i + (1 + b) / q_i)``, and these sum up to at most ``2 / ((1 + a) / (1 - a) + (1 + b) / (1 - b))``. From
    there ``a + b <= 2 (1 - s) / (1 + s)`` for a similarity of s, whatever the weights.
    """
    return 2 * (1 - similarity) / (1 + similarity) + 1e-9


#: members of a centre in a block, about; two blocks are compared at a time
_DEALT = 256
#: shingles that one product of incidence matrices takes
_COLUMNS = 4096


def overlaps(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """How many elements each list of ``a`` shares with each of ``b``; lists hold no element twice."""
    out = np.zeros((len(a), len(b)), np.float32)
    sides = [(x.flatten().to_numpy(), segment_ids(x.value_lengths().to_numpy())) for x in (a, b)]
    common = np.intersect1d(*(values for values, _ in sides))
    found = []
    for values, row in sides:
        at = np.minimum(np.searchsorted(common, values), max(len(common) - 1, 0))
        hit = np.flatnonzero(common[at] == values) if len(common) else np.zeros(0, np.int64)
        order = np.argsort(at[hit], kind="stable")
        found.append((at[hit][order], row[hit][order]))
    for k in range(0, len(common), _COLUMNS):
        blocks = []
        for (at, row), n in zip(found, (len(a), len(b)), strict=True):
            lo, hi = np.searchsorted(at, (k, k + _COLUMNS))
            block = np.zeros((n, min(_COLUMNS, len(common) - k)), np.float32)
            block[row[lo:hi], at[lo:hi] - k] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out


def _met(members: DataFrame, most: float, more: list[str], told: Callable[[pa.Table, pa.Table, np.ndarray, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """What ``told`` makes of each two blocks of members of a centre, and of the pairs of sets of different groups in them that can be similar.

    ``members``: rows (centre, id, group, stray) with the columns of :func:`compared` (of which ``more`` are for ``told``); of a pair one
    at least is a stray. ``most``: see :func:`may_differ`. Seen from the centre, the first of two sets has alone its extras but those that
    they share, and of the centre what only the other lacks (a weight of one at least for each). Nothing similar is lost by that, and for
    sets without weights these are all their differences, so that hardly a pair comes out that is not similar. The members of a centre
    are dealt to blocks; two blocks meet in a task, where two products of incidence matrices count what their members share.
    """
    blocks = members.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / _DEALT).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")
    columns = ["id", "group", "stray", "extra", "missing", "total", "top", "extras", "lacks"]
    dealt = members.join(blocks, "centre").select("centre", *columns, *more, own.alias("_own"), F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
    dealt = dealt.select("centre", *columns, *more, "_own", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"))

    def meet(table: pa.Table) -> pa.Table:
        i, j = table.column("_i")[0].as_py(), table.column("_j")[0].as_py()
        sides = [table.filter(pa.array(table.column("_own").to_numpy() == k)) for k in (i, j)]
        shared, lacked = (overlaps(*(_whole(x, c) for x in sides)) for c in ("extras", "lacks"))
        x, y = ({c: s.column(c).to_numpy() for c in columns[:7]} for s in sides)
        across = {c: y[c][None, :] for c in y}
        x = {c: v[:, None] for c, v in x.items()}
        apart = np.zeros(shared.shape)
        for p, q in ((x, across), (across, x)):
            # extras that it may not share, and what the other lacks of the centre and it does not
            apart += p["extra"] - np.minimum(p["extra"], shared * p["top"] / p["total"]) + (q["missing"] - lacked) / p["total"]
        keep = (apart <= most) & (x["group"] != across["group"]) & (x["stray"] | across["stray"])
        if i == j:
            keep &= x["id"] < across["id"]
        return told(*sides, keep, shared, lacked)

    return dealt.groupBy("centre", "_i", "_j").applyInArrow(meet, schema)


def _whole(table: pa.Table, column: str) -> pa.Array:
    chunked = table.column(column)
    return pa.concat_arrays(chunked.chunks) if chunked.num_chunks else pa.array([], chunked.type)


def candidates(members: DataFrame, most: float) -> DataFrame:
    """Pairs (id, head) of sets of different groups that can be similar, from how each differs from a centre they share: see :func:`_met`."""

    def pairs(x: pa.Table, y: pa.Table, keep: np.ndarray, _shared: np.ndarray, _lacked: np.ndarray) -> pa.Table:
        a, b = np.nonzero(keep)
        ids = x.column("id").to_numpy()[a], y.column("id").to_numpy()[b]
        return pa.table({"id": pa.array(np.minimum(*ids)), "head": pa.array(np.maximum(*ids))})

    return _met(members, most, [], pairs, "id long, head long").distinct()


def linked(members: DataFrame, similarity: float) -> DataFrame:
    """The similar pairs of :func:`candidates`, told by set: rows (id, head, links).

    Rows of one id add up to its number of links, each pair counted once; the edges (id, head) have the components of all these pairs. Two
    blocks give a row at most for each of their members, however many pairs are similar. A pair that several centres have in common
    is compared at the first of them, exactly, from the differences from the centre.
    """
    seen = members.groupBy("id").agg(F.collect_list("centre").alias("centres"), F.collect_list(F.when(F.col("stray"), F.col("centre"))).alias("astray"))
    before = [F.filter(c, lambda at: at < F.col("centre")).alias(c) for c in ("centres", "astray")]
    more = ["plain", "changed", "weights"]

    def told(x: pa.Table, y: pa.Table, keep: np.ndarray, shared: np.ndarray, lacked: np.ndarray) -> pa.Table:
        if keep.any():
            for p, q in (("astray", "centres"), ("centres", "astray")):
                keep &= overlaps(_whole(x, p), _whole(y, q)) == 0
        a, b = np.nonzero(keep)
        total, other = x.column("total").to_numpy()[a], y.column("total").to_numpy()[b]
        # of sets with weights of one: what the first has of the centre but the other lacks, and the extras of both
        extras = _whole(x, "extras").value_lengths().to_numpy()[a]
        both = total - extras - (y.column("missing").to_numpy()[b] - lacked[a, b]) + shared[a, b]
        alike = both / (total + other - both)
        uneven = np.flatnonzero(~(x.column("plain").to_numpy()[a] & y.column("plain").to_numpy()[b]))
        alike[uneven] = from_differences(x, y, a[uneven], b[uneven])
        a, b = a[alike >= similarity], b[alike >= similarity]
        ids, at = np.unique(np.concatenate((x.column("id").to_numpy()[a], y.column("id").to_numpy()[b])), return_inverse=True)
        return pa.table({"id": pa.array(ids), "head": pa.array(ids[_least_reached(at[: len(a)], at[len(a) :], len(ids))]), "links": pa.array(np.bincount(at, minlength=len(ids)))})

    return _met(members.join(seen.select("id", "centres", "astray"), "id").select(*members.columns, *before), may_differ(similarity), [*more, "centres", "astray"], told, "id long, head long, links long")


def _least_reached(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Of each of n nodes the smallest that edges (a, b) join it to."""
    found = np.arange(n)
    while True:
        least = found.copy()
        np.minimum.at(least, a, found[b])
        np.minimum.at(least, b, found[a])
        least = least[least]
        if (least == found).all():
            return found
        found = least


def from_differences(x: pa.Table, y: pa.Table, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of rows ``a`` of x and ``b`` of y, weighted sets that :func:`compared` has told by their differences from one centre.

    Elements that weigh the same on both sides count like a single one that has all of their weight.
    """
    out = np.zeros(len(a))
    if not len(a):
        return out
    sides: list[dict[int, tuple[np.ndarray, ...]]] = []
    for table, rows in ((x, a), (y, b)):
        columns = [_whole(table, c) for c in ("extras", "lacks", "changed", "weights")]
        side = {}
        for r in np.unique(rows).tolist():
            extras, lacks, changed, w = (c[r].values.to_numpy() for c in columns)
            n, m = len(extras), len(extras) + len(lacks)
            w = w.astype(np.float64) if len(w) else np.ones(m)
            own = np.concatenate((w[:n], np.zeros(m - n), w[m : m + len(changed)]))
            side[r] = np.concatenate((extras, lacks, changed)), own, np.concatenate((np.zeros(n), w[n:m], w[m + len(changed) :]))
        sides.append(side)
    names = np.unique(np.concatenate([e for side in sides for e, _, _ in side.values()]))
    centre = np.zeros(len(names))
    for side in sides:
        for r, (e, own, weight) in side.items():
            at = np.searchsorted(names, e)
            centre[at] = weight
            side[r] = at, own
    total = x.column("total").to_numpy()
    left, right, second = centre.copy(), centre.copy(), np.zeros(len(names), bool)
    for k, (p, q) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        (i, own), (j, other) = sides[0][p], sides[1][q]
        left[i], right[j], second[j] = own, other, True
        at = np.concatenate((j, i[~second[i]]))
        v, w = left[at], right[at]
        rest = float(total[p]) - v[v != w].sum()
        unlike = (v != w) & (v > 0) & (w > 0)
        only = v[w == 0].sum(), w[v == 0].sum()
        if rest > 0 or unlike.any():
            out[k] = _jaccard(np.append(v[unlike], rest) if rest > 0 else v[unlike], np.append(w[unlike], rest) if rest > 0 else w[unlike], *only)
        left[i], right[j], second[j] = centre[i], centre[j], False
    return out


def components(edges: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """(id, group) of every node on an edge (a, b): the smallest id that it reaches.

    Each round links the larger neighbours of every node, then the smaller ones,
    to the smallest node next to it, so paths shrink to stars in few rounds. The
    smallest neighbour of a node is a minimum that is pre-aggregated before the shuffle.
    ``rows``: the most edges that there can be, if known.
    """
    current = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), name, rows)
    mark = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # an edge gives two at most
        current = stored(small.union(down.select("a", F.col("m").alias("b"))).filter("a > b").distinct(), name, 2 * current.count())
        before, mark = mark, current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before:
            break
    found = current.groupBy("a").agg(F.min("b").alias("group"))
    return found.select(F.col("a").alias("id"), "group").union(found.select(F.col("group").alias("id"), "group").distinct())


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: doc_id, ``group`` (the smallest doc_id of its group) and ``links``.

    ``links`` counts the verified pairs of the document's class; rows with equal
    weighted shingles are one class. Without a doc_id in its group, ``group`` is NULL.
    """
    signed, of_class = _classes(docs, similarity)
    with_words = signed.filter("digest is not null").select("doc_id", "digest").join(of_class.select("digest", "_first", "links"), "digest")
    return with_words.select("doc_id", F.nullif("_first", F.lit(_NO_ID)).alias("group"), "links").unionByName(
        signed.filter("digest is null").select("doc_id", F.col("doc_id").alias("group"), F.lit(0).cast("long").alias("links"))
    )


def _classes(docs: DataFrame, similarity: float, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows' signatures, and of each class of equal sets (digest) its group, the group's smallest doc_id and the links."""
    signed = stored(signatures(docs, key), "signatures")
    named = F.coalesce("doc_id", F.lit(_NO_ID))
    classes = signed.filter("digest is not null").groupBy("digest").agg(F.min(named).alias("doc"), F.first("bands").alias("bands"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("id"), "digest", "doc", "bands"), "classes", signed.count())
    groups, links = _group(docs, classes, similarity)
    of_class = classes.select("id", "digest", "doc").join(groups, "id", "left").withColumn("group", F.coalesce("group", "id"))
    first = of_class.groupBy("group").agg(F.min("doc").alias("_first"))
    return signed, of_class.join(first, "group").join(links, "id", "left").select("digest", "group", "_first", F.coalesce("links", F.lit(0)).alias("links"))


def _group(docs: DataFrame, classes: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(id, group) of the classes that have a candidate, and (id, links)."""
    n = classes.count()
    buckets = classes.select("id", F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = stored(buckets.join(sizes, "bucket"), "buckets", n * BANDS)
    nodes = shared.select("id").distinct()
    sets = stored(weighted_sets(docs, classes.join(nodes, "id", "left_semi")), "sets", n, _SETS_A_FILE)
    groups = stored(nodes.withColumn("group", F.col("id")), "groups", n)
    in_buckets = shared.count()
    # rounding must not part texts that are exactly as similar as asked
    least = similarity - 1e-9

    def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
        """The groups after links (id, head) between their members."""
        if not (edges := links.count()):
            return groups
        between = links.join(groups.select("id", F.col("group").alias("a")), "id")
        between = between.join(groups.select(F.col("id").alias("head"), F.col("group").alias("b")), "head").select("a", "b")
        found = components(between, "components", edges).select(F.col("id").alias("group"), F.col("group").alias("_to"))
        return stored(groups.join(found, "group", "left").select("id", F.coalesce("_to", "group").alias("group")), "groups", n)

    def against(heads: DataFrame, groups: DataFrame) -> DataFrame:
        """All members of a bucket with its head (bucket, head), where their groups differ."""
        of_head = groups.select(F.col("id").alias("head"), F.col("group").alias("_hg"))
        pairs = shared.select("id", "bucket").join(heads, "bucket").join(of_head, "head").join(groups, "id")
        return stored(pairs.filter(F.col("group") != F.col("_hg")).select("id", "head").distinct(), "pairs", in_buckets)

    # 1. one centre a bucket: a minimum, summed up before any shuffle
    first = F.min(F.struct(F.xxhash64("id").alias("h"), "id"))["id"]
    centres = stored(shared.groupBy("bucket").agg(first.alias("head"), F.max("size").alias("size")), "centres", in_buckets)
    pairs = against(centres.select("bucket", "head"), groups)
    relative = stored(compared(pairs, sets), "relative", pairs.count(), _SETS_A_FILE)
    verified = [relative.filter(F.col("similarity") >= least).select("id", "head")]
    groups = merged(groups, verified[0])

    # 2. one more centre from the members that are not of the first one's group
    def strays(groups: DataFrame) -> DataFrame:
        of_head = groups.select(F.col("id").alias("head"), F.col("group").alias("centre_group"))
        open_ = centres.filter("size > 2").join(of_head, "head")
        members = shared.select("id", "bucket").join(open_.select("bucket", "head", "centre_group"), "bucket").join(groups, "id")
        return members.filter(F.col("group") != F.col("centre_group"))

    second = stored(strays(groups).groupBy("bucket").agg(first.alias("head")), "second", in_buckets)
    if second.limit(1).count():
        pairs = against(second, groups)
        again = stored(compared(pairs, sets).select("id", "head", "similarity"), "second-pairs", pairs.count(), _SETS_A_FILE)
        verified.append(again.filter(F.col("similarity") >= least).select("id", "head"))
        groups = merged(groups, verified[1])

    # 3. the pairs that are left: members of a bucket with strays, as they differ from its first centre
    loose = strays(groups).select("bucket", "id", F.lit(True).alias("stray"))
    of_bucket = shared.select("id", "bucket").join(centres.filter("size > 2").select("bucket", "head"), "bucket").join(loose.select("bucket").distinct(), "bucket")
    of_centre = of_bucket.join(loose, ["bucket", "id"], "left").groupBy("id", "head").agg(F.coalesce(F.bool_or("stray"), F.lit(False)).alias("stray"))
    members = of_centre.join(relative.drop("similarity"), ["id", "head"]).join(groups, "id").withColumnRenamed("head", "centre")
    rest = stored(linked(stored(members, "members", relative.count(), _SETS_A_FILE), least), "rest")
    groups = merged(groups, rest.filter("id != head").select("id", "head"))

    links = verified[0]
    for more in verified[1:]:
        links = links.unionByName(more)
    links = links.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()
    ends = links.select(F.col("a").alias("id")).unionAll(links.select(F.col("b").alias("id")))
    # the pairs told by set join different groups, so none of them is among the others
    counted = ends.groupBy("id").agg(F.count(F.lit(1)).alias("links")).unionByName(rest.select("id", "links"))
    return groups, counted.groupBy("id").agg(F.sum("links").alias("links"))


def keep_first(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group, all columns as they were: that with the smallest doc_id, one without doc_id only where all are.

    Of several such rows the one whose words' digest, then whose text's digest is smallest stays.
    Rows without words are groups of their own; of those with a doc_id, equal ones stay once.
    """
    # rows of one doc_id and text are the same to everything below
    text = F.col("text").cast("string")
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), text)))))
    signed, of_class = _classes(docs, similarity, key)
    in_group = signed.filter("digest is not null").select("doc_id", "key", "digest").join(of_class.select("digest", "group"), "digest")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest", "key")
    heads = in_group.groupBy("group").agg(F.min(order).alias("_h")).select(F.col("_h.key").alias("_keep_key"), F.lit(False).alias("_keep_each"))
    wordless = signed.filter("digest is null").select(F.col("key").alias("_keep_key"), F.col("doc_id").isNull().alias("_keep_each")).distinct()
    # the row travels as one value, so its columns may have any names
    rows = docs.select(key.alias("_keep_key"), F.monotonically_increasing_id().alias("_keep_row"), F.struct("*").alias("_keep")).join(heads.unionByName(wordless), "_keep_key")
    rows = rows.withColumn("_keep_row", F.when(F.col("_keep_each"), F.col("_keep_row")).otherwise(F.lit(0)))
    return rows.dropDuplicates(["_keep_key", "_keep_row"]).select("_keep.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))
