"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Word counts over the whole corpus (of the words that the benchmark holds) give
each word its probability. A run of ``SEED`` words of a test item is a seed if the
product of its words' probabilities is at most ``RARE``; an item's ``LEAST`` rarest
runs are seeds in any case. Rarity is judged from single words on purpose: a
passage that has leaked into many documents has frequent n-grams, and must still
be found.

A pass over the texts joins them to the seeds: each shared n-gram proposes a
stretch of the text where the item might stand, and a local alignment of the
item's words with that stretch scores it. The score is the alignment's as a share of
that of a verbatim copy, so edits and paraphrases lower it gradually; pairs from
``THRESHOLD`` on are reported.

The benchmark goes to the tasks as arrays. Its size is checked: beyond
``MOST_WORDS`` words it is worked off in parts of that size, one pass each. Texts
are never shuffled, and the work of a text follows its length.

NULL and empty texts or items, and items without words, match nothing. An item
of fewer words than a seed is looked up as it is, among the runs of its own length: it
matches every text that holds its words in a row. Repeated rows are reported once each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import Tokens, as_binary, ranges, read_table, release_memory, segment_ids, shingles, text_blocks, text_column

SEED, RARE, LEAST = 3, 1e-9, 8
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
# words of test items that one pass works with (8 bytes each in every task)
MOST_WORDS = 2_000_000
# cells of one alignment batch
_CELLS = 1 << 20


@dataclass
class Benchmark:
    """Test items as word hashes, and their seeds: ``seed`` ascending, with item and place of each."""

    ids: list
    words: list[np.ndarray]
    seed: np.ndarray
    item: np.ndarray
    place: np.ndarray


def _tokens(texts: pa.Array) -> Tokens:
    return Tokens(*as_binary(texts))


def word_counts(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """Occurrences in all texts of each word of ``vocabulary`` (ascending hashes), and the number of all words.

    The rows that come to the driver are as many as the vocabulary has words.
    """
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            data, offsets = as_binary(batch.column(0))
            for a, b in text_blocks(offsets):
                found = Tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]).hash
                at = np.minimum(np.searchsorted(vocabulary, found), size - 1)
                total[:size] += np.bincount(at[vocabulary[at] == found], minlength=size)
                total[size] += len(found)
            release_memory()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["word", "n"])

    rows = docs.select(text_column()).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size + 1, np.int64)
    for r in rows:
        out[r["word"]] = r["n"]
    return out[:size], int(out[size])


def index(docs: DataFrame, items: pa.Table) -> Benchmark | None:
    """The seeds of some test items (item_id, text); None where no item has a word."""
    tokens = _tokens(items["text"].combine_chunks())
    cuts = np.concatenate(([0], np.cumsum(tokens.count)))
    words = [tokens.hash[cuts[i] : cuts[i + 1]] for i in range(len(items))]
    if not len(tokens.hash):
        return None
    vocabulary = np.unique(tokens.hash)
    counts, total = word_counts(docs, vocabulary)
    log_p = np.log((counts + 1) / (total + 1))
    seeds, items_of, places = [], [], []
    for i, w in enumerate(words):
        if not len(w):
            continue
        runs, _ = shingles(w, np.array([len(w)]), SEED)
        p = log_p[np.searchsorted(vocabulary, w)]
        weight = np.array([p[k : k + SEED].sum() for k in range(len(runs))])
        keep = weight <= np.log(RARE)
        keep[np.argsort(weight, kind="stable")[:LEAST]] = True
        seeds.append(runs[keep])
        places.append(np.flatnonzero(keep))
        items_of.append(np.full(int(keep.sum()), i))
    seed = np.concatenate(seeds)
    order = np.argsort(seed, kind="stable")
    return Benchmark(items["item_id"].to_pylist(), words, seed[order], np.concatenate(items_of)[order], np.concatenate(places)[order])


def align(items: list[np.ndarray], stretches: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman of each item with its stretch: best score, and where it ends in either (exclusive)."""
    n = len(items)
    rows, width = max(map(len, items)), max(map(len, stretches))
    pad = lambda arrays, size, fill: np.stack([np.pad(x.view(np.int64), (0, size - len(x)), constant_values=fill) for x in arrays])
    a, b = pad(items, rows, 0), pad(stretches, width, 0)
    a_in = np.arange(rows) < np.array([len(x) for x in items])[:, None]
    b_in = np.arange(width) < np.array([len(x) for x in stretches])[:, None]
    ramp = np.arange(width + 1, dtype=np.int32) * -GAP
    before = np.zeros((n, width + 1), np.int32)
    best, row, column = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(rows):
        same = (a[:, i, None] == b) & b_in & a_in[:, i, None]
        now = np.zeros((n, width + 1), np.int32)
        now[:, 1:] = np.maximum(before[:, :-1] + np.where(same, MATCH, MISMATCH), before[:, 1:] + GAP)
        np.maximum(now, 0, out=now)
        # gaps along the stretch: the best start so far, less one gap for each step from it
        now = np.maximum.accumulate(now + ramp, axis=1) - ramp
        at = now.argmax(axis=1)
        top = now[np.arange(n), at]
        better = top > best
        best[better], row[better], column[better] = top[better], i + 1, at[better]
        before = now
    return best, row, column


def _short_items(bench: Benchmark) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(words, hashes ascending, item of each) of the items with fewer words than a seed."""
    out = []
    for size in range(1, SEED):
        items = np.array([i for i, w in enumerate(bench.words) if len(w) == size], np.int64)
        if len(items):
            runs, _ = shingles(np.concatenate([bench.words[i] for i in items]), np.full(len(items), size), size)
            order = np.argsort(runs, kind="stable")
            out.append((size, runs[order], items[order]))
    return out


def find(texts: pa.Array, bench: Benchmark, threshold: float) -> list[dict[int, tuple]]:
    """Per text the items found: item number -> (score, first word, end word)."""
    data, offsets = as_binary(texts)
    out: list[dict[int, tuple]] = [{} for _ in range(len(texts))]
    sizes = np.array([len(w) for w in bench.words])
    short = _short_items(bench) if threshold <= 1 else []
    for a, b in text_blocks(offsets):
        tokens = Tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        for size, seeds, items in short:
            runs, n_runs = shingles(tokens.hash, tokens.count, size)
            row = segment_ids(n_runs)
            low, high = np.searchsorted(seeds, runs, "left"), np.searchsorted(seeds, runs, "right")
            hit = np.flatnonzero(high > low)
            n = (high - low)[hit]
            run, item = np.repeat(hit, n), items[ranges(low[hit], n)]
            # a verbatim copy has the best score; the first one of a text counts
            _, first = np.unique(row[run] * len(sizes) + item, return_index=True)
            place = run - (np.cumsum(n_runs) - n_runs)[row[run]]
            for t, i, k in zip(row[run][first].tolist(), item[first].tolist(), place[first].tolist(), strict=True):
                out[a + t][i] = (1.0, k, k + size)
        runs, n_runs = shingles(tokens.hash, tokens.count, SEED)
        row = segment_ids(n_runs)
        low, high = np.searchsorted(bench.seed, runs, "left"), np.searchsorted(bench.seed, runs, "right")
        hit = np.flatnonzero(high > low)
        if not len(hit):
            continue
        # every hit with every place of its seed, as the stretch of the text that it proposes
        n = (high - low)[hit]
        posting = np.repeat(low[hit], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        text, item = np.repeat(row[hit], n), bench.item[posting]
        place = np.repeat((np.arange(len(runs)) - (np.cumsum(n_runs) - n_runs)[row])[hit], n) - bench.place[posting]
        length = sizes[item]
        proposed = np.unique(np.stack([text, item, place // length]), axis=1).T
        first_word = np.concatenate(([0], np.cumsum(tokens.count)))
        jobs = []
        for t, i, k in proposed.tolist():
            size = len(bench.words[i])
            slack = size // 4 + 2
            start = max(0, k * size - slack)
            end = min(int(tokens.count[t]), (k + 2) * size + slack)
            jobs.append((t, i, start, tokens.hash[first_word[t] + start : first_word[t] + end]))
        jobs.sort(key=lambda j: (len(bench.words[j[1]]), len(j[3])))
        at = 0
        while at < len(jobs):
            stop = at + 1
            while stop < len(jobs) and (stop + 1 - at) * max(len(j[3]) for j in (jobs[at], jobs[stop])) < _CELLS // 64:
                stop += 1
            part, at = jobs[at:stop], stop
            best, row_end, end = align([bench.words[j[1]] for j in part], [j[3] for j in part])
            good = [k for k, j in enumerate(part) if best[k] >= threshold * MATCH * len(bench.words[j[1]]) and best[k] > 0]
            if not good:
                continue
            # backwards from its end, the alignment ends where it begins
            _, _, back = align([bench.words[part[k][1]][: row_end[k]][::-1] for k in good], [part[k][3][: end[k]][::-1] for k in good])
            for k, length_back in zip(good, back.tolist(), strict=True):
                t, i, start, _ = part[k]
                score = float(best[k]) / (MATCH * len(bench.words[i]))
                found = (score, start + int(end[k]) - length_back, start + int(end[k]))
                held = out[a + t].get(i)
                if held is None or (found[0], -found[1]) > (held[0], -held[1]):
                    out[a + t][i] = found
    return out


def leaks(text: Column, bench: Benchmark, threshold: float = THRESHOLD) -> Column:
    """Per text an array of structs (item, score, start, end): item number, first and end word of the passage."""
    kind = pa.list_(pa.struct([("item", pa.int32()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf("array<struct<item int, score double, start long, end long>>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = pa.array([[(i, *x) for i, x in sorted(f.items())] for f in find(texts, bench, threshold)], kind)
            release_memory()
            yield found

    return search(F.coalesce(text.cast("string"), F.lit("")))


def benchmarks(docs: DataFrame, items: DataFrame, most_words: int = MOST_WORDS) -> list[Benchmark]:
    """The test items with their seeds, in parts of about ``most_words`` words at most."""
    slim = items.select("item_id", text_column().alias("text"))

    # words as the search takes them: letters between commas are words as well
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch({"n": pa.array([sum(int(_tokens(b.column(0)).count.sum()) for b in batches)], pa.int64())})

    size = slim.select("text").mapInArrow(count, "n long").agg(F.sum("n").alias("n")).first()["n"] or 0
    parts = -(-int(size) // most_words) if size else 0
    out = []
    for k in range(parts):
        some = slim.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k) if parts > 1 else slim
        out.append(index(docs, some.toArrow().combine_chunks()))
    return [b for b in out if b is not None]


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (doc_id, item_id, score, start_word, end_word) of documents and test items found in them."""
    spark = docs.sparkSession
    found = None
    for bench in benchmarks(docs, items):
        ids = F.array(*[F.lit(i) for i in bench.ids]) if len(bench.ids) <= 1000 else None
        hits = docs.select("doc_id", F.explode(leaks(text_column(), bench, threshold)).alias("_m"))
        if ids is not None:
            named = hits.withColumn("item_id", F.get(ids, F.col("_m.item")))
        else:
            names = spark.createDataFrame(list(enumerate(bench.ids)), "item int, item_id long")
            named = hits.join(F.broadcast(names), F.col("_m.item") == F.col("item")).drop("item")
        part = named.select("doc_id", F.col("item_id").cast("long").alias("item_id"), "_m.score", F.col("_m.start").alias("start_word"), F.col("_m.end").alias("end_word"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, score double, start_word long, end_word long")
    return found


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents in which no test item was found, all columns as they were."""
    out = docs
    for bench in benchmarks(docs, items):
        out = out.filter(F.size(leaks(F.col("text"), bench, threshold)) == 0)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
