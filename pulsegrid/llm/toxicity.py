"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its own embedding (words known from training) beside the mean
embedding of its character trigrams (any word). Two gated recurrent units read a
window of words in either direction; attention weights pool their states, and a
linear layer gives the window's logit. Windows of ``WINDOW`` words start every
``STRIDE`` words, so they overlap by half, and all windows of a text are scored; the text's
score is that of its most toxic window.

The network is fitted on the driver from a bounded sample of labelled rows
(``TRAINING_ROWS``). A label belongs to a whole text, so each pass picks the
window that the present network finds most toxic, in toxic and in clean texts,
and learns the text's label there. Embeddings start from class log-count ratios.
Scoring is vectorised over the windows of a block of whole texts in Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import BLOCK_BYTES, Tokens, as_binary, ranges, read_table, release_memory, segment_ids, text_blocks, text_column
from pulsegrid.llm.labelled import fold, training_rows

TRAINING_ROWS = 4000
WINDOW, STRIDE = 32, 16
HIDDEN, WORD_SIZE, CHAR_SIZE, CHAR_BUCKETS = 8, 8, 8, 1 << 14
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
# windows that one pass of the network takes together
_CHUNK = 8192
_F = np.float32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * _F(0.5)) * _F(0.5) + _F(0.5)


def _add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """out[at[i]] += rows[i] for every i, repeats included."""
    order = np.argsort(at, kind="stable")
    where = at[order]
    cuts = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
    out[where[cuts]] += np.add.reduceat(rows[order], cuts, axis=0)
    return out


@dataclass
class Block:
    """The words of a block of texts: distinct words with their trigrams, and the windows over them."""

    hashes: np.ndarray  # of the distinct words, ascending
    grams: np.ndarray  # trigram buckets of the distinct words, concatenated
    sizes: np.ndarray  # trigrams of each distinct word
    words: np.ndarray  # distinct word number of each word
    counts: np.ndarray  # words of each text
    start: np.ndarray  # first word of each window
    length: np.ndarray  # its words
    text: np.ndarray  # its text


def read_block(data: np.ndarray, offsets: np.ndarray) -> Block:
    tokens = Tokens(data, offsets)
    hashes, first, words = np.unique(tokens.hash, return_index=True, return_inverse=True)
    size = (tokens.end - tokens.start)[first]
    begin = tokens.start[first]
    at = ranges(begin, size)
    low = tokens.lower.astype(np.uint32)
    before = np.where(at == np.repeat(begin, size), 60, low[at - 1]) if len(at) else low[:0]
    after = np.where(at == np.repeat(begin + size - 1, size), 62, low[np.minimum(at + 1, len(low) - 1)]) if len(at) else low[:0]
    code = ((before << 16) | (low[at] << 8) | after).astype(np.uint32)
    grams = ((code * np.uint32(2654435761)) >> np.uint32(32 - CHAR_BUCKETS.bit_length() + 1)).astype(np.int32)
    # windows start every STRIDE words until one reaches the end of the text
    n = np.where(tokens.count > 0, np.maximum(0, -(-(tokens.count - WINDOW) // STRIDE)) + 1, 0)
    text = segment_ids(n)
    step = (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    start = (np.cumsum(tokens.count) - tokens.count)[text] + step
    return Block(hashes, grams, size, words, tokens.count, start, np.minimum(tokens.count[text] - step, WINDOW), text)


def _blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Block]]:
    data, offsets = as_binary(texts)
    for a, b in text_blocks(offsets, limit):
        yield a, b, read_block(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


class ToxicityModel:
    """The network: ``vocabulary`` (ascending word hashes) and the arrays of ``p``.

    ``word`` (one row a known word, then a row for all others) and ``char`` are the
    embeddings; ``wf, uf, bf, cf`` and ``wb, ub, bb, cb`` the two recurrent units with
    update, reset and candidate gates side by side; ``aw, av`` the attention;
    ``ow, ob`` the output.
    """

    def __init__(self, vocabulary: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        size, h = WORD_SIZE + CHAR_SIZE, HIDDEN
        self.vocabulary = vocabulary
        self.p = {
            "word": rng.normal(0, 0.05, (len(vocabulary) + 1, WORD_SIZE)), "char": rng.normal(0, 0.05, (CHAR_BUCKETS, CHAR_SIZE)),
            **{f"w{d}": rng.normal(0, 0.3, (size, 3 * h)) for d in "fb"}, **{f"u{d}": rng.normal(0, 0.25, (h, 3 * h)) for d in "fb"},
            **{f"b{d}": np.zeros(3 * h) for d in "fb"}, **{f"c{d}": np.zeros(h) for d in "fb"},
            "aw": rng.normal(0, 0.3, (2 * h, h)), "av": rng.normal(0, 0.3, h), "ow": rng.normal(0, 0.3, 2 * h), "ob": np.array([-2.0]),
        }
        self.p = {k: v.astype(_F) for k, v in self.p.items()}

    def inputs(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Row of ``word`` and input vector of each distinct word of a block."""
        known = len(self.vocabulary)
        at = np.searchsorted(self.vocabulary, block.hashes)
        hit = at < known
        hit[hit] = self.vocabulary[at[hit]] == block.hashes[hit]
        at = np.where(hit, at, known)
        vectors = np.empty((len(at), WORD_SIZE + CHAR_SIZE), _F)
        ends = np.cumsum(block.sizes)
        # some words at a time: their trigrams' rows take far more room than the words' own
        for a in range(0, len(at), _CHUNK):
            size, end = block.sizes[a : a + _CHUNK], ends[a : a + _CHUNK]
            begin = end - size
            sums = np.add.reduceat(self.p["char"][block.grams[begin[0] : end[-1]]], begin - begin[0], axis=0)
            vectors[a : a + _CHUNK, :WORD_SIZE] = self.p["word"][at[a : a + _CHUNK]]
            vectors[a : a + _CHUNK, WORD_SIZE:] = sums / size[:, None].astype(_F)
        return at, vectors

    def _recur(self, d: str, gates: np.ndarray, idx: np.ndarray, mask: np.ndarray | None, keep: bool):
        """States of one direction over windows ``idx`` (words by window); with ``keep`` also all gates."""
        h, steps, n = HIDDEN, idx.shape[0], idx.shape[1]
        u_zr, u_n, c = self.p[f"u{d}"][:, : 2 * h], self.p[f"u{d}"][:, 2 * h :], self.p[f"c{d}"]
        state, states, kept = np.zeros((n, h), _F), np.empty((steps, n, h), _F), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            x = gates[idx[t]]
            zr = _sigmoid(x[:, : 2 * h] + state @ u_zr)
            z, r = zr[:, :h], zr[:, h:]
            inner = state @ u_n + c
            new = np.tanh(x[:, 2 * h :] + r * inner)
            after = new + z * (state - new)
            if mask is not None:
                after = np.where(mask[t][:, None], after, state)
            if keep:
                kept.append((t, state, z, r, inner, new))
            state = states[t] = after
        return states, kept

    def gates(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        """What each distinct word adds to the gates of either direction."""
        out = {d: vectors @ self.p[f"w{d}"] for d in "fb"}
        for d, gates in out.items():
            gates += self.p[f"b{d}"]
        return out

    def forward(self, gates: dict[str, np.ndarray], idx: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        (sf, kf), (sb, kb) = (self._recur(d, gates[d], idx, mask, keep) for d in "fb")
        states = np.concatenate([sf, sb], axis=2)
        hidden = np.tanh(states @ self.p["aw"])
        weight = hidden @ self.p["av"]
        if mask is not None:
            weight = np.where(mask, weight, _F(-1e9))
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logit = pooled @ self.p["ow"] + self.p["ob"][0]
        return (logit, (idx, mask, kf, kb, states, hidden, weight, pooled)) if keep else logit

    def backward(self, vectors: np.ndarray, cache: tuple, d_logit: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of all parameters but the embeddings, and of the input vectors."""
        idx, mask, kf, kb, states, hidden, weight, pooled = cache
        p, h = self.p, HIDDEN
        g = {"ow": pooled.T @ d_logit, "ob": np.array([d_logit.sum()])}
        d_pooled = d_logit[:, None] * p["ow"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["av"] = np.einsum("tn,tnk->k", d_score, hidden)
        d_hidden = d_score[:, :, None] * p["av"] * (1 - hidden**2)
        g["aw"] = np.einsum("tnh,tnk->hk", states, d_hidden)
        d_states = d_states + d_hidden @ p["aw"].T
        d_vectors = np.zeros_like(vectors)
        for d, kept, part in (("f", kf, slice(0, h)), ("b", kb, slice(h, 2 * h))):
            u, gw, gu = p[f"u{d}"], np.zeros_like(p[f"w{d}"]), np.zeros_like(p[f"u{d}"])
            gb, gc, carry = np.zeros(3 * h, _F), np.zeros(h, _F), np.zeros_like(d_states[0][:, part])
            d_inputs = np.zeros((*idx.shape, vectors.shape[1]), _F)
            for t, before, z, r, inner, new in reversed(kept):
                total = carry + d_states[t][:, part]
                passed = 0
                if mask is not None:
                    on = mask[t][:, None]
                    passed, total = np.where(on, 0, total), np.where(on, total, 0)
                d_new = total * (1 - z) * (1 - new**2)
                d_z = total * (before - new) * z * (1 - z)
                d_inner = d_new * r
                d_r = d_new * inner * r * (1 - r)
                d_gate = np.concatenate([d_z, d_r, d_new], axis=1)
                d_rec = np.concatenate([d_z, d_r, d_inner], axis=1)
                gu += before.T @ d_rec
                gb += d_gate.sum(axis=0)
                gc += d_inner.sum(axis=0)
                x = vectors[idx[t]]
                gw += x.T @ d_gate
                d_inputs[t] = d_gate @ p[f"w{d}"].T
                carry = total * z + d_rec @ u.T + passed
            _add_rows(d_vectors, idx.ravel(), d_inputs.reshape(-1, vectors.shape[1]))
            g |= {f"w{d}": gw, f"u{d}": gu, f"b{d}": gb, f"c{d}": gc}
        return g, d_vectors

    def window_logits(self, block: Block, vectors: np.ndarray) -> np.ndarray:
        """Logit of every window of a block: full windows without a mask, the rest with one."""
        out, gates = np.empty(len(block.start), _F), self.gates(vectors)
        full = block.length == WINDOW
        for rows, masked in ((np.flatnonzero(full), False), (np.flatnonzero(~full), True)):
            for a in range(0, len(rows), _CHUNK):
                some = rows[a : a + _CHUNK]
                idx, mask = _window_words(block, some, masked)
                out[some] = self.forward(gates, idx, mask)
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        """Score of each text; 0 where a text has no words."""
        out = np.zeros(len(texts))
        for a, _, block in _blocks(texts):
            if len(block.start):
                logits = self.window_logits(block, self.inputs(block)[1])
                has = np.flatnonzero(block.counts)
                best = np.maximum.reduceat(logits, np.searchsorted(block.text, has)).astype(np.float64)
                out[a + has] = 1 / (1 + np.exp(-best))
        return out


def _window_words(block: Block, rows: np.ndarray, masked: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Word numbers by (step, window), and which of them are words."""
    steps = np.arange(WINDOW)[:, None]
    if not masked:
        return block.words[block.start[rows] + steps], None
    mask = steps < block.length[rows]
    return block.words[np.where(mask, block.start[rows] + steps, block.start[rows])], mask


def _merge(blocks: list[Block]) -> Block:
    """One block of several, over the union of their words."""
    hashes, first, inverse = np.unique(np.concatenate([b.hashes for b in blocks]), return_index=True, return_inverse=True)
    sizes = np.concatenate([b.sizes for b in blocks])
    starts = np.cumsum(sizes) - sizes
    grams = np.concatenate([b.grams for b in blocks])[ranges(starts[first], sizes[first])]
    kinds = np.cumsum([0, *(len(b.hashes) for b in blocks)])
    words = np.concatenate([inverse[k + b.words] for k, b in zip(kinds, blocks, strict=False)])
    n_words = np.cumsum([0, *(len(b.words) for b in blocks)])
    n_texts = np.cumsum([0, *(len(b.counts) for b in blocks)])
    return Block(
        hashes, grams, sizes[first], words, np.concatenate([b.counts for b in blocks]),
        np.concatenate([b.start + k for k, b in zip(n_words, blocks, strict=False)]), np.concatenate([b.length for b in blocks]),
        np.concatenate([b.text + k for k, b in zip(n_texts, blocks, strict=False)]),
    )


def _log_ratio(block: Block, kinds: np.ndarray, sizes: np.ndarray, label: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Log ratio of class document shares of each kind, and its number of documents.

    ``kinds``: those of each distinct word, concatenated, ``sizes`` of them. Texts are taken some at a time.
    """
    ones, zeros = np.zeros(width), np.zeros(width)
    first = np.cumsum(sizes) - sizes
    ends = np.cumsum(block.counts)
    for t, (a, b) in enumerate(zip((ends - block.counts).tolist(), ends.tolist(), strict=True)):
        words = np.unique(block.words[a:b])
        (ones if label[t] == 1 else zeros)[np.unique(kinds[ranges(first[words], sizes[words])])] += 1
    ratio = np.log((ones + 0.5) / (label.sum() + 1)) - np.log((zeros + 0.5) / (len(label) - label.sum() + 1))
    return ratio, ones + zeros


def fit(rows: pa.Table, passes: int = 10, batch: int = 256, rate: float = 0.02, seed: int = 11) -> ToxicityModel:
    """Fit to a table (label, text). Without both classes the output layer alone is set to the known share."""
    label = rows["label"].to_numpy()
    if len(label) == 0 or label.min() == label.max():
        model = ToxicityModel(np.zeros(0, np.uint64))
        share = (float(label.sum()) + 1) / (len(label) + 2)
        model.p["ow"][:], model.p["ob"][0] = 0, np.log(share / (1 - share))
        return model
    # the driver reads few bytes at a time and gives back what each step leaves: its memory is small
    block = _merge([b for _, _, b in _blocks(rows["text"].combine_chunks(), BLOCK_BYTES >> 3)])
    release_memory()
    n_words = len(block.hashes)
    ratio, seen = _log_ratio(block, np.arange(n_words), np.ones(n_words, np.int64), label, n_words)
    known = np.flatnonzero(seen >= 4)
    model = ToxicityModel(block.hashes[known], seed)
    model.p["word"][:-1, 0] += np.clip(ratio[known], -3, 5) / 2
    # trigrams start from the documents that hold them
    first = np.cumsum(block.sizes) - block.sizes
    chars, held = _log_ratio(block, block.grams, block.sizes, label, CHAR_BUCKETS)
    model.p["char"][held >= 4, 0] += np.clip(chars[held >= 4], -3, 5) / 2
    rng = np.random.default_rng(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    has = np.flatnonzero(block.counts)
    cuts = np.searchsorted(block.text, np.arange(len(block.counts) + 1))
    share = label[has].mean()
    balance = np.where(label == 1, min(0.35 / share, 4.0), 1.0)
    step = 0
    for turn in range(passes):
        at, vectors = model.inputs(block)
        if turn == 0:  # the suspicion of a window before training: its most telling word or trigrams
            word_score = np.clip(ratio, -3, 5) * (seen >= 4) + vectors[:, WORD_SIZE]
            logits = np.array([word_score[block.words[s : s + n]].max() for s, n in zip(block.start, block.length, strict=True)])
        else:
            logits = model.window_logits(block, vectors)
        del at, vectors
        release_memory()
        logits = logits + rng.normal(0, 1e-4, len(logits))
        chosen = [cuts[t] + int(np.argmax(logits[cuts[t] : cuts[t + 1]])) for t in has]
        clean = has[label[has] != 1]
        # a second window of each clean text, drawn at random
        extra = cuts[clean] + (rng.random(len(clean)) * (cuts[clean + 1] - cuts[clean])).astype(np.int64)
        windows = rng.permutation(np.concatenate([chosen, extra]))
        for a in range(0, len(windows), batch):
            some = windows[a : a + batch]
            idx, mask = _window_words(block, some, True)
            used, idx = np.unique(idx, return_inverse=True)
            idx = idx.reshape(mask.shape)
            part = Block(block.hashes[used], block.grams[ranges(first[used], block.sizes[used])], block.sizes[used], *[np.zeros(0, np.int64)] * 5)
            at, vectors = model.inputs(part)
            logit, cache = model.forward(model.gates(vectors), idx, mask, keep=True)
            y = label[block.text[some]]
            d_logit = ((1 / (1 + np.exp(-logit)) - y) * balance[block.text[some]] / len(some)).astype(_F)
            grads, d_vectors = model.backward(vectors, cache, d_logit)
            grads["word"] = _add_rows(np.zeros_like(model.p["word"]), at, d_vectors[:, :WORD_SIZE])
            d_chars = np.repeat(d_vectors[:, WORD_SIZE:] / part.sizes[:, None].astype(_F), part.sizes, axis=0)
            grads["char"] = _add_rows(np.zeros_like(model.p["char"]), part.grams, d_chars)
            step += 1
            pace = rate * min(1.0, 2 * (1 - turn / passes))
            for k, grad in grads.items():
                m, v = moment[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                model.p[k] -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)).astype(_F)
    return model


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score of each whole text; an empty or NULL text, or one without words, scores 0."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            scores = pa.array(model.score(texts), pa.float64())
            release_memory()
            yield scores

    return score(F.coalesce(text.cast("string"), F.lit("")))


def train(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """The fitted network; the driver holds nothing else of the training afterwards."""
    model = fit(training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, TRAINING_ROWS))
    release_memory()
    return model


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity_score(text_column(), model).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
