"""Secret scans over a trigram inverted index.

Every rule is a regular expression. Its parse tree gives a Boolean query over
lower-case trigrams that each match must contain: a run of mandatory literals
gives the AND of its trigrams, alternatives give an OR. A rule without mandatory
trigrams has the query "any" and scans every text.

Texts are indexed by segment, a block of rows of one task: the postings of a
trigram are the sorted rows of the segment that contain it. Only trigrams that
some rule asks for get postings. A query is evaluated by intersecting and
merging postings, and the expression itself runs over the candidate texts
alone. No posting list crosses a task, so a trigram that all texts share costs
no more than a scan of those texts, and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import as_binary, read_table, release_memory, text_blocks, text_column


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    fold: bool = False


# fixed values: the three base rules of the contract, in their order
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
# rules added by this operator
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,80}:[^\s:/@]{3,80}@"),
)
RULES = BASE_RULES + MORE_RULES

ANY = ("any",)
# alternatives kept apart while literals grow; beyond it the literals so far become a query
_MAX_STRINGS = 64


def _all(*parts):
    parts = [p for p in parts if p != ANY]
    return parts[0] if len(parts) == 1 else ("and", *parts) if parts else ANY


def _some(parts):
    # an alternative that asks for all that another asks for adds nothing
    parts = sorted(set(parts))
    parts = [p for p in parts if not any(q != p and _asked_all(q) < _asked_all(p) for q in parts)]
    return ANY if ANY in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _asked_all(query) -> frozenset:
    """The trigrams of an AND; of anything else only itself, so that it compares with nothing."""
    parts = query[1:] if query[0] == "and" else (query,)
    return frozenset(p if p[0] == "has" else query for p in parts)


def _trigrams(text: str):
    data = text.lower().encode()
    return _all(*dict.fromkeys(("has", data[i : i + 3]) for i in range(len(data) - 2)))


def trigram_query(pattern: str) -> tuple:
    """The Boolean query of a regular expression: ("any",), ("has", trigram), ("and", ...), ("or", ...).

    Every text with a match satisfies it: literals count in lower case, classes
    of up to eight characters are tried out, all else breaks a run of literals.
    """

    def walk(items) -> tuple:
        done, runs = [], {""}  # queries so far; the strings that the current run may be

        def flush():
            nonlocal runs
            done.append(_some([_trigrams(r) for r in runs]))
            runs = {""}

        def extend(options):
            nonlocal runs
            if len(runs) * len(options) > _MAX_STRINGS:
                flush()
            runs = {a + b for a in runs for b in options}

        for op, arg in items:
            if op is rc.LITERAL:
                extend({chr(arg).lower()})
            elif op is rc.IN and (chars := _few(arg)):
                extend(chars)
            elif op is rc.SUBPATTERN and (options := _strings(arg[3])):
                extend(options)
            elif op is rc.BRANCH and (options := _strings([(op, arg)])):
                extend(options)
            elif op is rc.BRANCH:
                flush()
                done.append(_some([walk(branch) for branch in arg[1]]))
            elif op is rc.SUBPATTERN:
                flush()
                done.append(walk(arg[3]))
            elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
                low, high, body = arg
                options = _strings(body)
                if options and (low, high) == (0, 1):
                    extend(options | {""})
                elif options and low == high and low <= 40 and len(options) == 1:
                    extend({next(iter(options)) * low})
                else:
                    if options and len(options) == 1 and 0 < low <= 40:
                        extend({next(iter(options)) * low})
                    flush()
                    if low:
                        done.append(walk(body))
            elif op is not rc.AT:
                flush()
        flush()
        return _all(*dict.fromkeys(done))

    def _few(items) -> set | None:
        out = set()
        for op, arg in items:
            if op is rc.LITERAL:
                out.add(chr(arg).lower())
            elif op is rc.RANGE and arg[1] - arg[0] < 8:
                out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
            else:
                return None
        return out if 0 < len(out) <= 8 else None

    def _strings(items) -> set | None:
        """All strings that a part without repeats may be, if they are few."""
        out = {""}
        for op, arg in items:
            if op is rc.LITERAL:
                step = {chr(arg).lower()}
            elif op is rc.IN:
                step = _few(arg)
            elif op is rc.SUBPATTERN:
                step = _strings(arg[3])
            elif op is rc.BRANCH:
                parts = [_strings(b) for b in arg[1]]
                step = None if None in parts else set().union(*parts)
            elif op is rc.MAX_REPEAT and arg[:2] == (0, 1):
                step = _strings(arg[2])
                step = None if step is None else step | {""}
            else:
                return None
            if step is None or len(out) * len(step) > _MAX_STRINGS:
                return None
            out = {a + b for a in out for b in step}
        return out

    return walk(list(rp.parse(pattern)))


def _asked(query: tuple) -> set[bytes]:
    if query[0] == "has":
        return {query[1]}
    return set().union(*(_asked(q) for q in query[1:])) if query[0] in ("and", "or") else set()


class SecretScanner:
    """The compiled rules, their trigram queries, and the scan of an index segment."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        # re.ASCII: a letter folds to its own other case only
        self._compiled = [re.compile(r.pattern, re.ASCII | re.IGNORECASE * r.fold) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        asked = sorted(set().union(*map(_asked, self.queries)))
        self._number = {t: k for k, t in enumerate(asked)}
        self._slot = np.zeros(1 << 24, np.uint16)
        for t, k in self._number.items():
            self._slot[int.from_bytes(t, "big")] = k + 1
        self._lower = np.arange(256, dtype=np.uint32)
        self._lower[65:91] += 32

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[bytes, np.ndarray]:
        """Of each asked trigram the ascending rows that contain it."""
        low = self._lower[data]
        if len(low) < 3:
            return {}
        found = self._slot[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        at = np.flatnonzero(found)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[row + 1]
        pairs = np.unique(found[at[inside]].astype(np.int64) * len(offsets) + row[inside])
        number, row = np.divmod(pairs, len(offsets))
        cuts = np.searchsorted(number, np.arange(len(self._number) + 2))
        return {t: row[cuts[k + 1] : cuts[k + 2]] for t, k in self._number.items()}

    def candidates(self, query: tuple, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        if query == ANY:
            return np.arange(n)
        if query[0] == "has":
            return postings.get(query[1], np.zeros(0, np.int64))
        parts = [self.candidates(q, postings, n) for q in query[1:]]
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        out = min(parts, key=len)
        for p in parts:
            if p is not out:
                out = np.intersect1d(out, p, assume_unique=True)
        return out

    def matches(self, k: int, text: str) -> list[tuple[int, int]]:
        """Spans of rule k, leftmost and non-overlapping, in code points."""
        rule = self.rules[k]
        return [m.span() for m in self._compiled[k].finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]

    def scan(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """Per text (start, rule number, end) in order of start, then rule."""
        data, offsets = as_binary(texts)
        out: list[list] = [[] for _ in range(len(texts))]
        for a, b in text_blocks(offsets):
            inner = offsets[a : b + 1] - offsets[a]
            postings = self.postings(data[offsets[a] : offsets[b]], inner)
            strings: dict[int, str] = {}
            for k, query in enumerate(self.queries):
                for row in self.candidates(query, postings, b - a).tolist():
                    if row not in strings:
                        strings[row] = texts[a + row].as_py() or ""
                    out[a + row] += [(s, k, e) for s, e in self.matches(k, strings[row])]
        for found in out:
            found.sort()
        return out


def _joined(rules, found) -> str:
    return ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in found)


def secret_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Per text an array of structs (kind, start, end): code points, ``end`` exclusive.

    NULL and empty texts give an empty array. Spans of different kinds may overlap.
    """

    @F.arrow_udf("array<struct<kind string, start int, end int>>")
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = SecretScanner(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for texts in batches:
            yield pa.array([[(rules[k].kind, s, e) for s, k, e in found] for found in scanner.scan(texts)], kind)

    return spans(F.coalesce(text.cast("string"), F.lit("")))


def secret_report(text: Column) -> Column:
    """Per text a struct: count of each base kind, digest of the base spans, all spans as text."""

    @F.arrow_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_more long")
    def report(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = SecretScanner(RULES)
        base = len(BASE_RULES)
        for texts in batches:
            rows = []
            for found in scanner.scan(texts):
                own = [x for x in found if x[1] < base]
                n = np.bincount([k for _, k, _ in own], minlength=base).tolist()
                digest = hashlib.sha256(_joined(RULES, own).encode()).hexdigest()
                rows.append((*n, digest, _joined(RULES, found), len(found) - len(own)))
            yield pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()])],
                names=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_more"],
            )

    return report(F.coalesce(text.cast("string"), F.lit("")))


def redact(text: Column, mark: str = "[SECRET]", rules: tuple[Rule, ...] = RULES) -> Column:
    """The text with every found span replaced by ``mark`` (overlapping spans by one); NULL stays NULL.

    A block of texts is worked on, handed out and forgotten before the next one.
    """

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = SecretScanner(rules)
        for texts in batches:
            for a, b in text_blocks(as_binary(texts)[1]):
                some, out = texts.slice(a, b - a), []
                for value, found in zip(some.to_pylist(), scanner.scan(some), strict=True):
                    if found:
                        parts, at = [], 0
                        for s, _, e in found:
                            if e <= at:
                                continue
                            if s >= at:
                                parts += [value[at:s], mark]
                            at = e
                        value = "".join([*parts, value[at:]])
                    out.append(value)
                redacted = pa.array(out, pa.string())
                del out
                yield redacted
                release_memory()

    return clean(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", secret_report(text_column()).alias("_r")).select("doc_id", "_r.*")
