from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import docs_frame
from support import SF_DIRS

from pulsegrid.llm import common as C
from pulsegrid.llm import neardup as N


def plain_words(text):
    """Words as the operator defines them, for ASCII texts."""
    return "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "").lower()).split()


def plain_set(text):
    w = plain_words(text)
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(x, y):
    """Probability Jaccard by its definition."""
    out = 0.0
    for i in x.keys() & y.keys():
        out += 1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x.keys() | y.keys())
    return out


def brute(rows):
    """Group of each row: the smallest doc_id that chains of similar texts reach."""
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(a):
        while group[a] != a:
            a = group[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and (sets[a] == sets[b] or sum((sets[a] & sets[b]).values()) and similarity(sets[a], sets[b]) >= 0.8):
                group[root(a)] = root(b)
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(root(k), []).append(i)
    return sorted(((i, min((x for x in least[root(k)] if x is not None), default=None)) for k, (i, _) in enumerate(rows)), key=str)


def result(docs):
    return sorted(((r["doc_id"], r["group"]) for r in N.near_duplicates(docs).collect()), key=str)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def test_similarity_by_definition():
    rng = random.Random(2)
    for _ in range(40):
        x, y = (Counter(rng.randrange(30) for _ in range(rng.randrange(1, 60))) for _ in range(2))
        as_set = lambda c: (np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)]))
        assert N.probability_jaccard(as_set(x), as_set(y)) == pytest.approx(similarity(x, y), abs=1e-12)


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(4)
    for overlap in (50, 80, 95):
        row = np.repeat([0, 1], 100)
        element = np.concatenate([np.arange(100), np.arange(100 - overlap, 200 - overlap)]).astype(np.uint64)
        element = N.mix64(element + np.uint64(rng.integers(1 << 40)))
        weight = rng.integers(1, 4, 200)
        weight[100 : 100 + overlap] = weight[100 - overlap : 100]
        both = N.prob_min_hash(row, element, weight, 2, 2000)
        x, y = (Counter(dict(zip(element[row == k].tolist(), weight[row == k].tolist(), strict=True))) for k in (0, 1))
        assert (both[0] == both[1]).mean() == pytest.approx(similarity(x, y), abs=0.05)
        assert (both != 0).all()


def test_order_of_rows_does_not_matter():
    row, element = np.array([0, 0, 0, 2, 2]), N.mix64(np.arange(5, dtype=np.uint64))
    a = N.prob_min_hash(row, element, np.array([1, 5, 2, 1, 1]), 3)
    order = np.array([4, 2, 0, 3, 1])
    b = N.prob_min_hash(row[order], element[order], np.array([1, 5, 2, 1, 1])[order], 3)
    assert (a == b).all() and (a[1] == 0).all()


def test_groups_against_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(500)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    rows, base = [], text(120)
    for i in range(40):  # a large group around one text, some members alike only through others
        rows.append((i, " ".join(edited(rng, base, rng.randrange(0, 5)))))
    rows += [(100 + i, " ".join(base)) for i in range(15)]
    for i in range(60):
        one = text(rng.randrange(3, 90))
        rows += [(200 + 3 * i, " ".join(one)), (201 + 3 * i, " ".join(edited(rng, one, max(1, len(one) // 40)))), (202 + 3 * i, " ".join(text(rng.randrange(0, 9))))]
    chain = text(200)
    for i in range(8):
        chain = edited(rng, chain, 2)
        rows.append((500 - i, " ".join(chain)))
    rows += [(600, "for for for for for for for"), (601, "for for for for for for for for"), (602, "x"), (603, "X."), (600, "other words under a used id here")]
    assert result(docs_frame(spark, rows).repartition(3)) == brute(rows)


def test_edges(spark, edge_docs, no_docs):
    got = result(edge_docs)
    assert got == sorted(
        [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (7, 5), (8, 8), (9, 8), (9, 8), (None, None), (None, None), (12, 12), (13, 13)], key=str
    )
    assert N.near_duplicates(no_docs).count() == 0
    kept = N.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=str) == sorted([1, 2, 3, 4, 5, 8, None, None, 12, 13], key=str)


def test_components_on_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(1000, 1001), (1001, 1001)], "a long, b long")
    got = {r["id"]: r["group"] for r in N.components(edges, "test").collect()}
    assert got == {**{k: 0 for k in range(201)}, 1000: 1000, 1001: 1000}


def test_small_steps_are_written_in_few_files(spark, monkeypatch):
    """Each file costs processes that the executors start; 40 partitions of a few rows are a file, not 40."""
    folders, scratch = [], C.scratch
    monkeypatch.setattr(C, "scratch", lambda spark, name: folders.append(scratch(spark, name)) or folders[-1])
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join([*words[:k], f"edit{k}", *words[k + 1 :]])) for k in range(50)] + [(100 + k, f"other words of text {k} alone") for k in range(50)]
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        assert result(docs_frame(spark, rows).repartition(3)) == brute(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [len(list(Path(f.removeprefix("file:")).glob("part-*"))) for f in folders]
    # the signatures come from the table's own partitions, and the last pairs by blocks
    assert len(files) > 8 and sorted(files)[-3] <= 1 and max(files) <= 4


def test_partitions_written_together_keep_every_row(spark):
    df = spark.range(0, 1000, 1, 20).select("id", N.F.monotonically_increasing_id().alias("n"))
    for rows, files in ((1000, 4), (1, 1), (0, 1), (10**6, 20), (None, 20)):
        back = C.stored(df, "test", rows, 256)
        assert sorted(r["id"] for r in back.collect()) == list(range(1000)) and back.select("n").distinct().count() == 1000
        assert len(back.inputFiles()) == files


def test_query(spark):
    d = SF_DIRS["0.001"]
    t = pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist(), strict=True))
    assert sorted(((r["doc_id"], r["group"]) for r in N.query(spark, d).collect()), key=str) == brute(rows)


def test_one_row_of_each_group_stays(spark):
    one, two, three = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [
        (5, one), (None, one), (None, one + " more"), (3, two), (9, two + " more"), (9, three), (None, "alone here without an id"),
        (None, "alone here without an id"), (None, "Alone here, without an id!"), (None, None), (None, None), (None, ""), (11, ""), (11, ""), (12, None), (9, three), (9, three.upper()),
    ]
    kept = sorted(((r["doc_id"], (r["text"] or "").lower().replace(",", "").replace("!", "")) for r in N.keep_first(docs_frame(spark, rows)).collect()), key=str)
    assert kept == sorted([(5, one), (3, two), (9, three), (None, "alone here without an id"), (None, ""), (None, ""), (None, ""), (11, ""), (12, "")], key=str)


def links_of(sets):
    return {(i, j) for i, x in enumerate(sets) for j in range(i + 1, len(sets)) if similarity(x, sets[j]) >= 0.8}


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("weights", [1, 4])
def test_no_similar_pair_is_lost(spark, monkeypatch, seed, weights):
    """Sets around a centre, near and far, with extras of their own, shared ones and repeated shingles: every similar pair is a candidate."""
    rng = random.Random(seed)
    centre = Counter({k: rng.randint(1, weights) for k in range(60)})
    sets = [centre]
    editions = [Counter({1000 * e + k: rng.randint(1, weights) for k in range(25)}) for e in range(1, 4)]
    for i in range(90):
        x = Counter(centre)
        if i % 3:  # an edition adds the same shingles to all of its members
            x |= editions[i % 3]
        for k in rng.sample(sorted(x), rng.randrange(0, 25)):
            del x[k]
        x |= Counter({10_000 + 100 * i + k: rng.randint(1, weights) for k in range(rng.randrange(0, 20))})
        if i % 7 == 0:  # twice the weight is the same set to the measure
            x = Counter({k: 2 * v for k, v in x.items()})
        sets.append(x)
    rows = []
    for i, x in enumerate(sets):
        e = np.array(sorted(x), "<u4")
        w = np.array([x[k] for k in sorted(x)], "<u4")
        rows.append((i, e.tobytes(), b"" if (w == 1).all() else w.tobytes()))
    frame = spark.createDataFrame(rows, "id long, elements binary, weights binary")
    pairs = spark.createDataFrame([(i, 0) for i in range(1, len(sets))], "id long, head long")
    found = N.compared(pairs, frame)
    for r in found.collect():
        assert r["similarity"] == pytest.approx(similarity(sets[r["id"]], centre), abs=1e-12)
        own = sets[r["id"]].keys() - centre.keys()
        assert set(r["extras"]) == own and set(r["lacks"]) == centre.keys() - sets[r["id"]].keys() and r["extra"] == pytest.approx(sum(sets[r["id"]][k] for k in own) / r["total"]) and r["missing"] == len(r["lacks"])
    members = found.drop("similarity").withColumnRenamed("head", "centre").selectExpr("*", "id as group", "true as stray")
    got = {(r["id"], r["head"]) for r in N.candidates(members, N.may_differ(0.8)).collect()}
    want = {p for p in links_of(sets) if p[0]}
    assert want and want <= got and len(got) < (1.5 * len(want) + 10 if weights == 1 else len(sets) * (len(sets) - 1) // 4)
    # many blocks give the same pairs
    monkeypatch.setattr(N, "_DEALT", 7)
    assert {(r["id"], r["head"]) for r in N.candidates(members, N.may_differ(0.8)).collect()} == got


def test_edited_copies_meet_few_others(spark):
    """Copies that differ by their own edits are not met in pairs, nor are those of one edition."""
    rng = random.Random(4)
    members = []
    for i in range(600):
        extras = [5000 + 100 * i + k for k in range(30)] + list(range(900, 930)) * (i % 2)
        lacks = rng.sample(range(120), rng.randrange(25, 35))
        total = 120 - len(lacks) + len(extras)
        members.append((0, i + 1, i + 1, True, len(extras) / total, len(lacks), total, 1, extras, lacks))
    frame = spark.createDataFrame(members, "centre long, id long, group long, stray boolean, extra double, missing int, total long, top int, extras array<int>, lacks array<int>")
    assert N.candidates(frame, N.may_differ(0.8)).count() == 0


def test_overlaps(monkeypatch):
    rng = np.random.default_rng(6)
    lists = [[sorted(rng.choice(50, rng.integers(0, 20), replace=False).tolist()) for _ in range(n)] for n in (7, 5)]
    monkeypatch.setattr(N, "_COLUMNS", 6)
    got = N.overlaps(*(pa.array(x, pa.list_(pa.int32())) for x in lists))
    assert got.tolist() == [[len(set(a) & set(b)) for b in lists[1]] for a in lists[0]]
    assert N.overlaps(pa.array([[]], pa.list_(pa.int32())), pa.array([[1], []], pa.list_(pa.int32()))).tolist() == [[0, 0]]


def test_keep_first_leaves_columns_of_any_name(spark):
    rows = [(1, "one two three four five six", 7, "k", 1.5), (2, "one two three four five six", 8, "m", 2.5), (3, None, 9, "n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _keep_row int, _keep_key string, `a.b` double")
    kept = N.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [rows[0], rows[2]]


def members_at(spark, sets, centres, strays):
    """Rows for ``linked``: every set of ``sets`` against each centre, each a group of its own, ``strays`` (centre, id) as told."""
    rows = []
    for i, x in [*enumerate(sets), *centres.items()]:
        w = np.array([x[k] for k in sorted(x)], "<u4")
        rows.append((i, np.array(sorted(x), "<u4").tobytes(), b"" if (w == 1).all() else w.tobytes()))
    frame = spark.createDataFrame(rows, "id long, elements binary, weights binary")
    pairs = spark.createDataFrame([(i, c) for i in range(len(sets)) for c in centres], "id long, head long")
    stray = spark.createDataFrame([(c, i, (c, i) in strays) for c in centres for i in range(len(sets))], "centre long, id long, stray boolean")
    return N.compared(pairs, frame).drop("similarity").withColumnRenamed("head", "centre").withColumn("group", N.F.col("id")).join(stray, ["centre", "id"])


@pytest.mark.parametrize("weights", [1, 4])
def test_links_of_a_crowd_come_out_by_set(spark, monkeypatch, weights):
    """Hundreds of sets far from their centres and near each other: a row a set and task, not a row a pair; each pair counts once."""
    rng = random.Random(weights)
    sets = []
    for e in range(3):  # editions, of which each is a crowd
        edition = Counter({1000 * e + k: rng.randint(1, weights) for k in range(50)}) | Counter({9000 + k: rng.randint(1, weights) for k in range(30)})
        for i in range(60):
            x = Counter(edition)
            for k in rng.sample(sorted(x), rng.randrange(0, 14)):
                del x[k]
            if i % 5 == 0 and weights > 1:
                x[rng.choice(sorted(x))] += 1
            if i % 9 == 0:
                x = Counter({k: 2 * v if weights > 1 else v for k, v in x.items()})
            sets.append(x)
    centres = {100_001: Counter({9000 + k: rng.randint(1, weights) for k in range(60)}), 100_002: Counter({9000 + k: 1 for k in range(40)})}
    strays = {(100_001, i) for i in range(len(sets)) if i % 2} | {(100_002, i) for i in range(len(sets)) if i % 3}
    arrays = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in sets]
    met = {(i, j) for j in range(len(sets)) for i in range(j) if any({(c, i), (c, j)} & strays for c in centres)}
    pairs = {(i, j) for i, j in met if N.probability_jaccard(arrays[i], arrays[j]) >= 0.8 - 1e-9}
    members = members_at(spark, sets, centres, strays).persist()
    assert len(pairs) > 2 * len(sets) * len(centres)
    for dealt in (256, 70):
        monkeypatch.setattr(N, "_DEALT", dealt)
        found = N.linked(members, 0.8 - 1e-9).collect()
        blocks = -(-len(sets) // dealt)
        assert len(found) <= len(sets) * len(centres) * blocks and len(found) < len(pairs) / 2 <= N.candidates(members, N.may_differ(0.8)).count()
        links, ends = Counter(), Counter()
        for r in found:
            links[r["id"]] += r["links"]
        for p in pairs:
            ends.update(p)
        assert +links == ends
        joined = lambda edges: {frozenset(x) for x in components_of(edges, len(sets))}
        assert joined({(r["id"], r["head"]) for r in found}) == joined(pairs)
    members.unpersist()


def components_of(edges, n):
    group = list(range(n))
    for _ in range(n):
        before = list(group)
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
        if before == group:
            break
    return [[i for i in range(n) if group[i] == g] for g in set(group)]


def test_similarity_from_differences(spark):
    """Sets of any weights, compared by how they differ from a centre, are as alike as by the definition."""
    rng = random.Random(8)
    centre = Counter({k: rng.randint(1, 3) for k in range(20)})
    sets = [Counter({k: rng.randint(1, 3) * (1 + i % 2) for k in rng.sample(range(26), rng.randint(1, 20))}) for i in range(30)]
    sets += [centre, Counter({k: 2 * v for k, v in centre.items()}), Counter({k: 1 for k in range(20)}), Counter({99: 1})]
    members = members_at(spark, sets, {1000: centre}, set()).toArrow().sort_by("id")
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    got = N.from_differences(members, members, a, b)
    assert got.tolist() == pytest.approx([similarity(sets[i], sets[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)], abs=1e-12)
