"""Overlap joins, runs and hard negatives against brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute
from txrisk.llm import op06_near_dedup, op11_overlap_join, op12_runs, op13_negatives
from txrisk.llm.components import components

SCHEMA = "doc_id long, text string, comp string, n int, vid string, node int"


def some_texts(seed: int) -> list:
    """Unlike texts, a passage in most of them, chains of near copies, a large group of near copies, short and odd texts."""
    rng = np.random.default_rng(seed)
    word = lambda n: [f"w{i}" for i in rng.integers(0, 500, n)]
    passage = word(40)
    texts = [None, "", " \n\t ", "one", "ONE", "one two", "One two", "one two three four five six"] + [" ".join(word(n)) for n in range(3, 40)]
    texts += [" ".join(word(60) + passage) for _ in range(40)]
    base = word(90)
    for _ in range(120):
        new = list(base)
        for at in rng.integers(0, len(base), rng.integers(0, 6)):
            new[at] = f"x{rng.integers(0, 10**6)}"
        texts.append(" ".join(new))
    chain = word(300)
    for _ in range(12):
        at = int(rng.integers(0, 290))
        chain = [*chain[:at], *word(3), *chain[at + 3 :]]
        texts.append(" ".join(chain))
    long = word(6000)
    texts += [" ".join(long), " ".join(long[:5000]), " ".join(long[:4700]), " ".join(["same"] * 4000), " ".join(["same"] * 4001), texts[50], texts[50].upper()]
    return texts


@pytest.mark.parametrize(("words", "leaf"), [(5, 16), (2, 512), (1, 8)])
def test_overlap_join(spark, words, leaf):
    rows = [(i, t) for i, t in enumerate(some_texts(words))] + [(3, "another text of the same number as one"), (60, some_texts(words)[61]), (None, some_texts(words)[60]), (None, None)]
    docs = spark.createDataFrame([(*r, "c", 1, "v", 2) for r in rows], SCHEMA).repartition(5)
    got = op11_overlap_join.overlap_join(docs, words=words, leaf=leaf)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(map(tuple, got.collect())) == Counter(brute.sets_and_components(rows, words))
    assert op11_overlap_join.overlap_join(docs.limit(0)).count() == 0


def test_bounds_are_never_below_the_overlap():
    rng = np.random.default_rng(7)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 64, int(rng.integers(1, 900)), dtype=np.uint64))
        b = np.unique(np.concatenate([rng.choice(a, len(a) // 2), rng.integers(0, 1 << 64, int(rng.integers(1, 900)), dtype=np.uint64)]))
        for fine in (False, True):
            width = min(op11_overlap_join._width(len(s), fine) for s in (a, b))
            points = [op11_overlap_join.on_grid(op11_overlap_join.group_counts(s), width) for s in (a, b)]
            assert points[0].sum() == len(a) and np.minimum(*points).sum() >= len(np.intersect1d(a, b))


def test_tree_finds_all_pairs_that_reach_the_bound():
    rng = np.random.default_rng(8)
    n = 400
    points = rng.poisson(1.5, (n, 64)).astype(np.uint16)
    points[100:200] = points[100] + (rng.random((100, 64)) < 0.05)
    group, comp, size = rng.integers(0, 5, n), rng.integers(0, 60, n), points.sum(1).astype(np.int64)
    a, b = op11_overlap_join._Tree(group, comp, size, points).pairs(80)
    want = set()
    for i in range(n):
        for j in range(i):
            near = 100 * min(size[i], size[j]) >= 80 * max(size[i], size[j])
            if group[i] == group[j] and comp[i] != comp[j] and near and 180 * np.minimum(points[i], points[j]).sum() >= 80 * (size[i] + size[j]):
                want.add((j, i))
    assert len(want) > 300 and {(min(x), max(x)) for x in zip(a.tolist(), b.tolist(), strict=True)} == want and len(a) == len(want)


@pytest.mark.parametrize("task_edges", [10**6, 40])
def test_components_in_one_task_and_in_many(spark, task_edges):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(100)] + [(7, 7)]
    root = {v: v for e in edges for v in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    lone = {v for v in root if all(v not in e or e[0] == e[1] for e in edges)}
    got = {r.vertex: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(8), task_edges).collect()}
    assert got == {v: r for v, r in root.items() if v not in lone}
    assert components(spark.createDataFrame([], "a long, b long"), task_edges).count() == 0


def test_runs_match_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(1500):
        n, kinds = int(rng.integers(0, 110)), int(rng.choice([1, 2, 2, 3, 5, 40]))
        words = [b"%d" % i for i in rng.integers(0, kinds, n)]
        if n and rng.random() < 0.6:
            a, p = int(rng.integers(0, n)), int(rng.integers(1, 30))
            words = [words[i] if i < a else words[min(a + (i - a) % p, n - 1)] for i in range(n)]
        assert op12_runs.find_runs(words) == brute.runs(words)


def test_rules_derive_the_text():
    rng = np.random.default_rng(6)
    for kinds in (1, 2, 4, 30):
        ids = rng.integers(0, kinds, 500)
        rules, starts = op12_runs.re_pair(ids, op12_runs._Text(ids).pairs)
        assert starts[0] == 0 and starts == sorted(starts) and len(rules) > 5
        for half, length, at in rules:
            assert 0 < half < length and len(at) > 1 and len({tuple(ids[p : p + length]) for p in at}) == 1
        # No pair of what is left occurs twice without overlap.
        parts = [tuple(ids[a:b]) for a, b in zip(starts, [*starts[1:], 500], strict=True)]
        seen = {}
        for i, pair in enumerate(zip(parts, parts[1:], strict=False)):
            assert pair not in seen or seen[pair] == i - 1
            seen.setdefault(pair, i)


def test_runs_of_documents(spark):
    texts = [None, "", "  ", "a " * 11, "a " * 12, "a b c d e f g " * 3 + "x", " ".join(f"w{i}" for i in range(40)), "A b a " * 9, "a " * 50_000, " ".join(f"w{i % 977}" for i in range(30_000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(i, "k l m n o p q r s t u v w x y z " * 2) for i in range(40, 90)] + [(40, "a b " * 9), (None, "a " * 12)]
    docs = spark.createDataFrame([(*r, "c", 1, "v", 2) for r in rows], SCHEMA)
    for plant in (False, True):
        want = Counter()
        for i, t in rows:
            words = (t or "").encode().split()
            n, h = len(words), zlib.crc32(str(i).encode())
            if plant and i is not None and n and h % 10 == 0:
                g = h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words = words[:a] + [words[a + (j - a) % p] for j in range(a, n)]
            own = brute.runs(words) if n < 2000 else op12_runs.find_runs(words)
            drop = {j for s, e, q in own for j in range(s + q, e)}
            kept = b" ".join(w for j, w in enumerate(words) if j not in drop)
            s, e, q = max(own, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=(None,) * 3)
            top = (None,) * 4 if s is None else (s, e - s, q, 1000 * (e - s) // q)
            listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in own)
            want[i, len(own), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()] += 1
        assert Counter(map(tuple, op12_runs.periodic_runs(docs, plant).collect())) == want
    assert {len(w) for w in want} == {8}
    out = op12_runs.periodic_runs(docs, runs_column="all").where("doc_id = 5").first()
    assert [tuple(r) for r in out["all"]] == [(0, 21, 7)]
    assert op12_runs.periodic_runs(docs.limit(0), runs_column="all").count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id long, label int, embedding array<float>, anchor string, rank int")


def test_negatives(spark, monkeypatch):
    monkeypatch.setattr(op13_negatives, "CHUNK", 150)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(700):
        own = rng.normal(0, 0.3, 24) * np.linspace(1, 0.1, 24) + (0.4 if i % 3 else 0)
        rows.append((i, int(rng.integers(0, 4)), [float(np.float32(x)) for x in own]))
    rows += [(1000 + i, i % 3, rows[100][2]) for i in range(60)]  # one vector in many rows: ties
    rows += [rows[200], rows[7], (100, 3, rows[1][2]), (800, 1, [-x for x in rows[800 % 7][2]]), (900, 99, rows[3][2])]
    odd = [(None, 1, rows[0][2]), (1100, None, rows[0][2]), (1200, 1, None), (1300, 1, [None, 1.0]), (1400, 1, [float("nan")] * 24), (1500, 2, [float("inf")] * 24)]
    short = [(1600, 1, [1.0, 0.5]), (1601, 1, [1.0]), (1602, 2, [0.5, 0.5]), (1700, 1, [])]
    usable = op13_negatives.usable(vectors(spark, rows + odd + short).repartition(3))
    got = op13_negatives.hard_negatives(usable)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    whole = [(i, lab, [float(np.floor(256 * x)) for x in v]) for i, lab, v in rows + short]
    want = Counter(brute.negatives(whole))
    assert Counter(map(tuple, got.collect())) == want and len(want) > 200
    assert op13_negatives.hard_negatives(usable.limit(0)).count() == 0


def test_wide_rows_are_kept_once(spark, monkeypatch):
    """Tokens and points are the bulk of what the joins of documents write: one table of them, and half a byte a token for comparing."""
    docs = spark.createDataFrame([(i, f"a{i // 3} b c d e f g h i j k l m n o p q r s t u v w {i % 3 % 2}") for i in range(60)], "doc_id long, text string")
    wide = []
    for module, column, run in ((op06_near_dedup, "tokens", op06_near_dedup.near_duplicates), (op11_overlap_join, "counts", op11_overlap_join.overlap_join)):
        keep = module.kept
        monkeypatch.setattr(module, "kept", lambda df, name, keep=keep, column=column: (wide.append((column, name)) if column in df.columns else None) or keep(df, name))
        assert run(docs).count() == 60
    assert wide == [("tokens", "vertices"), ("counts", "points")]
    tokens = np.arange(op06_near_dedup.WIDTH, dtype=np.uint32) * 977
    other = np.where(np.arange(op06_near_dedup.WIDTH) % 4 == 0, tokens + 3, tokens)
    low = [op06_near_dedup.low_bits(t) for t in (tokens, other)]
    assert len(low[0]) == op06_near_dedup.WIDTH // 2 and op06_near_dedup._ZEROS[low[0] ^ low[1]].sum() == 96


def test_index_leaves_out_nothing_above_the_threshold():
    rng = np.random.default_rng(9)
    for share in (0.9, 0.5, 0.1, -1.0):
        rows, anchors = (np.floor(256 * rng.normal(0, 0.2, (n, 40)) * np.linspace(1, 0.05, 40)) for n in (300, 20))
        index = op13_negatives.Index(np.arange(300), np.zeros(300, int), rows)
        scores = anchors @ rows.T
        least = share * scores.max(1) if share > 0 else np.full(20, -np.inf)
        a, r, s = index.above(anchors, least)
        assert {(x, y) for x, y in zip(a.tolist(), r.tolist(), strict=True)} >= set(zip(*(x.tolist() for x in np.nonzero(scores >= least[:, None])), strict=True))
        assert (s == scores[a, r]).all() and (s >= least[a] - 0.5).all()


def test_points_without_a_partner_leave_their_node(spark):
    # Node 1: sizes too different; 2: too little left after the place; 3: linkable; 4: the same component; 5: one of three has no partner.
    rows = [(1, 10, 10, 100, 0), (1, 11, 11, 70, 0), (2, 20, 20, 100, 15), (2, 21, 21, 100, 0), (3, 30, 30, 100, 11), (3, 31, 31, 100, 11)]
    rows += [(4, 40, 40, 100, 0), (4, 41, 40, 100, 0), (5, 30, 30, 100, 0), (5, 50, 50, 300, 0), (5, 31, 31, 100, 3)]
    frame = spark.createDataFrame(rows, "node long, vid long, comp long, size int, place int")
    got = op11_overlap_join._with_partner(frame, 80).collect()
    assert sorted((r.node, r.vid, r.n) for r in got) == [(3, 30, 2), (3, 31, 2), (5, 30, 2), (5, 31, 2)]
    assert len({r.alike for r in got}) == 1  # nodes 3 and 5 hold the same points now
    open_ = op11_overlap_join._open_nodes(frame, 80).collect()
    assert sorted(map(str, open_)) == sorted(map(str, got))


def test_bit_map_has_every_named_node(spark):
    rng = np.random.default_rng(11)
    nodes, others = (rng.integers(-(1 << 63), (1 << 63) - 1, 5000) for _ in range(2))
    words = op11_overlap_join._bit_map(spark.createDataFrame([(int(x),) for x in nodes], "node long"))
    assert op11_overlap_join._in_map(words, nodes).all() and op11_overlap_join._in_map(words, others).mean() < 0.05


def test_cells_of_the_histogram_grow_with_the_documents():
    assert [op11_overlap_join._cells(n) for n in (0, 51_282, 256_410, 10**9)] == [1 << 16, 1 << 18, 1 << 20, 1 << 22]


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_points_outside_of_groups_are_not_shuffled(spark, monkeypatch, sent):
    points = op11_overlap_join.kept(spark.range(1000).selectExpr("id as vid", "3L as n", "cast(repeat('a', 64) as binary) as counts"), "points")
    groups = spark.createDataFrame([(1, 5, 5), (1, 6, 6)], "grp long, vid long, comp long")
    plans, small = [], op11_overlap_join.small
    monkeypatch.setattr(op11_overlap_join, "small", lambda df, rows=sent: small(df, rows))

    def surviving(rows, percent, fine):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return rows.selectExpr("grp as cluster", "vid", "comp")

    monkeypatch.setattr(op11_overlap_join, "_surviving", surviving)
    monkeypatch.setattr(op11_overlap_join, "_coarse", lambda points: points)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = op11_overlap_join._clusters(lambda *_: groups, points, points, 80, 512)
        assert sorted(map(tuple, found.collect())) == [(1, 5), (1, 6)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Where the groups are not sent, their points' names are.
    assert len(plans) == 2 and all("BroadcastHashJoin" in p for p in plans)
