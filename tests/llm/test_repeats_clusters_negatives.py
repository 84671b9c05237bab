"""Repeated passages, centroids and hard negatives: against brute force and on hard inputs."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from martloom.llm import centroids, hard_negatives, suffix_index
from martloom.llm.queries import llm_oracles, llm_queries
from martloom.llm.repeats import anchors, leftmost_minima, pieces

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_suffix_array_dedup", "op13_hard_negative_mining"])
def test_query_equals_its_sql(spark, name):
    assert compare(llm_queries()[name](spark, SF), duck(SF), llm_oracles()[name]) == []


# --- repeated passages ----------------------------------------------------------------------------

def without_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    times = Counter(t[k:k + length] for t in raw for k in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if times[t[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def texts_with_passages(count=70, seed=5):
    pick = random.Random(seed)
    words = ["".join(pick.choice("abcdefghij") for _ in range(pick.randint(1, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(pick.choice(words) for _ in range(n))
    passages = [prose(pick.randint(10, 90)) for _ in range(6)]
    texts = []
    for _ in range(count):
        parts = [prose(pick.randint(0, 60))]
        for _ in range(pick.randint(0, 3)):
            p = pick.choice(passages)
            at = pick.randint(0, len(p) // 2)
            parts += [p[at:at + pick.randint(1, len(p))], prose(pick.randint(0, 30))]
        texts.append(("" if pick.random() < 0.3 else " ").join(parts))
    return texts + [texts[3], texts[3], "", None, "a" * 500, "ab" * 300, "c" * 199, "d" * 200, "é" * 150, "x" * 40]


@pytest.mark.parametrize("length, gram, batches, group", [(200, 64, 4, 2048), (60, 20, 3, 3)])
def test_repeats_equal_brute_force(spark, length, gram, batches, group):
    texts = texts_with_passages()
    # Columns that clash with inner names.
    df = spark.createDataFrame([(k, t, "z", 1) for k, t in enumerate(texts)], "doc_id long, text string, key string, gram long")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_index.remove_repeats(df, length, gram, batches, group).collect()}
    want = without_repeats(texts, length)
    assert sum(w[2] for w in want) > 20
    assert [got[k] for k in range(len(texts))] == want


def test_spans_are_what_is_removed(spark, docs):
    passage = " ".join(f"word{k}" for k in range(60))
    df = docs([(1, "first " + passage), (None, passage + " then the end"), (7, "alone")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in suffix_index.remove_repeats(df).collect()}
    size = len(passage.encode())
    assert got == {1: [6, 6 + size], None: [0, size], 7: []}


def test_one_passage_in_all_texts_of_a_task(spark):
    """Every text has the passage between words of its own: one gram begins as many segments as there are texts."""
    passage = " ".join(f"common{k}" for k in range(30))
    texts = [f"{'x' * (k % 7)}{k} own {k * k} {passage} {k * 7} tail {k}" for k in range(800)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_index.remove_repeats(df, batches=2, group=100).collect()}
    assert [got[k] for k in range(800)] == without_repeats(texts, 200)
    assert min(g[1] for g in got.values()) >= len(passage)


def test_empty_and_blank_repeats(spark, docs):
    df = docs([(1, None), (2, ""), (2, "")], "doc_id long, text string")
    assert suffix_index.remove_repeats(df.limit(0)).count() == 0
    assert [tuple(r)[:4] for r in suffix_index.remove_repeats(df).orderBy("doc_id").collect()] == [(1, 0, 0, 0), (2, 0, 0, 0), (2, 0, 0, 0)]


def test_levels_merge_like_a_binary_counter(spark):
    index = suffix_index.SuffixIndex(spark)
    seen = []
    for k in range(1, 7):
        batch = spark.createDataFrame([(7, 7, 1), (k, k * 10, 1), (99, k, 1)], suffix_index.SUFFIXES)
        whole, shared = index.add(batch)
        seen.append((sorted(map(tuple, whole.collect())), sorted(map(tuple, shared.collect()))))
    assert index.levels() == [(1, 4), (5, 6)]
    assert seen[0] == ([], [])
    # The seventh key is in every batch; the gram 99 begins another segment in every batch.
    assert all((7, 7) in w and (99, k) in s for k, (w, s) in enumerate(seen[1:], start=2))
    # Opened again, a level that a wider one covers is not read, though it was not removed.
    index.read([(5, 6)]).write.parquet(index._folder((5, 5)))
    again = suffix_index.SuffixIndex(spark, index.location)
    assert again.levels() == [(1, 4), (5, 6)]
    assert again.read(again.levels()).where("gram = 7").agg(F.sum("n")).first()[0] == 6


def test_anchors_of_pieces_cover_every_window_once():
    data = np.frombuffer(random.Random(3).randbytes(5000), np.uint8) % 3
    column = pa.array([bytes(data), b"", bytes(data[:450])])
    for most in (300, 1000, 1 << 20):
        covered = Counter()
        for first, base, part, offsets in pieces(column, 200, most):
            found = anchors(part, offsets, 200, 64)
            if found is not None:
                for row, low, high in zip(found.row, found.low, found.high):
                    covered.update((first + row, base + p - offsets[row]) for p in range(low, high + 1))
        assert set(covered.values()) == {1}
        assert len(covered) == (5000 - 199) + (450 - 199)


def test_leftmost_minima():
    values = np.random.default_rng(1).integers(0, 5, 1003).astype(np.uint64)
    for width in (1, 2, 7, 100):
        want = [k + int(values[k:k + width].argmin()) for k in range(len(values) - width + 1)]
        assert leftmost_minima(values, width).tolist() == want


# --- centroids --------------------------------------------------------------------------------------

def plain_clusters(rows, k, rounds):
    ids, x = [i for i, _ in rows], np.floor(256 * np.array([v for _, v in rows], float)).astype(np.int64)
    named = [p for p in range(len(ids)) if ids[p] is not None]
    order = sorted(named, key=lambda p: (hashlib.sha256(f"2:{ids[p]}".encode()).hexdigest(), x[p].tolist()))[:k]
    c = x[order]
    for turn in range(rounds + 1):
        squared = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        where, distance = squared.argmin(1), squared.min(1)
        if turn < rounds:
            c = np.array([[int(s) // int((where == j).sum()) for s in x[where == j].sum(0)] if (where == j).any() else c[j]
                          for j in range(len(c))])
    return {(ids[p], int(where[p]), int(distance[p]), int(distance[where == where[p]].sum()), int(distance.sum()),
             hashlib.sha256(",".join(map(str, c[where[p]])).encode()).hexdigest()) for p in range(len(ids))}


def test_clusters_equal_plain_rounds(spark):
    pick = np.random.default_rng(4)
    middle = pick.normal(size=(6, 64))
    rows = [(k, (middle[k % 6] + pick.normal(scale=0.4, size=64)).tolist()) for k in range(600)]
    rows += [(700, rows[0][1]), (700, rows[0][1]), (None, rows[1][1])]
    bad = [(800, None), (801, [0.0] * 63), (802, [0.0] * 63 + [float("nan")]), (803, [0.0] * 63 + [None]), (804, [float("inf")] * 64)]
    df = spark.createDataFrame([(i, v, "x", 9) for i, v in rows + bad], "vec_id long, embedding array<double>, vector string, cluster int")
    got = {tuple(r) for r in centroids.cluster(df, clusters=12).collect()}
    assert got == plain_clusters(rows, 12, 5)
    state, _ = centroids.assign(centroids.integer_vectors(df), clusters=12)
    # The bounds exclude most distances by the last round.
    assert state.agg(F.sum("evaluated")).first()[0] < 0.5 * 12 * len(rows)


def test_clusters_of_few_equal_and_no_vectors(spark):
    df = spark.createDataFrame([(k, [0.5] * 64) for k in range(5)], "vec_id long, embedding array<float>")
    rows = centroids.cluster(df).collect()
    assert {r.cluster for r in rows} == {0} and {r.inertia for r in rows} == {0} and len(rows) == 5
    assert centroids.cluster(df.limit(0)).count() == 0


def test_bounds_use_total_displacement():
    pick = np.random.default_rng(2)
    x = pick.integers(-300, 300, (500, 8))
    history = [pick.integers(-300, 300, (9, 8))]
    bounds = centroids.Bounds.first(x, history[0])
    # Centroids that go and come back have not moved: nothing is computed.
    history.append(history[0] + 40)
    bounds.advance(x, history)
    history.append(history[0].copy())
    kept = bounds.cluster.copy()
    bounds.advance(x, history)
    want = ((x[:, None] - history[-1][None]) ** 2).sum(-1).argmin(1)
    assert (bounds.cluster == want).all()
    fresh = centroids.Bounds.first(x, history[0])
    far = [history[0], history[0] + 10_000, history[0]]
    assert fresh.advance(x, far) == 0 and kept is not None
    large = x * (1 << 20)
    assert (centroids._all_squared(large, large[:5]) == ((large[:, None] - large[None, :5]) ** 2).sum(-1)).all()


# --- hard negatives -----------------------------------------------------------------------------------

def plain_negatives(rows, every=100, most=5, negatives=10):
    x = [np.floor(256 * np.array(v, float)).astype(np.int64) for _, v, _ in rows]
    out = []
    for a, (anchor, _, label) in enumerate(rows):
        if anchor % every:
            continue
        score = {k: int(x[a] @ x[k]) for k in range(len(rows)) if k != a and len(x[k]) == len(x[a])}
        order = sorted(score, key=lambda k: (-score[k], rows[k][0]))
        for p in [k for k in order if rows[k][2] == label][:most]:
            band = [k for k in order if rows[k][2] != label and 30 * score[p] <= 100 * score[k] <= 90 * score[p]]
            out += [(anchor, rows[p][0], n + 1, rows[k][0], score[p], score[k]) for n, k in enumerate(band[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("block, queries, dims", [(8192, 256, 64), (100, 3, 64), (64, 4, 70)])
def test_negatives_equal_brute_force(spark, block, queries, dims):
    pick = np.random.default_rng(dims)
    middle = pick.normal(size=(5, dims))
    # One label holds more than half; two labels have a few rows each; scores tie; rows repeat.
    labels = [0 if k % 2 else 1 + k % 6 for k in range(700)] + [90, 91, 91]
    rows = [(k, (0.1 * middle[k % 5] + pick.normal(scale=0.1, size=dims)).round(1).tolist(), label) for k, label in enumerate(labels)]
    rows += [rows[5], rows[5], (1000, rows[10][1][:40], 0), (1001, rows[11][1][:40], 0), (1002, rows[12][1][:40], 3), (1100, [], 2)]
    bad = [(2000, None, 1), (2100, rows[0][1], None), (2200, [float("nan")] * dims, 1), (None, rows[0][1], 1)]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows + bad],
                               "vec_id long, embedding array<double>, label int, number string, score int")
    got = hard_negatives.mine(hard_negatives.usable(df), F.col("vec_id") % 20 == 0, block=block, queries=queries)
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows, 20)


def test_no_anchors_and_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 2)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(df).count() == 0
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


def test_intervals_hold_every_score():
    pick = np.random.default_rng(8)
    for dims in (1, 3, 64, 100):
        x = np.floor(256 * pick.normal(size=(400, dims))).astype(np.int32)
        x[7] = 0
        codes = hard_negatives.Codes({"size": 400, "vectors": x.tobytes(), **hard_negatives.coded(x)})
        for query in (*x[:20].astype(np.int64), np.zeros(dims, np.int64)):
            low, high = codes.interval(query)
            score = x.astype(np.int64) @ query
            assert ((low <= score) & (score <= high)).all()
            if dims == 64 and query.any():
                assert (high - low).mean() < 0.5 * np.linalg.norm(query) * np.linalg.norm(x, axis=1).mean()
