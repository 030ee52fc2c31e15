"""Merged digest runs, whitening and clusters by subvector dictionaries, against brute force."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from fieldglass.llm import digest_runs, queries, reduce_tree, subvector_clusters, whitening

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>"


# Runs of digests


def ascii_lower(text):
    return (text or "").encode().lower()


def groups_by_definition(rows, largest):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[ascii_lower(text)].append(doc_id)
    out = defaultdict(int)
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = (max(named) if largest else min(named)) if named else None
        digest = hashlib.sha256(text).hexdigest()
        kept = False
        for i in ids:
            now = i == keep and not kept
            kept |= now
            out[(i, keep, len(ids), now, digest)] += 1
    return dict(out)


def found_groups(frame, **options):
    out = defaultdict(int)
    for r in digest_runs.deduplicate(frame, **options).collect():
        out[(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)] += 1
    return dict(out)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_duplicates_of_odd_rows(spark, monkeypatch, keep):
    pick = random.Random(5)
    texts = ["", None, "A b", "a B", "É", "é", "x" * 100_000, "X" * 100_000, "ſ", "K"] + [f"Text {i % 40}" for i in range(60)]
    rows = [(pick.choice([None, *range(-5, 60)]), pick.choice(texts), 1, 2) for _ in range(600)] + [(7, "hot", 1, 2)] * 300 + [(None, "HOT", 1, 2)] * 5
    frame = spark.createDataFrame(rows, "doc_id long, text string, digest int, tag int").repartition(13)
    wanted = groups_by_definition([r[:2] for r in rows], keep == "largest")
    assert found_groups(frame, keep=keep) == wanted
    # Many small nodes: several rounds, pieces of a run sent early; hot texts broadcast.
    monkeypatch.setattr(digest_runs, "NODE_ENTRIES", 4)
    monkeypatch.setattr(digest_runs, "ROUND_BITS", 3)
    monkeypatch.setattr(digest_runs, "HOT", 100)
    assert found_groups(frame, keep=keep) == wanted


def test_exact_duplicates_of_nothing(spark):
    assert found_groups(spark.createDataFrame([], "doc_id long, text string")) == {}
    with pytest.raises(ValueError, match="smallest or largest"):
        digest_runs.deduplicate(spark.createDataFrame([], "doc_id long, text string"), keep="first")


def test_equal_prefixes_are_not_equal_digests():
    run = np.zeros(3, digest_runs.ENTRY)
    run["rows"], run["named"], run["id"] = 1, 1, [5, 6, 7]
    run["digest"][1, 3] = 9
    run["bytes"] = [1, 1, 2]
    out = digest_runs.merged([run, run], True)
    assert out["id"].tolist() == [5, 7, 6] and out["rows"].tolist() == [2, 2, 2]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 4), st.integers(0, 2**32))
def test_pieces_end_at_the_node_of_their_digest(bits, step, seed):
    random_ = np.random.default_rng(seed)
    runs = {int(n): [np.zeros(20, digest_runs.ENTRY)] for n in random_.integers(0, 1 << bits, 5)}
    for run in runs.values():
        run[0]["digest"] = random_.integers(0, 1 << 63, (20, 4)) * 2
    total = sum(len(r[0]) for r in runs.values())
    done = 0
    while done < bits:
        now, after = min(step, bits - done), defaultdict(list)
        for node, held in runs.items():
            for to, part in digest_runs.pieces(np.concatenate(held), node, bits, done, now):
                after[to].append(part)
        runs, done = after, done + now
    assert sum(len(p) for held in runs.values() for p in held) == total
    for node, held in runs.items():
        assert all((p["digest"][:, 0].astype(np.uint64) >> np.uint64(64 - bits) == node).all() for p in held)


def test_exact_duplicates_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = defaultdict(int)
    for r in queries.op11_digest_runs(spark, SF).collect():
        out[(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)] += 1
    assert dict(out) == groups_by_definition(rows, True)


def test_exact_duplicates_query_on_rows_that_come_twice(spark, tmp_path):
    """By the contract, which the SQL twin repeats, every row with the id that stays is kept."""
    rows = [(1, "a"), (3, "A"), (3, "a"), (3, "b"), (2, "b"), (None, "b"), (9, None), (9, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_digest_runs(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in found) == [
        (0, 3, 3, False), (1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (3, 3, 3, True), (9, 9, 2, True), (9, 9, 2, True),
    ]


# Whitening


def scatter(x):
    centred = x - x.mean(axis=0)
    return centred.T @ centred


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 9), st.integers(1, 40), st.integers(1, 400), st.integers(0, 2**32))
def test_spectrum_follows_every_vector(width, count, reach, seed):
    x = np.random.default_rng(seed).integers(-reach, reach + 1, (count, width))
    x[:, seed % width] *= seed % 3  # often without variance or with repeated eigenvalues
    whole = whitening.spectrum_of([x[: count // 3], x[count // 3 :]])
    states = [s for s in (whitening.spectrum_of([p]) for p in np.array_split(x, 3)) if s is not None]
    merged = states[0]
    for state in states[1:]:
        merged = whitening.both_spectra(merged, state)
    s = scatter(x)
    size = max(np.abs(s).max(), 1e-9)
    for state in (whole, merged):
        assert state["n"] == count and (state["sums"] == x.sum(axis=0)).all()
        assert (np.diff(state["values"]) >= 0).all()
        assert np.abs(state["vectors"].T @ state["vectors"] - np.eye(width)).max() < 1e-10
        assert np.abs((state["vectors"] * state["values"]) @ state["vectors"].T - s).max() < 1e-10 * size


def test_secular_roots_lie_between_poles():
    poles, z2 = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0, 1e6]), np.array([1e-12, 3.0, 1e-3, 7.0, 1e4])
    near, x = whitening.secular_roots(poles, z2)
    roots = poles[near] + x
    assert np.allclose(roots, np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(z2), np.sqrt(z2))), rtol=1e-14)
    assert (x != 0).all()


def whitened_by_definition(rows, components=16):
    """id -> (n, deviation, whitened up to sign, explained) by numpy's eigendecomposition."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    widths = [len(v) for _, v in good]
    width = max(set(widths), key=lambda w: (widths.count(w), w))
    good = [(i, v) for i, v in good if len(v) == width]
    fit = np.array(sorted({tuple(v) for _, v in good}))
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(scatter(fit - 1_000_000) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = sum(values[:components] > 1e-12 * values[0])
    out = []
    for i, v in good:
        deviation = sum((n * x - int(s)) ** 2 for x, s in zip(v, sums))
        white = ((np.array(v) - 1_000_000) - (sums - 1_000_000 * n) / n) @ vectors[:, :count] / np.sqrt(values[:count])
        out.append((i, n, deviation, white))
    return out, values[:count] / values.sum()


def compared(got, rows, components=16):
    wanted, explained = whitened_by_definition(rows, components)
    table = defaultdict(list)
    for r in got:
        table[(r.vec_id, r.n, r.deviation)].append(r)
    assert len(got) == len(wanted) * len(explained)
    assert all(r.identity_error <= 1e-9 for r in got) and len({r.identity_error for r in got}) == 1
    ours = {key: np.array(sorted((r.component, r.whitened) for r in rows_)) for key, rows_ in table.items()}
    assert set(ours) == {w[:3] for w in wanted}
    shares = {r.component: r.explained for r in got}
    assert np.allclose([shares[c + 1] for c in range(len(explained))], explained, rtol=1e-9)
    mine = np.array([ours[w[:3]][: len(explained), 1] if len(ours[w[:3]]) == len(explained) else np.full(len(explained), NAN) for w in wanted])
    theirs = np.array([w[3] for w in wanted])
    for c in range(len(explained)):
        at = np.nanargmax(np.abs(mine[:, c]))
        sign = np.sign(mine[at, c] * theirs[at, c])
        assert np.nanmax(np.abs(mine[:, c] - sign * theirs[:, c])) < 1e-7


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compared(queries.op12_whitening(spark, SF).collect(), rows)


def test_whitening_of_odd_rows(spark):
    random_ = np.random.default_rng(2)
    rows = [(i, [float(c) for c in random_.normal(size=3) * (1, 3, 0)]) for i in range(50)]
    rows += rows[:9] + [(None, [5.0, -4.0, 0.0]), (60, None), (61, []), (62, [NAN, 1.0, 0.0]), (63, [1.0, INF, 0.0]), (64, [None, 1.0, 0.0]), (65, [1.0, 2.0])]
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], VECTORS + ", whole int, component string").repartition(7)
    got = whitening.whiten(frame, fan_in=2).collect()
    assert {r.component for r in got} == {1, 2}
    compared(got, rows)
    assert whitening.whiten(frame.where("vec_id = 3")).count() == 0
    assert whitening.whiten(frame.where("vec_id > 59 AND vec_id < 65")).count() == 0
    with pytest.raises(PySparkException, match="larger than"):
        whitening.whiten(spark.createDataFrame([(1, [1e30])], VECTORS)).collect()


def test_deviations_beyond_a_long_are_null():
    rows, sums = np.array([[0, 0], [1 << 40, 3], [7, 1]]), np.array([(1 << 40) + 7, 4])
    exact = [sum((1000 * int(x) - int(s)) ** 2 for x, s in zip(row, sums)) for row in rows]
    assert whitening.deviations(rows, 1000, sums) == [d if d < 1 << 63 else None for d in exact]


def test_states_meet_in_rounds(spark):
    rows = spark.range(1000, numPartitions=9)
    states = reduce_tree.task_states(rows, lambda batches: {"ids": sorted(i for b in batches for i in b.column(0).to_pylist())})
    merged = reduce_tree.tree_merged(states, lambda a, b: {"ids": a["ids"] + b["ids"]}, fan_in=2)
    assert merged["ids"] == list(range(1000))
    assert reduce_tree.tree_merged(reduce_tree.task_states(rows.where("id < 0"), lambda batches: None), None) is None


# Clusters


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 60), st.integers(1, 9), st.integers(1, 4), st.integers(0, 2**32))
def test_dictionaries_lose_nothing(count, width, kinds, seed):
    random_ = np.random.default_rng(seed)
    vectors = random_.integers(-kinds, kinds, (count, width))
    vectors[random_.random(count) < 0.5] = vectors[0]
    blocks = subvector_clusters.encoded(vectors)
    assert (subvector_clusters.decoded(blocks) == vectors).all()
    centres = random_.integers(-5, 5, (3, width))
    by_hand = ((vectors[:, None, :] - centres) ** 2).sum(axis=2)
    assert (subvector_clusters.distances(blocks, centres) == by_hand).all()
    near = by_hand.argmin(axis=1)
    sums = [vectors[near == c].sum(axis=0).tolist() for c in range(3)]
    assert subvector_clusters.cluster_sums(blocks, near, 3).tolist() == sums


def test_repeated_vectors_make_wide_blocks():
    vectors = np.tile(np.arange(64) % 7, (800, 1)) + (np.arange(800) % 4)[:, None]
    assert [b.values.shape for b in subvector_clusters.encoded(vectors)] == [(4, 64)]


def clusters_by_definition(rows, width, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)]
    hashed = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in hashed[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        centres = [[sum(column) // len(groups[j]) for column in zip(*groups[j])] if groups[j] else c for j, c in enumerate(centres)]
    final = [(i, *near(v)) for i, v in kept]
    inertia = defaultdict(int)
    for _, distance, j in final:
        inertia[j] += distance
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i is None, i or 0, j, d, inertia[j], sum(inertia.values()), digest[j]) for i, d, j in final)


def found_clusters(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_clusters_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert found_clusters(queries.op13_subvector_clusters(spark, SF)) == clusters_by_definition(rows, 64)


def test_clusters_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(subvector_clusters, "CHUNK", 50)
    random_ = np.random.default_rng(4)
    rows = [(int(i) % 90, [float(c) for c in random_.normal(size=3) * 4]) for i in range(120)]
    rows += [(500, [1.0, 1.0, 1.0])] * 40 + [(None, [1.0, 1.0, 1.0]), (None, [-0.0, -1.0, 0.5]), (1, None), (2, []), (3, [1.0, 2.0]), (4, [NAN, 1.0, 1.0]), (5, [INF, 1.0, 1.0]), (6, [None, 1.0, 1.0])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS + ", cluster int, codes int").repartition(3)
    assert found_clusters(subvector_clusters.cluster(frame, width=3)) == clusters_by_definition(rows, 3)
    few = [r for r in rows if r[0] in (3, 500)][:4]
    assert found_clusters(subvector_clusters.cluster(spark.createDataFrame(few, VECTORS), width=3)) == clusters_by_definition(few, 3)
    assert subvector_clusters.cluster(frame.where("vec_id IS NULL AND vec_id IS NOT NULL"), width=3).count() == 0
    with pytest.raises(PySparkException, match="larger than"):
        subvector_clusters.cluster(spark.createDataFrame([(1, [1e30, 0.0, 0.0])], VECTORS), width=3).collect()
