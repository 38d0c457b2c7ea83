"""Mixing, packing, nearest neighbours and the pipeline."""

import hashlib
import math
import random

import numpy as np
import pytest

import corpus_pipeline
from loomsift.llm import ann, linededup, mixing, neardup, packing
from tests.llm.test_dedup import brute_groups, brute_lines, near_rows

CLASH = "doc_id long, text string, source string, copy int, mix_reps double, weight long"


def water(sizes, weights, cap, budget):
    """The loop that the closed form stands for."""
    reps, clamped = {}, set()
    while True:
        taken = sum(cap * sizes[s] for s in clamped)
        free = [s for s in sizes if s not in clamped]
        total = sum(weights[s] for s in free)
        for s in free:
            reps[s] = max(0, budget - taken) * weights[s] / total / sizes[s]
        over = {s for s in free if reps[s] >= cap}
        if not over:
            break
        clamped |= over
        reps.update({s: float(cap) for s in over})
        if len(clamped) == len(sizes):
            break
    return reps


def test_water_filling_against_the_loop(spark):
    rng = random.Random(1)
    for _ in range(4):
        sizes = {f"s{i}": rng.randint(1, 60) for i in range(rng.randint(1, 6))}
        weights = {s: rng.randint(1, 50) for s in sizes}
        docs = spark.createDataFrame([(i, "x" * n, s) for i, (s, n) in enumerate(sizes.items())], "doc_id long, text string, source string")
        budget = rng.randint(1, 5 * sum(sizes.values()))
        w = spark.createDataFrame(list(weights.items()), "source string, weight long")
        got = {r.source: r.reps for r in mixing.epochs(docs, w, 4, budget).collect()}
        want = water(sizes, weights, 4, budget)
        assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-9) for s in want)


def brute_mix(rows):
    """rows: (doc_id, text, source). No weights, no budget: every source at one epoch at least."""
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode())
    some = {s: n for s, n in sizes.items() if n}
    weights = {s: math.floor(math.sqrt(n) * math.sqrt(math.sqrt(n)) * 1000) for s, n in some.items()}
    top = max((n / weights[s] for s, n in some.items()), default=0)
    budget = sum(math.floor(min(4.0 * n, top * weights[s])) for s, n in some.items())
    reps = {**{s: 1.0 for s in sizes}, **(water(some, weights, 4, budget) if some else {})}
    out = []
    for i, t, s in rows:
        u = int(hashlib.md5(f"{mixing.SEED}:{'' if i is None else i}".encode()).hexdigest()[:8], 16) / 2**32
        out += [(i, t, s)] * (math.floor(reps[s]) + (u < reps[s] - math.floor(reps[s])))
    return out


def _key(rows):
    return sorted(rows, key=repr)


def test_mixing_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randint(0, 50), "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])) for i in range(200)]
    rows += [(None, "no id", "a"), (3, None, "b"), (500, None, "bare"), (501, "", "bare"), rows[5], (502, "y" * 100_000, "long")]
    df = spark.createDataFrame([(*r, 7, 0.1, 3) for r in rows], CLASH)
    got = mixing.mix(df)
    assert got.columns == df.columns
    assert _key([(r.doc_id, r.text, r.source) for r in got.collect()]) == _key(brute_mix(rows))
    assert mixing.mix(df.limit(0)).count() == 0
    w = spark.createDataFrame([("hot", 1), ("a", 0)], "source string, weight long")
    assert {r.source for r in mixing.mix(df, w, budget=10_000_000).collect()} == {"hot"}


def test_plan_does_not_shuffle_texts(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    assert "BroadcastHashJoin" in mixing.mix(df)._jdf.queryExecution().executedPlan().toString()


# ---- packing


def slow_pack(sizes, window):
    """Tries every level and adds up all squares."""
    open_windows, out, opened = [], [], 0
    for i, n in enumerate(sizes):
        at = 0
        while n - at >= window:
            out.append((i, opened, 0, at, window))
            opened += 1
            at += window
        n -= at
        if not n:
            continue
        best = None
        for level in sorted({f for _, f in open_windows if f + n <= window} | {0}, reverse=True):
            counts = {}
            for _, f in open_windows:
                counts[f] = counts.get(f, 0) + 1
            if level:
                counts[level] -= 1
            if level + n < window:
                counts[level + n] = counts.get(level + n, 0) + 1
            cost = sum(c * c for c in counts.values())
            if best is None or cost < best[0]:
                best = cost, level
        level = best[1]
        if level:
            k = max(k for k, (_, f) in enumerate(open_windows) if f == level)
            w, _ = open_windows.pop(k)
        else:
            w, opened = opened, opened + 1
        if level + n < window:
            open_windows.append((w, level + n))
        out.append((i, w, level, at, n))
    return out


def test_sum_of_squares_against_all_squares():
    rng = random.Random(3)
    for window in (2, 7, 16, 50):
        sizes = [rng.randint(1, int(window * 1.6)) for _ in range(150)]
        got = list(zip(*(x.tolist() for x in packing.pack_lengths(np.array(sizes), window))))
        assert got == slow_pack(sizes, window)


def test_packing_loses_nothing(spark):
    rng = random.Random(4)
    rows = [(i, "é" * rng.randint(0, 90)) for i in range(300)] + [(None, "abc"), (1000, None), (7, "dup"), (7, "dup"), (1001, "z" * 50_000)]
    df = spark.createDataFrame([(i, t, 5, 6) for i, t in rows], "doc_id long, text string, n int, shard int")
    got = packing.pack(df, window=128, per_shard=100).collect()
    assert sum(r.length for r in got) == sum(len(t.encode()) + 1 for _, t in rows if t is not None)
    windows = {}
    for r in got:
        windows.setdefault(r.window_id, []).append((r.start, r.length))
    for parts in windows.values():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at <= 128
    assert packing.pack(df.limit(0)).count() == 0
    assert 1000 not in {r.doc_id for r in got}
    full = sum(sum(x for _, x in p) == 128 for p in windows.values())
    assert full / len(windows) > 0.5
    with pytest.raises(ValueError):
        packing.pack(df, window=1)


# ---- neighbours


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 24))
    x = np.concatenate([base[rng.integers(0, 40, 900)] + 0.4 * rng.standard_normal((900, 24)), rng.standard_normal((300, 24))])
    rows = [(i, [float(v) for v in r], 1, "g") for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, g int, id string")
    got = {}
    for r in ann.neighbours(df, k=10).collect():
        got.setdefault(r.vec_id, []).append((r.rank, r.neighbour_id))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit @ unit.T
    np.fill_diagonal(s, -9)
    best = np.argsort(-s, axis=1)[:, :10]
    assert all(sorted(r for r, _ in got[i]) == list(range(1, 11)) for i in range(len(x)))
    recall = np.mean([len({n for _, n in got[i]} & set(best[i].tolist())) / 10 for i in range(len(x))])
    assert recall >= 0.9


def test_neighbours_of_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [nan, 1.0]), (6, [0.0, 0.0]), (7, [1.0]), (None, [1.0, 1.0]), (3, [0.0, 1.0]), (8, [None, 1.0]), (9, []), (10, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.rank, r.neighbour_id, r.similarity) for r in ann.neighbours(df, k=2).collect())
    assert got == [(1, 1, 2, 1.0), (1, 2, 10, 1.0), (2, 1, 1, 1.0), (2, 2, 10, 1.0), (3, 1, 1, 0.0), (3, 2, 2, 0.0), (10, 1, 1, 1.0), (10, 2, 2, 1.0)]
    assert ann.neighbours(df.limit(0)).count() == 0
    assert ann.neighbours(df.where("vec_id = 7")).count() == 0


# ---- pipeline


def test_pipeline_against_brute_force(spark, tmp_path):
    """Without labels the classifier keeps every text; the other stages are done again by hand."""
    rng = random.Random(6)
    lines = [f"shared line {i} with some words in it" for i in range(8)]
    rows = [(i, t.replace(" v1", "\nv1") + "\n" + rng.choice(lines), rng.choice(["p", "q", "q", "q"])) for i, t in near_rows(9, 12)]
    rows += [(900, None, "p"), (901, "", "q"), (902, rows[0][1], "p")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    source = {i: s for i, _, s in rows}
    kept = [(i, t) for i, t, _ in rows if t is not None]
    kept = brute_lines(kept)
    group = brute_groups(kept)
    first = {}
    for k, (i, t) in enumerate(kept):
        if (t or "").split():
            first[group[k]] = min(first.get(group[k], i), i)
    kept = [(i, t) for k, (i, t) in enumerate(kept) if not (t or "").split() or first[group[k]] == i]
    mixed = sorted(brute_mix([(i, t, source[i]) for i, t in kept]), key=lambda r: (r[0], len(r[1].encode())))
    packed = slow_pack([len(t.encode()) + 1 for _, t, _ in mixed], 8192)
    want = [(w, mixed[d][0], start, at, n) for d, w, start, at, n in packed]
    got = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert _key(got) == _key(want)


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5), (2, "d e f", "fr", "t", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).schema == docs.schema
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "near dedup" and neardup and linededup
