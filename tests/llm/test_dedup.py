"""Line dedup and near dedup against brute force."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from loomsift.llm import align, graph, linededup, neardup
from loomsift.llm.cuckoo import CuckooFilter

CLASH = "doc_id long, text string, gone string, hi long, pos int, nd_row int, ld_gone array<int>"


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    f = CuckooFilter.of(keys)
    assert f.contains(keys).all() and f.count == len(keys)
    others = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    assert f.contains(others).mean() < 0.001
    f.delete(keys[:10_000])
    assert f.contains(keys[10_000:]).all() and f.contains(keys[:10_000]).mean() < 0.001
    g = CuckooFilter.from_bytes(f.to_bytes())
    assert (g.table == f.table).all() and g.count == f.count == 10_000
    assert g.insert(keys[:5_000]) and g.contains(keys[:5_000]).all()


def brute_lines(rows):
    """rows: (doc_id, text); what stays, in order of ids."""
    seen, out, done = set(), [], set()
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if t is None or not t.strip(" \t\r\n"):
            out.append((i, t))
            continue
        if (i, t) in done:
            continue
        done.add((i, t))
        kept = []
        for x in t.split("\n"):
            if not x.strip(" \t\r"):
                kept.append(x)
            elif x not in seen:
                seen.add(x)
                kept.append(x)
        if any(x.strip(" \t\r") for x in kept):
            out.append((i, "\n".join(kept)))
    return out


def _texts(rng, n):
    lines = [f"line {i}" for i in range(30)] + ["", " ", "\t\r", "é line"]
    return ["\n".join(rng.choice(lines) for _ in range(rng.randint(1, 6))) for _ in range(n)]


def _order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))


def test_lines_against_brute_force(spark):
    rng = random.Random(4)
    rows = list(enumerate(_texts(rng, 60)))
    rows += [(100, None), (101, ""), (102, " \n\t"), (None, "line 1\nonly here"), (7, rows[7][1]), (103, "\n".join(f"row {i % 9000}" for i in range(20_000)))]
    df = spark.createDataFrame([(i, t, "g", 1, k, 2, [k]) for k, (i, t) in enumerate(rows)], CLASH)
    got = linededup.dedup_lines(df)
    assert got.columns == df.columns
    assert _order([(r.doc_id, r.text) for r in got.collect()]) == _order(brute_lines(rows))
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_line_store_is_reversible(spark):
    rng = random.Random(6)
    a, b, c = ([(k * 100 + i, t) for i, t in enumerate(_texts(rng, 25))] for k in range(3))
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    read = lambda df: _order([(r.doc_id, r.text) for r in df.collect()])
    store = linededup.new_store(spark)
    first = read(store.insert(make(a)))
    second = read(store.insert(make(b)))
    assert _order(first + second) == _order(brute_lines(a + b))
    store.insert(make(c)).count()
    store.delete(make(b + [(9999, "absent")]).select("doc_id"))
    fresh = linededup.new_store(spark)
    fresh.insert(make(a)).count()
    third = read(fresh.insert(make(c)))
    assert {tuple(r) for r in store.refs.collect()} == {tuple(r) for r in fresh.refs.collect()}
    assert read(store.view(make(a + c))) == _order(first + third)
    present = store.refs.select("hi", "lo")
    assert store.may_have(present).count() == present.count()
    store.drop()
    fresh.drop()


# ---- alignment and groups


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def alike(a, b, similarity):
    return bool(a) and bool(b) and 1 - edits(a, b) / max(len(a), len(b)) >= similarity - 1e-12


def test_alignment_against_brute_force():
    rng = np.random.default_rng(0)
    pairs = []
    for _ in range(250):
        a = rng.integers(0, 30, rng.integers(0, 60)).tolist()
        b = list(a)
        for _ in range(rng.integers(0, 14)):
            if b:
                i = int(rng.integers(len(b)))
                b[i : i + int(rng.integers(0, 2))] = rng.integers(0, 30, rng.integers(0, 2)).tolist()
        pairs.append((a, b))
    arrays = [(np.array(a, np.int32), np.array(b, np.int32)) for a, b in pairs]
    for s in (0.5, 0.8, 0.95):
        assert align.within(arrays, s).tolist() == [alike(a, b, s) for a, b in pairs]


def test_sketches_keep_order():
    p = neardup.Params(sketches=64, order=2, kmer=1)
    words = [f"w{i}" for i in range(40)]
    keys, n = neardup.order_minhash(pa.array([" ".join(words), " ".join(words[::-1]), " ".join(words).upper(), "", "one"]), p)
    assert n.tolist() == [40, 40, 40, 0, 1]
    assert (keys[0] == keys[2]).all() and (keys[0] == keys[1]).mean() < 0.1


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50), (50, 75), (-5, -5), (200, 201), (201, 200)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(41)) and got[100] == got[75] == 50 and got[201] == 200 and -5 not in got


def brute_groups(rows, similarity=0.8):
    words = [(t or "").lower().split() for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and alike(words[i], words[j], similarity):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def near_rows(seed=8, groups=25):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(30, 120))
        if g % 3 == 0:
            base = base[:20] + passage + base[20:]  # shared by many, which doesn't make them alike
        for _ in range(rng.choice([1, 1, 2, 3, 6])):
            copy = list(base)
            for _ in range(int(len(copy) * rng.choice([0, 0.02, 0.06]))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows()
    rows += [(500, None), (501, ""), (502, " \n "), (None, rows[0][1]), (1, rows[1][1]), (503, "hi"), (504, "HI "), (505, "x " * 30_000)]
    want = brute_groups(rows)
    keep = {}
    for k, (i, t) in enumerate(rows):
        keep.setdefault(want[k], []).append((i is None, i or 0, k))
    stay = {min(g)[2] for g in keep.values()}
    df = spark.createDataFrame([(i, t, "g", 1, k, 2, [k]) for k, (i, t) in enumerate(rows)], CLASH)
    left = neardup.drop_duplicates(df)
    assert left.columns == df.columns
    got = {r.pos for r in left.collect()}
    gone, right = set(range(len(rows))) - got, set(range(len(rows))) - stay
    assert len(gone & right) >= 0.9 * len(right) and gone <= right and len(right) > 20
    pairs = {(r.doc_id, r.duplicate_of) for r in neardup.duplicates(df).collect()}
    assert (504, 503) in pairs and (None, 0) in pairs
    assert neardup.drop_duplicates(df.limit(0)).count() == 0


def test_blocks_of_a_large_bucket(spark):
    """Buckets are compared in blocks; small blocks must give the same groups."""
    rows = near_rows(11, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    small = neardup.Params(block=8, order=1, kmer=1, sketches=4)
    a = {(r.doc_id, r.keep_id) for r in neardup.groups(df, small).collect()}
    b = {(r.doc_id, r.keep_id) for r in neardup.groups(df, neardup.Params(order=1, kmer=1, sketches=4)).collect()}
    assert a == b and a


def test_candidates_near_the_threshold_and_short_texts():
    rng = np.random.default_rng(11)
    for words, changed in ((400, 80), (100, 20), (100, 15), (30, 6), (20, 4), (20, 3), (10, 2), (10, 1), (5, 1)):
        one, two = [], []
        for _ in range(200):
            a = [f"w{x}" for x in rng.integers(0, 50_000, words)]
            b = list(a)
            for i in rng.choice(words, changed, replace=False):
                b[i] = f"x{rng.integers(1 << 40)}"
            one.append(" ".join(a))
            two.append(" ".join(b))
        (x, begin, _), (y, _, _) = (neardup.keys(pa.array(t), neardup.Params()) for t in (one, two))
        same = np.logical_or.reduceat(x == y, begin[:-1])
        assert same.mean() >= 0.95, (words, changed, same.mean())


def test_near_duplicates_with_text_ids_and_equal_hashes(spark):
    """Ids of another type, and first hashes so short that different texts share them, give the same groups."""
    rows = near_rows(seed=4, groups=12)
    df = spark.createDataFrame(rows, ["doc_id", "text"])
    whole = {(r.doc_id, r.duplicate_of) for r in neardup.duplicates(df).collect()}
    named = df.withColumn("doc_id", F.format_string("%09d", "doc_id"))
    got = {(int(r.doc_id), int(r.duplicate_of)) for r in neardup.duplicates(named, neardup.Params(hash_bits=5)).collect()}
    assert got == whole and len(whole) > 10
