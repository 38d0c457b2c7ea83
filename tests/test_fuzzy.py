"""Fuzzy dedup against the one-thread rules, document after document with a set that grows."""

import random

import pytest

from loomsift.functions import words as wd
from loomsift.operators import dedup as dd

SIZE, THRESHOLD = 3, 0.6


def grams(tokens):
    return [tuple(tokens[i : i + SIZE]) for i in range(len(tokens) - SIZE + 1)]


def by_units(rows, whole=False):
    seen, out, shares = set(), {}, {}
    for k, text in rows:
        parts = [text] if whole else text.split("\n")
        kept, hit_all, n_all = [], 0, 0
        for p in parts:
            own = grams(wd.uax29(p))
            hit = sum(g in seen for g in own)
            hit_all, n_all = hit_all + hit, n_all + len(own)
            if own and hit / len(own) > THRESHOLD:
                continue
            seen.update(own)
            kept.append(p)
        out[k], shares[k] = "\n".join(kept), hit_all / n_all if n_all else 0
    return out, shares


def paragraphs(rows):
    return {k: t for k, t in by_units(rows)[0].items() if t.strip()}


def documents(rows):
    return {k: t for k, t in by_units(rows, whole=True)[0].items() if t.strip()}


def old(rows):
    out, shares = by_units(rows)
    return {k: t for k, t in out.items() if t.strip() and shares[k] <= THRESHOLD}


def naive(rows):
    left = documents(rows)
    return paragraphs([(k, t) for k, t in rows if k in left])


def both(rows):
    seen, out = set(), {}
    for k, text in rows:
        parts = [wd.uax29(p) for p in text.split("\n")]
        tokens, of = [w for p in parts for w in p], [i for i, p in enumerate(parts) for _ in p]
        own = [(g, of[i], of[i + SIZE - 1]) for i, g in enumerate(grams(tokens))]
        if own and sum(g in seen for g, _, _ in own) / len(own) >= THRESHOLD:
            continue
        cut = set()
        for i in range(len(parts)):
            mine = [g for g, a, z in own if a == z == i]
            if mine and sum(g in seen for g in mine) / len(mine) >= THRESHOLD:
                cut.add(i)
        seen.update(g for g, a, z in own if not cut & set(range(a, z + 1)))
        out[k] = "\n".join(p for i, p in enumerate(text.split("\n")) if i not in cut)
    return {k: t for k, t in out.items() if t.strip()}


def corpus():
    rng = random.Random(3)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(25)]
    rows = []
    for k in range(60):
        own = [rng.choice(lines) if rng.random() < 0.5 else " ".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 10))) for _ in range(rng.randint(1, 5))]
        rows.append((k, rng.choice(rows)[1] if rows and rng.random() < 0.1 else "\n".join(own)))
    return rows


@pytest.mark.parametrize("rule", ["paragraphs", "documents", "old", "both", "naive"])
def test_rules(spark, rule):
    rows = corpus()
    df = spark.createDataFrame([*rows, (100, None), (101, ""), (102, " \n ")], "doc_id long, text string")
    how = {"size": SIZE, "threshold": THRESHOLD}
    got = dd.fuzzy_paragraphs(df, **how) if rule == "paragraphs" else dd.fuzzy_documents(df, **how) if rule == "documents" else dd.fuzzy_both(df, rule=rule, **how)
    want = globals()[rule](rows)
    # the first piece that is left may begin with its newline
    assert {r.doc_id: r.text.removeprefix("\n") for r in got.collect()} == want
    assert len(want) < len(rows)


def test_rows_without_a_key_stay(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "a"), (5, "")], "id long, url string")
    assert sorted(r.id for r in dd.exact(df, F.col("url"), [F.col("id")]).collect()) == [1, 2, 3, 5]
