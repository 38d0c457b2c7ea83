"""Cases that reviews found: queries against their SQL on odd documents, plans against one-thread rules."""

import json
import random

import pytest

ODD = [
    (1, "a\nb\na", "en", "s"), (2, "", "en", "s"), (3, "", "en", "s"), (4, " \n ", "en", "s"), (5, None, "en", "s"), (6, None, "en", "s"),
    (7, "a\nb\na", "en", None), (8, "a\nb\na", "en", None), (9, "a\nb\na", "en", "s"), (9, "a\nb\na", "en", "s"), (10, "\n", "en", "t"), (11, "\tB\nc ", "en", "t"), (None, "z\nc", "en", "t"),
]


@pytest.mark.parametrize("name", ["dedup_exact_in_shards", "dedup_lines"])
def test_odd_documents_follow_the_sql(spark, tmp_path, name):
    import duckdb

    import __spark_entry__ as e

    rows = [(k, t, lang, s, len(t or "")) for k, t, lang, s in ODD]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in e.queries()[name](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.sql(f"create view documents as from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.sql(e.oracle_sql()[name]).fetchall()
    assert sorted(got, key=str) == sorted(want, key=str)


def test_tokens_by_ranks_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    from loomsift.operators import packing as pk

    path = "/opt/tokenizers/byte_bpe_50k.json"
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    rng, signs = random.Random(1), ["a", "bc", "the", "Été", "ß", "ǆ", "'s", "'ll", "'", "!", "_", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\xad", "\0", "12", "²", "½", "…", "—", "\u2028", "\u3000", "中", "<|endoftext|>", "🙂", "ａ", "٣"]
    by_ranks = pk._by_ranks(whole)
    texts = ["", *["".join(rng.choices(signs[: rng.choice([16, 26, len(signs)])], k=rng.randint(1, 12))) for _ in range(20000)]]
    for t in texts:
        assert by_ranks(t) == whole.encode(t, add_special_tokens=False).ids, repr(t)
    assert pk._by_ranks(Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")) is None
    swapped = json.loads(whole.to_str())
    swapped["model"]["merges"][0], swapped["model"]["merges"][1] = swapped["model"]["merges"][1], swapped["model"]["merges"][0]
    assert pk._by_ranks(Tokenizer.from_str(json.dumps(swapped))) is None


def test_buckets_of_languages_are_those_of_all_ngrams(monkeypatch):
    import zlib

    import numpy as np

    from loomsift.functions import providers as pr

    rng = random.Random(2)
    signs = [*"abcABÉßİΣς²½٣_-'. \n\t", "中", "e\u0301", "\x1c", "\x85", "\u3000", "ab", "the ", "x" * 70]
    texts = ["", " ", "a", "1", *["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(3000)]]
    for t in texts:
        assert pr._buckets(t, 512).tolist() == np.unique([zlib.crc32(g.encode()) % 512 for g in pr.char_ngrams(t)]).tolist(), repr(t)
    long = " ".join(rng.choices(["alpha", "beta", "gamma"], k=300))
    pr._buckets(long, 512)
    monkeypatch.setattr(pr.zlib, "crc32", lambda _: 1 / 0)  # nothing is hashed again
    assert len(pr._buckets(long, 512)) > 10


def test_words_of_latin_texts_are_those_of_the_boundaries(monkeypatch):
    from loomsift.functions import words as wd

    rng, signs = random.Random(4), [chr(c) for c in range(0x250)]
    often = [*"aZé09_.,:;'\"-·  \n", "\r\n", "\t", "\xad", "e\u0301", "中"]
    texts = ["", *["".join(rng.choices(often if rng.random() < 0.6 else often + signs, k=rng.randint(1, 14))) for _ in range(60000)], *(f"a{c}a1{c}1 {c}{c}_{c}_" for c in signs)]
    boundary, _ = wd._boundary()
    for t in texts:
        want = [w for w in boundary.split(t) if w.strip()]
        assert wd.uax29(t) == want, repr(t)
        assert wd.uax29(t, True) == [w for w in want if w[0].isalnum()], repr(t)
    monkeypatch.setattr(wd, "_boundary", lambda: 1 / 0)
    assert wd.uax29("do not 1.5") == ["do", "not", "1.5"]


def test_fuzzy_dedup_writes_down_what_units_share_only(spark, monkeypatch):
    from loomsift.operators import dedup as dd

    frame = type(spark.range(1))
    sizes, kept = [], frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda df, *a, **kw: sizes.append((df.columns, df.count())) or kept(df, *a, **kw))
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(50)) + "\nthe same line") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for rule in ("old", "both", "naive"):
        got = dd.fuzzy_both(df, size=3, threshold=0.9, rule=rule)
        assert got.count() == 20 and any("hash" in c for c, _ in sizes)
        assert max(n for c, n in sizes if "hash" in c) <= 40
        sizes.clear()


@pytest.mark.parametrize("annotate", [False, True])
def test_substrings_are_those_of_the_rule_in_order(spark, monkeypatch, annotate):
    """no task holds a shard, and the cuts are those of one thread that goes through it."""
    from collections import defaultdict

    from loomsift.operators import dedup as dd
    from loomsift.operators import substrings as ss

    rng = random.Random(5)
    lines = [" ".join(rng.choices("abcdefgh é 中 don't 1.5 ½".split(), k=rng.randint(4, 25))) for _ in range(12)]
    texts = ["\n".join(rng.choice(lines) if rng.random() < 0.5 else " ".join(rng.choices("abcdefghijklmnop", k=rng.randint(1, 10))) for _ in range(rng.randint(0, 7))) for _ in range(100)]
    rows = [(rng.choice(["x", "y", None]), k, t) for k, t in enumerate(texts)]
    rows += [*rng.choices(rows, k=15), ("x", None, rows[3][2]), ("x", 200, None), ("y", 201, " \n")]
    seen, want = defaultdict(set), []
    for s, k, t in sorted((r for r in rows if r[2] and r[2].strip()), key=lambda r: (r[1] is None, r[1] or 0)):
        cut = dd.substring_cuts(t, seen[s], 3, 0.8, 6)
        left = "".join(t[a:b] for a, b in zip([0] + [e for _, e in cut], [a for a, _ in cut] + [len(t)]))
        if annotate or left.strip():
            want.append((k, t if annotate else left, [(len(t[:a].encode()), len(t[:b].encode())) for a, b in cut]))
    assert sum(bool(spans) for _, _, spans in want) > 20
    df = spark.createDataFrame(rows, "source string, doc_id long, text string").repartition(5)
    monkeypatch.setattr(ss, "BUCKET_BYTES", 2000)
    got = dd.sequential(df, "source", "doc_id", "text", size=3, threshold=0.8, least_tokens=6, annotate=annotate)
    assert "FlatMapGroupsInArrow" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted([(r.doc_id, r.text, [(x.s, x.e) for x in r.spans]) for r in got.collect()], key=str) == sorted(want, key=str)


@pytest.mark.parametrize("by", ["paragraph", "document"])
def test_decontamination_shuffles_no_documents(spark, monkeypatch, by):
    """one pass over the documents, with the rows of the join."""
    from loomsift.operators import dedup as dd

    rng = random.Random(8)
    items = [" ".join(rng.choices("abcdé", k=rng.randint(1, 12))) for _ in range(6)]
    texts = ["\n".join(rng.choice(items) + rng.choice(["", " b b", " q r s t"]) if rng.random() < 0.4 else " ".join(rng.choices("abcdéfgh", k=rng.randint(0, 9))) for _ in range(rng.randint(1, 5))) for _ in range(150)]
    docs = spark.createDataFrame([*enumerate(texts), (200, None), (201, " \n")], "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (9, None)], "item_id long, text string")
    how = {"size": 3, "threshold": 0.6, "by": by}
    got = dd.decontaminate(docs, bench, **how)
    assert "Exchange" not in got._jdf.queryExecution().sparkPlan().toString() and "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted(map(tuple, got.collect()), key=str)
    monkeypatch.setattr(dd, "PROBED", 0)
    assert rows == sorted(map(tuple, dd.decontaminate(docs, bench, **how).collect()), key=str)
    assert len(set(rows) & set(enumerate(texts))) < 140


def test_quality_is_fitted_on_stored_features_in_few_parts(spark, monkeypatch):
    """texts are cut into words once, and a round's gradients are as many as there are cores."""
    from loomsift.functions import providers as pr

    frame = type(spark.range(1))
    stored, keep = [], frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda df, *a, **kw: stored.append((df.columns, df.rdd.getNumPartitions())) or keep(df, *a, **kw))
    rows = [(i, f"{'good fine' if i % 2 else 'bad poor'} w{i}", float(i % 2)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label double").repartition(20)
    scored = pr.QualityModel.train(df).score(df)
    assert stored == [(["label", "_f"], spark.sparkContext.defaultParallelism)]
    assert all((r.quality_prob > 0.5) == (r.label > 0.5) for r in scored.collect())


def test_stripping_needs_no_regex(spark):
    """the signs that str.strip() takes from the ends, without a search through the text."""
    from pyspark.sql import functions as F

    from loomsift.functions import text as tx

    rng = random.Random(1)
    signs = [*map(chr, [*range(33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]), "a", "é", "中", "🙂", "​", "᠎"]
    rows = ["", None, *["".join(rng.choices(signs, k=rng.randint(0, 8))) for _ in range(5000)]]
    df = spark.createDataFrame([(t,) for t in rows], "t string").select("t", tx.strip(F.col("t")).alias("s"), tx.filled(F.col("t")).alias("f"))
    assert "regexp_replace" not in df._jdf.queryExecution().optimizedPlan().toString()
    for t, s, f in df.collect():
        assert (s, f) == ((None, None) if t is None else (t.strip(), t.strip() != "")), repr(t)


def test_exact_dedup_computes_its_rows_once(spark):
    """what comes before the dedup isn't computed again for rows without a key."""
    from pyspark.sql import functions as F

    from loomsift.operators import dedup as dd

    df = spark.createDataFrame([(k, None if k % 3 else f"u{k % 9}") for k in range(90)], "id long, url string").repartition(4)
    got = dd.exact(df, F.col("url"), [F.col("id")])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and got.columns == ["id", "url"]
    assert sorted(r.id for r in got.collect()) == sorted([0, 3, 6, *(k for k in range(90) if k % 3)])
