"""Registry operators, stored n-gram sets, sampling, prefix sums and the pipelines as files."""

import hashlib
import os
import random
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from loomsift.functions import providers
from loomsift.functions import text as tx
from loomsift.operators import dedup as dd
from loomsift.operators import filters as fl
from loomsift.operators import packing as pk
from loomsift.plans import catalog as ct
from loomsift.plans import pipeline as pl
from loomsift.plans import registry
from loomsift.sources import jsonl
from tests import test_fuzzy as one_thread

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_draw_is_the_md5_of_seed_and_key(spark):
    rows = [(1, "a"), (2, "é"), (None, None)]
    got = spark.createDataFrame(rows, "id long, s string").select(tx.draw(F.col("id"), 5).alias("a"), tx.draw(F.col("s")).alias("b")).collect()
    slow = lambda seed, key: int(hashlib.md5(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:13], 16) / 2**52
    assert [(r.a, r.b) for r in got] == [(slow(5, i), slow(0, s)) for i, s in rows]


def test_urls_lose_strings_and_not_characters(spark):
    urls = ["http://www.bad.com/x", "http://BAD.com/", "http://wowbad.com", "http://a.b/best-casi.no", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    banned = spark.createDataFrame([("bad.com",)], "domain string")
    assert {r.url for r in fl.banned_domains(df, banned, ignored=["www."]).collect()} == set(urls[2:])
    assert {r.url for r in fl.banned_domains(df, banned, ignored=["www."], case_sensitive=True).collect()} == set(urls[1:])
    assert [r.url for r in df.where("url is not null").where(fl.url_substrings(F.col("url"), ["bestcasino"], ["-", "."])).collect()] == urls[:3]


@pytest.mark.parametrize("by", ["paragraph", "document"])
def test_runs_against_a_stored_set_are_one_long_run(spark, tmp_path, by):
    rows = one_thread.corpus()
    want = (one_thread.paragraphs if by == "paragraph" else one_thread.documents)(rows)
    path, got = f"file://{tmp_path}/seen", {}
    for part in (rows[:20], rows[20:35], rows[35:]):
        df = spark.createDataFrame(part, "doc_id long, text string")
        for update in (False, True):  # without an update, a run leaves no trace
            found = dd.fuzzy_incremental(df, path, size=one_thread.SIZE, threshold=one_thread.THRESHOLD, by=by, update=update)
        got.update({r.doc_id: r.text.removeprefix("\n") for r in found.collect()})
    assert got == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dd.fuzzy_incremental(empty, path, by=by).count() == 0


def test_annotation_with_counts(spark):
    df = spark.createDataFrame([(1, "a b c d\ne f g h"), (2, "a b c d\nx y z w"), (3, "")], "doc_id long, text string")
    grams = dd.unit_ngrams(dd.units_of(df, "doc_id", "text"), "doc_id", 3)
    got = {r.doc_id: r.duplicates for r in dd.annotated(df, dd.fuzzy(grams, "doc_id", 0.5), grams).collect()}
    assert [tuple(u) for u in got[1]] == [(0, 2, 0, True), (1, 2, 0, True)] and got[3] is None
    assert [tuple(u) for u in got[2]] == [(0, 2, 2, False), (1, 2, 0, True)]


def test_contexts_against_a_loop(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None, i]), [rng.randrange(100) for _ in range(rng.randint(0, 30))]) for i in range(120)]
    rows += [("a", 7, [1, 2, 3])] * 5 + [("c", 1, list(range(14))), ("a", 8, None)]
    df = spark.createDataFrame(rows, "source string, doc_id long, tokens array<int>")
    got = pk.contexts(df, "source", "doc_id", length=7, all_pad=True).collect()
    for shard in ("a", "b", "c", None):
        own = [r for r in got if r.source == shard]
        assert sorted(r.context for r in own) == list(range(len(own)))
        joined = [t for r in sorted(own, key=lambda r: r.context) for t in r.tokens]
        mine = [(r[1] is not None, r[1] or 0, r[2]) for r in rows if r[0] == shard and r[2]]
        total = sum(len(x[2]) for x in mine)
        assert len(joined) == (total // 7 + 1) * 7 and joined[total:] == [-1] * (len(joined) - total)
        at, left = 0, sorted(mine, key=lambda x: x[:2])
        while left:  # documents in order; those that tie, in any
            tied = [x for x in left if x[:2] == left[0][:2]]
            hit = next(x for x in sorted(tied, key=lambda x: -len(x[2])) if joined[at : at + len(x[2])] == x[2])
            left.remove(hit)
            at += len(hit[2])
    ranks = pk.shuffled(pk.contexts(df, "source", "doc_id", length=7), per_chunk=4).collect()
    assert sorted((r.chunk, r.place) for r in ranks) == [(i // 4, i % 4) for i in range(len(ranks))]


def test_language_model_holds_every_ngram(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, "the dog and the log", "en"), (4, None, "fr"), (5, "x", None)]
    model = providers.LanguageModel.train(spark.createDataFrame(rows, "id long, text string, lang string"))
    assert model.languages == ["en", "fr"]
    assert model.probabilities("the dog sat")["en"] > 0.9 and model.probabilities("le chat")["fr"] > 0.9
    n = {g: [sum(g in providers.char_ngrams(t) for _, t, x in rows if x == lang and t) for lang in ("en", "fr")] for g in ("the", "at", "q")}
    for g, counts in n.items():
        b = providers._buckets("", 1)  # no n-gram but that of a space
        assert len(b) == 1
        import zlib

        import numpy as np

        row = model.logs[zlib.crc32(g.encode()) % len(model.logs)]
        assert np.allclose(row, np.log((np.array(counts) + 0.5) / (np.array([2, 1]) + 1)), atol=1e-6), g


def test_registry_has_models_dedup_and_packing(spark, tmp_path):
    rows = [(i, ("fine words of good prose " if i % 2 else "junk spam click here ") * 3 + f"w{i}", "s", float(i % 2)) for i in range(60)] + [(99, None, "s", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, label double")
    spec = pl.Spec.parse("""
- source: s
  steps:
    - {func: classify_fasttext_hq_prob_enricher, key: good}
    - {func: quality_filter, key: good, threshold: 0.5}
    - {func: fuzzy_dedup, remove_type: document, ngram_size: 3, threshold: 0.8}
""", {"classify_fasttext_hq_prob_enricher": providers.QualityModel.train(df)})[0]
    kept = pl.compile(df, spec, observe=False).df.collect()
    assert [r.doc_id for r in kept] == [1] and kept[0].good > 0.5
    words = registry.make("detect_lang_paragraph_enricher", provider=lambda c: F.create_map(F.lit("en"), F.lit(1.0))).apply(df).collect()
    assert {r.doc_id: r.language_id_paragraph_own for r in words}[1]["en"].number_of_sentences == 1
    packed = registry.make("pack_contexts", length=16).apply(registry.make("tokenize", tokenizer_file="/opt/tokenizers/byte_bpe_50k.json").apply(df))
    assert {len(r.tokens) for r in packed.collect()} == {16}
    with pytest.raises(ValueError):
        registry.make("quality_filter", key="none").apply(df)
    assert registry.make("quality_filter", key="none", key_must_exist=False).apply(df).count() == 0
    stored = {"remove_type": "paragraph", "ngram_size": 3, "stored": f"file://{tmp_path}/set"}
    assert registry.make("fuzzy_dedup", **stored).apply(df).count() > 0 and registry.make("fuzzy_dedup", **stored).apply(df.where("doc_id = 1")).count() == 0


def test_a_changed_file_does_not_reuse_commits(spark, tmp_path):
    df = spark.createDataFrame([(1, "aa"), (2, "bbbbbb")], "doc_id long, text string")
    text = "- {source: s, steps: [{func: page_length_filter, length_type: char, min_length: %d}, commit]}"
    for least, n in ((1, 2), (3, 1), (1, 2)):
        run = pl.compile(df, pl.Spec.parse(text % least)[0], observe=False, commit_to=str(tmp_path))
        assert run.df.count() == n
    assert len(os.listdir(tmp_path)) == 2


def test_sources_of_lists_and_ban_lists(spark, tmp_path):
    import gzip

    (tmp_path / "crawl").mkdir()
    with gzip.open(tmp_path / "crawl" / "warc.paths.gz", "wt") as f:
        f.write("a/warc/1.warc.gz\nb/warc/2.warc.gz\n")
    assert sorted(r.path for r in jsonl.crawl_paths(spark, str(tmp_path / "crawl"), "s3://x/").collect()) == ["s3://x/a/warc/1.warc.gz", "s3://x/b/warc/2.warc.gz"]
    (tmp_path / "keys.txt").write_text("abc\nxabc\nabd\n")
    assert sorted(r.key for r in jsonl.keys(spark, str(tmp_path / "keys.txt"), "ab").collect()) == ["abc", "abd"]
    for kind, items in (("domains", "bad.com\n\n worse.com\n"), ("urls", "bad.com/x\nbad.com/x\n")):
        (tmp_path / "bans" / "adult").mkdir(parents=True, exist_ok=True)
        (tmp_path / "bans" / "adult" / kind).write_text(items)
    assert sorted(tuple(r) for r in jsonl.ban_list(spark, str(tmp_path / "bans"), ["adult"]).collect()) == [("adult", "domains", "bad.com"), ("adult", "domains", "worse.com"), ("adult", "urls", "bad.com/x")]
    assert [r.id for r in jsonl.head(spark.range(10), "id", fraction=0.3).collect()] == [0, 1, 2]
    assert ct.replace_prefix(F.col("x"), {"a": "b"}) is not None


def test_the_rest_works_with_the_llm_folders_deleted(tmp_path):
    for name in ("loomsift", "tests"):
        shutil.copytree(f"{ROOT}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    assert not (tmp_path / "loomsift" / "llm").exists() and not (tmp_path / "corpus_pipeline.py").exists()
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and e.oracle_sql().keys() <= q.keys() and not any(k.startswith('op') for k in q); import loomsift.plans.registry, loomsift.streaming.pages; print('good')"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("good"), done.stderr


def test_streams_keep_first_pages_and_count(spark, tmp_path):
    import json

    from loomsift.streaming import pages as st

    (tmp_path / "in").mkdir()
    rows = [("2024-01-01T00:00:00", "http://www.a.com/", "x"), ("2024-01-01T00:10:00", "https://a.com", "y"), ("2024-01-01T01:00:00", "http://b.com", "x"), ("2024-01-01T01:30:00", "http://b.com?utm_x=1", "x")]
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps({"ts": t, "url": u, "kind": k}) for t, u, k in rows[:3]))
    schema = "ts timestamp, url string, kind string"

    def run(build, out):
        stream = st.write(build(st.read(spark, str(tmp_path / "in"), schema)), str(tmp_path / out), str(tmp_path / f"{out}-state"))
        stream.awaitTermination(60)
        return spark.read.parquet(str(tmp_path / out)).collect()

    assert sorted(r.url for r in run(st.distinct_urls, "urls")) in (["http://b.com", "http://www.a.com/"], ["http://b.com", "https://a.com"])
    (tmp_path / "in" / "2.json").write_text(json.dumps({"ts": rows[3][0], "url": rows[3][1], "kind": rows[3][2]}))
    assert len(run(st.distinct_urls, "urls")) == 2  # the second run goes on from the state of the first
    (tmp_path / "in" / "3.json").write_text(json.dumps({"ts": "2024-01-05T00:00:00", "url": "http://z.com", "kind": "z"}))
    got = run(lambda s: st.counts(s, "ts", "kind"), "counts") and run(lambda s: st.counts(s, "ts", "kind"), "counts")
    assert {(r.kind, r.n, r.window.start.hour) for r in got} >= {("x", 1, 0), ("y", 1, 0), ("x", 2, 1)}


def test_tars_in_a_uri_and_statistics(spark, tmp_path):
    import json

    ctx = spark.createDataFrame([(0, i, [i, i + 1]) for i in range(5)], "chunk long, place int, tokens array<int>")
    assert pk.write_tars(ctx, f"file://{tmp_path}/tars").collect()[0].num_sequences == 5
    assert sorted(r.tokens for r in pk.read_tars(spark, f"file://{tmp_path}/tars").collect()) == [[i, i + 1] for i in range(5)]
    assert os.listdir(tmp_path / "tars") == ["shard_00000000.tar"]
    (tmp_path / "in.jsonl").write_text("\n".join(json.dumps({"text": t}) for t in ("a", "bb", "ccc")))
    spec = pl.Spec.parse("- {source: s, steps: [{func: page_length_filter, length_type: char, min_length: 2}]}")[0]
    rows = pl.process(spark, spec, str(tmp_path / "in.jsonl"), str(tmp_path / "out"))
    assert [(r["rows"], r["removed"], r["added"]) for r in rows] == [(3, 0, 0), (2, 1, 0)]
    stats = spark.read.json(jsonl.output_paths(str(tmp_path / "out"))["stats"]).orderBy("step").collect()
    assert [(r.name, r.pages_in, r.pages_out, r.removed) for r in stats] == [("input", 3, 3, 0), ("page_length_filter", 3, 2, 1), ("global", 3, 2, 1)]
