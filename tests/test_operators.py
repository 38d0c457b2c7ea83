"""Modifiers, aggregates, dedup, packing, catalog, pipelines and sources."""

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomsift.functions import normalize as nz
from loomsift.functions import words as wd
from loomsift.operators import aggregates as ag
from loomsift.operators import dedup as dd
from loomsift.operators import modifiers as md
from loomsift.operators import packing as pk
from loomsift.plans import catalog as ct
from loomsift.plans import pipeline as pl
from loomsift.plans import registry
from loomsift.sources import jsonl, warc


def T():
    return F.col("text")



def change(spark, column, *rows):
    return [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, text string").select(column.alias("v"), "i").orderBy("i").collect()]


def test_line_modifiers(spark):
    assert change(spark, md.drop_counters(T()), "3 likes\nkept\n5.1M views!\n9 lives", "7 shares", "1" * 5000 + " x") == ["kept\n9 lives", None, "1" * 5000 + " x"]
    assert change(spark, md.punctuated_lines(T(), True), "a.\nb\n\nc...\nd?", "x") == ["a.\n\nd?", None]
    assert change(spark, md.drop_lines_with(T(), ["cart"], max_words=2, match_only=True), "in cart\ncart\na b cart c") == ["in\na b cart c"]
    assert change(spark, md.drop_lines_with(T(), "read more...", where="suffix", match_only=True), "text Read more...\nother") == ["text\nother"]
    assert change(spark, md.uppercase_lines(T()), "ABc\nabc\n") == ["abc"]
    assert change(spark, md.numeric_lines(T(), 0.5), "12²a\nab1") == ["ab1"]
    assert change(spark, md.drop_citations(T()), "a[1] b[edit][] c[x]") == ["a b c[x]"]
    assert change(spark, md.drop_urls(T(), ["com"]), "see https://a.b.com/x?y ok", "at 10.0.0.1/z ok", "http://a.com") == ["see ok", "at ok", None]
    assert change(spark, md.dedup_within(T()), "a\nA \n\n\nb\na") == ["a\n\n\nb"]
    assert change(spark, md.squeeze_newlines(T()), "a\n\n\n\nb") == ["a\n\nb"]
    assert change(spark, md.lines_by_length(T(), 2), "a\na b\n\nc d") == ["a b\n\nc d"]


def test_paper_modifiers(spark):
    assert change(spark, md.cut_appendix(T()), r"a\appendix b", r"\begin{references}x", "c") == ["a", None, "c"]
    assert change(spark, md.drop_comments(T()), "% x\na\\% b c% d\ne") == ["a\\% b \ne"]
    assert change(spark, md.expand_macros(T()), "\\def\\x{y}\n\\x z \\xa", "none") == ["\\defy{y}\ny z \\xa", "none"]
    assert change(spark, md.from_first_section(T()), "pre \\section{A} b", "none", "p \\paragraph{x} q") == ["\\section{A} b", None, "\\paragraph{x} q"]
    assert change(spark, md.from_first_section(T(), joined_paragraph=True), "p \\paragraph{x} q", "p \\paragraph{x}\\subparagraph{y} q") == [None, "\\paragraph{x}\\subparagraph{y} q"]


def test_posts_and_repositories(spark):
    df = spark.createDataFrame([(("Q<li>1</li>",), [("a", 1), ("b", 5), ("c", None)]), (None, None)], "question struct<text:string>, answers array<struct<text:string,score:int>>")
    out = df.select(md.question_and_answers(F.col("question"), md.sort_answers(F.col("answers"))).alias("t")).collect()
    assert [r.t for r in out] == ["Q: Q<li>1</li>\nA: b\nA: a\nA: c", None]
    assert [r.question.text if r.question else None for r in md.on_posts(df, md.mark_lists).collect()] == ["Q\n*1", None]
    repos = spark.createDataFrame([("r", None, [(f"f{i}", f"t{i}") for i in range(5)])], "repo_name string, text string, files array<struct<filename:string,text:string>>")
    assert [len(r.files) for r in md.split_repositories(repos, 2).collect()] == [2, 2, 1]
    told = repos.select(md.format_repository(F.col("files"), F.col("repo_name"), F.col("repo_name"), 1.0)).first()[0]
    assert told.startswith("<repo_name>r<file_sep>f0\nt0<file_sep>f1")
    assert md.html_paragraphs("<p>a&amp;b<script>x</script></p>c<br><br>d") == ["a&b", "c", "d"]


def test_percentiles_as_numpy(spark):
    rng = random.Random(1)
    for n in (1, 2, 5, 39):
        values = [float(rng.randint(0, 20)) for _ in range(n)]
        got = ag.percentiles(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()
        for name, q in ag.PERCENTILES.items():
            assert got[name] == np.percentile(values, q * 100, method="nearest"), (n, name)
        assert got["mean"] == pytest.approx(np.mean(values))
    h = ag.histogram(spark.createDataFrame([(v,) for v in [1.0, 1.0, 2.0, 11.0]], "v double"), "v").orderBy("left_edge").collect()
    assert [r.n for r in h] == np.histogram([1, 1, 2, 11], 10)[0].tolist()
    assert ag.histogram(spark.createDataFrame([(3.0,)], "v double"), "v").agg(F.sum("n")).first()[0] == 1


def sequential_rule(rows, size, threshold):
    """The rule as one thread would apply it, paragraph by paragraph."""
    seen, kept = set(), {}
    for key, text in sorted(rows):
        for u, piece in enumerate(text.split("\n")):
            tokens = wd.uax29(piece if u == 0 else "\n" + piece)
            grams = [tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)]
            if not grams:
                continue
            kept[key, u] = not sum(g in seen for g in grams) / len(grams) > threshold
            if kept[key, u]:
                seen.update(grams)
    return kept


def test_fuzzy_dedup_is_the_sequential_rule(spark):
    rng = random.Random(5)
    for round_ in range(2):
        rows = [(i, "\n".join(" ".join(rng.choices("abc", k=rng.randint(1, 8))) for _ in range(rng.randint(1, 4)))) for i in range(25)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = dd.fuzzy(dd.unit_ngrams(dd.units_of(df, "doc_id", "text"), "doc_id", 2), "doc_id", 0.6)
        assert {(r.doc_id, r.unit): r.kept for r in got.collect()} == sequential_rule(rows, 2, 0.6)


def test_exact_dedup(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"], 9), (2, ["B ", "c"], 1), (3, ["a"], 5)], "doc_id long, units array<string>, k long")
    out = {r.doc_id: r.units for r in dd.exact_units(df, "units", nz.whitespace_and_case, [F.col("k")], "doc_id").collect()}
    assert out == {2: ["B ", "c"], 3: ["a"]}


def test_spans():
    assert dd.merge_spans([(5, 7), (0, 2), (2, 3)]) == [(0, 3), (5, 7)]
    assert dd.invert_spans([(2, 3)], 5) == [(0, 2), (3, 5)]
    assert dd.bridge_spans([(0, 8), (9, 20)], 0.9) == [(0, 20)] and len(dd.bridge_spans([(0, 2), (9, 10)], 0.9)) == 2
    seen = set()
    text = " ".join(f"w{i}" for i in range(30))
    assert dd.substring_cuts(text, seen, 5, 1.0, 10) == []
    assert dd.substring_cuts("x " + text + " y", seen, 5, 1.0, 10) == [(2, 2 + len(text))]


def test_packing_and_tars(spark, tmp_path):
    rng = random.Random(2)
    rows = [(s, i, [rng.randint(1, 99) for _ in range(rng.choice([0, 3, 10, 57]))]) for s in "ab" for i in range(9)]
    df = spark.createDataFrame(rows, "source string, doc_id long, tokens array<int>")
    got = pk.contexts(pk.end_marked(df), "source", "doc_id", length=10).collect()
    for s in "ab":
        stream = [t for x, _, toks in sorted(rows) if x == s for t in [*toks, 0]]
        want = [stream[i : i + 10] for i in range(0, len(stream), 10)]
        assert [r.tokens for r in sorted(got) if r.source == s] == [w + [-1] * (10 - len(w)) for w in want]
    chunks = pk.shuffled(pk.contexts(pk.end_marked(df), "source", "doc_id", length=10), 1, per_chunk=8)
    shards = pk.write_tars(chunks, str(tmp_path / "tars")).collect()
    assert sum(r.num_sequences for r in shards) == len(got) == pk.manifest(chunks).agg(F.sum("num_sequences")).first()[0]
    assert sorted(tuple(r.tokens) for r in pk.read_tars(spark, str(tmp_path / "tars")).collect()) == sorted(tuple(r.tokens) for r in got)


def test_catalog():
    assert ct.number("1.5B") == 1.5e9 and ct.number("300") == 300
    for bad in ("x", "a>b"):
        with pytest.raises(ValueError):
            ct.number(bad)
    with pytest.raises(ValueError):
        ct.condition("nothing")


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "name string, age long")
    for codec in ("none", "gzip"):
        jsonl.write(df, f"{tmp_path}/{codec}", codec)
        for f in jsonl._files(spark, f"{tmp_path}/{codec}")[2].listStatus(jsonl._files(spark, f"{tmp_path}/{codec}")[1]):
            assert "json" in f.getPath().getName() or f.getPath().getName().startswith("_")
        assert sorted(spark.read.json(f"{tmp_path}/{codec}").select("name", "age").collect()) == [("a", 1), ("b", 2)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.jsonl").write_text('{"text": "one"}\n')
    (tmp_path / "in/y.jsonl.gz").write_bytes(gzip.compress(b'{"text": "two"}\n'))
    (tmp_path / "in/z.txt").write_text("no")
    assert sorted(r.text for r in jsonl.read(spark, f"{tmp_path}/in", "text string").collect()) == ["one", "two"]
    assert len(jsonl.list_files(spark, f"{tmp_path}/in")) == 2
    record = lambda kind, url, body: f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    (tmp_path / "w").mkdir()
    raw = [record("warcinfo", "", b"info"), record("response", "http://a", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n<p>hi</p>"), record("request", "http://a", b"no")]
    (tmp_path / "w/a.warc.gz").write_bytes(b"".join(map(gzip.compress, raw)))
    got = warc.with_url(warc.read(spark, f"{tmp_path}/w", extract=True)).collect()
    assert [(r.text, r.url, r.warcinfo) for r in got] == [("hi", "http://a", "info")]


def test_pipelines(spark, tmp_path):
    text = """
- source: x
  steps:
    - {func: page_length_filter, length_type: char, min_length: 3}
    - {func: word_counter_enricher, model: split}
    - commit
    - {func: pattern_splitter, pattern: "b+"}
"""
    spec = pl.Spec.parse(text)[0]
    df = spark.createDataFrame([("abba",), ("b",), ("bob",)], "text string")
    run = pl.compile(df, spec, commit_to=str(tmp_path / "run"))
    assert sorted(r.text for r in run.df.collect()) == ["b", "b", "bb"]
    assert [s["name"] for s in run.funnel() if s["step"] == 4]
    with pytest.raises(KeyError):
        pl.Spec.parse("- {source: x, steps: [{func: unknown_operator}]}")
    with pytest.raises(ValueError):
        registry.make("..evil.thing")

    def twice(row):
        if row["text"] == "b":
            raise RuntimeError("no")
        return [row, row]

    out = registry.row_function(twice, "text string")(df).collect()
    assert len(out) == 5 and sum(r._error is not None for r in out) == 1


def test_entry_without_the_llm_folders():
    import __spark_entry__ as entry
    from loomsift.queries import ORACLE_SQL, QUERIES

    assert QUERIES.keys() <= entry.queries().keys() and ORACLE_SQL.keys() <= QUERIES.keys()


def test_perplexity_keeps_all_ngrams_that_occur_twice(spark):
    from collections import Counter

    from loomsift.functions import providers
    from loomsift.operators import enrichers as en

    rng = random.Random(3)
    texts = [" ".join(f"w{min(rng.randint(0, 30), rng.randint(0, 30))}" for _ in range(rng.randint(1, 30))) for _ in range(60)]
    texts = [t + "\n\n" + u for t, u in zip(texts, texts[1:])] + [None, " ", texts[0], texts[0]]
    counts = Counter()
    for t in texts:
        for line in (t or "").split("\n"):
            if line.strip():
                w = ["<s>", "<s>", *line.split(), "</s>"]
                counts.update(tuple(w[i - n + 1 : i + 1]) for i in range(2, len(w)) for n in (1, 2, 3))
    ones = [g for g in counts if len(g) == 1]
    total, words = sum(counts[g] for g in ones), len(ones) + 1
    counts = {g: n for g, n in counts.items() if n >= 2}

    def want(t):
        lines, score, tokens = [x for x in (t or "").split("\n") if x.strip()], 0.0, 0
        for line in lines:
            w = ["<s>", "<s>", *line.split(), "</s>"]
            for i in range(2, len(w)):
                p = 0.2 * (counts.get((w[i],), 0) + 1) / (total + words)
                for weight, g in ((0.3, tuple(w[i - 1 : i + 1])), (0.5, tuple(w[i - 2 : i + 1]))):
                    if counts.get(g[:-1], 0):
                        p += weight * counts.get(g, 0) / counts[g[:-1]]
                score, tokens = score + np.log10(p), tokens + 1
        return (score, tokens) if tokens else None

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = providers.NgramModel.train(df)
    assert model.table.count() == len(counts)
    got = {r.doc_id: r.s for r in model.score(df, F.col("text"), "s").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        w = want(t)
        assert (got[i] is None) == (w is None)
        if w:
            assert got[i].tokens == w[1] and abs(got[i].log10_prob - w[0]) < 1e-6
    assert en.perplexity_of(df, F.col("text"), model, "p").columns == ["doc_id", "text", "p"]


def test_perplexity_shuffles_no_row_for_an_ngram(spark, monkeypatch):
    """n-grams travel as slices of many; the same scores by many keys and chunks, and of more texts than the model is from."""
    from loomsift.functions import ngrams, providers

    rng = random.Random(4)
    texts = ["\n".join(" ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(0, 4))) for _ in range(300)]
    few = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:40])], "doc_id long, text string")
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, "<s> <s> a </s>", texts[0]])], "doc_id long, text string")
    got = []
    for tokens, size in ((1 << 20, 16 << 20), (300, 400)):
        monkeypatch.setattr(ngrams, "TOKENS", tokens)
        monkeypatch.setattr(ngrams, "KEY_BYTES", size)
        model = providers.NgramModel.train(few)
        out = model.score(df, F.upper("text"), "s", by=F.col("text")), model.score(df, F.col("text"), "s")
        got.append([{r.doc_id: r.s and (round(r.s.log10_prob, 9), r.s.tokens) for r in o.collect()} for o in out])
        plan = out[1]._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan and plan.count("Join") == 1
        assert model.slices.count() * 10 < model.table.count() if size > 400 else model.bits > 1
    assert got[0] == got[1] and len(got[0][1]) == len(texts) + 3 and got[0][0] != got[0][1] and got[0][1][0] == got[0][1][len(texts) + 2]


def test_quality_query_scores_every_document(spark):
    from loomsift.queries import QUERIES

    d = "/root/testdata/sf0.001"
    got = QUERIES["enrich_quality"](spark, d)
    ids = spark.read.parquet(f"{d}/documents.parquet").select("doc_id")
    assert got.columns == ["doc_id", "quality_prob"]
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in ids.collect())
    assert got.where("quality_prob is null or quality_prob < 0 or quality_prob > 1").count() == 0
