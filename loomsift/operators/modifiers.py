"""Modifiers: text in, text out.

A modifier returns a column; null means that the page is dropped, which most do
when nothing is left. Use `apply` to replace a column and drop such rows.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import words as wd

BACKSLASH = r"\\"


def apply(df: DataFrame, column: str, value: Column) -> DataFrame:
    """df with the modified column, without the rows for which it is null.

    The value goes through a generator of one row. Otherwise the optimizer would
    push the test for null below the projection, and compute the whole chain of
    modifiers again for each step of a pipeline.
    """
    names = [c for c in df.columns if c != column]
    out = df.select(*[F.col(f"`{c}`") for c in names], F.explode(F.array(value)).alias(column)).where(F.col(column).isNotNull())
    return out.select(*[F.col(f"`{c}`") for c in df.columns]) if column in df.columns else out


# ---- code and papers


def split_repositories(repos: DataFrame, most: int = 1000, files: str = "files", text: str | None = "text") -> DataFrame:
    """A repository of more than `most` files becomes several rows, of consecutive files; their text is then null."""
    parts = F.greatest(F.ceil(F.size(files) / most), F.lit(1)).cast("int")
    slices = F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.slice(files, i * most + 1, F.lit(most)))
    many = F.size(files) > most
    columns = [(F.when(~many, F.col(c)).alias(c) if c == text else F.col(c)) for c in repos.columns if c != files]
    return repos.select(*columns, F.explode(F.when(many, slices).otherwise(F.array(files))).alias(files))


def format_repository(files: Column, name: Column, key: Column, with_names: float = 0.5, sentinels: bool = True, seed: int = 0) -> Column:
    """All files of a repository as one text; a seeded coin on `key` decides whether names are told."""
    named = tx.draw(key, seed) < with_names
    mark = F.lit("<file_sep>" if sentinels else "\n\n")
    plain = F.array_join(F.transform(files, lambda f: F.concat(mark, f["text"])), "")
    told = F.concat(F.lit("<repo_name>" if sentinels else ""), name, F.array_join(F.transform(files, lambda f: F.concat(mark, f["filename"], F.lit("\n"), f["text"])), ""))
    out = F.when(named, told).otherwise(plain)
    return out if sentinels else tx.strip(out)


def cut_appendix(text: Column) -> Column:
    """Ends a LaTeX source before its appendix or bibliography."""
    heads = "|".join([r"\\appendix", *[rf"\\begin\{{{x}\}}" for x in ("references", "REFERENCES", "thebibliography")], r"\\bibliography\{.*?\}"])
    return tx.if_kept(F.regexp_replace(text, f"(?s)(?:{heads}).*", ""))


def drop_comments(text: Column, environments: bool = False) -> Column:
    """LaTeX comments: whole lines, then line ends from an unescaped % (and the character before it), then comment environments."""
    out = F.regexp_replace(text, r"(?md)^%.*\n?", "")
    out = F.regexp_replace(out, r"(?md)[^\\]%.+$", "")
    if environments:
        out = F.regexp_replace(out, r"(?s)\\begin\{comment\}.*?\\end\{comment\}", "")
    return tx.if_kept(out)


_NAME, _BODY = r"(\\[0-9A-Za-z]+)", r"\{(.*?)\}$"
_NEW_COMMAND = re.compile(r"\\newcommand\b[*]?[{]" + _NAME + "[}]" + _BODY, re.M)
_DEF = re.compile(r"\\def\s*" + _NAME + r"\s*" + _BODY, re.M)


def expand_macros_in(text: str) -> str:
    """Macros without arguments, in the order of their definitions, wherever no letter or digit follows; their definitions are replaced as well."""
    found: dict[str, str] = {}
    for pattern in (_NEW_COMMAND, _DEF):
        for m in pattern.finditer(text):
            found[m.group(1)] = m.group(2)
    for name, value in found.items():
        text = re.sub(re.escape(name) + "(?=[^0-9A-Za-z])", lambda m, v=value: v, text)
    return text


def expand_macros(text: Column) -> Column:
    run = F.arrow_udf(lambda a: pa.array([None if t is None else expand_macros_in(t) for t in a.to_pylist()], pa.string()), "string")
    return tx.if_kept(run(text))


def from_first_section(text: Column, joined_paragraph: bool = False) -> Column:
    r"""Drops what comes before the first sectioning command; a text without one goes.

    joined_paragraph: \paragraph counts only where \subparagraph follows it at
    once, as published pipelines have it.
    """
    one = r"\\(?:chapter|part|section|subsection|subsubsection{})\b\*?(?:\[.*?\])?\{{.*?\}}"
    if joined_paragraph:
        tail = r"\b\*?(?:\[.*?\])?\{.*?\}"
        head = f"(?:{one.format('')}|" + r"\\paragraph" + tail + r"\\subparagraph" + tail + ")"
    else:
        head = one.format("|paragraph|subparagraph")
    return F.when(text.rlike(f"(?s){head}"), tx.if_kept(F.regexp_replace(text, rf"(?s)\A.*?(?={head})", "")))


# ---- questions and answers


def mark_lists(text: Column) -> Column:
    """HTML list items as lines with a star."""
    out = text
    for old, new in (("<li>", "\n*"), ("</li>", ""), ("<ol>", "\n*"), ("</ol>", "")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def on_posts(df: DataFrame, change, question: str = "question", answers: str = "answers") -> DataFrame:
    """Changes the text of the question and of each answer."""
    return df.withColumn(question, F.col(question).withField("text", change(F.col(question)["text"]))).withColumn(answers, F.transform(answers, lambda a: a.withField("text", change(a["text"]))))


def sort_answers(answers: Column, descending: bool = True) -> Column:
    """By score, a missing one as 0; equal scores keep their order."""
    keyed = F.transform(answers, lambda a, i: F.struct((F.coalesce(a["score"], F.lit(0)) * (-1 if descending else 1)).alias("k"), i.alias("i"), a.alias("a")))
    return F.transform(F.array_sort(keyed, lambda x, y: F.when(x["k"] < y["k"], -1).when(x["k"] > y["k"], 1).otherwise(x["i"] - y["i"])), lambda x: x["a"])


def question_and_answers(question: Column, answers: Column) -> Column:
    """Q: and A: lines; without a question the page goes."""
    tail = F.array_join(F.transform(F.coalesce(answers, F.array().cast("array<struct<text:string,score:int>>")), lambda a: F.concat(F.lit("\nA: "), a["text"])), "")
    return F.when(question.isNotNull(), F.concat(F.lit("Q: "), question["text"], tail))


def conversations_as_text(turns: DataFrame) -> DataFrame:
    """(conv_id, text): the turns of each conversation in order, as question and answer lines."""
    line = F.concat(F.when(F.col("role") == "user", "Q: ").otherwise("A: "), F.coalesce("text", F.lit("")))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))


# ---- HTML

_BLOCKS = frozenset("address article aside blockquote body caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol option p pre section table tbody td tfoot th thead tr ul".split())
_HIDDEN = frozenset("script style head noscript template".split())


class _Paragraphs(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.done: list[str] = []
        self.parts: list[str] = []
        self.hidden = 0
        self.breaks = 0

    def close_paragraph(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.done.append(text)
        self.parts.clear()

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in _HIDDEN
        if tag == "br":
            self.breaks += 1
            self.parts.append(" ")
            if self.breaks > 1:
                self.close_paragraph()
        elif tag in _BLOCKS:
            self.close_paragraph()

    def handle_endtag(self, tag):
        if tag in _HIDDEN and self.hidden:
            self.hidden -= 1
        if tag in _BLOCKS:
            self.close_paragraph()

    def handle_data(self, data):
        if not self.hidden:
            if data.strip():
                self.breaks = 0
            self.parts.append(data)


def html_paragraphs(page: str) -> list[str]:
    parser = _Paragraphs()
    parser.feed(page)
    parser.close()
    parser.close_paragraph()
    return parser.done


def _html(joiner: str):
    def run(a: pa.Array) -> pa.Array:
        return pa.array([None if t is None else joiner.join(html_paragraphs(t)) for t in a.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")


def html_text(page: Column) -> Column:
    """All paragraphs of a page with blank lines between them; a page without one goes."""
    return tx.if_kept(_html("\n\n")(page))


def post_text(body: Column) -> Column:
    """The text of an HTML fragment, lines for its paragraphs; stays even if empty."""
    return _html("\n")(body)


def on_posts_html(df: DataFrame, question: str = "question", answers: str = "answers") -> DataFrame:
    """The posts of a page from HTML to text, all of them in one Arrow call."""

    def run(a: pa.Array) -> pa.Array:
        return pa.array([None if x is None else [None if t is None else "\n".join(html_paragraphs(t)) for t in x] for x in a.to_pylist()], pa.list_(pa.string()))

    raw = F.concat(F.array(F.col(question)["text"]), F.coalesce(F.transform(answers, lambda x: x["text"]), F.array().cast("array<string>")))
    out = df.withColumn("_posts", F.arrow_udf(run, "array<string>")(raw))
    out = out.withColumn(question, F.col(question).withField("text", F.col("_posts")[0]))
    return out.withColumn(answers, F.transform(answers, lambda x, i: x.withField("text", F.element_at("_posts", (i + 2).cast("int"))))).drop("_posts")


# ---- columns


def url_from_metadata(df: DataFrame, metadata: str = "metadata", field: str = "WARC-Target-URI") -> DataFrame:
    return df.withColumn("url", F.col(metadata)[field])


def rename(df: DataFrame, old: str = "content", new: str = "text", overwrite: bool = False) -> DataFrame:
    """Renames a column. Nothing happens if it is absent, or if the new name is taken and may not be overwritten."""
    if old not in df.columns or new in df.columns and not overwrite:
        return df
    return df.drop(new).withColumnRenamed(old, new) if new in df.columns else df.withColumnRenamed(old, new)


# ---- lines


def _lines(text: Column, keep) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), keep), "\n")


def drop_lines_with(text: Column, banned: list[str] | str, case_sensitive: bool = False, where: str = "any", max_words: int | None = None, match_only: bool = False) -> Column:
    """Lines with a match go (or the match alone goes, and the line if it is then blank). Lines of more than max_words words stay. The page is stripped; an empty one goes."""
    items = [banned] if isinstance(banned, str) else banned
    core = tx.any_of(items, case_sensitive=True).removeprefix("(?d)")
    body = {"prefix": rf"^{core}\s?", "suffix": rf"\s?{core}$", "any": rf"\s?{core}"}[where]
    pattern = ("(?d)" if case_sensitive else "(?iud)") + body
    looked = lambda x: x.rlike(pattern) if max_words is None else x.rlike(pattern) & (F.size(tx.words(x)) <= max_words)
    if match_only:
        changed = F.transform(F.split(text, "\n"), lambda x: F.when(looked(x), F.regexp_replace(x, pattern, "")).otherwise(x))
        pairs = F.filter(F.arrays_zip(changed.alias("new"), F.split(text, "\n").alias("old")), lambda p: (p["new"] == p["old"]) | (tx.strip(p["new"]) != ""))
        out = F.array_join(F.transform(pairs, lambda p: p["new"]), "\n")
    else:
        out = _lines(text, lambda x: ~looked(x))
    return tx.if_kept(tx.strip(out))


def punctuated_lines(text: Column, drop_ellipses: bool = False) -> Column:
    """Lines that end in . ! ? \" or … stay, and empty ones."""
    space = f"[{tx.SPACE}]*"
    ok = lambda x: (x == "") | x.rlike(rf"[.!?\"…]{space}\z")
    if drop_ellipses:
        return tx.if_kept(_lines(text, lambda x: ok(x) & ~x.rlike(rf"(?:\.\.\.|…){space}\z")))
    return tx.if_kept(_lines(text, ok))


def lines_by_length(text: Column, least: int = 0, most: float = float("inf")) -> Column:
    """Lines with so many words stay, and empty ones."""
    return tx.if_kept(_lines(text, lambda x: (x == "") | ((F.size(tx.words(x)) >= least) & (F.size(tx.words(x)) <= F.lit(float(most))))))


def lines_by_longest_word(text: Column, most: int = 1000, model: str = "split") -> Column:
    """Lines whose longest word has at most so many characters stay."""
    if model == "split":
        return tx.if_kept(_lines(text, lambda x: F.coalesce(F.array_max(F.transform(tx.words(x), lambda w: F.length(w))), F.lit(0)) <= most))

    def run(a: pa.Array) -> pa.Array:
        return pa.array([None if t is None else "\n".join(x for x in t.split("\n") if max(map(len, wd.uax29(x)), default=0) <= most) for t in a.to_pylist()], pa.string())

    return tx.if_kept(F.arrow_udf(run, "string")(text))


def _ratio_lines(text: Column, pattern: str, most: float) -> Column:
    share = lambda x: F.coalesce(F.try_divide(F.length(F.regexp_replace(x, f"[^{pattern}]", "")), F.length(x)), F.lit(0.0))
    return tx.if_kept(tx.strip(_lines(text, lambda x: share(x) <= most)))


def uppercase_lines(text: Column, most: float = 0.5) -> Column:
    """Lines with a larger share of capitals go."""
    return _ratio_lines(text, r"\p{Lu}", most)


def numeric_lines(text: Column, most: float = 1.0) -> Column:
    return _ratio_lines(text, tx.DIGIT, most)


def drop_citations(text: Column) -> Column:
    """[12], [], [edit] and [citation needed]."""
    return F.regexp_replace(text, r"\[(?:\p{Nd}*|edit|citation needed)\]", "")


def drop_urls(text: Column, domains: list[str], strict_gate: bool = False) -> Column:
    """URLs whose host ends in one of the top-level domains, then URLs with an IPv4 address, and up to ten spaces before. strict_gate: the former only where the text itself begins with a domain."""
    tops = "|".join(re.escape(d) for d in sorted(domains, key=lambda d: (-len(d), d)))
    tail = r"[0-9A-Za-z()@:%_+.~#?&/=\-]*"
    scheme = "(?:(?:ftp|https?)://)?"
    named = rf"(?U)\s{{0,10}}{scheme}[0-9A-Za-z@:%._+~#=\-]{{1,256}}\.(?:{tops})\b{tail}"
    byte = "[012]?[0-9][0-9]?"
    numbered = rf"(?U)\s{{0,10}}\b{scheme}(?:{byte}\.){{3}}{byte}{tail}"
    gate = text.rlike(rf"\A(?:{tops})") if strict_gate else text.rlike(rf"\.(?:{tops})")
    out = F.when(gate, F.regexp_replace(text, named, "")).otherwise(text)
    return tx.if_kept(F.regexp_replace(out, numbered, ""))


COUNTED = ("bookmarks", "comments", "downloads", "downvotes", "followers", "likes", "quotes", "reposts", "retweets", "shares", "upvotes", "views")


def drop_counters(text: Column) -> Column:
    """Lines that are a counter and nothing else, such as "3 likes" or "5.1M views!". Quantifiers are possessive: no backtracking on long digit strings."""
    pattern = rf"(?U)\A\W*+\d[\d,.]*+[kmb]?+\s++(?:{'|'.join(COUNTED)})\W*+\z"
    return tx.if_kept(tx.strip(_lines(text, lambda x: ~F.lower(x).rlike(pattern))))


def dedup_within(text: Column, unit: str = "line", normalize: bool = True) -> Column:
    """Keeps the first of equal lines or paragraphs, and all blank ones; never drops the page. One pass with a set, so it is linear in the units."""
    mark = {"line": "\n", "paragraph": "\n\n"}[unit]

    def run(a: pa.Array) -> pa.Array:
        out = []
        for t in a.to_pylist():
            if t is None:
                out.append(None)
                continue
            seen: set[str] = set()
            kept = []
            for x in t.split(mark):
                key = x.strip().lower() if normalize else x
                if not x.strip() or key not in seen:
                    kept.append(x)
                    seen.add(key)
            out.append(mark.join(kept))
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string")(text)


def squeeze_newlines(text: Column, most: int = 2) -> Column:
    return F.regexp_replace(text, f"\n{{{most + 1},}}", "\n" * most)


def split_lines(text: Column, mark: str = "\n") -> Column:
    """The pieces between literal marks, as an array; an empty text goes."""
    return F.when(text != "", F.split(text, re.escape(mark)))


def join_lines(lines: Column, mark: str = "\n") -> Column:
    """An array as one text; an empty array goes."""
    return F.when(F.size(lines) > 0, F.array_join(lines, mark))


def split_around(df: DataFrame, pattern: str, context: int = 0, text: str = "text") -> DataFrame:
    """One row for each match of the pattern, with `context` characters on both sides, and the number of the chunk."""

    def run(a: pa.Array) -> pa.Array:
        one = re.compile(pattern)
        return pa.array([None if t is None else [t[max(0, m.start() - context) : m.end() + context] for m in one.finditer(t)] for t in a.to_pylist()], pa.list_(pa.string()))

    chunks = F.arrow_udf(run, "array<string>")(F.col(text))
    return df.select(*[c for c in df.columns if c not in (text, "chunk")], F.posexplode(chunks).alias("chunk", text))
