"""Text primitives as Catalyst expressions, with the semantics of Python strings.

White space, line ends, letters and digits are spelt out as character classes,
so that a pattern means the same to Java and to other regex engines. Nothing
here leaves the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What str.isspace() accepts, for use inside a character class.
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Where str.splitlines() cuts.
LINE_END = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
#: str.isdigit() but for scripts that keep digits outside \p{Nd}: superscripts, subscripts and circled digits are listed.
DIGIT = r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}"
STRIP = rf"\A[{SPACE}]+|[{SPACE}]+\z"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def filled(c: Column) -> Column:
    """Whether anything is left of a text by `strip`; it looks no further than to the first sign."""
    return c.rlike(rf"[^{SPACE}]")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"[{SPACE}]+\z", "")


def words(c: Column) -> Column:
    """str.split()"""
    return F.filter(F.split(c, f"[{SPACE}]+"), lambda w: w != "")


def fasttext_tokens(c: Column) -> Column:
    """Cut at ASCII white space and NUL, with a token </s> for each newline."""
    marked = F.replace(c, F.lit("\n"), F.lit(" </s> "))
    return F.filter(F.split(marked, r"[ \n\r\t\x{0b}\x{0c}\x{00}]+"), lambda w: w != "")


def lines(c: Column) -> Column:
    """str.splitlines(): no empty line after the last line end."""
    parts = F.split(c, LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def segments(c: Column, mark: str = "\n") -> Column:
    """The pieces between literal marks, stripped, without empty ones."""
    return F.filter(F.transform(F.split(c, re.escape(mark)), strip), lambda s: s != "")


def paragraphs(c: Column, end: str = "\n", remove_empty: bool = True) -> Column:
    """Pieces between matches of the regex `end`; stripped and without empty ones if remove_empty."""
    parts = F.split(c, java_regex(end))
    return F.filter(F.transform(parts, strip), lambda s: s != "") if remove_empty else parts


def join(parts: Column, mark: str = "\n") -> Column:
    return F.array_join(parts, mark)


def count(c: Column, literal: str) -> Column:
    """str.count(literal): occurrences that don't overlap."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(literal), F.lit("")))) / len(literal)).cast("int")


def letters(c: Column) -> Column:
    """How many characters are letters."""
    return F.length(F.regexp_replace(c, r"[^\p{L}]", ""))


def alphanumerics(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


def total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)


def is_space_or_punct(c: Column) -> Column:
    """Only spaces and ASCII punctuation; a newline is neither."""
    return c.rlike(r"\A[ !-/:-@\[-`{-~]*\z")


def if_kept(c: Column) -> Column:
    """Null, which drops the row, for an empty text. The column is computed once, though it is looked at and returned."""
    return F.get(F.filter(F.array(c), lambda x: x != ""), F.lit(0))


def java_regex(pattern: str) -> str:
    """A Python pattern for Java: braces that aren't quantifiers or escapes are literals, and only newline ends a line."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            if nxt in "pPxu" and pattern[i + 2 : i + 3] == "{":
                end = pattern.index("}", i)
                out.append(pattern[i : end + 1])
                i = end + 1
                continue
            out.append(pattern[i : i + 2])
            i += 2
        elif ch == "{":
            quantifier = re.match(r"\{\d*(?:,\d*)?\}", pattern[i:])
            if quantifier and i and quantifier.group() not in ("{}", "{,}"):
                text = quantifier.group()
                out.append("{0," + text[2:] if text.startswith("{,") else text)
                i += len(text)
            else:
                out.append(r"\{")
                i += 1
        elif ch == "}":
            out.append(r"\}")
            i += 1
        elif ch == "[":
            end = i + 1 + (pattern[i + 1 : i + 2] == "^")
            end += pattern[end : end + 1] == "]"
            while pattern[end] != "]":
                end += 2 if pattern[end] == "\\" else 1
            out.append("[" + re.sub(r"(?<!\\)(\[|&&)", r"\\\1", pattern[i + 1 : end]) + "]")
            i = end + 1
        else:
            out.append(ch)
            i += 1
    return "(?d)" + "".join(out)


def any_of(items: list[str], case_sensitive: bool = False, word: bool = False, literal: bool = False) -> str:
    """One Java pattern for several alternatives, which are regexes unless literal."""
    body = "|".join(re.escape(x) if literal else x for x in items)
    pattern = java_regex(rf"\b(?:{body})\b" if word else f"(?:{body})")
    return pattern if case_sensitive else "(?iu)" + pattern


def draw(key: Column, seed: int = 0) -> Column:
    """A number from 0 up to 1 for each key, from 52 bits of the MD5 of seed and key: the same on every run, and in any SQL. Null counts as an empty key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)
