"""Text normalisation, tokens, tags and term screens, as Column expressions."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[\p{L}\p{N}]+(?:[-–][\p{L}\p{N}]+)*"


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """NFKC form; Spark has no built-in for it."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.StringType())
def casefolded(s: pd.Series) -> pd.Series:
    """Stripped, casefolded, blanks collapsed: unlike lower case this folds sharp s too."""
    return s.map(lambda x: None if x is None else " ".join(x.casefold().split()))


def normalize(c: Column, variant: str = "words") -> Column:
    """Lower case, then by variant: words keeps letters, digits, _ and %, as words_dash does
    with dashes mapped first; signs puts blanks for what is no letter, digit or _; alnum
    drops other signs in place; alnum_dash maps dashes first; spaces only collapses."""
    low = F.regexp_replace(F.lower(c), "[–—]", "-") if variant == "words_dash" else F.lower(c)
    if variant == "signs":
        return F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}_]+", " "))
    if variant in ("words", "words_dash"):
        return F.trim(F.regexp_replace(low, r"[^\p{L}\p{N}_%]+", " "))
    if variant in ("alnum", "alnum_dash"):
        low = F.regexp_replace(low, "[–—]", "-") if variant == "alnum_dash" else low
        low = F.regexp_replace(low, r"[^\p{L}\p{N}\s]", "")
    elif variant != "spaces":
        raise ValueError(variant)
    return F.trim(F.regexp_replace(low, r"\s+", " "))


def tokens(c: Column) -> Column:
    """Lexical tokens: letter or digit runs, hyphenated ones as one."""
    return F.regexp_extract_all(c, F.lit(f"({WORD})"), F.lit(1))


def tag(c: Column, name: str) -> Column:
    """The body of the first <name>...</name>, or the empty string."""
    return F.regexp_extract(c, f"(?is)<{name}>(.*?)</{name}>", 1)


def joined(items: Column, comma: str = ", ", last: str = " and ") -> Column:
    """Distinct items in order, the last one joined by another word."""
    d = F.array_distinct(items)
    n = F.size(d)
    return F.when(n < 2, F.array_join(d, comma)).otherwise(F.concat(F.array_join(F.slice(d, F.lit(1), n - 1), comma), F.lit(last), F.element_at(d, -1)))


def sentence(c: Column) -> Column:
    """First letter upper, the rest untouched, one full stop."""
    body = F.rtrim(F.regexp_replace(F.trim(c), r"\.+$", ""))
    return F.concat(F.upper(F.substring(body, 1, 1)), F.regexp_replace(body, r"(?s)^.", ""), F.lit("."))


def found_terms(c: Column, terms: list[str], prefix: str = "forbidden_term:") -> Column:
    """Codes of the terms that the text contains, in the order given."""
    low = F.lower(c)
    return F.array_compact(F.array(*(F.when(low.contains(t), F.lit(prefix + t)) for t in terms)))


def has_anchors(c: Column, groups: list[list[str]]) -> Column:
    """Whether of every group some alternative occurs."""
    low, out = F.lower(c), F.lit(True)
    for group in groups:
        any_ = F.lit(False)
        for term in group:
            any_ = any_ | low.contains(term)
        out = out & any_
    return out


def thousands(c: Column, mark: str = ".") -> Column:
    """A whole number with a mark between thousands."""
    return F.translate(F.format_number(c, 0), ",", mark)


def choices(options: Column, inline: bool = False) -> Column:
    """Options by key: one on each line, or in brackets on one."""
    entries = F.array_sort(F.map_entries(options))
    lines = F.transform(entries, lambda e: F.concat(e["key"], F.lit(": " if inline else ". "), e["value"]))
    return F.concat(F.lit(" <choices>: ["), F.array_join(lines, ", "), F.lit("]")) if inline else F.array_join(lines, "\n")


def count_marked(c: Column, letters: str) -> Column:
    """How many characters are among the given letters, in either case."""
    return F.regexp_count(F.lower(c), F.lit(f"[{letters}]"))


@F.pandas_udf(T.StringType())
def json_object(s: pd.Series) -> pd.Series:
    """The first JSON object in a text, as compact JSON with sorted keys: a fenced block
    that is one, else what starts at the first brace from which one can be read; null
    without any."""
    decoder = json.JSONDecoder()

    def first(text: str | None) -> str | None:
        if text is None:
            return None
        fenced = [m.start(1) for m in re.finditer(r"```(?:json)?\s*(\{)", text)]
        for at in [*fenced, *(m.start() for m in re.finditer(r"\{", text))]:
            try:
                return json.dumps(decoder.raw_decode(text, at)[0], sort_keys=True, ensure_ascii=False, separators=(",", ":"))
            except (ValueError, RecursionError):
                continue
        return None

    return s.map(first)


def tail(c: Column, prefix: str) -> Column:
    """What follows a prefix (a pattern); all of it without one."""
    return F.regexp_replace(F.trim(c), f"^(?:{prefix})", "")


def clean_question(c: Column) -> Column:
    """The question itself: without the image mark, and cut before its choices."""
    return F.regexp_replace(F.split(F.regexp_replace(c, "<image>", ""), "<choices>:")[0], r"^\s+|\s+$", "")


def part(c: Column, name: str) -> Column:
    """What follows <name> up to the next mark in angle brackets or the end, trimmed."""
    return F.regexp_replace(F.regexp_extract(c, rf"(?s)<{name}>(.*?)(?=<[a-z_]+>|$)", 1), r"^\s+|\s+$", "")


def boxes(c: Column) -> Column:
    """The boxes that follow <location>, as arrays of whole numbers; null without any."""
    return F.from_json(part(c, "location"), "array<array<int>>")


def leaks_answer(question: Column, answer: Column, exempt: tuple[str, ...] = ()) -> Column:
    """Whether the question says the answer, both normalised; some answers are exempt."""
    said = normalize(question).contains(normalize(answer)) & (normalize(answer) != "")
    return said & ~answer.isin(*exempt) if exempt else said


def phrase_counts(c: Column, phrases: list[str]) -> tuple[list[Column], Column]:
    """(how often each phrase occurs, the words left over). Phrases are taken in order and
    removed, so that a shorter one does not count inside a longer one."""
    rest = F.concat(F.lit(" "), F.replace(normalize(c), F.lit(" "), F.lit("  ")), F.lit(" "))
    out = []
    for p in phrases:
        own = F.lit(" " + p.replace(" ", "  ") + " ")
        less = F.replace(rest, own, F.lit(" | "))
        out.append(((F.length(rest) - F.length(F.replace(rest, own, F.lit("")))) / F.length(own)).cast("long"))
        rest = less
    words = F.filter(F.split(F.trim(rest), " +"), lambda w: (w != "|") & (w != ""))
    return out, words


def templated(key: Column, templates: dict[str, str], slots: dict[str, Column]) -> Column:
    """The key's template with {name} replaced by slots; a key without one, or a null
    slot, is an error."""
    out = F.lit(None).cast("string")
    for name, template in templates.items():
        text = F.lit(template)
        for slot, value in slots.items():
            text = F.replace(text, F.lit("{" + slot + "}"), value.cast("string"))
        out = F.when(key == name, text).otherwise(out)
    return F.when(out.isNull(), F.raise_error(F.concat(F.lit("no template or value for "), F.coalesce(key, F.lit("null"))))).otherwise(out)
