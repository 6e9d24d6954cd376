"""Metadata of paper pages."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import patterns as P
from pairloom.functions.cleaning import trim_space

# The five entities every XML document knows, the ampersand last.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
_NUMBER = "&#([xX][0-9A-Fa-f]+|[0-9]+);"
_NAME = "&(?!(?:lt|gt|quot|apos|amp);)([A-Za-z][A-Za-z0-9]*;)"


def _names() -> Column:
    """Named references, their semicolon included, to characters, from the standard library's table."""
    from html.entities import html5

    known = {entity[1:] for entity, _ in _ENTITIES}
    found = {n: c for n, c in html5.items() if n.endswith(";") and n not in known}
    # one literal, folded once: thousands of them would be planned one by one
    return F.from_json(F.lit(json.dumps(found)), "map<string,string>")


def _character(ref: Column) -> Column:
    """The character of a numeric reference; what is no character gives the replacement character."""
    digits = F.regexp_replace(F.regexp_extract(ref, _NUMBER, 1), "^([xX]?)0+(?=.)", "$1")
    hexadecimal = digits.rlike("^[xX]")
    bare = F.when(hexadecimal, F.substring(digits, 2, 1 << 30)).otherwise(digits)
    # eight digits are beyond all characters in either base
    code = F.when(F.length(bare) < 8, F.when(hexadecimal, F.conv(bare, 16, 10)).otherwise(bare).cast("long"))
    good = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    safe = F.when(good, code).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _references(text: Column) -> Column:
    """Numeric and named character references to characters, apart from the five that everyone knows."""

    def numbers(t: Column) -> Column:
        refs = F.array_distinct(F.regexp_extract_all(t, F.lit(_NUMBER), F.lit(0)))
        replaced = F.aggregate(refs, t, lambda acc, ref: F.replace(acc, ref, _character(ref)))
        return F.when(F.contains(t, F.lit("&#")), replaced).otherwise(t)

    def names(t: Column) -> Column:
        refs = F.array_distinct(F.regexp_extract_all(t, F.lit(_NAME), F.lit(1)))

        def replace(acc: Column, n: Column) -> Column:
            return F.coalesce(F.replace(acc, F.concat(F.lit("&"), n), F.try_element_at(_names(), n)), acc)

        return F.when(t.rlike(_NAME), F.aggregate(refs, t, replace)).otherwise(t)

    return _let(_let(text, numbers), names)


def element_text(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Text of the first ``tag`` element, optionally of exactly this class; null when there is none or it never ends.

    Elements of the same name inside it are part of its text.
    """
    attributes = r"(?:\s[^>]*)?" if css_class is None else rf"""\s(?:[^>]*\s)?class=["']{css_class}["'][^>]*"""
    opening = rf"(?s)<(?i:{tag}){attributes}>(.*)"
    mark = rf"(?i)<(/?){tag}(?=[\s/>])[^>]*>"
    # most elements hold none of their own name and end soon: those are read without cutting up the rest of the page
    plain = rf"(?s)\A(?>.*?<(?i:{tag}){attributes}>)([^<]*+(?:<(?!/?(?i:{tag})[\s/>])[^<]*+){{0,200}}+)</(?i:{tag})(?=[\s/>])[^>]*>"

    def count(acc: Column, end: Column) -> Column:
        depth = acc["depth"] + F.when(end == "/", -1).otherwise(1)
        return F.when(acc["depth"] == 0, acc).otherwise(F.struct(depth.alias("depth"), (acc["n"] + 1).alias("n")))

    def inside(rest: Column) -> Column:
        ends = F.regexp_extract_all(rest, F.lit(mark), F.lit(1))
        upto = F.aggregate(ends, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")), count)
        pieces = F.split(rest, mark, -1)
        return _let(upto, lambda u: F.when(u["depth"] == 0, F.array_join(F.slice(pieces, F.lit(1), u["n"]), "")))

    rest = F.get(F.regexp_extract_all(html, F.lit(opening), F.lit(1)), F.lit(0))
    text = F.when(html.rlike(plain), F.regexp_extract(html, plain, 1)).otherwise(_let(rest, inside))
    text = F.regexp_replace(text, "<[^>]*>", "")
    text = _references(text)
    for entity, character in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def page_meta(
    pages: DataFrame,
    keys: tuple[str, ...] = ("paper_id",),
    html: str = "html",
    title: tuple[str, str | None] = ("h1", "title mathjax"),
    category: tuple[str, str | None] = ("span", "primary-subject"),
) -> DataFrame:
    """Title without its label and subject without its parenthesised code; empty strings when missing."""
    titles = F.substring(element_text(F.col(html), *title), P.TITLE_LABEL_CHARS + 1, 1 << 30)
    subject = trim_space(F.regexp_replace(element_text(F.col(html), *category), r"\([^\n]*\)", ""))
    return pages.select(
        *keys, F.coalesce(titles, F.lit("")).alias("title"), F.coalesce(subject, F.lit("")).alias("category")
    )
