"""Balanced brackets, titles and author blocks. One linear pass per row, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pairloom.functions import patterns as P
from pairloom.functions.arrays import let

_CLOSER = {"(": ")", "[": "]", "{": "}"}


def extract_balanced(text: Column, open_pattern: str, bracket: str = "{") -> Column:
    """Text from the first match of ``open_pattern`` (which ends at ``bracket``) to the closing bracket.

    Null where nothing matches or the bracket never closes. The text after the match is cut at every
    bracket of this kind; the depth is counted over the cuts and the pieces up to depth zero are put
    back together.
    """
    closer = _CLOSER[bracket]
    any_bracket = rf"[\{bracket}\{closer}]"
    opened = F.regexp_extract(text, f"({open_pattern})", 1)

    def closed(rest: Column) -> Column:
        marks = F.regexp_extract_all(rest, F.lit(any_bracket), F.lit(0))
        state = F.aggregate(
            marks,
            F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen")),
            lambda s, m: F.when(s["depth"] == 0, s).otherwise(
                F.struct(
                    (s["depth"] + F.when(m == bracket, 1).otherwise(-1)).alias("depth"),
                    (s["seen"] + 1).alias("seen"),
                )
            ),
        )

        def rebuilt(s: Column) -> Column:
            inner = F.zip_with(
                F.slice(F.split(rest, any_bracket, -1), F.lit(1), s["seen"]),
                F.slice(marks, F.lit(1), s["seen"]),
                lambda piece, mark: F.concat(piece, mark),
            )
            return F.when(s["depth"] == 0, F.concat(opened, F.array_join(inner, "")))

        return let(state, rebuilt)

    rest = F.get(F.split(text, open_pattern, 2), F.lit(1))
    return F.when(F.length(opened) > 0, let(rest, closed))


def tex_title(text: Column) -> Column:
    """Content of the first one-line title command; null when there is none."""
    hits = F.regexp_extract_all(text, F.lit(P.TITLE), F.lit(1))
    return F.get(hits, F.lit(0))


def author_block(text: Column) -> Column:
    """The balanced author command without spacing noise; null when absent or unclosed."""
    return F.regexp_replace(extract_balanced(text, P.AUTHOR_OPEN), P.AUTHOR_NOISE, "")
