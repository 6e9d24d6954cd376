"""Cleaning of LaTeX and web text as column expressions (JVM only, no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.sql import Column, functions as F

from pairloom.functions import patterns as P


def universal_newlines(text: Column) -> Column:
    """``\\r\\n`` and ``\\r`` become ``\\n``, as a file opened in text mode reads."""
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, r"\r\n?", "\n")).otherwise(text)


def decode_latin1(content: Column) -> Column:
    """Bytes to text one byte per character; never fails."""
    return universal_newlines(F.decode(content, "ISO-8859-1"))


def decode_utf8(content: Column) -> Column:
    """Bytes to text, null where the bytes are not valid UTF-8."""
    return universal_newlines(F.try_validate_utf8(content.cast("string")))


def strip_comments(text: Column, keep_newline: bool = True) -> Column:
    """Remove unescaped ``%`` to the end of the line, optionally with the newline itself."""
    return F.regexp_replace(text, P.COMMENT if keep_newline else P.COMMENT_AND_NEWLINE, "")


def drop_environments(text: Column, names: Sequence[str] = P.DROPPED_ENVIRONMENTS) -> Column:
    """Remove whole environments, one name after the other."""
    for name in names:
        block = rf"\\begin\{{{name}\}}[\s\S]*?\\end\{{{name}\}}"
        text = F.regexp_replace(text, block, "")
    return text


def flatten_newlines(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def trim_space(text: Column) -> Column:
    return F.btrim(text, F.lit(P.TRIM_CHARACTERS))


def squeeze_space(text: Column) -> Column:
    """Newlines to spaces, trim, runs of white space to one space."""
    return F.regexp_replace(trim_space(flatten_newlines(text)), P.SPACE_TO_SQUEEZE, " ")


def strip_markup_commands(text: Column) -> Column:
    return F.regexp_replace(text, P.MARKUP_COMMAND, "")


def clean_sentence(text: Column) -> Column:
    """Squeeze, remove markup commands, squeeze again where there may be some."""
    once = squeeze_space(text)
    return F.when(F.contains(once, F.lit("\\")), squeeze_space(strip_markup_commands(once))).otherwise(once)


def strip_math_delimiters(text: Column) -> Column:
    return F.regexp_replace(text, P.MATH_DELIMITER, "")


def strip_preamble(text: Column, restore_begin: bool = False) -> Column:
    """Remove preamble lines and layout commands, then trim.

    ``restore_begin`` puts ``\\begin{document}`` back in front where the removal took it away.
    """
    body = F.regexp_replace(text, P.PREAMBLE, "")
    if restore_begin:
        opening = F.lit(P.DOCUMENT_BEGIN)
        body = F.when(F.contains(body, opening), body).otherwise(F.concat(opening, F.lit("\n"), body))
    return trim_space(body)


def prepare_for_sentences(text: Column) -> Column:
    """Comment, environment and newline removal that precedes sentence work on LaTeX files."""
    return flatten_newlines(drop_environments(strip_comments(text, keep_newline=False)))


def find_all(text: Column, pattern: str, group: int | None = None) -> Column:
    """All matches; the first group where the pattern has one, or the ``group`` asked for.

    The pattern is Java's, so Java counts its groups.
    """
    if group is None:
        java = SparkContext._active_spark_context._jvm.java.util.regex.Pattern
        group = min(java.compile(pattern).matcher("").groupCount(), 1)
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def has_document_body(text: Column) -> Column:
    """True for a main file: both document delimiters occur."""
    return F.contains(text, F.lit(P.DOCUMENT_BEGIN)) & F.contains(text, F.lit(P.DOCUMENT_END))


def is_paper_pdf(name: Column) -> Column:
    return name.rlike(P.PAPER_PDF) & name.endswith(".pdf")


def id_from_line(line: Column) -> Column:
    """Paper id of a listing line ending in ``.pdf``; null for other lines."""
    trimmed = trim_space(line)
    return F.when(trimmed.endswith(".pdf"), F.regexp_replace(trimmed, r"\.pdf\z", ""))


def paper_id_from_url(url: Column) -> Column:
    """Last path segment without a ``.pdf`` suffix."""
    return F.regexp_replace(F.element_at(F.split(url, "/"), -1), r"\.pdf\z", "")


def paper_urls(paper_id: Column) -> Column:
    """Addresses of the abstract page, the PDF and the source archive."""
    return F.struct(
        F.concat(F.lit(P.ABSTRACT_PAGE_BASE), paper_id).alias("abs_url"),
        F.concat(F.lit(P.PDF_BASE), paper_id, F.lit(".pdf")).alias("pdf_url"),
        F.concat(F.lit(P.SOURCE_BASE), paper_id).alias("source_url"),
    )


def title_slug(title: Column) -> Column:
    """Folder name of a title: spaces become dashes."""
    return F.translate(title, " ", "-")


def span_text(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def span_inside(a_start: Column, a_end: Column, b_start: Column, b_end: Column, strict: bool = False) -> Column:
    """True when span a lies within span b."""
    if strict:
        return (a_start > b_start) & (a_end < b_end)
    return (a_start >= b_start) & (a_end <= b_end)


def merge_span(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Smallest span that covers both."""
    return F.struct(
        F.least(a_start, a_end, b_start, b_end).alias("start"),
        F.greatest(a_start, a_end, b_start, b_end).alias("end"),
    )
