"""Recursive replacement of include commands by the content of the included files."""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import cleaning as C, patterns as P
from pairloom.functions.workers import ship_by_value, small_batches
from pairloom.session import ensure_checkpoint_dir

ship_by_value(__name__)

_KEYS = ("paper_id", "path")
_PIECE = "array<struct<txt:string,command:string,target:string>>"
#: A paper with more files, or more letters in them, is expanded level by level.
PAPER_FILES, PAPER_LETTERS = 4096, 8 << 20
_FOLDER = r"^(.*/)?[^/]*$"
_HERE = r"^(?:\./)+"
_INCLUDE, _SUFFIXES = re.compile(P.INCLUDE), P.INCLUDE_SUFFIXES


def _bare(keep_comments: bool) -> Column:
    # a percent sign begins no comment in a bibliography database
    bare = F.when(F.lower("path").endswith(".bib"), F.col("text")).otherwise(C.strip_comments(F.col("text")))
    return F.col("text") if keep_comments else bare


def _segments(files: DataFrame, keep_comments: bool) -> DataFrame:
    """Each file as an array of alternating text pieces and include commands."""
    none = F.lit(None).cast("string")
    cut = (
        files.select(*_KEYS, _bare(keep_comments).alias("__t"))
        .withColumn("__gaps", F.split("__t", P.INCLUDE, -1))
        .withColumn("__hits", F.regexp_extract_all("__t", F.lit(P.INCLUDE), F.lit(0)))
    )

    def pair(gap: Column, hit: Column) -> Column:
        return F.array(
            F.struct(gap.alias("txt"), none.alias("command"), none.alias("target")),
            F.struct(
                hit.alias("txt"),
                F.regexp_extract(hit, P.INCLUDE, 1).alias("command"),
                F.trim(F.regexp_extract(hit, P.INCLUDE, 2)).alias("target"),
            ),
        )

    pieces = F.filter(F.flatten(F.zip_with("__gaps", "__hits", pair)), lambda p: p["txt"] != "")
    return cut.select(*_KEYS, pieces.cast(_PIECE).alias("pieces"))


def _opened(df: DataFrame, order: Column, trail: Column) -> DataFrame:
    """One row per piece, with its place in the whole text and the files it came through."""
    return df.select(
        "paper_id", "root", order.alias("order"), trail.alias("trail"), F.posexplode("pieces").alias("pos", "piece")
    ).select(
        "paper_id", "root", F.concat("order", F.array("pos")).alias("order"), "trail",
        "piece.*", F.lit(None).cast("string").alias("status"),
    )


def _pieces(text: str) -> list[tuple[str, str | None, str]]:
    """(text, command or None, target without ./) in order, as in ``_segments``."""
    out, at = [], 0
    for m in _INCLUDE.finditer(text):
        target = m[2].strip(" ")
        if target[:2] == "./":
            target = re.sub(_HERE, "", target)
        if m.start() > at:
            out.append((text[at : m.start()], None, ""))
        out.append((m[0], m[1], target))
        at = m.end()
    if at < len(text):
        out.append((text[at:], None, ""))
    return out


def _expand(files: dict[str, list], root: str, folder: str) -> tuple[str, int, int] | None:
    """(text, missing, cyclic) of one root among the pieces of a paper's files, None if there is no text at all."""
    out: list[tuple[tuple[int, ...], str]] = []
    status = Counter()
    to_open = [(root, (), (root,))]
    while to_open:
        path, order, trail = to_open.pop()
        for pieces in files[path]:
            for i, (txt, command, target) in enumerate(pieces):
                place = (*order, i)
                if command:
                    found = next((name for x in _SUFFIXES[command] if (name := folder + target + x) in files), None)
                    if found is not None and found not in trail:
                        to_open.append((found, place, (*trail, found)))
                        continue
                    status["missing" if found is None else "cyclic"] += 1
                out.append((place, txt))
    out.sort()
    return ("".join(txt for _, txt in out), status["missing"], status["cyclic"]) if out else None


def _by_paper(files: DataFrame, roots: DataFrame, keep_comments: bool) -> DataFrame:
    """Expanded roots, a paper at a time: its files and roots travel once, and meet one after the other."""
    small_batches(files.sparkSession)
    texts = files.select(*_KEYS, F.coalesce(_bare(keep_comments), F.lit("")).alias("text"), F.lit(None).cast("string").alias("folder"))
    wanted = roots.select(*_KEYS, F.lit(None).cast("string").alias("text"), F.regexp_extract("path", _FOLDER, 1).alias("folder"))
    rows = texts.unionByName(wanted).where(F.col("paper_id").isNotNull() & F.col("path").isNotNull())
    names = ["paper_id", "path", "text", "missing", "cyclic"]
    id_type = rows.schema["paper_id"].dataType.simpleString()

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, letters, types = [], 0, None

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

        def given() -> Iterator[tuple]:
            nonlocal types
            for b in batches:
                types = [*b.schema.types[:3], pa.int64(), pa.int64()]
                yield from zip(*(c.to_pylist() for c in b.columns))

        for paper, group in itertools.groupby(given(), lambda row: row[0]):
            texts, wanted = {}, Counter()
            for _, path, text, folder in group:
                if folder is None:
                    texts.setdefault(path, []).append(_pieces(text))
                else:
                    wanted[path, folder] += 1
            for (path, folder), n in wanted.items():
                if path in texts:
                    found = _expand(texts, path, folder)
                    out += [(paper, path, *found)] if found else [(paper, path, "", 0, 0)] * n
                    letters += len(out[-1][2])
                    if len(out) >= 4096 or letters >= 8 << 20:
                        yield batch()
                        out, letters = [], 0
        if out:
            yield batch()

    schema = f"paper_id {id_type}, path string, text string, missing long, cyclic long"
    # by an expression: a shuffle by the bare column goes if the rows seem to lie so, which joins may change while they run
    return rows.repartition(F.xxhash64("paper_id")).sortWithinPartitions("paper_id").mapInArrow(expand, schema)


def expand_includes(
    files: DataFrame, roots: DataFrame, keep_comments: bool = False, paper_files: int = PAPER_FILES, paper_letters: int = PAPER_LETTERS
) -> DataFrame:
    """Text of every root file with its includes replaced, however deeply nested.

    ``files`` has ``paper_id, path, text``, ``roots`` has ``paper_id, path``. A target is looked up in the
    folder of the root, as it is and then with the suffixes of its command. Returns ``paper_id, path, text``
    and ``missing``, ``cyclic``: how many commands could not be replaced and stay in the text. No path of
    includes repeats a file, so the levels end by themselves.

    Papers of up to ``paper_files`` files and ``paper_letters`` letters in all are expanded one by one, each in a task
    that its files reach by one shuffle. Larger ones, which are counted before, go level by level with all of their files.
    """
    ensure_checkpoint_dir(files.sparkSession)
    sizes = files.groupBy("paper_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("letters"))
    large = sizes.where((F.col("n") > paper_files) | (F.col("letters") > paper_letters)).select("paper_id").checkpoint()
    if large.isEmpty():
        return _by_paper(files, roots, keep_comments)
    parts = [[df.join(large, "paper_id", how) for df in (files, roots)] for how in ("left_anti", "left_semi")]
    return _by_paper(*parts[0], keep_comments).unionByName(_by_levels(*parts[1], keep_comments))


def _by_levels(files: DataFrame, roots: DataFrame, keep_comments: bool) -> DataFrame:
    """Expanded roots of papers of any size.

    A level joins only the include commands still open; text that is already known is not touched again
    and is put in order once, at the end. Each level is checkpointed, so the plan stays small and a lost
    executor costs one level.
    """
    segments = _segments(files, keep_comments).checkpoint()
    names = segments.select(*_KEYS)
    level = _opened(
        segments.join(roots.select(*_KEYS), list(_KEYS), "left_semi").withColumn("root", F.col("path")),
        F.array().cast("array<int>"),
        F.array("root"),
    ).checkpoint()
    done = level.where(F.col("command").isNull())
    still_open = level.where(F.col("command").isNotNull())
    while not still_open.isEmpty():
        folder = F.regexp_extract("root", _FOLDER, 1)
        name = F.regexp_replace("target", _HERE, "")
        suffixes = F.when(
            F.col("command") == "input", F.array(*[F.lit(s) for s in P.INCLUDE_SUFFIXES["input"]])
        ).otherwise(F.array(*[F.lit(s) for s in P.INCLUDE_SUFFIXES["bibliography"]]))
        tried = still_open.select(
            "paper_id", "root", "order", F.posexplode(suffixes).alias("rank", "suffix"),
            folder.alias("folder"), name.alias("name"),
        ).select("paper_id", "root", "order", "rank", F.concat("folder", "name", "suffix").alias("path"))
        resolved = (
            tried.join(names, list(_KEYS))
            .groupBy("paper_id", "root", "order")
            .agg(F.min_by("path", "rank").alias("path"))
        )
        located = still_open.join(resolved, ["paper_id", "root", "order"], "left").withColumn(
            "status",
            F.when(F.col("path").isNull(), "missing").when(F.array_contains("trail", F.col("path")), "cyclic"),
        )
        children = _opened(
            located.where(F.col("status").isNull()).join(segments, list(_KEYS)),
            F.col("order"),
            F.array_append("trail", F.col("path")),
        )
        stuck = located.where(F.col("status").isNotNull()).drop("path")
        level = children.unionByName(stuck).checkpoint()
        finished = F.col("command").isNull() | F.col("status").isNotNull()
        done = done.unionByName(level.where(finished))
        still_open = level.where(~finished)
    text = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("order", "txt"))), lambda p: p["txt"]), ""
    )
    whole = done.groupBy("paper_id", F.col("root").alias("path")).agg(
        text.alias("text"),
        *[F.count_if(F.coalesce(F.col("status") == s, F.lit(False))).alias(s) for s in ("missing", "cyclic")],
    )
    # A root without any text has no pieces at all.
    empty = roots.select(*_KEYS).join(names, list(_KEYS), "left_semi").join(whole, list(_KEYS), "left_anti")
    zero = F.lit(0).cast("long")
    return whole.unionByName(
        empty.select(*_KEYS, F.lit("").alias("text"), zero.alias("missing"), zero.alias("cyclic"))
    )
