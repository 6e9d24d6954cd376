"""Spelling variants: words that differ by one code point, found by pairs of trie nodes.

1. Words are counted per partition and summed. Sorted, they are the trie: a word shares with its predecessor the nodes
   of their common prefix, and the rest of its path is new. So a range partition numbers its nodes in one pass, and one
   row per partition (first word, last word and its path) is all it takes to number them through. Sorted by their
   reversal the words give the reversed trie.
2. A word is a pair (prefix node, suffix node) at each of its gaps, and at each of its letters the pair around the
   letter it skips. Two words that skip a letter to the same pair differ in that letter; a word whose gap is the pair
   around a skipped letter is the other without it. Of equal neighbouring letters only the last one counts as deleted,
   so every neighbour is met exactly once. Nodes that only one word passes cannot match and give no pairs.
3. Words of one pair meet in a group: as many as there are letters to skip, and one that has none there. A group hands
   each member its number of neighbours and the best of them; pairs of words are never made.
4. ``form`` is the most frequent neighbour (ties: smallest in code-point order, which is the order of word numbers) if
   it is ``factor`` times as frequent. Counts grow by that factor with every step, so roots are found in few doublings.

Defined results: a null text has no words; a null id is written as nothing where ids are written; rows that repeat
count again; other columns are not looked at; an empty table gives an empty table. A word may be of any length: what is
made of it is in proportion to the length.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm import common

FACTOR = 10
#: Words that a counting task remembers before it hands counts on; words of a partition of the trie.
REMEMBER, PART = 300_000, 200_000
_LETTERS = re.compile(rb"[a-z\xc0-\xff]+")


def letter_runs(text: str) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased, as Latin-1 bytes."""
    return _LETTERS.findall(text.encode("latin-1", "replace").lower())


def dropped_letter(doc_id: str, run: bytes) -> bytes:
    """The run without the letter that crc32 of ``doc_id:run`` names, if 31 divides that."""
    name = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(name, zlib.crc32(f"{doc_id}:".encode()))
    if h % 31:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counts(docs: DataFrame, least: int = 7, change: Callable[[str, bytes], bytes] | None = None) -> DataFrame:
    """(word, n) of all runs of at least ``least`` letters after ``change``, which sees the id and the run."""

    def flush(found: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in found], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id = doc_id.as_py()
                # a changed run may be one letter shorter, never longer
                for run, n in Counter(w for w in letter_runs(text.as_py()) if len(w) >= least).items():
                    word = change(doc_id, run) if change else run
                    if len(word) >= least:
                        total[word] += n
                if len(total) >= REMEMBER:
                    yield flush(total)
                    total.clear()
        yield flush(total)
        common.give_back()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    return rows.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def trie_paths(words: DataFrame, parts: int, name: str) -> DataFrame:
    """(word, path, shared) for the distinct strings in ``word``: path[k] numbers the trie's node of the first k + 1
    letters (the root is 0), numbers grow with the order of strings, and only the first ``shared`` nodes may belong to
    other words too."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        path: list[int] = []
        made = 0
        held: tuple | None = None  # the last word, whose successor is not known yet
        part = None

        def batch_of(rows):
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(columns, ["part", "word", "path", "shared", "first", "nodes"])

        types = [pa.int32(), pa.string(), pa.list_(pa.int64()), pa.int32(), pa.string(), pa.int64()]
        for batch in batches:
            rows = []
            for word in batch.column(1).to_pylist():
                if first is None:
                    first, part, same = word, batch.column(0)[0].as_py(), 0
                    before = len(word)  # its predecessor is in another partition
                else:
                    same = before = len(commonprefix((last, word)))
                    rows.append((part, held[0], held[1], max(held[2], same), None, None))
                path = path[:same] + list(range(made + 1, made + 1 + len(word) - same))
                made += len(word) - same
                last, held = word, (word, path, before)
            if rows:
                yield batch_of(rows)
        if held:
            yield batch_of([(part, held[0], held[1], len(held[0]), None, None), (part, last, path, 0, first, made)])

    sorted_ = words.select("word").repartitionByRange(parts, "word").sortWithinPartitions("word")
    schema = "part int, word string, path array<long>, shared int, first string, nodes long"
    rows = sorted_.select(F.spark_partition_id().alias("part"), "word").mapInArrow(number, schema)
    rows = common.stage(rows, name)

    # one row per partition: those nodes of its first word that the last word before it has made already
    fixed, offset, before_word, before_path = [], 0, "", []
    for row in sorted(rows.filter("first IS NOT NULL").collect(), key=lambda r: r.part):
        same = len(commonprefix((before_word, row["first"])))
        shared = before_path[:same]
        fixed.append((row.part, shared, offset - same))
        before_word = row.word
        before_path = [shared[x - 1] if x <= same else offset - same + x for x in row.path]
        offset += row.nodes - same
    fixed = words.sparkSession.createDataFrame(fixed, "part int, known array<long>, add long")
    rows = rows.filter("first IS NULL").join(F.broadcast(fixed), "part")  # a row per partition of the trie
    path = F.transform("path", lambda x: F.when(x <= F.size("known"), F.get("known", (x - 1).cast("int"))).otherwise(x + F.col("add")))
    return rows.select("word", path.alias("path"), "shared")


def node_pairs(words: DataFrame) -> DataFrame:
    """(p, s, kind, id, n): pairs around skipped letters (kind 0, or 1 if the next letter differs) and at gaps (2)."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = batch.column(2).to_pylist()
        length = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        start = np.cumsum(length) - length
        differs = np.ones(len(codes), bool)
        differs[:-1] = codes[1:] != codes[:-1]
        differs[start + length - 1] = True
        paths, most = [], []
        for k in (3, 4):
            column = batch.column(k)
            ends = column.offsets.to_numpy().astype(np.int64)
            paths.append((column.flatten().to_numpy(), ends[:-1] - ends[0]))
            most.append(np.diff(ends))

        def node(side: int, word: np.ndarray, depth: np.ndarray) -> np.ndarray:
            values, at = paths[side]
            out = np.zeros(len(word), np.int64)
            some = np.flatnonzero(depth)
            out[some] = values[at[word[some]] + depth[some] - 1]
            return out

        for gap in (0, 1):  # skipped letters, then gaps
            rest = length - 1 + gap
            low, high = np.maximum(rest - most[1], 0), np.minimum(most[0], rest)
            many = np.maximum(high - low + 1, 0)
            word = np.repeat(np.arange(len(ids)), many)
            i = low[word] + np.arange(len(word)) - (np.cumsum(many) - many)[word]
            kind = np.full(len(word), 2, np.int8) if gap else differs[start[word] + i].astype(np.int8)
            columns = [node(0, word, i), node(1, word, rest[word] - i), kind, ids[word], n[word]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["p", "s", "kind", "id", "n"])

    return words.select("id", "n", "word", "prefixes", "suffixes").mapInArrow(
        common.in_batches(work, rows=1 << 14, size=4 << 20), "p long, s long, kind byte, id long, n long"
    )


def neighbours(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best): number of near words and (n, -id) of the best."""
    member = F.struct("n", (-F.col("id")).alias("minus"), "kind")
    groups = pairs.groupBy("p", "s").agg(F.collect_list(member).alias("all")).filter(F.size("all") > 1)
    plain = lambda x: F.struct(x["n"].alias("n"), x["minus"].alias("minus"))
    groups = groups.select(
        "all",
        F.sort_array(F.transform(F.filter("all", lambda x: x["kind"] < 2), plain), asc=False).alias("skip"),
        F.transform(F.filter("all", lambda x: x["kind"] == 1), plain).alias("longer"),
        F.get(F.transform(F.filter("all", lambda x: x["kind"] == 2), plain), F.lit(0)).alias("shorter"),
    )

    def answer(x):
        first, second = F.get("skip", F.lit(0)), F.get("skip", F.lit(1))
        other = F.when(first["minus"] == x["minus"], second).otherwise(first)
        below = F.when(x["kind"] == 1, F.col("shorter"))
        n = F.size("skip") - 1 + F.when(below.isNotNull(), 1).otherwise(0)
        gap = x["kind"] == 2
        return F.struct(
            (-x["minus"]).alias("id"),
            F.when(gap, F.size("longer")).otherwise(n).cast("long").alias("near"),
            F.when(gap, F.array_max("longer")).otherwise(F.array_max(F.array(other, below))).alias("best"),
        )

    rows = groups.select(F.inline(F.transform("all", answer)))
    return rows.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best")).filter("n_near > 0")


def roots(links: DataFrame) -> DataFrame:
    """(id, root) for links (id, form) that go upwards: pointer doubling, logarithmic in the longest chain."""
    links = links.select("id", F.col("form").alias("root"))
    while True:
        links = common.stage(links, "roots")
        step = links.toDF("root", "next")
        if links.join(step, "root", "left_semi").isEmpty():
            return links
        links = links.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct words in (word, n)."""
    spark = words.sparkSession
    common.prepare(spark)
    words = common.stage(words.select("word", "n"), "words")
    parts = max(common.parallelism(spark), -(-words.count() // PART))
    forward = trie_paths(words, parts, "trie")
    # words that end alike are neighbours in the reversed trie; a word's own number is its last forward node
    backward = trie_paths(words.select(F.reverse("word").alias("word")), parts, "reversed_trie")
    cut = lambda name: F.slice("path", F.lit(1), F.col("shared")).alias(name)
    forward = forward.select("word", F.element_at("path", -1).alias("id"), cut("prefixes"))
    backward = backward.select(F.reverse("word").alias("word"), cut("suffixes"))
    known = words.join(forward, "word").join(backward, "word")
    known = common.stage(known, "numbered")
    near = common.stage(neighbours(node_pairs(known)), "neighbours")

    rows = known.select("id", "word", "n").join(near, "id", "left")
    best = F.when(F.col("best.n") >= factor * F.col("n"), F.col("best"))
    rows = rows.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), best.alias("best"))
    rows = rows.select("id", "word", "n", "n_near", (-F.col("best.minus")).alias("form_id"), F.col("best.n").alias("form_n"))
    rows = common.stage(rows, "forms")
    linked = rows.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("form"))
    names = known.select("id", "word")
    ends = roots(linked).join(names.toDF("root", "root_word"), "root").select("id", F.col("root_word").alias("root"))
    forms = linked.join(names.toDF("form", "form_word"), "form").select("id", F.col("form_word").alias("form"))
    rows = rows.join(forms, "id", "left").join(ends, "id", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
