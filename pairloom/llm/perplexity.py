"""Quality rules by the perplexity of an n-gram model, with upper and lower bands per language.

The model is an interpolated modified Kneser-Ney model of order ``ORDER`` over the bytes of words, as they are, each word
with one space after it; before a text there are spaces. It grows with the collection, so it stays dealt out:

1. Tasks pack batches of texts, with the base rules' counts, and deal out each batch's distinct n-grams with their counts,
   in chunks, by the last two bytes of their contexts.
2. A task sums the chunks of its bucket. Contexts of two bytes or more are whole there; what the shorter ones and the
   discounts need (at most 256 x 256 counts and a few for each order, whatever the data) is added up over all buckets.
3. The task answers each chunk with its n-grams' code lengths, and each batch adds them up by text.

An n-gram's bytes are its key, so there are no collisions. Code lengths are rounded to 1 / 4096 of a bit.

A document's perplexity is measured in bits per word. Its language's bands follow from quartiles over all documents of
the language that pass the base rules: so many times the distance of a quartile from the median. Distances are taken
after scaling by the square root of the words, since the mean over few words varies more.

Base rules (whole text): fewer than 50 words, or more than half of the words inside 3-word windows found twice or more.

Defined results: a null or empty text has no words and fails the base rules; a null language is a language of its own;
where a language has no quartiles (no documents that pass) nothing is rejected beyond the base rules; an empty table
gives an empty table; rows that repeat are judged and counted each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.ipc  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm import chunked, common
from pairloom.llm.flat import FlatTexts

ORDER = 6
#: of text in a batch
BATCH_BYTES = 16 << 20
_SCALE = 4096
MIN_WORDS = 50
#: Bands: median - LOWER x (median - lower quartile), median + UPPER x (upper quartile - median).
LOWER, UPPER = 7.0, 7.0

def words_of(flat: FlatTexts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all words, each with a space after it, bytes of each text among them)."""
    lengths = flat.ends - flat.starts
    data = np.insert(flat.data[~flat.space], np.cumsum(lengths), 32)
    return data, np.bincount(flat.owner, lengths + 1, len(flat)).astype(np.int64)


def grams(data: np.ndarray, lengths: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each byte of texts in a row: its last byte lowest; before a text there are spaces."""
    place = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    key = data.astype(np.uint64)
    for k in range(1, order):
        before = np.full(len(data), 32, np.uint64)
        before[k:] = data[:-k] if k < len(data) else data[:0]
        before[place < k] = 32
        key |= before << np.uint64(8 * k)
    return key


def stretches(data: np.ndarray, lengths: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[slice, np.ndarray]]:
    """(texts, their ``grams``), ``size`` bytes or one text at a time: the arrays are many times as large as the text."""
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        begin = int(ends[at] - lengths[at])
        to = max(at + 1, int(np.searchsorted(ends, begin + size, side="right")))
        yield slice(at, to), grams(data[begin : ends[to - 1]], lengths[at:to])
        at = to


def counted(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct n-grams of texts in a row, ascending, their counts), by sorting alone."""
    parts = []
    for _, key in stretches(data, lengths):
        key.sort()
        first = np.flatnonzero(np.append(np.ones(min(len(key), 1), bool), key[1:] != key[:-1]))
        parts.append((key[first], np.diff(np.append(first, len(key)))))
    keys, n = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


def base_rules(flat: FlatTexts) -> dict[str, np.ndarray]:
    n = len(flat)
    continued = (flat.data & 0xC0) == 0x80
    signs = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
    runs, text, at = flat.runs(3)
    key = common.mix64(runs ^ common.mix64(text.astype(np.uint64)))
    _, place, count = np.unique(key, return_inverse=True, return_counts=True)
    at = at[count[place] > 1]
    inside = np.zeros(len(flat.owner), bool)
    for k in range(3):
        inside[at + k] = True
    # lines: hashes of the bytes between line ends; lines are compared by their bytes within each text
    copies = np.zeros(n, np.int64)
    raw = flat.data.tobytes()
    for i in range(n):
        a, b = flat.bounds[i], flat.bounds[i + 1]
        lines = [x for x in raw[a:b].split(b"\n") if x and not x.isspace()]
        copies[i] = len(lines) - len(set(lines))
    return {
        "n_words": flat.words,
        "word_chars": flat.per_text(~flat.space & ~continued),
        "n_symbols": flat.per_text(signs[flat.data]),
        "n_dup_lines": copies,
        "n_repeat_words": np.bincount(flat.owner[inside], minlength=n).astype(np.int64),
    }


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and more, from the counts of counts; 0.5, 1, 1.5 where those have gaps."""
    return _from_counts([int((counts == k).sum()) for k in (1, 2, 3, 4)])


def _from_counts(of_counts: list[int]) -> np.ndarray:
    n1, n2, n3, n4 = of_counts
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(found, 0, [0, 0.99, 1.99, 2.99])


Level = tuple[np.ndarray, np.ndarray]


def levels(gram: np.ndarray, n: np.ndarray, lowest: int, order: int, symbols: int) -> list[Level]:
    """(sorted n-grams, counts) of each order from ``lowest`` up: shorter ones count the different symbols before them."""
    by = np.argsort(gram)
    out = [(gram[by].astype(np.int64), n[by].astype(np.int64))]
    for k in range(order - 1, lowest - 1, -1):
        out.insert(0, np.unique(out[0][0] % symbols**k, return_counts=True))
    return out


def interpolate(level: Level, discounts: np.ndarray, lower: np.ndarray, symbols: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probabilities, contexts, what their n-grams leave) of one order, ``lower`` being the next shorter n-grams' probabilities."""
    keys, counts = level
    discount = discounts[np.minimum(counts, 3)]
    context, place = np.unique(keys // symbols, return_inverse=True)
    total = np.bincount(place, counts)
    rest = np.bincount(place, discount) / total
    return (counts - discount) / total[place] + rest[place] * lower, context, rest


def estimate(gram: np.ndarray, n: np.ndarray, order: int = 4, symbols: int = 48) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """A whole model at once: per order (sorted n-grams, log2 p, sorted contexts, log2 of their rest).

    Lower orders count the different symbols before an n-gram. The lowest order rests on the uniform distribution.
    """
    out, below = [], None
    for k, level in enumerate(levels(gram, n, 1, order, symbols)):
        lower = np.full(len(level[0]), 1 / symbols) if below is None else below[1][np.searchsorted(below[0], level[0] % symbols**k)]
        p, context, rest = interpolate(level, _discounts(level[1]), lower, symbols)
        out.append((level[0], np.log2(p), context, np.log2(np.maximum(rest, 1e-12))))
        below = (level[0], p)
    return out


def log2_of(model: list, gram: np.ndarray, symbols: int = 48) -> np.ndarray:
    """log2 probability of each n-gram's last symbol after the others; those not in the model back off."""
    out = np.zeros(len(gram))
    open_ = np.arange(len(gram))
    for k in range(len(model), 0, -1):
        keys, p, context, rest = model[k - 1]
        now = gram[open_] % symbols**k
        at = np.minimum(np.searchsorted(keys, now), len(keys) - 1)
        hit = keys[at] == now
        out[open_[hit]] += p[at[hit]]
        open_, now = open_[~hit], now[~hit]
        if not len(open_):
            return out
        at = np.minimum(np.searchsorted(context, now // symbols), len(context) - 1)
        known = context[at] == now // symbols
        out[open_[known]] += rest[at[known]]
    out[open_] -= np.log2(symbols)
    return out


def statistics(gram: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    """What a bucket adds to the whole model, (what, key, n): ``what`` 2: the counts of pairs of bytes; above: of that
    order's n-grams, how many have the count ``key``, 1 to 4."""
    found = levels(gram, n, 2, ORDER, 256)
    out = [pd.DataFrame({"what": 2, "key": found[0][0], "n": found[0][1]})]
    out += [pd.DataFrame({"what": k, "key": range(1, 5), "n": [int((c == i).sum()) for i in range(1, 5)]}) for k, (_, c) in enumerate(found[1:], 3)]
    return pd.concat(out)


class Top:
    """Probabilities of all pairs of bytes, and the discounts of the longer n-grams."""

    def __init__(self, rows: pd.DataFrame):
        pairs = rows[rows["what"] == 2].sort_values("key")
        pairs = (pairs["key"].to_numpy(np.int64), pairs["n"].to_numpy(np.int64))
        one = np.unique(pairs[0] % 256, return_counts=True)
        p = np.zeros(256)
        p[one[0]] = interpolate(one, _discounts(one[1]), np.full(len(one[0]), 1 / 256), 256)[0]
        self.pairs = np.zeros(65536)
        self.pairs[pairs[0]] = interpolate(pairs, _discounts(pairs[1]), p[pairs[0] % 256], 256)[0]
        n = {(w, k): int(v) for w, k, v in zip(rows["what"], rows["key"], rows["n"]) if w > 2}
        self.discounts = {k: _from_counts([n.get((k, i), 0) for i in range(1, 5)]) for k in range(3, ORDER + 1)}


def code_lengths(gram: np.ndarray, n: np.ndarray, top: Top) -> np.ndarray:
    """Code lengths of a bucket's distinct n-grams (ascending), in units of 1 / ``_SCALE`` of a bit."""
    below: Level = (np.arange(65536), top.pairs)
    for k, level in enumerate(levels(gram, n, 3, ORDER, 256), 3):
        lower = below[1][np.searchsorted(below[0], level[0] % 256 ** (k - 1))]
        below = (level[0], interpolate(level, top.discounts[k], lower, 256)[0])
    return np.rint(-np.log2(below[1]) * _SCALE).astype(np.int64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the last two bytes of the context."""
    return (common.mix64((keys >> np.uint64(8)) & np.uint64(0xFFFF)) % np.uint64(buckets)).astype(np.int64)


_RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _unpack(raw: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """(a batch's rows without its words, bytes of its words, bytes of each text)."""
    rows = pa.ipc.open_stream(raw).read_all().combine_chunks()
    words = FlatTexts(rows["words"].chunk(0) if len(rows) else pa.array([], pa.large_binary()))
    return rows.drop_columns(["words"]), words.data, np.diff(words.bounds)


def packed(docs: DataFrame) -> DataFrame:
    """(batch, rows): batches of documents with the base rules' counts and the bytes of their words."""

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, size = TaskContext.get().partitionId(), 0, 0
        held: list[pa.RecordBatch] = []

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            raw = _pack(pa.Table.from_batches(held))
            held.clear()
            batch, number, size = (part << 32) | number, number + 1, 0
            yield pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([raw], pa.binary())], ["batch", "rows"])

        def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal size
            flat = FlatTexts(batch.column(2))
            data, lengths = words_of(flat)
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(flat), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            rules = base_rules(flat)
            columns = [batch.column(0), batch.column(1), *[pa.array(rules[x]) for x in _RULES], words]
            held.append(pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", *_RULES, "words"]))
            size += len(data)
            if size >= BATCH_BYTES:
                yield from close()

        yield from common.in_batches(some, rows=1024, size=4 << 20)(stream)
        if held:
            yield from close()

    return docs.select("doc_id", "lang", common.text_bytes().alias("text")).mapInArrow(work, "batch long, rows binary")


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits), staged: bits of the whole text."""
    spark = docs.sparkSession
    buckets = 4 * common.parallelism(spark)
    # bucketed by batch as it is written: answers meet the batches' texts where those lie
    path, name = common.stage_path(spark, "packed"), f"packed_{uuid.uuid4().hex}"
    packed(docs).write.format("parquet").bucketBy(buckets, "batch").option("path", path).saveAsTable(name)
    made = spark.table(name)

    def deal(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in ((x.as_py(), y.as_py()) for given in stream for x, y in zip(given.column(0), given.column(1))):
            keys, n = counted(*_unpack(raw)[1:])
            where = bucket_of(keys, buckets)
            order = np.argsort(where, kind="stable")
            cut = np.searchsorted(where[order], np.arange(buckets + 1))
            out = [(b, order[cut[b] : cut[b + 1]]) for b in np.flatnonzero(np.diff(cut)).tolist()]
            columns = [[batch] * len(out), [b for b, _ in out], [chunked.squeeze_keys(keys[at]) for _, at in out], [chunked.squeeze(n[at]) for _, at in out]]
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], ["batch", "bucket", "keys", "counts"])
            common.give_back()

    chunks = common.stage(made.mapInArrow(deal, "batch long, bucket int, keys binary, counts binary"), "grams")

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return statistics(*chunked.gather(group)[:2])

    sums = chunks.groupBy("bucket").applyInPandas(add, "what int, key long, n long")
    # at most 256 x 256 rows and four for each longer order, whatever the data
    top = Top(sums.groupBy("what", "key").agg(F.sum("n").alias("n")).toPandas())

    def ask(group: pd.DataFrame) -> pd.DataFrame:
        keys, n, place, lengths = chunked.gather(group)
        found = np.split(code_lengths(keys, n, top)[place], np.cumsum(lengths)[:-1])
        return pd.DataFrame({"batch": group["batch"], "bucket": group["bucket"], "bits": [chunked.squeeze(x) for x in found]})

    answers = chunks.groupBy("bucket").applyInPandas(ask, "batch long, bucket int, bits binary")

    def finish(given: pa.Table, found: pa.Table) -> pa.Table:
        rows, data, lengths = _unpack(given["rows"][0].as_py())
        bits = np.zeros(len(rows))
        if len(data):
            keys, _ = counted(data, lengths)
            given_bits = np.concatenate([chunked.unsqueeze(x) for x in found.sort_by("bucket")["bits"].to_pylist()])
            cost = np.empty(len(keys))
            cost[np.argsort(bucket_of(keys, buckets), kind="stable")] = given_bits / _SCALE
            index = pd.Index(keys)
            for some, gram in stretches(data, lengths):
                text = np.repeat(np.arange(some.stop - some.start), lengths[some])
                bits[some] = np.bincount(text, cost[index.get_indexer(gram)], some.stop - some.start)
        common.give_back()
        return rows.append_column("bits", pa.array(bits))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, lang string, " + ", ".join(f"{x} long" for x in _RULES) + ", bits double"
    out = common.stage(made.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, schema), "perplexity")
    spark.sql(f"DROP TABLE {name}")
    common.drop_stage(spark, path)
    return out


def judge(docs: DataFrame, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """``measure``'s columns with base_failed, bits_per_word, low, high and kept."""
    common.prepare(docs.sparkSession)
    rows = measure(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    per_word = F.col("bits") / F.greatest(F.col("n_words"), F.lit(1))
    rows = rows.withColumns({"base_failed": failed, "bits_per_word": per_word})
    good = rows.filter(~F.col("base_failed"))
    quartiles = good.groupBy("lang").agg(F.percentile_approx("bits_per_word", [0.25, 0.5, 0.75], 1000).alias("q"))
    middle = quartiles.select(F.col("lang").alias("__lang"), F.col("q")[1].alias("__middle"))
    same = F.col("lang").eqNullSafe(F.col("__lang"))
    scale = F.sqrt(F.least(F.greatest(F.col("n_words"), F.lit(1)), F.lit(400)))
    away = good.join(middle, same).withColumn("__away", (F.col("bits_per_word") - F.col("__middle")) * scale)
    spread = away.groupBy("lang", "__middle").agg(F.percentile_approx("__away", [0.25, 0.75], 1000).alias("__q"))
    spread = common.stage(spread.withColumnRenamed("lang", "__lang"), "bands")  # one row per language
    rows = rows.join(spread, same, "left")
    low = F.col("__middle") + lower * F.least(F.col("__q")[0], F.lit(-0.01)) / scale
    high = F.col("__middle") + upper * F.greatest(F.col("__q")[1], F.lit(0.01)) / scale
    rows = rows.withColumns({"low": low, "high": high})
    inside = F.coalesce(F.col("bits_per_word").between(F.col("low"), F.col("high")), F.lit(True))
    return rows.withColumn("kept", ~F.col("base_failed") & inside).drop("__lang", "__middle", "__q", "bits")
