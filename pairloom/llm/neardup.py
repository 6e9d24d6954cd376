"""Near-duplicates by SuperMinHash: signatures, banding, verification on whole sets, union-find grouping.

SuperMinHash gives each element of a set a random permutation of the signature's places, drawn step by step: in step j
the element proposes j plus a random fraction for its j-th place, and each place keeps its smallest proposal. Places
are used up without replacement, so the places are negatively correlated and the estimate of a similarity varies less
than with independent hashes; and as soon as every place holds a value below j, no later step can change anything.
The steps run over all elements of a batch of documents at once.

From there on:

1. Documents with equal sets form a class; classes get signatures cut into bands (32 bands of 4 places: a pair at
   similarity 0.8 misses all bands with probability 5e-8).
2. In each bucket of a band the member that meets most others is the centre, and every other member is compared with
   it: as many pairs as members, not their square.
3. What passes a bound on the sizes and on the estimate (0.15 below the limit, over 4 deviations) is decided on whole
   sets of 64-bit hashes of the shingles. A pair right at the limit fails the estimate with a probability of up to 5e-5
   (independent places; SuperMinHash varies less), and is then found only through other links of its group. Links are grouped by distributed union-find.
4. Members that are not with their bucket's centre then meet all members of other groups there, on whole sets, in cells of
   bounded rows and shingles. A cell keeps the groups it has joined so far and skips pairs within one, so what leaves it
   is a forest over the groups it has seen: fewer links than rows came in, however similar they are. So no link is
   lost for the sake of the centres, only to the bands (and with the centre to the estimate) as said, and nothing is capped.
   Buckets of other bands with the very same members have no more to tell and are dropped at the start.

Defined results: a document without words has an empty set and links with nothing, itself apart; fewer words than a
shingle's width are one shingle; a null text is empty; a null doc_id comes after all others as a group's smallest;
rows that repeat are in one group; other columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import common
from pairloom.llm.flat import FlatTexts

PLACES, BANDS = 128, 32
WIDTH, PERCENT = 5, 80
#: An estimate may lie this far below the limit and the pair is still decided on whole sets.
MARGIN = 0.15
#: Members, and shingles, in a block of a bucket; a cell is two blocks.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
FILTER_BITS = 1 << 24


def signatures(elements: np.ndarray, owner: np.ndarray, n: int, places: int = PLACES) -> np.ndarray:
    """(n, places) SuperMinHash values of n sets; ``elements`` are distinct within their set (``owner``, ascending)."""
    out = np.full((n, places), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    low = np.uint64((1 << 48) - 1)
    table = None
    for step in range(places):
        if not len(elements):
            break
        draw = common.mix64(elements + np.uint64((step + 1) * 0x632BE59BD9B4E019 % 2**64))
        place = step + ((draw >> np.uint64(48)) % np.uint64(places - step)).astype(np.int64)
        value = (np.uint64(step) << np.uint64(48)) | (draw & low)
        if table is None:
            target, first = place, place
        else:
            row = np.arange(len(elements))
            target = table[row, place].astype(np.int64)
            table[row, place] = table[row, step]
            table[row, step] = target
        np.minimum.at(flat, owner * places + target, value)
        still = out.max(1) >= (np.uint64(step + 1) << np.uint64(48))
        keep = still[owner]
        if table is None:
            elements, owner, first = elements[keep], owner[keep], first[keep]
            table = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (len(elements), 1))
            row = np.arange(len(elements))
            table[row, first] = 0
            table[row, 0] = first
        elif not keep.all():
            elements, owner, table = elements[keep], owner[keep], table[keep]
    return out


def sets(flat: FlatTexts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, text of each), by text and hash."""
    runs, text, _ = flat.runs(width)
    few = np.flatnonzero((flat.words > 0) & (flat.words < width))
    if len(few):
        firsts = np.cumsum(flat.words) - flat.words
        whole = np.empty(len(few), np.uint64)
        for i, t in enumerate(few.tolist()):
            a = int(firsts[t])
            whole[i] = common.shingles(flat.hashes[a : a + int(flat.words[t])], width)[0]
        runs, text = np.concatenate([runs, whole]), np.concatenate([text, few])
    order = np.lexsort((runs, text))
    runs, text = runs[order], text[order]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
    return runs[first], text[first]


def _sign(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, digest, sig): sig holds 32 bits of each place, digest 128 bits of the set."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        flat = FlatTexts(batch.column(2), lower=True)
        n = len(flat)
        elements, owner = sets(flat, width)
        count = np.bincount(owner, minlength=n).astype(np.int64)
        sums = []
        for salt in (1, 2):
            mixed = common.mix64(elements ^ common.mix64(np.array([salt], np.uint64)))
            total = np.zeros(n, np.uint64)
            some = np.flatnonzero(count)
            if len(some):
                with np.errstate(over="ignore"):
                    total[some] = np.add.reduceat(mixed, (np.cumsum(count) - count)[some])
            sums.append(common.mix64(total ^ count.astype(np.uint64)))
        digest = np.ascontiguousarray(np.stack(sums, 1)).view(np.uint8).reshape(n, 16)
        sig = np.ascontiguousarray((common.mix64(signatures(elements, owner, n)) >> np.uint64(32)).astype("<u4"))
        raw = sig.view(np.uint8).reshape(n, 4 * PLACES)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(count),
                pa.array([x.tobytes() for x in digest], pa.binary()),
                pa.array([x.tobytes() for x in raw], pa.binary()),
            ],
            ["doc_id", "text_hash", "n_shingles", "digest", "sig"],
        )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = _rows(docs)
    schema = f"doc_id {id_type}, text_hash long, n_shingles long, digest binary, sig binary"
    return rows.mapInArrow(common.in_batches(work, rows=256, size=1 << 20), schema)


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))


def _estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(-1)


def _as_signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(len(column), PLACES)


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of those pairs that sizes and signatures do not rule out."""
    side = classes.select("node", "n_shingles", "sig")
    for x in "ab":
        pairs = pairs.join(side.toDF(x, f"n_{x}", f"sig_{x}"), x)
    pairs = pairs.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        near = _estimate(_as_signatures(batch.column(2)), _as_signatures(batch.column(3))) >= percent / 100 - MARGIN
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(near)) for i in (0, 1)], ["a", "b"])

    return pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(common.in_batches(work, rows=4096), "a long, b long")


def _needed_filter(spark: SparkSession, hashes: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, one per hash modulo their number: fixed in size, so it may go to the driver and to all tasks."""
    position = F.pmod(F.col("text_hash"), F.lit(FILTER_BITS))
    found = (
        hashes.select(position.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
        .collect()
    )
    bits = np.zeros(FILTER_BITS, bool)
    for row in found:
        if row.bucket == 0:  # holds nothing but the value 0
            bits[0] = True
            continue
        part = np.unpackbits(np.frombuffer(bytes(row.bits), np.uint8), bitorder="little")
        bits[(row.bucket - 1) * len(part) + 1 + np.flatnonzero(part)] = True  # position p of bucket b
    return bits


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, elements): whole sets, made again for the classes in question only."""
    spark = docs.sparkSession
    wanted = common.stage(nodes.distinct().join(classes.select("node", "doc_id", "text_hash"), "node"), "wanted")
    bits = spark.sparkContext.broadcast(np.packbits(_needed_filter(spark, wanted)))

    def make(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bit = batch.column(1).to_numpy().astype(np.int64) % FILTER_BITS
        hit = (bits.value[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1
        batch = batch.filter(pa.array(hit.astype(bool)))
        flat = FlatTexts(batch.column(2), lower=True)
        elements, owner = sets(flat, width)
        raw = elements.tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(flat))).tolist() if len(flat) else []
        out = [raw[8 * a : 8 * b] for a, b in zip([0, *ends], ends)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "text_hash", "elements"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    made = _rows(docs).mapInArrow(common.in_batches(make, rows=1024, size=4 << 20), f"doc_id {id_type}, text_hash long, elements binary")
    made = made.withColumnRenamed("doc_id", "__id")
    made = made.join(wanted, (F.col("__id").eqNullSafe(F.col("doc_id"))) & (made["text_hash"] == wanted["text_hash"]))
    return common.stage(made.groupBy("node").agg(F.min("elements").alias("elements")), "sets")


def _verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose whole sets reach the limit."""
    made = _sets(docs, classes, pairs.select(F.col("a").alias("node")).union(pairs.select("b")), width)

    def decide(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep = []
        for a, b in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
            common_ = len(a) + len(b) - len(np.union1d(a, b))
            keep.append(100 * common_ >= percent * (len(a) + len(b) - common_))
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep, pa.bool_())) for i in (0, 1)], ["a", "b"])

    both = pairs.join(made.toDF("a", "set_a"), "a").join(made.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(common.in_batches(decide, rows=4096), "a long, b long")


def union_find(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest node of its group.

    Distributed union-find by alternating stars: every node hooks its larger neighbours on the smallest node it knows,
    then its smaller ones, until the forest is flat. Rounds grow with the logarithm of the longest chain.
    """
    ordered = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges = common.stage(ordered, "links")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = common.stage(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = common.stage(small.union(least.toDF("u", "v")).distinct(), "small_star")
        # flat: nobody has two parents, and no parent has one
        twice = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
        if twice.isEmpty() and edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty():
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.toDF("node", "root").union(roots.select("node", F.col("node").alias("root")))


def _members(classes: DataFrame) -> DataFrame:
    """(key, node, n_shingles, size) of the buckets that hold two classes or more; of buckets with the same members, one."""
    size = 4 * PLACES // BANDS
    band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.substring("sig", i * size + 1, F.lit(size))))
    rows = classes.filter("n_shingles > 0").select("node", "n_shingles", band.alias("band", "part"))
    rows = rows.select(F.xxhash64("band", "part").alias("key"), "node", "n_shingles")
    content = [F.bit_xor(F.xxhash64("node", F.lit(salt))).alias(f"content_{salt}") for salt in (1, 2)]
    shared = rows.groupBy("key").agg(F.count("*").alias("size"), *content).filter("size > 1")
    shared = shared.groupBy("size", "content_1", "content_2").agg(F.min("key").alias("key")).select("key", "size")
    return common.stage(rows.join(shared, "key"), "members")


def _centres(members: DataFrame) -> DataFrame:
    """(key, centre): the member that meets most others in all its buckets."""
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    best = F.max(F.struct("met", (-F.col("node")).alias("less"))).alias("best")
    return members.join(met, "node").groupBy("key").agg(best).select("key", (-F.col("best.less")).alias("centre"))


def _forest(roots: np.ndarray, sizes: np.ndarray, elements: np.ndarray, some: np.ndarray, every: np.ndarray, percent: int) -> list[tuple]:
    """Links (root, root) that join what whole sets join of ``some`` with ``every`` (places in the arrays), none twice."""
    distinct, group = np.unique(roots, return_inverse=True)
    code = np.unique(elements, return_inverse=True)[1]
    ends = np.cumsum(sizes)
    theirs = np.concatenate([code[ends[i] - sizes[i] : ends[i]] for i in every])
    starts = np.cumsum(sizes[every]) - sizes[every]
    flag = np.zeros(int(code.max()) + 1, bool)
    label = np.arange(len(distinct))
    links = []
    for x in some.tolist():
        other = label[group[every]] != label[group[x]]
        other &= 100 * np.minimum(sizes[every], sizes[x]) >= percent * np.maximum(sizes[every], sizes[x])
        if not other.any():
            continue
        mine = code[ends[x] - sizes[x] : ends[x]]
        flag[mine] = True
        both = np.add.reduceat(flag[theirs], starts, dtype=np.int64)
        flag[mine] = False
        met = group[every[other & (100 * both >= percent * (sizes[every] + sizes[x] - both))]]
        for k in np.unique(label[met], return_index=True)[1]:
            links.append((distinct[group[x]], distinct[met[k]]))
        label[np.isin(label, label[met])] = label[group[x]]
    return links


def _rest_links(docs: DataFrame, members: DataFrame, classes: DataFrame, groups: DataFrame, centres: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): groups to be joined, by links in a bucket other than with its centre. A group is its root, or a node alone."""
    mine = members.filter("size > 2").join(groups, "node", "left")
    mine = mine.withColumn("root", F.coalesce("root", "node"))
    root_of = groups.select(F.col("node").alias("centre"), F.col("root").alias("major"))
    heads = centres.join(root_of, "centre", "left").withColumn("major", F.coalesce("major", "centre"))
    mine = mine.join(heads, "key").filter("node != centre").withColumn("minor", F.col("root") != F.col("major"))
    counts = [F.count_if("minor").alias("n_minor"), F.sum(F.when(F.col("minor"), F.col("n_shingles"))).alias("of_minor"), F.sum("n_shingles").alias("of_all")]
    left = mine.groupBy("key").agg(*counts).filter("n_minor > 0")
    blocks = lambda n, of: F.greatest(F.ceil(F.col(n) / BLOCK), F.ceil(F.col(of) / BLOCK_SHINGLES)).cast("int")
    mine = mine.join(left, "key").select("key", "node", "root", "minor", blocks("size", "of_all").alias("n_all"), blocks("n_minor", "of_minor").alias("n_some"))
    mine = common.stage(mine, "rest")
    sets = _sets(docs, classes, mine.select("node"), width)
    # cells of a block of all and a block of minor members, by hashes of the node; most buckets have one
    own, part = F.pmod(F.xxhash64("node"), "n_all").cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), "n_some").cast("int")
    cell = lambda i, j, every, some: F.struct(i.alias("i"), j.alias("j"), every.alias("every"), some.alias("some"))
    as_all = F.transform(F.sequence(F.lit(0), F.col("n_some") - 1), lambda j: cell(F.col("own"), j, F.lit(True), F.col("minor") & (j == F.col("part"))))
    as_minor = F.transform(F.sequence(F.lit(0), F.col("n_all") - 1), lambda i: cell(i, F.col("part"), F.lit(False), F.col("minor") & (i != F.col("own"))))
    cells = F.explode(F.concat(as_all, F.filter(as_minor, lambda c: c["some"]))).alias("cell")
    rows = mine.withColumns({"own": own, "part": part}).join(sets, "node").select("key", "root", "elements", cells)
    row = F.struct("root", "cell.every", "cell.some", "elements")
    met = rows.groupBy("key", "cell.i", "cell.j").agg(F.collect_list(row).alias("rows")).select("rows")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                given = batch.column(0)[i].values
                roots = given.field("root").to_numpy()
                every, some = (np.flatnonzero(given.field(x).to_numpy(zero_copy_only=False)) for x in ("every", "some"))
                if len(every) and len(some):
                    raw = given.field("elements").to_pylist()
                    sizes = np.array([len(x) // 8 for x in raw], np.int64)
                    found += _forest(roots, sizes, np.frombuffer(b"".join(raw), np.uint64), some, every, percent)
            a, b = np.array(found, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
            common.give_back()

    return common.stage(met.mapInArrow(work, "a long, b long"), "rest_links")


def group(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept, representative) of every row of (doc_id, text).

    ``kept``: doc_id is its group's smallest. ``representative``: the same, and of equal ids the smallest text hash.
    """
    common.prepare(docs.sparkSession)
    signed = common.stage(_sign(docs, width), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "n_shingles", "sig")
    classes = signed.filter("n_shingles > 0").groupBy("digest").agg(F.min(order).alias("best"))
    classes = common.stage(classes.select(F.monotonically_increasing_id().alias("node"), "digest", "best.*"), "classes")
    members = _members(classes)
    centres = common.stage(_centres(members), "centres")
    pairs = members.join(centres, "key").filter("node != centre")
    pairs = pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    likely = common.stage(_likely(pairs, classes, percent), "likely")
    links = common.stage(_verify(docs, classes, likely, width, percent), "star_links")
    groups = union_find(links)
    joined = union_find(_rest_links(docs, members, classes, groups, centres, width, percent))
    groups = classes.select("node", "digest", "no_id", "doc_id", "text_hash").join(groups, "node", "left")
    groups = groups.withColumn("root", F.coalesce("root", "node")).join(joined.toDF("root", "whole"), "root", "left")
    groups = groups.withColumn("root", F.coalesce("whole", "root"))
    heads = groups.groupBy("root").agg(F.min(F.struct("no_id", "doc_id", "text_hash")).alias("head"))
    heads = groups.join(heads, "root").select("digest", F.col("head.doc_id").alias("component_id"), F.col("head.text_hash").alias("__head"))
    heads = common.stage(heads, "heads")
    rows = signed.drop("sig").join(heads, "digest", "left")
    alone = F.col("n_shingles") == 0
    rows = rows.withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    first = alone | (kept & (F.col("text_hash") == F.col("__head")))
    return rows.select("doc_id", "text_hash", "n_shingles", "component_id", kept.alias("kept"), first.alias("representative"))


def without_near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each group, with all columns. Rows that repeat id and text are left as they are: they are exact
    copies, which exact dedup removes."""
    chosen = group(docs, width, percent).filter("representative").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    marked = docs.withColumn("__text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    return marked.join(chosen, same, "left_semi").drop("__text_hash")
