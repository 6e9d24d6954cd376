"""The trie of conversation prefixes in node tables: perfect hash slots, flat arrays, sums through parent slots.

1. Turns are numbered and prefixes digested by running values over one range exchange each, so a conversation may hold
   any share of the turns. A prefix's digest is 128 bits: xor of a hash of every turn with its place.
2. Equal digests are a node. What would differ if two prefixes had one digest (depth, parent, last turn) is compared
   while they are grouped, and the job fails if it does.
3. Nodes with the same members are a chain, named by its smallest member and their number; only chains branch or end.
   Along a chain everything follows from its last node and from running word counts, so there are at most two chains a
   conversation, however long conversations are.
4. Chains with more than ``cap`` members are heavy. Each row of the input lies in one node, so there are at most rows /
   cap of them. The rest hangs below them in light subtrees of at most 2 cap chains. Subtrees are dealt over shards by
   the digest of their topmost node: a hot first turn is heavy, and its children spread.
5. A shard gives its digests slots by a minimal perfect hash function, which keeps each slot's digest and compares it
   on every look-up. Counts go to flat arrays by slot, an array holds each node's parent slot, and sums flow up in
   depth order. What light subtrees come to is added up per heavy parent, and the heavy chains are one more table.
6. ``ends`` are hashed in a stream per node: sorted by number in the shuffle, never held as a list.

Defined results: rows without a conv_id belong to no conversation; a null role or text is empty; turns of one number
are ordered by role and text; rows that repeat are turns each; other columns are not looked at; no conversations, no
nodes, not even the root. A negative conv_id keeps its sign in conv_id % 20.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm import common
from pairloom.operators.scan import Running, running_values

#: Members of a chain that make it heavy, at least; heavy chains, at most (a power of two); chains of a shard, about.
CAP, HEAVY_BITS, SHARD = 1024, 18, 1 << 16
_NONE = hashlib.sha256(b"").hexdigest()


class PerfectSlots:
    """Slots 0 to n - 1 for n distinct 128-bit keys: each level places the keys that are alone in their cell, a table
    twice as large as what is left; a look-up compares the key that its slot holds."""

    def __init__(self, keys: np.ndarray):
        left, done = np.arange(len(keys)), 0
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.keys = np.empty_like(keys)
        while len(left):
            if len(self.levels) == 200:
                raise ValueError("keys repeat")
            cell = self._cell(keys[left], len(self.levels), 2 * len(left))
            alone = np.bincount(cell, minlength=2 * len(left)) == 1
            self.levels.append((alone, done + np.cumsum(alone) - 1))
            placed = alone[cell]
            self.keys[self.levels[-1][1][cell[placed]]] = keys[left[placed]]
            done += int(placed.sum())
            left = left[~placed]

    @staticmethod
    def _cell(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        mixed = common.mix64(keys[:, 0] ^ common.mix64(keys[:, 1] + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)))
        return (mixed % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for those that have none."""
        out, left = np.full(len(keys), -1), np.arange(len(keys))
        for level, (alone, slot) in enumerate(self.levels):
            cell = self._cell(keys[left], level, len(alone))
            found = alone[cell]
            out[left[found]] = slot[cell[found]]
            left = left[~found]
        hit = np.flatnonzero(out >= 0)
        wrong = (self.keys[out[hit]] != keys[hit]).any(1)
        out[hit[wrong]] = -1
        return out


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n_turns) and (conv_id, place, a, b, words): a and b are hashes of role and text.

    A conversation is rebuilt from the first h turns of conversation conv_id - conv_id % 20 and its own after h.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    words = F.size(F.regexp_extract_all(text, F.lit(common.WORD_PATTERN), F.lit(0))).cast("long")
    rows = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # what orders turns of one number is their text itself, so it travels once
    rows = running_values(rows, ["conv_id"], ["turn", "role", "text"], place=Running(F.lit(1), include_current=False))
    a, b = F.xxhash64("role", "text"), F.xxhash64(F.lit(1), "text", F.lit("/"), "role")
    rows = common.stage(rows.select("conv_id", "place", a.alias("a"), b.alias("b"), words.alias("words")), "turns")

    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    own = rows.groupBy("conv_id").agg(F.count("*").alias("own"))
    own = common.stage(own.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("base")), "own")
    given = own.join(own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own")), "base", "left")
    given = given.withColumn("given", F.least(F.coalesce("base_own", F.lit(0)), "h"))
    given = common.stage(given.withColumn("n_turns", F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "given")
    heads = rows.filter("place < 3 AND conv_id % 20 = 0").withColumnRenamed("conv_id", "base")
    taken = heads.join(given.select("conv_id", "base", "given"), "base").filter("place < given")
    rest = rows.join(given.select("conv_id", "given", "h"), "conv_id").filter("place >= h")
    rest = rest.withColumn("place", F.col("given") + F.col("place") - F.col("h"))
    columns = ["conv_id", "place", "a", "b", "words"]
    return given.select("conv_id", "n_turns"), taken.select(*columns).union(rest.select(*columns))


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, depth, d1, d2, p1, p2, words, upto) of all prefixes: digest, the parent's digest, words of the last
    turn and of all turns; the root has depth 0 and no parent."""
    one, two = F.xxhash64("a", "place"), F.xxhash64("place", "b")
    rows = running_values(turns.withColumns({"t1": one, "t2": two}), ["conv_id"], ["place"],
                          d1=Running(F.col("t1"), "xor"), d2=Running(F.col("t2"), "xor"), upto=Running(F.col("words")))
    rows = rows.select(
        "conv_id", (F.col("place") + 1).alias("depth"), "d1", "d2", F.col("d1").bitwiseXOR(F.col("t1")).alias("p1"),
        F.col("d2").bitwiseXOR(F.col("t2")).alias("p2"), "words", "upto",
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), none.alias("p1"), none.alias("p2"), zero.alias("words"), zero.alias("upto"))
    return rows.union(root)


def trie_nodes(rows: DataFrame) -> DataFrame:
    """(d1, d2, depth, p1, p2, words, upto, conv_id, n_convs): distinct prefixes with their smallest member."""
    same = ["depth", "p1", "p2", "words", "upto"]
    found = rows.groupBy("d1", "d2").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"__{c}") for c in same]
    )
    differ = F.lit(False)
    for c in same:
        differ = differ | ~F.col(c).eqNullSafe(F.col(f"__{c}"))
    check = F.when(differ, F.raise_error(F.lit("two prefixes have one digest"))).otherwise(F.col("n_convs"))
    return found.select("d1", "d2", *same, "conv_id", check.cast("long").alias("n_convs"))


def chains(nodes: DataFrame) -> DataFrame:
    """(conv_id, n_convs, top, bottom, p1, p2, d1, d2, before, upto): parent of the first node, digest of the last."""
    first = F.min(F.struct("depth", "p1", "p2", (F.col("upto") - F.col("words")).alias("before"))).alias("first")
    last = F.max(F.struct("depth", "d1", "d2", "upto")).alias("last")
    rows = nodes.groupBy("conv_id", "n_convs").agg(first, last)
    return rows.select(
        "conv_id", "n_convs", F.col("first.depth").alias("top"), F.col("last.depth").alias("bottom"), "first.p1", "first.p2",
        "last.d1", "last.d2", "first.before", "last.upto",
    )


_RESULT = "conv_id long, n_convs long, d1 long, d2 long, p1 long, p2 long, children long, leaves long, saved long, below long, parent long"


def _accumulate(table: pa.Table) -> pa.Table:
    """Sums of one shard: rows are its chains, with what has come to them from other shards already."""
    get = lambda name: table.column(name).to_numpy()
    keys = np.stack([get("d1"), get("d2")], 1).view(np.uint64)
    parents = np.stack([table.column(c).fill_null(0).to_numpy() for c in ("p1", "p2")], 1).view(np.uint64)
    hashed = PerfectSlots(keys)
    slot = hashed.slots(keys)
    n = len(keys)

    def by_slot(values: np.ndarray) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[slot] = values
        return out

    has_parent = table.column("p1").is_valid().to_numpy()
    up = by_slot(np.where(has_parent, hashed.slots(parents), -1))
    depth, conv = by_slot(get("top")), by_slot(get("conv_id"))
    children, leaves, below = (by_slot(get(c)) for c in ("got_children", "got_leaves", "got_saved"))
    saved = by_slot((get("n_convs") - 1) * (get("upto") - get("before")))
    np.add.at(children, up[up >= 0], 1)
    leaves[children == 0] = 1
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        saved[level] += below[level]
        some = level[up[level] >= 0]
        np.add.at(leaves, up[some], leaves[some])
        np.add.at(below, up[some], saved[some])
    parent = pa.array(conv[up][slot], mask=(up < 0)[slot])
    out = {c: table.column(c) for c in ("conv_id", "n_convs", "d1", "d2", "p1", "p2")}
    out |= {name: pa.array(x[slot]) for name, x in (("children", children), ("leaves", leaves), ("saved", saved), ("below", below))}
    return pa.table(out | {"parent": parent})


def chain_sums(rows: DataFrame, found: DataFrame, cap: int) -> DataFrame:
    """Results of all ``found`` chains in the form of ``_RESULT``; ``rows`` are the prefixes, with n_convs."""
    light = F.col("n_convs") <= cap
    # the first light node of a member's path names the subtree that a chain lies in
    homes = rows.filter(light).groupBy("conv_id").agg(F.min(F.struct("depth", "d1", "d2")).alias("home"))
    shards = max(common.parallelism(rows.sparkSession), -(-found.count() // SHARD))
    zero = F.lit(0).cast("long")
    nothing = {c: zero for c in ("got_children", "got_leaves", "got_saved")}
    dealt = found.filter(light).withColumns(nothing).join(homes, "conv_id")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("home.d1", "home.d2"), F.lit(shards))).drop("home")
    low = common.stage(dealt.groupBy("shard").applyInArrow(_accumulate, _RESULT), "light")

    tops = low.filter("parent IS NULL AND p1 IS NOT NULL").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
        F.count("*").alias("got_children"), F.sum("leaves").alias("got_leaves"), F.sum("saved").alias("got_saved")
    )
    heavy = found.filter(~light).join(tops, ["d1", "d2"], "left").fillna(0, list(nothing))
    high = common.stage(heavy.withColumn("shard", F.lit(0)).groupBy("shard").applyInArrow(_accumulate, _RESULT), "heavy")
    above = high.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("heavy_parent"))
    low = low.join(above, ["p1", "p2"], "left").withColumn("parent", F.coalesce("parent", "heavy_parent"))
    return low.select(*high.columns).union(high)


def ends(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """(d1, d2, ends_sha256): hash of the comma-joined ids, ascending, of the conversations that end at a node."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []
        for batch in batches:
            a, b, ids = (batch.column(i).to_numpy() for i in range(3))
            new = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            for i, j in zip([0, *new.tolist()], [*new.tolist(), len(ids)]):
                if i == j:
                    continue
                text = ",".join(map(str, ids[i:j].tolist()))
                if key == (a[i], b[i]):
                    state.update(b"," + text.encode())
                    continue
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (a[i], b[i]), hashlib.sha256(text.encode())
            yield flush(done)
            done = []
        if key:
            yield flush([(*key, state.hexdigest())])

    def flush(done: list) -> pa.RecordBatch:
        columns = list(zip(*done)) or [[], [], []]
        types = [pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["d1", "d2", "ends_sha256"])

    last = rows.join(convs.withColumnRenamed("n_turns", "depth"), ["conv_id", "depth"]).select("d1", "d2", "conv_id")
    parts = common.parallelism(rows.sparkSession)
    sorted_ = last.repartition(parts, "d1", "d2").sortWithinPartitions("d1", "d2", "conv_id")
    return sorted_.mapInArrow(work, "d1 long, d2 long, ends_sha256 string")


def build(conversations: DataFrame, cap: int | None = None) -> DataFrame:
    """Every node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    common.prepare(conversations.sparkSession)
    convs, turns = rebuilt_turns(conversations)
    rows = common.stage(prefixes(convs, turns), "prefixes")
    nodes = common.stage(trie_nodes(rows), "nodes")
    if cap is None:
        cap = max(CAP, rows.count() >> HEAVY_BITS)
    found = common.stage(chains(nodes), "chains")
    counted = rows.select("conv_id", "depth", "d1", "d2").join(nodes.filter(F.col("n_convs") <= cap).select("d1", "d2", "n_convs"), ["d1", "d2"])
    sums = common.stage(chain_sums(counted, found, cap), "sums")

    chain = found.select("conv_id", "n_convs", "top", "bottom", F.col("upto").alias("chain_upto"))
    chain = chain.join(sums.select("conv_id", "n_convs", "children", "leaves", "below", "parent"), ["conv_id", "n_convs"])
    out = nodes.join(chain, ["conv_id", "n_convs"]).join(ends(convs, rows), ["d1", "d2"], "left")
    last: Column = F.col("depth") == F.col("bottom")
    return out.select(
        "conv_id", "depth",
        F.when(F.col("depth") == F.col("top"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n_convs") - 1) * (F.col("chain_upto") - F.col("upto") + F.col("words"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256"),
    )
