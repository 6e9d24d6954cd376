"""The queries of this package on the given tables, and SQL equivalents where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import classifier, common, ctw, exactdedup, hostsuffix, mixing, neardup, packing, perplexity, prefixtrie, sharding, spelling, substrings, tokenfiles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return common.table(spark, folder, "documents")


SQL_OP6 = r"""
WITH sized AS (
    SELECT doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           len(regexp_extract_all(coalesce(text, ''), '[0-9#*$%&|<>{}=_~^/]+')) AS runs,
           (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM documents
), keyed AS (
    SELECT *, ln(u) / -greatest(0.1::DOUBLE, 1 - runs::DOUBLE / greatest(size, 1)) AS key FROM sized
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS w
    FROM keyed GROUP BY source
), ordered AS (
    SELECT *, 3 * source_size AS lim, sum(source_size) OVER () AS total,
           coalesce(sum(3 * source_size) OVER upto, 0) AS full_, sum(w) OVER () - coalesce(sum(w) OVER upto, 0) AS open_
    FROM sources
    WINDOW upto AS (ORDER BY 3 * source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
    SELECT *, (total - full_)::DOUBLE / open_ AS lev FROM ordered
), goal AS (
    SELECT source, source_size,
           least(lim::DOUBLE, w * (SELECT min_by(lev, full_) FROM levels WHERE lev * w <= lim)) AS target
    FROM levels
), running AS (
    SELECT k.doc_id, k.size, k.source, g.source_size, g.target,
           CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS epochs,
           sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) - k.size AS before
    FROM keyed k JOIN goal g ON k.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, source, size, source_size, target,
       CAST(size * (epochs + CASE WHEN size > 0 AND target - epochs * source_size > 0
                                   AND before + size / 2.0::DOUBLE <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM running
"""


@query("op6_mix_sources", SQL_OP6)
def op6_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, mixed with weights 1, 2, 3 to as many words as they hold."""
    return mixing.mix(documents(spark, folder), keep=["doc_id", "source"]).drop("copies")


SQL_OP8 = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), k AS (
    SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""


@query("op8_exact_dedup", SQL_OP8)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, indexed in two waves: the second meets the first by the anti-join on the bucketed index.

    The index is new, and dropped once the decisions are written.
    """
    index = exactdedup.DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    rows = index.add(documents(spark, folder), "documents", waves=2)
    rows = common.stage(rows.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest"), "decisions")
    spark.sql(f"DROP TABLE {index.name}")
    return rows


_DRAWS = ", ".join(
    f"ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{i}'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / -1.0::DOUBLE"
    for i in range(17)
)
SQL_OP10 = f"""
WITH RECURSIVE steps(byte, step, value) AS (
    SELECT range, 0, range::UBIGINT FROM range(256)
    UNION ALL
    SELECT byte, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384::UBIGINT) ELSE value >> 1 END FROM steps WHERE step < 8
), crc_table AS (
    SELECT list(value ORDER BY byte) AS t FROM steps WHERE step = 8
), crcs AS (
    SELECT doc_id, text, CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: CAST('0x' || x AS UBIGINT))),
               lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295::UBIGINT) AS BIGINT) AS text_crc32
    FROM documents, crc_table
), d AS (
    SELECT doc_id, text_crc32, strlen(coalesce(text, '')) + 1 AS size, text, [{_DRAWS}] AS draws,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 4096 AS bucket
    FROM crcs
), s AS (
    SELECT doc_id, text_crc32, size, bucket, CAST(list_position(draws[1:16], list_min(draws[1:16])) - 1 AS INTEGER) AS shard,
           CAST(list_position(draws, list_min(draws)) - 1 AS INTEGER) AS grown_shard
    FROM d
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id) - 1 AS BIGINT) AS slot
FROM s
"""


@query("op10_shard_by_rendezvous", SQL_OP10)
def op10_shard_by_rendezvous(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of equal weight, by their ids."""
    rows = sharding.shard(documents(spark, folder), [1.0] * 16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long"), "grown_shard")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_quality_classifier")
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents; labels are learned from where crc32(doc_id) mod 5 is not 0."""
    docs = documents(spark, folder)
    labels = common.table(spark, folder, "labels").filter(common.crc_mod(F.col("doc_id"), 5) != 0)
    rows = classifier.score(docs.select("doc_id", "text"), classifier.learn(docs, labels)).drop("text")
    return rows.select(
        "doc_id",
        (common.crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= classifier.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op2_token_planes")
def op2_token_planes(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as planes of token ids and read back."""
    path = common.stage_path(spark, "token_files")
    tokenfiles.write_tokens(documents(spark, folder), path, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return tokenfiles.read_tokens(spark.read.schema(tokenfiles.SEGMENTS).parquet(path), digests=True)


@query("op5_pack_harmonic")
def op5_pack_harmonic(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids."""
    return packing.pack(documents(spark, folder), tokenizer_path("word_bpe_49k.json"), end_id=2, digests=True)


@query("op9_perplexity_rules")
def op9_perplexity_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and perplexity bands of all documents."""
    return perplexity.judge(documents(spark, folder)).drop("lang")


SQL_OP3 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                        ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
    FROM w
), e AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (
    SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), c AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN c USING (doc_id)
"""


@query("op3_super_minhash", SQL_OP3)
def op3_super_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, grouped by 2-word shingles at 80 percent."""
    rows = neardup.group(documents(spark, folder).select("doc_id", "text"), width=2, percent=80)
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


@query("op4_context_tree_weighting")
def op4_context_tree_weighting(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents; learned from those whose crc32(doc_id) mod 7 is not 2."""
    rows = ctw.score(documents(spark, folder).select("doc_id", "text"), common.crc_mod(F.col("doc_id"), 7) != 2)
    return rows.withColumn("held_out", ~F.col("train")).drop("train")


@query("op7_host_suffix_array")
def op7_host_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    """Main texts of all pages."""
    rows = hostsuffix.extract(common.table(spark, folder, "pages"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))


SQL_OP11 = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, sha256(array_to_string(w[i : i + 49], ' ')) AS h FROM w, unnest(range(1, len(w) - 48)) AS t(i)
), low AS (
    SELECT h, min(doc_id) AS low FROM windows GROUP BY h
), gone AS (
    SELECT doc_id, list(DISTINCT j) AS gone FROM windows JOIN low USING (h), unnest(range(i, i + 50)) AS t(j) WHERE doc_id > low GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE [w[k] FOR k IN range(1, len(w) + 1) IF NOT list_contains(gone, k)] END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""


@query("op11_substring_dedup", SQL_OP11)
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the words that windows of 50 words share with documents of smaller ids."""
    rows = substrings.without_repeats(documents(spark, folder).select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL_CRC_TABLE = """
steps(byte, step, value) AS (
    SELECT range, 0, range::UBIGINT FROM range(256)
    UNION ALL
    SELECT byte, step + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384::UBIGINT) ELSE value >> 1 END FROM steps WHERE step < 8
), crc_table AS (
    SELECT list(value ORDER BY byte) AS t FROM steps WHERE step = 8
)"""


def sql_crc32(text: str) -> str:
    """crc32 of a string's UTF-8 bytes, with ``t`` of crc_table in scope."""
    return f"""CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
               regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS UBIGINT))),
               lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295::UBIGINT) AS BIGINT)"""


SQL_OP12 = rf"""
WITH RECURSIVE {SQL_CRC_TABLE}, own AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
    SELECT conv_id, ts, {sql_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own, crc_table
), built AS (
    SELECT o.conv_id, list_concat(coalesce(b.ts[1:h], []), o.ts[h + 1:]) AS ts FROM hashed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), keyed AS (
    SELECT conv_id, len(ts) AS n, list_transform(ts, lambda x: length(x.r) || ':' || x.r || length(x.t) || ':' || x.t) AS parts,
           list_transform(ts, lambda x: len(regexp_extract_all(x.t, '[^\x20\x09-\x0D]+'))) AS words
    FROM built
), prefix AS (
    SELECT conv_id, d, n = d AS done, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, parts[1:d] AS parts,
           [sha256(array_to_string(parts[1:a], '')) FOR a IN range(0, d + 1)] AS path
    FROM keyed, unnest(range(0, n + 1)) AS u(d)
), nodes AS (
    SELECT path[-1] AS key, any_value(d) AS depth, any_value(path) AS path, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE done), '') AS ids
    FROM prefix GROUP BY path[-1]
), kids AS (
    SELECT path[-2] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY path[-2]
), full_ AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (key)
), sums AS (
    SELECT a AS key, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved FROM full_, unnest(path) AS u(a) GROUP BY a
)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(f.ids) AS ends_sha256
FROM full_ f JOIN sums USING (key) LEFT JOIN nodes p ON f.depth > 0 AND p.key = f.path[-2]
"""


@query("op12_prefix_trie", SQL_OP12)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefixtrie.build(common.table(spark, folder, "conversations"))


SQL_OP13 = rf"""
WITH RECURSIVE {SQL_CRC_TABLE}, runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents
), found AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {sql_crc32("doc_id || ':' || run")} AS h FROM found, crc_table
), changed AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), skips AS (
    SELECT word, n, i, substr(word, 1, i) || '*' || substr(word, i + 2) AS gap, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM words, unnest(range(0, length(word))) AS x(i)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM skips a JOIN skips b ON a.gap = b.gap AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM skips a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM skips a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min_by(other, (-n, encode(other))) AS other, max(n) AS other_n FROM near GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
           CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
    FROM words w LEFT JOIN best USING (word)
), walk(word, here, form) AS (
    SELECT word, word, form FROM forms
    UNION ALL
    SELECT walk.word, f.word, f.form FROM walk JOIN forms f ON walk.form = f.word
)
SELECT f.word, f.form, walk.here AS root, f.n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM forms f JOIN walk ON f.word = walk.word AND walk.form IS NULL
"""


@query("op13_spelling_variants", SQL_OP13)
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of at least 7 letters that occur twice or more, and what they are probably a variant of."""
    found = spelling.counts(documents(spark, folder).select("doc_id", "text"), 7, spelling.dropped_letter)
    return spelling.variants(found.filter("n >= 2"))
