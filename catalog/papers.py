"""Papers, files, pages, archives and includes."""

from __future__ import annotations

import gzip
import io
import tarfile
import uuid

import pandas as pd
from pyspark.sql import functions as F

from catalog.base import query, spread, sql_trim, table
from pairloom.functions import cleaning as C
from pairloom.functions.workers import in_parts, ship_by_value, small_batches
from pairloom.operators import papers as PA
from pairloom.operators.includes import expand_includes
from pairloom.session import ensure_checkpoint_dir
from pairloom.sources import archivesource as AS
from pairloom.sources.archives import unpack_archives
from pairloom.sources.files import decode_tex, to_base64
from pairloom.sources.pages import page_meta as read_meta
from pairloom.sources.tei import tei_elements as read_tei

ship_by_value(__name__)

# Orders as papers and their line items as files: returned items are PDFs with or without a paper id,
# others LaTeX or other files.
_SQL_FILES = """SELECT l_orderkey AS paper_id,
      CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber < 6 THEN l_orderkey || '.' || l_partkey ELSE 'figure' || l_partkey END || '.pdf'
           ELSE l_partkey || '_' || l_suppkey || CASE WHEN l_linestatus = 'O' THEN '.tex' ELSE '.bib' END END AS path,
      CASE WHEN l_returnflag = 'R' THEN 'pdf' WHEN l_linestatus = 'O' THEN 'tex' ELSE 'bib' END AS kind FROM lineitem"""


def _files(spark, d):
    text = lambda c: F.col(c).cast("string")
    pdf = F.when(
        F.col("l_linenumber") < 6, F.concat(text("l_orderkey"), F.lit("."), text("l_partkey"))
    ).otherwise(F.concat(F.lit("figure"), text("l_partkey")))
    source = F.concat(
        text("l_partkey"), F.lit("_"), text("l_suppkey"), F.when(F.col("l_linestatus") == "O", ".tex").otherwise(".bib")
    )
    returned = F.col("l_returnflag") == "R"
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("paper_id"),
        F.when(returned, F.concat(pdf, F.lit(".pdf"))).otherwise(source).alias("path"),
        F.when(returned, "pdf").when(F.col("l_linestatus") == "O", "tex").otherwise("bib").alias("kind"),
    )


@query(
    "complete_papers",
    rf"""WITH f AS ({_SQL_FILES}),
        c AS (SELECT paper_id, max(path) FILTER (kind = 'pdf' AND regexp_matches(path, '^\d+\.\d+\.pdf')) AS pdf_path,
                     count(*) FILTER (kind = 'tex') AS n_tex FROM f GROUP BY paper_id),
        x AS (SELECT o_orderkey AS paper_id, 'tei/' || o_orderkey AS xml_path FROM orders WHERE o_orderstatus <> 'P')
    SELECT paper_id, pdf_path, n_tex, xml_path FROM c JOIN x USING (paper_id) WHERE pdf_path IS NOT NULL AND n_tex > 0""",
)
def complete_papers(spark, d):
    parsed = table(spark, d, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("paper_id"), F.concat(F.lit("tei/"), F.col("o_orderkey").cast("string")).alias("path")
    )
    return PA.with_parsed_xml(PA.complete_papers(_files(spark, d)), parsed)


@query(
    "collect_files",
    f"""WITH f AS ({_SQL_FILES})
    SELECT paper_id, row_number() OVER (PARTITION BY paper_id ORDER BY path) - 1 AS position, path FROM f WHERE kind = 'tex'""",
)
def collect_files(spark, d):
    return PA.collect_files(_files(spark, d))


@query(
    "single_file",
    "SELECT l_orderkey AS paper_id, count(*) AS n_files FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def single_file(spark, d):
    return PA.drop_single_file_papers(_files(spark, d))


@query(
    "main_file",
    r"""WITH f AS (SELECT source AS paper_id, doc_id::VARCHAR || '.tex' AS path, text,
          CASE WHEN quality = 1 THEN '\begin{document}' ELSE '' END || CASE WHEN doc_id % 7 = 0 THEN '\end{document}' ELSE '' END AS marks
          FROM documents LEFT JOIN labels USING (doc_id)),
        c AS (SELECT paper_id, count(*) FILTER (contains(marks, '\begin') AND contains(marks, '\end')) AS n_main,
                     min(path) FILTER (contains(marks, '\begin') AND contains(marks, '\end')) AS path FROM f GROUP BY paper_id)
    SELECT paper_id, n_main, CASE WHEN n_main = 0 THEN 'none' WHEN n_main > 1 THEN 'ambiguous' ELSE 'ok' END AS status,
           CASE WHEN n_main = 1 THEN path END AS main_path FROM c""",
)
def main_file(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    opening = F.when(F.col("quality") == 1, r"\begin{document}").otherwise("")
    closing = F.when(F.col("doc_id") % 7 == 0, r"\end{document}").otherwise("")
    return PA.main_tex_file(
        docs.select(
            F.col("source").alias("paper_id"),
            F.concat(F.col("doc_id").cast("string"), F.lit(".tex")).alias("path"),
            F.concat(opening, F.col("text"), closing).alias("text"),
        )
    )


@query("pending_items", "SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)")
def pending_items(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "lang")
    return PA.pending_items(documents, table(spark, d, "labels"), ["doc_id"])


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(spark, d):
    return PA.row_count(table(spark, d, "lineitem"))


@query(
    "sample_pairs",
    "SELECT doc_id, lang, text FROM documents ORDER BY md5(doc_id::VARCHAR || '#7'), doc_id LIMIT 200",
)
def sample_pairs(spark, d):
    return PA.random_sample(table(spark, d, "documents").select("doc_id", "lang", "text"), 200, F.col("doc_id"), 7)


_UNENTITY = "replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&apos;', ''''), '&amp;', '&')"


@query(
    "page_meta",
    rf"""WITH t AS (SELECT page_id, regexp_extract(html, '(?s)<h1(?:\s[^>]*)?>(.*?)</h1>', 1) AS h1,
                           regexp_extract(html, '(?s)<title(?:\s[^>]*)?>(.*?)</title>', 1) AS head FROM pages),
        c AS (SELECT page_id, substr({_UNENTITY.format("regexp_replace(h1, '<[^>]*>', '', 'g')")}, 7) AS title,
                     {_UNENTITY.format("regexp_replace(head, '<[^>]*>', '', 'g')")} AS head FROM t)
    SELECT page_id, title, {sql_trim(r"regexp_replace(head, '\([^\n]*\)', '', 'g')")} AS category, replace(title, ' ', '-') AS slug FROM c
    WHERE title <> ''""",
)
def page_meta(spark, d):
    pages = spread(table(spark, d, "pages").select("page_id", "html"))
    meta = read_meta(pages, ("page_id",), title=("h1", None), category=("title", None))
    return meta.withColumn("slug", C.title_slug(F.col("title"))).where(F.col("title") != "")


@query(
    "id_list",
    rf"""WITH l AS (SELECT page_id, ' ' || url || CASE WHEN page_id % 3 = 0 THEN '.pdf ' ELSE '.ps' END AS line FROM pages),
        k AS (SELECT page_id, {sql_trim('line')} AS line FROM l),
        i AS (SELECT page_id, substr(line, 1, length(line) - 4) AS id FROM k WHERE ends_with(line, '.pdf')),
        n AS (SELECT page_id, id, string_split(id, '/')[-1] AS paper_id FROM i)
    SELECT page_id, id, paper_id, 'https://arxiv.org/abs/' || paper_id AS abs_url, 'https://arxiv.org/pdf/' || paper_id || '.pdf' AS pdf_url,
           'https://arxiv.org/e-print/' || paper_id AS source_url, regexp_matches(page_id || '.' || page_id || '.pdf', '^\d+\.\d+\.pdf') AS is_pdf
    FROM n""",
)
def id_list(spark, d):
    line = F.concat(F.lit(" "), "url", F.when(F.col("page_id") % 3 == 0, ".pdf ").otherwise(".ps"))
    page = F.col("page_id").cast("string")
    ids = table(spark, d, "pages").select("page_id", C.id_from_line(line).alias("id")).where(F.col("id").isNotNull())
    named = ids.withColumn("paper_id", C.paper_id_from_url(F.col("id")))
    return named.select(
        "page_id", "id", "paper_id", C.paper_urls(F.col("paper_id")).alias("u"),
        C.is_paper_pdf(F.concat(page, F.lit("."), page, F.lit(".pdf"))).alias("is_pdf"),
    ).select("page_id", "id", "paper_id", "u.*", "is_pdf")


@query(
    "base64_content",
    "SELECT doc_id, base64(encode(text)) AS base64, length(text)::INTEGER AS n FROM documents",
)
def base64_content(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("content"), F.length("text").alias("n")
    )
    coded = to_base64(docs).drop("content")
    return coded.withColumn("base64", F.translate("base64", "\r\n", ""))


# UTF-8 bytes read as Latin-1: each byte becomes the character of its number.
@query(
    "decode_files",
    """WITH c AS (SELECT item_id, text, unnest(string_split(text, '')) AS ch FROM benchmark)
    SELECT item_id AS paper_id, any_value(text) AS text, count(*)::INTEGER AS n_utf8,
           sum(strlen(ch))::INTEGER AS n_latin1, TRUE AS utf8_ok FROM c GROUP BY item_id""",
)
def decode_files(spark, d):
    files = table(spark, d, "benchmark").select(
        F.col("item_id").alias("paper_id"), F.lit("f.tex").alias("path"), F.encode("text", "UTF-8").alias("content")
    )
    wide = decode_tex(files, "latin1").select("paper_id", F.length("text").alias("n_latin1"))
    return decode_tex(files, "utf8").select("paper_id", "text", F.length("text").alias("n_utf8"), "utf8_ok").join(wide, "paper_id")


# --- includes -------------------------------------------------------------------------------------

# An order is a paper. Its main file includes one file per line number; each of those includes a part
# description and names a supplier as bibliography, found under a suffix. Late lines point nowhere.
_SQL_LINES = """SELECT l_orderkey AS o, l_linenumber AS n, min(l_partkey) AS p, min(l_suppkey) AS s FROM lineitem GROUP BY ALL"""


@query(
    "include_expansion",
    rf"""WITH l AS ({_SQL_LINES}),
        t AS (SELECT o, n, 'line ' || n || ': [' || p || ']' || CASE WHEN n % 2 = 0 THEN 'S' || s ELSE '' END
                || CASE WHEN n = 7 THEN '\input{{gone}}' ELSE '' END AS text FROM l)
    SELECT 'o' || o AS paper_id, 'd/main.tex' AS path,
           'Order' || string_agg(' ' || text || ';', '' ORDER BY n) AS text, count(*) FILTER (n = 7) AS missing,
           0::BIGINT AS cyclic
    FROM t GROUP BY o""",
)
def include_expansion(spark, d):
    text = lambda c: F.col(c).cast("string")
    lines = table(spark, d, "lineitem").groupBy(
        F.concat(F.lit("o"), text("l_orderkey")).alias("paper_id"), F.col("l_linenumber").alias("n")
    ).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    numbers = F.sort_array(F.collect_list("n"))
    command = lambda n: F.concat(F.lit(r" \input{line"), n.cast("string"), F.lit("};"))
    main = lines.groupBy("paper_id").agg(F.array_join(F.transform(numbers, command), "").alias("body")).select(
        "paper_id", F.lit("d/main.tex").alias("path"), F.concat(F.lit("Order"), "body", F.lit("% note")).alias("text")
    )
    line = lines.select(
        "paper_id",
        F.concat(F.lit("d/line"), text("n"), F.lit(".tex")).alias("path"),
        F.concat(
            F.lit("line "), text("n"), F.lit(r": [\input{part"), text("n"), F.lit(".tex}]"),
            F.when(F.col("n") % 2 == 0, F.concat(F.lit(r"\bibliography{sup"), text("n"), F.lit("}"))).otherwise(""),
            F.when(F.col("n") == 7, r"\input{gone}").otherwise(""),
        ).alias("text"),
    )
    part = lines.select("paper_id", F.concat(F.lit("d/part"), text("n"), F.lit(".tex")).alias("path"), text("p").alias("text"))
    supplier = lines.select(
        "paper_id", F.concat(F.lit("d/sup"), text("n"), F.lit(".bbl")).alias("path"),
        F.concat(F.lit("S"), text("s")).alias("text"),
    )
    files = main.unionByName(line).unionByName(part).unionByName(supplier)
    return expand_includes(files, main.select("paper_id", "path"))


# --- parsers inside tasks -------------------------------------------------------------------------


@query(
    "tei_elements",
    r"""WITH t AS (SELECT doc_id, lang, source, text FROM documents),
        e AS (SELECT doc_id, 'title' AS section, 0 AS pos, 'title' AS el_type, lang AS txt, NULL AS tail, NULL AS target FROM t
          UNION ALL SELECT doc_id, 'abstract', 0, 'p', chr(10), NULL, NULL FROM t
          UNION ALL SELECT doc_id, 'abstract', 1, 's', source, NULL, NULL FROM t
          UNION ALL SELECT doc_id, 'body', 0, 'head', '<b>' || lang || '</b>' || chr(10), NULL, NULL FROM t
          UNION ALL SELECT doc_id, 'body', 1, 'p', chr(10), NULL, NULL FROM t
          UNION ALL SELECT doc_id, 'body', 2, 's', text, NULL, NULL FROM t
          UNION ALL SELECT doc_id, 'body', 3, 'ref', '[' || source || ']', ' after', '#b0' FROM t
          UNION ALL SELECT doc_id, 'body', 4, 'formula', source || '=' || lang, NULL, NULL FROM t
          UNION ALL SELECT doc_id, 'back', 0, 'bibr', '[1] ' || source, NULL, NULL FROM t)
    SELECT doc_id, section, pos::INTEGER AS pos, el_type, txt, tail, target FROM e""",
)
def tei_elements(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "lang", "source", "text"))
    plain = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    xml = F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>'), "lang",
        F.lit("</title></titleStmt></fileDesc><profileDesc><abstract><p><s>"), "source",
        F.lit("</s></p></abstract></profileDesc></teiHeader><text><body><div><head>"), "lang",
        F.lit("</head><p><s>"), plain, F.lit('<ref target="#b0">'), "source", F.lit("</ref> after</s></p><formula>"),
        "source", F.lit("="), "lang",
        F.lit('<label>(1)</label></formula></div></body><back><listBibl><biblStruct><note type="raw_reference">'),
        "source", F.lit("</note></biblStruct></listBibl></back></text></TEI>"),
    )
    elements = read_tei(docs.select("doc_id", F.encode(xml, "UTF-8").alias("content")), ("doc_id",))
    return elements.select("doc_id", "section", "pos", "el_type", "txt", "tail", "target")


def _pack(part):
    """Three kinds of archive: compressed tar with two members, one compressed file, damaged bytes."""
    contents = []
    for doc_id, text in zip(part["doc_id"], part["text"]):
        data = text.encode()
        if doc_id % 3 == 0:
            buffer = io.BytesIO()
            with tarfile.open(fileobj=buffer, mode="w:gz") as archive:
                for name, member_data in (("main.tex", data), ("sub/a.bib", b"@b{%d}" % doc_id)):
                    member = tarfile.TarInfo(name)
                    member.size = len(member_data)
                    archive.addfile(member, io.BytesIO(member_data))
            contents.append(buffer.getvalue())
        elif doc_id % 3 == 1:
            contents.append(gzip.compress(data, mtime=0))
        else:
            contents.append(b"\x00broken" + data)
    yield pd.DataFrame({"paper_id": part["doc_id"].astype(str), "content": contents})


@query(
    "unpack",
    """SELECT doc_id::VARCHAR AS paper_id, 'main.tex' AS member_path, text, 'tar' AS status FROM documents WHERE doc_id % 3 = 0
    UNION ALL SELECT doc_id::VARCHAR, 'sub/a.bib', '@b{' || doc_id || '}', 'tar' FROM documents WHERE doc_id % 3 = 0
    UNION ALL SELECT doc_id::VARCHAR, doc_id::VARCHAR, text, 'gzip' FROM documents WHERE doc_id % 3 = 1
    UNION ALL SELECT doc_id::VARCHAR, NULL, NULL, 'failed' FROM documents WHERE doc_id % 3 = 2""",
)
def unpack(spark, d):
    docs = spread(table(spark, d, "documents").select("doc_id", "text"))
    small_batches(spark)
    archives = docs.mapInPandas(in_parts(_pack, "text"), "paper_id string, content binary")
    return unpack_archives(archives).select(
        "paper_id", "member_path", F.decode("content", "UTF-8").alias("text"), "status"
    )


def _fresh(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _tar(paper: pd.DataFrame) -> pd.DataFrame:
    """One compressed archive of a paper's files."""
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as archive:
        for doc_id, content in sorted(zip(paper["doc_id"], paper["content"])):
            member = tarfile.TarInfo(f"src/d{doc_id}.tex")
            member.size = len(content)
            archive.addfile(member, io.BytesIO(content))
    return pd.DataFrame({"paper_id": [str(paper["paper"].iloc[0])], "content": [buffer.getvalue()]})


# Papers of up to 32 documents, written as archives and read by the data source in parts of 2,000 bytes.
@query(
    "archive_source",
    """SELECT (doc_id // 32)::VARCHAR AS paper_id, 'src/d' || doc_id || '.tex' AS member_path, text, 'tar' AS status,
      strlen(text)::BIGINT AS size, greatest(1, ceil(strlen(text) / 2000.0))::INTEGER AS n_parts,
      (row_number() OVER (PARTITION BY doc_id // 32 ORDER BY doc_id) - 1)::INTEGER AS member
    FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)""",
)
def archive_source(spark, d):
    content = F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content")
    docs = table(spark, d, "documents").select(F.expr("doc_id div 32").alias("paper"), "doc_id", content)
    folder = _fresh(spark, "archives")
    AS.register(spark)
    tars = docs.groupBy("paper").applyInPandas(_tar, "paper_id string, content binary")
    tars.write.format("paper_archives").mode("append").save(folder)
    members = AS.whole_members(AS.read_archives(spark, folder, partBytes="2000", partitionBytes=str(1 << 20)))
    return members.withColumn("text", F.decode("content", "UTF-8")).drop("content", "archive")
