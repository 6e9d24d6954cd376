"""Readers, parsers, writers, pipelines and the stream, on small folders."""

import gzip
import io
import json
import tarfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairloom.plans.formula_pairs import formula_pairs
from pairloom.plans.preparation import cleaned_main_files, landed_files, landed_folder
from pairloom.plans.sentence_pairs import partial_sentence_pairs, sentence_pairs, surrounding_pairs
from pairloom.sources import files as SF, sinks
from pairloom.sources import archivesource as AS
from pairloom.sources.archives import members_of
from pairloom.sources.pages import element_text, page_meta
from pairloom.sources.tei import tei_elements
from pairloom.streaming.incremental import stream_formula_pairs

FILLER = "This is a sentence about pruning deep networks that says nothing. "
TEX = FILLER + "The cost of layer l is \\begin{equation}C_l = a + b\\end{equation} for all layers of it. " + FILLER


def parsed(paper):
    body = [
        {"el_type": "head", "txt": "H"}, {"el_type": "s", "txt": FILLER.strip()},
        {"el_type": "s", "txt": "The cost of layer l is "}, {"el_type": "formula", "txt": "C l = a + b", "xml_id": "f0"},
        {"el_type": "s", "txt": "for all layers of it."}, {"el_type": "s", "txt": FILLER.strip()},
    ]
    return {"paper_id": paper, "title": [{"el_type": "title", "txt": "T"}], "abstract": [], "body": body, "back": []}


@pytest.fixture
def corpus(tmp_path):
    (tmp_path / "tex" / "1.1").mkdir(parents=True)
    (tmp_path / "tex" / "1.1" / "m.tex").write_text(TEX)
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "1.1.json").write_text(json.dumps({k: v for k, v in parsed("1.1").items() if k != "paper_id"}))
    return tmp_path


def test_pairs_from_files(spark, corpus):
    tex = SF.read_tex_files(spark, str(corpus / "tex"))
    documents = SF.read_parsed_json(spark, str(corpus / "json"))
    pairs = formula_pairs(tex, documents)
    row = pairs.first()
    assert (row.dirty_data.equation_txt, row.clean_data.equation_txt[:16]) == ("C l = a + b", "\\begin{equation}")
    assert formula_pairs(tex, documents, normalize=True, estimate=True).count() == 1
    out = str(corpus / "pairs")
    sinks.write_new_pairs(pairs, out)
    sinks.write_new_pairs(pairs, out)
    assert SF.read_pairs(spark, out).collect() == [row.__class__(**row.asDict()) for row in pairs.collect()]
    inline = tex.withColumn("text", F.regexp_replace("text", r"\\(begin|end)\{equation\}", r"\$"))
    assert [r.score >= 80 for r in sentence_pairs(inline, documents).collect()] == [True]
    partial_sentence_pairs(tex, documents).collect()
    surrounding_pairs(tex, documents).collect()


def test_stream_saves_each_paper_once(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    for n in range(3):
        paper = {**parsed(f"1.{n}"), "tex": [{"path": "m.tex", "text": TEX}]}
        (landed / f"1.{n}.json").write_text(json.dumps(paper))
    for _ in range(2):
        stream = stream_formula_pairs(spark, str(landed), str(tmp_path / "out"), str(tmp_path / "ck"), 2)
        assert stream.awaitTermination(120) and stream.exception() is None
    assert sorted(r.paper_id for r in SF.read_pairs(spark, str(tmp_path / "out")).collect()) == ["1.0", "1.1", "1.2"]
    assert len(list((tmp_path / "out").glob("batch=*"))) == 2


def test_listing_and_ids(spark, tmp_path):
    for path in ("AI/1.1/1.1.pdf", "AI/1.1/a.tex", "AI/1.1_arXiv/a.tex", "AI/1.1/sub dir/b.bib", "CL/2.2/x.bbl"):
        (tmp_path / "c" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "c" / path).write_text("x")
    rows = SF.scan_paper_files(spark, str(tmp_path / "c")).collect()
    assert {(r.category, r.paper_id, r.kind, r.cleaned) for r in rows} == {
        ("AI", "1.1", "pdf", False), ("AI", "1.1", "tex", False), ("AI", "1.1", "tex", True),
        ("AI", "1.1", "bib", False), ("CL", "2.2", "bbl", False),
    }
    assert SF.scan_paper_files(spark, str(tmp_path / "c"), recursive=False).count() == 4
    (tmp_path / "ids.txt").write_text(" 1.1.pdf \n2.2.ps\n3.pdf.pdf\n")
    assert [r.paper_id for r in SF.read_id_list(spark, str(tmp_path / "ids.txt")).collect()] == ["1.1", "3.pdf"]


def test_page_meta(spark):
    html = (
        '<h1 class="title mathjax"><span class="descriptor">Title:</span>A &lt;b&gt; &#233;&#x4e2d;</h1>'
        '<span class="primary-subject">Artificial Intelligence (cs.AI)</span>'
    )
    df = spark.createDataFrame([("1", html), ("2", "<h1>Title:no class</h1>")], "paper_id string, html string")
    got = {r.paper_id: (r.title, r.category) for r in page_meta(df).collect()}
    assert got == {"1": ("A <b> é中", "Artificial Intelligence"), "2": ("", "")}


def test_tei(spark):
    xml = (
        '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>T</title></titleStmt></fileDesc></teiHeader>'
        '<text><body><div><head coords="1">Intro</head><p><s>See <ref type="bibr" target="#b1">(A;</ref>, and <ref type="figure">1</ref>.</s></p>'
        '<formula xml:id="f0">x=1<label>(2)</label></formula><figure type="table"><head>H</head></figure></div></body></text></TEI>'
    )
    df = spark.createDataFrame([("p", bytearray(xml.encode())), ("bad", bytearray(b"<x"))], "paper_id string, content binary")
    got = [(r.section, r.pos, r.el_type, r.txt, r.tail, r.target) for r in tei_elements(df).collect()]
    assert got == [
        ("title", 0, "title", "T", None, None), ("body", 0, "head", "<b>Intro</b>\n", None, None),
        ("body", 1, "p", "\n", None, None), ("body", 2, "s", "See ", None, None),
        ("body", 3, "ref", "[(A]", ", and ", "#b1"), ("body", 4, "ref", "1", ".", None),
        ("body", 5, "formula", "x=1", None, None), ("body", 6, "figure", "", None, None),
        ("failed", 0, "failed", None, None, None),
    ]


def test_tei_keeps_all_text(spark):
    body = (
        "<div><head>See <ref target='#x'>1</ref></head><p>Loose <hi>one</hi> here.<s>See <hi>very</hi> clear text.</s> between <s>Two.</s></p>"
        "<list><item>First</item><item><s>Second</s></item></list><p><s>Before <formula>x<label>(1)</label></formula> after "
        "<ref>(B)</ref> <hi>then</hi> end.</s></p><note>A note.</note><figure><head>F</head></figure> tail</div>"
    )
    xml = f'<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body>{body}</body></text></TEI>'
    df = spark.createDataFrame([("p", bytearray(xml.encode()))], "paper_id string, content binary")
    got = [(r.el_type, r.txt, r.tail) for r in tei_elements(df).collect()]
    assert got == [
        ("head", "<b>See 1</b>\n", None), ("p", "\n", None), ("s", "Loose one here.", None), ("s", "See very clear text.", None),
        ("s", " between ", None), ("s", "Two.", None), ("s", "First", None), ("s", "Second", None), ("p", "\n", None),
        ("s", "Before ", None), ("formula", "x", None), ("s", " after ", None), ("ref", "(B)", " then end."),
        ("s", "A note.", None), ("figure", "", None), ("s", " tail", None),
    ]


def test_damaged_and_unsafe_archives():
    whole = bytes(archive({"a.tex": "x" * 3000, "b.tex": "y" * 3000}))
    raw = gzip.decompress(whole)
    assert [m[::2] for m in members_of("p", whole)] == [("a.tex", "tar"), ("b.tex", "tar")]
    for cut in (raw[:3500], gzip.compress(raw[:3500]), raw[:4000], gzip.compress(raw[:7168])):
        found = [m[::2] for m in members_of("p", cut)]
        assert found[-1] == (None, "failed") and ("p", "gzip") not in found
    assert [m[::2] for m in members_of("p", raw[:4608])][0] == ("a.tex", "tar")
    assert [m[::2] for m in members_of("p", bytes(archive({"../m": "x", "b": "y"})))] == [("../m", "unsafe"), ("b", "tar")]


def test_page_references(spark):
    cases = [
        ("A &eacute;&nbsp;B&#X41;&#0000000065;", "A é\u00a0BAA"), ("&#xFFFFFF;&#9999999;&#xD800;&#0;", "\ufffd" * 4),
        ("&amp;lt; &nosuch; &", "&lt; &nosuch; &"),
    ]
    rows = [(f"<H1>{html}</H1>", text) for html, text in cases] + [("<h1>A <h1>B</h1> C</h1>", "A B C")]
    df = spark.createDataFrame(rows, "html string, text string")
    got = df.select(element_text(F.col("html"), "h1").alias("got"), "text").collect()
    assert [r.got for r in got] == [r.text for r in got]


def test_ids_with_spaces_and_globs(spark, tmp_path):
    folder = tmp_path / "abc" / "c" / "p 1+2%20"
    folder.mkdir(parents=True)
    (folder / "x.tex").write_text("t")
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a b+c.json").write_text('{"title": []}')
    (tmp_path / "j" / "bad.json").write_text("{")
    for root in (f"{tmp_path}/abc/c", f"{tmp_path}/*/c", f"file:{tmp_path}/a{{bc,x}}/c/"):
        assert [r.paper_id for r in SF.read_tex_files(spark, root).collect()] == ["p 1+2%20"]
    got = {(r.paper_id, r.damaged) for r in SF.read_parsed_json(spark, f"{tmp_path}/j").collect()}
    assert got == {("a b+c", False), ("bad", True)}


def archive(members):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as out:
        for name, text in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(text)
            out.addfile(info, io.BytesIO(text.encode()))
    return bytearray(buffer.getvalue())


def test_archives_to_main_files(spark):
    main = "\\documentclass{a}\n\\begin{document}\\input{sec}\\end{document}"
    rows = [
        ("1", archive({"m.tex": main, "sec.tex": "Body."})), ("2", bytearray(gzip.compress(b"alone"))),
        ("3", bytearray(b"damaged")), ("4", archive({"m.tex": main, "x.tex": "x"})),
        ("5", archive({"../m.tex": main, "x.tex": "x"})),
    ]
    archives = spark.createDataFrame(rows, "paper_id string, content binary")
    landed = spark.createDataFrame([("1", "1.pdf"), ("4", "a.tex"), ("4", "b.tex")], "paper_id string, path string")
    files = landed_files(archives, landed)
    assert sorted((r.paper_id, r.path) for r in files.collect()) == [("1", "m.tex"), ("1", "sec.tex")]
    assert [r.text for r in cleaned_main_files(files).collect()] == ["\\begin{document}Body.\\end{document}"]


def test_writers(spark, tmp_path):
    tex = spark.createDataFrame([("p", "a", "é"), ("p", "b", "中")], "paper_id string, path string, text string")
    sinks.write_cleaned_tex(tex, str(tmp_path / "t"))
    got = {r.path: (bytes(r.content), r.encoding) for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == {"a": (b"\xe9", "ISO-8859-1"), "b": ("中".encode(), "UTF-8")}
    sinks.write_by_category(tex.withColumn("category", F.lit("AI")), str(tmp_path / "c"))
    assert (tmp_path / "c" / "category=AI").is_dir()
    assert SF.to_base64(spark.createDataFrame([(bytearray(b"ab"),)], "content binary")).first()["base64"] == "YWI="


def test_archive_source_streams_members(spark, tmp_path):
    whole = archive({"a.tex": "xy" * 15_000, "sub/b.tex": "y" * 3000, "e": ""})
    plain = gzip.decompress(whole)
    rows = [
        ("1.1", whole), ("2.2", bytearray(gzip.compress(b"alone" * 100))), ("3", bytearray(b"damaged")), ("4", whole[:-30]),
        ("5", archive({"../m": "x", "b": "y"})), ("6", bytearray(plain)), ("7", bytearray(plain[:20_000])),
    ]
    folder = str(tmp_path / "in")
    AS.register(spark)
    spark.createDataFrame(rows, "paper_id string, content binary").repartition(3).write.format("paper_archives").mode("append").save(folder)
    expected = {
        (paper, path, None if content is None else bytes(content), status)
        for paper, data in rows for path, content, status in members_of(paper, bytes(data))
    }
    for part in ("700", "1000000"):
        read = AS.read_archives(spark, folder, partBytes=part, partitionBytes="200")
        got = AS.whole_members(read).collect()
        assert {(r.paper_id, r.member_path, None if r.content is None else bytes(r.content), r.status) for r in got} == expected
        assert all(r.size == len(r.content) for r in got if r.content is not None)
    assert max(len(r.content or b"") for r in AS.read_archives(spark, folder, partBytes="1000").collect()) == 1000
    # fewer columns, and papers that are not asked for stay closed
    (tmp_path / "in" / "9.tar.gz").mkdir()
    few = spark.read.format("paper_archives").schema("size long, paper_id string").load(folder).where("paper_id IN ('1.1', '2.2')")
    assert sorted(map(tuple, few.collect())) == [(0, "1.1"), (500, "2.2"), (3000, "1.1"), (30000, "1.1")]
    assert "Filter" not in few._jdf.queryExecution().executedPlan().toString().replace("Filters", "")
    (tmp_path / "empty").mkdir()
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "8.tar.gz").write_bytes(b"")
    assert [r.status for r in AS.read_archives(spark, str(tmp_path / "none")).collect()] == ["failed"]
    assert AS.read_archives(spark, str(tmp_path / "empty")).count() == 0


def test_archive_source_keeps_repeated_names(spark, tmp_path):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:xz") as out:
        for data in (b"first one", b"second"):
            info = tarfile.TarInfo("same.tex")
            info.size = len(data)
            out.addfile(info, io.BytesIO(data))
    (tmp_path / "1.tar.xz").write_bytes(buffer.getvalue())
    (tmp_path / "_hidden.tar").write_bytes(b"")
    got = AS.whole_members(AS.read_archives(spark, str(tmp_path), partBytes="4")).collect()
    assert sorted((r.member, bytes(r.content), r.n_parts) for r in got) == [(0, b"first one", 3), (1, b"second", 2)]


def test_archive_folder_to_main_files(spark, tmp_path):
    main = "\\documentclass{a}\n\\begin{document}\\input{sec}\\end{document}"
    for paper, data in (("1", archive({"m.tex": main, "sec.tex": "Body."})), ("2", gzip.compress(b"alone")), ("4", archive({"m.tex": main, "x": "x"}))):
        (tmp_path / f"{paper}.tar.gz").write_bytes(data)
    landed = spark.createDataFrame([("1", "1.pdf"), ("4", "a.tex"), ("4", "b.tex")], "paper_id string, path string")
    files = landed_folder(spark, str(tmp_path), landed)
    assert [r.text for r in cleaned_main_files(files).collect()] == ["\\begin{document}Body.\\end{document}"]


def test_element_source(spark, corpus):
    folder = corpus / "json"
    tei = b'<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div><head>H</head><p><s>One.</s></p></div></body></text></TEI>'
    (folder / "2.2.tei.xml").write_bytes(tei)
    (folder / "3.json").write_text("[1]")
    (folder / "4.xml").write_text("<a>")
    AS.register(spark)
    rows = spark.read.format("paper_elements").option("partitionBytes", "1").load(str(folder))
    expected = spark.createDataFrame([("2.2", bytearray(tei))], "paper_id string, content binary")
    assert sorted(map(str, rows.where("paper_id = '2.2'").collect())) == sorted(map(str, tei_elements(expected).collect()))
    assert [(r.section, r.pos, r.el_type, r.txt) for r in rows.where("paper_id = '1.1'").orderBy("section", "pos").collect()] == sorted(
        (section, pos, e["el_type"], e["txt"]) for section in ("title", "body") for pos, e in enumerate(parsed("1.1")[section])
    )
    assert {r.paper_id for r in rows.where("section = 'failed'").collect()} == {"3", "4"}


def test_python_batches_are_bounded_by_bytes(spark):
    from pairloom.functions import workers

    frame = pd.DataFrame({"n": range(7), "t": ["x" * 60, None, "", "y" * 200, "z", "w" * 99, "v"]})
    parts = []
    list(workers.in_parts(lambda part: iter([parts.append(part)]), "t", 100)(iter([frame, frame[:0]])))
    assert [n for part in parts for n in part["n"]] == list(range(7))
    assert all(part["t"].map(lambda v: len(v or "")).iloc[:-1].sum() < 200 for part in parts)
    assert len(parts) > 2
    workers.small_batches(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") != "67108864b"
