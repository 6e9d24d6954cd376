"""Ordered, interval and element operators against literal definitions."""

import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators import elements as E, intervals as I, ordered as O, papers as PA
from pairloom.operators.includes import expand_includes

WIDTH = 100


@pytest.fixture(scope="module")
def spans():
    rng = random.Random(7)
    return [(k, i, a, a + rng.randrange(1, 40)) for k in "abc" for i in range(60) for a in [rng.randrange(1000)]]


@pytest.fixture(scope="module")
def stops():
    rng = random.Random(8)
    return sorted({(k, a, a + 1) for k in "abc" for _ in range(60) for a in [rng.randrange(1000)]})


@pytest.fixture(scope="module")
def span_rows(spark, spans):
    return spark.createDataFrame(spans, "k string, id int, start int, end int")


@pytest.fixture(scope="module")
def stop_rows(spark, stops):
    return spark.createDataFrame(stops, "k string, start int, end int")


@pytest.mark.parametrize("strict", [False, True])
def test_containers(spark, spans, span_rows, strict):
    rng = random.Random(9)
    cuts = {k: sorted(rng.sample(range(1000), 30)) for k in "abc"}
    boxes = [(k, a, b - rng.randrange(2)) for k in "abc" for a, b in zip(cuts[k], cuts[k][1:]) if b - a > 2]
    df = spark.createDataFrame(boxes, "k string, start int, end int")
    got = {(r.k, r.id): (r.container_start, r.container_end) for r in I.assign_to_container(span_rows, df, ["k"], WIDTH, strict).collect()}
    for k, i, a, b in spans:
        fits = [(x, y) for c, x, y in boxes if c == k and ((x < a and b < y) if strict else (x <= a and b <= y))]
        assert got[(k, i)] == (min(fits) if fits else (None, None))


def test_boundaries_inside(spans, stops, span_rows, stop_rows):
    got = {(r.k, r.start) for r in I.drop_boundaries_inside(stop_rows, span_rows, ["k"], WIDTH).collect()}
    assert got == {(k, s) for k, s, e in stops if not any(c == k and a <= e <= b for c, _, a, b in spans)}


def test_nearest_boundaries(spans, stops, span_rows, stop_rows):
    found = I.nearest_boundaries(span_rows, stop_rows, ["k"], WIDTH, F.lit(5000))
    got = {(r.k, r.id): (r.sentence_start, r.sentence_end) for r in found.collect()}
    for k, i, a, b in spans:
        start = max([e for c, _, e in stops if c == k and e <= a], default=0)
        end = min([s + 1 for c, s, _ in stops if c == k and s >= b], default=5000)
        assert got[(k, i)] == (start, end)


@pytest.mark.parametrize("chunk", [1, 16, 10_000])
def test_merge_short(spark, chunk):
    rng = random.Random(1)
    rows = [(k, i, rng.choice([1, 2, 3] if k == "z" else [1, 2, 3, 5, 9, 30])) for k in "xyz" for i in range(200)]
    df = spark.createDataFrame(rows, "k string, pos int, len int").withColumn("c", F.floor(F.col("pos") / chunk))
    got = {(r.k, r.pos): r.group_end for r in O.merge_short(df, ["k"], "c", "pos", "len", 12).collect()}
    for k in "xyz":
        pieces = [(i, n) for c, i, n in rows if c == k]
        total, group = 0, []
        for i, n in pieces:
            total += n
            group.append(i)
            if total > 12 or i == pieces[-1][0]:
                assert {got[(k, j)] for j in group} == {i}
                total, group = 0, []


@pytest.mark.parametrize("how", ["sum", "max", "min"])
@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("include_current", [False, True])
def test_running(spark, how, forward, include_current):
    rng = random.Random(2)
    rows = [(k, i, rng.choice([None, 1, 5, 9])) for k in "ab" for i in range(40)]
    df = spark.createDataFrame(rows, "k string, i int, v int").withColumn("c", F.floor(F.col("i") / 7))
    got = O.running(df, ["k"], "c", ["i"], F.col("v").cast("long"), "out", how, forward, include_current)
    for r in got.collect():
        seen = [
            v for k, i, v in rows
            if k == r.k and v is not None and (i == r.i and include_current or (i > r.i if forward else i < r.i))
        ]
        assert r.out == ((sum(seen) if how == "sum" else max(seen, default=None) if how == "max" else min(seen, default=None)))


def test_between_sentinels(spark):
    rng = random.Random(4)
    rows = [(k, i, rng.choice(["cs", "a.pdf", "b.pdf", "math"])) for k in "abcdefgh" for i in range(12)]
    rows += [("s", i, v) for i, v in enumerate(["a", "cs", "1.pdf", "2.pdf", "math", "3.pdf"])]
    df = spark.createDataFrame(rows, "k string, i int, v string")
    got = {(r.k, r.i) for r in O.between_sentinels(df, ["k"], "i", F.col("v") == "cs", F.col("v").endswith(".pdf")).collect()}
    want = set()
    for key in "abcdefghs":
        started = False
        for k, i, v in rows:
            if k == key and v == "cs":
                started = True
            elif k == key and started:
                if not v.endswith(".pdf"):
                    break
                want.add((k, i))
    assert got == want and {i for k, i in got if k == "s"} == {2, 3}


@pytest.fixture(scope="module")
def elements():
    rng = random.Random(5)
    rows = []
    for doc in range(30):
        for pos in range(rng.randrange(1, 60)):
            kind = rng.choice(["s", "formula", "ref", "p"])
            txt = rng.choice(["", "a", "word ", "long text " * 9, None])
            rows.append((doc, pos, kind, (txt or "F") if kind == "formula" else txt, rng.choice([None, "", " t", "tail " * 3])))
    return rows


@pytest.mark.parametrize("chunk_size", [4, 1024])
def test_element_context(spark, elements, chunk_size):
    df = spark.createDataFrame(elements, "doc int, pos int, el_type string, txt string, tail string")
    got = {(r.doc, r.pos): (r.pre_txt, r.equation_txt, r.post_txt) for r in E.element_context(df, ["doc"], 70, chunk_size).collect()}
    want = {}
    for doc, pos, kind, txt, _ in elements:
        if kind == "formula":
            parts = [(p, (t or "") + (tail or "") if t is not None else "") for d, p, _, t, tail in elements if d == doc]
            before = "".join(c for p, c in parts if 0 < p < pos)
            want[(doc, pos)] = (before[-70:], txt, "".join(c for p, c in parts if p > max(pos, 0))[:70])
    assert got == want


def test_document_text(spark, elements):
    df = spark.createDataFrame(elements, "doc int, pos int, el_type string, txt string, tail string")
    piece = E.flat_piece(F.col("txt"), F.col("tail"))
    got = {r.doc: r.text for r in E.document_text(df, ["doc"], "pos", piece, 7).collect()}
    want = {}
    for doc, _, _, txt, tail in elements:
        want[doc] = want.get(doc, "") + (txt or "") + " " + (tail + " " if tail is not None else "")
    assert got == want


def test_collect_files_in_order(spark):
    rows = [("big", f"{i:03}.tex", "tex") for i in range(95)] + [("small", "a.tex", "tex"), ("small", "a.bib", "bib")]
    found = PA.collect_files(spark.createDataFrame(rows, "paper_id string, path string, kind string")).collect()
    got = sorted((r.paper_id, r.position, r.path) for r in found)
    assert got == [("big", i, f"{i:03}.tex") for i in range(95)] + [("small", 0, "a.tex")]


def test_includes(spark):
    files = [
        ("p", "m.tex", "A \\input{b} % \\input{zz}\n\\input{c.tex}\\bibliography{refs}\\input{gone}"),
        ("p", "b.tex", r"[B \input{c}]"), ("p", "c.tex", "C$1"), ("p", "refs.bbl", "BBL"),
        ("q", "d/m.tex", r"x\input{./y}\input{m.tex}"), ("q", "d/y.tex", r"Y\input{m}"),
        ("r", "e.tex", ""), ("s", "l.tex", r"\input{l2}"), ("s", "l2.tex", r"\input{l3}"), ("s", "l3.tex", "end"),
    ]
    df = spark.createDataFrame(files, "paper_id string, path string, text string")
    roots = df.where("path IN ('m.tex', 'd/m.tex', 'e.tex', 'l.tex')").select("paper_id", "path")
    got = {r.paper_id: (r.text, r.missing, r.cyclic) for r in expand_includes(df, roots).collect()}
    assert got == {
        "p": ("A [B C$1] \nC$1BBL\\input{gone}", 1, 0), "q": ("xY\\input{m}\\input{m.tex}", 0, 2),
        "r": ("", 0, 0), "s": ("end", 0, 0),
    }


def test_includes_of_small_papers_take_one_shuffle(spark):
    files = [
        ("p", "m.tex", r"A \input{ ././b } \input{b.tex}\input{gone}\bibliography{refs}"), ("p", "b.tex", r"[\input{c}\input{m}]"),
        ("p", "c.tex", "C"), ("p", "c", "first"), ("p", "refs.bbl", "BBL"), ("p", "refs.bib", "B%IB"),
        ("twice", "d/m.tex", r"x\input{y}"), ("twice", "d/m.tex", r"x\input{y}"), ("twice", "d/y.tex", "y"), ("twice", "d/y.tex", "y"),
        ("void", "m.tex", r"\input{e}"), ("void", "e.tex", None), (None, "m.tex", "no paper"), ("p", None, "no name"),
        ("void", "e2.tex", ""), ("other", "x.tex", "no root"),
    ]
    df = spark.createDataFrame(files, "paper_id string, path string, text string")
    named = [(p, path) for p, path, _ in files if path in ("m.tex", "d/m.tex", "e2.tex")]
    roots = spark.createDataFrame([*named, ("void", "m.tex"), ("p", "not there"), ("nor", "m.tex")], "paper_id string, path string")
    whole = expand_includes(df, roots)
    assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1  # of the paper
    got = sorted(whole.collect())
    assert got == sorted([
        ("p", "m.tex", "A [first\\input{m}] [first\\input{m}]\\input{gone}B%IB", 1, 2), ("twice", "d/m.tex", "xxyyyy", 0, 0),
        ("void", "m.tex", "", 0, 0), ("void", "m.tex", "", 0, 0), ("void", "e2.tex", "", 0, 0),
    ])
    # by levels, all papers and those with more than four files
    assert sorted(expand_includes(df, roots, paper_files=0).collect()) == got
    assert sorted(expand_includes(df, roots, paper_files=4).collect()) == got


def test_includes_of_any_depth_and_bibliography(spark):
    chain = [("p", f"{i}.tex", f"{i} \\input{{{i + 1}}}") for i in range(22)] + [("p", "22.tex", "end")]
    bib = [("b", "m.tex", "\\bibliography{r} % note"), ("b", "r.bib", "url={http://h/a%20b}, title={T}}")]
    df = spark.createDataFrame(chain + bib, "paper_id string, path string, text string")
    roots = df.where("path IN ('0.tex', 'm.tex')").select("paper_id", "path")
    got = {r.paper_id: r.text for r in expand_includes(df, roots).collect()}
    assert got == {"p": " ".join(map(str, range(22))) + " end", "b": "url={http://h/a%20b}, title={T}} "}
