"""Cleaning, formulas and sentences against literal definitions on generated LaTeX-like texts."""

import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from pairloom.functions import brackets as B, cleaning as C, patterns as P
from pairloom.operators.formulas import extract_formulas, formula_spans
from pairloom.operators.sentences import formula_sentences, merge_short_spans, plain_sentences, sentence_boundaries, sentence_spans
from pairloom.plans.sentence_pairs import formula_surroundings

TOKENS = [
    "$", "$$", "\\(", "\\)", "\\[", "\\]", "\\begin{equation}", "\\end{equation}", "\\begin{align}", "\\end{align}",
    ". ", ".", "e.g. ", "No. ", "a", "b ", "\\$", "é", "\U0001d465", "\n", "\\begin{multline}", "\\end{multline}",
    "word ", "some text here. ", " . ", "1.5 ", "see Fig.\u00a0",
]
SPAN = P.FORMULA_SPAN.replace("(?d)", "")
STOP = r"(?<!No)(?<!\.g)(?<!\.e)(?<!\{)\.(?=\s)"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = ["".join(rng.choice(TOKENS) for _ in range(rng.randrange(1, 60))) for _ in range(200)]
    return made + ["", ".", "x" * 3000 + "$a$" + "y" * 100 + ". z " + "\ufdd0.\ufdd1 \ufdd0 $q.\ufdd1$ r. s", "$a$" * 700]


@pytest.fixture(scope="module")
def files(spark, texts):
    rows = [(str(i), "f", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "paper_id string, path string, text string").repartition(4).cache()


def grouped(df, *fields):
    out = {}
    for row in df.collect():
        out.setdefault(int(row.paper_id), []).append(tuple(row[f] for f in fields))
    return {k: [v[1:] if len(v) > 2 else v[1] for v in sorted(vs)] for k, vs in out.items()}


@pytest.mark.parametrize("short_prefix", ["exclusive", "inclusive"])
def test_extract_formulas(files, texts, short_prefix):
    got = grouped(extract_formulas(files, short_prefix=short_prefix), "ordinal", "start", "end", "pre_txt", "equation_txt", "post_txt", "full_txt")
    for i, text in enumerate(texts):
        want = []
        for _, _, pattern in P.FORMULA_KINDS:
            for m in re.finditer(pattern, text):
                a, b = m.span()
                pre = text[a - 70 : a] if a >= 70 else text[:a] if short_prefix == "exclusive" else text[:b]
                want.append((a, b, pre, m[0], text[b : b + 70], pre + m[0] + text[b : b + 70]))
        assert got.get(i, []) == want


def stops(text):
    return [m.span() for m in regex.finditer(STOP, text)]


def test_spans_and_boundaries(files, texts):
    for row in sentence_boundaries(formula_spans(files)).collect():
        text = texts[int(row.paper_id)]
        assert [(s.start, s.end) for s in row.spans] == [m.span() for m in regex.finditer(SPAN, text)]
        assert [(s.start, s.end) for s in row.boundaries] == stops(text)


@pytest.mark.parametrize("keep_tail", [False, True])
def test_sentence_spans(files, texts, keep_tail):
    for row in sentence_spans(files, keep_tail=keep_tail).collect():
        text = texts[int(row.paper_id)]
        cuts = [0] + [e for _, e in stops(text)] + ([len(text)] if keep_tail else [])
        assert [(s.start, s.end, s.txt) for s in row.sentences] == [(a, b, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def test_formula_sentences(files, texts):
    got = grouped(formula_sentences(files.withColumn("text", C.flatten_newlines(F.col("text")))), "ordinal", "sentence")
    for i, text in enumerate(t.replace("\n", " ") for t in texts):
        formulas = [m.span() for m in regex.finditer(SPAN, text)]
        ends = [e for _, e in stops(text) if not any(a <= e <= b for a, b in formulas)]
        sentences = list(zip([0] + ends, ends))
        chosen = [s for s in sentences if any(s[0] <= a and b <= s[1] for a, b in formulas) and s[1] - s[0] <= 800]
        assert got.get(i, []) == [clean(text[a:b]) for a, b in chosen]


def clean(text):
    text = re.sub(r"\s+", " ", text.strip())
    text = regex.sub(P.MARKUP_COMMAND, "", text)
    return re.sub(r"\s+", " ", text.strip())


def test_plain_sentences(files, texts):
    got = grouped(plain_sentences(files), "ordinal", "sentence")
    for i, text in enumerate(texts):
        ends = [e for _, e in stops(text)]
        spans = [list(s) for s in zip([0] + ends, ends)]
        kept = []
        for n, span in enumerate(spans):
            if n < len(spans) - 1 and span[1] - span[0] <= 12:
                spans[n + 1][0] = span[0]
            else:
                kept.append(span)
        assert got.get(i, []) == [clean(text[a:b]) for a, b in kept if b - a <= 800]


def test_formula_surroundings(files, texts):
    got = grouped(formula_surroundings(files, ("paper_id",)), "ordinal", "sentence")
    pattern = P.FORMULA_SPAN_NO_MULTLINE.replace("(?d)", "")
    for i, text in enumerate(texts):
        want = []
        for m in regex.finditer(pattern, text):
            a, b = m.span()
            start = max([e for _, e in stops(text) if e <= a], default=0)
            end = min([s + 1 for s, _ in stops(text) if s >= b], default=len(text))
            if (start, end) not in want:
                want.append((start, end))
        assert got.get(i, []) == [text[a:b] for a, b in want]


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def test_comments(spark):
    assert one(spark, "50\\% of x % note\n%%\nb", C.strip_comments) == "50\\% of x \n\nb"
    assert one(spark, "a % c\n% d\nb", lambda c: C.strip_comments(c, keep_newline=False)) == "a b"


def test_preamble(spark):
    text = "\\documentclass{a}\nno stop\n\\title{T}\n\\maketitle\n\\def\\x{1}\nBody\\noindent. "
    assert one(spark, text, C.strip_preamble) == "\\title{T}\n\nBody."
    assert one(spark, "Body", lambda c: C.strip_preamble(c, restore_begin=True)) == "\\begin{document}\nBody"


def test_find_all_uses_the_group(spark):
    assert one(spark, r"\input{a} \input{b}", lambda c: C.find_all(c, r"\\input\{([^}]*)\}")) == ["a", "b"]
    assert one(spark, "a1 b2", lambda c: C.find_all(c, r"[a-z]\d")) == ["a1", "b2"]


def test_newlines_and_encodings(spark):
    raw = spark.createDataFrame([(bytearray(b"a\r\nb\rc\xe9"),), (bytearray("é".encode()),)], "c binary")
    assert [r[0] for r in raw.select(C.decode_latin1(F.col("c"))).collect()] == ["a\nb\ncé", "Ã©"]
    assert [r[0] for r in raw.select(C.decode_utf8(F.col("c"))).collect()] == [None, "é"]


@pytest.mark.parametrize(
    "text,author,title",
    [
        (r"\title{T}\n\author{A {b} c$\qquad$ d} x".replace("\\n", "\n"), r"\author{A {b} c d}", "T"),
        (r"\author{un{closed}", None, None),
        (r"\title[s]{long}", None, None),
        ("", None, None),
    ],
)
def test_author_and_title(spark, text, author, title):
    assert one(spark, text, B.author_block) == author
    assert one(spark, text, B.tex_title) == title


def test_brackets_of_each_kind(spark):
    for bracket, closer in ("()", "[]", "{}"):
        text = f"x f{bracket}a{bracket}b{closer}c{closer}d{closer}"
        got = one(spark, text, lambda c: B.extract_balanced(c, rf"f\{bracket}", bracket))
        assert got == f"f{bracket}a{bracket}b{closer}c{closer}"


@pytest.mark.parametrize(
    "pattern, found",
    [
        (r"\p{Lu}\p{L}*", ["Äpfel", "Zoë"]),
        (r"(?U)\b(\w)\w+\b", ["Ä", "u", "Z"]),
        (r"(?<first>\p{Lu})(\p{L}+)", ["Ä", "Z"]),
        (r"[\(\)]", []),
    ],
)
def test_find_all_takes_java_patterns(spark, pattern, found):
    frame = spark.createDataFrame([("Äpfel und Zoë",)], "t string")
    assert frame.select(C.find_all(F.col("t"), pattern)).first()[0] == found


def test_counts_and_states(spark):
    from pairloom.functions.arrays import count_up_to_sql, states_sql

    rng = random.Random(6)
    rows = [(sorted(rng.randrange(50) for _ in range(n)), x) for n in (0, 1, 2, 7, 8, 300) for x in (-1, 0, 24, 49, 60)]
    frame = spark.createDataFrame(rows, "v array<int>, x int")
    step = "CASE WHEN state + x > 60 THEN 0 ELSE state + x END"
    for row in frame.select("v", "x", F.expr(count_up_to_sql("v", "x")).alias("n"), F.expr(states_sql("v", "0", step)).alias("s")).collect():
        assert row.n == sum(v <= row.x for v in row.v)
        state, states = 0, []
        for v in row.v:
            state = 0 if state + v > 60 else state + v
            states.append(state)
        assert row.s == states


def test_short_sentences_are_merged_in_linear_time(spark):
    """Against the definition, on lengths around the limit, and on a text of 20,000 sentences."""
    rng = random.Random(7)
    lists = [[rng.choice([1, 2, 5, 11, 12, 13, 40]) for _ in range(n)] for n in (0, 1, 2, 3, 50, 600, 20_000)]
    rows = []
    for lengths in lists:
        at, spans = 0, []
        for n in lengths:
            spans.append((at, at + n, chr(97 + at % 26) * n))
            at += n
        rows.append((spans,))
    frame = spark.createDataFrame(rows, "s array<struct<start: int, `end`: int, txt: string>>")
    for (spans,), row in zip(rows, frame.select(merge_short_spans("s", 12).alias("m")).collect()):
        want, open_ = [], None
        for start, end, txt in spans:
            open_ = (open_[0] if open_ else start, end, (open_[2] if open_ else "") + txt)
            if open_[1] - open_[0] > 12:
                want.append(open_)
                open_ = None
        assert [tuple(m) for m in row.m] == want + ([open_] if open_ else [])
