"""Near-duplicates, page extraction and the pipeline: against brute force, on awkward rows and on nothing."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from pairloom.llm import common, hostsuffix, neardup, queries
from tests.llm import cases


def shingles(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, min(len(words), 1)))}


def brute_groups(rows, width):
    """Smallest id reachable for every row, by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = Counter()
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        least = min(ids) if ids else None
        out.update((rows[i][0], len(sets[i]), least, rows[i][0] == least) for i in members)
    return out


def variants(seed):
    """Chains and stars of copies at similarities around the limit."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(5000)}"
    rows = []
    for _ in range(6):
        base = [word() for _ in range(rng.randrange(30, 90))]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
            if rng.random() < 0.4:
                base = copy
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width,block", [(2, 512), (5, 3)])
def test_groups_equal_comparing_all_pairs(spark, monkeypatch, width, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = variants(width) + [(r[0] and r[0] + 10_000, r[1]) for r in cases.ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("other"))
    found = neardup.group(docs, width, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == brute_groups(rows, width)
    left = neardup.without_near_duplicates(docs, width, 80)
    assert left.columns == docs.columns


def test_rest_of_a_large_group_makes_no_pairs(spark, monkeypatch):
    """Copies around the limit, many groups in a bucket: what the rest of the buckets makes is bounded by their members."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(80)]
    rows = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(3, 8)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
        rows.append((i, " ".join(copy)))
    made, stage = {}, common.stage

    def counted(frame, name, path=None):
        done = stage(frame, name, path)
        made.setdefault(name, []).append(done.count())
        return done

    monkeypatch.setattr(common, "stage", counted)
    found = neardup.group(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == brute_groups(rows, 2)
    assert max(n for name in made if name.startswith("rest") for n in made[name]) <= made["members"][0]


@settings(max_examples=15, deadline=None)
@given(st.integers(1, 300), st.integers(0, 10**6))
def test_signatures_estimate_similarity(n, seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
    a, b = np.unique(pool[: n + n // 2]), np.unique(pool[n // 2 :])
    one = neardup.signatures(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2)
    assert (one[0] == neardup.signatures(a[::-1], np.zeros(len(a), np.int64), 1)[0]).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((one[0] == one[1]).mean() - true) < 0.25
    assert len(set((one[0] >> np.uint64(48)).tolist())) <= neardup.PLACES


def test_union_find_joins_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (105, 101), (200, 200)]
    rows = {r.node: r.root for r in neardup.union_find(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {rows[i] for i in range(61)} == {0} and {rows[i] for i in (100, 101, 105)} == {100}


def page(body):
    return f"<html><head><title>t</title></head><body>{body}</body></html>"


def test_blocks_of_a_page():
    html = page(
        "<header>Top</header><nav><ul><li>Menu</li></ul></nav><div class='cookie-notice'>Cookies</div>"
        "<article><header><h1>Title &amp; more</h1></header><p>One <b>bold</b>&nbsp;word<br>next<p>Two"
        "<div class=\"ad-box\"><p>Buy</p></div><aside>Aside</aside><form>Name</form><ul><li>a</li><li>b</li></ul>"
        "<script>if (a < b) {'</p>'}</script><section class='comments'><p>Nice!</p></section></article>"
        "<footer>&copy; x</footer>"
    )
    assert [t for t, z in hostsuffix.blocks(html) if z == hostsuffix.CONTENT] == ["Title & more", "One bold word", "next", "Two", "a", "b"]
    assert hostsuffix.blocks("<p>a<p class=advert>b<p>c") == [("a", 0), ("b", 2), ("c", 0)]
    assert hostsuffix.blocks("x <b unclosed") and hostsuffix.blocks("<!-- open <p>x") == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), max_size=5), st.integers(1, 5))
def test_repeats_equal_comparing_all_windows(pages, least):
    found = hostsuffix.repeated(pages, least)
    for i, words in enumerate(pages):
        want = np.zeros(len(words), bool)
        for at in range(len(words) - least + 1):
            run = words[at : at + least]
            if any(p != words and any(p[k : k + least] == run for k in range(len(p) - least + 1)) for p in pages):
                want[at : at + least] = True
        assert found[i].tolist() == want.tolist()


def test_open_pages_keep_their_unique_runs(spark, tmp_path):
    shared = "welcome to our site please read all of the following carefully"
    rows = [(i, "http://H.example:80/a", page(f"<div>{shared} story number {i} is here</div>")) for i in range(4)]
    rows += [(9, "http://other/", page(f"<div>{shared}</div>")), (None, None, None), (10, "http://h.example/b", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("other"))
    got = {r.page_id: r.text for r in hostsuffix.extract(pages).collect()}
    assert got == {**{i: f"{i} is here" for i in range(4)}, 9: shared, None: "", 10: ""}
    found = queries.op7_host_suffix_array(spark, cases.folder(spark, tmp_path / "a")).collect()
    assert Counter(r.page_id for r in found) == Counter(r[0] for r in cases.ROWS) and all(r.n_chars == len(r.text) for r in found)


def test_all_pages_of_a_large_host_are_compared(spark):
    """Passages on two of 700 pages, on most pages, on two hosts, and copies of a page: as one suffix array over the host."""
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(4000)}"
    bodies = [[word() for _ in range(rng.randrange(20))] for _ in range(700)]
    for k in range(60):
        passage = [word() for _ in range(rng.randrange(6, 11))]
        for i in rng.sample(range(700), 2 if k else 400):
            bodies[i][rng.randrange(len(bodies[i]) + 1) :] += passage
    bodies += bodies[:50]
    hosts = ["http://large/"] * 745 + ["http://small/"] * 5
    rows = [(i, h, page(f"<div>{' '.join(b)}</div>")) for i, (h, b) in enumerate(zip(hosts, bodies))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    for size in (8 << 20, 2000):
        got = {r.page_id: (r.text, r.n_outside, r.n_repeated) for r in hostsuffix.extract(pages, batch_bytes=size).collect()}
        for some in (slice(0, 745), slice(745, 750)):
            covered = hostsuffix.repeated(bodies[some], 8)
            for i, body, hit in zip(range(750)[some], bodies[some], covered):
                assert got[i] == (" ".join(w for w, x in zip(body, hit) if not x), len(body), hit.sum())


def test_only_what_may_be_a_repeat_is_dealt_out_in_full():
    """A batch sends less than one short hash for two words, and prefixes only of runs that other pages may have."""
    rng = random.Random(6)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = prose(12)
    bodies = [f"{prose(300)} {shared if i < 2 else prose(12)} {prose(300)}" for i in range(20)]
    blocks = [[{"text": b, "zone": hostsuffix.OPEN}] for b in bodies]
    group = pa.table({"blocks": pa.array(blocks, pa.list_(pa.struct([("text", pa.string()), ("zone", pa.int8())]))), "host": ["h"] * 20})
    rows = hostsuffix.Rows(group, 8)
    nowhere = np.zeros(len(rows.distinct), bool)
    assert len(rows.distinct) < len(rows.at) / 2
    runs = hostsuffix.Prefixes(rows, nowhere, 4)
    assert 5 <= len(runs.distinct) <= 12 and (runs.low != runs.high).sum() == 5
    want = hostsuffix.repeated([b.split(" ") for b in bodies], 8)
    assert (runs.covered(runs.low != runs.high) == np.concatenate(want)).all() and np.concatenate(want).sum() == 24
    # what another batch has of a page is asked about there
    alone = hostsuffix.Rows(group.slice(0, 1), 8)
    runs = hostsuffix.Prefixes(alone, np.isin(alone.distinct, hostsuffix.Rows(group.slice(1), 8).distinct), 4)
    assert 5 <= len(runs.distinct) <= 12


def test_repetition_decides_where_markup_does_not(spark):
    notice = "sign up for our weekly letter and never miss a story again"
    prose = lambda i, n=30: " ".join(f"p{i}w{k}" for k in range(n))
    bodies = [f"<article><p>{prose(i)}</p><div class=x>{notice}</div></article><div>note {i} of the editor</div><div><a href=/>More</a></div>" for i in range(3)]
    bodies += [bodies[0]]  # a copy does not erase the article
    bodies += [f"<article><p>{prose(7)} {prose(8 + k, 9)}</p></article>" for k in range(2)]  # copies with changes
    bodies += [f"<body class=has-sidebar><article class='post comments-open'><h2 class=banner>Head</h2>{prose(10)}</article><aside><article>Card</article></aside>"]
    bodies += [f"<div class=sidebar-wrap><article>{prose(11)}</article></div>"]
    rows = [(i, "http://h/", page(b)) for i, b in enumerate(bodies)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in hostsuffix.extract(pages, batch_bytes=300).collect()}
    want = {i: f"{prose(i % 3)}\nnote {i % 3} of the editor" for i in range(4)}
    assert got == {**want, 4: f"{prose(7)} {prose(8, 9)}", 5: f"{prose(7)} {prose(9, 9)}", 6: f"Head\n{prose(10)}", 7: prose(11)}


def test_articles_lose_whole_notices_only(spark):
    """Against the definition: on random articles with notices, quoted paragraphs, quoted words and a large other host."""
    rng = random.Random(5)
    prose = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    notice, rare, quoted = prose(12), prose(12), prose(20)
    rows = []
    for host, n, noticed, rares in (("large", 60, 15, 14), ("small", 8, 3, 2)):
        for i in range(n):
            blocks = [prose(60), f"{prose(9)} {quoted} {prose(9)}"] + [quoted] * (i < 2)
            blocks += [notice] * (i < noticed) + [rare] * (i >= n - rares)
            rng.shuffle(blocks)
            rows.append((len(rows), f"http://{host}/{i}", blocks, "\n".join(b for b in blocks if b != notice)))
    rows += [(900 + k, rows[k][1], rows[k][2], rows[k][3]) for k in range(5)]  # copies count once
    html = [(i, url, page("<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>")) for i, url, blocks, _ in rows]
    pages = spark.createDataFrame(html, "page_id long, url string, html string").repartition(3)
    for size in (8 << 20, 3000):
        got = {r.page_id: r.text for r in hostsuffix.extract(pages, batch_bytes=size).collect()}
        assert got == {i: text for i, _, _, text in rows}


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["lo", "ra", "mi", "ten", "sul"]) for _ in range(rng.randrange(1, 5)))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(20, 80))), "en", f"s{i % 3}", 1) for i in range(120)]
    rows += [(200 + i, rows[i][1], "en", "s0", 1) for i in range(20)] + [(300, rows[0][1] + " end", "en", "s0", 1)]
    path = cases.folder(spark, tmp_path / "p", rows)
    spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stage(stage(spark, docs, path), name)
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert len(seen["quality"]) == len(rows)
    assert len({r.text for r in seen["exact_dedup"]}) == len(seen["exact_dedup"]) == 121
    assert {r.doc_id for r in seen["near_dedup"]} == set(range(120))
    copies = Counter(r.doc_id for r in seen["mixing"])
    assert max(copies.values()) <= 3 and len(copies) < 120
    assert sum(r.length for r in seen["packing"] if r.start == 0) > 0
    assert sum(r.length for r in seen["packing"]) == sum({(r.doc_id): r.doc_tokens for r in seen["packing"]}[d] * n for d, n in copies.items())


def test_nothing_gives_nothing(spark, tmp_path):
    path = cases.folder(spark, tmp_path / "none", [])
    for name in ("op3_super_minhash", "op7_host_suffix_array"):
        assert queries.QUERIES[name](spark, path).count() == 0
    assert corpus_pipeline.run(spark, path).count() == 0


@pytest.mark.parametrize(
    "damaged",
    ["<svg " * 200_000, "<p " * 300_000, "<div>" * 100_000 + "</p>" * 100_000, "<p \"" * 200_000 + ">", "<p '\">" * 150_000, "<a" * 400_000,
     "<!-- " * 200_000, '<div class="' * 80_000, "<" * 500_000, '<p title="a>' * 80_000, "<svg>" * 200_000],
)
def test_damaged_markup_takes_linear_time(damaged):
    start = time.process_time()
    hostsuffix.blocks(damaged)
    assert time.process_time() - start < 5


def test_tags_are_read_as_the_pattern_reads_them():
    """Against one regular expression for all tokens, which is quadratic on damaged markup, on random small pages."""
    raw = "script|style|noscript|template|svg|math|iframe|object|canvas|textarea|select|title"
    quoted = r"""(?:[^>"']|"[^"]*"|'[^']*')*+>"""
    token = re.compile(
        rf"<!--.*?(?:-->|\Z)|<({raw})\b{quoted}.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)({quoted[:-1]})>|</?[a-zA-Z!?][^>]*>", re.S | re.I
    )
    rng = random.Random(3)
    bits = ["<p>", "</p>", "<svg>", "</svg >", "<SVG a='>'>", "<b class=\"x y\">", '"', "'", "<", ">", "x", " ", "<!-- ", "-->", "<!doctype html>", "</!x>",
            "<a href='q\">r'>", "<title", "<script-x>", "<br/>", "text", "\n", "<p title=\"a>", "/"]
    for _ in range(4000):
        page = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        want = [(m.start(), m.end(), m[3].lower() if m[3] else None) for m in token.finditer(page)]
        assert [t[:3] for t in hostsuffix.tags(page)] == want, page


def test_wrappers_comments_and_teasers():
    content = lambda html: [t for t, z in hostsuffix.blocks(html) if z == hostsuffix.CONTENT]
    assert content('<div class="page has-sidebar"><article><p>Real text</p></article></div><p>Copyright</p>') == ["Real text"]
    assert content('<div class="sidebar page"><article><p>The text of an article</p></article></div><p>Copyright</p>') == ["The text of an article"]
    assert content('<aside><article>Teaser</article></aside><p>An open text that is much longer</p>') == []
    page = '<main><p>Intro</p><article class="comment">c1</article><article class="teaser">t</article><article class="story">s</article></main>'
    assert content(page) == ["Intro", "s"]
