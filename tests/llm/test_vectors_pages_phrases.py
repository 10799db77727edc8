"""Operators 11 to 13 against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from kairo.llm import collocations, html_text, vector_codes
from kairo.llm.joins import lookup
from kairo.session import ship_package

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# -- lookup ---------------------------------------------------------------------------

def test_lookup_hot_keys_and_null_keys(spark):
    rows = spark.range(400).select(F.when(F.col("id") % 3 > 0, F.lit(None).cast("long"))
                                    .otherwise(F.col("id") % 40).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("total"))
    want = sorted((r.id, r.total) for r in rows.alias("r").join(
        table.alias("t"), F.expr("r.k <=> t.k")).select("r.id", "t.total").collect())
    for keys in (1, 5, 1000):
        out = lookup(rows, table, ["k"], "n", keys=keys)
        assert out.columns == ["k", "id", "total"]
        assert sorted((r.id, r.total) for r in out.collect()) == want


# -- operator 11 ----------------------------------------------------------------------

def brute_codes(rows, entries=256, rounds=4):
    """rows: (id, vector of 4 * w finite floats, label)"""
    x = {i: [int(np.floor(1024 * float(v))) for v in vec] for i, vec, _ in rows}
    w = len(next(iter(x.values()))) // 4
    books = [[x[i][p * w:p * w + w] for i in sorted(x)[:entries]] for p in range(4)]

    def nearest(p, part):
        d = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(4):
            got = defaultdict(list)
            for i in x:
                part = x[i][p * w:p * w + w]
                got[nearest(p, part)[0]].append(part)
            for e, parts in got.items():
                books[p][e] = [sum(c) // len(parts) for c in zip(*parts)]
    out = {}
    for i in x:
        code = [nearest(p, x[i][p * w:p * w + w]) for p in range(4)]
        out[i] = "".join(f"{c:02x}" for c, _ in code), sum(d for _, d in code)
    flat = ",".join(str(c) for b in books for e in b for c in e)
    return out, hashlib.sha256(flat.encode()).hexdigest()


VECTORS = "vec_id long, embedding array<float>, label int, code string, error long"


def vector_rows(n=60, width=8, seed=0):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-0.5, -0.25, 0.1, 0.3, rng.gauss(0, 0.2)]) for _ in range(width)],
             rng.choice([None, 1, 2]), "x", 0) for i in range(n)]
    rows[7] = (7, rows[3][1], 1, "x", 0)                     # equal vectors
    rows[9] = (9, rows[3][1], None, "x", 0)
    return rows


BAD = [(100, None, 1, "x", 0), (101, [0.5] * 7 + [None], 1, "x", 0),
       (102, [float("nan")] * 8, 1, "x", 0), (103, [float("inf")] + [0.0] * 7, None, "x", 0),
       (-5, [float("-inf")] + [0.0] * 7, None, "x", 0)]


@pytest.mark.parametrize("entries", [3, 16, 256])
def test_vector_codes(spark, entries):
    rows = vector_rows()
    df = spark.createDataFrame(rows + BAD, VECTORS).repartition(5)
    got = vector_codes.compress_vectors(df, entries=entries, cell=64) \
        .withColumn("code", vector_codes.code_hex()).collect()
    want, sha = brute_codes([r[:3] for r in rows], entries)
    assert {r.vec_id: (r.code, r.error) for r in got} == want and len(got) == len(rows)
    label = {r[0]: r[2] for r in rows}
    sums = Counter()
    for i, (_, e) in want.items():
        sums[label[i]] += e
    assert all(r.label_error == sums[label[r.vec_id]] for r in got)
    assert {r.codebooks_sha256 for r in got} == {sha}


def test_vector_codes_odd_rows(spark):
    """Repeated rows, rows without id, other lengths, huge components, empty tables."""
    rows = vector_rows(20)
    odd = [rows[4], (None, rows[5][1], 1, "x", 0), (200, [0.1] * 4, 5, "x", 0),
           (201, [], 5, "x", 0), (202, [3e38] + [0.0] * 7, 5, "x", 0)]
    got = vector_codes.compress_vectors(
        spark.createDataFrame(rows + odd + BAD, VECTORS), entries=6).collect()
    assert len(got) == len(rows) + len(odd)
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append((tuple(r.code or ()), r.error, r.label_error))
    assert len(by[4]) == 2 and len(set(by[4])) == 1
    assert by[None][0][:2] == by[5][0][:2]
    assert all(by[i] == [((), None, None)] for i in (200, 201, 202))
    empty = spark.createDataFrame([], VECTORS)
    assert vector_codes.compress_vectors(empty).collect() == []
    assert vector_codes.compress_vectors(spark.createDataFrame(BAD, VECTORS)).collect() == []


def test_cells_equal_plain_search():
    rng = np.random.default_rng(1)
    for _ in range(150):
        k, w, m = rng.integers(1, 9), rng.integers(1, 5), int(rng.choice([3, 50, 1 << 27]))
        book, x = rng.integers(-m, m + 1, (k, w)), rng.integers(-m, m + 1, (40, w))
        x[:5] = book[rng.integers(0, k, 5)]
        d = ((x[:, None, :] - book) ** 2).sum(axis=2)
        cells = vector_codes.Cells(book, int(rng.choice([1, 4, 32, 1 << 20])), limit=3)
        for _ in range(2):                                  # the second time from the memo
            code, error = cells.nearest(x)
            assert (code == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()


def test_survivors_are_few(spark):
    """On the given vectors, cells leave a small part of the entries to compare."""
    v = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").select("embedding").collect()
    x = np.floor(np.array([r[0] for r in v], np.float64) * 1024).astype(np.int64)[:, :16]
    cells = vector_codes.Cells(x[:256], 32)
    cells.nearest(x)
    assert np.mean([len(a) for a in cells.memo.values()]) < 0.15 * 256


# -- operator 12 ----------------------------------------------------------------------

P = "<p>The quick, brown fox jumps over the lazy dog, again and again, until it tires of it.</p>"
T = unescape(re.sub("<.*?>", "", P))

PAGES = {
    "class names": (
        f"<html><body><div id=header><a href=/>Home</a></div><div class='menu'><ul><li><a>x</a></ul>"
        f"</div><div class=content><h2>T</h2>{P * 3}<ul><li>one<li>two</ul><blockquote>q</blockquote>"
        f"</div><div class=sidebar>{P}</div><div class='comments'><div class=comment>{P * 5}</div></div>"
        f"<div class=footer>c</div></body></html>", ["T", T, T, T, "one", "two", "q"]),
    "sections": (f"<body><div id=wrap><div class=s1>{P * 3}</div><div class=s2>{P}</div><div class=s3>"
                 f"<p>Short.</p></div></div><div id=disqus_thread>{P}</div>", [T] * 4 + ["Short."]),
    "flat": (f"<body><h1>Head</h1>{P}<p>short</p>tail text<form><p>Sign up, now</p><input></form>",
             ["Head", T, "short", "tail text"]),
    "header, table, references": (
        f"<article><header><h1>H</h1><p>by me</p></header><table><tr><td>a<td>b<tr><td>c</table>{P}"
        "<p>x &lt;y&gt; &amp;amp; &nbsp; &#8364;&copy<footer>f</footer></article>",
        ["H", "a", "b", "c", T, "x <y> &amp; €©"]),
    "comments as articles": (
        f"<main><article>{P}<p>u<div class=ad>buy</div>v</p></article><article class=comment>{P * 9}"
        "</article></main>", [T, "u", "v"]),
    "nameless comments beside": (
        f"<header><h1>Site</h1></header><div class=notice>{P}</div><article><h1>A</h1>{P}</article>"
        f"<section><h2>Comments</h2>{P * 9}</section><aside>{P * 3}</aside>", ["A", T]),
    "a part's header": (
        f"<div class=page-header><h1>Site</h1></div><div class=post><div class=post-header><h1>A</h1>"
        f"<span>by me</span></div>{P * 2}<p>short</div><div class=discussion>{P * 4}</div>",
        ["A", T, T, "short"]),
    "comments inside": (f"<article>{P}<section id=comments>{P * 9}</section><h2 id=market-share>M</h2>"
                        "</article>", [T, "M"]),
    "cut off": (f"<article>{P}<p>cut <a href='x", [T, "cut"]),
    "misnested": (f"<article><b><div>{P}</b><p>more</div><i>{P}</article><p>out", [T, "more", T]),
    "raw": (f"<body><script>var t='</p>{P}'</script><style>p{{}}</style><div>{P}</div><!-- {P} -->"
            "<noscript><p>no</p></noscript>", [T]),
    "white space": ("<article><p> a\n\t b<br>c&#160;d <b>e</b>f </p>\n<pre> g\n h</pre></article>",
                    ["a b c d ef", "g h"]),
    "links": (f"<article>{P}<p>see <a>this</a> and that</p><ul><li><a>one</a><li><a>two</a></ul></article>",
              [T, "see this and that"]),
    "text only": ("just words", ["just words"]), "nothing": ("", []), "null": (None, []),
    "blank": (" \n <p> </p>", []), "no letters": ("<<<>><", ["<<<>><"]),
    "deep": ("<div>" * 20_000 + P + "</div>" * 20_000, [T]),
    "long": ("<article>" + P * 20_000, [T] * 20_000),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    html, want = PAGES[name]
    assert html_text.main_text(html) == "\n\n".join(want)


def brute_page(html: str) -> str:
    """The given pages' shape: one article of headings and paragraphs."""
    body = re.search(r"<article>(.*)</article>", html, re.S)[1]
    parts = (re.sub(r"</?b>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)>", body))
    return "\n\n".join(t for p in parts if (t := " ".join(unescape(p).split())))


def test_pages_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_text.extract_text(pages).collect()}
    want = {r.page_id: brute_page(r.html) for r in pages.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_pages_odd_rows(spark):
    rows = [(1, "u", PAGES["flat"][0], "x", 1), (1, "u", PAGES["flat"][0], "x", 1),
            (None, None, None, None, None), (2, "", "", "t", 5)]
    schema = "page_id long, url string, html string, text string, n_chars long"
    got = html_text.extract_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r.page_id or 0), r.n_chars) for r in got)[:1] == [(0, 0)]
    flat = "\n\n".join(PAGES["flat"][1])
    assert [r.text for r in got if r.page_id == 1] == [flat, flat]
    assert html_text.extract_text(spark.createDataFrame([], schema)).collect() == []


# -- operator 13 ----------------------------------------------------------------------

def brute_phrases(rows, least, top=2000, longest=4):
    """rows: (lang, text)"""
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                count[lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = {}
    for lang, f in count.items():
        often = {g: a for g, a in f.items() if a >= least}
        scored = []
        for g, a in often.items():
            if len(g) == 1:
                continue
            held = any(len(h) > len(g) and 100 * b >= 80 * a and
                       any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1))
                       for h, b in often.items())
            if held:
                continue
            s, k = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-s, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, g, l, r) in enumerate(sorted(scored)[:top], 1):
            out[lang, rank] = (g.decode(), -a, l, r, total[lang], -s)
    return out


def phrase_rows(n=150, seed=3):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "New", "times", "é", "ÀB", "a b", "x" * 30]
    def text():
        out = []
        for _ in range(rng.randrange(60)):
            out.append("new york times" if rng.random() < 0.2 else rng.choice(vocabulary))
            out.append(rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\r\n", " ", " ", " "]))
        return "".join(out)
    rows = [(i, text(), rng.choice(["en", "en", "de", None]), 1, "p") for i in range(n)]
    rows += [rows[5]] * 20 + [(None, rows[6][1], "en", 1, "p"), (1000, None, "en", 1, "p"),
                              (1001, "", None, 1, "p"), (1002, " \t\n.", "de", 1, "p"),
                              (1003, "a of " * 5000, "zz", 1, "p")]
    return rows


PHRASES = "doc_id long, text string, lang string, n long, phrase string"


@pytest.mark.parametrize("least,size", [(3, {}), (20, {"entries": 40, "burst": 4}),
                                        (2, {"entries": 300, "burst": 2})])
def test_phrases(spark, least, size):
    """Tries that burst and spill count as one that does not."""
    rows = phrase_rows()
    df = spark.createDataFrame(rows, PHRASES).repartition(4)
    got = collocations.mine_phrases(df, least=least, top=50, **size).collect()
    want = brute_phrases([(r[2], r[1]) for r in rows], least, top=50)
    assert {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got} == want
    assert len(got) == len(want) > 20


def test_phrases_empty(spark):
    assert collocations.mine_phrases(spark.createDataFrame([], PHRASES)).collect() == []
    blank = [(1, None, None, 1, "p"), (2, "", "en", 1, "p")]
    assert collocations.mine_phrases(spark.createDataFrame(blank, PHRASES)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    n = 9_000_000_000_000_000_001
    counts = spark.createDataFrame([("en", 1, "a", n), ("en", 1, "b", n - 1), ("en", 2, "a b", n - 2)],
                                   "lang string, words int, phrase string, n long")
    got = collocations.score_phrases(counts).collect()[0]
    assert got.score == 2_000_000 * (n - 2) // (2 * n - 1)


def test_trie_bursts_and_spills():
    rng = random.Random(5)
    trie, want = collocations.HatTrie(burst=3), Counter()
    taken = Counter()
    for _ in range(400):
        root = rng.randrange(1, 4)
        keys = sorted({sum(rng.randrange(1, 5) << (21 * j) for j in range(rng.randrange(4)))
                       for _ in range(rng.randrange(1, 6))})
        counts = [rng.randrange(1, 9) for _ in keys]
        want.update({(root, k): c for k, c in zip(keys, counts)})
        trie.add(root, keys, counts)
        if rng.random() < 0.02:
            for r in trie.largest(trie.entries // 2):
                taken.update({(r, k): c for k, c in zip(*trie.take(r))})
    assert isinstance(next(iter(trie.roots.values())), list)
    assert trie.entries == sum(trie.sizes.values())
    for r in list(trie.roots):
        taken.update({(r, k): c for k, c in zip(*trie.take(r))})
    assert taken == want and trie.entries == 0
