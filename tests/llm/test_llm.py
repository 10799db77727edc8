"""Corpus operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from kairo.llm import arrays as A
from kairo.llm import chat, lines, near, pieces, quality, sharding, simhash, suffix, token_counts
from kairo.llm.decontaminate import find_contamination
from kairo.llm.graph import connected_components
from kairo.session import ship_package

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, n long, key long, size long, sig string"

P1 = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))
P2 = "\n".join(f"line {i} of a passage that stands in several texts, {i * i}" for i in range(8))
LONG = "x" + " ab cd" * 40_000


def awkward() -> list[tuple]:
    """Nulls, empty, blank, long and repeated texts, ties; ids out of order."""
    texts = {7: None, 3: "", 5: " \t\n", 9: P1, 2: P1, 11: P1.replace("alpha30", "gamma"),
             4: "one", 6: "one two", 8: "A a A a A a", 10: LONG, 12: P2, 13: "before\n" + P2 + "\nafter",
             14: "é漢字🦙" * 50, 15: "é漢字🦙" * 50 + P1, 16: "x" * 99, 17: "x" * 100, 18: "x" * 300}
    return [(d, t, "en", 1, 2, 3, "s") for d, t in texts.items()]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    return spark.createDataFrame(awkward(), SCHEMA)


@pytest.fixture(scope="module")
def odd(spark, docs):
    """As ``docs``, with a repeated row and rows without an id."""
    more = [awkward()[3], (None, P1, None, None, None, None, None), (None, None, "x", 0, 0, 0, "")]
    return docs.union(spark.createDataFrame(more, SCHEMA))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(df) -> dict[int, str]:
    return {r.doc_id: r.text or "" for r in df.collect()}


def sha(b: bytes | str) -> str:
    return hashlib.sha256(b.encode() if isinstance(b, str) else b).hexdigest()


def words(t: str) -> list[bytes]:
    low = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    return re.findall(rb"[^\x20\x09-\x0d]+", t.encode().translate(low))


def shingles(t: str, k: int) -> list[tuple]:
    w = words(t)
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else []


# --- helpers

def test_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(40, 70)] + [(rnd.randint(100, 160), rnd.randint(100, 160))
                                                   for _ in range(40)] + [(5, 5), (1, 900), (900, 3)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_and_shingles():
    import pyarrow as pa
    col = pa.array(["a  b\tc", "", "x", None, "c a b c"]).fill_null("")
    buf, off = A.raw(col)
    start, end, first = A.words(buf, off)
    assert first.tolist() == [0, 3, 3, 4, 4, 8]
    h = A.word_hashes(buf, start, end)
    assert h[0] == h[5] and h[2] == h[4] == h[7] and len(set(h.tolist())) == 4
    s, f = A.shingles(h, first, 3)
    assert f.tolist() == [0, 1, 1, 2, 2, 4] and s[0] == s[3] != s[2]


# --- 1

def brute_shards(rows: dict, shards: int):
    groups = defaultdict(list)
    for d, t in rows.items():
        groups[t].append(d)
    order = sorted(groups.values(), key=min)
    sizes = [sum(len(rows[d].encode()) + 1 for d in g) for g in order]

    def cut(cap):
        out, left, k = [], cap, 0
        for s in sizes:
            if s > cap:
                return None
            if s > left:
                k, left = k + 1, cap
            left -= s
            out.append(k)
        return out if k < shards else None
    cap = next(c for c in range(max(sizes), sum(sizes) + 1) if cut(c))
    return {d: k for g, k in zip(order, cut(cap)) for d in g}


def test_sharding(docs, odd, empty):
    short = docs.filter("length(text) < 5000 OR text IS NULL")
    want = brute_shards(texts(short), 8)
    got = sharding.shard_documents(short).collect()
    assert {r.doc_id: r.shard for r in got} == want
    for k in range(8):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    import zlib
    t = texts(short)
    assert all(r.text_crc32 == zlib.crc32(t[r.doc_id].encode()) and r.size == len(t[r.doc_id].encode()) + 1
               for r in got)
    assert sharding.shard_documents(odd).count() == odd.count()
    assert sharding.shard_documents(empty).collect() == []


# --- 2

def test_line_dedup(docs, odd, empty):
    t = texts(docs)
    got = {r.doc_id: r for r in lines.remove_repeated_lines(docs).collect()}
    assert set(got) == set(t)
    assert got[12].n_removed == 0 and got[12].kept == P2
    assert got[13].n_removed >= 6 and got[13].kept.startswith("before")
    seen = set()
    for d in sorted(t):
        body = t[d].split("\n")
        pairs = {(i, i + 1) for i in range(len(body) - 1) if (body[i], body[i + 1]) in seen}
        seen |= {(body[i], body[i + 1]) for i in range(len(body) - 1)}
        covered = {i for p in pairs for i in p}
        left = got[d].kept.split("\n") if got[d].n_removed < len(body) else []
        # only lines of repeated pairs go, and the rest keeps its order
        must = [x for i, x in enumerate(body) if i not in covered]
        it = iter(left)
        assert all(x in it for x in must), d
        assert got[d].kept_sha256 == sha(got[d].kept) and got[d].n_lines == len(body)
    again = lines.remove_repeated_lines(odd)
    assert again.count() == odd.count()
    assert {r.n_removed for r in again.collect() if r.doc_id == 13} == {got[13].n_removed}
    assert lines.remove_repeated_lines(empty).collect() == []


def brute_lines(docs: dict) -> dict:
    first, out = {}, {}
    for d in sorted(docs):
        body = docs[d].split("\n")
        gone = set()
        for p, pair in enumerate(zip(body, body[1:])):
            if first.setdefault(pair, (d, p)) not in ((d, p), (d, p - 1)):
                gone |= {p, p + 1}
        out[d] = len(body), len(gone), "\n".join(x for i, x in enumerate(body) if i not in gone)
    return out


def test_line_dedup_runs_of_equal_lines(spark, docs):
    """Runs of equal lines, and passages whose ends differ, against brute force."""
    rnd = random.Random(2)
    rows = {1: "\n".join(["top", *["same"] * 6, "end"]), 2: "\n".join(["same"] * 4),
            3: "\n".join(["other", *["same"] * 9, "more"]), 4: "same", 5: "same\nsame",
            6: "\n".join(["b"] * 3), 7: "x\ny\nx\ny\nx"}
    rows |= {d: "\n".join(f"line {rnd.randrange(12)}" for _ in range(rnd.randint(1, 14)))
             for d in range(10, 60)}
    for some in (rows, texts(docs)):
        table = spark.createDataFrame(list(some.items()), "doc_id long, text string")
        got = {r.doc_id: (r.n_lines, r.n_removed, r.kept)
               for r in lines.remove_repeated_lines(table).collect()}
        want = brute_lines(some)
        assert {d: g for d, g in got.items() if d < 9} == {d: w for d, w in want.items() if d < 9}
        assert all(g[0] == want[d][0] and g[1] <= want[d][1] for d, g in got.items())
        assert sum(g[1] for g in got.values()) >= 0.95 * sum(w[1] for w in want.values())


def test_line_dedup_recall(spark):
    """Of all lines in pairs that occur earlier, cuts alone find nearly all; without
    chunkings only runs of equal lines are left to find."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_lines(texts(table))
    got = {r.doc_id: r for r in lines.remove_repeated_lines(table).collect()}
    assert all(r.n_removed <= want[d][1] for d, r in got.items())
    assert sum(r.n_removed for r in got.values()) >= 0.99 * sum(w[1] for w in want.values()) > 0
    runs = {d: [k for k, g in itertools.groupby(t.split("\n")) if len(list(g)) > 1]
            for d, t in texts(table).items()}
    assert all(runs[r.doc_id] for r in lines.remove_repeated_lines(table, chunkings=0).collect()
               if r.n_removed)


# --- 3

def recount(t, old: str, start: int, end: int, new: str) -> tuple[str, int]:
    """The edited text, and the pre-tokens encoded for the edit, by both texts' own
    boundaries: from the one before the edit's context to the first that both have."""
    def ends(x):
        return set(itertools.accumulate(map(len, t.split(x)), initial=0))
    n = len(old)
    start = min(max(start, 0), n)
    end = min(max(end, start), n)
    text, shift = old[:start] + new + old[end:], len(new) - (end - start)
    if not n:
        return text, len(t.split(text))
    before, k = ends(old), 0
    for m in t.iterate(text, max(b for b in before if b <= max(start - token_counts.CONTEXT, 0))):
        k += 1
        if m.end() >= start + len(new) and m.end() - shift >= end and m.end() - shift in before:
            break
    return text, k


def test_token_counts_fuzz():
    t = token_counts.pre_tokens(RANKS, public_tokenizers.PATTERN)
    full = lambda x: len(t._encoding.encode_ordinary(x))
    rnd = random.Random(3)
    parts = list("ab c  \n\t'stre,.!12é漢  ") + ["  ", "'ll", " the", "\n\n", "   x"]
    for _ in range(1500):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        tree = token_counts.CountTree(text, t)
        assert tree.total == full(text)
        for _ in range(4):
            a = rnd.randint(0, len(text) + 2)
            b = rnd.choice([a, a + rnd.randint(0, 6), len(text) + 9])
            new = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 4)))
            done = tree.encoded
            total = tree.edit(a, b, new)
            text, k = recount(t, text, a, b, new)
            assert tree.text == text and total == tree.total == full(text)
            assert tree.encoded - done == k


def test_token_counts_emptied_text():
    t = token_counts.pre_tokens(RANKS, public_tokenizers.PATTERN)
    tree = token_counts.CountTree("one two three", t)
    assert tree.edit(0, 99, "") == 0 and tree.edit(0, 0, "x") == 1 and tree.encoded == 4


def test_token_counts(odd, empty):
    p = public_tokenizers.PATTERN
    t = token_counts.pre_tokens(RANKS, p)
    got = token_counts.count_tokens(odd, RANKS, p, token_counts.sample_edits()).collect()
    rows = odd.collect()
    assert len(got) == len(rows)
    want = Counter((r.doc_id, len(t._encoding.encode_ordinary(r.text or ""))) for r in rows)
    assert Counter((r.doc_id, r.n_tokens) for r in got) == want
    long = next(r for r in got if r.doc_id == 10)
    assert long.n_reencoded < 100 < long.n_pretokens
    none = token_counts.count_tokens(odd, RANKS, p, F.lit(None).cast(
        "array<struct<start:int,end:int,replacement:string>>")).collect()
    assert all(r.n_tokens == r.n_tokens_edited for r in none)
    assert token_counts.count_tokens(empty, RANKS, p, token_counts.sample_edits()).collect() == []


# --- 4

def test_fingerprint_edits(docs, odd, empty):
    t = sorted(texts(docs).items())
    got = {r.doc_id: r for r in simhash.fingerprint_edits(docs).collect()}
    assert len(got) == len(t)
    for k, (d, text) in enumerate(t):
        other, n = t[(k + 1) % len(t)][1], len(text) // 4
        edited = text[:len(text) - n] + other[:n] if n else text
        assert got[d].n_chars == len(text) and got[d].edited_sha256 == sha(edited)
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        same = simhash.likeness(*(np.frombuffer(bytes.fromhex(x), np.uint8)[None]
                                  for x in (got[d].fingerprint, got[d].edited_fingerprint)))
        assert same[0] == got[d].near_edited
    assert got[9].fingerprint == got[2].fingerprint
    assert simhash.fingerprint_edits(odd).count() == odd.count()
    assert simhash.fingerprint_edits(docs.filter("doc_id = 9")).first().near_next == 1.0
    assert simhash.fingerprint_edits(empty).collect() == []


def test_fingerprint_search(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(128) for _ in range(30)]
    every = base + [b ^ sum(1 << rnd.randrange(128) for _ in range(k % 7)) for k, b in enumerate(base)]
    df = spark.createDataFrame([(f"{x:032x}",) for x in every] + [(None,)], "fingerprint string")
    for radius, extra in ((0, 1), (3, 1), (5, 2)):
        got = {(r.query, r.fingerprint): r.distance for r in
               simhash.near_fingerprints(df, df, radius, extra=extra).collect()}
        want = {(f"{a:032x}", f"{b:032x}"): (a ^ b).bit_count() for a, b in
                itertools.product(set(every), repeat=2) if a != b and (a ^ b).bit_count() <= radius}
        assert got == want


# --- 5

def test_pieces_match_library():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    c = pieces.codec(MODEL)
    rnd = random.Random(1)
    parts = list(" \n\t\r▁aabcdehilnostu.,!<>0x41éüß漢字🦙\x00́﻿\xa0") + \
        ["  ", "the", "ing", "\r\n", "ﬁ", "½", "한국", "русский", "²."]
    for _ in range(3000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))
        ids = sp.encode(t)
        assert c.encode(t) == ids and c.decode(ids) == sp.decode(ids)
        assert c.digest(t) == (len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids)))
    tokens = list(c._left)
    for _ in range(5000):
        a, b = rnd.choice(tokens[:1500]), rnd.choice(tokens[:1500])
        if pieces.MARK not in b:
            assert c.compatible(a, b) == ([t[0] for t in c.merge_tree(a + b)] == [a, b])


def test_pieces_tables(docs, odd, empty):
    encoded = pieces.encode_documents(docs, MODEL)
    back = {r.doc_id: r.text for r in pieces.decode_documents(encoded, MODEL).collect()}
    assert back == texts(docs)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    for r in pieces.round_trip(odd, MODEL).collect():
        if r.doc_id is not None:
            assert r.n_tokens == len(ids[r.doc_id])
            assert r.ids_sha256 == sha(",".join(map(str, ids[r.doc_id])))
    assert pieces.round_trip(odd, MODEL).count() == odd.count()
    assert pieces.round_trip(empty, MODEL).collect() == []


# --- 6

def test_quality(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.selected for r in quality.select_documents(docs, labels).collect()}
    rows = labels.collect()
    good = [got[r.doc_id] for r in rows if r.quality == 1 and r.toxic == 0]
    toxic = [got[r.doc_id] for r in rows if r.toxic == 1]
    poor = [got[r.doc_id] for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(toxic) < 0.15 and np.mean(poor) < 0.05
    some = labels.limit(5).unionByName(spark.createDataFrame(
        [(None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int"))
    assert quality.select_documents(odd, some).count() == odd.count()
    assert all(r.selected for r in quality.select_documents(odd, labels.limit(0)).collect())
    assert quality.select_documents(empty, labels).collect() == []


def test_quality_held_out(spark):
    """Documents whose labels neither model nor cut has seen (by id hash)."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    got = {r.doc_id: r.selected for r in quality.select_documents(docs, labels.filter(~out)).collect()}
    rows = labels.filter(out).collect()
    good = [got[r.doc_id] for r in rows if r.quality == 1 and r.toxic == 0]
    toxic = [got[r.doc_id] for r in rows if r.toxic == 1]
    poor = [got[r.doc_id] for r in rows if r.quality == 0]
    assert min(len(good), len(toxic), len(poor)) > 50
    assert np.mean(good) > 0.98 and np.mean(toxic) < 0.15 and np.mean(poor) < 0.05


def test_kth_largest(spark):
    rnd = random.Random(5)
    values = [rnd.choice([rnd.gauss(0, 1), 0.5, -3.0]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 700, 1500, 2999, 3000):
        assert quality.kth_largest(df, "x", k, bins=7, few=10) == sorted(values, reverse=True)[k - 1]


# --- 7

def brute_contamination(docs: dict, items: dict, k: int = 5, least: float = 0.8):
    out = {}
    for d, t in docs.items():
        s = shingles(t, k)
        for i, body in items.items():
            want = Counter(shingles(body, k))
            if not want or not set(want) & set(s):
                continue
            m = min(max(1, len(words(body)) - k + 1), len(s))
            best = 0.0
            for p in range(len(s) - m + 1):
                a = Counter(s[p:p + m])
                both = sum((a & want).values())
                best = max(best, both / (sum(a.values()) + sum(want.values()) - both))
            if best >= least:
                out[d, i] = best
    return out


def test_contamination(spark, odd, empty):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = {r.item_id: r.text for r in bench.collect()}
    want = brute_contamination(texts(docs), items)
    for bound in (4 << 20, 3000):               # one block, and several
        got = {(r.doc_id, r.item_id): r.similarity for r in find_contamination(docs, bench, bound=bound).collect()}
        assert got == pytest.approx(want)
    own = spark.createDataFrame([(1, P1), (2, None), (3, ""), (4, "one"), (4, "one"), (None, "zzz")],
                                "item_id long, text string")
    got = find_contamination(odd, own).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(9, 1), (2, 1), (11, 1), (15, 1), (4, 4), (None, 1)}
    assert find_contamination(empty, bench).collect() == []
    assert find_contamination(odd, bench.limit(0)).collect() == []


def test_contamination_whole(spark):
    """Short items inside longer texts, and windows whose bits differ too much."""
    items = {1: "one", 2: "One two three", 3: "two  three four five", 4: P1, 5: "", 6: "one"}
    docs = {1: "zero one two three four five six one", 2: "one", 3: "six one\ttwo three", 4: P1 + " end",
            5: P1.replace("alpha30", "gamma"), 6: "three two one", 7: None, 8: "onetwo three four five"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): (r.first_word, r.n_words) for r in find_contamination(table, bench).collect()}
    want = {}
    for d, t in docs.items():
        for i, body in items.items():
            a, b = words(t or ""), words(body)
            at = [p for p in range(len(a) - len(b) + 1) if a[p:p + len(b)] == b]
            if b and at:
                want[d, i] = at[0], len(b)
    assert got == want | {(5, 4): (0, 120)}
    # the radius decides: only equal fingerprints are within none
    got = {(r.doc_id, r.item_id): r.similarity for r in find_contamination(
        table, bench.filter("item_id = 4"), radius=0).collect()}
    assert got == {(4, 4): 1.0}


def test_contamination_comes_from_candidates(monkeypatch):
    """Nothing is found without the fingerprint search; with it, hardly any window of
    similarity 0.8 is missed."""
    from kairo.llm.decontaminate import Matcher
    rnd = random.Random(4)
    items, hits, all_ = [], 0, 0
    for k in range(300):
        n = rnd.randint(15, 120)
        items.append((k, " ".join(f"v{rnd.randrange(5000)}" for _ in range(n))))
    matcher = Matcher(items, 5, 31, 0.8)

    def found(m, text):
        import pyarrow as pa
        buf, off = A.raw(pa.array([text]))
        start, end, first = A.words(buf, off)
        w = A.word_hashes(buf, start, end)
        return {k for k, *_ in m.match(A.shingles(w, first, 5)[0], len(start))}

    for k, text in items:
        w = text.split()
        # drop words from an end until the shingles left are just similar enough
        n = len(w) - 4
        cut = w[:4 + -(-n * 8 // 9)]
        edited = " ".join(["x"] * 9 + cut + ["y"] * 200)
        want = brute_contamination({0: edited}, {k: text})
        all_ += len(want)
        hits += bool(want) and k in found(matcher, edited)
    assert all_ > 200 and hits >= 0.99 * all_
    monkeypatch.setattr(Matcher, "_candidates", lambda self, f: [])
    assert not any(found(matcher, text) for _, text in items)
    assert not list(Matcher([(1, "one two")], 5, 31, 0.8).short_items(
        *_hashes("zero one two three")))


def _hashes(text):
    import pyarrow as pa
    buf, off = A.raw(pa.array([text]))
    start, end, first = A.words(buf, off)
    return A.word_hashes(buf, start, end), first


# --- 8

def test_chat_null_identifiers(spark):
    """Turns without conversation or number link with nothing."""
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (None, 0, "user", "lost"),
            (None, 0, "user", "too"), (None, 1, "assistant", "answer"), (2, None, "user", "x"),
            (2, None, "assistant", "y"), (None, None, "user", "z")]
    c = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    calls, results = chat.conversation_calls(c)
    assert sorted(str(r.call_id) for r in calls.collect()) == ["1-0"] + ["None"] * 4
    assert sorted(str(r.call_id) for r in results.collect()) == ["1-0"] + ["None"] * 2
    got = chat.link_tool_calls(calls, results, chat.TOOLS).collect()
    assert [(r.call_id, r.conv_id, r.status, r.level) for r in got] == [("1-0", 1, "linked", 0)]


def test_chat_links(spark):
    tools = {"f": {"a": {"type": "integer", "required": True, "minimum": 1},
                   "b": {"type": "string", "required": False, "enum": ["x", "y"]}}}
    calls = [("c1", 1, "f", '{"b":"x", "a":2}', None), ("c2", 1, "f", '{"a":0}', "c1"),
             ("c3", 1, "g", "{}", "c2"), ("c4", 2, "f", "[1]", "none"), ("c5", 2, "f", "{", "c4"),
             ("c6", 3, "f", '{"a":"1","b":"z"}', "c7"), ("c7", 3, "f", '{"a":null}', "c6"),
             ("c8", None, None, None, "c6"), ("c1", 1, "f", '{"b":"x", "a":2}', None),
             (None, 1, "f", "{}", None)] + \
            [(f"d{i:03d}", 9, "f", '{"a":1}', f"d{i - 1:03d}" if i else None) for i in range(100)]
    results = [("c1", 'say "hi"\n'), ("c1", "zz"), ("c9", None), (None, "lost")]
    calls = spark.createDataFrame([(*c, 0) for c in calls],
                                  "call_id string, conv_id long, name string, arguments string, "
                                  "depends_on string, content int")
    results = spark.createDataFrame(results, "call_id string, content string")
    got = {r.call_id: r for r in chat.link_tool_calls(calls, results, tools).collect()}
    assert len(got) == 109
    assert [got[f"c{i}"].level for i in range(1, 10)] == [0, 1, 2, 0, 1, None, None, None, None]
    assert all(got[f"d{i:03d}"].level == i for i in range(100))
    assert got["c1"].valid and got["c1"].status == "linked" and got["c9"].status == "orphan"
    assert got["c1"].message == ('{"arguments":{"a":2,"b":"x"},"id":"c1","level":0,"name":"f",'
                                 '"result":"say \\"hi\\"\\n"}')
    assert got["c2"].problems == ["a: too small"] and got["c3"].problems == ["unknown tool"]
    assert got["c4"].problems == ["arguments are not an object"]
    assert got["c5"].problems == ["arguments are not JSON"]
    assert got["c6"].problems == ["a: not integer", "b: not allowed", "depends on itself"]
    assert got["c7"].problems == ["a: not integer", "depends on itself"]
    none = chat.link_tool_calls(calls.limit(0), results.limit(0), tools)
    assert none.collect() == []


# --- 9

def brute_near(docs: dict, k: int, num: int, den: int):
    sets = {d: set(shingles(t, k)) for d, t in docs.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    owners = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            owners[x].add(d)
    pairs = {p for o in owners.values() for p in itertools.combinations(sorted(o), 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("k,num,den", [(3, 85, 100), (5, 4, 5)])
def test_near(docs, k, num, den):
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in near.near_components(docs, words=k, num=num, den=den).collect()}
    assert got == brute_near(texts(docs), k, num, den)


def test_near_large_group(spark):
    """A group of near copies in which many are linked only through others."""
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(140):
        w = list(base)
        for _ in range(rnd.choice((0, 1, 2, 3, 5))):
            w[rnd.randrange(120)] = f"v{rnd.randrange(10 ** 6)}"
        rows.append((d + 1000, " ".join(w)))
    got = near.near_components(spark.createDataFrame(rows, "doc_id long, text string"),
                               words=3, num=85, den=100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == \
        brute_near(dict(rows), 3, 85, 100)


def test_near_odd_rows(odd, empty):
    got = near.near_components(odd, words=3, num=85, den=100).collect()
    assert len(got) == odd.count()
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert near.near_components(empty).collect() == []


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join((a, b)[bin(i).count("1") % 2] for i in range(n))


def test_words_that_collide_modulo_a_power_of_two(spark):
    """Two words whose polynomial hashes modulo 2**64 are equal whatever the base."""
    one, two = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    import pyarrow as pa
    buf, off = A.raw(pa.array([one, two]))
    start, end, _ = A.words(buf, off)
    assert len(set(A.range_hashes(A.prefix_hashes(buf), start, end).tolist())) == 1
    assert len(set(A.word_hashes(buf, start, end).tolist())) == 2
    rows = [(1, one), (2, two), (3, f"x {one} y z"), (4, f"x {two} y z")]
    got = near.near_components(spark.createDataFrame(rows, "doc_id long, text string"),
                               words=3, num=85, den=100).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i for i in (1, 2, 3, 4)}


def test_near_repeated_ids(spark):
    """Rows of one id are one document, linked if any of its texts is."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    c2 = " ".join(f"d{i}" for i in range(30))              # of the same size as c
    rows = [(1, a), (2, b), (5, a), (5, b), (7, c), (8, c), (8, c2), (9, c2), (10, None), (10, ""),
            (11, "x"), (11, "x"), (12, None), (12, a)]
    got = near.near_components(spark.createDataFrame(rows, "doc_id long, text string"),
                               words=3, num=85, den=100).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == {
        1: 1, 2: 1, 5: 1, 7: 7, 8: 7, 9: 7, 10: 10, 11: 11, 12: 1}
    assert sorted((r.doc_id, r.n_shingles) for r in got if r.doc_id in (10, 11, 12)) == [
        (10, 0), (10, 0), (11, 1), (11, 1), (12, 0), (12, 28)]
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


# --- 10

def brute_repeats(docs: dict, length: int = 100):
    seen, out = set(), {}
    for d in sorted(docs):
        b = docs[d].encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(s)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("piece", [20_000, 3])
def test_suffix(docs, piece):
    short = docs.filter("doc_id <> 10")
    got = {r.doc_id: tuple(r)[1:5] for r in suffix.remove_repeats(short, piece=piece).collect()}
    assert got == brute_repeats(texts(short))


def test_suffix_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 250")
    got = {r.doc_id: tuple(r)[1:5] for r in suffix.remove_repeats(table).collect()}
    assert got == brute_repeats(texts(table))


def test_suffix_sort_and_collisions(monkeypatch):
    rnd = np.random.default_rng(3)
    buf = rnd.integers(97, 99, 4000).astype(np.uint8)
    start = np.arange(3900)
    bucket = rnd.integers(0, 3, 3900)
    h = A.prefix_hashes(buf)
    order = suffix.suffix_sort(h, buf, start, bucket, 20)
    keys = [(bucket[i], buf[i:i + 20].tobytes()) for i in order]
    assert keys == sorted(keys)
    want = [(bucket[i], buf[i:i + 20].tobytes()) for i in range(3900)]
    run = suffix.equal_runs(h, buf, start, bucket, 20)
    assert len(set(run.tolist())) == len(set(want)) == len(set(zip(run.tolist(), want)))
    zero = np.zeros_like(h)                     # every hash collides
    run = suffix.equal_runs(zero, buf, start, bucket, 20)
    assert len(set(run.tolist())) == len(set(want)) == len(set(zip(run.tolist(), want)))


def test_suffix_odd_rows(odd, empty):
    got = suffix.remove_repeats(odd.filter("doc_id IS NULL OR doc_id <> 10")).collect()
    assert len(got) == odd.count() - 1
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)
    assert len({tuple(r) for r in got if r.doc_id == 9}) == 1
    assert suffix.remove_repeats(empty).collect() == []


def test_suffix_repeated_rows(spark, docs):
    """Repeated rows in one slice keep their text, whatever the batches."""
    rnd = random.Random(6)
    t = {d: "".join(rnd.choice("abcdefgh ") for _ in range(400)) for d in (3, 5, 8)}
    t |= {4: t[3], 9: t[8][:250] + t[5][:150]}
    rows = [(d, t[d]) for d in (3, 3, 3, 5, 4, 4, 8, 9, 9, 5)]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = suffix.remove_repeats(df).collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, *tuple(r)[1:5]) for r in got} == {(d, *x) for d, x in brute_repeats(t).items()}


# --- registered queries

def test_pipeline(spark, odd):
    import corpus_pipeline as P
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == len(set(ids)) > 100
    clean = odd.withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(1).cast("long"))
    docs = clean
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == P.COLUMNS, name
    assert math.isclose(P.STAGES[-1][1](spark, docs, SF).count(), docs.count())
    left = {r.doc_id for r in docs.collect()}
    assert 2 in left and 9 not in left and 11 not in left      # one of the near copies stays


def test_pipeline_stages(spark, docs):
    """The stages after quality, each on the rows of the one before, against brute force."""
    import sentencepiece
    import corpus_pipeline as P
    repeated = spark.createDataFrame([(30, "\n".join(["top", *["same"] * 6]), "en", 1, 2, 3, "s"),
                                      (31, "\n".join(["same"] * 4), "en", 1, 2, 3, "s")], SCHEMA)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    planted = spark.createDataFrame([(32, "x " + items[min(items)] + " y", "en", 1, 2, 3, "s")], SCHEMA)
    now = docs.union(repeated).union(planted).withColumns(
        {"source": F.lit("s"), "n_chars": F.lit(1).cast("long")}).select(*P.COLUMNS)
    stages = dict(P.STAGES)
    want = texts(now)
    lines_ = brute_lines(want)
    want = {d: lines_[d][2] for d in want if not lines_[d][1] or lines_[d][2].strip(" \t\r\n")}
    now = stages["line_dedup"](spark, now, SF)
    assert texts(now) == want and 31 not in want
    near_ = brute_near(want, 5, 4, 5)
    want = {d: t for d, t in want.items() if near_[d][1] == d}
    now = stages["near_duplicates"](spark, now, SF)
    assert texts(now) == want and len(want) < len(near_)
    found = {d for d, _ in brute_contamination(want, items)}
    want = {d: t for d, t in want.items() if d not in found}
    now = stages["decontamination"](spark, now, SF)
    assert texts(now) == want and 32 in found
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in stages["encoding"](spark, now, SF).collect()}
    ids = {d: sp.encode(t) for d, t in want.items()}
    assert got == {d: (len(i), sha(",".join(map(str, i)))) for d, i in ids.items()}
