"""Operator 7: benchmark decontamination by SimHash windows.

Benchmark items and document windows of an item's length in words are
fingerprinted from their five-word shingles (128 bits).  A window is a candidate
for an item if their fingerprints differ in at most ``radius`` bits.  Such pairs
are found by multi-index blocks: of eight 16-bit blocks, one must differ in at most
``radius // 8`` bits, so each item is listed under every block value that near, a
window looks up its eight values, and no pair within the radius is missed.
Candidates are verified by the exact weighted similarity of their shingles (sum of the
smaller counts over sum of the larger), at least ``similarity``.

A window of the wanted similarity can have bits beyond the radius.  At similarity 0.8
about 20 of 128 bits differ, 31 are three standard deviations more; README states
the share missed.  An item of fewer than five words is one shingle, sought in windows
of its own word count; such a window's fingerprint is the item's own.

Only windows that hold a shingle of some item are fingerprinted; any other has
similarity zero.  The benchmark is dealt out in blocks of at most ``bound`` bytes of
items, one in most cases; each is matched against all documents.  The driver holds one
block at a time; with several, each block's matches are written before the next.
"""

from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.llm import arrays as A
from kairo.llm.simhash import fingerprints
from kairo.session import materialize

BLOCKS = 8
SLICE = 1 << 18
U64 = np.uint64


def _near_values(bits: int) -> np.ndarray:
    """All 16-bit masks with at most ``bits`` bits set."""
    out = [0]
    for n in range(1, bits + 1):
        out += [sum(1 << i for i in c) for c in itertools.combinations(range(16), n)]
    return np.array(out, np.int64)


def _blocks(f: np.ndarray) -> np.ndarray:
    """Fingerprints (n x 16 bytes) as n x 8 block values."""
    return f[:, 0::2].astype(np.int64) * 256 + f[:, 1::2]


class Matcher:
    """Tables of one block of benchmark items ``(id, text)``."""

    def __init__(self, items: list[tuple[int, str]], words: int, radius: int, similarity: float):
        self.words, self.similarity, self.radius = words, similarity, radius
        texts = pa.array([t for _, t in items], pa.large_string())
        self.ids = [i for i, _ in items]
        data, off = A.raw(texts)
        buf = A.lower(data[off[0]:off[-1]])
        start, end, first = A.words(buf, off - off[0])
        self.length = np.diff(first)
        w = A.word_hashes(buf, start, end)
        h, sf = A.shingles(w, first, words)
        # an item shorter than a shingle: word count -> hash of its words -> items
        self.short = defaultdict(lambda: defaultdict(list))
        for k in np.flatnonzero((self.length > 0) & (self.length < words)).tolist():
            self.short[int(self.length[k])][int(h[sf[k]])].append(k)
        self.prints = fingerprints(h, sf)
        self.terms = [Counter(h[a:b].tolist()) for a, b in zip(sf[:-1], sf[1:])]
        self.items_of = defaultdict(set)
        for k, terms in enumerate(self.terms):
            if self.length[k] >= words:
                for t in terms:
                    self.items_of[t].add(k)
        self.all_terms = np.array(sorted(self.items_of), U64)
        masks = _near_values(radius // BLOCKS)
        values = _blocks(self.prints)
        self.table = []
        for b in range(BLOCKS):
            near = (values[:, b][:, None] ^ masks).ravel()
            owner = np.repeat(np.arange(len(items)), len(masks))
            order = np.argsort(near, kind="stable")
            self.table.append((near[order], owner[order]))

    def seeds(self, h: np.ndarray) -> np.ndarray:
        """Places of shingles that some item has."""
        if not len(self.all_terms) or not len(h):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.all_terms, h), len(self.all_terms) - 1)
        return np.flatnonzero(self.all_terms[at] == h)

    def match(self, h: np.ndarray, n_words: int) -> list[tuple[int, int, int, float]]:
        """Best window per item of one document, given its shingle hashes:
        ``(item, first word, words, similarity)``."""
        seeds = self.seeds(h)
        starts = defaultdict(set)                     # window length in shingles -> first shingles
        for s in seeds.tolist():
            for k in self.items_of[int(h[s])]:
                m = max(1, int(self.length[k]) - self.words + 1)
                m = min(m, len(h))
                starts[m].update(range(max(0, s - m + 1), min(s, len(h) - m) + 1))
        best: dict[int, tuple[float, int, int]] = {}
        for m, places in starts.items():
            place = np.array(sorted(places))
            for i in range(0, len(place), 4096):
                p = place[i:i + 4096]
                rows = h[p[:, None] + np.arange(m)]
                f = fingerprints(rows.ravel(), np.arange(len(p) + 1) * m)
                for w, k in sorted(self._candidates(f)):
                    if max(1, int(self.length[k]) - self.words + 1) != m and m != len(h):
                        continue
                    s = self._similarity(rows[w], k)
                    if s >= self.similarity and s > best.get(k, (0.0,))[0]:
                        best[k] = s, int(p[w]), m
        return [(k, p, min(n_words, m + self.words - 1), s) for k, (s, p, m) in sorted(best.items())]

    def short_items(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """First place of every short item in every document, given the word
        hashes: ``(document, item, first word, words)``."""
        for n, items in self.short.items():
            long = np.diff(first) >= n
            g, gf = A.shingles(h, first, n)
            known = np.array(sorted(items), U64)
            at = np.flatnonzero(np.isin(g, known))
            doc = np.searchsorted(gf, at, "right") - 1
            at, doc = at[long[doc]], doc[long[doc]]
            value = g[at]
            order = np.lexsort((at, value, doc))
            at, doc, value = at[order], doc[order], value[order]
            new = np.ones(len(at), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
            at, doc, value = at[new], doc[new], value[new]
            for w, k in self._candidates(fingerprints(value, np.arange(len(value) + 1))):
                if k in items.get(int(value[w]), ()):
                    yield int(doc[w]), k, int(at[w] - gf[doc[w]]), n

    def _candidates(self, f: np.ndarray) -> list[tuple[int, int]]:
        values, pairs = _blocks(f), []
        for b, (near, owner) in enumerate(self.table):
            lo = np.searchsorted(near, values[:, b], "left")
            hi = np.searchsorted(near, values[:, b], "right")
            n = hi - lo
            w = np.repeat(np.arange(len(f)), n)
            k = owner[np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + lo[w]]
            pairs.append(w * len(self.ids) + k)
        pair = np.unique(np.concatenate(pairs))
        w, k = pair // len(self.ids), pair % len(self.ids)
        near = np.bitwise_count(f[w] ^ self.prints[k]).sum(axis=1) <= self.radius
        return list(zip(w[near].tolist(), k[near].tolist()))

    def _similarity(self, window: np.ndarray, k: int) -> float:
        a, b = Counter(window.tolist()), self.terms[k]
        both = sum((a & b).values())
        return both / (sum(a.values()) + sum(b.values()) - both)


def _find(items: list[tuple[int, str]], words: int, radius: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, words, radius, similarity)
        for batch in batches:
            ids = batch.column(0)
            out = []
            for i, j, buf, off in A.slices(A.string_column(batch, "text"), SLICE):
                buf = A.lower(buf)
                start, end, first = A.words(buf, off)
                w = A.word_hashes(buf, start, end)
                h, sf = A.shingles(w, first, words)
                for d, k, p, m in matcher.short_items(w, first):
                    out.append((ids[i + d].as_py(), matcher.ids[k], p, m, 1.0))
                doc = np.searchsorted(sf, matcher.seeds(h), "right") - 1
                for d in np.unique(doc).tolist():
                    for k, p, m, s in matcher.match(h[sf[d]:sf[d + 1]], int(first[d + 1] - first[d])):
                        out.append((ids[i + d].as_py(), matcher.ids[k], p, m, s))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
                 pa.array(cols[4], pa.float64())],
                names=["doc_id", "item_id", "first_word", "n_words", "similarity"])
    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id",
                       text: str = "text", item_id: str = "item_id", item_text: str = "text", *,
                       words: int = 5, similarity: float = 0.8, radius: int = 31,
                       bound: int = 4 << 20) -> DataFrame:
    """``(doc_id, item_id, first_word, n_words, similarity)``: for each
    document and item the most similar window (the first on a tie).

    Windows whose fingerprints differ from the item's in more than ``radius`` bits
    are not compared.  Words are runs other than space and tab to carriage return,
    A-Z lower-cased.  A text of fewer than five words is one shingle; an item of
    fewer matches wherever its words stand, with similarity 1.  Null and empty texts and items match nothing;
    repeated rows match alike; a null id stays null.  Other columns are
    ignored.
    """
    if radius >= 4 * BLOCKS:
        raise ValueError("radius must be below 32")
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"),
                             F.col(item_text).alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    src = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, first_word long, n_words long, similarity double"
    blocks = max(1, -(-int(size) // bound))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    out = None
    for b in range(blocks):
        rows = [(r.item_id, r.text) for r in items.filter(part == b).orderBy("item_id", "text").collect()]
        found = src.mapInArrow(_find(rows, words, radius, similarity), schema)
        if blocks > 1:
            found, _ = materialize(found, "benchmark-block")
        out = found if out is None else out.union(found)
    return out
