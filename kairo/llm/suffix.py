"""Operator 10: removal of repeated byte strings by suffix sorting.

A byte goes if a ``length``-byte string over it also starts earlier (smaller
id, or same document and earlier start), judged on the input.

1. *Buckets.*  Every ``length``-byte window picks an anchor: the 32-byte gram
   of smallest hash in it (leftmost on a tie).  The choice depends on the
   window's bytes alone, so equal windows pick equal grams at equal offsets
   and meet in the gram's bucket.  One row per anchor (3 % of the bytes) is
   shuffled: gram hash, hash of the anchor's whole context (all its windows),
   id and place.
2. *Whole contexts.*  A bucket is read in sorted order as a stream of constant
   memory.  A context that was seen before is removed as a whole; a bucket
   with several contexts sends each one's first member to the suffix sort.
3. *Suffix sort.*  Those members fetch their context's bytes.  Per bucket,
   prefix polynomial hashes give the common extension of two suffixes by
   binary search, which orders them in a mergesort (vectorised over buckets);
   neighbours whose common extension reaches ``length`` are compared byte by
   byte.  All but the earliest of equal windows are removed.  Buckets larger
   than a task's bound are sorted in pieces; the pieces' windows then meet in
   an aggregation keyed by the window's bytes.

Texts travel compressed.  Per document the removed spans are merged and
applied to its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.llm import arrays as A
from kairo.session import materialize, release

GRAM = 32
#: Contexts that one task sorts at once.
PIECE = 20_000
SLICE = 1 << 17
U64 = np.uint64


# --- places: (first window, windows, anchor offset) of an anchor in one long

def _pack(lo, windows, anchor, known=0):
    return (lo << 17) | (known << 16) | (windows << 8) | anchor


def _unpack(at: np.ndarray):
    return at >> 17, (at >> 8) & 255, at & 255, (at >> 16) & 1


# --- 1. anchors

def _sliding_min(key: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        key = np.minimum(key[:-k], key[k:])
        k *= 2
    r = width - k
    return np.minimum(key[:len(key) - r], key[r:]) if r else key


def find_anchors(buf: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Anchors of all windows inside documents: ``(gram hash, context hash,
    document, first window, windows, anchor offset)``."""
    n = len(buf)
    if n < length:
        none = np.zeros(0, np.int64)
        return none.astype(U64), none.astype(U64), none, none, none, none
    h = A.prefix_hashes(buf)
    g = h[gram:] - h[:-gram]
    g *= A.powers(n + 1)[1][:n - gram + 1]
    g = A.mix(g)
    key = g & U64(0xFFFFFFFF00000000)
    key |= np.arange(len(key), dtype=U64)
    at = (_sliding_min(key, length - gram + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    size = np.diff(off)
    counts = np.maximum(size - length + 1, 0)                 # windows per document
    cut = np.zeros(len(at) + 1, np.int8)                      # +1 at the first window, -1 after
    has = counts > 0
    np.add.at(cut, off[:-1][has], 1)
    np.add.at(cut, off[:-1][has] + counts[has], -1)
    inside = np.cumsum(cut[:-1]).astype(bool)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    new[off[:-1][has]] = True
    new[1:] |= inside[1:] & ~inside[:-1]
    first = np.flatnonzero(new & inside)
    stop = np.ones(len(at) + 1, bool)
    stop[:-1] = new | ~inside
    ends = np.flatnonzero(stop)
    last = ends[np.searchsorted(ends, first, "right")]        # one after the run
    windows, anchor = last - first, at[first] - first
    shape = (windows * 256 + anchor).astype(U64)
    context = A.mix(A.range_hashes(h, first, last - 1 + length) ^ A.mix(shape))
    doc = np.searchsorted(off, first, "right") - 1
    return g[at[first]], context, doc, first - off[doc], windows, anchor


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, buf, off in A.slices(A.string_column(batch, "text"), SLICE):
                g, c, doc, lo, windows, anchor = find_anchors(buf, off, length, gram)
                if not len(g):
                    continue
                who = ids[i:j][doc]
                # a context met before at another place of this slice needs no bucket; it gets a
                # key of its own (a repeated row has the same places, which match nothing)
                order = np.lexsort((lo, who, c, g))
                gs, cs, ws, ls = (x[order] for x in (g, c, who, lo))
                new = np.concatenate([[True], (gs[1:] != gs[:-1]) | (cs[1:] != cs[:-1])])
                head = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
                same = np.zeros(len(g), np.int64)
                same[order] = (ws != ws[head]) | (ls != ls[head])
                own = A.mix(who.astype(U64) * U64(0x9E3779B97F4A7C15) + lo.astype(U64))
                g = np.where(same == 1, own, g)
                yield pa.RecordBatch.from_arrays([
                    pa.array(g.view(np.int64)), pa.array(c.view(np.int64)), pa.array(who),
                    pa.array(_pack(lo, windows, anchor, same))],
                    names=["key", "context", "doc_id", "at"])
    return run


# --- 2. whole contexts

def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, context, doc_id, at) to marks (null key) and to
    members for the suffix sort (with the key)."""
    def out(key, doc, at):
        return pa.RecordBatch.from_arrays([key, pa.array(doc), pa.array(at)],
                                          names=["key", "doc_id", "at"])

    def marks(doc, at):
        return out(pa.nulls(len(doc), pa.int64()), doc, at)

    last = None                     # last row so far
    waiting = None                  # first member of the only context of the open bucket
    for batch in batches:
        key, ctx, doc, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        known = ((at >> 16) & 1) == 1
        if known.any():
            yield marks(doc[known], at[known])
            key, ctx, doc, at = key[~known], ctx[~known], doc[~known], at[~known]
        if not len(key):
            continue
        before = (np.concatenate([[x[0] if last is None else last[k]], x[:-1]])
                  for k, x in enumerate((key, ctx, doc, at)))
        pk, pc, pd, pa_ = before
        new_key, new_ctx = key != pk, (key != pk) | (ctx != pc)
        again = ~new_ctx & (doc == pd) & (at == pa_)
        if last is None:
            new_key[0] = new_ctx[0] = True
            again[0] = False
        gone = ~new_ctx & ~again
        if gone.any():
            yield marks(doc[gone], at[gone])
        first = np.flatnonzero(new_ctx)
        if len(first):
            if waiting is not None and not new_key[first[0]]:
                k, d, a = waiting
                yield out(pa.array([k]), np.array([d]), np.array([a]))
                waiting = None
            several = ~new_key[first]
            several[:-1] |= ~new_key[first[1:]]
            pick = first[several]
            if len(pick):
                yield out(pa.array(key[pick]), doc[pick], at[pick])
            f = first[-1]
            waiting = None if several[-1] else (key[f], doc[f], at[f])
        last = key[-1], ctx[-1], doc[-1], at[-1]


# --- 3. suffix sort

def common_extension(h: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, up to
    ``limit``, by binary search on prefix hashes."""
    inverse = A.powers(len(h) + 1)[1]
    ha, hb, ia, ib = h[a], h[b], inverse[a], inverse[b]
    lo, hi = np.zeros(len(a), np.int64), np.full(len(a), limit, np.int64)
    for _ in range(limit.bit_length()):
        mid = (lo + hi + 1) >> 1
        equal = (h[a + mid] - ha) * ia == (h[b + mid] - hb) * ib
        lo = np.where(equal, mid, lo)
        hi = np.where(equal, hi, mid - 1)
        hi = np.maximum(hi, lo)
    return lo


def compare(h, buf, a, b, limit: int) -> np.ndarray:
    """-1, 0 or 1 as the suffix at ``a`` sorts before, with or after ``b``."""
    n = common_extension(h, a, b, limit)
    x, y = buf[a + np.minimum(n, limit - 1)], buf[b + np.minimum(n, limit - 1)]
    return np.where(n == limit, 0, np.where(x < y, -1, 1))


def suffix_sort(h: np.ndarray, buf: np.ndarray, start: np.ndarray, bucket: np.ndarray,
                limit: int) -> np.ndarray:
    """Order of the suffixes by (bucket, first ``limit`` bytes): bottom-up
    mergesort inside all buckets at once.  Each element finds its place in the
    neighbouring run by binary search with ``compare``."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    n = len(order)
    edge = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if n else np.zeros(0, int)
    size = np.diff(np.append(edge, n))
    base, total = np.repeat(edge, size), np.repeat(size, size)
    rank = np.arange(n) - base
    run = 1
    while n and run < size.max():
        mine = rank // run
        other = mine ^ 1
        lo = np.minimum(other * run, total)
        hi = np.minimum(lo + run, total)
        left = mine < other
        begin, x = lo.copy(), start[order]
        act = np.flatnonzero(lo < hi)
        while len(act):
            mid = (lo[act] + hi[act]) >> 1
            c = compare(h, buf, start[order[base[act] + mid]], x[act], limit)
            right = (c < 0) | ((c == 0) & ~left[act])      # equal ones of the left run come first
            lo[act] = np.where(right, mid + 1, lo[act])
            hi[act] = np.where(right, hi[act], mid)
            act = act[lo[act] < hi[act]]
        place = base + (mine // 2) * 2 * run + (rank - mine * run) + (lo - begin)
        merged = np.empty_like(order)
        merged[place] = order
        order, run = merged, run * 2
    return order


def equal_runs(h, buf, start, bucket, limit: int) -> np.ndarray:
    """A number for each suffix, equal for suffixes of one bucket with equal
    first ``limit`` bytes.  Neighbours in sorted order that the hashes call
    equal are compared byte by byte; if any pair fails (a hash collision), the
    suffixes are numbered by their bytes instead."""
    order = suffix_sort(h, buf, start, bucket, limit)
    a, b = start[order[:-1]], start[order[1:]]
    same = (bucket[order[:-1]] == bucket[order[1:]]) & (common_extension(h, a, b, limit) == limit)
    rows = np.arange(limit)
    for i in range(0, len(a), 1 << 14):
        pick = np.flatnonzero(same[i:i + (1 << 14)]) + i
        if not np.array_equal(buf[a[pick][:, None] + rows], buf[b[pick][:, None] + rows]):
            texts = buf[start[:, None] + rows]
            whole = np.concatenate([bucket.astype(">i8")[:, None].view(np.uint8), texts], axis=1)
            return np.unique(whole, axis=0, return_inverse=True)[1].ravel()
    out = np.empty(len(start), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(~same)])
    return out


def _repeats(key, doc, lo, windows, anchor, buf, off, length: int, gram: int):
    """Of whole buckets of contexts: ``(context, window, removed, run)`` of
    every window that can repeat."""
    h = A.prefix_hashes(buf)
    # a window repeats only if the core shared by its group of eight does
    first_o, last_o = anchor - windows + 1, anchor            # offsets of the anchor in its windows
    g0, g1 = first_o >> 3, last_o >> 3
    m = g1 - g0 + 1
    ctx = np.repeat(np.arange(len(key)), m)
    part = np.arange(len(ctx)) - np.repeat(np.cumsum(m) - m, m) + g0[ctx]
    place = off[ctx] + anchor[ctx]                            # the anchor
    core = A.range_hashes(h, place - part * 8, place - part * 8 - 7 + length)
    tag = A.mix(core ^ A.mix(key[ctx].astype(U64) + part.astype(U64)))
    # cores at a context's edge may reach outside it: those windows always go on
    inside = (part * 8 >= first_o[ctx]) & (part * 8 + 7 <= last_o[ctx])
    known, counts = np.unique(tag[inside], return_counts=True)
    single = np.zeros(len(ctx), bool)
    single[inside] = counts[np.searchsorted(known, tag[inside])] == 1
    lone = single & ~_met_by_edge(key, part, ctx, inside)
    ctx, part = ctx[~lone], part[~lone]
    o0, o1 = np.maximum(part * 8, first_o[ctx]), np.minimum(part * 8 + 7, last_o[ctx])
    m = o1 - o0 + 1
    row = np.repeat(np.arange(len(ctx)), m)
    o = np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m) + o0[row]
    ctx = ctx[row]
    window = anchor[ctx] - o
    bucket = np.unique(key, return_inverse=True)[1][ctx] * 256 + o
    run = equal_runs(h, buf, off[ctx] + window, bucket, length)
    order = np.lexsort((lo[ctx] + window, doc[ctx], run))
    r, d, p = run[order], doc[ctx][order], (lo[ctx] + window)[order]
    new = np.concatenate([[True], r[1:] != r[:-1]])[:len(r)]
    head = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    removed = np.zeros(len(r), bool)
    removed[order] = (d != d[head]) | (p != p[head])
    return ctx, window, removed, new_mask(new, order)


def new_mask(new: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.zeros(len(order), bool)
    out[order] = new
    return out


def _met_by_edge(key, part, ctx, inside) -> np.ndarray:
    """Whether another context of the bucket has this group only in part, so
    that its core was not compared."""
    tag = key[ctx].astype(U64) * U64(256) + part.astype(U64)
    return np.isin(tag, tag[~inside])


def _sort_buckets(length: int, gram: int, limit: int):
    def spans(doc, lo, ctx, window):
        """Marked windows as (doc, start, length) of runs of windows."""
        order = np.lexsort((window, ctx))
        c, w = ctx[order], window[order]
        new = np.ones(len(c), bool)
        new[1:] = (c[1:] != c[:-1]) | (w[1:] != w[:-1] + 1)
        f = np.flatnonzero(new)
        n = np.diff(np.append(f, len(c)))
        return doc[c[f]], lo[c[f]] + w[f], n - 1 + length

    def piece(rows: list, split: bool) -> Iterator[pa.RecordBatch]:
        key, doc, at = (np.concatenate([r[k] for r in rows]) for k in range(3))
        parts = [r[3] for r in rows]
        size = np.concatenate([p[1] for p in parts])
        buf = np.concatenate([p[0] for p in parts])
        off = np.cumsum(size) - size
        buf = np.concatenate([buf, np.zeros(length + 8, np.uint8)])
        lo, windows, anchor, _ = _unpack(at)
        ctx, window, removed, head = _repeats(key, doc, lo, windows, anchor, buf, off, length, gram)
        d, s, n = spans(doc, lo, ctx[removed], window[removed])
        yield pa.RecordBatch.from_arrays(
            [pa.array(d), pa.array(s), pa.array(n), pa.nulls(len(d), pa.binary())],
            names=["doc_id", "start", "n", "w"])
        if split:                       # the bucket goes on elsewhere: its windows meet by bytes
            every = np.repeat(np.arange(len(key)), windows)
            win = np.arange(len(every)) - np.repeat(np.cumsum(windows) - windows, windows)
            done = np.isin(every * 256 + win, (ctx * 256 + window)[removed])
            every, win = every[~done], win[~done]
            for i in range(0, len(every), 1 << 14):
                e, w = every[i:i + (1 << 14)], win[i:i + (1 << 14)]
                data = buf[(off[e] + w)[:, None] + np.arange(length)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[e]), pa.array(lo[e] + w), pa.array(np.full(len(e), length)),
                     pa.array([x.tobytes() for x in data], pa.binary())],
                    names=["doc_id", "start", "n", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, open_key, split = [], 0, None, False
        for batch in batches:
            key, doc, at = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            col = batch.column(3)
            data, off = A.raw(col.cast(pa.large_binary()).view(pa.large_string()))
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else []
            for f, e in zip(cuts, [*cuts[1:], len(key)]):
                for i in range(f, e, limit):
                    j = min(e, i + limit)
                    same = key[i] == open_key
                    if rows and held + j - i > limit:
                        if same and len(rows) and rows[0][0][0] != open_key:
                            # keep the open bucket whole if it fits without the earlier ones
                            cut = next(k for k, r in enumerate(rows) if r[0][0] == open_key)
                            yield from piece(rows[:cut], False)
                            rows = rows[cut:]
                            held = sum(len(r[0]) for r in rows)
                        if held + j - i > limit:
                            yield from piece(rows, split or same)
                            rows, held, split = [], 0, same
                    elif not same and split:
                        yield from piece(rows, True)
                        rows, held, split = [], 0, False
                    rows.append((key[i:j], doc[i:j], at[i:j],
                                 (data[off[i]:off[j]], np.diff(off[i:j + 1]))))
                    held += j - i
                    open_key = key[i]
        if rows:
            yield from piece(rows, split)
    return run


# --- texts

def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, off = A.raw(A.string_column(batch, "text"))
        view, o = memoryview(data), off.tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0),
             pa.array([z.compress(view[a:b]) for a, b in zip(o, o[1:])], pa.binary())],
            names=["doc_id", "z"])


def _fetch(length: int):
    """Documents with their members to context bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            members = batch.column(2)
            keys, ids, ats, parts, size = [], [], [], [], 0
            for r in range(batch.num_rows):
                text = z.decompress(batch.column(1)[r].as_py())
                doc = batch.column(0)[r].as_py()
                pair = members[r].values
                key, at = (pair.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                lo, windows, _, _ = _unpack(at)
                good = lo + windows - 1 + length <= len(text)
                for k, a, s, n in zip(key[good].tolist(), at[good].tolist(), lo[good].tolist(),
                                      windows[good].tolist()):
                    keys.append(k)
                    ids.append(doc)
                    ats.append(a)
                    parts.append(text[s:s + n - 1 + length])
                size += int(good.sum())
                if size > 20_000:
                    yield _rows(keys, ids, ats, parts)
                    keys, ids, ats, parts, size = [], [], [], [], 0
            yield _rows(keys, ids, ats, parts)

    def _rows(keys, ids, ats, parts):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(ids, pa.int64()), pa.array(ats, pa.int64()),
             pa.array(parts, pa.binary())], names=["key", "doc_id", "at", "bytes"])
    return run


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdDecompressor()
    for batch in batches:
        spans = batch.column(2)
        total, removed, runs, sha, kept = [], [], [], [], []
        for r in range(batch.num_rows):
            text = z.decompress(batch.column(1)[r].as_py())
            total.append(len(text))
            gone = 0
            n = 0
            if spans[r].is_valid:
                pair = spans[r].values
                s, m = (pair.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                order = np.argsort(s, kind="stable")
                s = s[order]
                e = np.maximum.accumulate(np.minimum(s + m[order], len(text)))
                new = np.ones(len(s), bool)
                new[1:] = s[1:] > e[:-1]
                f = np.flatnonzero(new)
                begin, end = s[f].tolist(), e[np.append(f[1:], len(s)) - 1].tolist()
                n = len(f)
                gone = sum(end) - sum(begin)
                text = b"".join(text[a:b] for a, b in zip([0, *end], [*begin, len(text)]))
            removed.append(gone)
            runs.append(n)
            sha.append(hashlib.sha256(text).hexdigest())
            kept.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(runs, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", *,
                   length: int = 100, gram: int = GRAM, piece: int = PIECE) -> DataFrame:
    """One row per document: ``(doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, kept)``; ``kept`` holds the remaining UTF-8 bytes (a cut may
    split a character).

    Null text reads as empty.  Matches never cross documents.  Rows that
    repeat an id with the same text are the same document: they match nothing
    in each other and give equal rows.  Rows without an id come first in no
    order: they are kept whole.  Other columns are ignored.
    """
    src = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = src.filter("doc_id IS NOT NULL AND octet_length(text) >= %d" % length)
    anchors = keyed.mapInArrow(_anchors(length, gram),
                               "key long, context long, doc_id long, at long")
    found, _ = materialize(
        anchors.repartition("key").sortWithinPartitions("key", "context", "doc_id", "at")
               .mapInArrow(_contexts, "key long, doc_id long, at long"), "suffix-found")
    packed = src.mapInArrow(_compress, "doc_id long, z binary")

    members = (found.filter("key IS NOT NULL").groupBy("doc_id")
               .agg(F.collect_list(F.struct("key", "at")).alias("members")))
    fetched = (packed.join(members, "doc_id").select("doc_id", "z", "members")
               .dropDuplicates(["doc_id"])
               .mapInArrow(_fetch(length), "key long, doc_id long, at long, bytes binary"))
    sorted_, _ = materialize(
        fetched.repartition("key").sortWithinPartitions("key")
               .mapInArrow(_sort_buckets(length, gram, piece),
                           "doc_id long, start long, n long, w binary"), "suffix-sorted")
    windows = sorted_.filter("w IS NOT NULL")
    earliest = windows.groupBy("w").agg(F.min(F.struct("doc_id", "start")).alias("first"),
                                        F.count("*").alias("c")).filter("c > 1")
    across = (windows.join(earliest, "w")
              .filter(F.struct("doc_id", "start") != F.col("first"))
              .select("doc_id", "start", "n"))
    whole = found.filter("key IS NULL").select(
        "doc_id", F.expr("shiftright(at, 17)").alias("start"),
        F.expr(f"(shiftright(at, 8) & 255) + {length - 1}").alias("n"))
    spans = (whole.union(sorted_.filter("w IS NULL").select("doc_id", "start", "n")).union(across)
             .groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    return (packed.join(spans, "doc_id", "left").select("doc_id", "z", "spans")
            .mapInArrow(_apply, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                "kept_sha256 string, kept binary"))
