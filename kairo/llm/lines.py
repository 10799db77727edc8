"""Operator 2: removal of repeated multi-line chunks.

A text is cut into chunks of lines at content-defined places.  Rolling hashes over
line hashes give each line a role: lines of the *start* role open a chunk (judged
with the lines after them), lines of the *end* role close one (judged with the lines
before them).  A role depends on the passage's own lines, so insertions elsewhere do
not shift it, and a passage is cut alike wherever it stands.  ``chunkings``
independent role assignments are used, whose hashes roll over ``windows`` lines in
turn: a window of one judges a line by itself, so a short passage can be cut alike
whatever surrounds it; longer windows tell equal lines apart by their neighbours.

All lines of a run of equal lines have the same roles, so a run is cut into chunks of
fixed size, two lines from its start on (and its last two).

The cuts alone decide what is found.  A passage is missed if no chunking puts a
boundary before and after two or more of its lines and none between; README states the
share found of all repeated pairs of lines.

Chunks of two or more lines that occur more than once, by the hash of their
lines, are fetched from the texts and compared with the first occurrence
(smallest id, then place) byte by byte; all equal later ones that do not
overlap the first are removed.  Of a document's overlapping candidates only a
cover is compared.

Counting is pre-aggregated, a frequent chunk's owner is one row (so the join is
split by rows, not by chunk), and texts travel compressed.
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

SLICE = 1 << 18
U64 = np.uint64
#: Share of lines with either role, of 2**16.
ROLE = 23_000


def line_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, first_line)`` of all lines; an empty text has one."""
    cut = np.flatnonzero(buf == 10)
    start = np.sort(np.concatenate([off[:-1], cut + 1]), kind="stable")
    end = np.sort(np.concatenate([cut, off[1:]]), kind="stable")
    lines = np.searchsorted(cut, off[1:]) - np.searchsorted(cut, off[:-1]) + 1
    return start, end, np.concatenate([[0], np.cumsum(lines)])


def _rolling(h: np.ndarray, doc: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes over ``window`` line hashes from each line on, and up to each line."""
    ahead, back = h.copy(), h.copy()
    for k in range(1, min(window, len(h))):
        near = doc[k:] == doc[:-k]
        ahead[:-k] += np.where(near, h[k:], U64(0)) * A.seeds(k + 1, 20)[k]
        back[k:] += np.where(near, h[:-k], U64(0)) * A.seeds(k + 1, 21)[k]
    return ahead, back


def _runs(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Places of the two-line chunks that runs of equal lines are cut into."""
    same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    edge = np.diff(np.concatenate([[0], same.astype(np.int8), [0]]))
    start, size = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1) + 1
    pairs = size // 2
    step = np.arange(pairs.sum()) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    return np.concatenate([np.repeat(start, pairs) + 2 * step, (start + size - 2)[size % 2 == 1]])


def chunks(h: np.ndarray, first: np.ndarray, windows: tuple[int, ...], chunkings: int):
    """Distinct multi-line chunks ``(document, first line, lines, key)`` of all
    chunkings and of runs of equal lines; ``h`` holds line hashes."""
    n = len(h)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    rolled = [_rolling(h, doc, w) for w in windows]
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    begins = [_runs(h, doc)]
    sizes = [np.full(len(begins[0]), 2)]
    for k, salt in enumerate(A.seeds(chunkings, 22)):
        ahead, back = rolled[k % len(rolled)]
        opens = (A.mix(ahead ^ salt) & U64(0xFFFF)) < U64(ROLE)
        closes = (A.mix(back ^ salt) & U64(0xFFFF)) >= U64((1 << 16) - ROLE)
        cut = edge.copy()
        cut[:-1] |= opens
        cut[1:] |= closes
        at = np.flatnonzero(cut)
        size = np.diff(at)
        begins.append(at[:-1][size > 1])
        sizes.append(size[size > 1])
    pair = np.unique(np.concatenate(begins) * (n + 1) + np.concatenate(sizes))
    begin, size = pair // (n + 1), pair % (n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(h * A.powers(n + 1)[0][:n], out=total[1:])
    key = A.mix(A.range_hashes(total, begin, begin + size) + size.astype(U64))
    return doc[begin], begin - first[doc[begin]], size, key


def _chunk_rows(windows: tuple[int, ...], chunkings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, buf, off in A.slices(A.string_column(batch, "text"), SLICE):
                start, end, first = line_spans(buf, off)
                h = A.mix(A.range_hashes(A.prefix_hashes(buf), start, end)
                          + (end - start).astype(U64))
                doc, line, size, key = chunks(h, first, windows, chunkings)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(ids[i:j][doc]),
                     pa.array(line.astype(np.int32)), pa.array(size.astype(np.int32))],
                    names=["key", "doc_id", "line", "n"])
    return run


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, off = A.raw(A.string_column(batch, "text"))
        view, o = memoryview(data), off.tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0),
             pa.array([z.compress(view[a:b]) for a, b in zip(o, o[1:])], pa.binary())],
            names=["doc_id", "z"])


def _cover(line: np.ndarray, n: np.ndarray) -> list[int]:
    """Few of the intervals that cover what all of them cover."""
    order = np.lexsort((-n, line))
    out, reach, best = [], -1, None
    for k in order.tolist():
        a, b = int(line[k]), int(line[k] + n[k])
        if b <= reach:
            continue
        if best is not None and a > reach:
            out.append(best[1])
            reach, best = best[0], None
            if b <= reach:
                continue
        if a > reach:
            out.append(k)
            reach = b
        elif best is None or b > best[0]:
            best = b, k
    if best is not None and best[0] > reach:
        out.append(best[1])
    return out


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of owned chunks and of a cover of the others."""
    z = zstandard.ZstdDecompressor()
    names = ["key", "doc_id", "line", "n", "owned", "bytes"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    rows, held = [], 0
    for batch in batches:
        hits = batch.column(2)
        for r in range(batch.num_rows):
            lines = z.decompress(batch.column(1)[r].as_py()).split(b"\n")
            doc, own = batch.column(0)[r].as_py(), hits[r].values
            key, line, n, owned = (own.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            other = np.flatnonzero(~owned)
            picked = np.flatnonzero(owned).tolist()
            picked += other[_cover(line[other], n[other])].tolist()
            for k in picked:
                a, m = int(line[k]), int(n[k])
                if a + m <= len(lines):
                    text = b"\n".join(lines[a:a + m])
                    rows.append((int(key[k]), doc, a, m, bool(owned[k]), text))
                    held += len(text)
            if held > 1 << 22:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdDecompressor()
    names = ["doc_id", "n_lines", "n_removed", "kept_sha256", "kept"]
    for batch in batches:
        spans = batch.column(2)
        for i in range(0, batch.num_rows, 512):
            total, gone, sha, kept = [], [], [], []
            for r in range(i, min(i + 512, batch.num_rows)):
                text = z.decompress(batch.column(1)[r].as_py())
                n = text.count(b"\n") + 1
                removed = 0
                if spans[r].is_valid:
                    drop = np.zeros(n, bool)
                    for a, m in zip(*(spans[r].values.field(k).to_pylist() for k in (0, 1))):
                        drop[a:a + m] = True
                    removed = int(drop.sum())
                    text = b"\n".join(x for x, d in zip(text.split(b"\n"), drop.tolist()) if not d)
                total.append(n)
                gone.append(removed)
                sha.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, 512), pa.array(total, pa.int64()),
                 pa.array(gone, pa.int64()), pa.array(sha), pa.array(kept, pa.string())],
                names=names)


def remove_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", *,
                          windows: tuple[int, ...] = (1, 2, 3), chunkings: int = 32
                          ) -> DataFrame:
    """One row per document: ``(doc_id, n_lines, n_removed, kept_sha256, kept)``.

    A line goes if it stands in a chunk of two or more lines that occurs earlier
    (smaller id, or same document and earlier place) and does not overlap its
    first occurrence: of a run of equal lines, the first two or three stay.
    Lines end at line feeds.  Null text reads as empty, which is one empty
    line.  Rows that repeat an id with the same text count as one document and
    give equal rows; rows without an id are kept whole and matched with
    nothing.  Other columns are ignored.
    """
    src = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = src.filter("doc_id IS NOT NULL").mapInArrow(
        _chunk_rows(windows, chunkings), "key long, doc_id long, line int, n int")
    owners = (rows.groupBy("key").agg(F.min(F.struct("doc_id", "line")).alias("first"),
                                      F.count("*").alias("c"))
              .filter("c > 1").select("key", "first"))
    overlaps = ((F.col("doc_id") == F.col("first.doc_id")) & (F.col("line") > F.col("first.line"))
                & (F.col("line") < F.col("first.line") + F.col("n")))
    hits, _ = materialize(
        rows.join(owners, "key").filter(~overlaps)
        .select("doc_id", F.struct("key", "line", "n",
                                   (F.struct("doc_id", "line") == F.col("first")).alias("owned"))
                .alias("hit")), "lines-hits")
    packed = src.mapInArrow(_compress, "doc_id long, z binary")
    grouped = hits.groupBy("doc_id").agg(F.collect_set("hit").alias("hits"))
    fetched, _ = materialize(
        packed.join(grouped, "doc_id").select("doc_id", "z", "hits").dropDuplicates(["doc_id"])
        .mapInArrow(_fetch, "key long, doc_id long, line int, n int, owned boolean, bytes binary"),
        "lines-fetched")
    release(hits)
    owned = fetched.filter("owned").select("key", F.col("bytes").alias("owner_bytes"))
    equal = (fetched.filter("NOT owned").join(owned, "key")
             .filter(F.col("bytes") == F.col("owner_bytes"))
             .groupBy("doc_id").agg(F.collect_list(F.struct("line", "n")).alias("spans")))
    return (packed.join(equal, "doc_id", "left").select("doc_id", "z", "spans")
            .mapInArrow(_strip, "doc_id long, n_lines long, n_removed long, kept_sha256 string, "
                                "kept string"))
