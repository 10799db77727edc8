"""Operator 4: SimHash fingerprints of documents.

Terms are the document's five-word shingles, weighted by their number of
occurrences.  Each term's 128-bit hash votes with its weight, +1 or -1 per
bit; a fingerprint bit is set where the votes are positive.  The likeness of
two fingerprints is the share of equal bits.

``near_fingerprints`` finds all fingerprints within a Hamming radius by
permuted block tables: with ``radius + extra`` blocks, two fingerprints within
the radius agree in some ``extra`` blocks, so joining on every choice of
``extra`` blocks finds them all.

``successors`` gives each document its neighbour in id order: rows go to
contiguous id ranges, a range also gets the next range's first row, and a
task walks its sorted range.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairo.llm import arrays as A

BITS = 128
_SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1)


def fingerprints(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fingerprints (documents x 16 bytes) from term hashes; repeated terms
    vote once per occurrence.  No term: all bits zero.  A tied vote: bit 0."""
    n = len(first) - 1
    out = np.zeros((n, BITS // 8), np.uint8)
    if not len(h):
        return out
    doc = np.repeat(np.arange(n), np.diff(first)) * 256
    for half, salt in enumerate((3, 4)):
        word = A.mix(h ^ A.seeds(1, salt)[0])
        for byte in range(8):
            value = ((word >> A.U64(8 * byte)) & A.U64(255)).astype(np.int64)
            votes = np.bincount(doc + value, minlength=n * 256).reshape(n, 256)
            out[:, half * 8 + byte] = np.packbits(votes.astype(np.float32) @ _SIGNS > 0, axis=1)[:, 0]
    return out


def fingerprint_texts(texts: pa.Array, words: int = 5) -> np.ndarray:
    """Fingerprints of a string array, in pieces of bounded size."""
    parts = [np.zeros((0, BITS // 8), np.uint8)]
    for _, _, buf, off in A.slices(texts, 1 << 18):
        start, end, first = A.words(buf, off)
        parts.append(fingerprints(*A.shingles(A.word_hashes(buf, start, end), first, words)))
    return np.concatenate(parts)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits, 0 to 1."""
    return 1.0 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def hexes(f: np.ndarray) -> list[str]:
    return [x.tobytes().hex() for x in f]


def fingerprint_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", *,
                          words: int = 5) -> DataFrame:
    """``(doc_id, fingerprint)``, 32 hex digits.  Null and empty text: zeros."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = fingerprint_texts(A.string_column(batch, "text"), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hexes(f), pa.string())],
                                             names=["doc_id", "fingerprint"])
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")) \
               .mapInArrow(run, "doc_id long, fingerprint string")


# --- search within a Hamming radius

def near_fingerprints(queries: DataFrame, against: DataFrame, radius: int, *,
                      extra: int = 1, column: str = "fingerprint") -> DataFrame:
    """All pairs of *different* fingerprints ``(query, fingerprint, distance)``
    with at most ``radius`` unequal bits (each pair once per query).

    Works on distinct fingerprints, so copies never multiply; join the result
    back to documents by fingerprint for their ids.  ``extra`` blocks must
    agree per table: more blocks make tables more selective but more numerous.
    A null fingerprint matches nothing.
    """
    blocks = radius + extra
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    if blocks > BITS:
        raise ValueError("radius is too large for block tables")
    bits = [F.concat(*[F.lpad(F.conv(F.substring(column, 8 * i + 1, 8), 16, 2), 32, "0")
                       for i in range(BITS // 32)])]
    keys = F.array(*[
        F.xxhash64(F.lit(t), *[F.substring(F.col("bits"), cuts[b] + 1, cuts[b + 1] - cuts[b])
                               for b in choice])
        for t, choice in enumerate(itertools.combinations(range(blocks), extra))])

    def tables(df: DataFrame, name: str) -> DataFrame:
        return (df.select(column).filter(F.col(column).isNotNull()).distinct()
                .withColumn("bits", bits[0])
                .select(F.col(column).alias(name), F.explode(keys).alias("key")))

    def word(c: str, i: int) -> Column:
        return F.conv(F.substring(c, 8 * i + 1, 8), 16, 10).cast("long")

    distance = sum((F.bit_count(word("query", i).bitwiseXOR(word("fingerprint", i)))
                    for i in range(1, BITS // 32)),
                   F.bit_count(word("query", 0).bitwiseXOR(word("fingerprint", 0))))
    return (tables(queries, "query").join(tables(against, "fingerprint"), "key")
            .filter("query <> fingerprint").withColumn("distance", distance.cast("int"))
            .filter(F.col("distance") <= radius)
            .select("query", "fingerprint", "distance").distinct())


# --- neighbours in id order

def _ranges(src: DataFrame) -> tuple[list, list]:
    """Upper id bounds of the ranges, and each range's smallest id.  Both have
    one entry per shuffle partition."""
    n = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    bounds = src.agg(F.percentile_approx("doc_id", steps, 10_000)).first()[0] or []
    bounds = sorted(set(bounds))
    least = dict(src.filter("doc_id IS NOT NULL").groupBy(_range_of(bounds).alias("r"))
                 .agg(F.min("doc_id")).collect())
    return bounds, [least.get(r) for r in range(len(bounds) + 1)]


def _range_of(bounds: list) -> Column:
    """Number of bounds below the id, looked up in two levels of about the
    square root of their number; null ids are in range 0."""
    if not bounds:
        return F.lit(0)
    size = max(1, math.isqrt(len(bounds)))
    groups = [[int(b) for b in bounds[k:k + size]] for k in range(0, len(bounds), size)]

    def below(array: Column) -> Column:
        return F.aggregate(array, F.lit(0), lambda n, b: n + (b < F.col("doc_id")).cast("int"))

    group = below(F.lit([g[-1] for g in groups[:-1]])) if len(groups) > 1 else F.lit(0)
    inner = F.element_at(F.array(*[F.lit(g) for g in groups]), group + 1)
    return F.coalesce(group * size + below(inner), F.lit(0))


def _one_each(df: DataFrame, number: str, n: int) -> DataFrame:
    """Rows dealt out by a column of numbers 0..n-1, a partition to each number.
    Dealing by the number itself would put several into one partition and none into
    another, as ``repartition`` takes its hash; so each number goes by a value whose
    hash is its own partition's."""
    spark = df.sparkSession
    found = dict(spark.range(64 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p"))
                 .agg(F.min("id")).collect())
    keys = F.lit([int(found.get(p, p)) for p in range(n)]).cast("array<long>")
    return df.repartition(n, F.element_at(keys, F.col(number) + 1))


def _edited(text: str, other: str) -> str:
    k = len(text) // 4
    return text[:len(text) - k] + other[:k] if k else text


def _walk(words: int):
    def rows(ids, texts, others):
        edited = [_edited(t, o) for t, o in zip(texts, others)]
        own, new, after = (fingerprint_texts(pa.array(x, pa.large_string()), words)
                           for x in (texts, edited, others))
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(list(map(len, texts)), pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array(hexes(own)), pa.array(hexes(new)),
            pa.array(likeness(own, new)), pa.array(likeness(own, after))],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                   "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (range, guest, id, text): a row is done when its
        successor is seen; guests are successors only."""
        ids, texts, others, size = [], [], [], 0
        last = None
        for batch in batches:
            col = A.string_column(batch, "text")
            for i in range(0, batch.num_rows, 256):
                part = zip(batch.column(0).slice(i, 256).to_pylist(),
                           batch.column(1).slice(i, 256).to_pylist(),
                           batch.column(2).slice(i, 256).to_pylist(),
                           col.slice(i, 256).to_pylist())
                for r, guest, doc, text in part:
                    if last is not None and last[0] == r:
                        ids.append(last[1])
                        texts.append(last[2])
                        others.append(text)
                        size += len(last[2]) + len(text)
                        if size > 1 << 19:
                            yield rows(ids, texts, others)
                            ids, texts, others, size = [], [], [], 0
                    last = None if guest else (r, doc, text)
        if ids:
            yield rows(ids, texts, others)
    return run


def fingerprint_edits(docs: DataFrame, id: str = "doc_id", text: str = "text", *,
                      words: int = 5) -> DataFrame:
    """Every text's fingerprint against those of its edited text and of the
    next document: ``(doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next)``.

    The edited text has its last ``n_chars // 4`` code points replaced by the
    first as many (or all) of the next document in ascending id order; the
    last document is followed by the first.  Null text reads as empty.  Rows
    that repeat an id are ordered by text; rows without an id come first,
    likewise.  A lone row follows itself.  Other columns are ignored.
    """
    src = docs.select(F.col(id).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))
    bounds, least = _ranges(src)
    heads = [x for x in least if x is not None]
    home = src.withColumn("r", _range_of(bounds)).withColumn("guest", F.lit(False))
    spark = src.sparkSession
    nulls = not src.filter("doc_id IS NULL").isEmpty()
    if nulls:                                   # the first row has no id: it is everybody's first
        heads = [None] + [x for r, x in enumerate(least) if x is not None and r]
    if not heads:
        return spark.createDataFrame([], _SCHEMA)
    # a range's first row is also the guest that ends the range before it
    where = {h: (0 if h is None else bisect_left(bounds, h)) for h in heads}
    before = {h: where[heads[k - 1]] for k, h in enumerate(heads)}
    some = [h for h in heads if h is not None]
    if some:
        pairs = F.create_map(*[F.lit(x) for h in some for x in (int(h), before[h])])
        guests = src.filter(F.col("doc_id").isin([int(h) for h in some])) \
                    .withColumn("r", pairs[F.col("doc_id")])
    else:
        guests = src.limit(0).withColumn("r", F.lit(0))
    if nulls:
        guests = guests.union(src.filter("doc_id IS NULL").withColumn("r", F.lit(before[None])))
    both = home.select("r", "guest", "doc_id", "text").union(
        guests.select("r", F.lit(True), "doc_id", "text"))
    return (_one_each(both, "r", len(bounds) + 1).sortWithinPartitions("r", "guest", "doc_id", "text")
            .mapInArrow(_walk(words), _SCHEMA))


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")
