"""Operator 6: quality selection by importance resampling.

Two generative models over hashed n-grams are estimated from document
frequencies: *target* on labelled documents of good quality that are not
toxic, *raw* on every document.  A document's log importance weight is the sum
of ``log target - log raw`` over its distinct n-grams; the documents kept are
drawn by Gumbel top-k: the ``k`` largest of ``weight / temperature + Gumbel
noise``.

N-grams: words, word beginnings (four and five bytes), and sequences of one, two and
eight token shapes (letter case, symbols, digits, repetition of the token
before).
Ratios are kept only where they are evidence: an n-gram counts if labelled
documents of one rejected class have it significantly (1e-7, by their share of
the sample) and ``contrast`` times as often as target documents; all other
ratios are zero, so ordinary documents weigh zero whatever their length.

The labelled sample is bounded (``max_labels`` rows by smallest id hash, copies
removed by three-word sketches) and so may be broadcast.  Everything else
covers all documents: the raw model adds up per-task counts, the model has a
fixed number of buckets, ``k`` is the number of documents whose weight reaches
the cut that best separates the sample, and the k-th largest key is found by
counting in narrowing histograms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.llm import arrays as A
from kairo.session import materialize, release

BUCKETS = 1 << 20
SLICE = 1 << 18
U64 = np.uint64

_WORD = np.zeros(256, bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _WORD[_lo:_hi] = True
GOOD, TOXIC, POOR = 1, 2, 3
#: Lengths of the sequences of token shapes.
SHAPES = (1, 2, 8)
#: Lengths in bytes of the beginnings of words.
BEGINNINGS = (4, 5)


def features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of all n-grams, with repetitions."""
    low = A.lower(buf)
    only = np.where(_WORD[buf], low, np.uint8(32))
    start, end, first = A.words(only, off)
    h = A.prefix_hashes(only)
    word = A.mix(A.range_hashes(h, start, end))
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    parts, docs = [word], [doc]
    for n in BEGINNINGS:
        long = end - start > n
        parts.append(A.mix(A.range_hashes(h, start[long], start[long] + n) + U64(n)))
        docs.append(doc[long])

    start, end, first = A.words(buf, off)
    token = A.range_hashes(A.prefix_hashes(low), start, end)
    tdoc = np.repeat(np.arange(len(off) - 1), np.diff(first))

    def count(kind: np.ndarray) -> np.ndarray:
        total = np.zeros(len(buf) + 1, np.int32)
        np.cumsum(kind, out=total[1:])
        return total[end] - total[start]

    upper = count((buf >= 65) & (buf <= 90))
    lower = count((buf >= 97) & (buf <= 122))
    symbol = count(~_WORD[buf] & (buf > 32))
    digit = count((buf >= 48) & (buf <= 57))
    again = np.zeros(len(token), bool)
    again[1:] = (token[1:] == token[:-1]) & (tdoc[1:] == tdoc[:-1])
    shape = ((np.minimum(upper, 2) * 3 + np.minimum(symbol, 2)) * 8
             + (lower > 0) * 4 + (digit > 0) * 2 + again).astype(U64)
    for n in SHAPES:
        m = max(0, len(shape) - n + 1)
        total = np.full(m, n, U64)
        for k in range(n):
            total = total * U64(0x9E3779B97F4A7C15) + shape[k:k + m]
        whole = tdoc[:m] == tdoc[n - 1:n - 1 + m]
        parts.append(A.mix(total[whole]))
        docs.append(tdoc[:m][whole])
    bucket = np.concatenate(parts) & U64(BUCKETS - 1)
    return bucket.astype(np.int64), np.concatenate(docs)


def _distinct(bucket: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique(doc * BUCKETS + bucket)
    return key % BUCKETS, key // BUCKETS


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors = A.seeds(3, 6)
    for batch in batches:
        for i, j, buf, off in A.slices(A.string_column(batch, "text"), SLICE):
            start, end, first = A.words(A.lower(buf), off)
            h, f = A.shingles(A.word_hashes(A.lower(buf), start, end), first, 3)
            least = [A.per_document(h * x, f, np.minimum, U64(0)).view(np.int64) for x in factors]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                 *map(pa.array, least)], names=["doc_id", "cls", "a", "b", "c"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Document frequencies of a whole task: all, and of each sample class."""
    total = np.zeros((4, BUCKETS), np.int32)
    for batch in batches:
        cls = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
        for i, j, buf, off in A.slices(A.string_column(batch, "text"), SLICE):
            bucket, doc = _distinct(*features(buf, off))
            total[0] += np.bincount(bucket, minlength=BUCKETS).astype(np.int32)
            which = cls[i:j][doc]
            for c in (GOOD, TOXIC, POOR):
                if (which == c).any():
                    np.add.at(total[c], bucket[which == c], 1)
    some = np.flatnonzero(total[0])
    for i in range(0, len(some), 1 << 16):
        s = some[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(s.astype(np.int32))] + [pa.array(total[c][s].astype(np.int64)) for c in range(4)],
            names=["bucket", "n", "good", "toxic", "poor"])


def _ratios(model: pd.DataFrame, docs: int, sizes: dict[int, int], contrast: float,
            rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, log target - log raw) of the n-grams that are evidence."""
    target = (model["good"].to_numpy() + 0.5) / (sizes[GOOD] + 1)
    raw = (model["n"].to_numpy() + 0.5) / (docs + 1)
    keep = np.zeros(len(model), bool)
    for c, name in ((TOXIC, "toxic"), (POOR, "poor")):
        if sizes[c]:
            df = model[name].to_numpy()
            share = sizes[c] / (sizes[c] + sizes[GOOD])
            least = max(rate * sizes[c], np.log(1e7) / -np.log(min(share, 0.99)))
            keep |= (df >= least) & (df / sizes[c] > contrast * target)
    ratio = np.minimum(np.log(target) - np.log(raw), 0.0)
    keep &= ratio < 0
    return model["bucket"].to_numpy()[keep].astype(np.int64), ratio[keep]


def _score(buckets: np.ndarray, ratio: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = np.zeros(BUCKETS)
        weight[buckets] = ratio
        for batch in batches:
            for i, j, buf, off in A.slices(A.string_column(batch, "text"), SLICE):
                bucket, doc = features(buf, off)
                hit = weight[bucket] != 0
                bucket, doc = _distinct(bucket[hit], doc[hit])
                total = np.bincount(doc, weights=weight[bucket], minlength=j - i).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i),
                     pa.array(total)], names=["doc_id", "crc", "log_weight"])
    return run


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 512, few: int = 10_000) -> float:
    """The exact k-th largest value by counting in narrowing histograms; only
    bin counts and at most ``few`` values (or one repeated value) are fetched."""
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    while True:
        inside = df.filter(F.col(column).between(lo, hi))
        if lo == hi:
            return lo
        step = (hi - lo) / bins
        bin_ = F.least(F.floor((F.col(column) - lo) / F.lit(step or 1.0)), F.lit(bins - 1))
        counts = {r[0]: r[1:] for r in inside.groupBy(bin_.alias("b")).agg(
            F.count("*"), F.min(column), F.max(column)).collect()}
        for b in sorted(counts, reverse=True):
            n, least, most = counts[b]
            if k <= n:
                break
            k -= n
        lo, hi = least, most
        if n <= few:
            rows = df.filter(F.col(column).between(lo, hi)).select(column).collect()
            return sorted((r[0] for r in rows), reverse=True)[k - 1]


def select_documents(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", *,
                     max_labels: int = 20_000, contrast: float = 50.0, rate: float = 0.015,
                     temperature: float = 0.01, seed: int = 6) -> DataFrame:
    """One row per document: ``(doc_id, text_crc32, log_weight, key, selected)``.

    ``labels`` has ``doc_id, quality, toxic``; rows with a null among them are
    ignored, and a repeated id uses its smallest class.  Null and empty texts
    have no n-gram and weigh zero.  Without labels of a target and a rejected
    class every weight is zero and every document is selected.  The noise
    depends on id and text, so repeated rows share their key, and rows tied at
    the cut are all selected.  Rows without an id are scored like others.
    Other columns are ignored.
    """
    src = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    cls = F.when(F.col("quality") == 0, POOR).when(F.col("toxic") == 1, TOXIC).otherwise(GOOD)
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
              .dropna().groupBy("doc_id").agg(F.min(cls).alias("cls"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    sketched = src.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "cls") \
                  .mapInArrow(_sketch, "doc_id long, cls int, a long, b long, c long")
    for c in "abc":
        one = sketched.groupBy("cls", c).agg(F.min_by(F.struct("doc_id", "a", "b", "c"),
                                                      "doc_id").alias("m"))
        sketched = one.select(F.col("m.doc_id").alias("doc_id"), "cls",
                              *[F.col(f"m.{x}").alias(x) for x in "abc"])
    chosen, _ = materialize(sketched.select("doc_id", "cls"), "quality-sample")
    sizes = {c: 0 for c in (GOOD, TOXIC, POOR)}
    sizes |= {r[0]: r[1] for r in chosen.groupBy("cls").count().collect()}

    # both models in one pass; the result has at most BUCKETS rows
    marked = src.join(F.broadcast(chosen), "doc_id", "left").select("doc_id", "text", "cls")
    if sizes[GOOD] and sizes[TOXIC] + sizes[POOR]:
        counts = marked.mapInArrow(_count, "bucket int, n long, good long, toxic long, poor long")
        model = counts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in
                                               ("n", "good", "toxic", "poor")])
        small = model.filter("toxic + poor > 0").toPandas()      # at most BUCKETS rows
        buckets, ratio = _ratios(small, src.count(), sizes, contrast, rate)
    else:
        buckets, ratio = np.zeros(0, np.int64), np.zeros(0)

    noise = -F.log(-F.log((F.pmod(F.xxhash64(F.lit(seed), "doc_id", "crc"), F.lit(1 << 52)) + 0.5)
                          / float(1 << 52)))
    scored, n = materialize(
        src.select("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("crc"), "text")
           .mapInArrow(_score(buckets, ratio), "doc_id long, crc long, log_weight double")
           .withColumn("key", F.col("log_weight") / temperature + noise), "quality-scored")
    known = scored.join(F.broadcast(chosen), "doc_id").select("log_weight", "cls").toPandas()
    cut = _cut(known["log_weight"].to_numpy(), known["cls"].to_numpy())
    k = scored.filter(F.col("log_weight") >= cut).count()
    least = kth_largest(scored, "key", k) if 0 < k < n else float("-inf")
    release(chosen)
    return scored.select("doc_id", F.col("crc").alias("text_crc32"), "log_weight", "key",
                         (F.col("key") >= F.lit(least)).alias("selected"))


def _cut(weight: np.ndarray, cls: np.ndarray) -> float:
    """The weight that best separates the sample: the share of target
    documents at or above it less the mean such share of the rejected classes.
    The cut lies halfway to the next lower weight."""
    target = weight[cls == GOOD]
    rejected = [weight[cls == c] for c in (TOXIC, POOR) if (cls == c).any()]
    if not len(target) or not rejected:
        return float("-inf")
    values = np.unique(weight)
    if len(values) > 2048:
        values = np.quantile(weight, np.linspace(0, 1, 2048))
    gain = [(target >= v).mean() - np.mean([(r >= v).mean() for r in rejected]) for v in values]
    best = values[int(np.argmax(gain))]
    lower = weight[weight < best]
    return float((best + lower.max()) / 2) if len(lower) else float(best)
