"""Operator 11: vectors as codes of codebook entries (product quantisation).

Every component is scaled and floored to an integer; a vector is cut into equal
parts, and every part position has a codebook.  Training assigns each part to
the nearest entry (squared Euclidean distance, ties to the lower index) and
replaces an entry by the floored mean of its parts.

Method: memoised grid cells.  A part lies in a coarse cell, a box of side
``cell``.  An entry whose smallest distance to the box exceeds some other
entry's largest distance is dominated: it is nearest nowhere in the box.  The
entries that are left are kept under the hash of the cell for the whole task, and
parts are compared exactly with those only.  Integers throughout, so the result
does not depend on how rows are dealt out.

Plan: one Arrow map over the table per round; a task sends one row per entry that
it used (count and sums), which Spark adds up.  The driver holds the codebooks
only: ``parts * entries`` rows whatever the table's size.  Codes are written once,
summed by label and joined back by ``lookup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kairo.llm.joins import lookup
from kairo.session import materialize

#: Largest integer component: squared distances of 64 such still fit a long.
LARGEST = 1 << 27


def integer_vectors(col: pa.Array, scale: int, dim: int
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(kept, fits, ints)``: rows without null or non-finite components, those
    of them with ``dim`` components within ``LARGEST``, and the latter's integers."""
    n = len(col)
    size = np.asarray(col.value_lengths().fill_null(0)).astype(np.int64)
    flat = col.flatten()
    x = np.asarray(flat.fill_null(float("nan")), dtype=np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
    end = np.cumsum(size)
    kept = np.asarray(col.is_valid()) & (bad[end] == bad[end - size])
    fits = kept & (size == dim)
    rows = x[np.repeat(fits, size)].reshape(int(fits.sum()), dim)
    big = (np.abs(rows) * scale > LARGEST).any(axis=1)
    where = np.flatnonzero(fits)
    fits[where[big]] = False
    return kept, fits, np.floor(rows[~big] * scale).astype(np.int64).reshape(-1, dim)


class Cells:
    """Nearest entries of one codebook, by memoised grid cells."""

    PAIRS = 1 << 16

    def __init__(self, book: np.ndarray, cell: int, limit: int = 1 << 14):
        self.book, self.cell, self.limit = book, cell, limit
        self.book_t = book.T.astype(np.float64)
        self.norm = (self.book_t ** 2).sum(axis=0)
        self.memo: dict[bytes, np.ndarray] = {}

    def survivors(self, low: np.ndarray) -> list[np.ndarray]:
        """Ascending entries that no other dominates in the boxes from ``low``."""
        out = []
        step = max(1, self.PAIRS // len(self.book))
        half = (self.cell - 1) / 2
        reach = half * self.book.shape[1] ** 0.5
        for i in range(0, len(low), step):
            # by the boxes' middles first: an entry further from it than the nearest
            # one by more than the diagonal is dominated; the slack covers rounding
            mid = low[i:i + step] + half
            far = (mid ** 2).sum(axis=1)[:, None] + self.norm
            d = np.sqrt(np.maximum(far - 2 * mid @ self.book_t, 0))
            slack = 1e-6 * (1 + np.sqrt(far))
            box, entry = np.nonzero(d <= d.min(axis=1)[:, None] + 2 * reach + slack)
            a = low[i + box] - self.book[entry]
            b = a + (self.cell - 1)
            least = (np.maximum(np.maximum(a, -b), 0) ** 2).sum(axis=1)
            most = (np.maximum(np.abs(a), np.abs(b)) ** 2).sum(axis=1)
            start = np.searchsorted(box, np.arange(len(mid)))
            keep = least <= np.minimum.reduceat(most, start)[box]
            out += np.split(entry[keep], np.cumsum(np.bincount(box[keep], minlength=len(mid)))[:-1])
        return out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(entry, squared distance)`` of every row of ``x``."""
        n = len(x)
        if not n or not x.shape[1]:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        grid = np.ascontiguousarray(x // self.cell)
        keys = grid.view(f"V{grid.strides[0]}").ravel()
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        names = [grid[i].tobytes() for i in first.tolist()]
        if len(self.memo) > self.limit:
            self.memo.clear()
        new = [j for j, name in enumerate(names) if name not in self.memo]
        if new:
            found = self.survivors(grid[first[new]] * self.cell)
            self.memo.update(zip((names[j] for j in new), found))
        lists = [self.memo[name] for name in names]
        size = np.array([len(a) for a in lists], np.int64)
        flat, start = np.concatenate(lists), np.cumsum(size) - size
        code, error = np.empty(n, np.int64), np.empty(n, np.int64)
        per_row, at = size[which], 0
        total = np.concatenate([[0], np.cumsum(per_row)])
        while at < n:
            to = max(at + 1, int(np.searchsorted(total, total[at] + self.PAIRS, "right")) - 1)
            m = per_row[at:to]
            row = np.repeat(np.arange(at, to), m)
            entry = flat[np.arange(m.sum()) - np.repeat(total[at:to] - total[at] - start[which[at:to]], m)]
            d = ((x[row] - self.book[entry]) ** 2).sum(axis=1)
            best = np.minimum.reduceat(d, total[at:to] - total[at])
            hit = np.flatnonzero(d == np.repeat(best, m))
            _, lowest = np.unique(row[hit], return_index=True)
            code[at:to], error[at:to] = entry[hit[lowest]], best
            at = to
        return code, error


def _books(codebooks: np.ndarray, cell: int) -> list[Cells]:
    return [Cells(book, cell) for book in codebooks]


def _starts(df: DataFrame, dim: int, entries: int, scale: int) -> np.ndarray:
    """Integer vectors of the smallest kept ids, ascending; of a repeated id the
    smallest vector.  A task sends its own smallest ids only."""
    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for batch in batches:
            _, fits, x = integer_vectors(batch.column(1), scale, dim)
            ids = batch.column(0).filter(pa.array(fits)).to_pylist()
            for i, v in zip(ids, x.tolist()):
                if i is not None:
                    best[i] = min(best.get(i, v), v)
            if len(best) > 8 * entries:
                best = {i: best[i] for i in sorted(best)[:entries]}
        best = {i: best[i] for i in sorted(best)[:entries]}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(best), batch_type), pa.array(list(best.values()), pa.list_(pa.int64()))],
            names=["id", "v"])

    from pyspark.sql.pandas.types import to_arrow_type
    kind = df.schema["id"].dataType
    batch_type = to_arrow_type(kind)
    schema = T.StructType([T.StructField("id", kind), T.StructField("v", T.ArrayType(T.LongType()))])
    rows = (df.select("id", "v").mapInArrow(smallest, schema)
            .groupBy("id").agg(F.min("v").alias("v")).orderBy("id").limit(entries).collect())
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), dim)


def common_length(df: DataFrame) -> int | None:
    """The most frequent vector length, the smaller of equally frequent ones."""
    row = (df.filter("v IS NOT NULL").groupBy(F.size("v").alias("d")).count()
           .orderBy(F.desc("count"), "d").first())
    return None if row is None else row["d"]


def train_codebooks(df: DataFrame, *, parts: int = 4, entries: int = 256, rounds: int = 4,
                    scale: int = 1024, cell: int = 32, dim: int | None = None) -> np.ndarray:
    """Codebooks ``(parts, entries, dim / parts)`` of a table ``(id, v array<double>)``.

    Rows with a null vector or null or non-finite components take no part, nor do
    vectors of another length than ``dim`` (default: the most frequent one) or with
    components beyond ``LARGEST / scale``.  Rows without an id are assigned, but
    start no entry; of a repeated id the smallest vector does.  A table with fewer
    ids gives fewer entries, an empty one none."""
    dim = common_length(df) if dim is None else dim
    if dim is None:
        return np.zeros((parts, 0, 0), np.int64)
    if dim % parts:
        raise ValueError(f"{dim} components cannot be cut into {parts} equal parts")
    width = dim // parts
    start = _starts(df, dim, entries, scale)
    books = start.reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(start) and width else 0):
        def partial(batches, books=books):
            near = _books(books, cell)
            count = np.zeros(books.shape[:2], np.int64)
            total = np.zeros(books.shape, np.int64)
            for batch in batches:
                _, _, x = integer_vectors(batch.column(0), scale, dim)
                for p, part in enumerate(np.split(x, parts, axis=1)):
                    code, _ = near[p].nearest(part)
                    count[p] += np.bincount(code, minlength=count.shape[1])
                    np.add.at(total[p], code, part)
            part, entry = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry), pa.array(count[part, entry]),
                 pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "s"])

        sums = (df.select("v").mapInArrow(partial, "part long, entry long, n long, s array<long>")
                .groupBy("part", "entry")
                .agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}")
                                              for i in range(width)]).collect())
        books = books.copy()
        for r in sums:
            books[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return books


def encode_vectors(df: DataFrame, books: np.ndarray, *, scale: int = 1024,
                   cell: int = 32) -> DataFrame:
    """``id, label, code array<int>, error`` of a table ``(id, v, label)``; a kept
    row whose vector cannot be cut (another length, or beyond ``LARGEST``) has a
    null code and error.  Equal rows stay, each with its code."""
    parts, _, width = books.shape

    def encode(batches):
        near = _books(books, cell)
        for batch in batches:
            kept, fits, x = integer_vectors(batch.column(1), scale, parts * width)
            if not books.shape[1]:
                fits[:], x = False, x[:0]
            code = np.zeros((len(x), parts), np.int32)
            error = np.zeros(len(x), np.int64)
            for p, part in enumerate(np.split(x, parts, axis=1)):
                code[:, p], e = near[p].nearest(part)
                error += e
            at = np.where(fits, np.cumsum(fits) - 1, -1)[kept]
            take = pa.array(at, mask=at < 0)
            codes = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts), pa.array(code.ravel()))
            rows = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(rows), batch.column(2).filter(rows),
                 codes.take(take), pa.array(error).take(take)],
                names=["id", "label", "code", "error"])

    schema = T.StructType([df.schema["id"], df.schema["label"],
                           T.StructField("code", T.ArrayType(T.IntegerType())),
                           T.StructField("error", T.LongType())])
    return df.select("id", "v", "label").mapInArrow(encode, schema)


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(table: DataFrame, *, id: str = "vec_id", vector: str = "embedding",
                     label: str = "label", **params) -> DataFrame:
    """Train on all rows of ``table`` and encode them: ``vec_id, label, code,
    error, label_error, codebooks_sha256``.  ``label_error`` is the error summed
    over equal labels, null labels together (null if it passes a long); other
    columns of the table are left aside, whatever their names.  Dropped rows, odd
    lengths, repeated ids and empty tables: see ``train_codebooks`` and
    ``encode_vectors``."""
    df = table.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"),
                      F.col(label).alias("label"))
    books = train_codebooks(df, **params)
    encoded, _ = materialize(encode_vectors(df, books, **{k: params[k] for k in ("scale", "cell")
                                                          if k in params}), "vector-codes")
    totals = encoded.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"),
        F.count(F.lit(1)).alias("rows"))
    return lookup(encoded, totals, ["label"], "rows").select(
        F.col("id").alias(id), "label", "code", "error", "label_error",
        F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def code_hex(code: str = "code", parts: int = 4):
    """Two lowercase hex digits an entry, in part order."""
    return F.concat(*[F.lower(F.lpad(F.hex(F.col(code)[i]), 2, "0")) for i in range(parts)])


def _oracle(rounds: int = 4) -> str:
    """DuckDB SQL of ``op11_vector_codes``: the same training by plain comparison."""
    floor = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    sql = ["""WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
comp AS (
  SELECT vec_id, unnest(range(len(embedding))) AS i,
         CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x,
         len(embedding) // 4 AS w FROM kept),
x AS MATERIALIZED (SELECT vec_id, i // w AS part, i % w AS pos, x FROM comp),
b0 AS MATERIALIZED (
  SELECT part, e AS entry, pos, x AS b FROM x JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id)
  WHERE e < 256)"""]
    for k in range(rounds + 1):
        sql.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, part, min(d) AS d, CAST(arg_min(entry, (d, entry)) AS BIGINT) AS entry FROM (
    SELECT vec_id, part, entry, CAST(sum((x - b) * (x - b)) AS BIGINT) AS d
    FROM x JOIN b{k} USING (part, pos) GROUP BY ALL) GROUP BY ALL)""")
        if k < rounds:
            sql.append(f"""b{k + 1} AS MATERIALIZED (
  SELECT part, entry, pos, coalesce(m, b) AS b FROM b{k} LEFT JOIN (
    SELECT part, entry, pos, {floor} AS m FROM (
      SELECT part, entry, pos, sum(x) AS s, count(*) AS n
      FROM x JOIN a{k} USING (vec_id, part) GROUP BY ALL)) USING (part, entry, pos))""")
    return ",\n".join(sql) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(coalesce(string_agg(CAST(b AS VARCHAR), ',' ORDER BY part, entry, pos), ''))
   FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
         CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id) USING (vec_id)"""


ORACLE = _oracle()
