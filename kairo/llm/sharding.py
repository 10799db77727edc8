"""Operator 1: minimax contiguous partition of documents into shards.

Equal texts form an atomic group; groups stand in the order of their smallest
id.  The smallest capacity for which a greedy fill needs at most ``shards``
shards is found by binary search (many capacities per round), and the groups
are cut there.  The largest shard is then as small as any contiguous cut
allows.

The order is a range partition whose parts are balanced by rows, so a group
that holds a third of all rows is spread over parts.  Prefix sums are taken
per part and shifted by the totals of the earlier parts.  A greedy step looks
up the group in which each candidate's next shard ends: one filtered pass over
the written prefix table, of which only the narrow band between the smallest
and the largest candidate is read.  Only DataFrame functions are used; the
driver sees one number per candidate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kairo.llm.joins import lookup
from kairo.session import materialize, release

#: Capacities tried in one round of the search.
CANDIDATES = 128


def _ordered(rows: DataFrame, order: list[str], sums: dict[str, Column], name: str) -> DataFrame:
    """``rows`` in global ``order`` with, per entry of ``sums``, the total of
    all rows before each row."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed, _ = materialize(rows.repartitionByRange(parts, *order)
                            .withColumn("part", F.spark_partition_id()), name)
    totals = placed.groupBy("part").agg(*[F.sum(c).alias(f"t_{k}") for k, c in sums.items()])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", *[
        F.coalesce(F.sum(f"t_{k}").over(before), F.lit(0)).alias(f"o_{k}") for k in sums])
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row per part, and the number of parts is a setting: a bounded broadcast
    return placed.withColumns({k: F.coalesce(F.sum(c).over(inside), F.lit(0)) for k, c in sums.items()}) \
                 .join(F.broadcast(offsets), "part") \
                 .withColumns({k: F.col(k) + F.col(f"o_{k}") for k in sums}) \
                 .drop("part", *[f"o_{k}" for k in sums])


def _ends(groups: DataFrame, limits: list[int]) -> list[int]:
    """For each limit: the end of the last group that ends at or before it.
    Limits lie between the first group's end and the total."""
    wanted = sorted(set(limits))
    hit = (groups.filter((F.col("start") <= wanted[-1]) & (F.col("end") >= wanted[0]))
           .select("start", "end", F.explode(F.filter(
               F.lit(wanted), lambda t: (t >= F.col("start")) & (t < F.col("end")))).alias("t"))
           .select("t", "start").collect())          # at most one row per limit
    found = {r.t: r.start for r in hit}
    return [found.get(t, t) for t in limits]         # no row: a group ends past all, at the total


def minimax_cuts(groups: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """(smallest capacity, ends of the first ``shards - 1`` shards) of the
    contiguous groups ``(start, end)``, whose sizes are positive."""
    lo = max(largest, -(-total // shards))           # no smaller capacity can do
    hi = lo + largest                                # always enough

    def fill(capacities: list[int]) -> list[list[int]]:
        at, cuts = [0] * len(capacities), [[] for _ in capacities]
        for _ in range(shards):
            goal = [min(a + c, total) for a, c in zip(at, capacities)]
            open_ = [g for g in goal if g < total]
            ends = dict(zip(open_, _ends(groups, open_))) if open_ else {}
            at = [ends.get(g, total) for g in goal]
            for c, a in zip(cuts, at):
                c.append(a)
        return cuts

    best = None
    while lo < hi or best is None:
        step = max(1, -(-(hi - lo) // CANDIDATES))
        tries = sorted({*range(lo, hi, step), hi})
        cuts = fill(tries)
        k = next(i for i, c in enumerate(cuts) if c[-1] == total)
        best, hi = cuts[k], tries[k]
        lo = tries[k - 1] + 1 if k else hi
    return hi, best[:-1]


def shard_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", *,
                    shards: int = 8) -> DataFrame:
    """One row per document: ``(doc_id, size, text_crc32, law, shard, slot,
    grown_shard)``.

    The size is the text's UTF-8 bytes plus one.  Null text counts as empty,
    and both are one group.  ``slot`` numbers a shard's rows from 0 in group
    order, then by id; repeated rows take slots of their own.  Rows without an
    id come first.  ``law`` is ``bytes`` and ``grown_shard`` null.  An empty
    table gives no rows; fewer groups than shards leave shards empty.  Other
    columns are ignored.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows, n = materialize(docs.select(
        F.col(id).cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"), F.sha2(body, 256).alias("sha")), "shard-rows")
    if n == 0:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                           F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           F.lit(None).cast("int").alias("grown_shard"))
    first = rows.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    placed, _ = materialize(_ordered(
        lookup(rows, first, ["sha"], "copies"), ["first", "sha", "doc_id", "text_crc32"],
        {"start": F.col("size"), "row": F.lit(1)}, "shard-order"), "shard-prefix")
    groups, _ = materialize(placed.groupBy("first", "sha").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"),
        F.min("row").alias("row")).select("start", "end", "row").orderBy("start"), "shard-groups")
    total, largest = groups.agg(F.max("end"), F.max(F.col("end") - F.col("start"))).first()
    _, cuts = minimax_cuts(groups, total, largest, shards)
    begins = [0, *cuts]
    row_at = {r.start: r.row for r in groups.filter(F.col("start").isin(begins)).collect()}
    base = F.array(*[F.lit(row_at.get(b, n)).cast("long") for b in begins])
    shard = sum((F.when(F.col("start") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    out = placed.withColumn("shard", shard.cast("int")) \
                .withColumn("slot", F.col("row") - F.element_at(base, F.col("shard") + 1))
    release(rows, groups)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The same law in SQL: every sum of neighbouring groups is a candidate
#: capacity, filled greedily by as-of lookups; CRC-32 by its byte table.
ORACLE = """
WITH tab AS (SELECT list(list_reduce(list_prepend(i, range(8)),
                  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                  ORDER BY i) AS t FROM range(256) r(i)),
h AS (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS x FROM documents),
d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) + 1 AS size,
             coalesce(text, '') AS body,
             CAST(xor(list_reduce(list_prepend(4294967295::BIGINT,
                 list_transform(range(0, len(x) // 2),
                                lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
                 lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS BIGINT)
               AS text_crc32 FROM h, tab),
g AS (SELECT body, min(doc_id) AS first, sum(size) AS bytes FROM d GROUP BY body),
p AS (SELECT body, first, CAST(sum(bytes) OVER (ORDER BY first) - bytes AS BIGINT) AS start_at,
             CAST(sum(bytes) OVER (ORDER BY first) AS BIGINT) AS end_at FROM g),
t AS (SELECT max(end_at) AS total, max(end_at - start_at) AS largest FROM p),
c0 AS (SELECT DISTINCT e.end_at - s.start_at AS cap FROM p s, p e, t
       WHERE e.end_at > s.start_at AND e.end_at - s.start_at >= greatest(largest, total / 8.0)
         AND e.end_at - s.start_at <= ceil(total / 8.0) + largest),
""" + "".join(f"""
c{i} AS (SELECT c.*, p.end_at AS e{i} FROM (SELECT *, {f'e{i - 1}' if i > 1 else '0'} + cap AS goal{i}
         FROM c{i - 1}) c ASOF JOIN p ON c.goal{i} >= p.end_at),""" for i in range(1, 9)) + """
best AS (SELECT c8.* FROM c8, t WHERE e8 = total ORDER BY cap LIMIT 1),
s AS (SELECT d.doc_id, d.size, d.text_crc32, p.first,
             CAST((p.start_at >= e1)::INT + (p.start_at >= e2)::INT + (p.start_at >= e3)::INT
                + (p.start_at >= e4)::INT + (p.start_at >= e5)::INT + (p.start_at >= e6)::INT
                + (p.start_at >= e7)::INT AS INTEGER) AS shard
      FROM d JOIN p USING (body), best)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY first, doc_id) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard FROM s
"""
