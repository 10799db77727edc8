"""Operator 9: near-duplicate documents by a signature-coordinate join.

Every document becomes the set of its distinct k-word shingles.  Documents
with the same set form one class, and only the class's smallest id goes on.
A class's minimum-hash signature has ``coordinates`` values; it is posted
under each (coordinate, value) pair.  Two sets of similarity ``s`` agree in a
binomial(coordinates, s) number of pairs, so pairs that agree in fewer than
``matches`` (six standard deviations below the mean at the threshold: a miss
of about one linked pair in 1e8) cannot be links.

*Prefix and skip merging.*  A class's postings are ordered by rising list
length.  Classes that share ``matches`` lists share one of the first
``coordinates - matches + 1`` of either, so the longest lists are skipped; a
list with one member yields nothing, and ordinary documents have no other.

*Groups of copies.*  Each list has a leader (its most shared member), and a
member is first compared with the few leaders it meets in most lists, which is
linear; components then merge, and a second leader is tried between components.  Documents of different
components that still share a list are joined on the rarest items of their
full sets, with an exact bound on the overlap the rest leaves possible, so no
link between components is missed and no group is expanded into all its
pairs.  Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.llm import arrays as A
from kairo.llm.graph import connected_components
from kairo.session import materialize as _materialize
from kairo.session import release

# ids and hashes do not compress
materialize = partial(_materialize, compressed=False)



#: Leaders that a member is compared with in a round; what they leave apart is
#: settled by the exact join, so this bounds work, not results.
LEADERS = 6


def match_threshold(coordinates: int, num: int, den: int) -> int:
    s = num / den
    return max(1, int(coordinates * s - 6 * (coordinates * s * (1 - s)) ** 0.5))


def _sets(col: pa.Array, k: int):
    for i, j, buf, off in A.slices(col):
        buf = A.lower(buf)
        start, end, first = A.words(buf, off)
        h, sf = A.shingles(A.word_hashes(buf, start, end), first, k)
        values, vf = A.distinct_sorted(h, sf)
        yield i, j, values, vf


def _profile(k: int, coordinates: int):
    factors = A.seeds(coordinates, 9)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, values, first in _sets(A.string_column(batch, "text"), k):
                zero = A.U64(0)
                s1 = A.per_document(A.mix(values ^ A.U64(1)), first, np.add, zero)
                s2 = A.per_document(A.mix(values ^ A.U64(2)), first, np.add, zero)
                sig = np.empty((j - i, coordinates), np.uint64)
                for c in range(coordinates):
                    sig[:, c] = A.per_document(values * factors[c], first, np.minimum, zero)
                n = np.diff(first)
                sig_first = np.concatenate([[0], np.cumsum(np.where(n > 0, coordinates, 0))])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), pa.array(n, pa.int64()),
                    pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(sig_first, pa.int32()),
                                             pa.array(sig[n > 0].ravel().view(np.int64))),
                ], names=["doc_id", "n", "s1", "s2", "sig"])
    return run


def _blobs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, values, first in _sets(A.string_column(batch, "text"), k):
                off = pa.py_buffer((first * 8).astype(np.int32))
                data = pa.Array.from_buffers(pa.binary(), j - i,
                                             [None, off, pa.py_buffer(values)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), data], names=["id", "items"])
    return run


def _confirm(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            ok = np.zeros(len(left), bool)
            for r in range(len(left)):
                a = np.frombuffer(left[r].as_buffer(), np.uint64)
                b = np.frombuffer(right[r].as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok[r] = den * both >= num * (len(a) + len(b) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ok)], names=["a", "b", "linked"])
    return run


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            items = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(3)]
            m = [len(x) for x in items]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part.column(k).to_numpy(), m)) for k in range(3)]
                + [pa.array(np.concatenate(items))], names=["id", "n", "component", "item"])


def _prefix_pairs(docs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components that may link, exactly: with
    each set's items in rising frequency, linked sets share an item among the
    first ``n - ceil(n * num / den) + 1`` of both, and the places of their
    first shared item leave room for the overlap that a link needs.  Items of
    one set only are counted, not joined."""
    items = docs.join(sets, "id").select("id", "n", "component", "items") \
                .mapInArrow(_items, "id long, n long, component long, item long")
    often = items.groupBy("item").agg(F.count("*").alias("members")).filter("members > 1")
    ranked = (items.join(often, "item").groupBy("id", "n", "component")
              .agg(F.sort_array(F.collect_list(F.struct("members", "item"))).alias("l"))
              .withColumn("single", F.expr("n - size(l)"))
              .select("id", "n", "component", "single", F.posexplode(F.expr(
                  f"slice(l, 1, greatest(0, n - (n * {num} + {den} - 1) div {den} + 1 - single))"))
                  .alias("k", "p"))
              .select("id", "n", "component", F.expr("n - single - k").alias("room"),
                      F.col("p.item").alias("item")))
    other = ranked.select("item", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "component", "room")])
    return (ranked.join(other, "item")
            .filter("id < id2 AND component <> component2")
            .filter(f"least(room, room2) * {num + den} >= (n + n2) * {num}")
            .select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct())


def _own_ids(src: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``src`` with an id of its own for every row that repeats an id, above all given
    ones, and the written table ``(node, doc_id)`` of these; ``None`` if none repeats.
    Numbers are given in a written table, so they are the same in every retry."""
    often = src.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    often, n = materialize(often.select("doc_id"), "near-repeated")
    if not n:
        release(often)
        return src, None
    top = src.agg(F.max("doc_id")).first()[0]
    rows, _ = materialize(src.join(often, "doc_id", "left_semi").select(
        (F.lit(top) + 1 + F.monotonically_increasing_id()).alias("node"), "doc_id", "text"),
        "near-rows")
    others = src.join(often, "doc_id", "left_anti")
    return (others.unionByName(rows.select(F.col("node").alias("doc_id"), "text")),
            rows.select("node", "doc_id"))


def near_components(docs: DataFrame, id: str = "doc_id", text: str = "text", *,
                    words: int = 5, num: int = 4, den: int = 5,
                    coordinates: int = 40) -> DataFrame:
    """One row per document: ``(doc_id, n_shingles, component_id, kept)``.

    Documents link if ``den * |intersection| >= num * |union|`` on their sets
    of distinct ``words``-word shingles (A-Z lower-cased; a shorter text is
    one shingle).  A null, empty or blank text has no shingle and links with
    nothing.  Rows that repeat an id count as one document that links if any
    of its texts does, and each has its own text's ``n_shingles``.  A row without
    an id keeps a null component and is kept.  Other columns are ignored.
    """
    src = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    src, own = _own_ids(src)
    need = match_threshold(coordinates, num, den)
    prefix = coordinates - need + 1
    prof, _ = materialize(src.mapInArrow(
        _profile(words, coordinates),
        "doc_id long, n long, s1 long, s2 long, sig array<long>"), "near-profile")
    slim = prof.select("doc_id", "n", "s1", "s2")
    classes = (slim.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "s1", "s2")
               .agg(F.min("doc_id").alias("rep")))
    heads = prof.join(classes.select(F.col("rep").alias("doc_id"), "n", "s1", "s2"),
                      ["doc_id", "n", "s1", "s2"], "left_semi") \
                .select("doc_id", "n", "sig").dropDuplicates(["doc_id", "n"])

    # postings, in rising list length, without the lists that are skipped
    tokens = heads.select("doc_id", "n", F.posexplode("sig").alias("c", "v")) \
                  .select("doc_id", "n", F.xxhash64("c", "v").alias("token"))
    lists = tokens.groupBy("token").agg(F.count("*").alias("members")).filter("members > 1")
    posts, _ = materialize(
        tokens.join(lists, "token").groupBy("doc_id", "n")
        .agg(F.sort_array(F.collect_list(F.struct("members", "token"))).alias("l"),
             F.sum("members").alias("shared"))
        .select("doc_id", "n", "shared",
                F.explode(F.expr(f"slice(l, 1, greatest(0, {prefix} - {coordinates} + size(l)))"))
                 .alias("p"))
        .select(F.col("doc_id").alias("id"), "n", "shared", F.col("p.token").alias("token")),
        "near-postings")
    wanted = posts.select(F.col("id").alias("doc_id")).distinct()
    sets, _ = materialize(src.join(wanted, "doc_id", "left_semi")
                          .mapInArrow(_blobs(words), "id long, items binary"), "near-sets")
    sigs = prof.join(wanted, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "sig")

    def check(pairs: DataFrame, signatures: bool = True) -> DataFrame:
        one, two = (sigs.select(F.col("id").alias(x), F.col("sig").alias(f"s{x}")) for x in "ab")
        agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
        likely = pairs.join(one, "a").join(two, "b").filter(agree >= need).select("a", "b") \
            if signatures else pairs
        one, two = (sets.select(F.col("id").alias(x), F.col("items").alias(f"i{x}")) for x in "ab")
        found = likely.join(one, "a").join(two, "b").select("a", "b", "ia", "ib")
        return materialize(found.mapInArrow(_confirm(num, den), "a long, b long, linked boolean"),
                           "near-checked")[0]

    def with_components(labels: DataFrame | None) -> DataFrame:
        if labels is None:
            return posts.withColumn("component", F.col("id"))
        return posts.join(labels, "id", "left").withColumn(
            "component", F.coalesce("component", "id"))

    def fits(x: str, y: str) -> F.Column:
        return (F.least(x, y) * den >= F.greatest(x, y) * num)

    edges = labels = tried = None
    for order in (F.struct("shared", "id"), F.struct(F.xxhash64("id"), "id")):
        now = with_components(labels)
        heads_of = (now.groupBy("token")
                    .agg(F.max_by(F.struct("id", "n", "component"), order).alias("m"),
                         F.min("component").alias("lo"), F.max("component").alias("hi"))
                    .filter("lo < hi")
                    .select("token", F.col("m.id").alias("lead"), F.col("m.n").alias("lead_n"),
                            F.col("m.component").alias("lead_component")))
        pairs = (now.join(heads_of, "token")
                 .filter((F.col("component") != F.col("lead_component")) & fits("n", "lead_n"))
                 .groupBy("id", "lead").agg(F.count("*").alias("agree"))
                 .groupBy("id").agg(F.sort_array(F.collect_list(F.struct("agree", "lead")), False)
                                    .alias("l"))
                 .select("id", F.explode(F.slice("l", 1, LEADERS)).alias("m"))
                 .select("id", "m.lead")
                 .select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
                 .distinct())
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        done = check(pairs)
        tried = done.select("a", "b") if tried is None else tried.union(done.select("a", "b"))
        linked = done.filter("linked").select("a", "b")
        edges = linked if edges is None else edges.union(linked)
        labels = connected_components(edges)

    # what is left: documents of different components that still share a list
    now = with_components(labels)
    open_lists = (now.groupBy("token")
                  .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                  .filter("lo < hi").select("token"))
    rest, _ = materialize(now.join(open_lists, "token", "left_semi")
                          .select("id", "n", "component").distinct(), "near-open")
    pairs = _prefix_pairs(rest, sets, num, den).join(tried, ["a", "b"], "left_anti")
    edges = edges.union(check(pairs, signatures=False).filter("linked").select("a", "b"))
    if own is not None:
        # a repeated id joins its rows' classes; rows of no shingle join by themselves
        of_class = slim.filter("n > 0").join(classes, ["n", "s1", "s2"]).select(
            F.col("doc_id").alias("node"), "rep")
        edges = edges.union(own.join(of_class, "node", "left").select(
            F.col("doc_id").alias("a"), F.coalesce("rep", "node").alias("b")))
    labels = connected_components(edges)
    release(posts, sets, rest)

    out = slim.join(classes, ["n", "s1", "s2"], "left") \
              .join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
    if own is not None:
        found = labels.select(F.col("id").alias("given"), F.col("component").alias("whole"))
        of = own.select(F.col("node").alias("doc_id"), F.col("doc_id").alias("given")) \
                .join(found, "given")
        out = out.join(of, "doc_id", "left").withColumns({
            "doc_id": F.coalesce("given", "doc_id"), "component": F.coalesce("whole", "component")})
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
