"""Operator 13: phrases of two to four words whose words belong together.

Method: a HAT-trie counts phrases in every task.  Its root branches by the first
word's id; below hang containers, hash tables of the packed ids that follow.  A
container that grows too large bursts into a node that branches by the next word.
When the trie holds too many entries, whole subtrees are spilled as runs: per
language and prefix partition (by a hash of the first three words) one compressed row
of sorted phrases and their counts.  Spark brings a partition's runs together, and
they are merged there: equal phrases meet and their counts are added.

A phrase that occurs ``least`` times has only parts that do, so most phrases need
not enter the trie.  Words and pairs, then runs of three words, are first counted by
their 64-bit hashes alone; hashes that reach ``least`` mark ``PROBES`` places each of
a bit table, of at most ``2**MAX_BITS`` bits whatever the corpus, which all tasks get.
It never misses a frequent phrase, and a false hit costs an entry that the exact count
drops.

Memory: at most ``ENTRIES`` entries, ``WORDS`` words or ``HASHES`` hashes a task, and
where runs are merged a partition's distinct phrases, of which there are as many
partitions as the session's shuffles have.
Only the merged counts of frequent phrases are joined, by ``lookup``, which a
frequent word cannot bring down; the driver sees the bit tables only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairo.llm import arrays as A
from kairo.llm.joins import lookup
from kairo.session import materialize, release

BURST = 4096
ENTRIES = 400_000
HASHES = 1 << 21
WORDS = (1 << 21) - 2
MAX_BITS = 27
PROBES = 4
SLICE = 1 << 20
_SHIFT = 21

# What separates pieces, and words within a piece.
_CUT = np.zeros(256, bool)
_CUT[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _CUT.copy()
_GAP[[ord(" "), ord("\t")]] = True

RUNS = "part int, lang string, phrases binary, counts binary"
COUNTS = "lang string, words int, phrase string, n long"


def _bare(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, piece)`` of every word; words of one piece share its number."""
    n = len(buf)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    text = ~_GAP[buf]
    start, end = text.copy(), text.copy()
    start[1:] &= ~text[:-1] | edge[1:n]
    end[:-1] &= ~text[1:] | edge[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    cuts = np.cumsum(_CUT[buf] | edge[:n]) if n else np.zeros(0, np.int64)
    # an edge counts at the first byte of a text, a cut before the next word
    return start, end, cuts[start]


class HatTrie:
    """Counts of word-id sequences.  ``roots`` maps a first word to a container
    ``{packed rest: count}`` or, once burst, to a node ``[{next word: ...}]``."""

    def __init__(self, burst: int = BURST):
        self.roots: dict[int, dict | list] = {}
        self.sizes: dict[int, int] = {}
        self.entries, self.burst = 0, burst

    def add(self, root: int, keys: list[int], counts: list[int]) -> None:
        """Add counts of the packed rests ``keys`` below ``root``."""
        at = self.roots.get(root)
        if at is None:
            at = self.roots[root] = {}
        grown = self._into(at, keys, counts)
        if isinstance(at, dict) and len(at) > self.burst:
            self.roots[root] = self._split(at)
        self.sizes[root] = self.sizes.get(root, 0) + grown
        self.entries += grown

    def _into(self, at: dict | list, keys: list[int], counts: list[int]) -> int:
        if isinstance(at, dict):
            before = len(at)
            for k, c in zip(keys, counts):
                at[k] = at.get(k, 0) + c
            return len(at) - before
        children, grown, mask = at[0], 0, (1 << _SHIFT) - 1
        for k, c in zip(keys, counts):
            child = children.setdefault(k & mask, {})
            if isinstance(child, dict):
                rest = k >> _SHIFT
                grown += rest not in child
                child[rest] = child.get(rest, 0) + c
                if len(child) > self.burst and k & mask:
                    children[k & mask] = self._split(child)
            else:
                grown += self._into(child, [k >> _SHIFT], [c])
        return grown

    def _split(self, container: dict) -> list:
        children: dict[int, dict] = {}
        mask = (1 << _SHIFT) - 1
        for k, c in container.items():
            children.setdefault(k & mask, {})[k >> _SHIFT] = c
        return [children]

    def take(self, root: int) -> tuple[list[int], list[int]]:
        """Remove a whole subtree; its packed rests and counts."""
        at = self.roots.pop(root)
        self.entries -= self.sizes.pop(root)
        keys, counts, stack = [], [], [(at, 0, 0)]
        while stack:
            at, high, shift = stack.pop()
            if isinstance(at, dict):
                keys += [high | k << shift for k in at]
                counts += at.values()
            else:
                stack += [(child, high | w << shift, shift + _SHIFT) for w, child in at[0].items()]
        return keys, counts

    def largest(self, keep: int) -> list[int]:
        """Roots of the largest subtrees, so many that at most ``keep`` entries stay."""
        out, left = [], self.entries
        for root in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if left <= keep:
                break
            out.append(root)
            left -= self.sizes[root]
        return out


class _Counter:
    """One task's trie, its word ids, and the runs it spills."""

    def __init__(self, lengths: tuple[int, ...], entries: int, burst: int, parts: int):
        self.lengths, self.limit, self.burst, self.parts = lengths, entries, burst, parts
        self._clear()

    def _clear(self) -> None:
        self.trie, self.ids, self.names = HatTrie(self.burst), {}, []
        self.langs: dict[str, int] = {}

    def ids_of(self, names: list[str]) -> np.ndarray:
        ids = self.ids
        for w in names:
            if w not in ids:
                ids[w] = len(self.names) + 1
                self.names.append(w)
        return np.array([ids[w] for w in names], np.int64)

    def room(self, more: int) -> Iterator[pa.RecordBatch]:
        """Spill everything if ``more`` words might not fit the packed ids."""
        if len(self.names) + more > WORDS:
            yield from self.spill(0)

    def add(self, lang: str, word: np.ndarray, starts: dict[int, np.ndarray]
            ) -> Iterator[pa.RecordBatch]:
        """Count the phrases of ``n`` words that begin where ``starts[n]`` says."""
        tag = self.langs.setdefault(lang, len(self.langs)) << _SHIFT
        for n in self.lengths:
            at = starts[n]
            if not len(at):
                continue
            first, rest = word[at] | tag, np.zeros(len(at), np.int64)
            for j in range(1, n):
                rest |= word[at + j] << (_SHIFT * (j - 1))
            order = np.lexsort((rest, first))
            first, rest = first[order], rest[order]
            new = np.ones(len(at), bool)
            new[1:] = (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])
            place = np.flatnonzero(new)
            count = np.diff(np.append(place, len(at)))
            first, rest = first[place], rest[place]
            edge = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
            keys, counts = rest.tolist(), count.tolist()
            for root, a, b in zip(first[edge].tolist(), edge.tolist(),
                                  np.append(edge[1:], len(first)).tolist()):
                self.trie.add(root, keys[a:b], counts[a:b])
            if self.trie.entries > self.limit:
                yield from self.spill(self.limit // 2)

    def spill(self, keep: int) -> Iterator[pa.RecordBatch]:
        """Sorted runs of whole subtrees, until at most ``keep`` entries stay; with
        nothing left the word ids start anew."""
        langs, names, mask = list(self.langs), self.names, (1 << _SHIFT) - 1
        runs: dict[tuple[str, int], list[tuple[str, int]]] = {}
        for root in self.trie.largest(keep):
            keys, counts = self.trie.take(root)
            lang, head = langs[root >> _SHIFT], names[(root & mask) - 1]
            for k, c in zip(keys, counts):
                words = [head]
                while k:
                    words.append(names[(k & mask) - 1])
                    k >>= _SHIFT
                part = zlib.crc32(" ".join(words[:3]).encode()) % self.parts
                runs.setdefault((lang, part), []).append((" ".join(words), c))
        if runs:
            yield _run_rows(runs)
        if not self.trie.entries:
            self._clear()


def _run_rows(runs: dict[tuple[str, int], list[tuple[str, int]]]) -> pa.RecordBatch:
    """Each run sorted by phrase, as one compressed row; words hold no line feed."""
    z, rows = zstandard.ZstdCompressor(level=3), []
    for (lang, part), run in runs.items():
        run.sort()
        phrases, counts = zip(*run)
        rows.append((part, lang, z.compress("\n".join(phrases).encode()),
                     z.compress(np.array(counts, np.int64).tobytes())))
    kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                      names=["part", "lang", "phrases", "counts"])


def _merge(least: int):
    """Runs, sorted by partition and language, to the phrases that reach ``least``;
    the empty phrase, with all words of a language, always stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, now, held = zstandard.ZstdDecompressor(), None, []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("phrase").aggregate([("n", "sum")]) \
                     .rename_columns(["phrase", "n"])

        def done() -> Iterator[pa.RecordBatch]:
            t = merged()
            words = pc.add(pc.count_substring(t["phrase"], " "), 1)
            words = pc.if_else(pc.equal(t["phrase"], ""), 0, words)
            t = pa.table({"lang": pa.array([now[1]] * len(t), pa.string()),
                          "words": words.cast(pa.int32()), "phrase": t["phrase"], "n": t["n"]})
            yield from t.filter(pc.or_(pc.greater_equal(t["n"], least),
                                       pc.equal(t["words"], 0))).to_batches()

        for batch in batches:
            for part, lang, phrases, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if now != (part, lang):
                    if held:
                        yield from done()
                    now, held = (part, lang), []
                text = pa.array([z.decompress(phrases).decode()], pa.large_string())
                held.append(pa.table({
                    "phrase": pc.split_pattern(text, "\n").values,
                    "n": np.frombuffer(z.decompress(counts), np.int64)}))
                if sum(map(len, held[1:])) > max(ENTRIES, len(held[0])):
                    held = [merged()]
        if held:
            yield from done()
    return run


_LANG, _NEXT = A.seeds(2, 13)


def _salted(h: np.ndarray, lang: str) -> np.ndarray:
    """Word hashes made the language's own."""
    salt = A.word_hashes(np.frombuffer(f"{lang} ".encode(), np.uint8), np.array([0]),
                         np.array([len(lang.encode()) + 1]))
    return A.mix(h ^ (salt * _LANG))


def _gram(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` words from each place of ``at`` on."""
    out = h[at]
    for j in range(1, n):
        out = A.mix(out * _NEXT + h[at + j])
    return out


def _places(h: np.ndarray, salt: np.uint64, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(word, bit)`` of the hashes in a table of ``size`` bits."""
    at = A.mix(h ^ salt) & np.uint64(size - 1)
    return (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    found = np.arange(len(h))
    for salt in A.seeds(PROBES, 14):
        word, bit = _places(h[found], salt, len(bits) * 64)
        found = found[(bits[word] >> bit) & np.uint64(1) == 1]
    out = np.zeros(len(h), bool)
    out[found] = True
    return out


def _starts(h: np.ndarray, piece: np.ndarray, tables: list, longest: int) -> list[np.ndarray]:
    """Places where phrases of 1, 2, ... ``longest`` words begin that lie in one
    piece and all of whose parts the bit tables know: words and pairs the first
    table, ``n`` words the ``n - 1``-th."""
    m = len(h)
    out = [np.arange(m) if not tables else np.flatnonzero(_has(tables[0], h))]
    ok = np.zeros(m + 1, bool)
    for n in range(2, longest + 1):
        ok[:] = False
        ok[out[-1]] = True
        at = out[-1] if n > 2 else np.arange(m)
        at = at[at + n <= m]
        at = at[piece[at] == piece[at + n - 1]]
        if n > 2:
            at = at[ok[at + 1]]
        if len(tables) >= n - 1:
            at = at[_has(tables[n - 2], _gram(h, at, n))]
        out.append(at)
    return out


def _texts(batches: Iterator[pa.RecordBatch]
           ) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(lang, bytes, word starts, word ends, pieces)`` of slices of one language."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        text = A.string_column(batch, "text")
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            for _, _, buf, off in A.slices(text.filter(pc.equal(langs.indices, k)), SLICE):
                buf = A.lower(buf)
                start, end, piece = _bare(buf, off)
                if len(start):
                    yield lang, buf, start, end, piece


def _marked(docs: DataFrame, lengths: tuple[int, ...], tables: list, least: int):
    """Broadcast bit table of the hashes that phrases of ``lengths`` words reach
    ``least`` times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [t.value for t in tables]
        parts, held = [], 0

        def flush():
            h, n = np.unique(np.concatenate(parts), return_counts=True)
            for i in range(0, len(h), 1 << 18):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[i:i + (1 << 18)].view(np.int64)), pa.array(n[i:i + (1 << 18)])],
                    names=["h", "n"])

        for lang, buf, start, end, piece in _texts(batches):
            h = _salted(A.word_hashes(buf, start, end), lang)
            starts = _starts(h, piece, known, max(lengths))
            for n in lengths:
                parts.append(_gram(h, starts[n - 1], n))
                held += len(parts[-1])
            if held > HASHES:
                yield from flush()
                parts, held = [], 0
        if held:
            yield from flush()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 64, np.uint64)
        for batch in batches:
            for salt in A.seeds(PROBES, 14):
                word, bit = _places(batch.column(0).to_numpy().view(np.uint64), salt, size)
                np.bitwise_or.at(bits, word, np.uint64(1) << bit)
        slot = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(bits[slot].view(np.int64))],
                                         names=["slot", "bits"])

    often, rows = materialize(
        docs.mapInArrow(run, "h long, n long").repartition("h").groupBy("h")
        .agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("h"), "phrases-hashes",
        compressed=False)
    size = 1 << min(MAX_BITS, max(16, (32 * rows).bit_length()))
    found = (often.mapInArrow(mark, "slot long, bits long").groupBy("slot")
             .agg(F.bit_or("bits").alias("bits")).toArrow())
    release(often)
    bits = np.zeros(size // 64, np.uint64)
    bits[np.asarray(found["slot"])] = np.asarray(found["bits"]).astype(np.int64).view(np.uint64)
    return docs.sparkSession.sparkContext.broadcast(bits)


def _count(docs: DataFrame, longest: int, tables: list, least: int, entries: int, burst: int
           ) -> DataFrame:
    """``COUNTS`` of the phrases that occur ``least`` times, of those that the bit tables
    let through; ``words`` 0 counts all words of a language."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [t.value for t in tables]
        counter = _Counter(tuple(range(1, longest + 1)), entries, burst, parts)
        total: dict[str, int] = {}
        for lang, buf, start, end, piece in _texts(batches):
            total[lang] = total.get(lang, 0) + len(start)
            h = _salted(A.word_hashes(buf, start, end), lang)
            starts = dict(enumerate(_starts(h, piece, known, longest), 1))
            used = np.zeros(len(start), bool)
            for n, at in starts.items():
                for j in range(n):
                    used[at + j] = True
            where = np.flatnonzero(used)
            if len(where):
                coded = pc.dictionary_encode(_word_column(buf, start[where], end[where]))
                names = coded.dictionary.to_pylist()
                yield from counter.room(len(names))
                word = np.zeros(len(start), np.int64)
                word[where] = counter.ids_of(names)[np.asarray(coded.indices)]
                yield from counter.add(lang, word, starts)
        yield from counter.spill(0)
        if total:
            yield _run_rows({(lang, 0): [("", n)] for lang, n in total.items()})

    return (docs.mapInArrow(run, RUNS).repartition("part").sortWithinPartitions("part", "lang")
            .mapInArrow(_merge(least), COUNTS))


def _word_column(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words as an array of strings."""
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    data = buf[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    return pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(np.append(0, np.cumsum(end - start)).astype(np.int64)),
        pa.py_buffer(data))


def frequent_phrases(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = 4,
                     least: int = 30, entries: int = ENTRIES, burst: int = BURST
                     ) -> tuple[DataFrame, DataFrame]:
    """``(counts, totals)``: ``lang, words, phrase, n`` of all phrases of up to
    ``longest`` words that occur ``least`` times in a language, and ``lang, n``, all
    its word occurrences, of one written table."""
    df = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    tables: list = []
    for lengths in ((1, 2), *((n,) for n in range(3, longest))):
        tables.append(_marked(df, lengths, tables, least))
    counts, _ = materialize(_count(df, longest, tables, least, entries, burst), "phrases")
    for t in tables:
        t.unpersist()
    return counts.filter("words > 0"), counts.filter("words = 0").select("lang", "n")


def _part(first, length):
    return F.array_join(F.slice("w", first, length), " ")


def score_phrases(counts: DataFrame, *, factor: int = 2_000_000) -> DataFrame:
    """Every phrase of two or more words with its lowest-scoring cut: ``lang, words,
    phrase, a, l, r, score``.  Quotients are of decimals, hence exact."""
    phrases = counts.filter("words >= 2").select("lang", "words", "phrase", F.col("n").alias("a"))
    w = F.split("phrase", " ")
    cuts = (phrases.withColumn("w", w)
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumns({"left": _part(F.lit(1), F.col("k")),
                          "right": _part(F.col("k") + 1, F.col("words") - F.col("k"))}).drop("w"))
    cuts, _ = materialize(cuts, "phrases-cuts")
    for side, name in (("left", "l"), ("right", "r")):
        asked = cuts.groupBy("lang", side).agg(F.count(F.lit(1)).alias("asked"))
        table = (counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
                 .join(asked, ["lang", side]))
        table, _ = materialize(table, "phrases-parts")
        cuts, _ = materialize(lookup(cuts, table, ["lang", side], "asked").drop(side),
                              "phrases-cut")
    cuts = cuts.withColumn("score", F.expr(
        f"(CAST(a AS DECIMAL(20,0)) * CAST({factor} AS DECIMAL(10,0))) div "
        "(CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("b")
    return (cuts.groupBy("lang", "words", "phrase", "a").agg(best)
            .select("lang", "words", "phrase", "a", "b.l", "b.r", "b.score"))


def mine_phrases(docs: DataFrame, *, top: int = 2000, num: int = 80, den: int = 100,
                 **params) -> DataFrame:
    """Each language's best ``top`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase all but ``1 - num/den`` of whose occurrences lie in one longer phrase is
    dropped for it.  Null texts are empty, a null language is ``und``; equal scores
    go by occurrences, then by the phrase's bytes; repeated rows count each; an
    empty table gives no rows; other columns are left aside, whatever their names."""
    counts, totals = frequent_phrases(docs, **params)
    scored, _ = materialize(score_phrases(counts), "phrases-scored")
    inner = F.expr("""flatten(transform(sequence(2, words - 1), m ->
        transform(sequence(1, words - m + 1), i -> array_join(slice(w, i, m), ' '))))""")
    covered = (scored.filter("words >= 3").withColumn("w", F.split("phrase", " "))
               .select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
               .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    left = (scored.join(covered, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.col("longer") * den < F.col("a") * num)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = (salted.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top))
    ranked = first.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2),
                                        lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
f AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
cut AS (
  SELECT lang, m, phrase, a, k, string_split(phrase, ' ') AS w
  FROM f, (SELECT unnest([1, 2, 3]) AS k) WHERE k < m),
scored AS MATERIALIZED (
  SELECT c.lang, c.m, c.phrase, c.a, min((CAST(2000000::HUGEINT * c.a // (x.a + y.a) AS BIGINT),
                                          k, x.a, y.a)) AS b
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
             JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  GROUP BY ALL),
kept AS (
  SELECT * FROM scored s WHERE NOT EXISTS (
    SELECT 1 FROM f g WHERE g.lang = s.lang AND g.m > s.m AND 100 * g.a >= 80 * s.a
      AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, rank, phrase, a, b[3] AS l, b[4] AS r, n, b[1] AS score FROM (
  SELECT *, row_number() OVER (
    PARTITION BY lang ORDER BY b[1] DESC, a DESC, encode(phrase)) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000"""
