"""Operator 3: token counts that follow edits.

A document keeps a segment tree over its pre-tokens; every node holds the
characters and the tokens below it.  An edit finds the pre-tokens it touches by
descending the tree, goes back by the boundary context, and encodes from there
until its pre-tokens meet the old ones again.  The new pre-tokens take the
place of the touched ones in one leaf, the other touched leaves become empty,
and only the sums above them are updated.  A leaf that holds several pre-tokens keeps
the list of them, so a later edit stops at their boundaries too.

Pre-tokens depend on the text to their right only: on at most the two
characters after their end (a run of white space gives its last character to a
following word).  So a pre-token that ends two or more characters before the
edit stays, and once a new boundary after the edit meets an old one, all that
follows stays.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairo.llm import arrays as A

#: Characters after a pre-token's end on which it can depend.
CONTEXT = 2
REMEMBERED = 1 << 18


class PreTokens:
    """Splits texts and counts a pre-token's tokens (remembered, bounded)."""

    def __init__(self, ranks: str, pattern: str):
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges,
                                           special_tokens={})
        self.split = regex.compile(pattern).findall
        self.iterate = regex.compile(pattern).finditer
        self._known: dict[str, int] = {}

    def _count(self, token: str) -> int:
        n = len(self._encoding.encode_ordinary(token))
        if len(self._known) >= REMEMBERED:
            self._known.clear()
        self._known[token] = n
        return n

    def counts(self, tokens: list[str]) -> list[int]:
        found = list(map(self._known.get, tokens))
        if None in found:
            count = self._count
            found = [n or count(t) for n, t in zip(found, tokens)]
        return found


@functools.cache
def pre_tokens(ranks: str, pattern: str) -> PreTokens:
    return PreTokens(ranks, pattern)


class CountTree:
    """One document's text with its segment tree of counts."""

    def __init__(self, text: str, tokens: PreTokens):
        self.text, self._tokens = text, tokens
        parts = tokens.split(text)
        n = len(parts)
        self._size = size = 1 << max(0, n - 1).bit_length()
        self._chars, self._sums = np.zeros(2 * size, np.int64), np.zeros(2 * size, np.int64)
        self._chars[size:size + n] = list(map(len, parts))
        self._sums[size:size + n] = tokens.counts(parts)
        #: leaves that an edit filled: their pre-tokens as (characters, tokens)
        self._inner: dict[int, list[tuple[int, int]]] = {}
        for a in (self._chars, self._sums):
            lo = size
            while lo > 1:
                a[lo >> 1:lo] = a[lo:2 * lo:2] + a[lo + 1:2 * lo:2]
                lo >>= 1
        self.encoded = n                 # pre-tokens encoded so far

    @property
    def total(self) -> int:
        return int(self._sums[1])

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf holding the character."""
        node, begin = 1, 0
        while node < self._size:
            node *= 2
            left = int(self._chars[node])
            if place >= begin + left:
                begin, node = begin + left, node + 1
        return node, begin

    def _set(self, leaf: int, chars: int, tokens: int) -> None:
        dc, dt = chars - self._chars[leaf], tokens - self._sums[leaf]
        while leaf:
            self._chars[leaf] += dc
            self._sums[leaf] += dt
            leaf >>= 1

    def edit(self, start: int, end: int, new: str) -> int:
        """Replace ``text[start:end]``; returns the new total.  Places beyond
        the text are clipped to it."""
        old, n = self.text, len(self.text)
        start = min(max(start, 0), n)
        end = min(max(end, start), n)
        self.text = old[:start] + new + old[end:]
        shift = len(new) - (end - start)
        if not n:
            done = self.encoded
            self.__init__(self.text, self._tokens)
            self.encoded += done
            return self.total
        # the pre-token of the character before the edit's context
        target = min(max(start - CONTEXT, 0), n - 1)
        leaf, begin = self._leaf_at(target)
        head: list[tuple[int, int]] = []
        first = begin
        for chars, count in self._inner.get(leaf, ()):
            if begin + chars > target:
                break
            head.append((chars, count))
            begin += chars
        # old boundaries from the edit's end on, leaf by leaf
        last, last_begin = leaf, first
        parts: list[str] = []
        tail: list[tuple[int, int]] = []
        stop = None
        for m in self._tokens.iterate(self.text, begin):
            parts.append(m.group())
            if m.end() < start + len(new):
                continue
            goal = m.end() - shift                   # the same place in the old text
            while last_begin + int(self._chars[last]) < goal and last + 1 < 2 * self._size:
                last_begin += int(self._chars[last])
                last += 1
            rest = self._after(last, goal - last_begin) if goal >= end else None
            if rest is not None:
                stop, tail = last, rest
                break
        if stop is None:                             # the edit reaches the end of the text
            stop = 2 * self._size - 1
        fresh = list(zip(map(len, parts), self._tokens.counts(parts)))
        self.encoded += len(fresh)
        for k in range(leaf, stop + 1):
            if self._chars[k]:
                self._set(k, 0, 0)
            self._inner.pop(k, None)
        now = head + fresh + tail
        self._set(leaf, sum(c for c, _ in now), sum(t for _, t in now))
        self._inner[leaf] = now
        return self.total

    def _after(self, leaf: int, place: int) -> list[tuple[int, int]] | None:
        """The leaf's pre-tokens from ``place`` on, None if none begins there."""
        if place == int(self._chars[leaf]):
            return []
        inner = self._inner.get(leaf) or [(int(self._chars[leaf]), int(self._sums[leaf]))]
        if not place:
            return list(inner)
        for k, (chars, _) in enumerate(inner):
            place -= chars
            if place <= 0:
                return inner[k + 1:] if not place else None
        return None


def count_tokens(docs: DataFrame, ranks: str, pattern: str, edits: Column, *,
                 id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_pretokens, n_tokens, n_tokens_edited, n_reencoded)``.

    ``edits`` is a column of ``array<struct<start, end, replacement>>``, applied
    in order, in code points of the text as it stands; null or empty: none.
    Null fields of an edit read as 0, 0 and the empty text.  Null and empty
    texts have no token.  ``n_reencoded`` counts the pre-tokens encoded for
    the edits.  Rows are independent: ties, repeated rows and null ids stay as
    they are; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = pre_tokens(ranks, pattern)
        for batch in batches:
            col = A.string_column(batch, "text")
            for i in range(0, batch.num_rows, 512):
                rows = []
                for body, changes in zip(col.slice(i, 512).to_pylist(),
                                         batch.column(2).slice(i, 512).to_pylist()):
                    tree = CountTree(body, tokens)
                    n, before = tree.encoded, tree.total
                    for c in changes or ():
                        tree.edit(c["start"] or 0, c["end"] or 0, c["replacement"] or "")
                    rows.append((n, before, tree.total, tree.encoded - n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 512)] + [pa.array(c, pa.int64()) for c in zip(*rows)],
                    names=["doc_id", "n_pretokens", "n_tokens", "n_tokens_edited", "n_reencoded"])
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       edits.alias("edits")) \
               .mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, "
                                "n_tokens_edited long, n_reencoded long")


def sample_edits(text: str = "text") -> Column:
    """Three edits that every text gives by itself: 20 characters at a quarter
    reversed, 10 at the middle deleted, the first 15 inserted at three
    quarters."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.char_length(t)
    a, b, c = (n / 4).cast("int"), (n / 2).cast("int"), (n * 3 / 4).cast("int")
    edit = lambda s, e, r: F.struct(s.alias("start"), e.alias("end"), r.alias("replacement"))
    return F.array(edit(a, a + 20, F.reverse(F.substr(t, a + 1, F.lit(20)))),
                   edit(b, b + 10, F.lit("")), edit(c, c, F.substr(t, F.lit(1), F.lit(15))))
