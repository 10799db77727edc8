"""Operator 5: SentencePiece (merge type) encoding and decoding.

The encoder never runs merges over the text.  For every prefix of a segment it
stores the one token that ends the prefix's encoding:

* an automaton over the vocabulary lists the tokens that end at each place;
* a token ``t`` ends the prefix's encoding if the token stored for the rest of
  the prefix and ``t`` are *compatible*: the merges of their joined text give
  exactly these two tokens.  A sequence is the encoding of its text if and
  only if all its neighbours are compatible, so exactly one token fits;
* walking back from the last prefix recovers the ids.

Texts are cut into segments where no vocabulary entry crosses: before a run of
spaces (escaped as the mark U+2581 in the vocabulary), around line ends, and
between a letter and a *closer* (a character that no entry has after a letter;
found from the vocabulary).  Segments are therefore independent.  A bounded
table keeps the results of segments met before.

Compatibility is tested along the facing edges of the two tokens' merge trees:
the parts that touch the seam grow in merge order, and the pair fails if the
two parts that touch at some time form an entry that merges before either
grows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairo.llm import arrays as A

MARK = "▁"
#: Segments of each of the two halves of a worker's table.
REMEMBERED = 150_000


class PieceCodec:
    """Encoder and decoder of one merge-type model file.  The model must keep
    text as it is (identity normaliser), put a mark in front, keep repeated
    spaces and fall back to bytes; other settings raise ValueError."""

    def __init__(self, model: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        probe = " a  b\t½ "
        if sp.normalize(probe) != (MARK + probe).replace(" ", MARK):
            raise ValueError("the model's normaliser is not supported")
        self.byte_of = {i: int(self.piece[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        self.score, self.id = {}, {}
        for i, p in enumerate(self.piece):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.score[p], self.id[p] = sp.get_score(i), i
        crossing = [p for p in self.id if MARK in p.lstrip(MARK) or "\n" in p[:-1] or "\n" in p[1:]]
        if crossing:
            raise ValueError(f"vocabulary entries cross segments: {crossing[:3]}")
        self.known = frozenset(c for c in self.id if len(c) == 1)
        self._segments = self._segmenter()
        self._text_of = {p: str(i) for p, i in self.id.items()}
        self._fits: dict[tuple[str, str], bool] = {}
        self._tokens = ahocorasick.Automaton()
        self._right: dict[str, list[tuple[str, float]]] = {}
        self._left: dict[str, list[tuple[str, float]]] = {}
        for p in self.id:
            tree = self.merge_tree(p)
            if len(tree) == 1:                      # only tokens that merging can reach
                self._tokens.add_word(p, p)
                self._left[p], self._right[p] = self._edge(tree[0], 0), self._edge(tree[0], 1)
        self._tokens.make_automaton()
        self._table: dict[str, tuple[int, str, str]] = {}
        self._older: dict[str, tuple[int, str, str]] = {}

    def _segmenter(self) -> re.Pattern:
        letter, other = "[^\\W\\d_]", "(?:[^\\w \n]|[\\d_])"
        is_letter = re.compile(letter).match
        after = {b for p in self.id for a, b in zip(p, p[1:]) if is_letter(a)}
        open_ = "".join(sorted(c for c in after if not is_letter(c) and c not in (MARK, "\n")))
        tail = f"(?:{letter}+[{re.escape(open_)}]{other}*)*" if open_ else ""
        return re.compile(f"(?=[^\n]) *{other}*{tail}{letter}*|\n")

    def merge_tree(self, text: str) -> list[tuple]:
        """The merges themselves: best-scored neighbour pair first, leftmost on
        a tie.  Returns trees ``(text, time, left, right)``; ``time`` is the
        lowest score among a tree's merges, so trees form in falling time."""
        parts = [(c, float("inf"), None, None) for c in text]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i][0] + parts[i + 1][0])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            x, y = parts[at], parts[at + 1]
            parts[at:at + 2] = [(x[0] + y[0], min(best, x[1], y[1]), x, y)]
        return parts

    @staticmethod
    def _edge(tree: tuple, side: int) -> list[tuple[str, float]]:
        """Parts on one edge of a tree, from the single character up, each
        with the time at which it grows into the next."""
        out, grows = [], float("-inf")
        while tree is not None:
            out.append((tree[0], grows))
            grows, tree = tree[1], tree[2 + side]
        return out[::-1]

    def compatible(self, left: str, right: str) -> bool:
        known = self._fits.get((left, right))
        if known is None:
            known = self._meet(self._right[left], self._left[right])
            if len(self._fits) >= 1 << 20:
                self._fits.clear()
            self._fits[left, right] = known
        return known

    def _meet(self, left: list[tuple[str, float]], right: list[tuple[str, float]]) -> bool:
        i = j = 0
        while True:
            (x, grows_x), (y, grows_y) = left[i], right[j]
            s = self.score.get(x + y)
            if s is not None and s > grows_x and s >= grows_y:
                return False
            if i + 1 == len(left) and j + 1 == len(right):
                return True
            if grows_x >= grows_y:
                i += 1
            else:
                j += 1

    def _prefix_table(self, text: str) -> list[str]:
        """Tokens of a text of known characters."""
        last: list[str | None] = [None] * (len(text) + 1)
        fits, compatible = self._fits, self.compatible
        for end, token in self._tokens.iter(text):
            end += 1
            if last[end] is not None:
                continue
            begin = end - len(token)
            if begin == 0:
                last[end] = token
                continue
            pair = last[begin], token
            ok = fits.get(pair)
            if ok or (ok is None and compatible(*pair)):
                last[end] = token
        out, i = [], len(text)
        while i:
            out.append(last[i])
            i -= len(last[i])
        out.reverse()
        return out

    def segment_ids(self, segment: str) -> list[int]:
        ids, run = [], ""
        for c in segment:                            # unknown characters part the rest
            if c in self.known:
                run += c
                continue
            ids += [self.id[t] for t in self._prefix_table(run)]
            ids += [self.byte_id[b] for b in c.encode("utf-8", "replace")]
            run = ""
        return ids + [self.id[t] for t in self._prefix_table(run)]

    def _segment(self, segment: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by commas, decoded text) of a segment."""
        found = self._older.get(segment)
        if found is None:
            escaped = segment.replace(" ", MARK)
            if self.known.issuperset(escaped):
                tokens = self._prefix_table(escaped)
                found = (len(tokens), ",".join([self._text_of[t] for t in tokens]),
                         "".join(tokens).replace(MARK, " "))
            else:
                ids = self.segment_ids(escaped)
                found = len(ids), ",".join(map(str, ids)), self._surface(ids)
        if len(self._table) >= REMEMBERED:           # the older half goes
            self._older, self._table = self._table, {}
        self._table[segment] = found
        return found

    def _parts(self, text: str) -> list[tuple[int, str, str]]:
        if not text:
            return []
        segments = self._segments.findall(" " + text.replace(MARK, " "))
        found = list(map(self._table.get, segments))
        if None in found:
            new = self._segment
            found = [f or self._table.get(s) or new(s) for f, s in zip(found, segments)]
        return found

    def encode(self, text: str) -> list[int]:
        return [int(i) for p in self._parts(text) for i in p[1].split(",")]

    def _surface(self, ids: list[int]) -> str:
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(self.piece[i].replace(MARK, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, marks as spaces, without the space put in front."""
        return self._surface(ids).removeprefix(" ")

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text)."""
        parts = self._parts(text)
        ids = ",".join([p[1] for p in parts])
        back = "".join([p[2] for p in parts]).removeprefix(" ")
        return (sum([p[0] for p in parts]), hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(back.encode()).hexdigest())


@functools.cache
def codec(model: str) -> PieceCodec:
    """One codec per worker process and model file."""
    return PieceCodec(model)


def _pieces(batch: pa.RecordBatch, rows: int = 256) -> Iterator[tuple[pa.Array, list[str]]]:
    texts = A.string_column(batch, "text")
    for i in range(0, batch.num_rows, rows):
        yield batch.column(0).slice(i, rows), texts.slice(i, rows).to_pylist()


def encode_documents(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text"
                     ) -> DataFrame:
    """``(doc_id, ids)``: the ids of every text; null and empty text: no ids.
    Rows are independent: ties, repeated rows and null ids stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _pieces(batch):
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([codec(model).encode(t) for t in texts], pa.list_(pa.int32()))],
                    names=["doc_id", "ids"])
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")) \
               .mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids decode as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                ids = batch.column(1).slice(i, 256).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 256),
                     pa.array([codec(model).decode(x or []) for x in ids], pa.string())],
                    names=["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: every text encoded
    and decoded again in one pass; the digests are those of the ids joined by
    commas and of the decoded text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _pieces(batch):
                n, a, b = zip(*map(codec(model).digest, texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")) \
               .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, "
                                "decoded_sha256 string")
