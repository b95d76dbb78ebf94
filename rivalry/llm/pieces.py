"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search keeps, for each position of a window bounded by the longest piece, the best piece that
ends there. As soon as all paths that can still win run through one position, the ids up to it are
committed and forgotten. Models that merge pairs and models that add up scores differ in what is
best only:

* *merges*: a piece may follow another if joining the two texts by the model's merges gives just
  these two pieces again. The result of the merges is the only path all of whose neighbours agree
  so, thus each position has one piece, and the ids are those of the merges.
* *scores*: the path with the largest sum of scores.

No piece has a space after another character, so every such border is a position that all paths
share, where the window commits and is empty. What it commits from one such border to the next does
not depend on what comes before, so a task remembers it, and takes it from there the next time.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType


#: The character that pieces have for a space; fixed value.
SPACE = "▁"

#: Positions between two attempts to commit ids.
COMMIT = 64

#: Stands for that character in a text, where it is no space; no stretch ends so.
LITERAL = "\0" + SPACE

#: Bytes of text that a task encodes together.
PART = 2_000_000

#: Bytes of remembered stretches, about, in each half of the memory, and those that one may take.
MEMORY, MOST = 40_000_000, 1_000

#: Pairs of pieces whose order is remembered, as two sets of numbers.
PAIRS = 250_000


@dataclass
class Vocabulary:
    """Pieces with ids and scores, and the ids of the 256 bytes, of a SentencePiece model.

    ``merges`` tells a model that merges pairs, best score first, from one that adds up scores.
    """

    pieces: dict[str, int]
    scores: dict[int, float]
    bytes_: list[int]
    merges: bool = True
    texts: dict[int, str] = field(init=False)

    def __post_init__(self) -> None:
        self.texts = {i: p for p, i in self.pieces.items()}
        self.longest = max(map(len, self.pieces), default=1)
        #: The id of each piece, and -1 for what pieces end with.
        self.endings = {p[k:]: -1 for p in self.pieces for k in range(len(p))} | self.pieces
        #: Pairs of characters inside pieces; all paths share the border inside any other pair.
        self.inner = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        self.break_apart = not any("\n" in p for p in self.pieces)
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece has a space after another character")

    @classmethod
    def load(cls, path: str, merges: bool = True) -> Vocabulary:
        """From a model file that the driver can read; tasks are sent what they need of it."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        normal = [
            i
            for i in ids
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        if sum(map(model.is_byte, ids)) != 256:
            raise ValueError("the model has no piece for each byte")
        return cls(
            {model.id_to_piece(i): i for i in normal},
            {i: model.get_score(i) for i in normal},
            [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
            merges,
        )


class Encoder:
    """Encodes texts; remembers stretches, pairs and how pieces are made."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.lengths = {i: len(p) for i, p in vocabulary.texts.items()}
        self.window = COMMIT + vocabulary.longest
        # stretches of late and of before; the older half goes when the younger is full
        self.known: dict[str, bytes] = {LITERAL: self._packed([-1 - ord(SPACE)])}
        self.older: dict[str, bytes] = {}
        self.held = 0
        self.made: dict[int, tuple | None] = {}
        # numbers of pairs of pieces that may follow each other, and of those that may not
        self.size = max(vocabulary.pieces.values(), default=0) + 1
        self.good: set[int] = set()
        self.bad: set[int] = set()

    def _making(self, piece: int) -> tuple | None:
        """How merges make a piece: its last parts and its first parts over time, each with the
        rank of the merge that ends it. None if they make something else of its text."""
        pieces, scores = self.v.pieces, self.v.scores
        parts = list(self.v.texts[piece])
        first, last = [], []
        while len(parts) > 1:
            ranks = [
                -scores[pieces[a + b]] if a + b in pieces else np.inf
                for a, b in zip(parts, parts[1:])
            ]
            rank = min(ranks)
            if rank == np.inf:
                return None
            k = ranks.index(rank)
            if k == 0:
                first.append((parts[0], rank))
            if k == len(parts) - 2:
                last.append((parts[-1], rank))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        whole = (parts[0], np.inf)
        return ([*first, whole], [*last, whole])

    def _follows(self, one: int | None, two: int) -> bool:
        """Whether no merge joins a last part of ``one`` with a first part of ``two`` in time.

        Of merges of equal rank the left one comes first. At the start of a stretch, and after
        an unknown character, the merges need only give ``two`` itself.
        """
        pieces, scores = self.v.pieces, self.v.scores
        if two not in self.made:
            self.made[two] = self._making(two)
        found = self.made[two] is not None
        if found and one is not None and one >= 0:
            for left, ends_left in self.made[one][1]:
                for right, ends_right in self.made[two][0]:
                    joined = pieces.get(left + right)
                    if joined is not None:
                        rank = -scores[joined]
                        if rank < ends_left and rank <= ends_right:
                            found = False
        if len(self.good) + len(self.bad) >= PAIRS:
            self.good.clear()
            self.bad.clear()
        (self.good if found else self.bad).add(self._pair(one, two))
        return found

    def _pair(self, one: int | None, two: int) -> int:
        """A number for two pieces; the start and all unknown characters count as one piece."""
        return two if one is None or one < 0 else (one + 1) * self.size + two

    def _step(self, text: str, e: int, back: list, value: list) -> None:
        """Add the best piece that ends at ``e``, and the score of its path, to the lists.

        Unknown characters are -1 - code point; with scores they count as worse than any piece.
        """
        endings, scores, merges = self.v.endings, self.v.scores, self.v.merges
        best, most = None, 0.0
        for s in range(e - 1, -1, -1):
            piece = endings.get(text[s:e])
            if piece is None:
                break
            if piece < 0:
                continue
            before = back[s]
            if merges:
                pair = piece if before is None or before < 0 else (before + 1) * self.size + piece
                if pair in self.good or (pair not in self.bad and self._follows(before, piece)):
                    best = piece
                    break
            elif best is None or value[s] + scores[piece] > most:
                best, most = piece, value[s] + scores[piece]
        if best is None:
            best, most = -1 - ord(text[e - 1]), value[e - 1] - 1e6
        back.append(best)
        value.append(most)

    def stream(self, text: str) -> Iterator[list[int]]:
        """The pieces of a stretch, as lists that are final, with a window of bounded length."""
        back, value, base = [None], [0.0], 0
        for e in range(1, len(text) + 1):
            self._step(text[base:e], e - base, back, value)
            if len(back) >= self.window and (final := self._committed(back, value)):
                yield final
                base = e + 1 - len(back)
        yield self._path(back, len(back) - 1)

    def _committed(self, back: list, value: list) -> list[int]:
        """The pieces that all paths share, taken out of the window; none if they share none."""
        # a later piece starts at one of the last positions
        front = set(range(len(back) - self.v.longest, len(back)))
        while len(front) > 1:
            k = max(front)
            front.remove(k)
            front.add(k - self.lengths.get(back[k], 1))
        meet = front.pop()
        path = self._path(back, meet)
        del back[:meet], value[:meet]
        return path

    def _search(self, stretches: list[str]) -> None:
        """Stream new stretches and remember their ids. In sorted order, each goes on where it
        leaves the one before, as long as the window has forgotten nothing of that."""
        step, window = self._step, self.window
        back, value, last = [None], [0.0], ""
        for text in sorted(stretches):
            same, ids = 0, b""
            if len(back) == len(last) + 1:
                most = min(len(text), len(last))
                while same < most and text[same] == last[same]:
                    same += 1
                del back[same + 1 :], value[same + 1 :]
            else:
                back, value = [None], [0.0]
            base = 0
            for e in range(same + 1, len(text) + 1):
                step(text[base:e] if base else text, e - base, back, value)
                if len(back) >= window:
                    ids += self._packed(self._committed(back, value))
                    base = e + 1 - len(back)
            last = text
            ids += self._packed(self._path(back, len(back) - 1))
            self.known[text] = ids
            self.held += 250 + 2 * len(text) + len(ids)

    def _path(self, back: list, end: int) -> list[int]:
        path, lengths = [], self.lengths
        while end > 0:
            piece = back[end]
            path.append(piece)
            end -= lengths.get(piece, 1)
        path.reverse()
        return path

    def _packed(self, path: list[int]) -> bytes:
        """Ids as 32-bit integers; unknown characters become bytes."""
        if path and min(path) < 0:
            ids: list[int] = []
            for piece in path:
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids += (self.v.bytes_[b] for b in chr(-1 - piece).encode())
            path = ids
        return array("i", path).tobytes()

    def _prepare(self, stretches: set[str]) -> None:
        """Search the stretches not seen before, all together.

        All paths share the borders that no piece has inside, so what follows one is apart.
        """
        if self.held >= MEMORY:
            self.known, self.older, self.held = {}, self.known, 0
            self.known[LITERAL] = self.older[LITERAL]
        known, older, inner = self.known, self.older, self.v.inner
        new, ends = set(), {}
        for text in stretches:
            if text in known:
                continue
            if text in older:
                known[text] = older[text]
                self.held += 250 + 2 * len(text) + len(older[text])
                continue
            core = text
            while len(core) > 1 and core[-2:] not in inner:
                core = core[:-1]
                new.add(text[len(core)])
            if core != text:
                ends[text] = core
            new.add(core)
        self._search([x for x in new if x not in known])
        for text, core in ends.items():
            known[text] = b"".join([known[core], *map(known.__getitem__, text[len(core) :])])
            self.held += 250 + 2 * len(text) + len(known[text])

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of texts. A space stands before each, as the models have it; a character of a text
        that looks like the one for spaces is written as bytes, so that every text decodes."""
        split = [None if t is None else self._split(t) for t in texts]
        seen = set().union(*(parts for parts in split if parts))
        self._prepare(seen)
        find = self.known.__getitem__
        ids = [
            None if parts is None else np.frombuffer(b"".join(map(find, parts)), np.int32)
            for parts in split
        ]
        for text in [x for x in seen if len(x) > MOST]:
            self.held -= 250 + 2 * len(text) + len(self.known.pop(text))
        return ids

    def _split(self, text: str) -> list[str]:
        """The stretches of a text in order, ``LITERAL`` for the character that marks a space."""
        if not text:
            return []
        if SPACE in text:
            out = []
            for k, part in enumerate(text.split(SPACE)):
                if k:
                    out.append(LITERAL)
                out += self._stretches(part, k == 0)
            return out
        return self._stretches(text, True)

    def _stretches(self, text: str, first: bool) -> list[str]:
        if "  " in text or (first and text[:1] == " "):
            # runs of spaces stay with what follows
            out, spaces = [], int(first)
            for part in text.split(" "):
                if part:
                    out += self._lines(SPACE * spaces + part).split(" ")
                    spaces = 1
                else:
                    spaces += 1
            return [*out, SPACE * (spaces - 1)] if spaces > 1 else out
        return self._lines((SPACE if first else "") + text.replace(" ", " " + SPACE)).split(" ")

    def _lines(self, text: str) -> str:
        """Line breaks apart, if no piece has one; between two of them is an empty stretch."""
        return text.replace("\n", " \n ") if self.v.break_apart else text


class Decoder:
    """Turns ids into text again."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.parts = {i: p.replace(SPACE, " ").encode() for p, i in vocabulary.pieces.items()}
        self.parts |= {i: bytes([b]) for b, i in enumerate(vocabulary.bytes_)}

    def decode(self, ids: np.ndarray) -> str:
        """The text without the space before it; bytes that are no text become U+FFFD."""
        text = b"".join(map(self.parts.__getitem__, ids.tolist()))
        return text.removeprefix(b" ").decode("utf-8", "replace")


def _added(df: DataFrame, *more: StructField) -> tuple[DataFrame, StructType]:
    """``df`` without the columns to add, and the schema with them."""
    rows = df.select(*(c for c in df.columns if c not in {f.name for f in more}))
    return rows, StructType([*rows.schema.fields, *more])


def encode(docs: DataFrame, vocabulary: Vocabulary, column: str = "text") -> DataFrame:
    """``docs`` with ids (array of int), n_ids and exact (whether decoding gives the text back).

    Whole texts are read, row by row; nothing is shuffled, and the vocabulary, whose size is
    fixed, is sent to the tasks. A null text gets null ids, an empty one none; both are exact.
    Columns named ids, n_ids or exact are replaced; equal texts get equal ids; an empty table
    gives an empty result.
    """
    rows, schema = _added(
        docs,
        StructField("ids", ArrayType(IntegerType(), False)),
        StructField("n_ids", LongType()),
        StructField("exact", BooleanType()),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in batches:
            for small in _parts(batch, column):
                texts = small.column(column).to_pylist()
                ids = encoder.encode(texts)
                exact = [t is None or decoder.decode(i) == t for t, i in zip(texts, ids, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *small.columns,
                        _lists(ids),
                        pa.array([0 if i is None else len(i) for i in ids], pa.int64()),
                        pa.array(exact, pa.bool_()),
                    ],
                    names=[*small.schema.names, "ids", "n_ids", "exact"],
                )

    return rows.mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch, column: str, size: int = PART) -> Iterator[pa.RecordBatch]:
    """Rows with texts of about ``size`` bytes together, so that what is in work stays bounded."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size)))
        yield batch.slice(first, last - first)
        first = last


def _lists(ids: list[np.ndarray | None]) -> pa.Array:
    offsets = np.cumsum([0, *(0 if i is None else len(i) for i in ids)]).astype(np.int32)
    missing = np.array([i is None for i in ids] + [False])
    flat = [i for i in ids if i is not None]
    return pa.ListArray.from_arrays(
        pa.array(offsets, mask=missing),
        pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32)),
    )


def decode(encoded: DataFrame, vocabulary: Vocabulary, column: str = "ids") -> DataFrame:
    """``encoded`` with the column decoded: the text of its ids; null for null."""
    from pyspark.sql.types import StringType

    rows, schema = _added(encoded, StructField("decoded", StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            ids = batch.column(column).to_pylist()
            texts = [None if i is None else decoder.decode(np.array(i, np.int32)) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())],
                names=[*batch.schema.names, "decoded"],
            )

    return rows.mapInArrow(run, schema)
