"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping segments. A part of a document within ``k`` edits of a
segment of ``m`` characters shares at least ``m - q + 1 - k * q`` of its q-grams, all on diagonals
that lie at most ``k`` apart. So shared q-grams are counted in overlapping bands of diagonals,
bands below that count are dropped, and the rest are aligned within the band. Items too short for
that are looked for as whole words without edits.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.llm import words as W

#: Characters of benchmark text that one broadcast holds; more text takes more passes.
BLOCK_CHARS = 1_000_000

#: Characters that a task looks at together.
CHUNK_CHARS = 1_000_000

WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Bounds:
    """What counts as the same text.

    Segments have ``length`` characters, one starts at every ``step``; an item shorter than
    ``length`` is one segment, one shorter than ``shortest`` has to be there as it is, in whole
    words, and is a reason to drop a document from ``telling`` words on: "the" or a name is reported,
    but is no leak. One edit is allowed for every ``per_edit`` characters. With steps of no more than the
    edits of a segment, an excerpt of ``length`` characters is found wherever it starts.
    """

    length: int = 50
    step: int = 3
    shortest: int = 40
    per_edit: int = 16
    q: int = 12
    telling: int = 4

    def __post_init__(self) -> None:
        if any(self.needed(n) < 1 for n in range(self.shortest, self.length + 1)):
            raise ValueError("the lemma needs one shared q-gram at least; take a smaller q")

    def edits(self, length: int) -> int:
        return length // self.per_edit

    def needed(self, length: int) -> int:
        return length - self.q + 1 - self.edits(length) * self.q


def plain(text: str | None) -> str:
    """Lower-case letters and digits, other characters as single spaces between them."""
    return " ".join(WORD.findall(text.lower())) if text else ""


def segments(item: str, bounds: Bounds) -> list[str]:
    """The segments of a plain item; the last one ends with it."""
    if len(item) < bounds.shortest:
        return []
    last = max(0, len(item) - bounds.length)
    return [item[a : a + bounds.length] for a in (*range(0, last, bounds.step), last)]


def evidence(item: str, bounds: Bounds) -> set[str]:
    """What is looked for of a plain item: its segments, or all of it if it is short."""
    return set(segments(item, bounds)) or ({item} if item else set())


def _codes(text: str) -> np.ndarray:
    return W.mix(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64))


class Index:
    """Places of the q-grams of a block of plain items: one number for each character of them.

    A q-gram of a segment is one of its item, and on the same diagonal but for the segment's start,
    so the item's places serve all its segments.
    """

    def __init__(self, items: list[str], bounds: Bounds) -> None:
        self.items, self.bounds = items, bounds
        lengths = np.array([len(x) for x in items], np.int64)
        self.starts = np.r_[0, np.cumsum(lengths + 1)].astype(np.int32)
        hashes = W.rolling(_codes("\n".join(items)), bounds.q)
        place = np.arange(len(hashes), dtype=np.int32)
        # of q-grams inside one item
        item = np.searchsorted(self.starts, place, "right") - 1
        inside = place + bounds.q <= (self.starts[:-1] + lengths)[item] if len(items) else place < 0
        hashes, place = hashes[inside], place[inside]
        order = np.argsort(hashes, kind="stable")
        self.place = place[order]
        runs = W.starts(hashes[order])
        self.hashes, self.edges = hashes[order][runs], np.r_[runs, len(order)].astype(np.int32)
        # a table of bits by the hash's top ends most lookups at once
        self.shift = np.uint64(64 - max(16, int(len(self.hashes) * 8).bit_length()))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[self.hashes >> self.shift] = True
        sizes = [min(len(x), bounds.length) for x in items]
        self.size = np.array(sizes, np.int64)
        self.edits = np.array([bounds.edits(n) for n in sizes], np.int64)
        self.needed = np.array([bounds.needed(n) for n in sizes], np.int64)

    def memory(self) -> int:
        """Bytes of the arrays."""
        return sum(x.nbytes for x in vars(self).values() if isinstance(x, np.ndarray))

    def candidates(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, segment's start, lowest, highest diagonal) where enough q-grams are shared."""
        grams = W.rolling(_codes(text), self.bounds.q)
        at = np.flatnonzero(self.seen[grams >> self.shift])
        if not len(at) or not len(self.hashes):
            return
        gram = np.searchsorted(self.hashes, grams[at])
        same = self.hashes[np.minimum(gram, len(self.hashes) - 1)] == grams[at]
        at, gram = at[same], gram[same]
        first, n = self.edges[gram].astype(np.int64), np.diff(self.edges)[gram]
        hit = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        place = self.place[hit].astype(np.int64)
        item = np.searchsorted(self.starts, place, "right") - 1
        offset = place - self.starts[item]
        diagonal = np.repeat(at, n) - offset + int(self.starts[-1])  # not below 0
        # bands of 2 (k + 1) diagonals overlap by half: any k + 1 in a row share one
        half = self.edits[item] + 1
        for shift in (0, 1):
            band = (diagonal + shift * half) // (2 * half)
            order = np.lexsort((offset, band, item))
            i, b, o = item[order], band[order], offset[order]
            new = np.r_[True, (i[1:] != i[:-1]) | (b[1:] != b[:-1])][: len(i)]
            distinct = new | np.r_[True, o[1:] != o[:-1]][: len(i)]
            i, b, o, runs = i[distinct], b[distinct], o[distinct], np.flatnonzero(new[distinct])
            shared = np.diff(np.r_[runs, len(i)])
            for k in np.flatnonzero(shared >= self.needed[i[runs]]).tolist():
                which, own = int(i[runs[k]]), o[runs[k] : runs[k] + shared[k]]
                width = int(self.edits[which]) + 1
                low = (2 * int(b[runs[k]]) - shift) * width - int(self.starts[-1])
                for start in self._starts(which, own):
                    yield which, start, low + start, low + start + 2 * width - 1

    def _starts(self, item: int, offsets: np.ndarray) -> list[int]:
        """Starts of an item's segments that hold enough of the sorted offsets of q-grams."""
        last = len(self.items[item]) - int(self.size[item])
        starts = np.unique(np.r_[np.arange(0, last, self.bounds.step), last])
        reach = int(self.size[item]) - self.bounds.q
        n = np.searchsorted(offsets, starts + reach, "right") - np.searchsorted(offsets, starts)
        return starts[n >= self.needed[item]].tolist()


class Phrases:
    """Short items by the number of their words and the hash of these."""

    def __init__(self, found: list[str]) -> None:
        self.numbers = W.WordNumbers()
        self.found: dict[int, dict[int, list[str]]] = {}
        for item in found:
            words = item.split(" ")
            key = int(W.rolling(self._of(words), len(words))[0])
            self.found.setdefault(len(words), {}).setdefault(key, []).append(item)
        self.wanted = {n: np.array(sorted(keys), np.uint64) for n, keys in self.found.items()}

    def _of(self, words: list[str]) -> np.ndarray:
        return self.numbers.of([w.encode("utf-8", "surrogatepass") for w in words])

    def search(self, text: str) -> Iterator[tuple[str, int]]:
        """(item, end of its first place) of the items in a plain text, as whole words."""
        if not self.found or not text:
            return
        words = text.split(" ")
        numbers = self._of(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        for n, keys in self.found.items():
            hashes = W.rolling(numbers, n)
            some, first = np.unique(hashes, return_index=True)
            for k in first[np.isin(some, self.wanted[n])].tolist():
                item = " ".join(words[k : k + n])
                if item in keys[int(hashes[k])]:
                    yield item, int(ends[k + n - 1])


def banded(segment: str, text: str, low: int, high: int, most: int) -> tuple[int, int] | None:
    """(edits, end) of the best alignment of ``segment`` to a part of ``text``, or None.

    The part starts on a diagonal from ``low`` to ``high``; the path leaves that band by at most
    ``most`` diagonals, and has at most ``most`` edits. Rows are the segment's characters; a cell
    is kept for each diagonal of the band.
    """
    low, high = low - most, high + most
    width, never = high - low + 1, most + 1
    # before the first row each start is free; cell d stands at text position row + low + d
    row = [0 if 0 <= low + d <= len(text) else never for d in range(width)]
    for i, letter in enumerate(segment):
        new, left = [], never
        for d in range(width):
            j = i + 1 + low + d
            best = left + 1
            if 1 <= j <= len(text):
                match = row[d] + (text[j - 1] != letter)
                if match < best:
                    best = match
            if 0 <= j <= len(text):
                if d + 1 < width and row[d + 1] + 1 < best:
                    best = row[d + 1] + 1
            else:
                best = never
            left = best if best < never else never
            new.append(left)
        row = new
        if min(row) > most:
            return None
    edits = min(row)
    return (edits, len(segment) + low + row.index(edits)) if edits <= most else None


def _search(items: list[str], bounds: Bounds) -> Callable:
    """doc_id, segment, edits and stop (in the plain text) of all matches, chunk by chunk.

    Tasks are sent the items alone and build the index of these.
    """

    def matches(index: Index, phrases: Phrases, ids: list, texts: list[str]) -> Iterator[tuple]:
        whole = "\n".join(texts)  # no plain text has a line break
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        best: dict[tuple[int, str], tuple[int, int]] = {}
        seen = set()
        for item, first, low, high in index.candidates(whole):
            wanted, most = index.items[item][first : first + index.size[item]], int(index.edits[item])
            if (wanted, low) in seen:
                continue
            seen.add((wanted, low))
            # the band's text, in one or two documents at the joint of two
            a, b = max(0, low - most), high + most + len(wanted)
            for doc in range(
                max(0, int(np.searchsorted(begin, a, "right")) - 1),
                min(len(texts), int(np.searchsorted(begin, b, "right"))),
            ):
                start = max(a, int(begin[doc]))
                part = whole[start : min(b, int(begin[doc + 1]) - 1)]
                at = part.find(wanted)
                if at >= 0:
                    found = (0, at + len(wanted))
                else:
                    found = banded(wanted, part, low - start, high - start, most)
                if found:
                    edits, stop = found[0], found[1] + start - int(begin[doc])
                    key = (doc, wanted)
                    best[key] = min(best.get(key, (edits, stop)), (edits, stop))
        for (doc, segment), (edits, stop) in best.items():
            yield ids[doc], segment, edits, stop
        for doc_id, text in zip(ids, texts, strict=True):
            for item, stop in phrases.search(text):
                yield doc_id, item, 0, stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index([x for x in items if len(x) >= bounds.shortest], bounds)
        phrases = Phrases([x for x in items if 0 < len(x) < bounds.shortest])
        for batch in batches:
            ids, texts, size = [], [], 0
            out: list[tuple] = []
            column = batch.column("text").to_pylist()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), column, strict=True):
                ids.append(doc_id)
                texts.append(plain(text))
                size += len(texts[-1])
                if size >= CHUNK_CHARS:
                    out += matches(index, phrases, ids, texts)
                    ids, texts, size = [], [], 0
            out += matches(index, phrases, ids, texts)
            columns = list(zip(*out)) if out else [[], [], [], []]
            kinds = (batch.schema.field("doc_id").type, pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "segment", "edits", "stop"],
            )

    return run


def _matches(docs: DataFrame, benchmark: DataFrame, bounds: Bounds) -> DataFrame:
    """doc_id, item_id, segment, edits, stop: a row per place where evidence of an item was found."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where("text is not null")
    distinct = items.select("text").distinct()
    total = distinct.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = -(-total // BLOCK_CHARS)
    block = F.pmod(F.xxhash64("text"), F.lit(max(1, n_blocks)))
    texts = docs.select("doc_id", "text").where("text is not null")
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, segment string, edits int, stop int"
    found = spark.createDataFrame([], schema)
    for k in range(n_blocks):
        rows = distinct.where(block == k).collect()
        wanted = sorted({plain(r.text) for r in rows})
        found = found.unionByName(texts.mapInArrow(_search(wanted, bounds), schema))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, pieces = [], []
            for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                own = evidence(plain(text), bounds)
                ids += [item_id] * len(own)
                pieces += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field("item_id").type), pa.array(pieces, pa.string())],
                names=["item_id", "segment"],
            )

    item_type = items.schema["item_id"].dataType.simpleString()
    owners = items.mapInArrow(cut, f"item_id {item_type}, segment string")
    return found.join(owners.distinct(), "segment")


def overlaps(docs: DataFrame, benchmark: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """doc_id, item_id, n_segments, edits, stops: one row per document and item that overlap.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Texts are compared as
    :func:`plain` text. n_segments counts the item's distinct segments found within their edit
    budget, ``edits`` is their least edit distance, ``stops`` says where they end in the plain text;
    it is empty for documents without an id, which may be many texts.
    An item too short for segments counts as one, found without edits, as whole words.

    The benchmark is the query set: its distinct texts are read in blocks of about
    ``BLOCK_CHARS`` characters, each of which is sent to all tasks and compared with every whole
    document; documents are never shuffled. A task makes the index of a block, of less than 40 bytes
    a character.

    Null texts and those without a letter or digit overlap with nothing; an item of one common word
    overlaps with all documents that have it. Rows of equal id, null ids too, count as one
    document or item. Very long texts are searched whole, with those around them. An empty table on
    either side gives an empty result; other columns are left out.
    """
    return (
        _matches(docs, benchmark, bounds)
        .groupBy("doc_id", "item_id")
        .agg(
            F.countDistinct("segment").alias("n_segments"),
            F.min("edits").alias("edits"),
            F.sort_array(F.collect_set(F.when(F.col("doc_id").isNotNull(), F.col("stop")))).alias("stops"),
        )
    )


def _leaked(docs: DataFrame, benchmark: DataFrame, bounds: Bounds) -> DataFrame:
    """doc_id of the documents with evidence that lets them go, once each."""
    words = F.size(F.split("segment", " "))
    enough = (F.length("segment") >= bounds.shortest) | (words >= bounds.telling)
    return _matches(docs, benchmark, bounds).where(enough).select("doc_id").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that overlap with no benchmark item.

    Items of fewer than ``telling`` words let no document go, see :class:`Bounds`. By id, for tables whose ids are unique: a null id can't be told from another one, so if a text
    without id overlaps, all such rows go. :func:`decontaminate_rows` judges each text by itself.
    """
    found = _leaked(docs, benchmark, bounds).withColumnRenamed("doc_id", "found_id")
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(found, F.col("row.doc_id").eqNullSafe(F.col("found_id")), "left_anti").select(
        "row.*"
    )


def decontaminate_rows(docs: DataFrame, benchmark: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text overlaps with no benchmark item.

    Items of fewer than ``telling`` words let no document go, see :class:`Bounds`. Null and repeated ids are no matter: a row goes only for its own text. Rows are told apart by
    two hashes of id and text, so that copies of a text spread over the tasks.
    """
    tagged = docs.select(
        F.struct("*").alias("row"),
        F.xxhash64(F.lit(1), "doc_id", "text").alias("_id"),
        F.xxhash64(F.lit(2), "text", "doc_id").alias("_tie"),
    )
    named = tagged.select(F.struct("_id", "_tie").alias("doc_id"), "row.text")
    found = _leaked(named, benchmark, bounds).select("doc_id._id", "doc_id._tie")
    return tagged.join(found, ["_id", "_tie"], "left_anti").select("row.*")
