"""Removal of passages that repeat an earlier one, found by fixed-block anchors.

Each document is cut into non-overlapping blocks of ``window / 2`` words; these are the index.
Every rolling window of that many words probes it. A repeat of ``window`` words contains a whole
block of its earlier place, so a hit stands within reach of each of its words: hits are extended to
the left and right to all ``window``-word sequences around them, which are compared with each
other as a whole. The maximal runs of words in sequences that also start earlier are removed.

Work moves between tasks in bundles. A task reads a chunk of documents and sends, for each bucket
of the hash space, one row of packed arrays, in which a hash occurs once however often the chunk
holds it. So a passage that a third of all rows share costs one entry per chunk. Pairs of
documents are never formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.llm import words as W

#: Words of a chunk, which bounds a task's memory, and of a bucket, on average.
CHUNK_WORDS = 1_000_000
BUCKET_WORDS = 1_000_000

#: Id that a null id is ordered by, after all others.
LAST = np.iinfo(np.int64).max

#: Kinds of packed rows: hash entries, places found within the chunk, documents of the chunk.
ENTRIES, PLACES, DIRECTORY = 0, 1, 2

PACKED = "bucket long, chunk long, kind int, a binary, b binary, c binary, d binary"
FOUND = "chunk long, kind int, a binary, b binary, c binary, d binary"
MARKS = "_id long, _tie long, places binary"


def _chunks(
    batches: Iterator[pa.RecordBatch], width: int, chunk_words: int, *more: str
) -> Iterator[tuple]:
    """(ids, ties, first word of each document, word numbers, more columns) per chunk.

    Documents are in order of (id, tie); those that repeat both are taken once, and those with
    fewer than ``width`` words are left out.
    """
    numbers = W.WordNumbers()

    def chunk(rows: dict) -> tuple:
        keys = sorted(rows)
        parts = [rows[k][0] for k in keys]
        ends = np.cumsum([len(p) for p in parts])
        ids, ties = np.array(keys, np.int64).reshape(-1, 2).T
        first = np.r_[0, ends]
        return ids.copy(), ties.copy(), first, np.concatenate(parts), [rows[k][1:] for k in keys]

    rows, size = {}, 0
    for batch in batches:
        ids, ties = batch.column("_id").to_pylist(), batch.column("_tie").to_pylist()
        rest = [batch.column(name).to_pylist() for name in more]
        for row, (key, text) in enumerate(zip(zip(ids, ties), W.texts(batch))):
            split = W.split(text)
            if len(split) < width or key in rows:
                continue
            rows[key] = (numbers.of(split), *(column[row] for column in rest))
            size += len(split)
            if size >= chunk_words:
                yield chunk(rows)
                rows, size = {}, 0
    if rows:
        yield chunk(rows)


def _whole(first: np.ndarray, width: int) -> np.ndarray:
    """Word indexes at which a window of ``width`` words stays within its document."""
    inside = np.ones(first[-1], bool)
    for back in range(1, width):
        at = first[1:] - back
        inside[at[at >= 0]] = False
    return np.flatnonzero(inside)


def _bundles(bucket: np.ndarray, n_buckets: int) -> Iterator[tuple[int, slice]]:
    """(bucket, slice) of an array of bucket numbers in order."""
    edges = np.searchsorted(bucket, np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), slice(edges[b], edges[b + 1])


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as differences, byte by byte; rising ones shrink in the shuffle."""
    steps = np.diff(numbers.astype(np.int64), prepend=0).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(packed, np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0]
    return np.cumsum(steps, dtype=np.uint32).astype(np.int64)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _unbits(packed: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=count).astype(bool)


def _frame(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def _number(ids: np.ndarray, ties: np.ndarray) -> int:
    """The same for chunks of the same documents only, however often a task runs."""
    return xxhash.xxh3_64_intdigest(ids.tobytes() + ties.tobytes()) >> 1


def _own(chunk: int, places, ids, ties, first, n_buckets: int) -> list[tuple]:
    """Rows that pass by the buckets: places found within the chunk, and its documents."""
    own = n_buckets + chunk % n_buckets
    return [
        (own, chunk, PLACES, _pack(places), None, None, None),
        (own, chunk, DIRECTORY, ids.tobytes(), ties.tobytes(), _pack(first), None),
    ]


def _probes(block: int, n_buckets: int, chunk_words: int) -> Callable:
    """Chunk by chunk: every rolling window's hash, with a flag for the blocks of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ties, first, numbers, _ in _chunks(batches, 2 * block, chunk_words):
            hashes = W.rolling(numbers, block)
            at = _whole(first, block)
            at = at[at < len(hashes)]
            begin = np.repeat(first[:-1], np.diff(first))
            aligned = (at - begin[at]) % block == 0
            hashes = hashes[at]
            order = np.argsort(hashes)
            hashes, at, aligned = hashes[order], at[order], aligned[order]
            runs = W.starts(hashes)
            lengths = np.diff(np.r_[runs, len(hashes)])
            indexed = np.maximum.reduceat(aligned, runs)
            single = lengths == 1
            bucket = (hashes[runs] >> np.uint64(32)) % np.uint64(n_buckets)
            order = np.lexsort((at[runs], bucket))
            bucket, picked = bucket[order], runs[order]
            indexed, single_run = indexed[order], single[order]
            chunk = _number(ids, ties)
            # 32 bits beside the bucket: false hits, a few in 100,000, are sorted out later
            rows = [
                (
                    b,
                    chunk,
                    ENTRIES,
                    (hashes[picked[s]] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                    _bits(indexed[s]),
                    _bits(single_run[s]),
                    _pack(at[picked[s]]),
                )
                for b, s in _bundles(bucket, n_buckets)
            ]
            again = np.sort(at[np.repeat(~single, lengths)])
            yield _frame(rows + _own(chunk, again, ids, ties, first, n_buckets), PACKED)

    return run


def _hits(bundle: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the places whose hash is in the index and occurs in another chunk too."""
    passed = bundle[bundle.kind != ENTRIES]
    entries = bundle[bundle.kind == ENTRIES]
    out = [passed.drop(columns="bucket")]
    if len(entries) > 1:
        hashes = [np.frombuffer(x, np.uint32) for x in entries.a]
        counts = [len(x) for x in hashes]
        chunk = np.repeat(np.arange(len(counts)), counts)
        hashes = np.concatenate(hashes)
        flag = lambda column: np.concatenate(
            [_unbits(x, n) for x, n in zip(entries[column], counts, strict=True)]
        )
        indexed, single = flag("b"), flag("c")
        at = np.concatenate([_unpack(x) for x in entries.d])
        order = np.argsort(hashes)
        runs = W.starts(hashes[order])
        lengths = np.diff(np.r_[runs, len(order)])
        known = np.maximum.reduceat(indexed[order], runs)
        hit = order[np.repeat(known & (lengths > 1), lengths)]
        hit = np.sort(hit[single[hit]])
        out += _returned(entries, chunk[hit], at[hit])
    return pd.concat(out)


def _returned(entries: pd.DataFrame, chunk: np.ndarray, at: np.ndarray) -> list[pd.DataFrame]:
    """Places that go back to their chunks; ``chunk`` has row numbers of ``entries``, rising."""
    numbers = entries.chunk.to_numpy()
    edges = np.searchsorted(chunk, np.arange(len(numbers) + 1))
    rows = [
        (numbers[k], PLACES, _pack(at[edges[k] : edges[k + 1]]), None, None, None)
        for k in np.flatnonzero(np.diff(edges))
    ]
    return [pd.DataFrame(rows, columns=["chunk", "kind", "a", "b", "c", "d"])] if rows else []


def _by_document(found: pd.DataFrame) -> pd.DataFrame:
    """Of one chunk: the places hit in each document, as word indexes within it."""
    directory = found[found.kind == DIRECTORY].iloc[0]
    ids, ties = np.frombuffer(directory.a, np.int64), np.frombuffer(directory.b, np.int64)
    first = _unpack(directory.c)
    at = np.sort(np.concatenate([_unpack(x) for x in found[found.kind == PLACES].a]))
    edges = np.searchsorted(at, first)
    docs = np.flatnonzero(np.diff(edges))
    places = [_pack(at[edges[d] : edges[d + 1]] - first[d]) for d in docs]
    return pd.DataFrame({"_id": ids[docs], "_tie": ties[docs], "places": places})


def _sequences(window: int, n_buckets: int, chunk_words: int) -> Callable:
    """Chunk by chunk: the whole sequences within reach of a hit, by hash.

    Sequences that start again within the chunk are known to repeat; the chunk's first goes on.
    """
    reach = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ties, first, numbers, more in _chunks(batches, window, chunk_words, "hits"):
            wanted = np.zeros(len(numbers) + 1, np.int32)
            for doc, (bundles,) in enumerate(more):
                hits = np.concatenate([_unpack(x) for x in bundles]) + first[doc]
                np.add.at(wanted, np.maximum(hits - reach, first[doc]), 1)
                np.add.at(wanted, hits + 1, -1)
            hashes = W.rolling(numbers, window)
            at = _whole(first, window)
            at = at[np.cumsum(wanted[:-1])[at] > 0]
            doc = np.searchsorted(first, at, "right") - 1
            hashes = hashes[at]
            order = np.lexsort((at, hashes))
            hashes, at, doc = hashes[order], at[order], doc[order]
            runs = W.starts(hashes)
            later = np.ones(len(at), bool)
            later[runs] = False
            bucket = (hashes[runs] >> np.uint64(32)) % np.uint64(n_buckets)
            order = np.lexsort((at[runs], bucket))
            bucket, picked = bucket[order], runs[order]
            chunk = _number(ids, ties)
            rows = _own(chunk, np.sort(at[later]), ids, ties, first, n_buckets)
            for b, s in _bundles(bucket, n_buckets):
                some = picked[s]
                own, count = np.unique(doc[some], return_counts=True)
                listed = np.column_stack([ids[own], ties[own], first[own], count])
                packed = (hashes[some].tobytes(), listed.tobytes(), _pack(at[some]), None)
                rows.append((b, chunk, ENTRIES, *packed))
            yield _frame(rows, PACKED)

    return run


def _later(bundle: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the places of all sequences but the first of each hash."""
    passed = bundle[bundle.kind != ENTRIES]
    entries = bundle[bundle.kind == ENTRIES]
    out = [passed.drop(columns="bucket")]
    if len(entries) > 1:
        hashes = [np.frombuffer(x, np.uint64) for x in entries.a]
        chunk = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
        hashes = np.concatenate(hashes)
        listed = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 4) for x in entries.b])
        ids, ties, first = np.repeat(listed[:, :3], listed[:, 3], axis=0).T
        at = np.concatenate([_unpack(x) for x in entries.c])
        place = at - first
        order = np.lexsort((place, ties, ids, hashes))
        runs = W.starts(hashes[order])
        origin = order[np.repeat(runs, np.diff(np.r_[runs, len(order)]))]
        # a row read twice is the same place, not a later one
        same = (ids[order] == ids[origin]) & (ties[order] == ties[origin])
        later = np.sort(order[~same | (place[order] != place[origin])])
        out += _returned(entries, chunk[later], at[later])
    return pd.concat(out)


RESULT = "doc_id long, n_words long, spans array<struct<start:int,stop:int>>, kept_text string"


def _cut(window: int) -> Callable:
    """Documents without the words that the marked sequences cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            ids, marked = batch.column("doc_id").to_pylist(), batch.column("marks").to_pylist()
            for doc_id, text, bundles in zip(ids, W.texts(batch), marked, strict=True):
                split = W.split(text)
                spans: list = []
                kept = split
                if bundles:
                    at = np.concatenate([_unpack(x) for x in bundles])
                    depth = np.zeros(len(split) + 1, np.int32)
                    np.add.at(depth, at, 1)
                    np.add.at(depth, at + window, -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    spans = [{"start": a, "stop": b} for a, b in W.spans(gone)]
                    kept = [split[i] for i in np.flatnonzero(~gone)]
                for column, value in zip(
                    out, (doc_id, len(split), spans, b" ".join(kept)), strict=True
                ):
                    column.append(value)
            span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out[0], pa.int64()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], span),
                    pa.array(out[3], pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "spans", "kept_text"],
            )

    return run


def remove_repeats(
    docs: DataFrame,
    window: int = 20,
    chunk_words: int = CHUNK_WORDS,
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """doc_id, n_words, spans, kept_text for each row of ``docs`` (doc_id long, text).

    Words are runs of characters other than ASCII white space. A word goes if it is in a sequence
    of ``window`` words of one document that also starts earlier: in a document of smaller id, or
    further ahead in the same one. ``spans`` are the maximal runs of words removed (from start up
    to stop), ``kept_text`` is the rest, joined by single spaces. Sequences are compared by 64-bit
    hash. ``window`` must be even.

    A null text counts as no words. Null ids come after all others; texts of one id are ordered
    by hash; rows that repeat id and text count as one document, and each gets its result. An
    empty table gives an empty result; other columns are left out.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be even")
    rows = docs.select(
        "doc_id",
        "text",
        F.coalesce("doc_id", F.lit(LAST)).alias("_id"),
        F.xxhash64(F.lit(8), "text").alias("_tie"),
    )
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    # a word has six letters or so
    n_buckets = max(16, size // (6 * bucket_words))
    key = ["_id", "_tie"]
    probed = rows.select(*key, "text").mapInArrow(_probes(window // 2, n_buckets, chunk_words), PACKED)
    found = probed.groupBy("bucket").applyInPandas(_hits, FOUND)
    hits = found.groupBy("chunk").applyInPandas(_by_document, MARKS)
    hits = hits.groupBy(*key).agg(F.collect_list("places").alias("hits"))
    # both joins read one exchange of the texts
    near = rows.join(hits, key)
    packed = near.mapInArrow(_sequences(window, n_buckets, chunk_words), PACKED)
    later = packed.groupBy("bucket").applyInPandas(_later, FOUND)
    marks = later.groupBy("chunk").applyInPandas(_by_document, MARKS)
    marks = marks.groupBy(*key).agg(F.collect_list("places").alias("marks"))
    return rows.join(marks, key, "left").mapInArrow(_cut(window), RESULT)
