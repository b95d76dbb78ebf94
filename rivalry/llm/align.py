"""Alignment of two tokenizers over a corpus, with a fast path for tokens of the same bytes.

Both tokenizers cut a text into tokens whose bytes are the text. Where a token of each ends, a group
ends; the last tokens of a group are linked. An array made beforehand gives for each id of A the id
of B with the same bytes. A group of just these two tokens is *regular*: it is counted in a vector
as long as A's vocabulary. Only the last pairs of other groups are counted as pairs, by a shuffle.

The counts then return to the documents. The vector, the highest count of each id of B, and the
pairs that occur most (a bounded number) are sent to all tasks; other pairs are joined.

Neither tokenizer has a token with a space behind another character, so long texts are cut before
such spaces, and each part is encoded and aligned by itself.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivalry.session import stored

#: The character that pieces have for a space; fixed value.
SPACE = "▁"

#: Characters of text that are encoded together, about.
PART = 500_000

#: Different pairs of a task that are counted before their counts are handed on.
PAIRS = 500_000

#: Pairs of highest count that are sent to all tasks.
FREQUENT = 65_536

#: Where a text may be cut. Both tokenizers start a token at a space with another character before
#: it. Of white space before text the pattern of A leaves the last character to the text; B joins
#: spaces, but no other white space. A space at the end of a text is no part of its own.
_CUT = re.compile(r"(?<=\S)(?= [\s\S])|(?<=[^\S ])(?= \S)")

#: Characters whose class, a letter or not, may depend on the version of Unicode.
_LATE = re.compile("[^\x00-\u024f]")


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it can be printed."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(256 + k): b for k, b in enumerate(others)}


@dataclass
class Pair:
    """Tokenizer A (byte-level, a JSON text) and B (a SentencePiece model), with bytes per id."""

    one: str
    two: bytes
    one_bytes: list[bytes] = field(init=False)
    two_bytes: list[bytes] = field(init=False)
    same: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        import sentencepiece

        letters = _byte_letters()
        spec = json.loads(self.one)
        vocabulary = spec["model"]["vocab"]
        before = spec["pre_tokenizer"] or {}
        if before.get("type") != "ByteLevel" or not before.get("use_regex") or before.get("add_prefix_space"):
            raise ValueError("tokenizer A must be byte-level, split by its usual pattern, without a prefix")
        if spec["normalizer"] is not None:
            raise ValueError("tokenizer A must not change the text")
        special = {t["content"] for t in spec["added_tokens"]}
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        if [vocabulary[m] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("the ids of tokenizer A must follow its merges")
        self.one_bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            if token not in special:
                self.one_bytes[i] = bytes(letters[c] for c in token)
        model = sentencepiece.SentencePieceProcessor(model_proto=self.two)
        self.two_bytes = [b""] * model.vocab_size()
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.two_bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError("a piece of B has a space after another character")
                self.two_bytes[i] = piece.replace(SPACE, " ").encode()
        # of two ids of the same bytes a piece goes before a byte; the other is counted as a pair
        known: dict[bytes, int] = {}
        for i in sorted(range(len(self.two_bytes)), key=model.is_byte):
            known.setdefault(self.two_bytes[i], i)
        self.same = np.array([known.get(b, -1) if b else -1 for b in self.one_bytes], np.int32)

    @classmethod
    def load(cls, one: str, two: str) -> Pair:
        """From files that the driver can read; tasks are sent their content."""
        with open(one, encoding="utf-8") as a, open(two, "rb") as b:
            return cls(a.read(), b.read())


#: The pattern by which byte-level vocabularies of this kind split a text; fixed value.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


class Aligner:
    """Cuts texts by both tokenizers of a pair."""

    def __init__(self, pair: Pair) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.pair = pair
        # the same merges, faster; the slower one knows how A classes late characters
        ranks = {b: i for i, b in enumerate(pair.one_bytes) if b}
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_str(pair.one)
        self.slow.encode_special_tokens = True
        self.two = sentencepiece.SentencePieceProcessor(model_proto=pair.two)
        self.sizes = [np.array(list(map(len, x)), np.int64) for x in (pair.one_bytes, pair.two_bytes)]
        # each id of A with what follows it inside a group and at its end, then each of B
        n_one, n_two = len(pair.one_bytes), len(pair.two_bytes)
        self.written = [
            b"%d%c" % (i, end) for n, ends in ((n_one, b",|"), (n_two, b",;")) for end in ends for i in range(n)
        ]
        self.offsets = np.cumsum([0, n_one, n_one, n_two])

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of A and of B of a text that begins with a space; None if either changes its bytes."""
        if _LATE.search(text):
            a = self.slow.encode(text, add_special_tokens=False).ids
        else:
            a = self.fast.encode_ordinary(text)
        b = self.two.encode(text[1:], num_threads=1)
        plain = text.encode()
        for ids, known in ((a, self.pair.one_bytes), (b, self.pair.two_bytes)):
            parts = list(map(known.__getitem__, ids))
            # an id without bytes of its own is no token of a text
            if b"" in parts or b"".join(parts) != plain:
                return None
        return a, b

    def align(self, text: str) -> tuple | None:
        """n_a, n_b, n_groups, the groups as text, regular ids of A, other pairs; None: other bytes."""
        found = self.encode(text)
        if found is None:
            return None
        a, b = (np.array(ids, np.int64) for ids in found)
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        over = np.zeros(int(ends_a[-1]) + 1, np.int8)
        over[ends_a] += 1
        over[ends_b] += 1
        last_a, last_b = np.flatnonzero(over[ends_a] == 2), np.flatnonzero(over[ends_b] == 2)
        in_a, in_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        final_a, final_b = a[last_a], b[last_b]
        regular = (in_a == 1) & (in_b == 1) & (self.pair.same[final_a] == final_b)
        # place of each token in the written groups: tokens of A, then those of B
        rank_a = np.repeat(np.cumsum(in_b) - in_b, in_a)
        rank_b = np.repeat(np.cumsum(in_a), in_b)
        shift_a, shift_b = np.zeros(len(a), np.int64), np.full(len(b), self.offsets[2])
        shift_a[last_a], shift_b[last_b] = self.offsets[1], self.offsets[3]
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + rank_a] = a + shift_a
        order[np.arange(len(b)) + rank_b] = b + shift_b
        written = b"".join(map(self.written.__getitem__, order.tolist()))
        pairs = final_a[~regular] * len(self.pair.two_bytes) + final_b[~regular]
        return len(a), len(b), len(last_a), written, final_a[regular].astype(np.int32).tobytes(), pairs


def parts(text: str, size: int = PART) -> Iterator[str]:
    """A text, with a space before it, in parts that both tokenizers cut alone as in the whole."""
    text, first = " " + text, 0
    while first < len(text):
        cut = _CUT.search(text, first + size) if len(text) - first > size else None
        last = cut.start() if cut else len(text)
        yield text[first:last]
        first = last


_ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, regular binary,"
    " pairs array<long>, times array<long>"
)


def _documents(pair: Pair) -> Callable:
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()] + [pa.list_(pa.int64())] * 2
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "regular", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document the sizes, the regular ids and the other pairs with their number."""
        aligner, rows, held = Aligner(pair), [], 0

        def row(doc_id: int | None, text: str | None) -> tuple:
            sizes, digest, regular, others = np.zeros(3, np.int64), hashlib.sha256(), [], []
            before = b""
            for part in parts(text) if text else ():
                found = aligner.align(part)
                if found is None:
                    sizes[:] = 0
                    break
                sizes += found[:3]
                # all but the last separator
                digest.update(before + found[3][:-1])
                before = found[3][-1:]
                regular.append(found[4])
                others.append(found[5])
            if not sizes.any():
                return (doc_id, 0, 0, 0, "", b"", [], [])
            codes, times = np.unique(np.concatenate(others), return_counts=True)
            return (doc_id, *sizes.tolist(), digest.hexdigest(), b"".join(regular), codes, times)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                rows.append(row(doc_id.as_py(), text.as_py()))
                held += len(rows[-1][5]) + 16 * len(rows[-1][6])
                if held > 8 * PART or len(rows) >= 10_000:
                    yield batch_of(rows)
                    rows, held = [], 0
        yield batch_of(rows)

    return run


def _regular_counts(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One vector of counts for a task, as (id of A, count)."""
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for row in batch.column("regular"):
                counts += np.bincount(np.frombuffer(row.as_buffer(), np.int32), minlength=size)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], names=["a", "n"])

    return run


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n) of the other pairs, added up as far as a task holds them."""
    codes, counts = [], []

    def added() -> tuple[np.ndarray, np.ndarray]:
        code, at = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.zeros(len(code), np.int64)
        np.add.at(total, at, np.concatenate(counts))
        return code, total

    held = 0
    for batch in batches:
        codes.append(batch.column("pairs").flatten().to_numpy())
        counts.append(batch.column("times").flatten().to_numpy())
        held += len(codes[-1])
        if held > 4 * PAIRS:
            code, total = added()
            codes, counts, held = [code], [total], len(code)
            if held > PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total)], names=["pair", "n"])
                codes, counts, held = [], [], 0
    if held:
        code, total = added()
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total)], names=["pair", "n"])


def _scored(counts: np.ndarray, best: np.ndarray, frequent: tuple[np.ndarray, ...]) -> Callable:
    pairs, pair_counts, pair_best = frequent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """n_best and count_sum by what all tasks have; the pairs they don't have remain."""
        for batch in batches:
            out: list[list] = [[], [], [], []]
            rows = zip(batch.column("regular"), batch.column("pairs"), batch.column("times"), strict=True)
            for regular, codes, times in rows:
                ids = np.frombuffer(regular.as_buffer(), np.int32)
                codes, times = codes.values.to_numpy(), times.values.to_numpy()
                at = np.minimum(np.searchsorted(pairs, codes), max(len(pairs) - 1, 0))
                hit = pairs[at] == codes if len(pairs) else np.zeros(len(codes), bool)
                at, n = at[hit], times[hit]
                out[0].append(int(best[ids].sum() + n @ pair_best[at]))
                out[1].append(int(counts[ids].sum() + n @ pair_counts[at]))
                out[2].append(codes[~hit])
                out[3].append(times[~hit])
            lists = pa.list_(pa.int64())
            keep = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    *(pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), lists, lists), strict=True)),
                ],
                names=[*keep, "n_best", "count_sum", "pairs", "times"],
            )

    return run


def align(docs: DataFrame, pair: Pair, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of ``docs``.

    ``docs`` has doc_id (long) and text. A reads a space and the text, B the text, to which it adds
    the space. A text that is null or empty, or whose bytes one of them changes, has no tokens: its
    numbers are 0, its hash the empty text, and it adds nothing to the counts. groups_sha256 is that
    of ``a1,a2|b1;a3|b2,b3``, ids of A and B by group. A link is the last pair of a group; count_sum
    adds up how often each of a document's links' pairs occurs in all documents, n_best counts the
    links whose pair is the most frequent one of its id of B, ties included. Repeated rows and ids
    are documents of their own; an empty table gives an empty result; other columns play no part.
    Whole texts are read, in parts; a part without a place to cut is encoded whole, however long.
    """
    spark = docs.sparkSession
    n_one, n_two = len(pair.one_bytes), len(pair.two_bytes)
    found = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(_documents(pair), _ALIGNED)
        .select(F.monotonically_increasing_id().alias("row"), "*")
    )
    # the vector of the regular groups, and for each id of B its highest count: as long as vocabularies
    tallied = found.select("regular").mapInArrow(_regular_counts(n_one), "a int, n long")
    counts = np.zeros(n_one, np.int64)
    for a, n in tallied.groupBy("a").agg(F.sum("n")).collect():
        counts[a] = n
    pairs = stored(
        found.select("pairs", "times")
        .mapInArrow(_pair_counts, "pair long, n long")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    top = np.zeros(n_two, np.int64)
    of_two = (F.col("pair") % n_two).cast("int")
    for b, n in pairs.groupBy(of_two.alias("b")).agg(F.max("n")).collect():
        top[b] = n
    some = np.flatnonzero(pair.same >= 0)
    np.maximum.at(top, pair.same[some], counts[some])
    best = np.zeros(n_one, np.int64)
    best[some] = counts[some] == top[pair.same[some]]
    most = pairs.orderBy(F.desc("n"), "pair").limit(frequent).collect()
    codes, n = np.array(sorted((p, n) for p, n in most), np.int64).reshape(-1, 2).T
    known = (codes, n, (n == top[codes % n_two]).astype(np.int64))

    schema = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string,"
        " n_best long, count_sum long, pairs array<long>, times array<long>"
    )
    scored = stored(found.mapInArrow(_scored(counts, best, known), schema))
    rest = scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")
    )
    tops = spark.createDataFrame([(int(b), int(top[b])) for b in np.flatnonzero(top)], "b int, top long")
    # as long as B's vocabulary
    flagged = (
        pairs.withColumn("b", of_two)
        .join(F.broadcast(tops), "b")
        .select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))
    )
    more = (
        rest.join(flagged, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("best")).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return (
        scored.drop("pairs", "times")
        .join(more, "row", "left")
        .select(
            "doc_id",
            "n_a",
            "n_b",
            "n_groups",
            F.col("n_groups").alias("n_links"),
            (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
            "groups_sha256",
        )
    )
