"""Spelling variants of words by an index of variable-length grams.

Two words are near if one edit (a code point inserted, deleted or replaced) turns one into the other.

*Dictionary.* A gram of 2 code points is extended as long as it is frequent, up to 4. The dictionary
holds the grams frequent enough to be extended; infrequent ones are pruned, as they are only ends.

*Decomposition.* Every position of a word, with a mark at its end, starts one gram, which ends where
the dictionary stops. A gram depends on nothing but its own code points, so an edit changes just
the grams that lie over it; the others stay, moved by one place if they follow the edit.

*Bound.* ``affected`` is the most grams of a word that lie over one place. Two near words so share
all but ``affected`` of the grams of either, in one order. Of the ``affected`` + 1 rarest grams of
each, at least one is therefore shared: only these enter the index.

*Lists.* A list of the index holds the words with one gram at one place in words of one length. A
word joins its own lists, and as the shorter of a pair the lists of words longer by one, with the
gram at the same place (the edit follows) or one further on (the edit comes first). As the edit
lies on one side of the shared gram, the other side is equal, and of the edited side one half is:
inside a list, words meet only if these parts agree. Words that meet are compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivalry.llm import words as W
from rivalry.session import stored

#: Code points of the shortest and of the longest gram, the mark at the end of a word included.
#: A word of ``MIN_LENGTH`` or more has two grams that do not overlap.
SHORTEST, LONGEST, MIN_LENGTH = 2, 4, 7

#: A gram of more words than this is extended; for large vocabularies the number grows so that
#: the dictionary, which is broadcast, holds at most ``ENTRIES`` grams.
FREQUENT, ENTRIES = 100, 100_000

#: A gram of more words has no lists of its own: its words are listed by the parts that must agree.
HOT = 50_000

#: Rows of lists that a task takes together.
TOGETHER = 200_000

#: Pairs of words that a task compares together.
MEETINGS = 2_000_000

#: Marks the end of a word; no letter.
END = "\x00"

#: Longest word that is compared in a matrix.
WIDTH = 64

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def count_words(docs: DataFrame, noise: int = 31) -> DataFrame:
    """word, n: runs of Latin letters in ``docs`` (doc_id, text) of 7 code points or more, n >= 2.

    Runs are ``[A-Za-z\\u00C0-\\u00FF]+`` of the whole text, with A-Z in lower case. A run loses one
    code point if ``noise`` divides the crc32 of ``<doc_id>:<run>``, the one at that number modulo
    the length; a null doc_id counts as the empty text. Null and empty texts have no runs.
    """
    # a run of fewer letters stays too short, with or without that loss
    runs = F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0))
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run")
    ).select("doc", F.translate("run", _LETTERS, _LETTERS.lower()).alias("run"))
    number = F.crc32(F.encode(F.concat("doc", F.lit(":"), "run"), "UTF-8"))
    lost = F.pmod(number, F.length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, lost)"), F.expr("substring(run, lost + 2)"))
    return (
        found.withColumn("number", number)
        .withColumn("lost", lost)
        .select(F.when(F.col("number") % noise == 0, cut).otherwise(F.col("run")).alias("word"))
        .where(F.length("word") >= MIN_LENGTH)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n >= 2")
    )


def dictionary(words: DataFrame) -> dict[str, int]:
    """The grams to extend, with the number of places they have in ``words`` (word).

    At most :data:`ENTRIES`, as all places together are no more than that times the least number.
    """
    marked = F.concat("word", F.lit(END))

    def grams_of(size: int) -> Column:
        places = F.sequence(F.lit(1), F.length(marked) - (size - 1))
        return F.transform(places, lambda k: F.substring(marked, k, F.lit(size)))

    grams = [grams_of(size) for size in range(SHORTEST, LONGEST + 1)]
    places = words.agg(F.sum(F.length("word"))).first()[0] or 0
    least = max(FREQUENT, len(grams) * places // ENTRIES)
    counts = words.select(F.explode(F.concat(*grams)).alias("gram")).groupBy("gram").count()
    return dict(map(tuple, counts.where(F.col("count") > least).collect()))


def decompose(word: str, frequent: dict[str, int]) -> list[tuple[int, int]]:
    """(start, end) of the gram at each place of a word; an end beyond the word includes its mark."""
    text = word + END
    out = []
    for start in range(len(text) - SHORTEST + 1):
        end, most = start + SHORTEST, min(start + LONGEST, len(text))
        while end < most and text[start:end] in frequent:
            end += 1
        out.append((start, end))
    return out


def affected(grams: list[tuple[int, int]]) -> int:
    """The most grams that lie over one place: how many one edit can change."""
    # starts and ends both rise, as a gram and its tail are extended alike
    depth = most = first = 0
    ends = sorted(end for _, end in grams)
    for start, _ in grams:
        depth += 1
        while ends[first] <= start:
            depth -= 1
            first += 1
        most = max(most, depth)
    return most


def rarest(word: str, frequent: dict[str, int]) -> list[tuple[int, int, int]]:
    """(start, end, number) of the ``affected`` + 1 grams of a word that come first.

    The order is the same for all words: by number of places, 0 if not in the dictionary, then by
    gram, then by place.
    """
    text, grams = word + END, decompose(word, frequent)
    ordered = sorted((frequent.get(g := text[s:e], 0), g, s, e) for s, e in grams)
    return [(s, e, n) for n, _, s, e in ordered[: affected(grams) + 1]]


def _list_key(gram: str, place: int, length: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{place},{length},{gram}")


class Parts:
    """Hashes of parts of words, all from one sum over their code points."""

    #: Multiplier of each code point's weight, and its inverse modulo 2^64.
    step = W.STEP
    inverse = pow(W.STEP, -1, 2**64)

    def __init__(self, words: list[str]) -> None:
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.r_[0, np.cumsum(self.lengths)]
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        powers = np.full(len(codes) + 1, self.step, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self.sums = np.r_[np.uint64(0), np.cumsum(W.mix(codes.astype(np.uint64) + np.uint64(1)) * powers[:-1])]
        self.back = np.full(len(codes) + 1, self.inverse, np.uint64)
        self.back[0] = 1
        np.cumprod(self.back, out=self.back)

    def of(self, word: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of code points ``first`` to ``last`` of words, given by their numbers."""
        a, b = self.starts[word] + first, self.starts[word] + last
        return W.mix((self.sums[b] - self.sums[a]) * self.back[a] + (last - first).astype(np.uint64))

    def agreements(self, key, word, start, end, role) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, number, kind): what of a word must agree with its partner's, hashed with the key.

        ``role`` is 0 for words in their own list, 1 and 2 for the shorter of a pair that differ by
        an insertion behind the gram and before it. The rows of role 0 have kinds 1 to 4 for partners
        of their length, and 5 to 8, as the longer ones, for partners of the other roles.
        """
        length = self.lengths[word]
        marked = end > length
        left, right = start, np.where(marked, 0, length - end)
        end, zero = np.minimum(end, length), np.zeros(len(word), np.int64)
        rows, numbers, kinds = [], [], []

        def add(kind, chosen, a, b, c, d) -> None:
            """The parts a..b and c..d of the chosen rows agree."""
            at = np.flatnonzero(chosen)
            one, two = self.of(word[at], a[at], b[at]), self.of(word[at], c[at], d[at])
            rows.append(at)
            mixed = one * np.uint64(W.STEP) + two + key[at] * np.uint64(2 * kind + 1)
            numbers.append(W.mix(mixed ^ np.uint64(kind)))
            kinds.append(np.full(len(at), kind, np.int8))

        own = role == 0
        half = right // 2
        behind = own & (right > 0)
        add(1, behind, zero, left, end, end + half)
        add(2, behind, zero, left, end + half, length)
        half = left // 2
        before = own & (left > 0)
        add(3, before, zero, half, end, length)
        add(4, before, half, start, end, length)
        shorter = (role == 1) & ~marked
        half = right // 2
        add(5, shorter, zero, left, end, end + half)
        add(6, shorter, zero, left, end + half, length)
        half = (right - 1) // 2
        add(5, behind, zero, left, end, end + half)
        add(6, behind, zero, left, end + half + 1, length)
        half = left // 2
        add(7, role == 2, zero, half, end, length)
        add(8, role == 2, half, start, end, length)
        half = (left - 1) // 2
        add(7, before, zero, half, end, length)
        add(8, before, half + 1, start, end, length)
        return np.concatenate(rows), np.concatenate(numbers), np.concatenate(kinds)


def _list_rows(frequent: dict[str, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each list that a word joins."""
        for batch in batches:
            words = batch.column("word").to_pylist()
            n = batch.column("n").to_numpy()
            keys, rows, hot = [], [], []
            for k, word in enumerate(words):
                text = word + END
                for start, end, number in rarest(word, frequent):
                    gram, length = text[start:end], len(word)
                    for role, place, size in (
                        (0, start, length),
                        (1, start, length + 1),
                        (2, start + 1, length + 1),
                    ):
                        if role == 1 and end > length:
                            continue
                        keys.append(_list_key(gram, place, size))
                        rows.append((k, start, end, role))
                        hot.append(number > HOT)
            key = np.array(keys, np.uint64)
            word, start, end, role = np.array(rows, np.int64).reshape(-1, 4).T
            hot = np.array(hot, bool)
            at = np.flatnonzero(~hot)
            if hot.any():
                some = np.flatnonzero(hot)
                found, numbers, _ = Parts(words).agreements(
                    key[some], word[some], start[some], end[some], role[some]
                )
                at, key = np.r_[at, some[found]], np.r_[key[at], numbers]
            else:
                key = key[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    batch.column("word").take(pa.array(word[at])),
                    pa.array(n[word[at]]),
                    pa.array(start[at].astype(np.int32)),
                    pa.array(end[at].astype(np.int32)),
                    pa.array(role[at].astype(np.int8)),
                ],
                names=["key", "word", "n", "start", "end", "role"],
            )

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns one word into the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, x in enumerate(a) if x != b[i]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def _verified(words: list[str], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which of the pairs of words are one edit apart; ``two`` is the longer if lengths differ."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    good = np.zeros(len(one), bool)
    long = lengths[two] > WIDTH
    for k in np.flatnonzero(long):
        good[k] = one_edit(words[one[k]], words[two[k]])
    width = int(min(lengths.max(initial=1), WIDTH))
    matrix = np.array([w[:width] for w in words], f"<U{width}").view(np.uint32).reshape(len(words), width)
    columns = np.arange(width)
    for some in np.array_split(np.flatnonzero(~long), max(1, len(one) // 50_000)):
        a, b = matrix[one[some]], matrix[two[some]]
        differ = a != b
        first = np.argmax(differ, axis=1)
        equal = lengths[one[some]] == lengths[two[some]]
        replaced = equal & (differ.sum(axis=1) == 1)
        moved = (a[:, :-1] != b[:, 1:]) & (columns[:-1] >= first[:, None])
        inserted = ~equal & differ.any(axis=1) & ~moved.any(axis=1)
        good[some] = replaced | inserted
    return good


def _meetings(number: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions with equal numbers, some millions at a time: side 0 with 2, 1 with 1."""
    order = np.lexsort((side, number))
    number, side = number[order], side[order]
    first = W.starts(number)
    size = np.diff(np.r_[first, len(number)])
    run = np.repeat(np.arange(len(first)), size)
    at = np.arange(len(number))
    end = (first + size)[run]
    # side 0 meets those of side 2 at the end of its run, side 1 those after it
    shorter = np.add.reduceat((side == 0).astype(np.int64), first) if len(first) else first
    begin = np.where(side == 0, (first + shorter)[run], np.where(side == 1, at + 1, end))
    count = end - begin
    total = np.cumsum(count)
    low = 0
    while low < len(at):
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + MEETINGS, "right")))
        some = count[low:high]
        one = np.repeat(at[low:high], some)
        offset = np.arange(len(one)) - np.repeat(np.cumsum(some) - some, some)
        yield order[one], order[np.repeat(begin[low:high], some) + offset]
        low = high


def _merge(key, words, n, start, end, role) -> list[tuple]:
    """(word, n, other, other_n) of near words in whole lists."""
    parts = Parts(words)
    row, number, kind = parts.agreements(key, np.arange(len(words)), start, end, role)
    side = np.where(kind <= 4, 1, np.where(role[row] == 0, 2, 0))
    _, names = np.unique(words, return_inverse=True)
    found, seen = [], np.empty(0, np.int64)
    for one, two in _meetings(number, side):
        one, two = row[one], row[two]
        able = names[one] != names[two]
        one, two = one[able], two[able]
        # the same two words may meet by several parts
        code = np.minimum(names[one], names[two]) * len(words) + np.maximum(names[one], names[two])
        code, once = np.unique(code, return_index=True)
        new = ~np.isin(code, seen, assume_unique=True)
        one, two = one[once[new]], two[once[new]]
        good = _verified(words, one, two)
        seen = np.r_[seen, code[new][good]]
        found += [(words[a], n[a], words[b], n[b]) for a, b in zip(one[good].tolist(), two[good].tolist())]
    return found


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of lists, for rows in order of the list."""

    def merged(table: pa.Table) -> pa.RecordBatch:
        get = {name: table.column(name).to_numpy() for name in ("key", "start", "end", "role")}
        found = _merge(
            get["key"].view(np.uint64),
            table.column("word").to_pylist(),
            table.column("n").to_pylist(),
            get["start"].astype(np.int64),
            get["end"].astype(np.int64),
            get["role"],
        )
        a, a_n, b, b_n = zip(*found) if found else ([], [], [], [])
        # both directions
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a + b, pa.string()) if found else pa.array([], pa.string()),
                pa.array(b + a, pa.string()) if found else pa.array([], pa.string()),
                pa.array(b_n + a_n, pa.int64()) if found else pa.array([], pa.int64()),
            ],
            names=["word", "other", "other_n"],
        )

    waiting: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= TOGETHER:
            table = pa.Table.from_batches(waiting).combine_chunks()
            keys = table.column("key").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))
            if whole:
                yield merged(table.slice(0, whole))
            waiting = table.slice(whole).to_batches()
            rows -= whole
    if waiting:
        yield merged(pa.Table.from_batches(waiting).combine_chunks())


def near_words(words: DataFrame) -> DataFrame:
    """word, other, other_n: every two near words of ``words`` (word, n), in both directions, once.

    Words must be distinct and have :data:`MIN_LENGTH` code points or more.
    """
    frequent = dictionary(words)
    rows = words.mapInArrow(
        _list_rows(frequent), "key long, word string, n long, start int, end int, role byte"
    )
    lists = rows.repartition("key").sortWithinPartitions("key")
    return lists.mapInArrow(_near, "word string, other string, other_n long").distinct()


def group(docs: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n: the words of :func:`count_words` with their usual form.

    n_near is the number of near words; form is the near word of largest n, ties by code points, if
    it has at least ``ratio`` times the word's n, and form_n its n, else both are null; root is the
    end of the chain of forms, the word itself if it has none. An empty table, or one without such
    words, gives no rows; repeated rows count as often as they occur. Other columns play no part.
    """
    words = stored(count_words(docs))
    # the greatest n, then the least word
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    chosen = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    form = F.when(-F.col("best.n") >= ratio * F.col("n"), F.col("best.word"))
    formed = stored(
        words.join(chosen, "word", "left").select(
            "word",
            form.alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(form.isNotNull(), -F.col("best.n")).alias("form_n"),
        )
    )
    # n grows with each form, so chains end; each round doubles the part followed
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = roots.join(further, "root", "left")
        if joined.where("next is not null").isEmpty():
            break
        roots = stored(joined.select("word", F.coalesce("next", "root").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
