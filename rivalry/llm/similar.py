"""Near-duplicate join on word shingles with MinHash LSH in bands of fixed length.

Every text has one signature of MinHash values per band ("tree"), and texts that agree in all values
of a band share a path. All bands have the same length: the longest with which the chance that a pair
at the threshold shares a path in some band reaches the target recall. Pairs that do are compared
exactly, by their sets of shingles.

Texts of equal sets are one node. Nodes are compared in blocks: a block holds some nodes of one
neighbourhood, and two blocks meet if a band has members in both. A task gets one pair of
blocks and returns, per node, how many texts it is linked to and one link towards its group, so
the pairs of a large group are counted but never written.

The blocks of a large neighbourhood are rings around a pivot, the set of shingles that most of a
sample of it have. The Jaccard distance is a metric: with d the distance to the pivot, two nodes
are linked for certain if d + d' is at most the distance allowed, and not linked if d and d' differ
by more. Pairs of rings of which either holds are not compared; the linked ones are counted by ring.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivalry.llm import words as W
from rivalry.llm.links import components
from rivalry.session import stored

#: Nodes and shingles in a block, on average.
BLOCK, SHINGLES = 512, 200_000

#: Rings as wide as the distance allowed, and nodes whose shingles are counted for a pivot.
RINGS, SAMPLE = 10, 32

#: Columns of a block's 0/1 matrix at a time.
COLUMNS = 8_192


@dataclass(frozen=True)
class Forest:
    """``trees`` bands of up to ``longest`` values each, for Jaccard similarity ``threshold``."""

    width: int = 5
    threshold: float = 0.8
    trees: int = 40
    longest: int = 12
    recall: float = 0.99999

    def expected_recall(self, depth: int) -> float:
        """Chance that a pair at the threshold shares ``depth`` values in one of the trees."""
        return 1 - (1 - self.threshold**depth) ** self.trees

    def depth(self) -> int:
        """The length of all bands: the longest that reaches the target recall."""
        for depth in range(self.longest, 0, -1):
            if self.expected_recall(depth) >= self.recall:
                return depth
        raise ValueError("too few trees for this recall")

    def multipliers(self) -> np.ndarray:
        """Odd 32-bit numbers, one for each value of each tree; the same in every task."""
        numbers = W.mix(np.arange(1, self.trees * self.depth() + 1, dtype=np.uint64))
        return (numbers >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingles(numbers: np.ndarray, width: int) -> np.ndarray:
    """The sorted set of hashes of ``width`` words in a row; a shorter text is one shingle."""
    if not len(numbers):
        return numbers
    return np.unique(W.rolling(numbers, min(width, len(numbers))))


def paths(found: np.ndarray, multipliers: np.ndarray, trees: int) -> np.ndarray:
    """For each tree a hash of the first values of its path, which tells the trees apart."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(multipliers), 0xFFFFFFFF, np.uint32)
    for a in range(0, len(low), 4096):
        values = multipliers[:, None] * low[None, a : a + 4096]
        np.minimum(least, values.min(axis=1), out=least)
    values = least.reshape(trees, -1).astype(np.uint64)
    key = np.arange(1, trees + 1, dtype=np.uint64)
    for level in range(values.shape[1]):
        key = W.mix(key * np.uint64(W.STEP) + values[:, level])
    return key.view(np.int64)


def _sign(forest: Forest) -> Callable:
    multipliers = forest.multipliers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = W.WordNumbers()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column("_id").to_pylist(), W.texts(batch), strict=True):
                found = shingles(numbers.of(W.split(text)), forest.width)
                if not len(found):
                    continue
                digest = xxhash.xxh3_128_digest(found.tobytes())
                out[0].append(doc_id)
                out[1].append(int.from_bytes(digest[:8], "big", signed=True))
                out[2].append(int.from_bytes(digest[8:], "big", signed=True))
                out[3].append(paths(found, multipliers, forest.trees))
                out[4].append(len(found))
            flat = np.concatenate(out[3]) if out[3] else np.empty(0, np.int64)
            offsets = np.arange(len(out[0]) + 1, dtype=np.int32) * forest.trees
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            columns = [pa.array(c, pa.int64()) for c in out[:3]]
            sizes = pa.array(out[4], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, lists, sizes], names=["_id", "h1", "h2", "paths", "size"]
            )

    return run


def linked(a: list[np.ndarray], b: list[np.ndarray], near: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs ``near`` of two lists of sets reach the Jaccard ``threshold``."""
    size_a, size_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    near = near & (np.minimum.outer(size_a, size_b) >= threshold * np.maximum.outer(size_a, size_b))
    pairs = np.argwhere(near)
    shared = np.zeros(near.shape, np.int64)
    if len(pairs) <= 32:
        for i, j in pairs:
            shared[i, j] = np.isin(a[i], b[j], assume_unique=True).sum()
    else:
        some_a, some_b = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
        flat = np.concatenate([*(a[i] for i in some_a), *(b[j] for j in some_b)])
        row = np.repeat(np.arange(len(some_a) + len(some_b)), np.r_[size_a[some_a], size_b[some_b]])
        order = np.argsort(flat)
        flat, row = flat[order], row[order]
        runs = W.starts(flat)
        lengths = np.diff(np.r_[runs, len(flat)])
        column = np.repeat(np.arange(len(runs)), lengths)
        both = np.repeat(lengths > 1, lengths)
        row, column = row[both], np.unique(column[both], return_inverse=True)[1]
        edges = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + 1 + COLUMNS, COLUMNS))
        total = np.zeros((len(some_a), len(some_b)), np.float32)
        for first, last in zip(edges[:-1], edges[1:], strict=True):
            matrix = np.zeros((len(some_a) + len(some_b), COLUMNS), np.float32)
            matrix[row[first:last], column[first:last] % COLUMNS] = 1
            total += matrix[: len(some_a)] @ matrix[len(some_a) :].T
        shared[np.ix_(some_a, some_b)] = np.rint(total).astype(np.int64)
    union = np.add.outer(size_a, size_b) - shared
    # in whole numbers where the threshold allows, so that a similarity of just 0.8 counts
    return near & (shared * 1000 >= round(threshold * 1000) * union)


def _compare(forest: Forest) -> Callable:
    """Pair of blocks by pair of blocks, for rows in that order."""

    def compare(rows: list[tuple], numbers: W.WordNumbers) -> Iterator[tuple]:
        rows = sorted(set(rows))
        first = [r for r in rows if r[0] == 0]
        second = [r for r in rows if r[0] == 1] or first
        sets = [[shingles(numbers.of(W.split(r[2])), forest.width) for r in x] for x in (first, second)]
        trees = [np.array([r[4] for r in x]) for x in (first, second)]
        near = np.array([(trees[1] == path).any(axis=1) for path in trees[0]])
        if second is first:
            near &= np.triu(np.ones(near.shape, bool), 1)
        links = linked(sets[0], sets[1], near, forest.threshold)
        copies = [np.array([r[3] for r in x], np.int64) for x in (first, second)]
        ids = [np.array([r[1] for r in x], np.int64) for x in (first, second)]
        counts, least = [links @ copies[1], links.T @ copies[0]], [ids[0].copy(), ids[1].copy()]
        if second is first:
            counts = [counts[0] + counts[1]] * 2
        # the least node a node is linked with through others of this pair of blocks
        while True:
            before = least[0].sum(), least[1].sum()
            some = links.any(axis=1)
            largest = np.iinfo(np.int64).max
            step = np.where(links, least[1][None, :], largest).min(axis=1, initial=largest)
            least[0] = np.where(some, np.minimum(least[0], step), least[0])
            step = np.where(links, least[0][:, None], largest).min(axis=0, initial=largest)
            least[1] = np.minimum(least[1], step)
            if second is first:
                least = [np.minimum(least[0], least[1])] * 2
            if before == (least[0].sum(), least[1].sum()):
                break
        for side in (0, 1)[: 1 if second is first else 2]:
            for k in np.flatnonzero(counts[side]):
                yield int(ids[side][k]), int(least[side][k]), int(counts[side][k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, pair, rows, out = W.WordNumbers(), None, [], []

        def batch_of(found: list) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [[], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["node", "least", "n"]
            )

        for batch in batches:
            paths_of = np.array(batch.column("paths").values).reshape(-1, forest.trees)
            columns = [batch.column(c).to_pylist() for c in ("one", "two", "side", "node", "n")]
            for k, (one, two, side, node, n, text) in enumerate(
                zip(*columns, W.texts(batch), strict=True)
            ):
                if (one, two) != pair:
                    out += compare(rows, numbers) if rows else []
                    pair, rows = (one, two), []
                rows.append((side, node, text, n, tuple(paths_of[k].tolist())))
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        out += compare(rows, numbers) if rows else []
        yield batch_of(out)

    return run


def _pivot(forest: Forest) -> Callable:
    def run(sample: pa.Table) -> pa.Table:
        """The shingles that more than half of a sample of texts have."""
        numbers = W.WordNumbers()
        sets = [shingles(numbers.of(W.split(t)), forest.width) for t in W.texts(sample)]
        found, counts = np.unique(np.concatenate(sets), return_counts=True)
        pivot = found[2 * counts > len(sets)].view(np.int64)
        return pa.table(
            {"hub": sample.column("hub").slice(0, 1), "pivot": pa.array([pivot], pa.list_(pa.int64()))}
        )

    return run


def _ring(forest: Forest) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """node, hub, ring: how many ring widths a text lies from the pivot of its hub."""
        numbers = W.WordNumbers()
        for batch in batches:
            rings = []
            for text, pivot in zip(W.texts(batch), batch.column("pivot"), strict=True):
                found = shingles(numbers.of(W.split(text)), forest.width)
                pivot = pivot.values.to_numpy().view(np.uint64)
                shared = len(np.intersect1d(found, pivot, assume_unique=True))
                distance = 1 - shared / (len(found) + len(pivot) - shared)
                rings.append(int(distance * RINGS / (1 - forest.threshold)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("hub"), pa.array(rings, pa.int32())],
                names=["node", "hub", "ring"],
            )

    return run


def _rings(homes: DataFrame, texts: DataFrame, forest: Forest) -> DataFrame:
    """node, hub, n, size, ring of the nodes of ``homes``; -1 without a pivot or with several texts.

    Only neighbourhoods of more than one block have a pivot. Any set may be one: the sample
    decides how many pairs are certain, not what is found.
    """
    large = homes.groupBy("hub").agg(F.count(F.lit(1)).alias("nodes"), F.sum("size").alias("sizes"))
    large = large.where((F.col("nodes") > BLOCK) | (F.col("sizes") > SHINGLES)).select("hub")
    members = stored(homes.join(large, "hub").select("node", "hub"))
    first = Window.partitionBy("hub").orderBy(F.xxhash64("node"))
    sample = members.withColumn("k", F.row_number().over(first)).where(F.col("k") <= SAMPLE).drop("k")
    pivots = (
        sample.join(texts, "node")
        .groupBy("hub")
        .applyInArrow(_pivot(forest), "hub long, pivot array<long>")
    )
    found = (
        members.join(texts, "node")
        .join(pivots, "hub")
        .select("node", "hub", "text", "pivot")
        .mapInArrow(_ring(forest), "node long, hub long, ring int")
        .groupBy("node", "hub")
        .agg(F.min("ring").alias("ring"), F.max("ring").alias("most"))
        .select("node", "hub", F.when(F.col("ring") == F.col("most"), F.col("ring")).alias("ring"))
    )
    return homes.join(found, ["node", "hub"], "left").withColumn("ring", F.coalesce("ring", F.lit(-1)))


def _certain(rings: DataFrame) -> DataFrame:
    """node, least, n: what the rings alone tell of links, in the form of the comparisons."""
    tallied = (
        rings.where(F.col("ring").between(0, RINGS - 2))
        .groupBy("hub", "ring")
        .agg(F.sum("n").alias("texts"), F.min("node").alias("least"))
    )
    # at most RINGS - 1 rows for each of a few large neighbourhoods and ring
    inner = tallied.withColumnRenamed("ring", "inner").join(
        tallied.select("hub", "ring"), "hub"
    ).where(F.col("ring") + F.col("inner") + 2 <= RINGS)
    inner = inner.groupBy("hub", "ring").agg(F.sum("texts").alias("texts"), F.min("least").alias("least"))
    own = F.when(2 * F.col("ring") + 2 <= RINGS, F.col("n")).otherwise(0)
    return (
        rings.join(inner, ["hub", "ring"])
        .select("node", "least", (F.col("texts") - own).alias("n"))
        .where("n > 0")
    )


#: Ids that stand for a missing one are taken from the top of the range, by hash of the text.
UNNAMED = "coalesce(cast({id} as long), 9223372036854775807 - pmod(xxhash64(text), 4503599627370496))"


def near_duplicates(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """_id, class_id, n_links, n_copies: one row for each row of ``docs`` (doc_id long, text).

    Shingles are ``width`` words (runs of characters other than ASCII white space) in a row; a
    text with fewer words is one shingle, and one without words, or null, is alone in its class.
    Two texts are linked if the Jaccard similarity of their sets, of 64-bit hashes, reaches the
    threshold. class_id is the least _id that links lead to, n_links the number of other rows
    linked to the row, copies included, n_copies the number of rows with the same set, itself
    included. ``_id`` is doc_id, or for a null one a number near the largest long made from the
    text. Rows of one id share a class. An empty table gives an empty result.

    A pair at the threshold is missed with a chance below 1 - ``recall``, more similar pairs with
    a far smaller one; nothing else drops a pair.
    """
    rows = docs.select(F.expr(UNNAMED.format(id="doc_id")).alias("_id"), "text")
    signed = stored(
        rows.mapInArrow(_sign(forest), "_id long, h1 long, h2 long, paths array<long>, size long")
    )
    sets = signed.groupBy("h1", "h2").agg(F.min("_id").alias("node"), F.count(F.lit(1)).alias("n"))
    members = stored(signed.select("_id", "h1", "h2").join(sets, ["h1", "h2"]))
    nodes = stored(
        sets.withColumnRenamed("node", "_id")
        .join(signed.dropDuplicates(["_id", "h1", "h2"]), ["_id", "h1", "h2"])
        .select(F.col("_id").alias("node"), "n", "h1", "h2", "paths", "size")
    )
    # bands with more than one member
    steps = nodes.select("node", F.explode("paths").alias("path"))
    shared = (
        steps.groupBy("path").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top")
    )
    near = stored(steps.join(shared.select("path", "hub"), "path"))
    # the least neighbour's least neighbour: members of a dense group have one of few
    least = stored(near.groupBy("node").agg(F.min("hub").alias("hub")))
    further = least.select(F.col("node").alias("hub"), F.col("hub").alias("next"))
    homes = least.join(further, "hub").select("node", F.col("next").alias("hub"))
    sizes = nodes.groupBy("node").agg(F.max("n").alias("n"), F.sum("size").alias("size"))
    own_texts = rows.withColumnRenamed("_id", "node")
    rings = stored(_rings(stored(homes.join(sizes, "node")), own_texts, forest))
    parts = rings.groupBy("hub", "ring").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / SHINGLES)).alias("parts")
    )
    blocks = stored(
        rings.join(parts, ["hub", "ring"]).select(
            "node",
            "hub",
            "ring",
            F.xxhash64("hub", "ring", F.pmod(F.xxhash64("node"), "parts")).alias("block"),
        )
    )
    meet = near.select("path", "node").join(blocks, "node").select("path", "block", "hub", "ring").distinct()
    apart = F.abs(F.col("ring") - F.col("ring2")) > RINGS + 1
    linked = F.col("ring") + F.col("ring2") + 2 <= RINGS
    certain = (F.col("hub") == F.col("hub2")) & (F.least("ring", "ring2") >= 0) & (apart | linked)
    pairs = stored(
        meet.withColumnRenamed("block", "one")
        .join(meet.toDF("path", "two", "hub2", "ring2"), "path")
        .where("one <= two")
        .where(~certain)
        .select("one", "two")
        .distinct()
    )
    sides = pairs.select("one", "two", F.lit(0).alias("side"), F.col("one").alias("block")).union(
        pairs.where("one < two").select("one", "two", F.lit(1), F.col("two"))
    )
    # a text of the node's own set; rows of one id may have several
    texts = own_texts.join(
        nodes.join(blocks, "node").select("node", "n", "block", "paths"), "node"
    )
    work = (
        sides.join(texts, "block")
        .select("one", "two", "side", "node", "n", "paths", "text")
        .repartition("one", "two")
        .sortWithinPartitions("one", "two")
    )
    compared = work.mapInArrow(_compare(forest), "node long, least long, n long")
    found = stored(compared.union(_certain(rings)))
    counts = found.groupBy("node").agg(F.sum("n").alias("linked"))
    classes = components(found.select(F.col("node").alias("a"), F.col("least").alias("b")))
    named = (
        members.join(counts, "node", "left")
        .join(classes, "node", "left")
        .groupBy("_id")
        .agg(
            F.min(F.coalesce("component", "node")).alias("class_id"),
            F.max(F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.max("n").alias("n_copies"),
        )
    )
    return rows.select("_id").join(named, "_id", "left").select(
        "_id",
        F.coalesce("class_id", "_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def one_per_class(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """``docs``, with all their columns, one row of each class of near-duplicate texts.

    It is the row of least id, for null ids see :func:`near_duplicates`; of several texts of that
    id the one of least hash. Rows are told apart by a 64-bit hash of id and text, so rows that
    share an id but not the text are judged each by itself; equal rows are one.
    """
    rows = docs.select(
        F.struct("*").alias("row"),
        F.expr(UNNAMED.format(id="doc_id")).alias("named"),
        F.xxhash64(F.lit(1), "doc_id", "text").alias("doc_id"),
        "text",
    )
    classes = near_duplicates(rows.select("doc_id", "text"), forest).select("_id", "class_id").distinct()
    first = F.min(F.struct("named", "_id")).alias("first")
    stay = (
        rows.select("named", F.col("doc_id").alias("_id"))
        .distinct()
        .join(classes, "_id")
        .groupBy("class_id")
        .agg(first)
        .select("first._id")
    )
    return (
        rows.select("row", F.col("doc_id").alias("_id"))
        .join(stay, "_id")
        .dropDuplicates(["_id"])
        .select("row.*")
    )
