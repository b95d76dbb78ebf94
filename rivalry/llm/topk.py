"""Exact top-k search by inner product, with the kth score located in global histograms.

Every query is scored against every row, in cells of one block of queries and one block of rows that
a task holds as two matrices. No cell returns scores. First each returns, per query, how many of
its scores fall into which interval; the sums over all cells tell in which interval the kth score of
a query lies, and the next pass divides that interval, until it is one value. Only then a last pass
returns rows: those above the kth value, fewer than k for each query, and of those that equal it the
ones of least id, as many as are missing.

The kth score of all rows is at least that of any one cell, so a cell need not report intervals
below its own kth score: at most k counts per query and cell are shuffled, however many rows tie.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivalry.session import stored

#: Intervals into which a pass divides the range of a query.
BINS = 512

#: Most rows and most queries of a cell; their matrices and one slice of scores fit into a task.
ROWS, QUERIES = 32_768, 16_384

#: Rows of a cell where there are few, so that all cores have some.
LEAST = 1_024

#: Scores in work at a time.
SCORES = 4_000_000

LOWEST, HIGHEST = -(2**63), 2**63 - 1


def quantised(column: str, scale: float) -> Column:
    """floor(scale * x) of each component as long; null for a vector that takes no part."""
    finite = F.forall(column, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(math.inf)))
    numbers = F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.when(finite, numbers)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: float = 256, bins: int = BINS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for each query.

    ``vectors`` has vec_id (long) and embedding (array); the rows for which ``queries`` holds are
    the queries, all others are candidates of each. A component counts as floor(scale * x), x as
    double, and the score is the inner product, a long; a shorter vector has zeros at its end. Best
    is the highest score, then the least vec_id, a null one last. Vectors that are null or have a
    null or non-finite component are neither queries nor candidates. A row is no candidate of
    itself, but rows that repeat an id are rows of their own, as queries too. A query with fewer
    than ``k`` candidates gets them all, one with none no row; an empty table gives none. Scores
    beyond a long count as the nearest long. Other columns play no part.
    """
    table = stored(
        vectors.select(
            "vec_id",
            quantised("embedding", scale).alias("vec"),
            F.coalesce(queries, F.lit(False)).alias("asks"),
        )
        .where("vec is not null")
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "vec", "asks")
    )
    squares = F.aggregate("vec", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    count, asking, longest = table.agg(
        F.count(F.lit(1)), F.count_if("asks"), F.max(F.sqrt(squares))
    ).first()
    parallel = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(math.ceil(count / ROWS), min(parallel, math.ceil(count / LEAST)), 1)
    groups = max(math.ceil(asking / QUERIES), 1)
    candidates = table.select(
        "row",
        "vec_id",
        "vec",
        F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )
    asked = stored(table.where("asks").select("row", F.col("vec_id").alias("query_id"), "vec"))
    # |score| is at most the product of the norms, rounded up
    bound = F.ceil(F.sqrt(squares) * F.lit(float(longest or 0)) * 1.000001 + 1)
    state = stored(
        asked.select(
            "row",
            F.greatest(-bound, F.lit(LOWEST)).cast("long").alias("low"),
            F.least(bound, F.lit(HIGHEST)).cast("long").alias("high"),
            F.lit(k).cast("long").alias("need"),
        )
    )

    def cells(state: DataFrame):
        """Each block of queries, with where their kth score lies, beside each block of rows."""
        return (
            asked.join(state, "row")
            .withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
            .groupBy("group", "block")
            .cogroup(candidates.groupBy("group", "block"))
        )

    while not (wide := state.where("low < high")).isEmpty():
        counts = cells(wide).applyInArrow(_histogram(bins), "row long, low long, high long, n long")
        totals = counts.groupBy("row", "low", "high").agg(F.sum("n").alias("n"))
        state = stored(_narrowed(totals, wide.select("row", "need")).union(state.where("low = high")))
    rows = cells(state).applyInArrow(_best, "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (
        rows.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _narrowed(totals: DataFrame, needs: DataFrame) -> DataFrame:
    """row, low, high, need: the interval with the kth score, and which of its scores that is.

    A query with fewer candidates than it needs gets the lowest long, which all scores reach.
    """
    down = Window.partitionBy("row").orderBy(F.desc("low"))
    reached = totals.withColumn("sofar", F.sum("n").over(down)).join(needs, "row")
    first = F.min_by(F.struct("low", "high", "sofar", "n"), F.when(F.col("sofar") >= F.col("need"), F.col("sofar")))
    found = reached.groupBy("row").agg(first.alias("bin"), F.first("need").alias("need"))
    lowest = F.lit(LOWEST).cast("long")
    return found.select(
        "row",
        F.coalesce("bin.low", lowest).alias("low"),
        F.coalesce("bin.high", lowest).alias("high"),
        (F.col("need") - F.coalesce(F.expr("bin.sofar - bin.n"), F.lit(0))).alias("need"),
    )


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix of longs, with zeros at the end of shorter ones."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(n) for n in sizes])] = flat
    return out


def _scores(asked: pa.Table, rows: pa.Table) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Slices of queries with their scores, and which of these are of a row with itself.

    Products are taken in floating point where that is exact, else in whole numbers of any size.
    """
    a, b = (t.column("vec").combine_chunks() for t in (asked, rows))
    width = max([1, *(int(np.diff(x.offsets.to_numpy()).max(initial=0)) for x in (a, b))])
    one, two = _matrix(a, width), _matrix(b, width)
    top = [max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) for x in (one, two)]
    bound = top[0] * top[1] * width
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object
    one, two = one.astype(kind), np.ascontiguousarray(two.astype(kind).T)
    ids, own = asked.column("row").to_numpy(), rows.column("row").to_numpy()
    step = max(1, SCORES // max(len(own), BINS))
    for first in range(0, len(ids), step):
        part = slice(first, first + step)
        values = one[part] @ two
        if kind is object:
            values = np.clip(values, LOWEST, HIGHEST)
        values = values.astype(np.int64)
        order = np.argsort(own)
        at = np.minimum(np.searchsorted(own[order], ids[part]), len(own) - 1)
        same = order[at]
        yield part, values, np.where(own[same] == ids[part], same, -1)


def _histogram(bins: int) -> Callable:
    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        """Per query the highest intervals of a cell with a score, until they hold ``need``."""
        out: list[list[np.ndarray]] = [[], [], [], []]
        if asked.num_rows and rows.num_rows:
            ids, lows, highs, needs = (asked.column(c).to_numpy() for c in ("row", "low", "high", "need"))
            # the width of an interval in whole numbers; a range may exceed a long
            ranges = highs.astype(object) - lows.astype(object) + 1
            widths = ((ranges + bins - 1) // bins).astype(np.int64)
            for part, scores, same in _scores(asked, rows):
                low, high = lows[part, None], highs[part, None]
                inside = (scores >= low) & (scores <= high)
                own = np.flatnonzero(same >= 0)
                inside[own, same[own]] = False
                at, _ = np.nonzero(inside)
                # unsigned, as the distance to the low end may exceed a long
                base, width = lows[part].view(np.uint64), widths[part].view(np.uint64)
                interval = (scores[inside].view(np.uint64) - base[at]) // width[at]
                counts = np.bincount(at * bins + interval.astype(np.int64), minlength=len(low) * bins)
                counts = counts.reshape(-1, bins)
                higher = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
                query, interval = np.nonzero((counts > 0) & (higher < needs[part, None]))
                start = base[query] + interval.astype(np.uint64) * width[query]
                left = high[query, 0].view(np.uint64) - start
                end = start + np.minimum(width[query] - np.uint64(1), left)
                out[0].append(ids[part][query])
                out[1].append(start.view(np.int64))
                out[2].append(end.view(np.int64))
                out[3].append(counts[query, interval])
        return pa.table(
            {
                name: pa.array(np.concatenate(c) if c else [], pa.int64())
                for name, c in zip(("row", "low", "high", "n"), out, strict=True)
            }
        )

    return run


def _best(asked: pa.Table, rows: pa.Table) -> pa.Table:
    """Rows of a cell above the kth score, and of those that equal it the first by id."""
    out: list[list] = [[], [], [], []]
    if asked.num_rows and rows.num_rows:
        # in order of vec_id, nulls last
        rows = rows.sort_by([("vec_id", "ascending")])
        vec_ids = rows.column("vec_id").combine_chunks()
        ids, lows, needs = (asked.column(c).to_numpy() for c in ("row", "low", "need"))
        query_ids = asked.column("query_id").combine_chunks()
        for part, scores, same in _scores(asked, rows):
            low = lows[part, None]
            wanted = scores == low
            own = np.flatnonzero(same >= 0)
            wanted[own, same[own]] = False
            wanted &= np.cumsum(wanted, axis=1) <= needs[part, None]
            higher = scores > low
            higher[own, same[own]] = False
            query, row = np.nonzero(wanted | higher)
            out[0].append(pa.array(ids[part][query]))
            out[1].append(query_ids.slice(part.start).take(pa.array(query)))
            out[2].append(vec_ids.take(pa.array(row)))
            out[3].append(pa.array(scores[query, row]))
    return pa.table(
        {
            name: pa.chunked_array(c, pa.int64())
            for name, c in zip(("row", "query_id", "vec_id", "score"), out, strict=True)
        }
    )
