"""Quality by ordinal regression on graded ratings.

A cumulative-link model: P(grade <= j) = 1 / (1 + exp(score - threshold_j)), one score for all
grades, with thresholds in rising order. The score is linear in hashed features of the text. It
gives each document its expected grade and the tail probability of the best one, which selects.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rivalry.llm import words as W
from rivalry.session import stored

#: Labelled documents that a fit takes, chosen by grade and language; the fit is one task.
SAMPLE = 12_000

#: Rows that a feature must be in; one of fewer would learn single documents by heart.
LEAST = 3

#: Hash buckets of words, then of word shapes, then one for words that repeat the one before.
WORDS, SHAPES = 1 << 18, 1 << 10
DIM = WORDS + SHAPES + 1

#: In a shape each run of letters or digits is one letter, and of other characters one of them.
SHAPE = re.compile(r"([A-ZÀ-ÖØ-Þ]+)|([^\W\d_]+)|(\d+)|(.)\4*", re.S)


def _shape(word: str) -> str:
    return SHAPE.sub(lambda m: "A" if m[1] else "a" if m[2] else "0" if m[3] else m[4], word)


class _Features(dict):
    """Word and shape bucket of each word as one number, remembered up to a limit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= W.CACHE:
            self.clear()
        text = word.decode("utf-8", "replace")
        core = "".join(c for c in text.lower() if c.isalnum())
        bucket = xxhash.xxh3_64_intdigest(core or text) % WORDS
        shape = xxhash.xxh3_64_intdigest(_shape(text)[:12]) % SHAPES
        number = self[word] = bucket * SHAPES + shape
        return number

    def of(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """(indexes, values): 1 for each word present, the share of words of each shape, and the
        share of words that equal the word before."""
        split = W.split(text)
        n = len(split)
        if not n:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        numbers = np.fromiter(map(self.__getitem__, split), np.int64, n)
        present = np.unique(numbers // SHAPES)
        shapes = np.bincount(numbers % SHAPES, minlength=SHAPES) / n
        seen = np.flatnonzero(shapes)
        again = float((numbers[1:] == numbers[:-1]).mean()) if n > 1 else 0.0
        index = np.concatenate([present, WORDS + seen, [DIM - 1]]).astype(np.int32)
        value = np.concatenate([np.ones(len(present)), 10 * shapes[seen], [10 * again]])
        return index, value.astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Weights of the features and rising thresholds, one fewer than the grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, index: np.ndarray, value: np.ndarray) -> float:
        return float(self.weights[index] @ value)

    def at_least(self, score: float) -> np.ndarray:
        """P(grade >= j) for each j from 1."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -50, 50)))


def fit_model(
    features: list[tuple[np.ndarray, np.ndarray]],
    grades: np.ndarray,
    n_grades: int,
    penalty: float = 1e-4,
    rounds: int = 100,
    counts: np.ndarray | None = None,
) -> Model:
    """Penalised maximum likelihood over all rows, the same for the same input.

    ``counts`` says how many rows of the population each row stands for, by default one. Features
    of at least ``LEAST`` rows are used, however many rows there are; the penalty holds back rare
    ones. Thresholds start at the observed shares, one row added to each grade; they stay in order
    because their distances are fitted as logarithms.
    """
    rows = np.repeat(np.arange(len(features)), [len(i) for i, _ in features])
    index = np.concatenate([i for i, _ in features])
    value = np.concatenate([v for _, v in features]).astype(np.float64)
    common = np.bincount(index, minlength=DIM)[index] >= LEAST
    rows, value = rows[common], value[common]
    used, index = np.unique(index[common], return_inverse=True)
    n, dim = len(grades), len(used)
    low, high = grades > 0, grades < n_grades - 1
    share = np.full(n, 1 / n) if counts is None else counts / counts.sum()

    def cuts(params: np.ndarray) -> np.ndarray:
        return params[dim] + np.r_[0, np.cumsum(np.exp(params[dim + 1 :]))]

    def loss(params: np.ndarray) -> tuple[float, np.ndarray]:
        weights, at = params[:dim], cuts(params)
        score = np.bincount(rows, value * weights[index], minlength=n)
        upper, lower = np.ones(n), np.zeros(n)
        upper[high] = 1 / (1 + np.exp(np.clip(score[high] - at[grades[high]], -50, 50)))
        lower[low] = 1 / (1 + np.exp(np.clip(score[low] - at[grades[low] - 1], -50, 50)))
        chance = np.maximum(upper - lower, 1e-12)
        by_score = (1 - upper - lower) * share
        by_cut = np.zeros(n_grades - 1)
        np.add.at(by_cut, grades[high], -(upper * (1 - upper) / chance * share)[high])
        np.add.at(by_cut, grades[low] - 1, (lower * (1 - lower) / chance * share)[low])
        later = np.cumsum(by_cut[::-1])[::-1]
        by_weight = np.bincount(index, value * by_score[rows], minlength=dim) + penalty * weights
        gradient = np.concatenate([by_weight, later[:1], later[1:] * np.exp(params[dim + 1 :])])
        return -np.log(chance) @ share + penalty / 2 * weights @ weights, gradient

    shares = np.cumsum(np.bincount(grades, n * share, minlength=n_grades) + 1.0)
    start = np.log(shares[:-1] / (shares[-1] - shares[:-1]))
    params = np.concatenate([np.zeros(dim), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    params = descend(loss, params, rounds)
    weights = np.zeros(DIM, np.float32)
    weights[used] = params[:dim]
    return Model(weights, cuts(params))


def descend(loss: Callable, x: np.ndarray, rounds: int, memory: int = 10) -> np.ndarray:
    """A minimum of a smooth function by limited-memory quasi-Newton steps with backtracking."""
    f, g = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        d, factors = -g, []
        for s, y in reversed(past):
            factors.append((s @ d) / (s @ y))
            d = d - factors[-1] * y
        if past:
            s, y = past[-1]
            d = d * (s @ y) / (y @ y)
        for (s, y), a in zip(past, reversed(factors), strict=True):
            d = d + (a - (y @ d) / (s @ y)) * s
        step, slope = (1.0 if past else 1 / max(1.0, np.abs(g).sum())), g @ d
        if slope > -1e-10:
            break
        while True:
            new_f, new_g = loss(x + step * d)
            if new_f <= f + 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        s, y = step * d, new_g - g
        if s @ y > 1e-12:
            past = [*past[1 - memory :], (s, y)]
        if f - new_f < 1e-7:
            return x + s if new_f <= f else x
        x, f, g = x + s, new_f, new_g
    return x


def grade() -> Column:
    """The rating of a label row: one point for quality, one for not being toxic; 0, 1 or 2."""
    return F.col("quality") + 1 - F.col("toxic")


#: Most strata of the sample, for the driver; the rest of the languages are taken together.
STRATA = 1_000


def quotas(sizes: dict[tuple[str, int], int], sample: int) -> dict[tuple[str, int], float]:
    """How many rows each (language, grade) gives to a sample of ``sample`` rows.

    Up to half the sample, or what the best grade leaves, are of lower grades. Within each half the
    strata get equal shares; what small ones can't fill goes to the others.
    """

    def fill(part: dict, places: float) -> dict:
        shares, left = {}, places
        for k, (key, n) in enumerate(sorted(part.items(), key=lambda x: (x[1], x[0]))):
            shares[key] = min(float(n), left / (len(part) - k))
            left -= shares[key]
        return shares

    best = {key: n for key, n in sizes.items() if key[1] == 2}
    low = fill({k: n for k, n in sizes.items() if k not in best}, max(sample / 2, sample - sum(best.values())))
    return low | fill(best, sample - sum(low.values()))


def choose(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """doc_id, grade, n: the documents to fit on and how many labelled ones each stands for.

    Small strata of language and grade are taken whole, so that low grades of rare languages come
    in; of the others those whose id has the least hash, weighed by the share taken.
    """
    rated = (
        labels.select("doc_id", grade().cast("int").alias("grade"))
        .where("doc_id is not null and grade between 0 and 2")
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
    )
    lang = F.min("lang") if "lang" in docs.columns else F.lit("")
    known = docs.where("doc_id is not null").groupBy("doc_id").agg(F.coalesce(lang, F.lit("")).alias("lang"))
    rated = stored(rated.join(known, "doc_id"))
    by_size = rated.groupBy("lang", "grade").agg(F.count(F.lit(1)).alias("n"))
    # bounded by the constant
    sizes = {(r.lang, r.grade): r.n for r in by_size.orderBy(F.desc("n"), "lang", "grade").limit(STRATA).collect()}
    others = by_size.agg(F.sum("n")).first()[0] or 0
    others -= sum(sizes.values())
    taken = quotas(sizes | ({("", -1): others} if others else {}), sample)
    rates = {key: taken[key] / (sizes.get(key) or others) for key in taken}
    listed = rated.sparkSession.createDataFrame(
        [(*key, rate) for key, rate in rates.items()], "lang string, grade int, rate double"
    )
    rest = F.lit(rates.get(("", -1), 1.0))
    # a hash as a number from 0 to 1; the least by rate are as many as the quotas
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (
        rated.join(F.broadcast(listed), ["lang", "grade"], "left")
        .withColumn("rate", F.coalesce("rate", rest))
        .orderBy(F.when(F.col("rate") < 1, place / F.col("rate")).otherwise(-1.0), F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .select("doc_id", "grade", (1 / F.col("rate")).alias("n"))
    )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model of the rated documents; None if there is none.

    ``docs`` has doc_id, text and lang (without lang all are of one language), ``labels`` doc_id,
    quality and toxic (0 or 1). Of several labels of one document the lowest grade counts, labels
    with nulls don't. At most ``sample`` labelled documents are taken, by grade and language (see
    :func:`choose`); they, and so the fit, are bounded by that parameter. All their text is read.
    """
    rated = choose(docs, labels, sample)
    # bounded by the parameter
    texts = docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id").dropDuplicates(["doc_id"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features()
        for batch in batches:
            found = [features.of(t) for t in W.texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("grade"),
                    batch.column("n"),
                    pa.array([i.tobytes() for i, _ in found], pa.binary()),
                    pa.array([v.tobytes() for _, v in found], pa.binary()),
                ],
                names=["doc_id", "grade", "n", "i", "v"],
            )

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        pairs = [
            (np.frombuffer(i, np.int32), np.frombuffer(v, np.float32))
            for i, v in zip(rows.i, rows.v, strict=True)
        ]
        model = fit_model(pairs, rows.grade.to_numpy(np.int64), 3, counts=rows.n.to_numpy())
        return pd.DataFrame({"w": [model.weights.tobytes()], "t": [model.thresholds.tobytes()]})

    id_type = texts.schema["doc_id"].dataType.simpleString()
    described = texts.select("doc_id", "grade", "n", "text").mapInArrow(
        describe, f"doc_id {id_type}, grade int, n double, i binary, v binary"
    )
    row = described.groupBy().applyInPandas(train, "w binary, t binary").first()
    if row is None:
        return None
    return Model(np.frombuffer(row.w, np.float32), np.frombuffer(row.t, np.float64))


def rate(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (with text) and the columns expected_grade and tail, the chance of the best grade.

    Whole texts are read, a row at a time, and nothing is shuffled. A null text counts as an empty
    one, which only the thresholds judge. Without a model both columns are null. Columns of those
    names are replaced; equal texts get equal values; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c not in ("expected_grade", "tail")]
    rows = docs.select(*kept)
    if model is None:
        null = F.lit(None).cast("double")
        return rows.withColumns({"expected_grade": null, "tail": null})
    more = [StructField(c, DoubleType()) for c in ("expected_grade", "tail")]
    schema = StructType([*rows.schema.fields, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features()
        for batch in batches:
            chances = [model.at_least(model.score(*features.of(t))) for t in W.texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([float(c.sum()) for c in chances], pa.float64()),
                    pa.array([float(c[-1]) for c in chances], pa.float64()),
                ],
                names=[*batch.schema.names, "expected_grade", "tail"],
            )

    return rows.mapInArrow(run, schema)


def select(rated: DataFrame, least: float = 0.85) -> DataFrame:
    """Whether the tail reaches ``least``, as the column ``kept``; true where nothing is known."""
    return rated.withColumn("kept", F.coalesce(F.col("tail") >= least, F.lit(True)))
