"""Quality rules whose cutoffs carry a proven bound on false rejection.

Each rule is a number per document, larger being worse. On labelled good documents (the holdout)
the exact binomial tail tells which cutoffs keep the share of good documents rejected below the
rule's part of the risk; tests run from the loosest cutoff to the strictest and stop at the
first that fails, so only the number of (stratum, rule) pairs divides the error level. Of the
proven cutoffs the one that sorts best is taken: it must reject a far larger share of the
labelled bad documents than of the good ones. Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivalry.session import stored

#: Characters between words, and the characters counted as symbols; fixed values.
SPACE = "\\x20\\x09-\\x0D"
SYMBOLS = "#*$%&|<>"

#: Words in a window whose repetition counts; fixed value.
WINDOW = 8

SHARES = (0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.5)


@dataclass(frozen=True)
class Rule:
    """``value`` is SQL over the counts of :func:`counts`; more than the cutoff is a breach."""

    name: str
    value: str
    cutoffs: tuple[float, ...] = SHARES


RULES = (
    Rule("symbols", "n_symbols / greatest(word_chars, 1)"),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)"),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)"),
    Rule("shouts", "n_shouts / greatest(n_words, 1)"),
    Rule("long_words", "word_chars / greatest(n_words, 1)", (8.0, 9.0, 10.0, 12.0, 15.0, 20.0)),
    Rule("short_words", "-word_chars / greatest(n_words, 1)", (-4.0, -3.5, -3.0, -2.5, -2.0, -1.5)),
)

#: The number of words in windows found twice or more in the text. A window's 64-bit hash is made
#: by doubling: of words, then pairs, fours and eights. Texts without a repeated window, which are
#: most, need no sort. Each ``transform(array(x), name -> ...)[0]`` binds x once.
DOUBLED = "transform(array({of}), v -> transform(v, (x, i) -> xxhash64(x, get(v, i + {step}))))[0]"
HASHES = "transform(words, x -> xxhash64(x))"
for _step in (1, 2, 4):
    HASHES = DOUBLED.format(of=HASHES, step=_step)
REPEAT_WORDS = f"""
if(size(words) <= {WINDOW}, 0L,
  transform(array(slice({HASHES}, 1, size(words) - {WINDOW - 1})),
    h -> if(size(array_distinct(h)) = size(h), 0L,
      transform(array(sort_array(transform(h, (x, i) -> struct(x, i)))),
        s -> aggregate(
          sort_array(filter(
            transform(s, (e, k) -> if(coalesce(e.x = get(s, k - 1).x, false)
                                      or coalesce(e.x = get(s, k + 1).x, false), e.i, null)),
            p -> p is not null)),
          struct(0 as upto, 0L as n),
          (acc, p) -> struct(p + {WINDOW} as upto,
                             acc.n + p + {WINDOW} - greatest(acc.upto, p) as n),
          acc -> acc.n))[0]))[0])
"""


def _letters(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` are outside the character class ``pattern``."""
    return F.length(F.regexp_replace(text, f"[{pattern}]+", "")).cast("long")


def counts(docs: DataFrame, id_col: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """The id, ``stratum`` and counts per row of ``docs``, computed from whole texts.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouts
    (``!``), all long, and base_failed. A null text has no words;
    a null stratum counts as ''. Every row stays, repeated ids too; other columns are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"[{SPACE}]+")
    )
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    split = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
        words.alias("words"),
        lines.alias("lines"),
        F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        _letters(text, f"^{SYMBOLS}").alias("n_symbols"),
        _letters(text, "^!").alias("n_shouts"),
    )
    n_words = F.size("words").cast("long")
    counted = split.select(
        "doc_id",
        "stratum",
        n_words.alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(REPEAT_WORDS).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_shouts",
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


#: log of P(Bin(n, risk) <= k), by adding the terms from 0 to k in logarithms.
LOG_TAIL = """
aggregate(
  if(k > 0, sequence(1L, k), array()),
  struct(n * ln(1 - {risk}) as term, n * ln(1 - {risk}) as total),
  (a, i) -> transform(array(a.term + ln((n - i + 1) / i) + ln({risk} / (1 - {risk}))),
    t -> struct(t as term,
      greatest(a.total, t) + ln(1 + exp(least(a.total, t) - greatest(a.total, t))) as total))[0],
  a -> a.total)
"""


def cutoffs(
    counted: DataFrame,
    labels: DataFrame,
    risk: float = 0.05,
    error: float = 0.05,
    worth: float = 10.0,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """One row per stratum with good labelled documents: a map from rule name to its cutoff.

    With probability 1 - ``error``, in all strata at once, the rules reject together at most a
    share ``risk`` of the good documents that pass the base checks. Of the proven cutoffs of a
    rule, the one with the largest (share of bad rejected) - ``worth`` * (share of good rejected)
    is taken, the loosest of equals; a rule where none is above 0 is absent from the map. All
    labelled rows count, none are sampled; of several labels of one document the lowest counts,
    null labels don't.
    """
    lowest = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("lowest"))
    )
    holdout = counted.where(~F.col("base_failed")).join(lowest, "doc_id")
    part = risk / len(rules)
    good, bad = F.col("lowest") > 0, F.col("lowest") <= 0
    # counted on the map side: one row per stratum and task
    sums = [F.count(F.when(good, 1)).alias("n"), F.count(F.when(bad, 1)).alias("n_bad")]
    tests = []
    for rule in rules:
        for i, cutoff in enumerate(rule.cutoffs):
            breach, name = F.expr(rule.value) > F.lit(cutoff), f"{rule.name}_{i}"
            sums += [F.count(F.when(good & breach, 1)).alias(name)]
            sums += [F.count(F.when(bad & breach, 1)).alias(f"{name}_bad")]
            tests += [
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.lit(cutoff).alias("cutoff"),
                    F.col(name).alias("k"),
                    F.col(f"{name}_bad").alias("k_bad"),
                )
            ]
    tallied = holdout.groupBy("stratum").agg(*sums).where("n > 0")
    n_strata = tallied.agg(F.count(F.lit(1)).alias("n_strata"))
    tested = tallied.select("stratum", "n", "n_bad", F.inline(F.array(*tests)))
    proven = F.expr(LOG_TAIL.format(risk=f"{part!r}D")) <= F.log(
        F.lit(error) / (F.col("n_strata") * len(rules))
    )
    gain = F.col("k_bad") / F.greatest("n_bad", F.lit(1)) - worth * F.col("k") / F.col("n")
    # n_strata is one row
    return (
        tested.where(F.col("k") < part * F.col("n"))
        .join(F.broadcast(n_strata))
        .where(proven)
        .withColumn("gain", gain)
        .where("gain > 0")
        .groupBy("stratum", "rule")
        .agg(F.max_by("cutoff", F.struct("gain", "cutoff")).alias("cutoff"))
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    risk: float = 0.05,
    error: float = 0.05,
    worth: float = 10.0,
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts, base_failed, kept, and the rules it breaches.

    ``docs`` has doc_id, text, lang (the stratum). A document is kept if it passes the base
    checks and no proven cutoff of its stratum. In a stratum without good labels, or with an
    empty ``labels``, only the base checks apply. The counts are computed once and stored; no
    text is shuffled. The join with the cutoffs (a row per stratum) is left to measured sizes.
    """
    counted = stored(counts(docs))
    limits = cutoffs(counted, labels, risk, error, worth, rules)
    breaches = F.filter(
        F.array(
            *(
                F.when(F.expr(rule.value) > F.col("cutoffs")[rule.name], F.lit(rule.name))
                for rule in rules
            )
        ),
        lambda x: x.isNotNull(),
    )
    judged = counted.join(limits, "stratum", "left").withColumn("breaches", breaches)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.size("breaches") == 0)).alias("kept"),
        F.array_join("breaches", ",").alias("breaches"),
    )
