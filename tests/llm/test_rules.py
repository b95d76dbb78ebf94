import math
import random

from rivalry.llm import rules
from tests.llm.conftest import ODD

LABELS = "doc_id long, quality int, toxic int"


def repeated(split):
    places = {}
    for p in range(len(split) - 7):
        places.setdefault(tuple(split[p : p + 8]), []).append(p)
    covered = {p + k for found in places.values() if len(found) > 1 for p in found for k in range(8)}
    return len(covered)


def test_counts(documents):
    pick = random.Random(6)
    rows = [(k, " ".join(pick.choices("abcd", k=pick.randint(0, 60)))) for k in range(80)]
    rows += [(100, "x " * 300), (101, "a b c d e f g h " * 2), (102, "a  b\tc\x0bd é😀 #*\n\n|\na\na\n \n")]
    rows += [(103, "long " * 20_000)]
    got = {r.doc_id: r for r in rules.counts(documents(rows)).collect()}
    for i, text in rows:
        split = text.split()
        lines = [x for x in text.split("\n") if x.strip()]
        want = (len(split), sum(map(len, split)), sum(text.count(c) for c in rules.SYMBOLS))
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols) == want
        assert got[i].n_dup_lines == len(lines) - len(set(lines))
        assert got[i].n_repeat_words == repeated(split), i
    assert got[101].n_repeat_words == 16 and got[102].n_dup_lines == 1


def test_cutoffs_keep_the_bound(documents, spark):
    pick = random.Random(2)
    rows, labels = [], []
    for k in range(3000):
        good = pick.random() < 0.7
        split = [f"word{pick.randrange(900)}" for _ in range(30)]
        share = pick.random() * (0.02 if good else 0.6)
        rows.append((k, " ".join(w + "***" if pick.random() < share else w for w in split)))
        labels.append((k, int(good), 0))
    docs, labels = documents(rows), spark.createDataFrame(labels, LABELS)
    counted = rules.counts(docs)
    limits = rules.cutoffs(counted, labels).first().cutoffs
    # by hand: the exact tail at each cutoff of this rule
    part, n = 0.05 / len(rules.RULES), sum(r.quality for r in labels.collect())
    good = {r.doc_id for r in labels.collect() if r.quality}
    values = [r.n_symbols / r.word_chars for r in counted.collect() if r.doc_id in good]
    log = lambda i: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
    tail = lambda k: sum(
        math.exp(log(i) + i * math.log(part) + (n - i) * math.log(1 - part)) for i in range(k + 1)
    )
    proven = [c for c in rules.SHARES if tail(sum(v > c for v in values)) <= 0.05 / len(rules.RULES)]
    assert limits["symbols"] in proven
    judged = rules.judge(docs, labels).collect()
    lost = sum(not r.kept for r in judged if r.doc_id in good)
    assert lost <= 0.05 * n and sum(not r.kept for r in judged) > 500


def test_odd_rows(documents, spark):
    none = spark.createDataFrame([], LABELS)
    got = rules.judge(documents([*ODD, (9, " ".join(f"w{k}" for k in range(20)))]), none).collect()
    assert len(got) == len(ODD) + 1
    assert [r.doc_id for r in got if r.kept] == [9]
    assert rules.judge(documents([]), none).count() == 0
    odd = spark.createDataFrame([(9, None, 1), (None, 1, 1), (9, 1, None), (9, 1, 0)], LABELS)
    assert rules.judge(documents(ODD), odd).count() == len(ODD)
