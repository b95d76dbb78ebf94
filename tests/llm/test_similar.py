import random
from collections import Counter

import pytest

from rivalry.llm import similar
from rivalry.llm.links import components
from tests.llm.conftest import ODD


def sets(text):
    split = (text or "").split()
    return {tuple(split[k : k + 5]) for k in range(max(1, len(split) - 4))} if split else set()


def brute(rows):
    """Class and number of links per id, by comparing all pairs."""
    all_sets = [(i, sets(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    for a, (i, x) in enumerate(all_sets):
        for j, y in all_sets[:a]:
            if x and y and 5 * len(x & y) >= 4 * len(x | y):
                links[i] += 1
                links[j] += 1
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: (find(i), links[i]) for i, _ in rows}


def variants(seed, n, group):
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for k in range(n):
        base = pick.choices(words, k=pick.randint(3, 90))
        rows.append(" ".join(base))
        for _ in range(pick.randint(0, 2)):
            copy = list(base)
            for _ in range(pick.randint(0, 3)):
                copy[pick.randrange(len(copy))] = pick.choice(words)
            rows.append(" ".join(copy))
    # from one to twelve changes, so that pairs lie on both sides of the threshold
    base = pick.choices(words, k=200)
    for k in range(group):
        copy = list(base)
        for _ in range(1 + k % 12):
            copy[pick.randrange(200)] = f"v{k}"
        rows.append(" ".join(copy))
    pick.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block, shingles", [(512, 200_000), (40, 200_000), (512, 3_000)])
def test_matches_all_pairs(documents, monkeypatch, block, shingles):
    # the large group takes several blocks, in rings around a pivot
    monkeypatch.setattr(similar, "BLOCK", block)
    monkeypatch.setattr(similar, "SHINGLES", shingles)
    rows = variants(3, 150, 300)
    got = {r._id: (r.class_id, r.n_links) for r in similar.near_duplicates(documents(rows)).collect()}
    assert got == brute(rows)


def test_a_similarity_of_just_the_threshold_counts(documents):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "a b c d e f g")]
    got = {r._id: (r.class_id, r.n_links) for r in similar.near_duplicates(documents(rows)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}


def test_odd_rows(documents):
    got = similar.near_duplicates(documents(ODD)).collect()
    assert len(got) == len(ODD)
    assert {(r._id, r.class_id, r.n_links) for r in got if r._id in (1, 2, 3)} == {(k, k, 0) for k in (1, 2, 3)}
    assert similar.near_duplicates(documents([])).count() == 0


def test_recall_sets_the_depth():
    forest = similar.Forest()
    assert forest.expected_recall(forest.depth()) >= forest.recall
    assert forest.expected_recall(forest.depth() + 1) < forest.recall


def test_components(spark):
    pick = random.Random(2)
    links = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(40)]
    links += [(200 + pick.randrange(50), 200 + pick.randrange(50)) for _ in range(40)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    assert got == {i: find(i) for i in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
