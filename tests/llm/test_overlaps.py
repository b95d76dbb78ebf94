import random

import pytest

from rivalry.llm import decontaminate as d
from tests.llm.conftest import ODD


def distance(segment, text):
    """Least edit distance of ``segment`` to any part of ``text``, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, letter in enumerate(segment, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (letter != other)))
        row = new
    return min(row)


def spoil(text, n, pick):
    for _ in range(n):
        k = pick.randrange(len(text))
        text = pick.choice([text[:k] + text[k + 1 :], text[:k] + "q" + text[k:], text[:k] + "z" + text[k + 1 :]])
    return text


@pytest.fixture(scope="module")
def case():
    pick = random.Random(4)
    word = lambda: "".join(pick.choices("abcdefgh", k=pick.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(k, text(pick.randint(6, 30))) for k in range(25)] + [(90, "too short"), (91, None)]
    docs = []
    for k in range(90):
        body = text(pick.randint(0, 40))
        if k % 2:
            item = pick.choice(items[:25])[1]
            start = pick.randrange(max(1, len(item) - 60))
            part = spoil(item[start : start + pick.randint(40, 200)], pick.randint(0, 6), pick)
            body = f"{body} {part.upper() if k % 3 else part}, {text(5)}"
        docs.append((k, body))
    return docs, items


def test_matches_whole_table_alignment(documents, spark, case):
    docs, items = case
    bounds = d.Bounds()
    want = {}
    for i, text in docs:
        for j, item in items:
            found = [
                (s, e)
                for s in set(d.segments(d.plain(item), bounds))
                if (e := distance(s, d.plain(text))) <= bounds.edits(len(s))
            ]
            if found:
                want[i, j] = (len(found), min(e for _, e in found))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {
        (r.doc_id, r.item_id): (r.n_segments, r.edits)
        for r in d.overlaps(documents(docs), benchmark, bounds).collect()
    }
    assert got == want and len(want) > 10


def test_excerpts_at_any_start_and_short_items(documents, spark):
    pick = random.Random(8)
    word = lambda: "".join(pick.choices("abcdefgh", k=pick.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(k, text(45)) for k in range(8)]
    items += [(20, "xylo"), (21, "xy zeta ypsilon"), (22, "seven words that are not quite forty ch"), (23, " -- ")]
    docs = []
    for k in range(160):
        item = items[k % 8][1]
        start, n = pick.randrange(len(item) - 95), pick.choice([50, 51, 52, 60, 74, 80, 93])
        docs.append((k, f"{text(20)} {item[start : start + n]} {text(20)}"))
    docs += [(200 + k, f"{text(3)} {item.upper()}! {text(3)}") for k, (_, item) in enumerate(items[8:11])]
    docs += [(210, "xylophone, xy zeta ypsilons"), (211, "seven words that are not quite forty chs")]
    docs += [(212, "xylo"), (213, text(60))]

    def shared(item, doc):
        item, doc = d.plain(item), d.plain(doc)
        if len(item) < 40:
            return bool(item) and f" {item} " in f" {doc} "
        return any(item[a : a + 50] in doc for a in range(len(item) - 49))

    want = {(i, j) for i, t in docs for j, item in items if shared(item, t)}
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in d.overlaps(documents(docs), benchmark).collect()}
    assert set(found) >= want and len(want) > 140
    assert {(200, 20), (201, 21), (202, 22), (212, 20)} <= want
    # whatever else is found lies within the edits of 50 characters
    for i, j in set(found) - want:
        item, doc = d.plain(dict(items)[j]), d.plain(dict(docs)[i])
        assert len(item) > 40 and any(distance(item[a : a + 50], doc) <= 3 for a in range(len(item) - 49))
    assert found[212, 20].stops == [4] and found[212, 20].edits == 0 and found[212, 20].n_segments == 1
    assert all(d.plain(dict(docs)[i])[: found[i, j].stops[0]].endswith(item) for i, j, item in [
        (200, 20, items[8][1]), (201, 21, items[9][1]), (202, 22, items[10][1])
    ])


def test_blocks_give_the_same(documents, spark, case, monkeypatch):
    docs, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = d.overlaps(documents(docs), benchmark).collect()
    monkeypatch.setattr(d, "BLOCK_CHARS", 800)
    assert sorted(map(str, d.overlaps(documents(docs), benchmark).collect())) == sorted(map(str, whole))


def test_short_items_empty_no_corpus(documents, spark):
    benchmark = spark.createDataFrame([(1, "The"), (2, "is a name"), (3, "these are four words")], "item_id int, text string")
    docs = documents([(1, "the first of the"), (2, "what is a name?"), (3, "and these are four words"), (4, "none")])
    assert {(r.doc_id, r.item_id) for r in d.overlaps(docs, benchmark).collect()} == {(1, 1), (2, 2), (3, 3)}
    assert sorted(r.doc_id for r in d.decontaminate_rows(docs, benchmark).collect()) == [1, 2, 4]
    assert sorted(r.doc_id for r in d.decontaminate(docs, benchmark).collect()) == [1, 2, 4]


def test_memory_of_a_block():
    pick = random.Random(1)
    items, size = [], 0
    while size < d.BLOCK_CHARS:
        items.append(" ".join("".join(pick.choices("abcdefghijklmnop", k=pick.randint(2, 9))) for _ in range(200)))
        size += len(items[-1])
    index = d.Index(items, d.Bounds())
    assert index.memory() < 40 * size
    text = f"{items[7][100:300]}\n{items[9][3:90]}"
    assert {x[0] for x in index.candidates(text)} == {7, 9}


def test_very_long_texts(documents, spark):
    item = "a passage of the benchmark that is long enough to be found"
    benchmark = spark.createDataFrame([(1, item)], "item_id int, text string")
    docs = documents([(1, "word " * 400_000 + item + " word" * 400_000), (2, "x" * 2_000_000), (3, "word " * 400_000)])
    found = d.overlaps(docs, benchmark).collect()
    assert [(r.doc_id, r.edits, r.stops[-1]) for r in found] == [(1, 0, 2_000_000 + len(item))]


def test_odd_rows(documents, spark):
    item = "a passage of the benchmark that is long enough to be found"
    benchmark = spark.createDataFrame(
        [(1, item), (2, item), (None, None), (3, "")], "item_id long, text string"
    )
    docs = documents([*ODD, (8, f"before. {item.upper()}!! after"), (None, f"and {item}")])
    found = d.overlaps(docs, benchmark).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in found) == [(0, 1), (0, 2), (8, 1), (8, 2)]
    kept = d.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 4, 4]
    assert d.overlaps(documents([]), benchmark).count() == 0
    assert d.overlaps(docs, benchmark.limit(0)).count() == 0
