import random

from rivalry.llm import repeats
from tests.llm.conftest import ODD


def brute(rows, window):
    """Kept words per document, by comparing all windows in order."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        split = (text or "").split()
        gone = set()
        for p in range(len(split) - window + 1):
            key = tuple(split[p : p + window])
            if key in seen:
                gone.update(range(p, p + window))
            seen.add(key)
        out[doc_id] = (len(split), " ".join(w for k, w in enumerate(split) if k not in gone))
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.kept_text) for r in df.collect()}


def test_matches_brute_force_for_many_chunks(documents):
    pick = random.Random(5)
    words = [f"w{k}" for k in range(40)]
    passages = [" ".join(pick.choices(words, k=pick.randint(4, 30))) for _ in range(12)]
    rows = [(k, " ".join(pick.choices(passages, k=pick.randint(0, 5)))) for k in range(120)]
    rows += [(200 + k, rows[k][1]) for k in range(30)] + [(300, "a " * 500), (301, "a b " * 300)]
    want = brute(rows, 6)
    for chunk, bucket in ((50, 100), (10_000, 100), (10_000, 10_000)):
        got = result(repeats.remove_repeats(documents(rows), 6, chunk, bucket))
        assert got == want


def test_spans_are_maximal(documents):
    passage = " ".join(f"p{k}" for k in range(25))
    rows = [(1, f"x {passage} y"), (2, f"{passage} z {passage}")]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in repeats.remove_repeats(documents(rows)).collect()}
    assert got == {1: [], 2: [(0, 25), (26, 51)]}


def test_odd_rows(documents, spark):
    got = sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_words, r.kept_text)
        for r in repeats.remove_repeats(documents(ODD)).collect()
    )
    assert len(got) == len(ODD)
    assert got[0] == (False, 1, 0, "") and got[-1] == (True, 0, 3, "no id here")
    assert repeats.remove_repeats(documents([])).count() == 0


def test_rows_that_repeat_id_and_text_are_one_document(documents):
    text = " ".join(f"q{k}" for k in range(30))
    got = repeats.remove_repeats(documents([(5, text), (5, text), (6, text), (None, text)])).collect()
    assert sorted((r.doc_id or 99, r.kept_text == text) for r in got) == [
        (5, True),
        (5, True),
        (6, False),
        (99, False),
    ]
