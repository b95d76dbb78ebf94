import hashlib
import random
from collections import Counter

import pytest

from rivalry.llm import align
from rivalry.llm.queries import BYTES, MODEL
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def pair():
    return align.Pair.load(BYTES, MODEL)


@pytest.fixture(scope="module")
def models():
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(BYTES)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=MODEL)


LETTERS = {c: b for c, b in align._byte_letters().items()}


def groups_of(models, text):
    """Groups of a whole text by the libraries' own pieces; none where bytes differ."""
    one, two = models
    if not text:
        return []
    plain = (" " + text).encode()
    a = one.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(LETTERS[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
    b = [(i, two.id_to_piece(i)) for i in two.encode(text)]
    b = [
        (i, bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()) for i, p in b
    ]
    if b"".join(x for _, x in a) != plain or b"".join(x for _, x in b) != plain:
        return []
    ends = []
    for tokens in (a, b):
        at, out = 0, {}
        for k, (_, x) in enumerate(tokens):
            at += len(x)
            out[at] = k + 1
        ends.append(out)
    groups, last = [], (0, 0)
    for end in sorted(ends[0].keys() & ends[1].keys()):
        now = ends[0][end], ends[1][end]
        groups.append(([i for i, _ in a[last[0] : now[0]]], [i for i, _ in b[last[1] : now[1]]]))
        last = now
    return groups


def brute(models, rows):
    cut = [(i, groups_of(models, t)) for i, t in rows]
    counts = Counter((a[-1], b[-1]) for _, groups in cut for a, b in groups)
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for i, groups in cut:
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                i,
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(links),
                sum(counts[x] == top[x[1]] for x in links),
                sum(counts[x] for x in links),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


SCRAPS = [
    *"abcdeé \n\t '.,0123",
    *["the", " of", "ing", "tion", "'s", "'ll", "  ", "   ", " \n", "\n ", "\n\n", "\r\n", "\t\t", "\x1c", "\x00"],
    *["Straße", "naïve", "日本", "語", "Привет", "🙂", "👍🏽", " ", " ", "́", "​", "𐐷", "Ⅷ"],
    *["<s>", "</s>", "<|endoftext|>", "<0x0A>", "<unk>", "http://x.y/z?q=1", "####", "----"],
]


def texts(seed, n):
    pick = random.Random(seed)
    return [(i, "".join(pick.choices(SCRAPS, k=pick.randint(1, 40)))) for i in range(n)]


@pytest.mark.parametrize("size, frequent", [(align.PART, align.FREQUENT), (5, 0), (40, 7)])
def test_matches_whole_texts(documents, models, pair, monkeypatch, size, frequent):
    monkeypatch.setattr(align.parts, "__defaults__", (size,))
    rows = texts(size, 500) + [(600, "a ▁ literal"), (601, "▁"), (602, " lead"), (603, "trail "), (604, " ")]
    found = align.align(documents(rows), pair, frequent)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(models, rows)


def test_documents_of_the_tables(spark, models, pair):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, align.align(docs, pair).collect()), key=str) == brute(models, rows)


def test_odd_rows(documents, models, pair):
    long = "unspaced" * 20_000 + " and words " * 100_000 + "\n" * 1000
    rows = [*ODD, (7, long), (7, long), (8, "x"), (None, "x")]
    assert sorted(map(tuple, align.align(documents(rows), pair).collect()), key=str) == brute(models, rows)
    assert align.align(documents([]), pair).collect() == []
    assert [tuple(r) for r in align.align(documents([(1, None), (2, "")]), pair).orderBy("doc_id").collect()] == [
        (1, 0, 0, 0, 0, 0, 0, ""),
        (2, 0, 0, 0, 0, 0, 0, ""),
    ]


def test_same_bytes(pair):
    assert len(pair.same) == len(pair.one_bytes)
    for a in range(0, len(pair.same), 97):
        b = pair.same[a]
        assert (b < 0) == (not pair.one_bytes[a] or pair.one_bytes[a] not in set(pair.two_bytes))
        assert b < 0 or pair.two_bytes[b] == pair.one_bytes[a]
