import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rivalry.llm import variants
from tests.llm.conftest import ODD


def counted(rows):
    """Words and their counts, by the definition."""
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(words):
    """Words one edit apart, by trying all texts without one code point."""
    without = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            without[k, w[:k] + w[k + 1 :]].add(w)
    out = defaultdict(set)
    for (_, rest), some in without.items():
        for w in some:
            out[w] |= some - {w}
            if rest in words:
                out[w].add(rest)
                out[rest].add(w)
    return out


def brute(rows):
    words = counted(rows)
    neighbours, forms = near(words), {}
    for w, n in words.items():
        best = min(neighbours[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, forms[w], root, n, len(neighbours[w]), words.get(forms[w])))
    return out


def got(df):
    found = variants.group(df)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed, n, letters="abé", words=300):
    pick = random.Random(seed)
    base = ["".join(pick.choices(letters, k=pick.randint(5, 12))) for _ in range(words)]
    base += ["q" * 80, "q" * 40 + "r" + "q" * 39, "q" * 81]

    def typed():
        w = base[min(int(pick.expovariate(0.02)), len(base) - 1)] if pick.random() < 0.9 else pick.choice(base)
        if pick.random() < 0.2:
            k = pick.randrange(len(w))
            w = w[:k] + pick.choice(["", "x", w[k] * 2]) + w[k + 1 :]
        return w.capitalize() if pick.random() < 0.1 else w

    return [(i, " ".join(typed() for _ in range(pick.randint(1, 80)))) for i in range(n)]


def test_matches_all_pairs(documents):
    chain = "chainings " * 400 + "chainingz " * 30 + "chainingzy " * 3
    rows = [*corpus(1, 250), (900, chain)]
    assert any(r[1] and r[1] != r[2] for r in brute(rows))
    assert got(documents(rows)) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("name, value", [("HOT", 3), ("TOGETHER", 50), ("MEETINGS", 10), ("FREQUENT", 5)])
def test_limits_change_nothing(documents, monkeypatch, name, value):
    rows = corpus(2, 120, words=120)
    monkeypatch.setattr(variants, "FREQUENT", 20)
    monkeypatch.setattr(variants, name, value)
    assert got(documents(rows)) == sorted(brute(rows), key=str)


def test_grams_of_near_words():
    """Near words share all but ``affected`` grams, and one of their rarest."""
    pick = random.Random(4)
    words = ["".join(pick.choices("ab", k=pick.randint(7, 16))) for _ in range(400)]
    frequent = Counter(
        g for w in words for q in (2, 3, 4) for k in range(len(w) + 2 - q) if len(g := (w + variants.END)[k : k + q])
    )
    frequent = {g: n for g, n in frequent.items() if n > 200}
    for w in words:
        k = pick.randrange(len(w) + 1)
        other = w[:k] + pick.choice("ab") + w[k + pick.randint(0, 1) :]
        if len(other) < 7 or other == w:
            continue
        grams = [Counter((x + variants.END)[s:e] for s, e in variants.decompose(x, frequent)) for x in (w, other)]
        shared = (grams[0] & grams[1]).total()
        for x, g in zip((w, other), grams):
            assert shared >= g.total() - variants.affected(variants.decompose(x, frequent)) >= 1
        first = [{(x + variants.END)[s:e] for s, e, _ in variants.rarest(x, frequent)} for x in (w, other)]
        assert first[0] & first[1]


def test_one_edit_and_matrix_agree():
    pick = random.Random(3)
    words = ["".join(pick.choices("ab", k=pick.randint(7, 9))) for _ in range(60)] + ["a" * 70, "a" * 71, "a" * 69 + "b"]
    pairs = [(i, j) for i in range(len(words)) for j in range(len(words)) if 0 <= len(words[j]) - len(words[i]) <= 1]
    one, two = np.array(pairs).T
    wanted = [variants.one_edit(words[i], words[j]) for i, j in pairs]
    assert variants._verified(words, one, two).tolist() == wanted
    assert [variants.one_edit(a, b) for a, b in (("ab", "ab"), ("ab", "abc"), ("ab", "acb"), ("ab", "ba"))] == [
        False,
        True,
        True,
        False,
    ]


def test_odd_rows(documents):
    long = "surprise " * 40_000 + "surprize suprise"
    rows = [*ODD, (None, "Straße ÀÉÎÕ ×÷abcdefg ABCDEFG abcdefG"), (None, None), (9, long), (9, long), (10, "a" * 5000)]
    assert got(documents(rows)) == sorted(brute(rows), key=str)
    assert got(documents([])) == []
    assert got(documents([(1, "few short words")])) == []
