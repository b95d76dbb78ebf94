from collections import Counter

import pytest

from rivalry.llm import shards
from tests.llm.conftest import ODD

NAMES = [f"s{k}" for k in range(7)]


def test_shares_are_even_and_moves_few():
    table = shards.lookup_table(NAMES, 1009)
    share = Counter(table)
    # each claims a slot in turn
    assert set(share) == set(range(7)) and max(share.values()) - min(share.values()) <= 1
    fewer = shards.lookup_table(NAMES[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6)
    assert moved < 0.15 * 1009


def test_first_choices_are_kept():
    # the shard whose turn it is takes the first free slot of its own order
    table = shards.lookup_table(NAMES, 101)
    free, step = set(range(101)), [0] * 7
    order = [
        [
            (shards._number(f"{n}/start") % 101 + k * (shards._number(f"{n}/width") % 100 + 1)) % 101
            for k in range(101)
        ]
        for n in NAMES
    ]
    for turn in range(101):
        shard = turn % 7
        slot = next(s for s in order[shard] if s in free)
        free.remove(slot)
        assert table[slot] == shard


def test_wrong_parameters():
    for names, slots in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            shards.lookup_table(names, slots)


def test_odd_rows(documents):
    docs = documents(ODD).withColumnRenamed("source", "shard")
    got = shards.place(docs, "doc_id", NAMES, 101).collect()
    assert len(got) == len(ODD)
    assert len({r.slot for r in got if r.doc_id is None}) == 1
    assert len({r.slot for r in got if r.doc_id == 4}) == 1
    assert shards.place(documents([]), "doc_id", NAMES, 101).count() == 0


def test_written_shards_hold_every_row(documents, spark, tmp_path):
    docs = documents([(k % 40, f"text {k}") for k in range(200)])
    shards.write_shards(docs, "doc_id", NAMES, 101, str(tmp_path / "out"), rows_per_file=20)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.text for r in back.collect()) == sorted(r.text for r in docs.collect())
    assert back.groupBy("doc_id").agg({"shard": "max"}).count() == 40
