"""How many rows the join of all sets that share an entry makes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join


def test_one_entry_is_kept_for_each_set_of_members(spark):
    rows = [(e, v) for e in (2, 4, 7) for v in (10, 11)]  # 7 has the bit of pairs
    rows += [(e, v) for e in (9, 13) for v in (10, 12)] + [(16, v) for v in (10, 11, 12)] + [(20, 10), (22, 11)]
    entries = spark.createDataFrame(rows, "entry long, vertex long").withColumn("n", F.lit(5))
    got = sorted((r.entry, r.vertex) for r in jaccard_join.without_same_members(entries).collect())
    assert got == [(2, 10), (2, 11), (9, 10), (9, 12), (16, 10), (16, 11), (16, 12)]


def test_earlier_entries_hold_pairs_of_grams_last(spark):
    entries = [8, 3, 2, 5, *range(10, 30, 2)]
    placed = spark.createDataFrame([(e, 1) for e in entries] + [(5, 2), (8, 2)], "entry long, vertex long")
    got = {(r.vertex, r.entry): r.earlier for r in jaccard_join.with_earlier(placed).collect()}
    order = sorted(entries, key=lambda e: (e & 1, e))
    for k, e in enumerate(order):
        assert got[1, e] == order[max(0, k - jaccard_join.BEFORE) : k]
    assert (got[2, 8], got[2, 5]) == ([], [8])


@pytest.mark.parametrize("percent", [90, 80])
def test_a_pair_is_made_few_times(spark, monkeypatch, percent):
    """Long texts that differ in a few words share hundreds of entries; hubs are kept from linking any of them."""
    rng = random.Random(5)
    base = [[f"w{rng.randrange(10**9)}" for _ in range(600)] for _ in range(6)]
    rows = []
    for words in base:
        for _ in range(8):
            own = list(words)
            for _ in range(4):
                own[rng.randrange(600)] = f"x{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = []
    distinct = type(docs).distinct

    def counted(frame):
        if frame.columns == ["a", "b"]:
            made.append(frame.count())
        return distinct(frame)

    def none(placed, tried, percent, turn=0):
        return jaccard_join.stored(placed.limit(0).select(F.col("vertex").alias("a"), F.col("vertex").alias("b")))

    monkeypatch.setattr(jaccard_join, "one_hub", none)
    monkeypatch.setattr(type(docs), "distinct", counted)
    found = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs, 3, percent).collect()}
    assert found == {k: k // 8 * 8 for k in range(48)}
    assert 6 * 28 <= max(made) < 3 * 6 * 28


@pytest.mark.parametrize("most_bits", [25, 16])
def test_grams_of_one_text_are_not_frequent(spark, monkeypatch, most_bits):
    """Whether the counters follow the texts or have come to their limit: 38 n-grams for each of the first 2^16."""
    monkeypatch.setattr(jaccard_join, "SKETCH_BITS", 16)
    monkeypatch.setattr(jaccard_join, "MOST_SKETCH_BITS", most_bits, raising=False)
    words = F.transform(F.sequence(F.lit(1), F.lit(2_500)), lambda k: F.hex(F.xxhash64("id", k)))
    docs = spark.range(1_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", words).alias("text"))
    rows = jaccard_join.indexed(docs, jaccard_join.count_sketch(docs, 3), 3, 90)
    found = rows.agg(F.sum("n").alias("n"), F.sum("frequent").alias("frequent")).first()
    assert found.n == 1_000 * 2_498 and found.frequent < 0.01 * found.n


def test_counters_stop_at_their_highest(spark):
    docs = spark.createDataFrame([(k, "a b c " * 700) for k in range(200)], "doc_id long, text string").repartition(3)
    sketch = jaccard_join.count_sketch(docs, 3)
    assert sketch.max() == 65_535 and (sketch > 0).sum() == 3 and jaccard_join.rare_count(sketch) == jaccard_join.RARE
    assert len(jaccard_join.count_sketch(docs.limit(0), 3)) == 1 << jaccard_join.SKETCH_BITS
