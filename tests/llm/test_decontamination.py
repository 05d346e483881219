"""Retrieval against scoring every passage with every item; planted leaks."""

import random
from collections import Counter

import pytest

from clicktide.llm import decontamination as dc, queries
from tests.llm.helpers import SF, awkward, documents_of, empty, needs_data, rows_of

ITEMS = "item_id long, text string"


def weights_of(items):
    lists = [dc.words_of(t) for _, t in items]
    classes = Counter(w for words in lists for w in set(words))
    mean = sum(map(len, lists)) / len(lists)
    return [dc.bm25_weights(words, classes, len(items), mean) for words in lists], max(map(len, lists))


def brute(items, text):
    """Place of the passage and item id of every score at or above the threshold."""
    weights, longest = weights_of(items)
    size = max(dc.LEAST_PASSAGE, 2 * longest)
    words = dc.words_of(text)
    found = set()
    for first in range(0, max(1, len(words)), size // 2):
        passage = set(words[first : first + size])
        for (item, _), of in zip(items, weights, strict=True):
            if sum(w for word, w in of.items() if word in passage) / sum(of.values()) >= dc.THRESHOLD:
                found.add((first, item))
    return found


def zipf_text(rnd, n):
    return " ".join(f"w{int(rnd.paretovariate(0.7))}" for _ in range(n))


@pytest.mark.parametrize("block_items", [1, 4, 16])
def test_no_item_above_the_threshold_is_lost(monkeypatch, block_items):
    monkeypatch.setattr(dc, "BLOCK_ITEMS", block_items)
    monkeypatch.setattr(dc, "LEAST_PASSAGE", 16)
    rnd = random.Random(block_items)
    items = [(i, zipf_text(rnd, rnd.randint(3, 30))) for i in range(40)]
    weights, longest = weights_of(items)
    index = dc.Index(items, weights, longest)
    texts = [zipf_text(rnd, rnd.randint(0, 300)) for _ in range(60)] + [t for _, t in items]
    lists = [dc.words_of(t) for t in texts]
    got = Counter((text, first, index.items[place][0]) for text, first, place, _ in index.retrieved(lists))
    assert max(got.values()) == 1
    expected = {(k, *pair) for k, text in enumerate(texts) for pair in brute(items, text)}
    assert set(got) == expected and expected


def hits_of(frame, items):
    return {r["doc_id"]: r["hits"] for r in rows_of(dc.find_items(frame, items))}


def test_planted_leaks(spark, monkeypatch):
    monkeypatch.setattr(dc, "SLICE_WORDS", 120)  # several slices
    rnd = random.Random(5)
    items = [(i, ". ".join(" ".join(f"q{i}_{s}_{k}" for k in range(9)) for s in range(4)) + ".") for i in range(20)]
    clean = [zipf_text(rnd, 400) for _ in range(6)]
    texts = [f"{clean[0]} {items[3][1]} {clean[1]}", items[7][1].upper().replace(" ", "### "), *clean,
             f"{items[4][1]}\n{items[5][1]}", items[9][1].split(".")[0], None, ""]
    hits = hits_of(documents_of(spark, texts), spark.createDataFrame(items, ITEMS))
    sure = {i: sorted(h["item"] for h in hs if h["contaminated"]) for i, hs in hits.items()}
    assert {i: s for i, s in sure.items() if s} == {0: [3], 1: [7], 8: [4, 5]}
    assert len(hits) == len(texts)


@needs_data
def test_whole_table(spark):
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r for r in rows_of(queries.op8_decontamination(spark, SF))}
    assert got.keys() == documents.keys()
    for doc_id, text in documents.items():
        retrieved = {item for _, item in brute(items, text or "")}
        assert got[doc_id]["n_retrieved"] == len(retrieved)
        planted = {item for item, words in items if text and words in text}
        assert planted <= set(got[doc_id]["items"]) <= retrieved
        assert got[doc_id]["contaminated"] == bool(got[doc_id]["items"])
    assert 0 < sum(r["contaminated"] for r in got.values()) < len(got) / 4


def test_awkward_rows(spark):
    frame = awkward(spark)
    frame = frame.withColumn("hits", frame["key"])
    items = spark.createDataFrame(
        [(1, None), (2, ""), (None, "The same row twice, with enough words in it."), (3, "!!"), (4, "word and more")], ITEMS
    )
    rows = dc.find_items(frame, items).collect()
    assert len(rows) == 8
    assert [len(r.hits) for r in rows if r.doc_id == 5] == [1, 1]
    assert [r.hits for r in rows if r.doc_id in (1, 2, 3)] == [[], [], []]
    assert set(frame.columns) == set(rows[0].asDict())
    assert dc.find_items(empty(frame), items).collect() == []
    assert all(r.hits == [] for r in dc.find_items(frame, empty(items)).collect())
