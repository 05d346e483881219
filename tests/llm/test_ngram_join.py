"""Near-copy groups against all pairs of texts."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from clicktide.llm import components, ngram_join, queries
from tests.llm.helpers import SF, awkward, documents_of, empty, needs_data, rows_of


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    """doc_id -> (size, component) of rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def found(frame):
    return {
        r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(ngram_join.near_copies(frame))
    }


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"e{rnd.random():.6f}"
    return " ".join(words)


def family_texts(seed=0, families=12, members=14):
    """Families of near copies at similarities around the threshold, with shared passages."""
    rnd = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = []
    for f in range(families):
        base = [f"w{f}_{i}" for i in range(rnd.randint(6, 150))]
        for _ in range(members):
            text = edited(rnd, base, rnd.randint(0, 1 + len(base) // 25))
            texts.append(f"{text} {passage}" if rnd.random() < 0.3 else text)
    texts += ["a b c", "A  b\tC", "a b", "x y z q", "", None, " \n", passage, passage.upper(), "a b c d e f"]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_families(spark, seed):
    texts = family_texts(seed)
    assert found(documents_of(spark, texts)) == brute(list(enumerate(texts)))


def test_large_groups_are_split_in_cells(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL_NGRAMS", 600)
    monkeypatch.setattr(ngram_join, "BLOCK_NGRAMS", 2000)
    texts = family_texts(3, families=4, members=60)
    assert found(documents_of(spark, texts).repartition(3)) == brute(list(enumerate(texts)))


def test_exactly_at_the_threshold(spark):
    base = [f"w{i}" for i in range(40)]  # 36 n-grams
    cut = base[:-1] + ["x"]  # 35 common, union 37
    edge = [f"v{i}" for i in range(13)]  # 9 n-grams
    less = edge[:-1]  # 8 of 9: linked
    least = edge[:-2]  # 7 of 9: not, but 7 of 8 with the former
    texts = [" ".join(t) for t in (base, cut, edge, least, less)]
    assert found(documents_of(spark, texts)) == brute(list(enumerate(texts)))


@needs_data
def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows_of(queries.op4_ngram_join(spark, SF))}
    assert got == brute(rows)


def test_awkward_rows(spark):
    frame = awkward(spark)
    rows = ngram_join.near_copies(frame).collect()
    assert len(rows) == 8
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0
    assert by_id[1].component_id == 1 and by_id[1].group is None
    assert by_id[5].component_id == 5 and by_id[None].component_id is None
    assert sum(r.doc_id == 5 for r in rows) == 2
    assert ngram_join.near_copies(empty(frame)).collect() == []


def test_repeated_id_with_other_text(spark):
    rows = [(1, "a b c d e f"), (1, "q r s t u v"), (0, "q r s t u v"), (None, "a b c d e f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id) for r in ngram_join.near_copies(frame).collect())
    assert got == [(-1, 1), (0, 0), (1, 0), (1, 1)]


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    roots = components.components(edges.union(spark.createDataFrame([(1000, 1001)], edges.schema)))
    assert {(r.node, r.root) for r in roots.collect()} == {(i, 0) for i in range(301)} | {(1000, 1000), (1001, 1000)}
