"""Vector codes against plain Lloyd rounds over Python's integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from clicktide.llm import common, queries, vector_codes
from tests.llm.helpers import SF, empty, needs_data, rows_of

LAYOUT = "vec_id long, embedding array<double>, label int"


def brute(rows):
    """The contract, row by row: results per row in the order of ids, and the codebooks' hash."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = [[math.floor(x * 1024) for x in r[1]] for r in kept]
    width = len(vectors[0]) // 4
    parts = [[tuple(v[p * width : (p + 1) * width]) for v in vectors] for p in range(4)]
    books, errors, codes = [], [0] * len(kept), [""] * len(kept)

    def nearest(part, book):
        distances = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in book]
        best = min(distances)
        return distances.index(best), best

    for own in parts:
        book = [list(p) for p in own[:256]]
        for _ in range(4):
            groups, memo = defaultdict(list), {}
            for part in own:
                if part not in memo:
                    memo[part] = nearest(part, book)[0]
                groups[memo[part]].append(part)
            for entry, members in groups.items():
                book[entry] = [sum(column) // len(members) for column in zip(*members)]
        for i, part in enumerate(own):
            index, error = nearest(part, book)
            codes[i] += f"{index:02x}"
            errors[i] += error
        books.append(book)
    by_label = defaultdict(int)
    for row, error in zip(kept, errors):
        by_label[row[2]] += error
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(
        (str(r[0]), c, e, by_label[r[2]], digest) for r, c, e in zip(kept, codes, errors)
    )


def found(spark, folder, rows, layout=LAYOUT):
    spark.createDataFrame(rows, layout).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    got = rows_of(queries.op12_vector_codes(spark, folder))
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got)


def clustered(n, width, seed, spread=0.02):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(width)] for _ in range(12)]
    return [
        (i, [x + rnd.gauss(0, spread) for x in rnd.choice(centres)], rnd.choice([None, 1, 2, 2, 2]))
        for i in range(n)
    ]


@pytest.mark.parametrize("width,spread", [(4, 0.02), (16, 0.3), (8, 0.0)])
def test_against_plain_rounds(spark, folder, monkeypatch, width, spread):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 100)
    rows = clustered(700, width, 3, spread)
    assert found(spark, folder, rows) == brute(rows)


def test_few_repeated_and_unusable_rows(spark, folder):
    rows = clustered(20, 8, 5) * 2 + [(90, None, 1), (91, [None] * 8, 1), (92, [math.nan] + [0.0] * 7, 1),
                                      (93, [math.inf] + [0.0] * 7, None), (None, [0.5] * 8, None), (-1, [0.0] * 8, 7)]
    assert found(spark, folder, rows) == brute(rows)


def test_large_numbers(spark, folder):
    rnd = random.Random(2)
    rows = [(i, [rnd.choice([0.1, 1.0, -3e5]) * rnd.random() for _ in range(8)], i % 3) for i in range(300)]
    assert found(spark, f"{folder}/wide", rows) == brute(rows)
    far = [(i, [rnd.choice([1e4, 1e30, -1e30]) * (1 + i % 7) for _ in range(4)], 1) for i in range(30)]
    expected = [(*r[:2], r[2] if r[2] < 2**63 else None) for r in brute(far)]
    got = found(spark, f"{folder}/far", far)
    assert [r[:3] for r in got] == expected and {r[4] for r in got} == {brute(far)[0][4]}


def test_other_lengths_have_no_code(spark, folder):
    rows = clustered(30, 8, 1) + [(100, [1.0] * 4, 5), (101, [], 5), (102, [1.0] * 9, None)]
    got = found(spark, folder, rows)
    own = brute(rows[:30])
    assert sorted(r for r in got if r[1]) == own and len(got) == 33
    odd = spark.createDataFrame([(1, [1.0] * 6, 1), (2, [1.0] * 8, 1)], LAYOUT)
    assert [r.code for r in vector_codes.compress(odd).rows.collect()] == [None, None]


def test_empty_and_extra_columns(spark, folder):
    frame = spark.createDataFrame([(1, [0.5] * 8, None, "x"), (1, [0.5] * 8, None, None)], f"{LAYOUT}, code string")
    for name in ("ids", "labels", "trees", "error", "n", "label_error", "label_rows", "part"):
        frame = frame.withColumn(name, frame["code"])
    assert [(r.code, r.error, r.label_error) for r in vector_codes.compress(frame).rows.collect()] == [("00000000", 0, 0)] * 2
    nothing = vector_codes.compress(empty(frame))
    assert nothing.rows.collect() == [] and nothing.codebooks == [[], [], [], []]


@needs_data
def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = rows_of(queries.op12_vector_codes(spark, SF))
    assert sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == brute(rows)


def test_trees_cover_and_settle_subtrees():
    points = vector_codes._integers(np.array([r[1] for r in clustered(600, 6, 9, 0.004)]))
    order, tree = vector_codes.cover_tree(points)
    assert sorted(order) == list(range(600))
    for node in tree:
        inside = points[order[node["start"] : node["end"]]].astype(int) - points[node["centre"]]
        assert (inside**2).sum(axis=1).max() == node["radius2"]
        children = tree[node["child"] : node["last"]]
        if len(children):
            assert children["start"][0] == node["start"] and children["end"][-1] == node["end"]
            assert (children["radius2"] <= node["radius2"] / 4).all()
    middles = {}  # a point of each cluster
    for point in points:
        if all(((point - other) ** 2).sum() > 100**2 for other in middles.values()):
            middles[len(middles)] = point.astype(np.int64)
    entries = np.array(list(middles.values()))
    assert len(entries) == 12
    seen, visits = np.zeros(600, int), 0
    exact = vector_codes._squares(points, entries).argmin(axis=1)
    for settled, best in vector_codes.nearest_entries(points, entries, order, tree):
        for node, entry in zip(tree[settled], best):
            inside = order[node["start"] : node["end"]]
            assert (exact[inside] == entry).all()
            seen[inside] += 1
            visits += 1
    assert (seen == 1).all() and visits < 60  # whole subtrees, not points


def test_totals_of_heavy_and_light_keys(spark):
    rows = spark.range(5000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) AS k", "id")
    totals = rows.groupBy("k").count()
    got = common.joined_to_totals(rows, totals, ["k"], "count")
    counts = {r.k: r["count"] for r in totals.collect()}
    assert sorted((r.id, r["count"]) for r in got.collect()) == sorted((r.id, counts[r.k]) for r in rows.collect())
