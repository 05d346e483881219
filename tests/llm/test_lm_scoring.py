"""Context-tree weighting against the recursion of its definition."""

import math
import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest

from clicktide.llm import lm_scoring, queries
from clicktide.llm.common import in_fold
from tests.llm.helpers import SF, awkward, documents_of, empty, needs_data, rows_of

DEPTH = lm_scoring.DEPTH


def sequence(text):
    return bytes([255] * DEPTH) + (text or "").encode().lower() + b"\xff"


class Tree:
    """Weighted probabilities by recursion over contexts and bit prefixes."""

    def __init__(self, texts):
        self.counts = Counter()
        for text in texts:
            data = sequence(text)
            for i in range(DEPTH, len(data)):
                for k in range(8):
                    prefix, bit = (1 << k) | (data[i] >> (8 - k)), (data[i] >> (7 - k)) & 1
                    for d in range(DEPTH + 1):
                        self.counts[data[i - d : i], prefix, bit] += 1
        self.contexts = {(c, p) for c, p, _ in self.counts}
        self.longer = {}
        for c, p in self.contexts:
            if c:
                self.longer.setdefault((c[1:], p), []).append((c, p))
        self.weighted = lru_cache(maxsize=None)(self._weighted)

    def estimate(self, node):
        a, b = self.counts[(*node, 0)], self.counts[(*node, 1)]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def children(self, node):
        return sum(self.weighted(child) for child in self.longer.get(node, []))

    def _weighted(self, node):
        if len(node[0]) == DEPTH:
            return self.estimate(node)
        return np.logaddexp(self.estimate(node), self.children(node)) - math.log(2)

    def bit(self, context, prefix, bit, depth=0):
        node = (context[len(context) - depth :], prefix)
        a, b = self.counts[(*node, 0)], self.counts[(*node, 1)]
        own = ((b if bit else a) + 0.5) / (a + b + 1)
        if depth == DEPTH:
            return own
        ratio = math.exp(min(700, self.estimate(node) - self.children(node)))
        return (ratio * own + self.bit(context, prefix, bit, depth + 1)) / (ratio + 1)

    def byte(self, context, byte):
        return sum(
            math.log10(self.bit(context, (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1)) for k in range(8)
        )

    def score(self, text):
        data = sequence(text)
        return sum(self.byte(data[i - DEPTH : i], data[i]) for i in range(DEPTH, len(data)))


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


def base_of(rows):
    train = Counter()
    for i, text in rows:
        if not held(i):
            train.update([*(text or "").encode().lower().split(), b"\xff"])
    total, distinct = sum(train.values()), len(train)
    result = {}
    for i, text in rows:
        tokens = [*(text or "").encode().lower().split(), b"\xff"]
        score = sum(math.log10((train[t] + 1) / (total + distinct + 1)) for t in tokens)
        result[i] = (held(i), len(tokens), sum(train[t] > 0 for t in tokens), total, score)
    return result


def check(rows, got, tree):
    expected = base_of(rows)
    assert len(got) == len(rows)
    for r in got:
        of = expected[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == of[:4]
        assert r["base_score"] == pytest.approx(of[4], rel=1e-9)
    if tree:
        for i, text in rows:
            assert next(r for r in got if r["doc_id"] == i)["score"] == pytest.approx(tree.score(text), rel=1e-9)


TEXTS = ["the cat sat on the mat", "The cat ate", None, "", "a", "aaaaaaaaaa aaaa", "größe ß", "the mat\nthe mat",
         "xyzzy", "on the mat the cat sat", "the", "cat", "sat on", "mat mat", "été", "the cat sat on the mat"]


def test_definition(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 64)
    rows = list(enumerate(TEXTS))
    assert {held(i) for i, _ in rows} == {True, False}
    got = rows_of(lm_scoring.score_texts(documents_of(spark, TEXTS), in_fold("doc_id", 7, 2)))
    check(rows, got, Tree([t for i, t in rows if not held(i)]))


def test_bytes_sum_to_one():
    tree = Tree(TEXTS)
    for context in (b"\xff\xff\xff\xff", b" the", b"zzzz"):
        assert sum(10 ** tree.byte(context, b) for b in range(256)) == pytest.approx(1)


def test_many_chunks_in_a_block(monkeypatch):
    texts = [t.encode() for t in ("one text", "", "two", "three three three")]
    whole, lengths = lm_scoring._sequences(texts)
    assert lengths.tolist() == [9, 1, 4, 18]
    parts = [lm_scoring._sequences([t])[0] for t in texts]
    assert whole.tolist() == np.concatenate(parts).tolist()


@needs_data
def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows_of(queries.op3_lm_scoring(spark, SF))
    check(rows, got, None)
    unseen = [r for r in got if r["held_out"] and r["n_tokens"] > 20]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen) * 1.5
    assert all(r["score"] < 0 for r in got)


def test_whole_query_by_the_definition(spark, folder):
    """The query over a planted table, every score by the recursion; equal texts score alike."""
    rnd = random.Random(9)
    words = ["the", "cat", "Sat", "on", "mat", "été", "x", "\n", "a-b", "😀", "Größe"]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 12))) for _ in range(120)] + [None, "", "the " * 300] + ["the cat"] * 9
    documents_of(spark, texts).repartition(5).write.parquet(f"{folder}/documents.parquet")
    got = rows_of(queries.op3_lm_scoring(spark, folder))
    rows = list(enumerate(texts))
    check(rows, got, Tree([t for i, t in rows if not held(i)]))
    assert len({r["score"] for r in got if texts[r["doc_id"]] == "the cat"}) == 1
    for r in got:
        size = len((texts[r["doc_id"]] or "").encode()) + 1
        assert r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / size, rel=1e-9)


def test_awkward_rows(spark):
    frame = awkward(spark, "word and more " * 5000)
    rows = lm_scoring.score_texts(frame, in_fold("doc_id", 7, 2)).collect()
    assert len(rows) == 8 and all(r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert lm_scoring.score_texts(empty(frame), in_fold("doc_id", 7, 2)).collect() == []


def test_nothing_to_learn_from(spark):
    from pyspark.sql import functions as F

    row = lm_scoring.score_texts(documents_of(spark, ["ab"]), F.lit(True)).first()
    assert row.score == pytest.approx(-24 * math.log10(2)) and row.train_tokens == 0
