"""Log probability of texts under context-tree weighting of their bytes.

A byte is eight binary decisions. Each decision has a context tree of its own, over the
``DEPTH`` bytes before (start and end of a text are the byte 0xFF, which UTF-8 has not).
Every node keeps how often the training texts went on with 0 and with 1; its Krichevsky-
Trofimov estimate is mixed with what its children say, weighted by how well either coded
the training texts (P_w = (P_e + prod P_w of the children) / 2; a leaf has P_w = P_e). The
weights stay as trained while texts are scored: -log2 is the code length of a text.

The counts are gathered from all training texts. Texts are dealt into blocks by a hash of
their row; each block sends its distinct contexts-with-byte and distinct words with their
training counts, as rows that Spark sums per key. The tree is worked bottom-up where all
contexts with the same last two bytes are together, at most 256 ** (DEPTH - 2) of them;
only sums per last byte (at most 256 x 255) pass through the driver. The results go back
to the blocks that asked, by join, and meet the texts there. So neither the model nor the
vocabulary is ever in one place.

The base score is that of an add-one unigram model of the lower-cased words and an end.

A null text is scored like an empty one, which is its end alone. Rows are scored each,
repeated or not. Without training texts every bit has probability one half.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from clicktide.llm.common import few_rows_a_batch, hash64, small_batches, tasks_for, text_bytes, written

DEPTH = 4
EDGE = 0xFF
BLOCK_BYTES = 16 << 20  # of text in a block
CHUNK_BYTES = 1 << 20  # of text whose contexts are held as numbers at once
KEYS_HELD = 1 << 17  # contexts with a byte that are worked at once, unless two last bytes have more
END = b"\xff"  # the end token's place among the words
WORD, CONTEXT = 0, 1


def _sequences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the contexts with the byte after them, and how many each text has."""
    lengths = np.array([len(t) + 1 for t in texts])
    edge = bytes([EDGE])
    data = np.frombuffer(b"".join(edge * DEPTH + t + edge for t in texts), np.uint8).astype(np.uint64)
    n = len(data) - DEPTH
    value = np.zeros(n, np.uint64)
    for i in range(DEPTH + 1):
        value = (value << np.uint64(8)) | data[i : i + n]
    starts = np.cumsum(lengths + DEPTH) - lengths - DEPTH
    inside = np.ones(n, bool)
    for i in range(DEPTH):  # the paddings between texts are not coded
        ends = starts[1:] - DEPTH + i
        inside[ends[ends >= 0]] = False
    return value[inside].astype(np.int64), lengths


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    every, place = np.unique(keys, return_inverse=True)
    return every, np.bincount(place, counts, len(every)).astype(np.int64)


def _chunks(table: pa.Table) -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
    """A block's texts, lower-cased, a part at a time, with their rows."""
    for rows in small_batches(table.to_batches(), "text", CHUNK_BYTES):
        texts = rows.column(rows.schema.get_field_index("text")).to_pylist()
        yield [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts], rows


def _block_keys(table: pa.Table) -> pa.Table:
    """A block's distinct words and contexts, with their counts in its training texts."""
    words: dict[bytes, int] = defaultdict(int)
    keys, counts = [], []
    for texts, rows in _chunks(table):
        held_out = rows.column(rows.schema.get_field_index("held_out")).to_pylist()
        for is_held in (False, True):
            chunk = [t for t, h in zip(texts, held_out, strict=True) if h == is_held]
            if not chunk:
                continue
            add = int(not is_held)
            for text in chunk:
                for word in text.split():
                    words[word] += add
            words[END] += add * len(chunk)
            found, n = np.unique(_sequences(chunk)[0], return_counts=True)
            keys.append(found)
            counts.append(n * add)
    contexts, n = _summed(keys, counts)
    block = table["block"][0].as_py()
    size = len(words) + len(contexts)
    return pa.table({
        "block": pa.array(np.full(size, block, np.int64)),
        "kind": pa.array(np.repeat([WORD, CONTEXT], [len(words), len(contexts)]).astype(np.int8)),
        "key": pa.array(np.r_[np.fromiter(map(hash64, words), np.int64, len(words)), contexts]),
        "n": pa.array(np.r_[np.fromiter(words.values(), np.int64, len(words)), n]),
    })


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Of x >= 0.5, by Stirling's series at x + 8."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def _estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - np.log(np.pi) - _lgamma(zeros + ones + 1.0)


def _next_bit(counts: tuple[np.ndarray, np.ndarray], bits: np.ndarray) -> np.ndarray:
    zeros, ones = counts
    return (np.where(bits == 1, ones, zeros) + 0.5) / (zeros + ones + 1)


def _decisions(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each context's byte: the eight bit prefixes (with a leading 1) and the bits."""
    byte = (keys & 0xFF)[:, None]
    k = np.arange(8)
    return ((1 << k) | (byte >> (8 - k))).ravel(), ((byte >> (7 - k)) & 1).ravel()


class Level:
    """The nodes of one depth: their counts, weights, and whose they are."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, below: Level | None):
        self.depth = depth
        prefix, self.bits = _decisions(keys)
        context = np.repeat((keys >> 8) & ((1 << 8 * depth) - 1), 8)
        self.nodes, self.at = np.unique((context << 8) | prefix, return_inverse=True)
        n = np.repeat(counts, 8).astype(float)
        size = len(self.nodes)
        self.counts = tuple(np.bincount(self.at, n * (self.bits == b), size) for b in (0, 1))
        own = _estimate(*self.counts)
        if below is None:
            self.weighted, self.beta = own, np.full(size, np.inf)
        else:
            parent = below.nodes & ((1 << 8 * (depth + 1)) - 1)
            children = np.bincount(np.searchsorted(self.nodes, parent), below.weighted, size)
            self.weighted, self.beta = np.logaddexp(own, children) - np.log(2), own - children

    def mixed(self, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of each decision's bit, given that of the level below."""
        own = _next_bit(tuple(c[self.at] for c in self.counts), self.bits)
        return own if deeper is None else _blend(self.beta[self.at], own, deeper)


def _blend(beta: np.ndarray, own: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    share = 1 / (1 + np.exp(-np.clip(beta, -700, 700)))
    return share * own + (1 - share) * deeper


def _levels(keys: np.ndarray, counts: np.ndarray) -> list[Level]:
    """From the leaves up to contexts of two bytes."""
    levels: list[Level] = []
    for depth in range(DEPTH, 1, -1):
        levels.append(Level(keys, counts, depth, levels[-1] if levels else None))
    return levels


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and counts of rows that are sorted by their contexts' last two bytes, some whole
    groups of these at a time: no more than ``KEYS_HELD`` keys, or one group."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        keys = np.r_[keys, batch.column("key").to_numpy()]
        counts = np.r_[counts, batch.column("n").to_numpy()]
        while len(keys) > KEYS_HELD:
            pairs = (keys >> 8) & 0xFFFF
            ends = np.flatnonzero(pairs[1:] != pairs[:-1]) + 1
            if not len(ends):
                break  # the group goes on in the next batch
            cut = int(ends[max(0, np.searchsorted(ends, KEYS_HELD, side="right") - 1)])
            yield keys[:cut], counts[:cut]
            keys, counts = keys[cut:], counts[cut:]
    if len(keys):
        yield keys, counts


def _top_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What contexts of two bytes give their parents, by last byte and bit prefix."""
    for keys, counts in _pairs_of(batches):
        top = _levels(keys, counts)[-1]
        parent, place = np.unique(top.nodes & 0xFFFF, return_inverse=True)
        sums = [np.bincount(place, x, len(parent)) for x in (*top.counts, top.weighted)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (parent, *sums)], ["node", "zeros", "ones", "children"]
        )


class TreeTop:
    """The nodes of the contexts of one byte and of none: at most 256 x 255 numbers."""

    def __init__(self, sums: pa.Table):
        node = sums["node"].to_numpy().astype(np.int64)
        one = {name: np.zeros(1 << 16) for name in ("zeros", "ones", "children")}
        for name, values in one.items():
            values[node] = sums[name].to_numpy()
        self.one = (one["zeros"], one["ones"])
        estimate = _estimate(*self.one)
        self.one_beta = estimate - one["children"]
        weighted = np.logaddexp(estimate, one["children"]) - np.log(2)
        self.none = tuple(c.reshape(256, 256).sum(axis=0) for c in self.one)
        self.none_beta = _estimate(*self.none) - weighted.reshape(256, 256).sum(axis=0)

    def mixed(self, keys: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        prefix, bits = _decisions(keys)
        node = (np.repeat((keys >> 8) & 0xFF, 8) << 8) | prefix
        one = _blend(self.one_beta[node], _next_bit(tuple(c[node] for c in self.one), bits), deeper)
        own = _next_bit(tuple(c[prefix] for c in self.none), bits)
        return _blend(self.none_beta[prefix], own, one)


def log_probabilities(keys: np.ndarray, counts: np.ndarray, top: TreeTop) -> np.ndarray:
    """log10 of the byte's probability in its context; the keys have all that share two bytes."""
    deeper = None
    for level in _levels(keys, counts):
        deeper = level.mixed(deeper)
    return np.log10(top.mixed(keys, deeper)).reshape(-1, 8).sum(axis=1)


def context_scores(contexts: DataFrame) -> DataFrame:
    """``key`` and ``value``: the log10 probabilities, from ``key`` and training count ``n``."""
    last_two = F.shiftright("key", 8).bitwiseAND(0xFFFF)
    kept = written(contexts, "lm-contexts")
    dealt = kept.repartition(tasks_for(kept), last_two).sortWithinPartitions(last_two)
    top = TreeTop(
        dealt.mapInArrow(_top_sums, "node long, zeros double, ones double, children double")
        .groupBy("node")
        .agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "children")))
        .toArrow()
    )

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _pairs_of(batches):
            values = log_probabilities(keys, counts, top)
            for at in range(0, len(keys), KEYS_HELD):
                part = slice(at, at + KEYS_HELD)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[part]), pa.array(values[part])], ["key", "value"]
                )

    return dealt.mapInArrow(score_rows, "key long, value double")


class Values:
    """The values of a block's words or contexts, by a hash table of their keys."""

    def __init__(self, table: pa.Table, kind: int):
        own = table.filter(pc.equal(table["kind"], kind))
        self.keys, self.values = pd.Index(own["key"].to_numpy()), own["value"].to_numpy()

    def of(self, keys: np.ndarray) -> np.ndarray:
        places = self.keys.get_indexer(keys)
        if len(places) and places.min() < 0:
            raise ValueError("the texts of a block have changed since their keys were gathered")
        return self.values[places]


def _block_scores(table: pa.Table, values: pa.Table) -> pa.Table:
    """Scores of a block's texts, from the values of its words and contexts."""
    word_counts, context_values = Values(values, WORD), Values(values, CONTEXT)
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    count_of = np.zeros(0)
    parts = []
    for texts, rows in _chunks(table):
        words = [[*text.split(), END] for text in texts]
        sizes = [len(w) for w in words]
        places = np.concatenate([np.fromiter(map(number.__getitem__, w), np.int32, len(w)) for w in words])
        new = list(islice(number, len(count_of), None))
        hashes = np.fromiter(map(hash64, new), np.int64, len(new))
        count_of = np.r_[count_of, word_counts.of(hashes)]
        counts = count_of[places]
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        keys, lengths = _sequences(texts)
        each = context_values.of(keys)
        parts.append(pa.table({
            "key": rows.column(rows.schema.get_field_index("key")),
            "held_out": rows.column(rows.schema.get_field_index("held_out")),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "n_tokens": pa.array(sizes, pa.int64()),
            "n_known": pa.array(np.add.reduceat((counts > 0).astype(np.int64), starts)),
            "base_sum": pa.array(np.add.reduceat(np.log10(counts + 1), starts)),
            "score": pa.array(np.add.reduceat(each, np.r_[0, np.cumsum(lengths)[:-1]])),
        }))
    return pa.concat_tables(parts)


def score_texts(texts: DataFrame, held_out: Column, key: str = "doc_id") -> DataFrame:
    """Learn from the rows that are not held out, score all.

    Per row: the key, ``held_out``, ``n_bytes``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` (log10 of the probability of the lower-cased text and its end)
    and ``bits_per_byte``, the code length over the bytes and the end.
    """
    few_rows_a_batch(texts.sparkSession)
    rows = texts.select(F.col(key).alias("key"), held_out.alias("held_out"), "text")
    kind = rows.schema["key"].dataType.simpleString()
    blocks = max(1, -(-text_bytes(texts) // BLOCK_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))
    keys = written(
        dealt.select("block", "held_out", "text").groupBy("block").applyInArrow(
            _block_keys, "block long, kind byte, key long, n long"
        ),
        "lm-keys",
    )
    totals = keys.groupBy("kind", "key").agg(F.sum("n").alias("n"))
    words = written(totals.where(F.col("kind") == WORD).select("key", "n"), "lm-words")
    sizes = words.agg(F.sum("n"), F.count(F.when(F.col("n") > 0, 1))).first()
    n, distinct = sizes[0] or 0, sizes[1]
    contexts = totals.where(F.col("kind") == CONTEXT).select("key", "n")
    values = (
        words.select(F.lit(WORD).cast("byte").alias("kind"), "key", F.col("n").cast("double").alias("value"))
        .union(context_scores(contexts).select(F.lit(CONTEXT).cast("byte"), "key", "value"))
    )
    asked = keys.drop("n").join(values, ["kind", "key"]).select("block", "kind", "key", "value")
    scored = (
        dealt.groupBy("block")
        .cogroup(asked.groupBy("block"))
        .applyInArrow(
            _block_scores,
            f"key {kind}, held_out boolean, n_bytes long, n_tokens long, n_known long, "
            "base_sum double, score double",
        )
    )
    base = F.col("base_sum") - F.col("n_tokens") * F.log10(F.lit(float(n + distinct + 1)))
    return scored.select(
        F.col("key").alias(key),
        "held_out",
        "n_bytes",
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
        (-F.col("score") / F.log10(F.lit(2.0)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
