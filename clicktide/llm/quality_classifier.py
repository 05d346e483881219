"""Text quality from a byte-level convolutional network in numpy.

Bytes are embedded, those that continue a repetition (the last four bytes came before, up
to ``REACH`` bytes back) by an embedding of their own; filters respond to overlapping chunks (``WIDTH`` bytes, every
``STRIDE``) that cover the whole text; each filter's largest response over all chunks goes
into two dense layers that give one probability. The network is trained here, on the
driver, on a bounded sample: the ``sample`` labelled rows with the smallest hash of their
id, as far as their texts have ``sample_bytes`` together; a row that would exceed that is
not learnt from. Training and scoring take every chunk of every text, in pieces of bounded
size. Of chunks with equal responses the first counts.

A null or empty text is one chunk of padding and gets the score that it has. Rows without
a label or a text are not learnt from; a row with several labels has the lowest. Without
labels every score is 0.5, and an empty table has no scores. Repeated rows are scored each;
texts of any length are read whole; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clicktide.llm.common import few_rows_a_batch, hash_share, small_batches

WIDTH, STRIDE = 16, 8
EMBEDDING, FILTERS, HIDDEN = 8, 32, 16
PADDING, SYMBOLS = 256, 514  # bytes, the padding, and repeated bytes
GRAM, REACH = 4, 24
SAMPLE, SAMPLE_BYTES = 2000, 64 << 20
RANKED = 8
EPOCHS, BATCH, RATE = 8, 16, 3e-3
PIECE = 1 << 17  # bytes of text whose chunks are held at once

Weights = dict[str, np.ndarray]


def symbols_of(text: bytes) -> np.ndarray:
    """The text's bytes, those that continue a repetition raised by 257."""
    symbols = np.frombuffer(text, np.uint8).astype(np.int16)
    n = len(text) - GRAM + 1
    if n < 3:
        return symbols
    data = np.frombuffer(text, np.uint8).astype(np.uint32)
    grams = np.zeros(n, np.uint32)
    for i in range(GRAM):
        grams = (grams << np.uint32(8)) | data[i : i + n]
    repeated = np.zeros(n, bool)
    for back in range(2, min(REACH, n - 1) + 1):
        repeated[back:] |= grams[back:] == grams[:-back]
    symbols[GRAM - 1 :][repeated] += PADDING + 1
    return symbols


def _chunk_starts(n: int) -> int:
    return max(1, -(-n // STRIDE))


def _embedded(weights: Weights, chunks: np.ndarray) -> np.ndarray:
    return weights["embedding"][chunks].reshape(*chunks.shape[:-1], WIDTH * EMBEDDING)


def _responses(weights: Weights, inputs: np.ndarray) -> np.ndarray:
    return np.maximum(inputs @ weights["filters"] + weights["bias"], 0)


def _combined(weights: Weights, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(pooled @ weights["dense"] + weights["dense_bias"], 0)
    out = hidden @ weights["out"] + weights["out_bias"]
    return 1 / (1 + np.exp(-np.clip(out, -30, 30))), hidden


def pooled_of(weights: Weights, texts: list[bytes]) -> np.ndarray:
    """The largest response of every filter over all chunks of each text."""
    result = np.zeros((len(texts), FILTERS), np.float32)
    at, buffers, owners, size = 0, [], [], 0

    def flush() -> None:
        nonlocal buffers, owners, size
        if not buffers:
            return
        data = np.concatenate(buffers)
        embedded = weights["embedding"][data]
        n = (len(data) - WIDTH) // STRIDE + 1
        step = embedded.strides[0] * STRIDE
        windows = np.lib.stride_tricks.as_strided(
            embedded, (n, WIDTH * EMBEDDING), (step, embedded.itemsize)
        )
        responses = _responses(weights, windows)
        starts, owner, ends = [], [], []
        place = 0
        for buffer, who in zip(buffers, owners, strict=True):
            starts.append(place)
            place += len(buffer) // STRIDE
            ends.append(place - 1)  # the chunk from the padding on belongs to no text
            owner.append(who)
        responses[[e for e in ends if e < n]] = 0
        np.maximum.at(result, owner, np.maximum.reduceat(responses, starts, axis=0))
        buffers, owners, size = [], [], 0

    for at, text in enumerate(texts):
        data = symbols_of(text)
        for start in range(0, max(len(data), 1), PIECE):
            piece = data[start : start + PIECE + WIDTH - STRIDE]
            count = _chunk_starts(min(len(data) - start, PIECE))
            padded = np.full((count + 1) * STRIDE, PADDING, np.int16)
            padded[: min(len(piece), len(padded))] = piece[: len(padded)]
            buffers.append(padded)
            owners.append(at)
            size += len(padded)
            if size >= PIECE:
                flush()
    flush()
    return result


def score(weights: Weights | None, texts: list[bytes]) -> np.ndarray:
    if weights is None:
        return np.full(len(texts), 0.5)
    return _combined(weights, pooled_of(weights, texts))[0].astype(float).ravel()


def padded_symbols(text: bytes) -> np.ndarray:
    """The text's symbols, with padding behind the last chunk."""
    padded = np.full((_chunk_starts(len(text)) + 1) * STRIDE, PADDING, np.int16)
    padded[: len(text)] = symbols_of(text)
    return padded


def chunks_of(symbols: np.ndarray) -> np.ndarray:
    """All chunks of padded symbols, as a view."""
    return np.lib.stride_tricks.sliding_window_view(symbols, WIDTH)[::STRIDE]


def _largest(weights: Weights, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each filter the chunk with the largest response, and that response."""
    step = PIECE // STRIDE
    winners, largest = chunks[np.zeros(FILTERS, int)], np.full(FILTERS, -1.0, np.float32)
    for start in range(0, len(chunks), step):
        piece = chunks[start : start + step]
        responses = _responses(weights, _embedded(weights, piece))
        best = responses.argmax(axis=0)
        response = responses[best, np.arange(FILTERS)]
        better = response > largest
        winners[better], largest[better] = piece[best[better]], response[better]
    return winners, largest


def train(chunks: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Weights:
    """Adam on the log loss. Only the chunk that won a filter's maximum gets its gradient."""
    rng = np.random.default_rng(seed)

    def drawn(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)

    share = np.clip(labels.mean(), 0.01, 0.99)
    weights: Weights = {
        "embedding": (rng.standard_normal((SYMBOLS, EMBEDDING)) * 0.5).astype(np.float32),
        "filters": drawn(WIDTH * EMBEDDING, FILTERS),
        "bias": np.zeros(FILTERS, np.float32),
        "dense": drawn(FILTERS, HIDDEN),
        "dense_bias": np.zeros(HIDDEN, np.float32),
        "out": drawn(HIDDEN, 1) * np.float32(0.3),
        "out_bias": np.full(1, np.log(share / (1 - share)), np.float32),
    }
    first = {name: np.zeros_like(w) for name, w in weights.items()}
    second = {name: np.zeros_like(w) for name, w in weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        order = rng.permutation(len(chunks))
        for start in range(0, len(order), BATCH):
            picked = order[start : start + BATCH]
            pooled, winners = [], []
            for i in picked:
                winner, largest = _largest(weights, chunks[i])
                winners.append(winner)  # filter, width
                pooled.append(largest)
            pooled = np.array(pooled)
            probability, hidden = _combined(weights, pooled)
            wrong = ((probability.ravel() - labels[picked]) / len(picked))[:, None].astype(np.float32)
            to_hidden = (wrong @ weights["out"].T) * (hidden > 0)
            to_pooled = (to_hidden @ weights["dense"].T) * (pooled > 0)
            inputs = _embedded(weights, np.array(winners))  # text, filter, input
            to_inputs = to_pooled[:, :, None] * weights["filters"].T[None]
            embedding = np.zeros_like(weights["embedding"])
            np.add.at(
                embedding,
                np.array(winners).ravel(),
                to_inputs.reshape(-1, EMBEDDING),
            )
            gradients = {
                "out": hidden.T @ wrong,
                "out_bias": wrong.sum(axis=0),
                "dense": pooled.T @ to_hidden,
                "dense_bias": to_hidden.sum(axis=0),
                "filters": np.einsum("tfi,tf->if", inputs, to_pooled),
                "bias": to_pooled.sum(axis=0),
                "embedding": embedding,
            }
            step += 1
            for name, g in gradients.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                moved = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                weights[name] -= (rate * moved).astype(np.float32)
    return weights


def fit(
    texts: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality",
    sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES,
) -> Weights | None:
    """From the labelled rows of ``texts``; the sampled ids alone are sent to all tasks."""
    labelled = (
        labels.select(F.col(key).alias("key"), F.col(label).alias("label"))
        .dropna()
        .groupBy("key")
        .agg(F.min("label").cast("double").alias("label"))
    )
    share = min(1.0, RANKED * sample / max(1, labels.count()))
    few = labelled.where(hash_share("key") < share)  # a few times the sample is ranked
    picked = few.orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = texts.select(F.col(key).alias("key"), "text").where(F.col("text").isNotNull())
    # at most the sample's rows are ranked by one task, without their texts
    size = F.octet_length("text").alias("size")
    order = Window.orderBy("hash", "key", "digest")
    fitting = (
        rows.join(F.broadcast(picked), "key")
        .select("key", F.xxhash64("key").alias("hash"), F.xxhash64("text").alias("digest"), size)
        .orderBy("hash", "key", "digest")
        .limit(sample)
        .withColumn("nth", F.row_number().over(order))
        .withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where(F.col("upto") <= sample_bytes)
        .groupBy("key", "digest")
        .agg(F.first("hash").alias("hash"))
    )

    def symbol_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            symbols = [padded_symbols(text.encode()).tobytes() for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(symbols, pa.binary())], ["hash", "label", "symbols"]
            )

    learnt = (
        rows.join(F.broadcast(picked), "key")
        .withColumn("digest", F.xxhash64("text"))
        .join(F.broadcast(fitting), ["key", "digest"])
        .select("hash", "label", "text")
        .mapInArrow(symbol_rows, "hash long, label double, symbols binary")
        .orderBy("hash", "symbols")
        .limit(sample)
        .toArrow()
    )
    if not learnt.num_rows:
        return None
    chunks = [chunks_of(np.frombuffer(symbols, np.int16)) for symbols in learnt["symbols"].to_pylist()]
    return train(chunks, np.array(learnt["label"].to_pylist()))


def classify(texts: DataFrame, weights: Weights | None, key: str = "doc_id") -> DataFrame:
    """The key and ``score`` of every row. The weights are of fixed size and go with the tasks."""

    few_rows_a_batch(texts.sparkSession)

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            data = [(text or "").encode() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score(weights, data), pa.float64())], ["key", "score"]
            )

    rows = texts.select(F.col(key).alias("key"), "text")
    key_type = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(score_rows, f"key {key_type}, score double").withColumnRenamed("key", key)
