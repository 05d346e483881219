"""Groups of near copies by SimHash: a Hamming join by the general pigeonhole principle.

A text's fingerprint has 64 bits: a bit is set if it is set in more than half of the XXH64
hashes (seed 42) of the text's three-word shingles, repeats included (lower-cased A-Z, words
between ASCII blanks; a text of fewer words is one shingle). Fingerprints link when at most
``MOST_APART`` bits differ; a group is what links connect.

1. Equal fingerprints become one class with its smallest id and its number of rows.
2. Bits are cut into partitions, correlated ones together. A partition of allowance e promises
   to find pairs that differ there in less than e bits (0: it is not probed). Allowances that
   sum to ``MOST_APART + 1`` find every link, as a pair missed by all would differ in more bits.
   Dynamic programming takes the cheapest allowances, and so the number of partitions, by the
   candidates to be expected: distances between ``SAMPLE`` fingerprints of least hash, scaled
   to all. The sample decides costs only, never results.
3. Probing: a partition of allowance e sends each class to the buckets of its bits there, with
   every choice of e - 1 of them masked. Buckets are counted first. One of more than
   ``BUCKET`` classes is probed further: the bits that vary in it are cut in as many parts as
   differing bits would have to meet plus one, so linked classes agree on one of them. Each
   round leaves two thirds of the varying bits, and few bits have few values, so this ends.
4. Verifying: in buckets of bounded size classes are compared, and links leave.
5. Components over classes, named by their smallest id, and joined back to the rows.

Null and empty texts have the fingerprint zero and link like any other. Rows that repeat an
id are rows of their own, as are rows with null ids; a component whose ids are all null has
none. Equal texts are one class, whatever their number. Texts are read whole. Empty tables
give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clicktide.llm.common import few_rows_a_batch, joined_to_totals, shuffles_for, small_batches, written
from clicktide.llm.components import components

BITS, SHINGLE_WORDS, SEED = 64, 3, 42
MOST_APART = 2
BUCKET = 1024
SAMPLE = 4096
PARTITIONS = (2, 3, 4)
# What a row sent to a bucket costs, in comparisons of two fingerprints.
ROW_COST = 40.0
_CHUNK = 1 << 16


def fingerprint(text: bytes) -> int:
    """The SimHash of a text in UTF-8, as a signed number."""
    words = text.lower().split()
    if len(words) > SHINGLE_WORDS:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS))))
        n = len(words) - SHINGLE_WORDS + 1
    else:
        shingles, n = iter([b" ".join(words)]), min(len(words), 1)
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    counts = np.zeros(BITS, np.int64)
    for start in range(0, n, _CHUNK):
        some = np.fromiter(hashes, np.dtype("<u8"), min(_CHUNK, n - start))
        bits = np.unpackbits(some.view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([fingerprint(t or b"") for t in texts], pa.int64())],
            names=["doc_id", "fingerprint"],
        )


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    few_rows_a_batch(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        _fingerprint_batches, f"doc_id {kind}, fingerprint long"
    )


def _as_bits(values: list[int]) -> np.ndarray:
    whole = np.array(values, "<i8")
    return np.unpackbits(whole.view(np.uint8), bitorder="little").reshape(-1, BITS)


def correlated_partitions(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in partitions of nearly equal size: each grows by the bit most correlated with it."""
    centred = bits - bits.mean(axis=0)
    spread = np.sqrt((centred * centred).sum(axis=0))
    spread[spread == 0] = 1
    strength = np.abs(centred.T @ centred) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    left, partitions = list(range(BITS)), []
    for number in range(parts):
        size = BITS * (number + 1) // parts - BITS * number // parts
        own = [max(left, key=lambda bit: strength[bit, left].max())]
        left.remove(own[0])
        while len(own) < size:
            own.append(max(left, key=lambda bit: strength[bit, own].sum()))
            left.remove(own[-1])
        partitions.append(sorted(own))
    return partitions


def _expected_costs(bits: np.ndarray, own: list[int], classes: int) -> list[float]:
    """Of each allowance from 0 on the cost of probing a partition."""
    ones = bits[:, own].astype(np.float32)
    weight = ones.sum(axis=1)
    apart = weight[:, None] + weight[None, :] - 2 * (ones @ ones.T)
    pairs = len(bits) * (len(bits) - 1) / 2
    width, costs = len(own), [0.0]
    for allowance in range(1, MOST_APART + 2):
        masked = allowance - 1
        met = buckets = 0.0
        for distance in range(allowance):
            seen = ((apart == distance).sum() - (len(bits) if distance == 0 else 0)) / 2
            at_random = _choose(width, distance) / 2.0**width
            # a pair that differs in fewer bits than are masked meets in several buckets
            met += (seen + at_random) / (pairs + 1) * _choose(width - distance, masked - distance)
        buckets = _choose(width, masked)
        costs.append(ROW_COST * buckets * classes + met * classes * (classes - 1) / 2)
    return costs


def _choose(n: int, k: int) -> int:
    result = 1
    for i in range(k):
        result = result * (n - i) // (i + 1)
    return result


def allocated(costs: list[list[float]]) -> tuple[float, list[int]]:
    """The cheapest allowances with the sum ``MOST_APART + 1``, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for of_partition in costs:
        longer: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, allowances) in best.items():
            for allowance, more in enumerate(of_partition):
                way = (cost + more, [*allowances, allowance])
                if total + allowance <= MOST_APART + 1 and way < longer.get(total + allowance, (np.inf, [])):
                    longer[total + allowance] = way
        best = longer
    return best[MOST_APART + 1]


def probe_masks(sample: list[int], classes: int) -> list[int]:
    """The bits to probe, as signed masks: fingerprints of a link agree under one of them."""
    bits = _as_bits(sample)
    plans = []
    for parts in PARTITIONS:
        partitions = correlated_partitions(bits.astype(float), parts)
        cost, allowances = allocated([_expected_costs(bits, own, classes) for own in partitions])
        plans.append((cost, parts, list(zip(partitions, allowances))))
    _, _, plan = min(plans)
    return [
        _mask(set(own) - set(masked))
        for own, allowance in plan
        if allowance
        for masked in combinations(own, allowance - 1)
    ]


def _mask(bits: set[int]) -> int:
    value = sum(1 << bit for bit in bits)
    return value - (1 << 64) if value >> 63 else value


def _bucket(mask: Column) -> Column:
    return F.struct(mask.alias("mask"), F.col("fingerprint").bitwiseAND(mask).alias("value"))


def _finer_masks(mask: Column, varying: Column) -> Column:
    """The mask with the constant bits and one of equal parts of the varying bits, for each part."""
    parts = MOST_APART + 1
    places = F.filter(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda bit: F.expr("1L").bitwiseAND(F.call_function("shiftrightunsigned", varying, bit)) == 1,
    )
    def part(number: int) -> Column:
        own = F.filter(places, lambda bit, at: at % parts == number)
        return F.aggregate(
            own, F.lit(0).cast("long"), lambda sum_, bit: sum_.bitwiseOR(F.call_function("shiftleft", F.expr("1L"), bit))
        )

    constant = mask.bitwiseOR(F.bitwise_not(varying))
    return F.array(*(constant.bitwiseOR(part(number)) for number in range(parts)))


def links(classes: DataFrame, masks: list[int]) -> DataFrame:
    """``u, v``: nodes of classes (``node, fingerprint``) at most ``MOST_APART`` bits apart."""
    probes = classes.select(
        "node", "fingerprint", F.inline(F.array(*(_bucket(F.lit(mask).cast("long")) for mask in masks)))
    )
    found = []
    while True:
        buckets = written(
            probes.groupBy("mask", "value")
            .agg(
                F.count("*").alias("size"),
                F.bit_or("fingerprint").bitwiseXOR(F.bit_and("fingerprint")).alias("varying"),
            )
            .where("size > 1"),
            "simhash-buckets",
        )
        is_large = F.col("size") > BUCKET
        met = written(joined_to_totals(probes, buckets, ["mask", "value"], "size"), "simhash-probes")
        one, other = (
            met.where(~is_large).select("mask", "value", F.col("node").alias(n), F.col("fingerprint").alias(f"{n}_bits"))
            for n in ("u", "v")
        )
        apart = F.bit_count(F.col("u_bits").bitwiseXOR(F.col("v_bits")))
        pairs = one.join(other, ["mask", "value"]).where((F.col("u_bits") < F.col("v_bits")) & (apart <= MOST_APART))
        found.append(written(pairs.select("u", "v").distinct(), "simhash-links"))
        if not buckets.where(is_large).limit(1).count():
            break
        finer = met.where(is_large).withColumn("finer", _finer_masks(F.col("mask"), F.col("varying")))
        probes = written(
            finer.select("node", "fingerprint", F.explode("finer").alias("mask"))
            .select("node", "fingerprint", F.inline(F.array(_bucket(F.col("mask")))))
            .distinct(),
            "simhash-finer",
        )
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every


def near_copies(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id, n_rows``: the last is the number of rows of the fingerprint."""
    with shuffles_for(documents):
        rows = written(fingerprints(documents), "fingerprints")
        counted = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("id"), F.count("*").alias("n_rows"))
        node = F.struct(F.col("id").isNull().alias("no_id"), "id", "fingerprint")
        classes = written(counted.withColumn("node", node), "simhash-classes")
        sample = [r.fingerprint for r in classes.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).collect()]
        if len(sample) > 1:
            linked = links(classes, probe_masks(sample, classes.count()))
            roots = components(linked).select("node", F.col("root.id").alias("component_id"))
            classes = written(
                classes.join(roots, "node", "left").withColumn("component_id", F.coalesce("component_id", "id")),
                "simhash-components",
            )
        else:
            classes = classes.withColumn("component_id", F.col("id"))
    totals = classes.select("fingerprint", "component_id", "n_rows")
    return joined_to_totals(rows, totals, ["fingerprint"], "n_rows")
