"""Language of a text by its nearest centroid.

A text becomes a TF-IDF vector of its byte n-grams (lower case, everything but letters
one space), hashed into ``DIMENSIONS`` places and of length 1. Each language has a few
centroids, found by spherical k-means on a bounded sample of labelled rows: ``per_language``
texts of each language, those with the smallest hash of id and text. The closest centroid by
cosine names the language, ``score`` is that cosine; of equally close ones the first by name.

A text is rejected where it is farther from its centroid than its language's limit for its
length, as short texts are far from any centroid. The limits are set by leaving out one
language of the sample at a time: of the distances of its texts to the nearest centroid of
the other languages, the limit is below the one for which the shares of own texts beyond it
and of these texts within it have the smallest sum. The sample's texts and their beginnings
of 4, 8, 16, ... characters count, so that all lengths have texts. With one language there
is nothing to leave out: then the limit is ``REJECT_SPREADS`` standard deviations beyond the
mean distance of own texts. It is never beyond ``FURTHEST``.

Tasks fit one language each, and the limits of one length each. The driver holds a row of
names and counts, the centroids (48 KB) and the limits of every learnt language, no texts or
vectors of texts. Languages with fewer than ``least_rows`` labelled rows, as misspelt labels
have, are not learnt.

Texts without a letter, nulls and empty texts among them, get ``und``, score 0, and are
rejected. Texts of any length are counted whole. Repeated rows are each predicted alike, and
learnt as often as they occur. Without a labelled row every text is ``und``; an empty table
gives no rows. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F, types as T

from clicktide.llm.common import few_rows_a_batch, hash_share, small_batches, written

UNKNOWN = "und"
DIMENSIONS = 4096
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 200
LEAST_ROWS = 2
RANKED = 8
CENTROIDS = 3
LEAST_CLUSTER = 0.05  # of a language's texts: a few with a wrong label have no centroid
REJECT_SPREADS = 10.0
LEAST_SPREAD = 0.03
# A cosine of 0.05 is what texts of other scripts reach by colliding n-grams.
FURTHEST = 0.95
ROWS_COUNTED = 128  # whose counts are held at once
LENGTH_CLASSES = 24  # powers of two of the n-grams of a text
LEAST_TEXTS = 8  # of a length class that has a limit of its own
LEAST_FOREIGN = 20
LONGEST_BEGINNING = 1 << 16

_LETTER = regex.compile(r"\p{L}")
_LETTERS_ONLY = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))
_FACTORS = (2654435761, 2246822519, 3266489917)


def counted(texts: list[str]) -> np.ndarray:
    """Hashed n-gram counts, a row per text."""
    plain = [
        b" " + b" ".join(t.lower().encode("utf-8", "replace").translate(_LETTERS_ONLY).split()) + b" "
        for t in texts
    ]
    data = np.frombuffer(b"".join(plain) + bytes(2), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in plain])
    n = len(owner)
    total = np.zeros(len(texts) * DIMENSIONS)
    hashed = np.zeros(n, np.uint32)
    last_of = np.r_[owner, -1, -1]
    for order in range(1, max(ORDERS) + 1):
        hashed = hashed * np.uint32(31) + data[order - 1 : order - 1 + n] * np.uint32(_FACTORS[order - 1])
        if order in ORDERS:
            mixed = hashed * np.uint32(2654435769) + np.uint32(order)
            place = (mixed >> np.uint32(20)).astype(np.int64)
            whole = last_of[order - 1 : order - 1 + n] == owner
            total += np.bincount(
                (owner * DIMENSIONS + place)[whole], minlength=len(total)
            )
    return total.reshape(len(texts), DIMENSIONS)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Centroids:
    languages: list[str]
    idf: np.ndarray
    centers: np.ndarray  # language, centroid, dimension
    furthest: np.ndarray  # language, length class

    def cosines(self, counts: np.ndarray) -> np.ndarray:
        """Of each row the cosine with the closest centroid of each language."""
        vectors = _unit(np.log1p(counts) * self.idf).astype(np.float32)
        shape = self.centers.shape
        return (vectors @ self.centers.reshape(-1, shape[2]).T).reshape(-1, *shape[:2]).max(axis=2)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row the language's number, its cosine, and whether it is accepted."""
        cosine = self.cosines(counts)
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(best)), best].astype(float), 0, 1)
        return best, score, 1 - score <= self.furthest[best, length_class(counts)]


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(counts.sum(axis=1) + 1).astype(int), LENGTH_CLASSES - 1)


def _clustered(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means from the vectors farthest from each other."""
    centers = [_unit(vectors.mean(axis=0))]
    while len(centers) < CENTROIDS:
        centers.append(vectors[(vectors @ np.array(centers).T).max(axis=1).argmin()])
    centers = np.array(centers)
    for _ in range(20):
        nearest = (vectors @ centers.T).argmax(axis=1)
        new = np.array([
            _unit(vectors[nearest == k].mean(axis=0)) if (nearest == k).any() else centers[k]
            for k in range(CENTROIDS)
        ])
        if np.allclose(new, centers):
            break
        centers = new
    sizes = np.bincount((vectors @ centers.T).argmax(axis=1), minlength=CENTROIDS)
    centers[sizes < LEAST_CLUSTER * len(vectors)] = _unit(vectors.mean(axis=0))
    return centers


def _limit(own: np.ndarray, foreign: np.ndarray) -> float:
    """Near the largest foreign distance below which the two shares of errors have the smallest sum."""
    own, foreign = np.sort(own), np.unique(foreign, return_counts=True)
    values, before = foreign[0], np.cumsum(foreign[1]) - foreign[1]
    below = np.searchsorted(own, values)
    errors = 1 - below / len(own) + before / foreign[1].sum()
    at = np.flatnonzero(errors <= errors.min() + 1e-9)[-1]
    last = max(own[below[at] - 1] if below[at] else 0.0, values[at - 1] if at else 0.0)
    return values[at] - 0.1 * (values[at] - last)


def _limits_of_class(labels: np.ndarray, own: np.ndarray, foreign: np.ndarray, alone: bool) -> dict[int, float]:
    """Of the languages with enough texts of one length class the farthest accepted distance.

    ``foreign`` is each text's distance as if its own language were not known.
    """
    limits = {}
    for i in np.unique(labels):
        here = labels == i
        if here.sum() < LEAST_TEXTS:
            continue
        if alone:
            limits[int(i)] = own[here].mean() + REJECT_SPREADS * max(own[here].std(), LEAST_SPREAD)
        elif (~here).sum() >= LEAST_FOREIGN:
            limits[int(i)] = _limit(own[here], foreign[~here])
    return limits


def _furthest(languages: int, limits: dict[tuple[int, int], float]) -> np.ndarray:
    """Limits by language and length class; a class without one has that of the next shorter one,
    as texts get closer with length."""
    furthest = np.full((languages, LENGTH_CLASSES), FURTHEST)
    for i in range(languages):
        limit = FURTHEST
        for c in range(LENGTH_CLASSES):
            limit = limits.get((i, c), limit)
            furthest[i, c] = min(limit, FURTHEST)
    return furthest


def _beginnings(text: str) -> Iterator[str]:
    size = 4
    while size < min(len(text), LONGEST_BEGINNING):
        if _LETTER.search(text, 0, size):
            yield text[:size]
        size *= 2


def _dense(rows: list[dict]) -> np.ndarray:
    """Counts of rows with places and counts."""
    counts = np.zeros((len(rows), DIMENSIONS))
    for row, of in zip(counts, rows, strict=True):
        row[of["places"]] = of["counts"]
    return counts


def _counted_sample(sample: DataFrame) -> DataFrame:
    """``lang, whole, places, counts`` of the sampled texts and of their beginnings."""

    def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 19, ROWS_COUNTED):
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            yield counted_rows(texts, langs, True)
            begun = [(b, lang) for text, lang in zip(texts, langs, strict=True) for b in _beginnings(text)]
            for i in range(0, len(begun), ROWS_COUNTED):
                yield counted_rows(*map(list, zip(*begun[i : i + ROWS_COUNTED], strict=True)), False)

    def counted_rows(texts: list[str], langs: list[str], whole: bool) -> pa.RecordBatch:
        counts = counted(texts)
        places = [np.flatnonzero(row) for row in counts]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()),
                pa.array([whole] * len(texts)),
                pa.array([p.astype(np.int16) for p in places], pa.list_(pa.int16())),
                pa.array([row[p] for row, p in zip(counts, places, strict=True)], pa.list_(pa.float64())),
            ],
            ["lang", "whole", "places", "counts"],
        )

    return sample.select("text", "lang").mapInArrow(
        count_rows, "lang string, whole boolean, places array<short>, counts array<double>"
    )


def _clusters(idf: np.ndarray):
    """The centroids of one language's sample."""

    def cluster(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=lambda r: (sum(r["counts"]), r["places"], r["counts"]))  # they come in any order
        centers = _clustered(_unit(np.log1p(_dense(rows)) * idf)).astype(np.float32)
        return pa.table({"lang": [rows[0]["lang"]], "centers": pa.array([centers.tobytes()], pa.binary())})

    return cluster


def _measures(model: Centroids):
    """Of each counted text its language's number, length class, and distances."""
    number = {language: i for i, language in enumerate(model.languages)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_COUNTED):
                rows = batch.slice(start, ROWS_COUNTED).to_pylist()
                labels = np.array([number[r["lang"]] for r in rows])
                counts = _dense(rows)
                distances = 1 - model.cosines(counts).astype(float)
                own = distances[np.arange(len(rows)), labels]
                distances[np.arange(len(rows)), labels] = np.inf
                yield pa.RecordBatch.from_pydict({
                    "label": pa.array(labels, pa.int32()), "class": pa.array(length_class(counts), pa.int32()),
                    "own": own, "foreign": distances.min(axis=1),
                })

    return measure


def _limits(alone: bool):
    def limits(table: pa.Table) -> pa.Table:
        columns = (table[name].to_numpy() for name in ("label", "own", "foreign"))
        found = _limits_of_class(*columns, alone)
        return pa.table({
            "label": pa.array(found, pa.int32()), "class": pa.array([table["class"][0].as_py()] * len(found), pa.int32()),
            "limit": pa.array(found.values(), pa.float64()),
        })

    return limits


def fit(
    labelled: DataFrame, key: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE, least_rows: int = LEAST_ROWS
) -> Centroids | None:
    """From rows with key, text and lang; null and letterless texts and null langs are left out.

    ``per_language`` bounds the rows that a language is learnt from.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key", "text"), "key", "text")
    rows = labelled.select(F.col(key).alias("key"), "text", "lang").where(F.col("lang").isNotNull())
    # a row per learnt language, like the model; of frequent ones a few times the sample is ranked
    frequent = rows.groupBy("lang").agg(F.count("*").alias("rows")).where(F.col("rows") >= least_rows)
    shares = [(r.lang, min(1.0, RANKED * per_language / r.rows)) for r in frequent.collect()]
    if not shares:
        return None
    share = F.broadcast(labelled.sparkSession.createDataFrame(shares, "lang string, share double"))
    few = rows.join(share, "lang").where(
        (hash_share("key", "text") < F.col("share")) & F.col("text").rlike(r"\p{L}")
    )
    sample = few.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_language)
    sparse = written(_counted_sample(sample), "language-sample")

    whole = sparse.where("whole")
    texts = whole.count()
    having = np.zeros(DIMENSIONS)
    for row in whole.select(F.explode("places").alias("place")).groupBy("place").count().collect():
        having[row.place] = row["count"]
    idf = np.log((1 + texts) / (1 + having)) + 1
    fitted = whole.groupBy("lang").applyInArrow(_clusters(idf), "lang string, centers binary").collect()
    if not fitted:
        return None
    fitted.sort(key=lambda r: r.lang)
    languages = [r.lang for r in fitted]
    centers = np.array([np.frombuffer(r.centers, np.float32).reshape(CENTROIDS, DIMENSIONS) for r in fitted])
    model = Centroids(languages, idf, centers, _furthest(len(languages), {}))
    limits = (
        sparse.mapInArrow(_measures(model), "label int, class int, own double, foreign double")
        .groupBy("class")
        .applyInArrow(_limits(len(languages) == 1), "label int, class int, limit double")
        .collect()
    )
    limit_of = {(r["label"], r["class"]): r["limit"] for r in limits}
    return Centroids(languages, idf, centers, _furthest(len(languages), limit_of))


def predict(texts: DataFrame, model: Centroids | None, into: tuple[str, str, str]) -> DataFrame:
    """All columns of the table and three more: language, score, accepted.

    The model is a few vectors per language, so it travels with the tasks. ``into`` names
    the new columns, which replace columns of these names.
    """
    few_rows_a_batch(texts.sparkSession)
    texts = texts.drop(*into)
    names = texts.columns

    def predict_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 19, ROWS_COUNTED):
            rows = [text or "" for text in batch.column(names.index("text")).to_pylist()]
            readable = [i for i, text in enumerate(rows) if _LETTER.search(text)] if model else []
            found = np.full(len(rows), UNKNOWN, dtype=object)
            score, accepted = np.zeros(len(rows)), np.zeros(len(rows), bool)
            if readable:
                best, score[readable], accepted[readable] = model.predict(
                    counted([rows[i] for i in readable])
                )
                found[readable] = np.array(model.languages, dtype=object)[best]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(score), pa.array(accepted)],
                [*names, *into],
            )

    schema = T.StructType(list(texts.schema.fields)).add(into[0], "string").add(into[1], "double")
    return texts.mapInArrow(predict_rows, schema.add(into[2], "boolean"))
