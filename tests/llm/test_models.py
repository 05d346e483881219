"""Language and quality models: held-out accuracy, awkward rows, exactness of the pooling."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicktide.llm import language_id as li, quality_classifier as qc, queries
from clicktide.llm.common import in_fold
from tests.llm.helpers import DOCUMENTS, SF, awkward, documents_of, empty, needs_data, rows_of

BIG = SF.replace("0.001", "0.01")
NEW = ("lang_pred", "score", "accepted")


@pytest.fixture(scope="module")
def languages(spark):
    return li.fit(spark.read.parquet(f"{BIG}/documents.parquet"))


@needs_data
def test_held_out_languages(spark):
    documents = {r.doc_id: r.lang for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    got = rows_of(queries.op7_language_id(spark, BIG))
    assert len(got) == len(documents)
    unseen = [r for r in got if r["held_out"]]
    right = sum(r["lang_pred"] == documents[r["doc_id"]] for r in unseen)
    assert len(unseen) > 150 and right >= 0.98 * len(unseen)
    assert all(0 <= r["score"] <= 1 for r in got)
    assert sum(r["accepted"] for r in got) >= 0.97 * len(got)


@needs_data
def test_far_texts_are_rejected(spark, languages):
    texts = ["Привет, как дела сегодня вечером, друзья мои?", "這是一個用來測試的文件", "1234 !!", None, "", "   "]
    rows = rows_of(li.predict(documents_of(spark, texts), languages, NEW))
    assert not any(r["accepted"] for r in rows)
    assert [r["lang_pred"] for r in sorted(rows, key=lambda r: r["doc_id"])][2:] == [li.UNKNOWN] * 4


@needs_data
@pytest.mark.parametrize("left_out", ["de", "es"])
def test_a_language_that_was_not_learnt_is_rejected(spark, left_out):
    documents = spark.read.parquet(f"{BIG.replace('0.01', '0.1')}/documents.parquet").where(F.length("text") >= 20)
    model = li.fit(documents.where((F.col("lang") != left_out) & ~in_fold("doc_id", 4, 2)))
    unseen = documents.where(in_fold("doc_id", 4, 2))
    kept = {r.lang: r.share for r in li.predict(unseen, model, NEW).groupBy("lang").agg(
        F.avg(F.col("accepted").cast("int")).alias("share")).collect()}
    assert kept.pop(left_out) <= 0.05
    assert min(kept.values()) >= 0.95


@needs_data
def test_random_letters_are_rejected(spark, languages):
    letters = np.random.default_rng(2).choice(list("abcdefghijklmnopqrstuvwxyz      "), (40, 300))
    texts = ["".join(row[: 20 + 7 * i]) for i, row in enumerate(letters)]
    assert not any(r["accepted"] for r in rows_of(li.predict(documents_of(spark, texts), languages, NEW)))


@needs_data
def test_language_of_awkward_rows(spark, languages):
    frame = awkward(spark)
    rows = li.predict(frame, languages, NEW).collect()
    assert len(rows) == 8 and set(rows[0].asDict()) == set(frame.columns) | set(NEW)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {li.UNKNOWN}
    assert li.predict(empty(frame), languages, NEW).collect() == []
    assert li.fit(empty(frame)) is None
    assert {r.lang_pred for r in li.predict(frame, None, NEW).collect()} == {li.UNKNOWN}
    assert li.fit(frame) is not None


@pytest.mark.parametrize("key", [None, 7])
def test_many_rows_without_ids_of_their_own_are_learnt(spark, key):
    rows = spark.range(8000).select(
        F.lit(key).cast("long").alias("doc_id"),
        F.concat(F.when(F.col("id") % 2 == 0, "the house is near ").otherwise("das Haus ist nahe "), F.conv("id", 10, 36)).alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("de").alias("lang"),
    )
    model = li.fit(rows)
    assert model is not None and model.languages == ["de", "en"]
    assert rows_of(li.predict(rows.limit(50), model, NEW).where("lang_pred <> lang")) == []


def test_counts_are_of_each_text_alone():
    texts = ["Das ist ein Text", "", "another, text!", "x"]
    together = li.counted(texts)
    for i, text in enumerate(texts):
        assert (li.counted([text])[0] == together[i]).all()


def plain_model(rows):
    """The fit as its docstring says it, on one machine: languages, vectors' weights, centroids, limits."""
    rows = [(t, lang) for t, lang in rows if lang is not None and li._LETTER.search(t or "")]
    languages = sorted({lang for _, lang in rows})
    counts = li.counted([t for t, _ in rows])
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1

    def vectors(c):
        v = np.log1p(c) * idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    centers = []
    for language in languages:
        own = [counts[i] for i, (_, lang) in enumerate(rows) if lang == language]
        own.sort(key=lambda c: (c.sum(), np.flatnonzero(c).tolist(), c[c > 0].tolist()))
        centers.append(li._clustered(vectors(np.array(own))))

    def distances(c):
        v = vectors(c)
        return np.array([[min(1 - x @ center for center in of) for of in centers] for x in v])

    measured = [(t, lang) for t, lang in rows] + [(b, lang) for t, lang in rows for b in li._beginnings(t)]
    c = li.counted([t for t, _ in measured])
    d, classes = distances(c), li.length_class(c)
    labels = np.array([languages.index(lang) for _, lang in measured])
    furthest = np.full((len(languages), li.LENGTH_CLASSES), li.FURTHEST)
    for i in range(len(languages)):
        limit = li.FURTHEST
        for k in range(li.LENGTH_CLASSES):
            own, others = (labels == i) & (classes == k), (labels != i) & (classes == k)
            if own.sum() >= li.LEAST_TEXTS and others.sum() >= li.LEAST_FOREIGN:
                hidden = [np.delete(row, label).min() for row, label in zip(d[others], labels[others])]
                limit = li._limit(d[own, i], np.array(hidden))
            furthest[i, k] = min(limit, li.FURTHEST)
    return languages, distances, furthest


def test_whole_query_on_planted_rows(spark, folder):
    rnd = np.random.default_rng(5)
    alphabets = {"xa": "abcdefgh", "xb": "ijklmnop", "xc": "aeimquty"}

    def text(language, words):
        return " ".join("".join(rnd.choice(list(alphabets[language]), rnd.integers(2, 8))) for _ in range(words))

    planted = [(i, text(lang, int(rnd.integers(1, 40))), lang) for i, lang in enumerate(["xa", "xb", "xc"] * 50)]
    planted += [(900 + i, None if i % 2 else "12 34", "xa") for i in range(8)] + [(950, text("xa", 5), None)]
    planted += [(960 + i, "zzz wwww vvv " * 9, None) for i in range(4)]
    rows = [(i, t, lang, f"s{i % 3}", len(t or "")) for i, t, lang in planted]
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: r for r in rows_of(queries.op7_language_id(spark, folder))}
    held_out = {i: __import__("zlib").crc32(str(i).encode()) % 4 == 2 for i, _, _ in planted}
    languages, distances, furthest = plain_model([(t, lang) for i, t, lang in planted if not held_out[i]])
    assert got.keys() == held_out.keys()
    for i, t, _ in planted:
        row = got[i]
        assert row["held_out"] == held_out[i]
        if not li._LETTER.search(t or ""):
            assert (row["lang_pred"], row["score"], row["accepted"]) == (li.UNKNOWN, 0.0, False)
            continue
        counts = li.counted([t])
        nearest = distances(counts)[0]
        best = int(nearest.argmin())
        assert row["lang_pred"] == languages[best]
        assert row["score"] == pytest.approx(min(max(1 - nearest[best], 0), 1), abs=1e-5)
        limit = furthest[best, li.length_class(counts)[0]]
        if abs(nearest[best] - limit) > 1e-4:
            assert row["accepted"] == (nearest[best] <= limit)
    assert not any(got[i]["accepted"] for i in range(960, 964)) and sum(r["accepted"] for r in got.values()) > 120


def test_two_hundred_languages_leave_little_with_the_driver(spark):
    names = F.concat(F.lit("l"), (F.col("id") % 200).cast("string"))
    word = F.concat(*(F.substring(F.sha2(F.concat_ws("-", F.col("id") % 200, F.col("id") * k % 9), 256), k, 6) for k in (1, 9)))
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.translate(word, "0123456789", "ghijklmnop")] * 3).alias("text"),
        names.alias("lang"),
    ).unionByName(spark.range(50).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"), F.concat(F.lit("once "), "id").alias("lang")))
    model = li.fit(rows, per_language=20)
    assert len(model.languages) == 200  # labels that occur once are not learnt
    held = model.centers.nbytes + model.idf.nbytes + model.furthest.nbytes
    assert held < 200 * 50_000
    got = li.predict(rows.where("lang not like 'once%'").limit(300), model, NEW)
    assert got.where("lang_pred = lang").count() >= 270


@needs_data
def test_held_out_quality(spark):
    got = {r["doc_id"]: r for r in rows_of(queries.op9_quality_classifier(spark, BIG))}
    assert len(got) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    labels = [r for r in spark.read.parquet(f"{BIG}/labels.parquet").collect() if r.doc_id in got]
    unseen = [r for r in labels if got[r.doc_id]["held_out"]]
    right = sum(got[r.doc_id]["predicted"] == r.quality for r in unseen)
    assert len(unseen) > 50 and right >= 0.95 * len(unseen)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def random_weights(seed=0):
    rng = np.random.default_rng(seed)
    shapes = {"embedding": (qc.SYMBOLS, qc.EMBEDDING), "filters": (qc.WIDTH * qc.EMBEDDING, qc.FILTERS), "bias": (qc.FILTERS,),
              "dense": (qc.FILTERS, qc.HIDDEN), "dense_bias": (qc.HIDDEN,), "out": (qc.HIDDEN, 1), "out_bias": (1,)}
    return {name: rng.standard_normal(shape).astype(np.float32) for name, shape in shapes.items()}


def test_all_chunks_of_the_whole_text_count(monkeypatch):
    monkeypatch.setattr(qc, "PIECE", 64)
    weights, rng = random_weights(), np.random.default_rng(1)
    texts = [rng.integers(0, 256, n, np.uint8).tobytes() for n in (0, 1, 7, 8, 9, 16, 17, 63, 64, 65, 200, 1000)]
    texts += [b"so so so " * n for n in (1, 9, 60)]

    def plain(text):
        count = max(1, -(-len(text) // qc.STRIDE))
        data = np.full((count + 1) * qc.STRIDE, qc.PADDING)
        data[: len(text)] = qc.symbols_of(text)
        chunks = np.array([data[i * qc.STRIDE : i * qc.STRIDE + qc.WIDTH] for i in range(count)])
        return qc._responses(weights, qc._embedded(weights, chunks)).max(axis=0)

    assert qc.pooled_of(weights, texts) == pytest.approx(np.array([plain(t) for t in texts]), abs=1e-4)


@pytest.mark.parametrize("text", [b"", b"abc", b"aaaa", b"Ber Ber Ber Ber", b"the theme then", bytes(range(256)) * 2])
def test_symbols_mark_repetitions(text):
    def repeats(i):
        last = text[i - 3 : i + 1]
        return i >= 3 and any(text[i - 3 - k : i + 1 - k] == last for k in range(2, qc.REACH + 1) if i - 3 - k >= 0)

    expected = [b + 257 * repeats(i) for i, b in enumerate(text)]
    assert qc.symbols_of(text).tolist() == (expected if len(text) >= 6 else list(text))


def test_training_follows_the_gradient():
    words = ["".join(w) for w in np.random.default_rng(3).choice(list("abcdefgh"), (400, 6))]
    texts = [" ".join(words[i : i + 9]) for i in range(200)]
    texts += [" ".join(w + "#%&"[i % 3] * 3 for w in words[i : i + 9]) for i in range(200)]
    chunks = [qc.chunks_of(qc.padded_symbols(t.encode())) for t in texts]
    weights = qc.train(chunks, np.repeat([1.0, 0.0], 200))
    new = words[300:309]
    score = qc.score(weights, [" ".join(new).encode(), " ".join(w + "###" for w in new).encode()])
    assert score[0] > 0.7 > 0.3 > score[1]


def test_training_sees_every_chunk(monkeypatch):
    rng = np.random.default_rng(4)
    weights = random_weights(2)
    text = rng.integers(0, 256, 30_000, np.uint8).tobytes()
    chunks = qc.chunks_of(qc.padded_symbols(text))
    assert len(chunks) == -(-len(text) // qc.STRIDE)
    whole = qc._responses(weights, qc._embedded(weights, chunks))
    monkeypatch.setattr(qc, "PIECE", 1000)  # many pieces
    winners, largest = qc._largest(weights, chunks)
    assert largest == pytest.approx(whole.max(axis=0), rel=1e-5)
    assert largest == pytest.approx(qc.pooled_of(weights, [text])[0], rel=1e-4)
    assert (winners == chunks[whole.argmax(axis=0)]).all()


def test_sample_is_bounded_by_rows_and_bytes(spark, monkeypatch):
    learnt = []
    monkeypatch.setattr(qc, "train", lambda chunks, labels: learnt.append((len(chunks), sum(map(len, chunks)))))
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 40).alias("text"))
    labels = rows.select("doc_id", F.lit(1).alias("quality"))
    for options in ({}, {"sample": 50}, {"sample_bytes": 200 * 30}):
        qc.fit(rows, labels, **options)
    assert [n for n, _ in learnt] == [400, 50, 30] and all(size == 25 * n for n, size in learnt)


@needs_data
def test_whole_quality_query_on_one_machine(spark):
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        if r.quality is not None and __import__("zlib").crc32(str(r.doc_id).encode()) % 5:
            labels[r.doc_id] = min(r.quality, labels.get(r.doc_id, 9))
    order = {r.doc_id: r.hash for r in spark.createDataFrame([(i,) for i in labels], "doc_id long").select("doc_id", F.xxhash64("doc_id").alias("hash")).collect()}
    learnt = [i for i in labels if documents.get(i) is not None]
    learnt.sort(key=lambda i: (order[i], qc.padded_symbols(documents[i].encode()).tobytes()))
    chunks = [qc.chunks_of(qc.padded_symbols(documents[i].encode())) for i in learnt]
    weights = qc.train(chunks, np.array([float(labels[i]) for i in learnt]))

    def plain(text):  # one chunk after the other
        pieces = qc.chunks_of(qc.padded_symbols((text or "").encode()))
        pooled = np.max([qc._responses(weights, qc._embedded(weights, piece[None]))[0] for piece in pieces], axis=0)
        hidden = np.maximum(pooled @ weights["dense"] + weights["dense_bias"], 0)
        return 1 / (1 + np.exp(-float(hidden @ weights["out"][:, 0] + weights["out_bias"][0])))

    got = {r["doc_id"]: r for r in rows_of(queries.op9_quality_classifier(spark, SF))}
    assert got.keys() == documents.keys()
    for i, text in documents.items():
        expected = plain(text)
        assert got[i]["score"] == pytest.approx(expected, abs=1e-3)
        if abs(expected - 0.3) > 1e-3:
            assert got[i]["predicted"] == (expected >= 0.3)


def test_quality_of_awkward_rows(spark):
    frame = awkward(spark)
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (6, None), (None, 1), (99, 0)], "doc_id long, quality int")
    weights = qc.fit(frame, labels)
    rows = qc.classify(frame, weights).collect()
    assert len(rows) == 8 and len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert qc.classify(empty(frame), weights).collect() == []
    assert qc.fit(frame, labels.limit(0)) is None
    assert {r.score for r in qc.classify(frame, None).collect()} == {0.5}
    assert qc.fit(frame.where(F.col("text").isNull()), labels) is None
