"""Base measures against plain counting; cutoffs against exact quantiles of small groups."""

import re
from collections import Counter

import numpy as np
import pytest

from clicktide.llm import quality_rules as qr, queries
from tests.llm.helpers import DOCUMENTS, SF, awkward, documents_of, empty, needs_data, random_texts, rows_of


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def check(got, texts):
    assert len(got) == len(texts)
    for r in got:
        expected = measures(texts[r["doc_id"]])
        assert {k: r[k] for k in expected} == expected
        failed = expected["n_words"] < 10 or 100 * expected["n_repeat_words"] > 20 * expected["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_random_texts(spark):
    words = ["a ", "b ", "c", "a b c d e f ", "\n", "#", "x|y ", " ", "\t", "é ", "\x0b", " ", "a b\n", "<>"]
    texts = random_texts(2500, words, 40) + ["w " * 5, "w " * 6, "1 2 3 4 5 1 2 3 4 5", "a\n\n a\na\r\na"]
    check(rows_of(qr.quality_rules(documents_of(spark, texts))), dict(enumerate(texts)))


def test_long_repetitions(spark):
    texts = ["same words again and " * 5000, " ".join(f"w{i}" for i in range(30_000)), "line\n" * 20_000]
    check(rows_of(qr.quality_rules(documents_of(spark, texts))), dict(enumerate(texts)))


@needs_data
def test_whole_table(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = rows_of(queries.op2_quality_rules(spark, SF))
    check(got, {r.doc_id: r.text for r in documents})
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r for r in got if quality.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert all(r["kept"] for r in good) and len(good) > 40


def group(n, symbols, source, start, lang="en"):
    """Sound texts of 20 words, each with so many symbols; all words differ."""
    return [
        (start + i, " ".join(f"w{start + i}x{k}" for k in range(20)) + " " + "#" * symbols(i), lang, source, 1)
        for i in range(n)
    ]


def test_cutoffs_follow_the_group(spark, monkeypatch):
    monkeypatch.setattr(qr, "MIN_GROUP", 30)
    plain = group(60, lambda i: 0, "plain", 0)
    wild = group(60, lambda i: 30 + i % 40, "wild", 100)
    odd = group(1, lambda i: 60, "plain", 500) + group(1, lambda i: 60, "wild", 501)
    few = group(3, lambda i: 60, "few", 510)  # judged by its language
    docs = spark.createDataFrame(plain + wild + odd + few, DOCUMENTS)
    kept = {r["doc_id"]: r["kept"] for r in rows_of(qr.quality_rules(docs))}
    assert all(kept[r[0]] for r in plain + wild + few) and not kept[500] and kept[501]


def test_cutoffs_are_widened_quartiles(spark):
    rows = group(200, lambda i: i % 50, "s", 0)
    rates = qr.with_rates(qr.measured(spark.createDataFrame(rows, DOCUMENTS)))
    cut = qr.cutoffs(rates).first()
    values = np.sort([r.symbols_per_char for r in rates.collect()])
    low, high = values[49], values[149]
    assert cut.high_symbols_per_char == pytest.approx(high + qr.SPREADS * max(high - low, 0.02), rel=0.1)


def test_sketches_merge(spark):
    """Thresholds do not depend on how the rows are dealt out."""
    docs = spark.createDataFrame(group(150, lambda i: i % 9, "s", 0), DOCUMENTS)
    cuts = [qr.cutoffs(qr.with_rates(qr.measured(d))).first() for d in (docs.coalesce(1), docs.repartition(16))]
    assert cuts[0] == cuts[1]


def test_awkward_rows(spark):
    rows = qr.quality_rules(awkward(spark)).collect()
    assert len(rows) == 8
    assert {(r.n_words, r.base_failed, r.kept) for r in rows if r.doc_id in (1, 2, 3)} == {(0, True, False)}
    assert len({r.kept for r in rows if r.doc_id == 5}) == 1
    assert qr.quality_rules(empty(awkward(spark))).collect() == []
