"""Benchmark items in training texts: BM25 retrieval of items by every passage, then a check.

Each text is read in passages that overlap by half and are twice as long as the longest
item, so that every item lies whole in one. A passage is a query, its distinct words the
terms, against an inverted index of the items. Weights are BM25's, divided by the item's
score for itself: 1 is an item with all its words in the passage. Every item with
``THRESHOLD`` or more is retrieved.

Block-max WAND: items stand in blocks of ``BLOCK_ITEMS``, alike in language and length. A
term has its largest weight of all, and of each block in which it occurs. A passage whose
terms' largest weights don't sum to the threshold is done. Else its terms are ordered by
them; the pivot is where their sum reaches the threshold, and an item must have a term from
the pivot on. Only blocks of those terms are bounded, first with the other terms' largest
weights, then with all block maxima; only blocks that still reach the threshold are opened.
No item at or above the threshold is lost.

A retrieved item is verified in the passage: of its question (all sentences but the last)
and of its answer (the last one) the share of word trigrams that the passage has.

The index is made by tasks, in slices of about ``SLICE_WORDS`` item words (a longer item is a
slice alone), each a row in a file of its own in the shared folder. Spark hands the files to
the executors (``SparkContext.addFile``); one Python stage searches a few texts in one slice
after the other. The driver holds the names of the files, a worker up to ``SLICES_HELD``
slices. Term statistics are those of all items.

Null and empty texts have no passages and no hits. Items without words match nothing; items
with a null id or repeated ids are searched each, equal items once. Words are lower-cased,
and ASCII signs separate them. Without items nothing is found. Repeated rows get the same
hits each; hits of equal score keep the order of the index. Texts of any length are read whole.
"""

from __future__ import annotations

import math
import re
from collections import OrderedDict, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F, types as T

from clicktide.llm.common import few_rows_a_batch, joined_to_totals, small_batches, written
from clicktide.session import shared_folder
from clicktide.sources.files import data_files

THRESHOLD = 0.5
K1, B = 1.2, 0.75
BLOCK_ITEMS = 4
LEAST_PASSAGE = 128  # words
SLICE_WORDS = 40_000
SLICES_HELD = 4
TEXT_BYTES = 2 << 20  # of texts that are searched in one slice after the other
PAIRS_HELD = 1 << 19  # terms in blocks that are summed at once
QUESTION_SHARE, ANSWER_SHARE, WHOLE_SHARE = 0.5, 0.3, 0.7

_SIGNS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+|\n+")

HIT = T.StructType().add("item", "long").add("score", "double").add("question", "double").add(
    "answer", "double"
).add("contaminated", "boolean")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SIGNS).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of all sentences but the last, and of the last; of one sentence its last third."""
    sentences = [w for s in _SENTENCE_END.split(text) if (w := words_of(s))]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def _trigrams(words: list[bytes]) -> set[tuple[bytes, ...]]:
    size = min(3, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def _share(part: list[bytes], passage: list[bytes]) -> float:
    """Of the part's trigrams, or of all its words if it has fewer, how many the passage has."""
    wanted = _trigrams(part)
    if not wanted:
        return 1.0
    size = len(next(iter(wanted)))
    have = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
    return len(wanted & have) / len(wanted)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of some ranges one after the other, and which range each is of."""
    sizes = ends - starts
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes), of


class Index:
    """BM25 weights of a slice of the items, with block maxima where a term occurs."""

    def __init__(self, items: list[tuple[int, str]], weights: list[dict[bytes, float]], longest: int):
        order = sorted(range(len(items)), key=lambda i: (max(weights[i], key=lambda w: -weights[i][w]), len(weights[i])))
        number: dict[bytes, int] = {}
        posted = [
            (number.setdefault(word, len(number)), place, weight / sum(weights[i].values()))
            for place, i in enumerate(order)
            for word, weight in weights[i].items()
        ]
        posted.sort()
        terms, places, shares = zip(*posted) if posted else ((), (), ())
        self._set(
            [items[i] for i in order], longest, list(number), np.array(terms, np.int64),
            np.array(places, np.int64), np.array(shares, np.float64),
        )

    def _set(self, items, longest, words, terms, places, shares) -> None:
        self.items, self.longest, self.words = items, longest, words
        self.terms, self.places, self.shares = terms, places, shares  # of the postings, in order
        self.passage = max(LEAST_PASSAGE, 2 * longest)
        self.number = {word: term for term, word in enumerate(words)}
        self.blocks = max(1, -(-len(items) // BLOCK_ITEMS))
        # an entry is a term in a block: its key, its postings and their largest weight
        of_posting = terms * self.blocks + places // BLOCK_ITEMS
        self.keys, self.first = np.unique(of_posting, return_index=True)
        self.first = np.r_[self.first, len(terms)]
        self.maxima = np.maximum.reduceat(shares, self.first[:-1]) if len(terms) else shares
        self.entries = np.searchsorted(self.keys, np.arange(len(words) + 1) * self.blocks)
        self.largest = np.maximum.reduceat(self.maxima, self.entries[:-1]) if len(words) else shares
        self.parts = [question_and_answer(text) for _, text in items]

    def row(self) -> dict:
        """The index as a row of ``_SLICE``."""
        return {
            "items": [{"item": item, "text": text} for item, text in self.items], "longest": self.longest,
            "words": self.words, "terms": self.terms.astype(np.int32).tobytes(),
            "places": self.places.astype(np.int32).tobytes(), "shares": self.shares.tobytes(),
        }

    @classmethod
    def of_row(cls, row: dict) -> Index:
        index = cls.__new__(cls)
        index._set(
            [(item["item"], item["text"]) for item in row["items"]], row["longest"], row["words"],
            np.frombuffer(row["terms"], np.int32).astype(np.int64),
            np.frombuffer(row["places"], np.int32).astype(np.int64), np.frombuffer(row["shares"], np.float64),
        )
        return index

    def passages(self, lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passages by number and their distinct known terms, and each text's first passage number.

        Half passages are numbered over all texts; a passage is two of them in a row.
        """
        terms = [np.fromiter(map(self.number.get, w, repeat(-1)), np.int64, len(w)) for w in lists]
        lengths = np.array([len(t) for t in terms], np.int64)
        every = np.concatenate(terms) if terms else np.zeros(0, np.int64)
        step = self.passage // 2
        halves = np.maximum(1, -(-lengths // step))
        first_half = np.cumsum(halves) - halves
        half = np.repeat(first_half, lengths) + _ranges(np.zeros_like(lengths), lengths)[0] // step
        starts_text = np.zeros(int(halves.sum()) + 1, bool)
        starts_text[first_half] = True
        known = every >= 0
        half, every = half[known], every[known]
        size = max(1, len(self.words))
        into_previous = ~starts_text[half]
        pairs = np.concatenate([half * size + every, (half[into_previous] - 1) * size + every[into_previous]])
        pairs.sort()
        pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
        return pairs // size, pairs % size, first_half

    def open_blocks(self, passage: np.ndarray, term: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Passages, as ranges of the terms, and blocks whose maxima reach the threshold together."""
        least = THRESHOLD - 1e-9
        starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]]) if len(passage) else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], len(passage)].astype(np.int64)
        if not len(starts):
            return
        hopeful = np.add.reduceat(self.largest[term], starts) >= least
        starts, ends = starts[hopeful], ends[hopeful]
        inside, of = _ranges(starts, ends)
        # of each passage the terms by rising weight; from the pivot on their sum reaches the threshold
        by_weight = np.lexsort((self.largest[term[inside]], of))
        inside = inside[by_weight]
        weight = self.largest[term[inside]]
        upto = np.cumsum(weight)
        before = np.r_[0.0, upto][np.searchsorted(of, np.arange(len(starts)))]
        upto = upto - before[of]
        essential = upto >= least
        others = np.zeros(len(starts))
        np.add.at(others, of[~essential], weight[~essential])
        cuts = np.searchsorted(of, np.arange(len(starts) + 1))  # passages keep together
        pivots = cuts[:-1] + np.bincount(of[~essential], minlength=len(starts))
        first, last = (self.entries[term[inside] + k] for k in (0, 1))
        ahead = np.r_[0, np.cumsum(last - first)]

        def summed(terms: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
            """Block maxima of these terms, summed per passage and block."""
            entries, which = _ranges(first[terms], last[terms])
            pair = owner[which] * self.blocks + self.keys[entries] % self.blocks
            return np.bincount(pair, self.maxima[entries], rows * self.blocks)

        at = 0
        while at < len(starts):
            to = int(np.searchsorted(ahead[cuts], ahead[cuts[at]] + PAIRS_HELD, side="right")) - 1
            to = min(max(to, at + 1), at + max(1, PAIRS_HELD // self.blocks), len(starts))
            rows = np.arange(at, to)
            leading, owner = _ranges(pivots[rows], cuts[rows + 1])
            bound = summed(leading, owner, to - at)
            left = np.flatnonzero((bound > 0) & (bound + np.repeat(others[rows], self.blocks) >= least))
            trailing, owner = _ranges(cuts[rows], pivots[rows])
            if len(left) * len(trailing) < (last - first)[trailing].sum() * (to - at):
                # few blocks are left: look the other terms up there
                mine, of_pair = _ranges(cuts[rows][left // self.blocks], pivots[rows][left // self.blocks])
                entry = self._entry(term[inside[mine]], (left % self.blocks)[of_pair])
                bound[left] += np.bincount(of_pair, np.r_[self.maxima, 0.0][entry], len(left))
            else:
                bound += summed(trailing, owner, to - at)
            found = left[bound[left] >= least]
            row, block = rows[found // self.blocks], found % self.blocks
            mine, of_pair = _ranges(starts[row], ends[row])
            entry = self._entry(term[mine], block[of_pair])
            there = entry < len(self.keys)
            yield passage[starts[row]], block, entry[there], of_pair[there]
            at = to

    def _entry(self, term: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The entries of terms in blocks; one behind the last where a term is not in the block."""
        key = term * self.blocks + block
        entry = np.searchsorted(self.keys, key)
        there = entry < len(self.keys)
        there[there] = self.keys[entry[there]] == key[there]
        return np.where(there, entry, len(self.keys))

    def retrieved(self, lists: list[list[bytes]]) -> Iterator[tuple[int, int, int, float]]:
        """Text, first word of the passage, place of the item, and score at or above the threshold."""
        passage, term, first_half = self.passages(lists)
        for of_passage, block, entry, pair in self.open_blocks(passage, term):
            posted, which = _ranges(self.first[entry], self.first[entry + 1])
            slot = pair[which] * BLOCK_ITEMS + self.places[posted] % BLOCK_ITEMS
            scores = np.bincount(slot, self.shares[posted], len(block) * BLOCK_ITEMS)
            for found in np.flatnonzero(scores >= THRESHOLD - 1e-9):
                number = of_passage[found // BLOCK_ITEMS]
                text = int(np.searchsorted(first_half, number, side="right")) - 1
                place = int(block[found // BLOCK_ITEMS]) * BLOCK_ITEMS + int(found % BLOCK_ITEMS)
                yield text, int(number - first_half[text]) * (self.passage // 2), place, float(scores[found])

    def hits(self, lists: list[list[bytes]]) -> list[list[dict]]:
        """Of each text's words the retrieved items, each with its best passage."""
        found: list[dict[int, dict]] = [{} for _ in lists]
        for text, first, place, score in self.retrieved(lists):
            passage = lists[text][first : first + self.passage]
            question, answer = (_share(part, passage) for part in self.parts[place])
            whole = _share([*self.parts[place][0], *self.parts[place][1]], passage)
            sure = (question >= QUESTION_SHARE and answer >= ANSWER_SHARE) or whole >= WHOLE_SHARE
            hit = {"item": self.items[place][0], "score": float(score), "question": question,
                   "answer": answer, "contaminated": sure}
            known = found[text].get(place)
            if known is None or (sure, score, question, answer) > (
                known["contaminated"], known["score"], known["question"], known["answer"]
            ):
                found[text][place] = hit
        return [[hits[place] for place in sorted(hits)] for hits in found]


def bm25_weights(
    words: list[bytes], classes: dict[bytes, int], items: int, mean_length: float
) -> dict[bytes, float]:
    weights = {}
    counts: dict[bytes, int] = defaultdict(int)
    for word in words:
        counts[word] += 1
    for word, tf in counts.items():
        idf = math.log(1 + (items - classes[word] + 0.5) / (classes[word] + 0.5))
        weights[word] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_length))
    return weights


def _weighted(items: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Distinct items with words: id, text, words, their document frequencies, length and slice;
    and the number of slices."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            words = [words_of(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([sorted(set(w)) for w in words], pa.list_(pa.binary())),
                 pa.array(map(len, words), pa.int64())],
                ["item", "text", "words", "length"],
            )

    rows = items.select(F.col(key).cast("long").alias("item"), "text").where(F.col("text").isNotNull())
    layout = "item long, text string, words array<binary>, length long"
    split_rows = written(rows.distinct().mapInArrow(split, layout).where("length > 0"), "benchmark-items")
    total = split_rows.agg(F.sum("length")).first()[0] or 0
    slices = max(1, -(-total // (SLICE_WORDS // 2)))
    row = F.xxhash64("item", "text").alias("row")
    words = split_rows.select("item", "text", "length", row, F.explode("words").alias("word"))
    frequency = written(words.groupBy("word").agg(F.count("*").alias("of")), "benchmark-words")
    weighted = (
        joined_to_totals(words, frequency, ["word"], "of")
        .groupBy("item", "text", "length", "row")
        .agg(F.collect_list("word").alias("words"), F.collect_list("of").alias("of"))
    )
    return written(weighted.withColumn("slice", F.pmod("row", F.lit(slices))), "benchmark-weights"), slices


_SLICE = pa.schema([
    ("items", pa.list_(pa.struct([("item", pa.int64()), ("text", pa.string())]))), ("longest", pa.int64()),
    ("words", pa.list_(pa.binary())), ("terms", pa.binary()), ("places", pa.binary()), ("shares", pa.binary()),
])
_SLICE_LAYOUT = (
    "items array<struct<item: long, text: string>>, longest long, words array<binary>, terms binary, "
    "places binary, shares binary"
)


def _index(rows: list[dict], items: int, mean_length: float, longest: int) -> Index:
    weights = [
        bm25_weights(words_of(r["text"]), dict(zip(r["words"], r["of"], strict=True)), items, mean_length)
        for r in rows
    ]
    return Index([(r["item"], r["text"]) for r in rows], weights, longest)


def index_files(items: DataFrame, key: str = "item_id") -> list[str]:
    """Names of the files, a slice of the index in each, that every task can ask ``SparkFiles`` for."""
    spark = items.sparkSession
    weighted, slices = _weighted(items, key)
    n, total, longest = weighted.agg(F.count("*"), F.sum("length"), F.max("length")).first()
    if not n:
        return []

    def build(table: pa.Table) -> pa.Table:
        made, rows, held = [], [], 0
        for row in sorted(table.to_pylist(), key=lambda r: (r["row"], r["item"] is None, r["item"])):
            if rows and held + row["length"] > SLICE_WORDS:
                made.append(_index(rows, n, total / n, longest).row())
                rows, held = [], 0
            rows.append(row)
            held += row["length"]
        made.append(_index(rows, n, total / n, longest).row())
        return pa.Table.from_pylist(made, schema=_SLICE)

    folder = shared_folder(spark, "benchmark-slices")
    built = weighted.groupBy("slice").applyInArrow(build, _SLICE_LAYOUT)
    built.write.option("maxRecordsPerFile", 1).parquet(folder)
    names = sorted(data_files(spark, folder))
    for name in names:
        spark.sparkContext.addFile(f"{folder}/{name}")
    return names


_HELD: OrderedDict[str, Index | None] = OrderedDict()


def _slice(name: str) -> Index | None:
    """A slice of the index, kept until others were used since; None for a file without one."""
    if name not in _HELD:
        while len(_HELD) >= SLICES_HELD:
            _HELD.popitem(last=False)
        rows = pq.read_table(SparkFiles.get(name)).to_pylist()
        _HELD[name] = Index.of_row(rows[0]) if rows else None
    _HELD.move_to_end(name)
    return _HELD[name]


def find_items(texts: DataFrame, items: DataFrame, item_key: str = "item_id", into: str = "hits") -> DataFrame:
    """All columns and ``hits``: item, score, shares of question and answer, and the verdict.

    ``into`` replaces a column of that name. Hits come in the order of the index.
    """
    few_rows_a_batch(texts.sparkSession)
    texts = texts.drop(into)
    columns = texts.columns
    names = index_files(items, item_key)
    hits_type = pa.list_(pa.struct([
        ("item", pa.int64()), ("score", pa.float64()), ("question", pa.float64()),
        ("answer", pa.float64()), ("contaminated", pa.bool_()),
    ]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", TEXT_BYTES):
            lists = [words_of(t or "") for t in batch.column(columns.index("text")).to_pylist()]
            found: list[list[dict]] = [[] for _ in lists]
            for name in names:
                if (index := _slice(name)) is not None:
                    for hits, new in zip(found, index.hits(lists), strict=True):
                        hits += new
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, hits_type)], [*columns, into])

    layout = T.StructType([*texts.schema.fields, T.StructField(into, T.ArrayType(HIT))])
    return texts.mapInArrow(search, layout)


def contaminated(hits: str = "hits"):
    """Whether one of the hits was verified."""
    return F.exists(hits, lambda hit: hit["contaminated"])
