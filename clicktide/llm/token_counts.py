"""Token counts of a sentencepiece BPE model, whole tokens by look-up.

Offline, from the model file alone, three things are proved. First, its normaliser has an
empty character map and only writes blanks as the word mark U+2581, with one before the
text, so words reach the merges as they are. Second, no piece has the mark behind another
character, so no merge crosses the start of a word and a text's count is the sum over its
words, each with the blanks before it. Third, which vocabulary strings come back as that one
token when encoded alone; these words count 1 at a look-up. Only other words are merged by
the library, each distinct one once while it is remembered. A model without the first two
properties is encoded text by text.

Nulls and empty texts have no tokens. Equal rows are counted each, and alike. Texts of any
length are counted whole. An empty table gives no rows. The mark itself in a text is the
same to the model as a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from sentencepiece.sentencepiece_model_pb2 import ModelProto

from clicktide.llm.common import few_rows_a_batch, small_batches

MARK = "▁"
MEMO_ENTRIES = 300_000


def keeps_words(model: ModelProto) -> bool:
    """Whether the model's normaliser changes no character but blanks, each into a mark."""
    spec = model.normalizer_spec
    return (
        not spec.precompiled_charsmap
        and spec.add_dummy_prefix
        and spec.escape_whitespaces
        and not spec.remove_extra_whitespaces
        and not model.trainer_spec.treat_whitespace_as_suffix
    )


class PieceCounter:
    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [
            self.model.id_to_piece(i)
            for i in range(size)
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))
        ]
        proto = ModelProto.FromString(self.model.serialized_model_proto())
        self.by_word = keeps_words(proto) and all(MARK not in piece.lstrip(MARK) for piece in pieces)
        words = [p[1:] for p in pieces if p[0] == MARK and len(p) > 1 and p[1] != MARK]
        encoded = self.model.encode(words, num_threads=1)
        self.whole = {word: 1 for word, ids in zip(words, encoded, strict=True) if len(ids) == 1}
        self.memo = dict(self.whole)
        self.words_after_blanks = re.compile(f"{MARK}+[^{MARK}]*")

    def merge_new(self, words: list[str]) -> None:
        if len(self.memo) + len(words) > MEMO_ENTRIES:
            self.memo = dict(self.whole)
        counts = map(len, self.model.encode(words, num_threads=1))
        self.memo.update(zip(words, counts, strict=True))

    def blanks(self, n: int) -> int:
        """Tokens of n marks at the end of a text: none of them joins what is before."""
        return len(self.model.encode("a" + " " * n)) - len(self.model.encode("a"))

    def count_spaced(self, text: str) -> int:
        """Of a text with runs of blanks, or blanks at an end: the mark before a word is in
        the word's own encoding, as the model puts one before every text."""
        total = 0
        for unit in self.words_after_blanks.findall(MARK + text.replace(" ", MARK)):
            word = unit.lstrip(MARK)
            marks = len(unit) - len(word)
            total += len(self.model.encode(" " * (marks - 1) + word)) if word else self.blanks(marks)
        return total

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_word:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        split = [text.replace(MARK, " ").split(" ") if text else [] for text in texts]
        plain = ["" not in words for words in split]
        met = set().union(*(words for words, is_plain in zip(split, plain, strict=True) if is_plain))
        if new := [word for word in met if word not in self.memo]:
            self.merge_new(new)
        memo, counts = self.memo, []
        for text, words, is_plain in zip(texts, split, plain, strict=True):
            if not is_plain:
                counts.append(self.count_spaced(text))
                continue
            try:
                counts.append(sum(map(memo.__getitem__, words)))
            except KeyError:  # forgotten meanwhile
                counts.append(len(self.model.encode(text)))
        return counts


@lru_cache(maxsize=2)
def counter_of(path: str) -> PieceCounter:
    """Built once for each Python worker; the file is there on every machine."""
    return PieceCounter(path)


def token_counts(texts: DataFrame, model_path: str, key: str = "doc_id") -> DataFrame:
    """Of each row the key, ``n_bytes`` (UTF-8) and ``n_tokens``; other columns are not read."""

    few_rows_a_batch(texts.sparkSession)

    def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model_path)
        for batch in small_batches(batches, "text"):
            counts = counter.count([text or "" for text in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                ["key", "n_bytes", "n_tokens"],
            )
        counter.memo = dict(counter.whole)  # a worker goes on to other tasks, maybe of other kinds

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = texts.select(F.col(key).alias("key"), size.alias("n_bytes"), "text")
    key_type = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        count_rows, f"key {key_type}, n_bytes long, n_tokens long"
    ).withColumnRenamed("key", key)
