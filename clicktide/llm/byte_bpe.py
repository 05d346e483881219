"""Byte-level BPE, encoded in time linear in the text, and decoded again.

Tokens and text are bytes, written as Latin-1 so that an Aho-Corasick automaton over
strings finds every token that starts at a position. Encoding takes the longest one,
and goes back where two neighbours could not stand side by side in a merge result: a
token sequence is the merge result if and only if every adjacent pair is, so a memo of
pairs decides each step without merging the whole piece.

Nulls and empty texts give no ids and no bytes. Equal rows are encoded each, and alike; a
text has one encoding, so there are no ties. Texts of any length are encoded whole, in time
linear in it. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from clicktide.llm.common import few_rows_a_batch, small_batches

# Of the memos of one worker; beyond it they forget, which costs time only.
MEMO_ENTRIES = 300_000
MEMO_CHARS = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class PieceMemo(dict):
    """Of pieces met before, their ids as the bytes of 32-bit numbers.

    When full, it starts anew but still knows what it held before, until the next time.
    """

    def __init__(self, encode_piece):
        super().__init__()
        self.encode_piece = encode_piece
        self.before: dict[str, bytes] = {}

    def forget(self) -> None:
        self.clear()
        self.before = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = array("i", self.encode_piece(piece.encode("utf-8", "surrogatepass"))).tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_ENTRIES:
                self.before = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class BytePairEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"no token for the bytes {missing[:5]}")
        self.ranks = ranks
        self.pieces = regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.length_of = {rank: len(token) for token, rank in ranks.items()}
        self.id_of = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.id_of.items():
            self.automaton.add_word(token, rank)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo = PieceMemo(self.encode_piece)

    def merged(self, piece: bytes) -> list[int]:
        """Merges by rank, the definition; used on pairs of tokens only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(
                range(len(parts) - 1),
                key=lambda i: self.ranks.get(parts[i] + parts[i + 1], float("inf")),
            )
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[part] for part in parts]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_ENTRIES:
                self.pairs.clear()
            both = self.bytes_of[left] + self.bytes_of[right]
            known = self.pairs[left, right] = self.merged(both) == [left, right]
        return known

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        if (whole := self.ranks.get(piece)) is not None:
            return (whole,)
        text = piece.decode("latin-1")
        longest = [rank for _, rank in self.automaton.iter_long(text)]
        if sum(map(self.length_of.__getitem__, longest)) == len(text) and all(
            map(self.compatible, longest, longest[1:])
        ):
            return tuple(longest)
        return self.backtrack(text)

    def backtrack(self, text: str) -> tuple[int, ...]:
        """Longest tokens first, shorter ones where neighbours are not compatible."""
        lengths: list[list[int]] = [[] for _ in text]  # of the tokens from each position, rising
        for end, rank in self.automaton.iter(text):
            length = self.length_of[rank]
            lengths[end + 1 - length].append(length)
        id_of, compatible, n = self.id_of, self.compatible, len(text)
        dead = bytearray(n + 1)  # positions from which no valid rest was found
        tokens: list[int] = []
        choice: list[int] = []  # of each token, its place in the lengths at its start
        at, k = 0, len(lengths[0]) - 1
        while at < n:
            options = lengths[at]
            while k >= 0:
                end = at + options[k]
                if not dead[end]:
                    token = id_of[text[at:end]]
                    if not tokens or compatible(tokens[-1], token):
                        break
                k -= 1
            if k >= 0:
                tokens.append(token)
                choice.append(k)
                at = end
                k = len(lengths[at]) - 1 if at < n else 0
            else:
                dead[at] = 1
                at -= self.length_of[tokens.pop()]
                k = choice.pop() - 1
        return tuple(tokens)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(
            b"".join(map(self.memo.__getitem__, self.pieces.findall(text))), np.int32
        )

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str) -> BytePairEncoder:
    """Built once for each Python worker; the file is there on every machine."""
    return BytePairEncoder(read_ranks(path), pattern)


def encode_decode(texts: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """Of each row the key, ``ids`` (array<int>) and the bytes that the ids decode to.

    Only the key and ``text`` are read, so other columns may have any name.
    """

    few_rows_a_batch(texts.sparkSession)

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(ranks_path, pattern)
        for batch in small_batches(batches, "text", 1 << 20):
            ids = [encoder.encode(text or "") for text in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))),
                    pa.array(map(encoder.decode, ids), pa.binary()),
                ],
                ["key", "ids", "decoded"],
            )
        encoder.memo.forget()  # a worker goes on to other tasks, maybe of other kinds

    rows = texts.select(F.col(key).alias("key"), "text")
    key_type = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        encode_rows, f"key {key_type}, ids array<int>, decoded binary"
    ).withColumnRenamed("key", key)
