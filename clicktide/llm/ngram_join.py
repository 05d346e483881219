"""Groups of near copies: an exact Jaccard join on word n-grams by vertical partitioning.

A text's set is its distinct five-word n-grams (lower-cased A-Z, words between ASCII blanks),
hashed to 64 bits; a text of fewer words has its whole sequence as one. Two sets link when
their Jaccard similarity is at least ``THRESHOLD_PERCENT``; a group is what links connect.

1. The n-gram order is cut into fragments. Every block of texts sends each set's segment
   of a fragment there, n-grams that the block itself has twice only once. A fragment finds
   the n-grams that occur elsewhere and counts them per set; these partial counts are summed
   per set. A set with fewer shared n-grams than the threshold asks of it has no link, and
   leaves here. This is the only step on all n-grams.
2. Equal sets become one class. The global order is by frequency among the classes left,
   rarest first. Linked classes share an n-gram in the head of their orders, so the classes
   with a common head n-gram are candidates of each other. Buckets with the same smallest
   class are one group.
3. A group's sets are spread over cells: pairs of parts of the group, of bounded size. In a
   cell the overlaps of all its pairs are counted fragment by fragment and summed per pair;
   only a spanning forest of the links leaves it. A group of one part is a single cell. In
   larger ones each part, with the smallest class, is done first; then only classes outside
   the group's largest component meet the other parts.
4. Components over the links, then the smallest id of each.

Nulls and texts without words have an empty set, link with nothing, and are their own
component. Rows that repeat an id are rows of their own; equal texts are one class. Ids may
be null: they have the component's smallest id, null if it has none. No step is capped.
N-grams and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from clicktide.llm.common import few_rows_a_batch, hash64, small_batches, text_bytes, written
from clicktide.llm.components import components

WORDS = 5
THRESHOLD_PERCENT = 80
FRAGMENT_BYTES = 48 << 20  # of text whose n-grams share a fragment, some 8 million at most
BLOCK_NGRAMS = 1_000_000  # whose repetitions a task finds before it sends them
CELL_NGRAMS, CELL_CLASSES = 500_000, 1_500  # of a part of a group
CELL_FRAGMENTS = 16
FILTER_BITS = 1 << 24

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX2
    return (values ^ (values >> np.uint64(27))) * _MIX


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 150_000:
            self.clear()
        value = self[word] = hash64(word)
        return value


def ngrams_of(text: str, words: WordHashes) -> np.ndarray:
    """The sorted distinct n-gram hashes of a text."""
    split = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(words.__getitem__, split), np.int64, len(split)).view(np.uint64)
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - WORDS + 1)
    size = min(WORDS, len(hashes))
    value = np.full(n, np.uint64(size))
    for i in range(size):
        value = _mixed(value + hashes[i : i + n])
    return np.unique(value)


def _binaries(parts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values: the bytes of consecutive runs of an array."""
    offsets = np.r_[0, ends].astype(np.int32) * parts.itemsize
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(parts))]
    )


# Rows of three kinds: a document's set and size; n-grams of a block for a fragment, as the
# names of sets, how many each has there, and their tails; counts of a bucket of names.
_PROFILE = (
    "fragment long, doc_id {key}, set long, n long, bucket long, names binary, counts binary, tails binary"
)


def _name(grams: np.ndarray) -> int:
    """The set's name, a hash of its n-grams."""
    return hash64(grams.tobytes())


def _rows(schema: pa.Schema, height: int, **columns: pa.Array) -> pa.RecordBatch:
    """A batch with these columns, and nulls in the others."""
    return pa.RecordBatch.from_arrays(
        [columns.get(f.name, pa.nulls(height, f.type)) for f in schema], schema=schema
    )


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and ends of the runs in which all keys are equal."""
    changed = np.zeros(len(keys[0]) - 1, bool)
    for key in keys:
        changed |= key[1:] != key[:-1]
    ends = np.r_[np.flatnonzero(changed) + 1, len(keys[0])]
    return np.r_[0, ends[:-1]], ends


def _bucket_rows(schema: pa.Schema, bits: int, names: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Counts of sets' shared n-grams, a row for each bucket of names."""
    if not len(names):
        return _rows(schema, 0)
    bucket = names & ((4 << bits) - 1)
    order = np.argsort(bucket, kind="stable")
    starts, ends = _runs(bucket[order])
    buckets = bucket[order][starts]
    return _rows(
        schema,
        len(ends),
        fragment=pa.array(-1 - buckets),
        bucket=pa.array(buckets),
        names=_binaries(names[order], ends),
        counts=_binaries(counts[order].astype(np.int32), ends),
    )


def _segments(
    schema: pa.Schema, bits: int, sets: list[np.ndarray], names: list[int]
) -> Iterator[pa.RecordBatch]:
    """A block's n-grams to their fragments; those that it has twice once, and counted here.

    Tails are the 32 bits behind the fragment's own: a rare collision makes a set look
    more shared than it is, which costs time but changes nothing.
    """
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    last = np.r_[first[1:], True]
    alone = np.empty(len(grams), bool)
    alone[order] = first & last
    names = np.array(names, np.int64)
    shared = np.bincount(owner[~alone], minlength=len(sets))
    yield _bucket_rows(schema, bits, names[shared > 0], shared[shared > 0])
    for kept, of in ((grams[alone], owner[alone]), (ordered[first & ~last], None)):
        if not len(kept):
            continue
        fragment = (kept >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(fragment, kind="stable")
        fragment = fragment[order]
        starts, ends = _runs(fragment)
        tail = ((kept[order] << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
        by = {}
        if of is not None:  # of each set in the fragment its name and number of n-grams
            of = of[order]
            set_starts, set_ends = _runs(fragment, of)
            upto = np.searchsorted(set_ends, ends, side="right")
            by["names"] = _binaries(names[of[set_starts]], upto)
            by["counts"] = _binaries((set_ends - set_starts).astype(np.int32), upto)
        yield _rows(
            schema, len(ends), fragment=pa.array(fragment[starts]), tails=_binaries(tail, ends), **by
        )


def _profiled(bits: int):
    """Each row's set and its size, and the segments of the sets."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sets, names, met, held = WordHashes(), [], [], set(), 0
        schema = None
        for batch in small_batches(batches, "text", 1 << 20):
            schema = schema or pa.schema([
                ("fragment", pa.int64()), ("doc_id", batch.schema.field("doc_id").type),
                ("set", pa.int64()), ("n", pa.int64()), ("bucket", pa.int64()),
                ("names", pa.binary()), ("counts", pa.binary()), ("tails", pa.binary()),
            ])
            of_batch, sizes = [], []
            for text in batch.column("text").to_pylist():
                grams = ngrams_of(text or "", words)
                sizes.append(len(grams))
                of_batch.append(_name(grams) if len(grams) else None)
                if len(grams) and of_batch[-1] not in met:
                    met.add(of_batch[-1])
                    sets.append(grams)
                    names.append(of_batch[-1])
                    held += len(grams)
            yield _rows(
                schema,
                batch.num_rows,
                fragment=batch.column("aside"),
                doc_id=batch.column("doc_id"),
                set=pa.array(of_batch, pa.int64()),
                n=pa.array(sizes, pa.int64()),
            )
            if held >= BLOCK_NGRAMS:
                yield from _segments(schema, bits, sets, names)
                sets, names, met, held = [], [], set(), 0
        if sets:
            yield from _segments(schema, bits, sets, names)

    return send


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), kind)


def _shared_in_fragment(bits: int):
    """How many of each set's n-grams in a fragment others have; other rows as they are."""

    def count(table: pa.Table) -> pa.Table:
        if table["fragment"][0].as_py() < 0:
            return table
        named = pc.is_valid(table["names"])
        mine = table.filter(named)
        names, lengths = _joined(mine["names"], np.int64), _joined(mine["counts"], np.int32)
        if not len(names):
            return table.slice(0, 0)
        tails = np.concatenate([
            _joined(mine["tails"], np.uint32), _joined(table.filter(pc.invert(named))["tails"], np.uint32)
        ])
        order = np.argsort(tails, kind="stable")
        ordered = tails[order]
        same = ordered[1:] == ordered[:-1]
        shared = np.empty(len(tails), bool)
        shared[order] = np.r_[same, False] | np.r_[False, same]
        starts = np.cumsum(lengths) - lengths
        counts = np.add.reduceat(shared[: int(lengths.sum())], starts, dtype=np.int64)
        some = counts > 0
        return pa.Table.from_batches([_bucket_rows(table.schema, bits, names[some], counts[some])])

    return count


def _bucket_sums(table: pa.Table) -> pa.Table:
    names, counts = _joined(table["names"], np.int64), _joined(table["counts"], np.int32)
    every, place = np.unique(names, return_inverse=True)
    sums = np.bincount(place, counts, len(every)).astype(np.int64)
    return pa.table({"of_set": pa.array(every), "shared": pa.array(sums)})


def profiles(texts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Of each row key, set and n; of each set, how many of its n-grams others share at most."""
    few_rows_a_batch(texts.sparkSession)
    bits = max(3, (text_bytes(texts) // FRAGMENT_BYTES).bit_length())
    # rows about documents pass by the fragments, spread over four times as many groups
    aside = -1 - F.pmod(F.xxhash64(F.col(key), "text"), F.lit(4 << bits))
    rows = texts.select(F.col(key).alias("doc_id"), "text", aside.cast("long").alias("aside"))
    layout = _PROFILE.format(key=rows.schema["doc_id"].dataType.simpleString())
    sent = rows.mapInArrow(_profiled(bits), layout)
    counted = written(
        sent.groupBy("fragment").applyInArrow(_shared_in_fragment(bits), layout), "ngram-profiles"
    )
    documents = counted.where("bucket is null").select("doc_id", "set", "n")
    buckets = counted.where("bucket is not null").select("bucket", "names", "counts")
    return documents, buckets.groupBy("bucket").applyInArrow(_bucket_sums, "of_set long, shared long")


def _likely_in(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose id's hash is that of a wanted id: most others need not be shuffled.

    The bitmaps that all tasks get have ``FILTER_BITS`` bits, 2 MiB, whatever the input;
    the more ids there are the more other rows pass, and the join that follows drops them.
    """
    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))

    bitmaps = wanted.groupBy(F.bitmap_bucket_number(place("wanted")).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place("wanted"))).alias("bits")
    )
    at = F.bitmap_bit_position(place("doc_id")).cast("int")
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, at % 8) == 1
    same = F.bitmap_bucket_number(place("doc_id")) == F.col("bucket")
    return rows.join(F.broadcast(bitmaps), same).where(is_set).select(*rows.columns)


def classes_with_links(texts: DataFrame, key: str, documents: DataFrame, shared: DataFrame) -> DataFrame:
    """``set``, ``grams`` of the classes that share enough n-grams with others to have a link."""
    enough = 100 * F.col("shared") >= THRESHOLD_PERCENT * F.col("n")
    classes = documents.where("n > 0").groupBy("set").agg(
        F.min("doc_id").alias("doc_id"), F.max("n").alias("n")
    )
    left = written(
        classes.join(shared, F.col("set") == F.col("of_set")).where(enough), "ngram-classes"
    )
    one_each = left.select(F.col("doc_id").alias("wanted")).distinct()
    rows = texts.select(F.col(key).alias("doc_id"), "text").where(F.col("text").isNotNull())
    likely = _likely_in(rows, one_each)
    # an inner join, as ids are distinct: the optimizer would move a semi join below the filter
    wanted = likely.join(one_each, F.col("doc_id").eqNullSafe(F.col("wanted")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in small_batches(batches, "text", 1 << 20):
            grams = [ngrams_of(text, words) for text in batch.column(0).to_pylist()]
            grams = [g for g in grams if len(g)]
            if grams:
                ends = np.cumsum([len(g) for g in grams])
                values = pa.array(np.concatenate(grams).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(map(_name, grams), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), values),
                    ],
                    ["set", "grams"],
                )

    made = wanted.select("text").mapInArrow(sets, "set long, grams array<long>")
    return written(
        made.join(left.select("set"), "set", "left_semi").dropDuplicates(["set"]), "ngram-sets"
    )


def head_postings(sets: DataFrame) -> DataFrame:
    """``gram``, ``set`` and ``n`` of the n-grams in the head of each set's order.

    Rarest first; n-grams of one class only come first of all and find no partner, so they
    take places but are not returned.
    """
    grams = sets.select("set", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    frequency = grams.groupBy("gram").agg(F.count("*").alias("classes")).where("classes > 1")
    ordered = (
        grams.join(frequency, "gram")
        .groupBy("set", "n")
        .agg(F.array_sort(F.collect_list(F.struct("classes", "gram"))).alias("order"))
    )
    alone = F.col("n") - F.size("order")
    head = F.col("n") - F.ceil(F.col("n") * THRESHOLD_PERCENT / 100) + 1 - alone
    first = F.slice(F.col("order")["gram"], F.lit(1), head.cast("int"))
    return ordered.where(head > 0).select("set", "n", F.explode(first).alias("gram"))


def groups_of(postings: DataFrame) -> DataFrame:
    """``leader``, ``set``, ``n``: the classes that share a head n-gram with the leader.

    All pairs of classes with a common head n-gram are together in a group, that of the
    bucket's smallest name. The bucket itself is never gathered.
    """
    leaders = postings.groupBy("gram").agg(F.min("set").alias("leader"), F.count("*").alias("of"))
    members = postings.join(leaders.where("of > 1").drop("of"), "gram")
    return members.select("leader", "set", "n").distinct()


def _linked(a: list[np.ndarray], b: list[np.ndarray] | None) -> np.ndarray:
    """Pairs (i, j) of sets, within a or between a and b, whose Jaccard reaches the threshold.

    Overlaps are counted per fragment of the hash order and summed per pair.
    """
    other = a if b is None else b
    sizes_a, sizes_b = (np.array([len(s) for s in x]) for x in (a, other))
    overlap = np.zeros((len(a), len(other)), np.float32)
    bounds = [np.uint64((1 << 64) // CELL_FRAGMENTS * i) for i in range(1, CELL_FRAGMENTS)]
    cuts_a = [np.r_[0, np.searchsorted(s, bounds), len(s)] for s in a]
    cuts_b = cuts_a if b is None else [np.r_[0, np.searchsorted(s, bounds), len(s)] for s in b]
    for f in range(CELL_FRAGMENTS):
        part_a = [s[c[f] : c[f + 1]] for s, c in zip(a, cuts_a, strict=True)]
        part_b = part_a if b is None else [s[c[f] : c[f + 1]] for s, c in zip(other, cuts_b, strict=True)]
        every, inverse, count = np.unique(
            np.concatenate(part_a if b is None else part_a + part_b), return_inverse=True, return_counts=True
        )
        common = count > 1
        column = np.cumsum(common) - 1
        width = int(common.sum())
        n_a = sum(map(len, part_a))
        row_a = np.repeat(np.arange(len(a)), [len(p) for p in part_a])
        row_b = row_a if b is None else np.repeat(np.arange(len(other)), [len(p) for p in part_b])
        codes_a = inverse[:n_a]
        codes_b = codes_a if b is None else inverse[n_a:]
        step = max(1, (4 << 20) // max(len(a), len(other)))  # bounds the dense matrices
        for at in range(0, width, step):
            dense = []
            for rows, codes, size in ((row_a, codes_a, len(a)), (row_b, codes_b, len(other))):
                use = common[codes] & (column[codes] >= at) & (column[codes] < at + step)
                matrix = np.zeros((size, min(step, width - at)), np.float32)
                matrix[rows[use], column[codes[use]] - at] = 1
                dense.append(matrix)
            overlap += dense[0] @ dense[1].T
    union = sizes_a[:, None] + sizes_b[None, :] - overlap
    linked = 100 * overlap.astype(np.float64) >= THRESHOLD_PERCENT * union.astype(np.float64)
    if b is None:
        linked = np.triu(linked, 1)
    return np.argwhere(linked)


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs: each node under the root that was met first."""
    root = list(range(n))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        x, y = top(int(i)), top(int(j))
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(i, top(i)) for i in range(n) if top(i) != i]


_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _cell_links(table: pa.Table) -> pa.Table:
    """The spanning forest of a cell's links; side 0 alone, or sides 0 and 1 against each other."""
    sides = np.array(table["side"].to_pylist())
    names = table["set"].to_pylist()
    grams = [np.sort(np.array(g, np.int64).view(np.uint64)) for g in table["grams"].to_numpy()]
    mine, theirs = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    if not len(mine) or (len(theirs) == 0 and len(mine) < 2):
        return _EDGES.empty_table()
    a = [grams[i] for i in mine]
    if len(theirs):
        pairs = _linked(a, [grams[i] for i in theirs])
        pairs = np.stack([mine[pairs[:, 0]], theirs[pairs[:, 1]]], axis=1)
    else:
        pairs = mine[_linked(a, None)]
    found = _forest(pairs, len(names))
    return pa.Table.from_arrays(
        [pa.array([names[i] for i, _ in found], pa.int64()), pa.array([names[j] for _, j in found], pa.int64())],
        schema=_EDGES,
    )


def _parts(grams: Column, classes: Column) -> Column:
    """Parts of which none has much more than the bounds of a cell's side."""
    return F.greatest(F.ceil(grams / CELL_NGRAMS), F.ceil(classes / CELL_CLASSES)).cast("long")


def links(sets: DataFrame) -> DataFrame:
    """Edges ``u``, ``v`` between classes that connect exactly what the links connect."""
    members = written(groups_of(head_postings(sets)), "ngram-groups")
    sizes = members.groupBy("leader").agg(
        F.sum("n").alias("grams_in_group"), F.count("*").alias("classes_in_group")
    )
    parts = _parts(F.col("grams_in_group"), F.col("classes_in_group"))
    placed = members.join(sizes.where("classes_in_group > 1"), "leader").select(
        "leader", "set", parts.alias("parts"), F.pmod(F.xxhash64("set"), parts).alias("part")
    )
    # the leader goes to every part, so that what is linked with it is connected at once
    own = placed.where(F.col("set") != F.col("leader"))
    leader = (
        placed.where(F.col("set") == F.col("leader"))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    )
    spread = own.unionByName(leader)
    cells = spread.withColumn("side", F.lit(0)).join(sets, "set").select("leader", "part", "side", "set", "grams")
    first = written(
        cells.groupBy("leader", "part").applyInArrow(_cell_links, "u long, v long"), "ngram-links"
    )
    split = placed.where("parts > 1")
    if split.isEmpty():
        return first
    roots = components(first)
    known = split.join(roots, F.col("set") == F.col("node"), "left").select(
        "leader", "set", "parts", "part", F.coalesce("root", "set").alias("root")
    )
    known = written(known, "ngram-split-groups")
    largest = known.groupBy("leader", "root").agg(F.count("*").alias("c")).groupBy("leader").agg(
        F.max(F.struct("c", "root"))["root"].alias("main")
    )
    strays = known.join(largest, "leader").where(F.col("root") != F.col("main")).join(
        sets.select(F.col("set").alias("stray"), F.size("grams").alias("n")), F.col("set") == F.col("stray")
    )
    stray_parts = strays.groupBy("leader").agg(
        _parts(F.sum("n"), F.count("*")).alias("stray_parts")
    )
    side_0 = (
        strays.join(stray_parts, "leader")
        .withColumn("row", F.pmod(F.xxhash64(F.lit(1), "set"), F.col("stray_parts")))
        .select("leader", "row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "set", F.lit(0).alias("side"))
    )
    side_1 = known.join(stray_parts, "leader").select(
        "leader",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("stray_parts") - 1)).alias("row"),
        "part", "set", F.lit(1).alias("side"),
    )
    crossed = side_0.unionByName(side_1).join(sets, "set").select("leader", "row", "part", "side", "set", "grams")
    second = crossed.groupBy("leader", "row", "part").applyInArrow(_cell_links, "u long, v long")
    return written(first.union(second), "ngram-links")


def near_copies(texts: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row: the key, ``n_shingles``, ``set`` (null if empty), ``group`` and ``component_id``.

    ``set`` names the row's set of n-grams and ``group`` its component; rows with equal
    ``group`` are near copies of each other, directly or over others.
    """
    documents, shared = profiles(texts, key)
    sets = classes_with_links(texts, key, documents, shared)
    roots = components(links(sets))
    in_group = documents.join(roots, F.col("set") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "set", F.coalesce("root", "set").alias("group")
    )
    smallest = (
        in_group.where(F.col("group").isNotNull())
        .groupBy("group")
        .agg(F.min("doc_id").alias("component_id"))
        .withColumnRenamed("group", "of_group")
    )
    return in_group.join(smallest, F.col("group") == F.col("of_group"), "left").select(
        F.col("doc_id").alias(key),
        "n_shingles",
        "set",
        "group",
        F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )

