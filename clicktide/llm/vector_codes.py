"""Vector codes: product quantisation fitted by Lloyd's rounds over cover trees.

A component x becomes the integer floor(1024 x); a vector is cut into ``PARTS`` consecutive
parts. Each part position has a codebook of up to ``ENTRIES`` entries, which starts as that
part of the smallest ids. A round assigns every part to its nearest entry (ties to the lower
index) and replaces the entries in use by the floored mean of their parts.

1. Each task cuts its rows into blocks of ``BLOCK_ROWS`` and builds a cover tree of each block
   and part position: a node's children are a net of half its radius, and its points are
   neighbours in the tree's order, so that running sums give the sum of any subtree. Blocks and
   trees are written once.
2. A round takes the codebooks to the blocks. A tree is walked level by level: where the
   nearest entry is nearer to every point of a node than any other can be, by the triangle
   inequality, the whole subtree is assigned through its sums; other nodes are replaced by
   their children, and single points are compared exactly. A task sends one row of sums for
   each entry; the driver gets one row for each entry and makes the next codebooks.
3. The same walk gives the final codes. Labels with a thousandth of all rows receive their
   total by broadcast, of which there are a thousand at most; the others by a shuffle.

Comparisons are exact: products of integers below 2**53 for components up to ``NARROW``, else
Python's integers without a tree. Sums are exact as well, in limbs of 22 bits where needed.

Vectors that are null or hold nulls, infinities, NaN or numbers of 2**1000 and more are left
out. All others get a row. The smallest id's vector sets the length: vectors of another length,
or all if it is not a positive multiple of ``PARTS``, have a null code and error. Ids may be
null (then last) or repeated (then ordered by vector), labels null (one label). An error beyond
a long is null and in no label's total. Empty tables give empty codebooks and no rows. Equal
vectors have equal codes; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clicktide.llm.common import joined_to_totals, written

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024.0
BLOCK_ROWS = 1024
NARROW = 1 << 20
LIMB_BITS = 22
LARGEST = 2.0**1000


@dataclass(frozen=True)
class Codes:
    """Codes per row (``vec_id, label, code, error, label_error``) and the final codebooks:
    of each part position its entries, of each entry its integer components."""

    rows: DataFrame
    codebooks: list[list[list[int]]]


def _integers(values: np.ndarray) -> np.ndarray:
    """floor(1024 x) as integers, Python's where 32 bits are too few."""
    floored = np.floor(values.astype(np.float64) * SCALE)
    if not floored.size or np.abs(floored).max() <= NARROW:
        return floored.astype(np.int32)
    return np.array([int(v) for v in floored.ravel()], dtype=object).reshape(floored.shape)


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of points to entries."""
    if points.dtype == object or entries.dtype == object:
        apart = points.astype(object)[:, None, :] - entries.astype(object)[None, :, :]
        return (apart * apart).sum(axis=2)
    points, entries = points.astype(np.float64), entries.astype(np.float64)
    return (
        (points * points).sum(axis=1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(axis=1)
    )


# A tree is the order of its points, and of each node its centre, first and last place in the
# order, squared radius, and first and last child.
_NODE = np.dtype([
    ("centre", "<i4"), ("start", "<i4"), ("end", "<i4"), ("child", "<i4"), ("last", "<i4"), ("radius2", "<f8")
])


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and nodes of the cover tree of some narrow points."""
    n = len(points)
    apart = _squares(points, points)
    order = np.arange(n, dtype=np.int32)
    nodes = [(0, 0, n)]
    shape = []
    for centre, start, end in nodes:  # grows while it is read
        members = order[start:end]
        from_centre = apart[centre, members]
        radius2 = from_centre.max()
        first_child = len(nodes)
        if radius2 > 0:
            within = from_centre <= radius2 / 4
            groups = [(centre, members[within])]
            groups += _net(apart, members[~within], radius2 / 4)
            order[start:end] = np.concatenate([group for _, group in groups])
            for child, group in groups:
                nodes.append((child, start, start + len(group)))
                start += len(group)
        shape.append((first_child, len(nodes), radius2))
    tree = np.empty(len(nodes), _NODE)
    tree["centre"], tree["start"], tree["end"] = np.array(nodes, np.int32).T
    tree["child"], tree["last"], tree["radius2"] = (np.array(column) for column in zip(*shape))
    return order, tree


def _net(apart: np.ndarray, members: np.ndarray, radius2: float) -> list[tuple[int, np.ndarray]]:
    """Centres further than the radius from each other, each with members within it."""
    near = apart[np.ix_(members, members)] <= radius2
    alone = near.sum(axis=1) == 1
    groups = [(int(member), members[i : i + 1]) for i, member in zip(np.flatnonzero(alone), members[alone])]
    left = ~alone
    while True:
        first = int(left.argmax())
        if not len(left) or not left[first]:
            return groups
        group = left & near[first]
        groups.append((int(members[first]), members[group]))
        left &= ~group


def nearest_entries(
    points: np.ndarray, entries: np.ndarray, order: np.ndarray, tree: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Nodes whose points all have the same nearest entry, and these entries: every point once."""
    front = np.zeros(1, np.int64)
    while len(front):
        nodes = tree[front]
        squares = _squares(points[nodes["centre"]], entries)
        best = squares.argmin(axis=1)
        settled = nodes["radius2"] == 0
        if len(entries) > 1 and not settled.all():
            rows = np.arange(len(front))
            away = np.sqrt(squares)
            nearest = away[rows, best]
            away[rows, best] = np.inf
            reach = nearest + 2 * np.sqrt(nodes["radius2"])
            settled |= reach < away.min(axis=1) * (1 - 1e-9)
        elif len(entries) == 1:
            settled[:] = True
        yield front[settled], best[settled]
        open_nodes = nodes[~settled]
        sizes = open_nodes["last"] - open_nodes["child"]
        skipped = np.repeat(np.cumsum(sizes) - sizes, sizes)
        front = np.repeat(open_nodes["child"].astype(np.int64), sizes) + np.arange(sizes.sum()) - skipped


def _blocks(dimension: int, id_type: pa.DataType, label_type: pa.DataType):
    """Blocks of rows with their trees."""
    schema = pa.schema([
        ("ids", pa.list_(id_type)), ("labels", pa.list_(label_type)), ("vectors", pa.binary()),
        ("wide", pa.list_(pa.string())), ("trees", pa.list_(pa.binary())), ("largest", pa.float64()),
    ])

    def block(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        n = table.num_rows
        flat = table.column("embedding").chunk(0).flatten()
        whole = _integers(flat.to_numpy(zero_copy_only=False).reshape(n, dimension))
        narrow = whole.dtype != object
        trees = []
        for part in np.split(whole, PARTS, axis=1) if narrow else ():
            order, tree = cover_tree(part)
            trees += [order.astype(np.int32).tobytes(), tree.tobytes()]
        small = narrow and np.abs(whole).max(initial=0) < 1 << 15
        row = {
            "ids": table.column("vec_id").to_pylist(),
            "labels": table.column("label").to_pylist(),
            "vectors": whole.astype(np.int16 if small else np.int32).tobytes() if narrow else None,
            "wide": None if narrow else [str(v) for v in whole.ravel()],
            "trees": trees,
            "largest": float(max(abs(int(whole.max())), abs(int(whole.min())))) if n else 0.0,
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, BLOCK_ROWS - count)
                held.append(taken)
                count += taken.num_rows
                batch = batch.slice(taken.num_rows)
                if count == BLOCK_ROWS:
                    yield block(pa.Table.from_batches(held))
                    held, count = [], 0
        if held:
            yield block(pa.Table.from_batches(held))

    return read


def _parts_of(row: dict, dimension: int) -> Iterator[tuple[np.ndarray, tuple[np.ndarray, np.ndarray] | None]]:
    """Of each part position a block's points and their tree, if it has one."""
    n = len(row["ids"])
    if row["vectors"] is None:
        whole = np.array([int(v) for v in row["wide"]], dtype=object).reshape(n, dimension)
    else:
        kind = np.int16 if len(row["vectors"]) == 2 * n * dimension else np.int32
        whole = np.frombuffer(row["vectors"], kind).reshape(n, dimension).astype(np.int64)
    for number, points in enumerate(np.split(whole, PARTS, axis=1)):
        if row["vectors"] is None:
            yield points, None
        else:
            order, tree = row["trees"][2 * number : 2 * number + 2]
            yield points, (np.frombuffer(order, np.int32), np.frombuffer(tree, _NODE))


def _as_entries(codebook: list[list[int]]) -> np.ndarray:
    narrow = max((abs(v) for entry in codebook for v in entry), default=0) <= NARROW
    return np.array(codebook, dtype=np.int64 if narrow else object)


def _limbs(value: int, limbs: int) -> list[int]:
    low = (1 << LIMB_BITS) - 1
    return [(value >> LIMB_BITS * i) & low for i in range(limbs - 1)] + [value >> LIMB_BITS * (limbs - 1)]


def _from_limbs(limbs: list[int]) -> int:
    return sum(limb << LIMB_BITS * i for i, limb in enumerate(limbs))


def _summing(codebooks: list[list[list[int]]], dimension: int, limbs: int):
    """Count and sums of each entry's parts over all blocks of a task."""
    width = dimension // PARTS

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [_as_entries(book) for book in codebooks]
        counts = [np.zeros(len(book), np.int64) for book in books]
        sums = [np.zeros((len(book), width), np.int64 if limbs == 1 else object) for book in books]
        for batch in batches:
            for row in batch.to_pylist():
                for number, (points, tree) in enumerate(_parts_of(row, dimension)):
                    book = books[number]
                    if tree is None or book.dtype == object:
                        best = _squares(points, book).argmin(axis=1)
                        np.add.at(counts[number], best, 1)
                        np.add.at(sums[number], best, points)
                        continue
                    order, nodes = tree
                    running = np.zeros((len(points) + 1, width), np.int64)
                    np.cumsum(points[order], axis=0, out=running[1:])
                    for settled, best in nearest_entries(points, book, order, nodes):
                        start, end = nodes["start"][settled], nodes["end"][settled]
                        np.add.at(counts[number], best, end - start)
                        np.add.at(sums[number], best, running[end] - running[start])
        rows = [
            (part, entry, int(counts[part][entry]), *(
                limb for value in sums[part][entry] for limb in _limbs(int(value), limbs)
            ))
            for part in range(PARTS)
            for entry in np.flatnonzero(counts[part])
        ]
        names = ["part", "entry", "n", *(f"s{i}" for i in range(width * limbs))]
        kinds = [pa.int32(), pa.int32()] + [pa.int64()] * (1 + width * limbs)
        columns = list(zip(*rows)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return read


def _coding(codebooks: list[list[list[int]]], dimension: int, schema: pa.Schema):
    """Code and error of each row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [_as_entries(book) for book in codebooks]
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["ids"])
                chosen, error = np.zeros((n, PARTS), np.int64), 0
                for number, (points, tree) in enumerate(_parts_of(row, dimension)):
                    book = books[number]
                    if tree is None or book.dtype == object:
                        chosen[:, number] = _squares(points, book).argmin(axis=1)
                    else:
                        order, nodes = tree
                        for settled, best in nearest_entries(points, book, order, nodes):
                            sizes = nodes["end"][settled] - nodes["start"][settled]
                            skipped = np.repeat(np.cumsum(sizes) - sizes, sizes)
                            places = np.repeat(nodes["start"][settled], sizes) + np.arange(sizes.sum()) - skipped
                            chosen[order[places], number] = np.repeat(best, sizes)
                    apart = points - book[chosen[:, number]]
                    error = error + (apart * apart).sum(axis=1)
                errors = [int(e) if e < 1 << 63 else None for e in error]
                codes = [bytes(code).hex() for code in chosen.astype(np.uint8)]
                yield pa.RecordBatch.from_pydict(
                    {"vec_id": row["ids"], "label": row["labels"], "code": codes, "error": errors}, schema=schema
                )

    return read


def _usable(name: str):
    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST)

    return F.col(name).isNotNull() & F.forall(name, lambda x: F.coalesce(finite(x), F.lit(False)))


def _smallest(kept: DataFrame) -> list[list[float]]:
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding").asc()]
    return [row.embedding for row in kept.orderBy(*order).limit(ENTRIES).select("embedding").collect()]


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> Codes:
    """Codes and codebooks of ``vectors`` (``vec_id, embedding, label``)."""
    from pyspark.sql.pandas.types import to_arrow_type

    kept = vectors.where(_usable("embedding")).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label"
    )
    id_kind, label_kind = (kept.schema[name].dataType for name in ("vec_id", "label"))
    layout = f"vec_id {id_kind.simpleString()}, label {label_kind.simpleString()}, code string, error long"
    first = _smallest(kept)
    dimension = len(first[0]) if first else 0
    fits = F.size("embedding") == dimension
    if not dimension or dimension % PARTS:
        fits, first = F.lit(False), []
    elif any(len(vector) != dimension for vector in first):
        first = _smallest(kept.where(fits))
    uncoded = kept.where(~fits).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
    )
    if not first:
        return Codes(uncoded.withColumn("label_error", F.col("error")), [[] for _ in range(PARTS)])

    id_type, label_type = to_arrow_type(id_kind), to_arrow_type(label_kind)
    blocks = written(
        kept.where(fits).mapInArrow(
            _blocks(dimension, id_type, label_type),
            f"ids array<{id_kind.simpleString()}>, labels array<{label_kind.simpleString()}>, vectors binary, "
            "wide array<string>, trees array<binary>, largest double",
        ),
        "vector-blocks",
    )
    largest = int(blocks.agg(F.max("largest")).first()[0])
    limbs = 1 if largest <= NARROW else -(-largest.bit_length() // LIMB_BITS)

    width = dimension // PARTS
    starts = _integers(np.array(first))
    codebooks = [[[int(v) for v in entry] for entry in part] for part in np.split(starts, PARTS, axis=1)]
    sums = [f"s{i}" for i in range(width * limbs)]
    sum_layout = "part int, entry int, n long, " + ", ".join(f"{name} long" for name in sums)
    for _ in range(rounds):
        partial = blocks.mapInArrow(_summing(codebooks, dimension, limbs), sum_layout)
        totals = partial.groupBy("part", "entry").agg(*(F.sum(name).alias(name) for name in ("n", *sums)))
        for row in totals.collect():  # one row for each entry in use
            values = row[3:]
            codebooks[row.part][row.entry] = [
                _from_limbs(values[i * limbs : (i + 1) * limbs]) // row.n for i in range(width)
            ]

    schema = pa.schema([("vec_id", id_type), ("label", label_type), ("code", pa.string()), ("error", pa.int64())])
    codes = written(
        blocks.mapInArrow(_coding(codebooks, dimension, schema), layout).unionByName(uncoded), "vector-codes"
    )
    totals = written(
        codes.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("label_rows")),
        "label-errors",
    )
    return Codes(joined_to_totals(codes, totals, ["label"], "label_rows").drop("label_rows"), codebooks)
