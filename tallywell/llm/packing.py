"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents are cut, their lengths counted, and the table of counts by length (one
entry per possible length, whatever the corpus) is packed on the driver: for the
longest length left, the gap is filled exactly by one, two or three other lengths
that are still available, as often as their counts allow; where no exact filling
exists, by the best fit below. Every piece then finds its own place from its rank
among the pieces of its length.
"""

import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.common import id_and_text, materialize, text_batches
from tallywell.llm.tokens import default_path, encode

CAPACITY = 1024
END_OF_TEXT = 2

#: Pieces of one length that one task numbers.
BUCKET_ROWS = 20_000
LEAST_BUCKETS = 256


def cut_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_OF_TEXT,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document, ended by ``end_id``.

    Only longer documents are cut; the first piece takes what doesn't fill a whole one.
    A null or empty text is the end token alone. Repeated rows stay repeated.
    """
    path = path or default_path()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, pieces, starts, lengths, crcs, ids = array("i"), array("i"), array("q"), array("q"), array("q"), []
        for row, text in enumerate(batch.column("text").to_pylist()):
            own = np.array([*encode(text, path), end_id], "<u4")
            borders = [0, *range((len(own) - 1) % capacity + 1, len(own) + 1, capacity)]
            for piece, (a, b) in enumerate(zip(borders, borders[1:])):
                rows.append(row)
                pieces.append(piece)
                starts.append(a)
                lengths.append(b - a)
                crcs.append(zlib.crc32(own[a:b].tobytes()))
                if with_ids:
                    ids.append(own[a:b].tobytes())
        columns = [batch.column("doc_id").take(pa.array(rows, pa.int32())), pa.array(pieces, pa.int32())]
        columns += [pa.array(x, pa.int64()) for x in (starts, lengths, crcs)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
        return pa.RecordBatch.from_arrays(columns, names)

    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(text_batches(work), schema)


class _Lengths:
    """Counts by length, and the sums that one, two or three of them reach."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = dict(sorted(counts.items()))
        self.whole = (1 << (capacity + 1)) - 1

    def filling(self, gap: int, taken: tuple[int, ...]) -> tuple[int, ...]:
        """Up to three lengths with the largest sum not above the gap, as availability allows."""
        free = {x: n - taken.count(x) for x, n in self.left.items() if x <= gap and n > taken.count(x)}
        single = sum(1 << x for x in free)
        pair = triple = 0
        for x in free:
            pair |= single << x & self.whole
        for x in free:
            triple |= pair << x & self.whole
        reached = (single | pair | triple) & ((1 << (gap + 1)) - 1)
        while reached:
            total = reached.bit_length() - 1
            if found := self._parts(total, free, single, pair):
                return found
            reached ^= 1 << total
        return ()

    def _parts(self, total: int, free: dict[int, int], single: int, pair: int) -> tuple[int, ...]:
        if total in free:
            return (total,)
        if two := self._two(total, free):
            return two
        for a in sorted(free, reverse=True):
            if a < total and pair >> (total - a) & 1:
                rest = {x: n - (x == a) for x, n in free.items() if x <= a and n > (x == a)}
                if two := self._two(total - a, rest):
                    return (a, *two)
        return ()

    @staticmethod
    def _two(total: int, free: dict[int, int]) -> tuple[int, ...]:
        """The pair with this sum of which most copies are left."""
        best, most = (), 0
        for a, n in free.items():
            b = total - a
            if b <= a and b in free:
                copies = n // 2 if a == b else min(n, free[b])
                if copies > most:
                    best, most = (a, b), copies
        return best

    def take(self, pattern: tuple[int, ...]) -> int:
        """Use a pattern as often as it can be, and say how often."""
        copies = min(self.left[x] // pattern.count(x) for x in set(pattern))
        for x in set(pattern):
            self.left[x] -= copies * pattern.count(x)
            if not self.left[x]:
                del self.left[x]
        return copies


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with their copies; together they use every piece once.

    Each pattern uses up a length to less than one more copy, so there are a few
    patterns per length at most, however many pieces there are.
    """
    lengths, plan = _Lengths(counts, capacity), []
    while lengths.left:
        pattern: tuple[int, ...] = (max(lengths.left),)
        while gap := capacity - sum(pattern):
            more = lengths.filling(gap, pattern)
            if not more:
                break
            pattern += more
        plan.append((pattern, lengths.take(pattern)))
    return plan


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length, rows of (first rank, first sequence, offset), by rank."""
    used: dict[int, int] = {}
    slots: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for pattern, copies in plan:
        for length, offset in zip(pattern, accumulate((0, *pattern))):
            slots.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + copies
        sequence += copies
    return {length: np.array(rows, np.int64) for length, rows in slots.items()}


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces with ``doc_id, piece, start, length, ids_crc32``.

    The order of equal pieces is by these columns, so identical rows alone may trade places.
    Numbering is by length and hash bucket, with the counts of the buckets before added,
    so that a length which a third of all pieces have is numbered by many tasks. The
    number of buckets follows the number of pieces.
    """
    buckets = max(LEAST_BUCKETS, pieces.count() // BUCKET_ROWS)
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    counts = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = keyed.withColumn("_own", F.row_number().over(own) - 1).join(firsts, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_own") + F.col("_before"))

    by_length = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, names = _slots(plan_patterns(by_length, capacity)), pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for each in np.unique(length):
                rows = np.flatnonzero(length == each)
                table = slots[int(each)]
                found = table[np.searchsorted(table[:, 0], rank[rows], "right") - 1]
                sequence[rows], offset[rows] = found[:, 1] + rank[rows] - found[:, 0], found[:, 2]
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*names, "_rank").mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_OF_TEXT,
) -> DataFrame:
    """One row per piece with its sequence and its place there.

    Pieces (a few numbers each, no ids) are written once to the shared folder, since
    they are counted before they are placed. An empty table gives no rows; null ids
    and repeated rows are packed like any other.
    """
    pieces = materialize(cut_documents(docs, id_col, text_col, path, capacity, end_id), "pieces")
    return place_pieces(pieces, capacity)
