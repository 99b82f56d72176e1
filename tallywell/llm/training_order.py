"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride shards.

Documents are encoded and cut into sequences of one length. A keyed Feistel network,
walked until it falls into range, is a permutation of the sequences' numbers: it gives
each its slot in the training order without a sort or a table. A shard holds a range of
slots; each is one file of records of equal size, so that the place of a slot in its file
follows from its number, and reading can begin at any slot.
"""

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywell.llm.common import id_and_text, in_slices, materialize
from tallywell.llm.tokens import default_path, encode, vocabulary
from tallywell.session import new_path

SEQUENCE_TOKENS = 1024
SHARD_SEQUENCES = 4096
END_OF_TEXT = 2
ROUNDS = 6

#: Every record ends with this byte, as Spark's text writer puts it.
SEPARATOR = "\n"


class Permutation:
    """A keyed permutation of 0 .. n - 1: a balanced Feistel network over 2b bits with cycle-walking."""

    def __init__(self, n: int, key: str, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
        digest = [hashlib.sha256(f"{key}:{k}".encode()).digest() for k in range(rounds)]
        self.keys = [np.uint64(int.from_bytes(d[:8], "little")) for d in digest]

    def _mix(self, right: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (right ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & np.uint64((1 << self.half) - 1)

    def _once(self, values: np.ndarray, keys: list) -> np.ndarray:
        bits, low = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = values >> bits, values & low
        for key in keys:
            left, right = right, left ^ self._mix(right, key)
        # halves change places at the end, so the inverse is the same walk with the keys turned round
        return right << bits | left

    def _walk(self, values: np.ndarray, keys: list) -> np.ndarray:
        out = self._once(np.asarray(values, np.uint64), keys)
        outside = np.flatnonzero(out >= self.n)
        while len(outside):
            out[outside] = self._once(out[outside], keys)
            outside = outside[out[outside] >= self.n]
        return out.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, self.keys)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self.keys[::-1])


def id_type(path: str) -> np.dtype:
    """Little-endian ids of the least width that the vocabulary needs."""
    return np.dtype("<u2") if len(vocabulary(path).of_id) <= 1 << 16 else np.dtype("<u4")


def write_sequences(docs: DataFrame, id_col: str, text_col: str, path: str, length: int, end_id: int) -> DataFrame:
    """Written rows ``part, own, n, packed``: sequences of whole documents one after the other.

    Every document is followed by the end id. A row is a block of a few MB of text of one
    partition; its last sequence is filled up with the end id. ``own`` is the number of
    sequences of the partition before the block.
    """
    kind = id_type(path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = TaskContext.get().partitionId(), 0
        for batch in batches:
            for slice_ in in_slices(batch):
                ids = array("I")
                for text in slice_.column("text").to_pylist():
                    ids.extend(encode(text, path))
                    ids.append(end_id)
                n = -(-len(ids) // length)
                whole = np.full(n * length, end_id, kind)
                whole[: len(ids)] = np.frombuffer(ids, np.uint32)
                columns = [pa.array([part], pa.int32()), pa.array([own], pa.int64()), pa.array([n], pa.int64()), pa.array([zstandard.compress(whole.tobytes(), 6)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "own", "n", "packed"])
                own += n

    return materialize(id_and_text(docs, id_col, text_col).mapInArrow(cut, "part int, own long, n long, packed binary"), "sequences")


def _numbered(blocks: DataFrame) -> DataFrame:
    """``first``, the number of a block's first sequence, and ``packed``.

    The sequences of the partitions before are one number per partition, written so that
    the optimizer knows its size and leaves the blocks where they are.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n").alias("_all"))
    parts = materialize(parts.select("part", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("before")), "partitions")
    return blocks.join(parts, "part").select((F.col("before") + F.col("own")).alias("first"), "packed")


def write_training_order(
    docs: DataFrame,
    folder: str,
    key: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    length: int = SEQUENCE_TOKENS,
    shard_sequences: int = SHARD_SEQUENCES,
    end_id: int = END_OF_TEXT,
) -> int:
    """Write the shards ``folder/shard=N`` and return the number of sequences.

    A null or empty text is the end id alone. A record is ``length`` little-endian ids and a
    separator byte. Encoded text is written once, since the permutation needs the number
    of sequences; a lost executor costs a re-read of it. Without rows nothing is written.
    """
    path = path or default_path()
    blocks = write_sequences(docs, id_col, text_col, path, length, end_id)
    total = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    if not total:
        return 0
    order, stride = Permutation(total, key), length * id_type(path).itemsize

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, packed in zip(batch.column("first").to_pylist(), batch.column("packed").to_pylist()):
                records = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(-1, stride)
                slots = order.slots(first + np.arange(len(records)))
                rows = np.argsort(slots)
                shards, starts = np.unique(slots[rows] // shard_sequences, return_index=True)
                out = [(int(s), slots[own].tobytes(), zstandard.compress(records[own].tobytes(), 6)) for s, own in zip(shards, np.split(rows, starts[1:]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary()))], ["shard", "slots", "packed"])

    def gather(table: pa.Table) -> pa.Table:
        slots = np.frombuffer(b"".join(table.column("slots").to_pylist()), np.int64)
        records = b"".join(zstandard.decompress(p) for p in table.column("packed").to_pylist())
        shard = pa.array(np.full(len(slots), table.column("shard")[0].as_py()))
        ends = pa.py_buffer((np.arange(len(slots) + 1) * stride).astype(np.int32).tobytes())
        own = pa.Array.from_buffers(pa.binary(), len(slots), [None, ends, pa.py_buffer(records)])
        return pa.table([shard, pa.array(slots), own], ["shard", "slot", "record"])

    dealt = _numbered(blocks).mapInArrow(deal, "shard long, slots binary, packed binary")
    records = dealt.groupBy("shard").applyInArrow(gather, "shard long, slot long, record binary")
    lines = records.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value"))
    lines.write.partitionBy("shard").option("lineSep", SEPARATOR).option("compression", "none").text(folder)
    return total


def read_training_order(
    spark: SparkSession,
    folder: str,
    first_slot: int = 0,
    path: str | None = None,
    length: int = SEQUENCE_TOKENS,
    shard_sequences: int = SHARD_SEQUENCES,
    order: Permutation | None = None,
) -> DataFrame:
    """``shard, slot, at`` (byte of the record in its file), ``sequence`` and ``ids`` from a slot on; earlier shards aren't opened.

    ``sequence`` is the number that the slot came from, null without the permutation.
    """
    stride = length * id_type(path or default_path()).itemsize

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                records = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride + 1)
                slots = shard * shard_sequences + np.arange(len(records))
                wanted = np.flatnonzero(slots >= first_slot)
                for some in np.array_split(wanted, 1 + len(wanted) // 1024):
                    numbers = pa.array(order.numbers(slots[some])) if order else pa.nulls(len(some), pa.int64())
                    columns = [pa.array(np.full(len(some), shard)), pa.array(slots[some]), pa.array(some * (stride + 1)), numbers]
                    ids = pa.array([records[k, :stride].tobytes() for k in some], pa.binary())
                    yield pa.RecordBatch.from_arrays([*columns, ids], ["shard", "slot", "at", "sequence", "ids"])

    files = spark.read.format("binaryFile").load(folder).where(F.col("shard") >= first_slot // shard_sequences)
    return files.select(F.col("shard").cast("long"), "content").mapInArrow(cut, "shard long, slot long, at long, sequence long, ids binary")


def materialise(docs: DataFrame, key: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the training order (to a new shared folder by default) and read the shards back: one row per sequence."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "training_order")
    total = write_training_order(docs, folder, key, id_col, text_col)
    if not total:
        return spark.createDataFrame([], "shard long, slot long, at long, sequence long, ids binary")
    return read_training_order(spark, folder, order=Permutation(total, key))


def digests(records: DataFrame) -> DataFrame:
    """Every record with the checksum of its bytes instead of them."""
    return records.select("shard", "slot", "at", "sequence", F.crc32("ids").alias("ids_crc32"))
