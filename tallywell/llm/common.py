"""Helpers shared by the text operators: narrow inputs, Arrow batches, written steps."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.session import new_path

__all__ = ["annotate", "bitmap_of", "crc32_mod", "id_and_text", "in_slices", "materialize", "sha256_of_ids", "text_batches"]

#: Bytes of text that a task turns into Python objects at a time.
SLICE_BYTES = 4 << 20


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder, zstd-compressed as it may hold texts, and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names, a null text as empty.

    Extra columns of any name are left behind here, so they can't clash.
    """
    kept = [docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")]
    return docs.select(*kept, *[docs[c].alias(c) for c in more])


def in_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` bytes of one column; a longer row stands alone."""
    sizes = batch.column(column).cast(pa.large_string()).buffers()[1]
    offsets = memoryview(sizes).cast("q")[batch.column(column).offset :] if batch.num_rows else []
    start = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or offsets[i + 1] - offsets[start] > most:
            yield batch.slice(start, i - start)
            start = i


def text_batches(work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    """A function for mapInArrow that hands over bounded slices of the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_slices(batch):
                out = work(part)
                if out.num_rows:
                    yield out

    return run


def crc32_mod(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit(""))), F.lit(modulus))


def sha256_of_ids(ids: Column) -> Column:
    return F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256)


def bitmap_of(slots: DataFrame, bits: int) -> bytes:
    """The values of the column ``slot`` as one bitmap of 2^bits places, least bit first.

    Tasks unite bitmaps of 4 kB; what the driver gets is bounded by ``bits``, whatever the input.
    """
    part = F.shiftright("slot", 15).cast("int").alias("part")
    parts = slots.groupBy(part).agg(F.bitmap_construct_agg(F.col("slot") % 32768).alias("bits"))
    found = bytearray((1 << bits) // 8)
    for row in parts.toLocalIterator():
        found[row["part"] * 4096 : row["part"] * 4096 + len(row["bits"])] = row["bits"]
    return bytes(found)


def annotate(docs: DataFrame, text_col: str, work: Callable[[pa.RecordBatch], list[pa.Array]], fields: str) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``) and the ``fields`` that ``work`` computes.

    ``work`` gets batches with ``row`` and ``text`` (null as empty) and returns one
    array per field. Columns of ``docs`` can have any name, as they stay in the struct.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    names = [f.strip().split(" ")[0] for f in fields.split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("row"), *work(batch)], ["row", *names])

    return rows.mapInArrow(text_batches(run), f"row {rows.schema['row'].dataType.simpleString()}, {fields}")
