"""What the operators on documents share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task holds at a time.
BLOCK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_remainder(column: str, divisor: int) -> Column:
    """crc32 of the number written as text, modulo the divisor; 0 for NULL."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(divisor))


def blocks(
    batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES
) -> Iterator[pa.Table]:
    """Rows of Arrow batches in blocks of about so many bytes of text (or of the numbers of a
    list column), at least a row each."""
    for batch in batches:
        column = batch.column(text)
        if pa.types.is_list(column.type):
            sizes = pc.multiply(pc.fill_null(pc.list_value_length(column), 0), 8)
        else:
            sizes = pc.fill_null(pc.binary_length(column), 0)
        first, total = 0, 0
        for row, size in enumerate(sizes.to_pylist()):
            if row > first and total + size > limit:
                yield pa.Table.from_batches([batch.slice(first, row - first)])
                first, total = row, 0
            total += size
        if first < batch.num_rows:
            yield pa.Table.from_batches([batch.slice(first)])


def texts_as_bytes(block: pa.Table, text: str = "text") -> list[bytes]:
    """The UTF-8 bytes of each text, empty for NULL."""
    column = block.column(text).combine_chunks()
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [value or b"" for value in column.to_pylist()]
