"""What several operators of this package share."""

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# White space between words; what is left are the words.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; NULL without an id."""
    return F.crc32(id_column.cast("string").cast("binary")) % modulus


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; NULL gives no bytes."""
    return [value or b"" for value in batch.column(name).cast(pa.binary()).to_pylist()]


def words_of(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case. On bytes both methods know ASCII only."""
    return text.lower().split()


def in_pieces(batches: Iterable[pa.RecordBatch], name: str,
              max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `max_bytes` of the text column, or one row."""
    for batch in batches:
        offsets = _offsets(batch.column(name))
        start = 0
        for row in range(1, batch.num_rows + 1):
            if row == batch.num_rows or offsets[row + 1] - offsets[start] > max_bytes:
                yield batch.slice(start, row - start)
                start = row


def _offsets(column: pa.Array) -> list[int]:
    lengths = pc.binary_length(column.cast(pa.binary())).fill_null(0).to_pylist()
    total, offsets = 0, [0]
    for length in lengths:
        total += length
        offsets.append(total)
    return offsets
