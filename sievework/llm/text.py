"""What the operators on texts share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word, and the characters between words, as the contracts fix them (Java and Python syntax).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def n_words(text: Column) -> Column:
    """Words in a text; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


#: Rows of a batch that are worked on at a time where texts go out again: a task holds few texts besides the batch itself.
ROWS_AT_A_TIME = 256


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows."""
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_A_TIME):
            yield batch.slice(at, ROWS_AT_A_TIME)


def held_out(doc_id: Column) -> Column:
    """Documents from which nothing is learnt: one in five, by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def hash_unit(*keys: Column) -> Column:
    """A reproducible number strictly between 0 and 1 for the keys (52 bits of their MD5)."""
    text = F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("\x00")) for k in keys])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(4503599627370496.0)
