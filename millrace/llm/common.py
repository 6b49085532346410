"""What several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import release, small_batches as bounded_batches

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; the quick function serves texts of ASCII alone."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield f(batch)
        release()

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32(doc_id as text) mod 4 is 2: no model learns from them. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def row_key(docs: DataFrame) -> list[Column]:
    """Two long columns that tell (doc_id, text) of a row apart from any other: ids can be null, or stand for two texts."""
    text, name = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("string")
    who = (F.coalesce(name, F.lit("")), F.col("doc_id").isNull(), F.col("text").isNull())
    return [F.xxhash64(text, *who), F.xxhash64(*who, F.crc32(text.cast("binary")), F.octet_length(text))]


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that df does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
