"""Helpers of the corpus operators: table reading, folds, bounded samples, Arrow batches cut by size."""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus


def held_out(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from; a row without an id belongs to them."""
    return F.coalesce(fold(doc_id, modulus) == remainder, F.lit(True))


def sampled(rows: DataFrame, limit: int, by: str | None = None, seed: int = 17) -> DataFrame:
    """At most ``limit`` rows (of each value of ``by``, of which there are few) in the order of a hash of doc_id.

    Only the lowest part of the hashes can hold the first rows, so the rest stays where it is: of a group of any size about four times
    ``limit`` rows are sent.
    """
    place = F.xxhash64(F.lit(seed), "doc_id")
    if by:
        sizes = {r[by]: r["n"] for r in rows.where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n")).collect()}
        if not sizes:
            return rows.limit(0)
        share = F.create_map(*[F.lit(x) for value, n in sizes.items() for x in (value, 4 * limit / n)])
        near = rows.where(place.cast("double") / 2.0**64 + 0.5 < F.element_at(share, F.col(by)))
        return near.withColumn("_place", F.row_number().over(Window.partitionBy(by).orderBy(place, "doc_id"))).where(F.col("_place") <= limit).drop("_place")
    share = 4 * limit / max(1, rows.count())
    if share < 1:
        rows = rows.where(place < F.lit(int((share - 0.5) * 2**64)))
    return rows.orderBy(place, "doc_id").limit(limit)


def unused(columns: list[str], prefix: str) -> str:
    """``prefix``, made longer until no column begins with it."""
    while any(c.lower().startswith(prefix) for c in columns):
        prefix = "_" + prefix
    return prefix


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into row ranges of about ``most`` bytes of ``column``; one long row stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        lengths = np.asarray(pc.binary_length(values).fill_null(0), dtype=np.int64)
        part = np.cumsum(lengths) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all the ranges [start, start + length), one after the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return LETTER.search(text) is not None
