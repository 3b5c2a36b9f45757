"""Helpers shared by the corpus operators."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table below ``sf_dir``, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z only lower-cased; null counts as empty.

    Text of single-byte characters takes the fast built-in, which does the same there.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def map_rows(df: DataFrame, schema: str | T.StructType, rows: Callable[[Iterator[tuple]], Iterator[tuple]], batch: int = 2000) -> DataFrame:
    """Stream the rows of each partition through ``rows``, by Arrow batches.

    Only one incoming batch and ``batch`` outgoing rows are held at a time.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)

    def incoming(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            columns = b.columns
            for i in range(b.num_rows):
                yield tuple(c[i].as_py() for c in columns)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in rows(incoming(batches)):
            held.append(row)
            if len(held) >= batch:
                yield _record_batch(held, arrow)
                held = []
        if held:
            yield _record_batch(held, arrow)

    return df.mapInArrow(packed, struct)


def _record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def hash_sample(df: DataFrame, id_column: str, rows: int) -> DataFrame:
    """Distinct ids of ``rows`` rows at most, those of least hash.

    Few more than these leave their tasks: a share of the hashes that holds
    twice as many is taken first.
    """
    n = df.count()
    scaled = F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(1_000_000_007))
    kept = df.where(scaled < int(1_000_000_007 * min(1.0, 2 * rows / max(1, n)) + 1))
    return kept.select(id_column).orderBy(scaled, id_column).limit(rows).distinct()
