"""Shared pieces: Arrow functions over texts, the held-out split, conditional broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.sources.storage import scratch

#: Largest side, in rows, that an operator broadcasts after it has counted it.
BROADCAST_ROWS = 500_000
#: Rows of one Arrow batch; with texts of 100 kB a batch then holds some 25 MB.
BATCH_ROWS = 256

_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "array<string>": pa.list_(pa.string()),
    "array<int>": pa.list_(pa.int32()),
}


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches of whole texts small, so that workers need little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def per_text(
    fields: dict[str, str], make: Callable[[], Callable[[bytes], tuple]]
) -> Callable[[Column], Column]:
    """Column function from a text to a struct.

    ``make`` runs once per task and gives a function of the UTF-8 bytes of one text (null texts
    come as empty ones) that returns the values of ``fields`` in order.
    """
    names = list(fields)
    arrow = [pa.field(name, _ARROW[kind]) for name, kind in fields.items()]
    schema = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))

    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        function = make()
        for texts in batches:
            rows = [function(text or b"") for text in texts.cast(pa.binary()).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            yield pa.StructArray.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, arrow, strict=True)],
                fields=arrow,
            )

    return F.arrow_udf(apply, schema)


def per_row(
    fields: dict[str, str], make: Callable[[], Callable[..., tuple]]
) -> Callable[..., Column]:
    """Like :func:`per_text` for several string columns; null values come as None.

    A field may also be of another type, given as a pair of its DDL and its Arrow type.
    """
    kinds = {name: kind if isinstance(kind, tuple) else (kind, _ARROW[kind])
             for name, kind in fields.items()}
    arrow = [pa.field(name, own) for name, (_, own) in kinds.items()]
    schema = T.StructType.fromDDL(", ".join(f"{name} {ddl}" for name, (ddl, _) in kinds.items()))

    def apply(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        function = make()
        for columns in batches:
            values = [column.cast(pa.binary()).to_pylist() for column in columns]
            rows = [function(*row) for row in zip(*values, strict=True)]
            parts = list(zip(*rows, strict=True)) if rows else [[] for _ in arrow]
            yield pa.StructArray.from_arrays(
                [pa.array(part, field.type) for part, field in zip(parts, arrow, strict=True)],
                fields=arrow,
            )

    return F.arrow_udf(apply, schema)


def held_out(doc_id: Column) -> Column:
    """True where the checksum of the id says that labels must not be learned from.

    A null id counts as held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(True))


def small_side(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if a count shows at most ``limit`` rows, else leave the join to Spark.

    ``frame`` should be cheap to evaluate (a written table): it is counted once.
    """
    few = frame.limit(limit + 1).count() <= limit
    return F.broadcast(frame) if few else frame


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _matched(
    docs: DataFrame, keys: DataFrame, key_columns: dict[str, Column], how: str
) -> DataFrame:
    """Rows of ``docs`` packed as ``row`` beside their key, joined by key; null equals null."""
    # Packed, the columns of the input cannot clash with those of the key.
    packed = docs.select(
        F.struct("*").alias("row"),
        *[value.alias(f"key_{name}") for name, value in key_columns.items()],
    )
    side = small_side(keys.select(*[F.col(name).alias(f"is_{name}") for name in key_columns]))
    same = [F.col(f"key_{name}").eqNullSafe(F.col(f"is_{name}")) for name in key_columns]
    return packed.join(side, same, how)


def without(docs: DataFrame, keys: DataFrame, key_columns: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose key is not among ``keys``, with all columns; null equals null.

    ``key_columns`` gives the expression over ``docs`` of each column of ``keys``.
    """
    return _matched(docs, keys, key_columns, "left_anti").select("row.*")


def one_of_each(docs: DataFrame, keys: DataFrame, key_columns: dict[str, Column]) -> DataFrame:
    """One row of ``docs`` for each key among ``keys``, with all columns."""
    matched = _matched(docs, keys, key_columns, "left_semi")
    return matched.dropDuplicates([f"key_{name}" for name in key_columns]).select("row.*")
