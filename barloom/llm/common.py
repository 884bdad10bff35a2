"""What several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The largest table that a query asks Spark to broadcast, by measured rows times bytes of a row.
BROADCAST_BYTES = 8 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % F.lit(modulus) == remainder, F.lit(False))


def _hashable(kind: DataType) -> bool:
    """Whether Spark hashes a value of this type: there is no map and no variant in it."""
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a whole row, whatever the order of its columns. A column with maps or variants in it is hashed as JSON, by the order of
    its entries."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    column = lambda f: df[f"`{f.name}`"]
    return F.xxhash64(*[column(f) if _hashable(f.dataType) else F.to_json(F.struct(column(f).alias("x"))) for f in fields])


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with the hint to broadcast it, if its counted rows are small enough; else as it is."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def words_of(text: Column) -> Column:
    """Words of lower-cased text: runs of anything but space and tab to carriage return. Null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
