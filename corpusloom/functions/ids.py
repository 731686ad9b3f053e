"""Content-addressed identifiers, hash buckets and seals, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import written

NUL = "\u0000"


def stable_id(prefix: str, *parts: Column, length: int = 20, separator: str = NUL) -> Column:
    """prefix_ and the first hex digits of the SHA-256 of the parts. A null part is
    empty, so ids of (a, null) and (a,) differ."""
    text = F.concat_ws(separator, *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(text, 256), 1, length))


def hash_bucket(c: Column, n: int = 100) -> Column:
    """0..n-1 from the first 32 bits of the SHA-256."""
    return F.conv(F.substring(F.sha2(c.cast("string"), 256), 1, 8), 16, 10).cast("bigint") % n


def bucket_split(c: Column, train: int = 70, val: int = 85) -> Column:
    b = hash_bucket(c)
    return F.when(b < train, "train").when(b < val, "val").otherwise("test")


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys; nulls stay. Values: strings, integers, booleans."""
    parts = []
    for name in sorted(fields):
        c = fields[name]
        parts += [F.lit(f'{"," if parts else ""}"{name}":'), F.coalesce(F.element_at(F.regexp_extract_all(F.to_json(F.array(c)), F.lit(r"(?s)^\[(.*)\]$"), F.lit(1)), 1), F.lit("null"))]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def seal(**fields: Column) -> Column:
    """SHA-256 of the protected fields' canonical JSON."""
    return F.sha2(canonical_json(**fields), 256)


def ordinals(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """df with 1, 2, ... in a total order. Rows are sorted in ranges and numbered there; a
    range's offset comes from the counts before it, so no task sees all rows."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("__m", F.monotonically_increasing_id()), "ordinals")
    part, row = F.shiftright("__m", 33), F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))  # a row a range
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__p", before.alias("__o"))
    return placed.withColumn("__p", part).join(F.broadcast(offsets), "__p").withColumn(name, F.col("__o") + row + 1).drop("__p", "__o", "__m")
