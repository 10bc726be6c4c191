"""Shape shared by the payload adapters.

An adapter adds three columns to a payload table and keeps the rest:

* ``rows``       array of accepted records, in payload order,
* ``malformed``  the payload is no document of its format (it yields no rows),
* ``error``      why the payload as a whole has to be refused, else null.

Everything an adapter does happens inside one payload row: no shuffle, no
per-payload grouping, and the position in ``rows`` is the sequence number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tapeworks.schema import SCHEMA_VERSION, SCHEMAS


def typed_select(df: DataFrame, table: str, values: dict[str, Column],
                 *extra: str) -> DataFrame:
    """Project ``values`` to the full schema of ``table``; the rest is null."""
    known = {f.name for f in SCHEMAS[table].fields}
    unknown = set(values) - known
    if unknown:
        raise ValueError(f"not columns of {table}: {sorted(unknown)}")
    columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
               for f in SCHEMAS[table].fields]
    return df.select(*columns, *extra)


def in_steps(array: Column, *steps: Callable[[Column], Column]) -> Column:
    """Apply ``steps`` to every element, one after the other.

    Inside a lambda each use of an expression is a computation of its own, so
    whatever is used more than once gets a step of its own.
    """
    for step in steps:
        array = F.transform(array, step)
    return array


def stamp(ingest_ts: Column | None) -> Column:
    return F.current_timestamp() if ingest_ts is None else ingest_ts


def explode_rows(parsed: DataFrame) -> DataFrame:
    """One row per accepted record: payload columns, ``seq`` from 1, ``r``.

    A refused payload has no rows.  The outer form with a filter behind it gives
    the same rows as the plain one, for which Spark would also test the array's
    size below the projection, and so parse each payload twice.
    """
    keep = [c for c in parsed.columns if c not in ("rows", "malformed", "error", "content")]
    return (parsed.select(*keep, F.posexplode_outer("rows").alias("pos", "r"))
            .where(F.col("pos").isNotNull())
            .withColumn("seq", (F.col("pos") + 1).cast("long")).drop("pos"))


def schema_version() -> Column:
    return F.lit(SCHEMA_VERSION)


def string_struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
