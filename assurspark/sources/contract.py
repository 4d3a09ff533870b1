"""Input contract: what the reports expect of each logical table (``schemas``).

``check`` compares a loaded table's columns with the declared ones: every one must be
present (names compared case-insensitively) with a type Spark can use in its
place; extra columns are allowed and ignored.  ``key_violations`` reads a table:
one job counts the rows per declared key (a partial aggregate, so a value on many
rows is reduced before the shuffle) and the rows of each code that is looked up
as one value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


class ContractError(ValueError):
    pass


def schema_of(name: str) -> T.StructType | None:
    """Declared schema of one logical table (None for a name outside the contract)."""
    columns = schemas.COLUMNS.get(name)
    return None if columns is None else T.StructType.fromDDL(columns)


def _compatible(expected: T.DataType, actual: T.DataType) -> bool:
    """Types the reports can use in place of the contract's."""
    if type(expected) is type(actual):
        return True
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(expected, integral) and isinstance(actual, integral):
        return True
    if isinstance(expected, (T.TimestampNTZType, T.TimestampType)):
        return isinstance(actual, (T.TimestampNTZType, T.TimestampType, T.DateType))
    if isinstance(expected, T.DecimalType):
        return isinstance(actual, (T.DecimalType, T.DoubleType) + integral)
    return False


def check(name: str, df: DataFrame, expected: T.StructType) -> DataFrame:
    """Raise ``ContractError`` naming every missing or incompatible column."""
    have = {f.name.lower(): f for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        got = have.get(f.name.lower())
        if got is None:
            problems.append(f"missing {f.name} ({f.dataType.simpleString()})")
        elif not _compatible(f.dataType, got.dataType):
            problems.append(f"{f.name}: expected {f.dataType.simpleString()}, got {got.dataType.simpleString()}")
    if problems:
        raise ContractError(f"table {name}: " + "; ".join(problems))
    return df


def key_violations(name: str, df: DataFrame) -> list[str]:
    """What ``df`` breaks of the keys and single rows declared for ``name``, in words."""
    found = []
    keys = schemas.UNIQUE_KEYS.get(name)
    if keys:
        among = [schemas.UNIQUE_AMONG[name]] if name in schemas.UNIQUE_AMONG else []
        rows = df.where(" AND ".join([f"{k} IS NOT NULL" for k in keys] + among)).groupBy(*keys).agg(F.count("*").alias("_n"))
        example = F.max(F.struct("_n", *keys)).alias("worst")
        got = rows.where("_n > 1").agg(F.count("*").alias("keys"), example).first()
        if got["keys"]:
            shown = ", ".join(f"{k} = {got['worst'][k]}" for k in keys)
            found.append(f"table {name}: {got['keys']} values of ({', '.join(keys)}) on several rows, "
                         f"{shown} on {got['worst']['_n']}")
    single = schemas.SINGLE_ROWS.get(name)
    if single:
        n = df.where(single).count()
        if n > 1:
            found.append(f"table {name}: {n} rows where {single}, at most one is expected")
    return found
