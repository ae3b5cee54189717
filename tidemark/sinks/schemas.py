"""The schema of a table by path, kept beside it and merged on each write.

One file's footer says nothing of columns that only later files have.  The log says
it of all, so a batch is checked against every column the table ever had, and readers
need no footers.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks import records

SIMPLE = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/_schema"


def logged_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept beside a table by path; None if none is."""
    _, record = records.latest(spark, _folder(path))
    return T.StructType.fromJson(record) if record else None


def schema_of(spark: SparkSession, path: str) -> T.StructType | None:
    """The logged schema, else that of all files together; None without files."""
    known = logged_schema(spark, path)
    if known is not None:
        return known
    if not records.exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def merged(known: T.StructType | None, batch: T.StructType, partition_by: tuple[str, ...]) -> T.StructType:
    """`known` and the columns it lacks; partition columns last, as text, all columns nullable."""
    fields = {f.name: f for f in (known or [])}
    fields |= {f.name: f for f in batch if f.name not in fields}
    plain = [T.StructField(f.name, f.dataType, True) for f in fields.values() if f.name not in partition_by]
    return T.StructType([*plain, *(T.StructField(c, T.StringType(), True) for c in partition_by)])


def keep(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Log `schema` unless it is the latest; a writer that came in between is merged with."""
    while True:
        number, record = records.latest(spark, _folder(path))
        if record == schema.jsonValue() or records.put(spark, _folder(path), number + 1, schema.jsonValue()):
            return
        _, other = records.latest(spark, _folder(path))
        there = T.StructType.fromJson(other)
        check_same(there, schema)
        mine = {f.name for f in schema}
        schema = T.StructType([*(f for f in there if f.name not in mine), *schema])


def check_same(known: T.StructType, batch: T.StructType) -> None:
    """A column that both have must have one type."""
    kinds = {f.name: f.dataType for f in known}
    for f in batch:
        if kinds.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"{f.name} was {kinds[f.name].simpleString()} to one writer and {f.dataType.simpleString()} to another")


def _misfit(column: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.NumericType) and isinstance(have, T.NumericType):
        return column.isNotNull() & ~column.try_cast(want).try_cast(have).eqNullSafe(column)
    if isinstance(want, (T.DecimalType, T.IntegralType)) and isinstance(have, T.StringType):
        # Digits beyond the scale would be rounded away.
        wide = column.try_cast(T.DecimalType(38, 18))
        return column.isNotNull() & (wide.isNull() | ~column.try_cast(want).try_cast(T.DecimalType(38, 18)).eqNullSafe(wide))
    return column.isNotNull() & column.try_cast(want).isNull()


def fitted(df: DataFrame, known: T.StructType | None, partition_by: tuple[str, ...]) -> DataFrame:
    """`df` with the types that `known` has for its columns.

    Where a type differs the batch is looked through first, in one aggregate, and a
    value that does not fit is an error that names it; nothing is written then.
    """
    kinds = {f.name: f.dataType for f in (known or [])}
    changed, misfits = {}, {}
    for f in df.schema:
        want = kinds.get(f.name)
        if f.name in partition_by or want is None or want == f.dataType:
            continue
        if not (isinstance(want, SIMPLE) and isinstance(f.dataType, SIMPLE)):
            if f.dataType.simpleString() != want.simpleString():
                raise ValueError(f"{f.name}: {f.dataType.simpleString()} does not fit {want.simpleString()}")
            continue
        column = F.col(f"`{f.name.replace('`', '``')}`")
        changed[f.name] = column.try_cast(want)
        misfits[f.name] = F.min(F.when(_misfit(column, f.dataType, want), column.cast("string")))
    if not changed:
        return df
    found = df.agg(*(m.alias(str(i)) for i, m in enumerate(misfits.values()))).first()
    for i, name in enumerate(misfits):
        if found[i] is not None:
            raise ValueError(f"{name}: {found[i]} does not fit {kinds[name].simpleString()}")
    return df.withColumns(changed)
