"""Which columns are replicated, and as which type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the type mapping.
MAX_PRECISION = 32
MAX_SCALE = 30
EXCLUDED_COLUMN = "pkid"


def target_type(source: T.DataType, strict: bool = False, datetime_as_date: bool = False) -> T.DataType | None:
    """The replicated type of a source type, or ``None`` for a type that is left out.

    ``strict`` keeps the closed list of eight types; otherwise floating types pass
    through and small integers widen like ``int``.
    """
    match source:
        case T.IntegerType() | T.LongType():
            return T.LongType()
        case T.StringType() | T.VarcharType():
            return T.StringType()
        case T.BooleanType() | T.BinaryType() | T.DateType():
            return source
        case T.DecimalType():
            return T.DecimalType(min(source.precision, MAX_PRECISION), min(source.scale, MAX_SCALE))
        case T.TimestampType() | T.TimestampNTZType():
            return T.DateType() if datetime_as_date else T.TimestampNTZType()
        case T.ByteType() | T.ShortType() if not strict:
            return T.LongType()
        case T.FloatType() | T.DoubleType() if not strict:
            return source
    return None


@dataclass(frozen=True)
class TypePlan:
    """Target fields in source order and spelling, and the names that were left out."""

    schema: T.StructType
    dropped: tuple[str, ...]

    def apply(self, df: DataFrame) -> DataFrame:
        """Project ``df``.  Decimals round half away from zero; one that no longer fits raises."""
        return df.select(*[_converted(df, f).alias(f.name) for f in self.schema.fields])


def plan_types(schema: T.StructType, strict: bool = False, datetime_as_date: bool = False) -> TypePlan:
    kept, dropped = [], []
    for field in schema.fields:
        mapped = target_type(field.dataType, strict, datetime_as_date)
        if mapped is None or field.name.strip().lower() == EXCLUDED_COLUMN:
            dropped.append(field.name)
        else:
            kept.append(T.StructField(field.name, mapped, True))
    return TypePlan(T.StructType(kept), tuple(dropped))


def typed_projection(df: DataFrame, strict: bool = False, datetime_as_date: bool = False) -> DataFrame:
    return plan_types(df.schema, strict, datetime_as_date).apply(df)


def _converted(df: DataFrame, field: T.StructField) -> Column:
    value = F.col(_quoted(field.name))
    if isinstance(field.dataType, T.DecimalType) and df.schema[field.name].dataType != field.dataType:
        # The same with and without ANSI mode: an overflow is never a NULL.
        too_large = F.raise_error(F.concat(F.lit(f"{field.name} does not fit {field.dataType.simpleString()}: "), value))
        return F.coalesce(value.try_cast(field.dataType), F.when(value.isNotNull(), too_large).cast(field.dataType))
    return value.cast(field.dataType)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
