"""Number columns as texts while rows are in pandas, which would turn nullable whole numbers to floats and NaN to null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_KINDS = (*_WHOLE, T.FloatType, T.DoubleType, T.BooleanType)


def as_texts(df: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, T.DataType]]:
    """The rows with number and truth columns as texts, but for those to ``keep``; and the columns' own types."""
    own = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, _KINDS) and f.name not in keep}
    return df.withColumns({c: F.col(c).cast("string") for c in own}) if own else df, own


def from_texts(df: DataFrame, own: dict[str, T.DataType]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in own.items()}) if own else df


def number(text: object, kind: T.DataType | None) -> object:
    """The value of a text by its column's type; NaN as a text, so that it equals itself."""
    if kind is None or text is None:
        return text
    return int(text) if isinstance(kind, _WHOLE) else text if text in ("NaN", "true", "false") else float(text)
