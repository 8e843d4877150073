"""Folding field names and fitting rows to a declared schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def rename_fields(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Fold every alias into its field, the field's own name first.

    Columns that are no alias of anything pass through.
    """
    have = set(df.columns)
    consumed = {a for others in aliases.values() for a in others}
    out = [f"`{c}`" for c in df.columns if c not in consumed and c not in aliases]
    for name, others in aliases.items():
        present = [f"`{c}`" for c in (name, *others) if c in have]
        if present:
            out.append(f"coalesce({', '.join(present)}) AS `{name}`")
    return df.selectExpr(*out)


def conform(df: DataFrame, schema: T.StructType | Sequence[str]) -> DataFrame:
    """Exactly these columns in this order: missing ones typed NULL, others dropped.

    A list of names stands for text columns (the shape of wire data).
    """
    if not isinstance(schema, T.StructType):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in schema])
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()})"
            f" AS `{f.name}`"
            for f in schema
        ]
    )


def require_columns(df: DataFrame, columns: Sequence[str], context: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{context}: missing columns {missing}")
