"""Schemas of maps over rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import StructType


def plus(schema: StructType, ddl: str) -> StructType:
    """The fields of a schema, then those of a DDL string."""
    return StructType(schema.fields + StructType.fromDDL(ddl).fields)


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to clash with no column."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
