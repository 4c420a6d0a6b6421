"""Reconciliation of a wide source into entity tables.

Each entity is the projection of its attributes, one row per natural key
(first in attribute order), with a dense surrogate id.  This is valid when
the key functionally determines the attributes (check with ``fd_violations``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.windows import deduplicate, with_dense_id
from ..session import materialize


def reconcile_entity(wide: DataFrame, key: Sequence[str], attrs: Sequence[str], id_col: str | None = None) -> DataFrame:
    ent = deduplicate(wide.select(*key, *attrs).distinct(), list(key), list(attrs))  # tasks pass on each entity once
    return with_dense_id(ent, list(key), id_col) if id_col else ent


def reconcile(wide: DataFrame, entities: dict[str, tuple[Sequence[str], Sequence[str]]], fact: str) -> dict[str, DataFrame]:
    """All entity tables of a wide source: name -> (id, key, attributes), and ``fact``: the rows that remain
    when the attributes are gone, one per row of the source, with its own dense id.

    Every column that is no entity attribute stays in the remainder, the natural keys included.  The source is written
    once, and each table reads its columns of it.
    """
    wide = materialize(wide, "reconcile-wide")
    tables = {name: reconcile_entity(wide, key, attrs, f"{name}_id") for name, (key, attrs) in entities.items()}
    moved = {a for _, attrs in entities.values() for a in attrs}
    rest = [c for c in wide.columns if c not in moved]
    return {**tables, fact: with_dense_id(wide.select(*rest), rest, f"{fact}_id")}
