"""Ordered string aggregation (the reference builds column and key lists this way)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ordered_list(value: str, order_by: str, sep: str = ", ") -> Column:
    """``listagg(value, sep) WITHIN GROUP (ORDER BY order_by)`` — use on groups of bounded size only."""
    quoted = sep.replace("'", "''")
    return F.expr(f"listagg(CAST({value} AS STRING), '{quoted}') WITHIN GROUP (ORDER BY {order_by})")


def key_list_text(names, sep: str = ", ") -> str:
    """Driver-side: ordered key names → text, e.g. for report headers."""
    return sep.join(names)


def join_clause_text(keys, left: str = "s", right: str = "p") -> str:
    return " and ".join(f"{left}.{k} = {right}.{k}" for k in keys)
