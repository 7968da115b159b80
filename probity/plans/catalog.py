"""Query catalog: name -> (Spark builder, DuckDB oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables.  ``sql`` is an independent formulation of the same
result for DuckDB (omitted only where SQL cannot express the operator).
Double-valued output columns are rounded to 6 places on both sides so value
hashes compare numbers, not the last bits of a floating-point sum order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probity.plans.adapters_sql import with_adapters
from probity.sources.tables import Tables


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles: tuple[str, ...] = ()):
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(Tables(spark, sf_dir)))
        REGISTRY[name] = Query(name, build, with_adapters(sql) if sql else None, tuple(doubles))
        return fn
    return deco


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), places).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def exact_sql(sql: str) -> str:
    """Write ``avg(x)`` and the AI-score sum as decimal sums, like ``functions.exact``."""
    def outer(s, name, make):
        at = 0
        while (m := re.search(rf"\b{name}\(", s[at:])):
            a, k, depth = at + m.start(), at + m.end(), 1
            while depth:
                depth += {"(": 1, ")": -1}.get(s[k], 0)
                k += 1
            new = make(s[at + m.end():k - 1])
            s, at = s[:a] + new + s[k:], a + len(new)
        return s

    exact = "CAST(sum(CAST({0} AS DECIMAL(28,10))) AS DOUBLE)"
    sql = sql.replace("sum(ai_usage_score)", exact.format("ai_usage_score"))
    return outer(sql, "avg", lambda x: f"({exact.format(x)} / count({x}))")


def oracle(q: Query) -> str | None:
    if q.sql is None:
        return None
    if not q.doubles:
        return exact_sql(q.sql)
    # Round like Spark's round(): half-up on the shortest decimal form of the
    # double (DuckDB's round() multiplies first and can tip near-ties).
    rep = ", ".join(
        f"CASE WHEN isfinite({c}) THEN CAST(CAST(CAST({c} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 6))"
        f"::DOUBLE ELSE {c} END AS {c}" for c in q.doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({exact_sql(q.sql)}) AS oracle_q"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {n: q.build for n, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    out = {}
    for n, q in REGISTRY.items():
        s = oracle(q)
        if s is not None:
            out[n] = s
    return out


def _load_all():
    # Importing the query modules fills REGISTRY.
    from probity.plans import (q_archive, q_basic, q_collusion, q_dashboards,  # noqa: F401
                               q_kpis, q_quality, q_rollups, q_stream, q_text)
