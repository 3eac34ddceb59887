"""Registration of a query with its output columns and its SQL twin.

`cols` lists the output as `name:kind`, kind `s` text, `i` whole number, `d` double. Both sides are
cast to these kinds, since engines print dates, decimals and booleans differently: dates and
timestamps as ISO text, decimals as double, flags as 0/1.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.registry.ctes import CTES
from tidemark.session import settings
from tidemark.sources.adapter import Bronze

SPARK_KIND = {"s": "string", "i": "bigint", "d": "double"}
SQL_KIND = {"s": "VARCHAR", "i": "BIGINT", "d": "DOUBLE"}


#: Time zone that casts are bound to, and the split of hot keys in jobs that run while planning.
PLANNING = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Bronze], DataFrame]
    cols: tuple[tuple[str, str], ...]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """Plans the query under `PLANNING`; the caller's settings are put back."""
        with settings(spark, PLANNING):
            df = self.build(Bronze(spark, sf_dir))
            return df.select(*[F.col(f"`{c}`").cast(SPARK_KIND[k]).alias(c) for c, k in self.cols])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = ", ".join(f'CAST("{c}" AS {SQL_KIND[k]}) AS "{c}"' for c, k in self.cols)
        return f"{with_ctes(self.sql)}\nSELECT {casts} FROM answer"


REGISTRY: dict[str, Query] = {}


def query(cols: str, sql: str | None = None, key: str | None = None):
    """Registers the decorated builder under its own name (or `key`)."""
    parsed = tuple(tuple(c.split(":")) for c in cols.split())

    def register(build: Callable[[Bronze], DataFrame]):
        name = key or build.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Query(name, build, parsed, sql)
        return build

    return register


def needed_ctes(sql: str) -> list[str]:
    """Shared subqueries that `sql` names, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", text)):
            if word in CTES and word not in order:
                visit(CTES[word])
                if word not in order:
                    order.append(word)

    visit(sql)
    return order


def with_ctes(sql: str) -> str:
    parts = [f"{name} AS (\n{CTES[name]}\n)" for name in needed_ctes(sql)] + [f"answer AS (\n{sql}\n)"]
    return "WITH " + ",\n".join(parts)


def runners() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: q.run for key, q in REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {key: q.oracle() for key, q in REGISTRY.items() if q.sql is not None}
