"""One registered query: a Spark callable, its output columns and its SQL twin.

Both sides are brought to the same column types: text, bigint and rounded double.
Rounding adds a small fixed offset first, so that values which end in exactly half
a unit of the last digit round the same way in both engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .base_sql import CHAIN

OFFSET = 0.0137


@dataclass(frozen=True)
class Query:
    columns: str                                   # "name:kind, name:kind"
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None                         # body over the shared tables

    def fields(self) -> list[tuple[str, str]]:
        pairs = (part.strip().rsplit(":", 1) for part in self.columns.split(","))
        return [(name.strip(), kind.strip()) for name, kind in pairs]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.run(spark, sf_dir)
        return df.select(*[_spark_column(n, k) for n, k in self.fields()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        columns = ",\n  ".join(_sql_column(n, k) for n, k in self.fields())
        recursive = "RECURSIVE " if "RECURSIVE" in self.sql else ""
        body = self.sql.replace("RECURSIVE", "").strip()
        extra = ""
        if body.upper().startswith("WITH"):
            head, body = body[4:].split("\nRESULT\n")
            extra = ",\n" + head.strip()
        return f"WITH {recursive}{CHAIN}{extra}\nSELECT\n  {columns}\nFROM (\n{body.strip()}\n) AS result"


def _spark_column(name: str, kind: str):
    col = F.col(f"`{name}`")
    if kind == "s":
        out = col.cast("string")
    elif kind == "i":
        out = col.cast("bigint")
    elif kind == "d":
        out = F.date_format(col, "yyyy-MM-dd")
    elif kind == "t":
        out = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    else:
        digits = int(kind)
        out = F.round(col.cast("double") + OFFSET * 10.0 ** -digits, digits)
    return out.alias(name)


def _sql_column(name: str, kind: str) -> str:
    col = f'"{name}"'
    if kind == "s":
        out = f"CAST({col} AS VARCHAR)"
    elif kind == "i":
        out = f"CAST({col} AS BIGINT)"
    elif kind == "d":
        out = f"strftime({col}, '%Y-%m-%d')"
    elif kind == "t":
        out = f"strftime({col}, '%Y-%m-%d %H:%M:%S')"
    else:
        digits = int(kind)
        shift = OFFSET * 10.0 ** -digits
        out = f"round(CAST({col} AS DOUBLE) + CAST({shift!r} AS DOUBLE), {digits})"
    return f"{out} AS {col}"
