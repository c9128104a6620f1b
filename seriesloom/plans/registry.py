"""Registered queries: a Spark plan, its SQL twin where one exists, and the rounding both share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, object] = {}
ORACLES: dict[str, str] = {}


def _whole(df: DataFrame, digits: int) -> DataFrame:
    """Doubles rounded (and -0.0 made 0.0), small integers widened, so both engines print alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            r = F.round(c, digits)
            c = F.when(r == 0, F.lit(0.0)).otherwise(r)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws(",", c.cast("array<string>"))
        out.append(c.alias(f.name))
    return df.select(*out)


def prepare_session(spark) -> None:
    """Planner setting for wide plans: inferring constraints doubles per aliased column, so a plan
    with some fifty derived columns would spend minutes in the optimizer and gain nothing."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")


def query(name: str, sql: str | None = None, doubles: str = "", digits: int = 6):
    """Register fn(spark, sf_dir). `doubles` names the SQL columns to round."""
    def add(fn):
        def run(spark, sf_dir):
            prepare_session(spark)
            return _whole(fn(spark, sf_dir), digits)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _rounded(sql, doubles.split(), digits)
        return fn

    return add


def _rounded(sql: str, columns, digits: int) -> str:
    if not columns:
        return sql
    replaced = ", ".join(
        f"CASE WHEN round({c}::DOUBLE, {digits}) = 0 THEN 0.0::DOUBLE ELSE round({c}::DOUBLE, {digits}) END AS {c}" for c in columns
    )
    return f"SELECT * REPLACE ({replaced}) FROM ({sql})"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()
