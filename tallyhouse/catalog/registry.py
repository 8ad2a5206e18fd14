"""Name -> plan and name -> SQL, and the one form in which results are published."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.bindings import Roles
from tallyhouse.session import apply_settings

Plan = Callable[[Roles], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


def publish(df: DataFrame) -> DataFrame:
    """Types that two engines print alike: decimals as double, integers as bigint, times as text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType | T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ByteType | T.ShortType | T.IntegerType):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish(QUERIES[name](Roles(apply_settings(spark), sf_dir)))
