"""Every query on the bundled test tables and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.catalog import landing, mart, measures, silver, watch
from lakemart.standins import look_again

MODULES = (silver, landing, mart, measures, watch)


def _plain(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Decimals leave a query as doubles, the type the SQL side casts to."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        look_again(spark, sf_dir)
        df = query(spark, sf_dir)
        decimals = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
        if not decimals:
            return df
        return df.select(*[F.col(c).cast("double").alias(c) if c in decimals else F.col(c) for c in df.columns])

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _plain(query) for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
