"""Small typed frames from configuration rows, and result presentation."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A configuration table is broadcast only below this many rows.
CONFIG_ROW_BOUND = 100_000

_ARROW = {
    "string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(),
    "date": pa.date32(), "money": pa.decimal128(18, 2), "rate": pa.decimal128(9, 4),
}


def config_frame(spark: SparkSession, rows: list[tuple], schema: list[tuple[str, str]]) -> DataFrame:
    """Rows of configuration as a broadcast frame of declared types. The row
    bound is checked here, so no caller can broadcast data that grew."""
    if len(rows) > CONFIG_ROW_BOUND:
        raise ValueError(f"{len(rows)} configuration rows exceed {CONFIG_ROW_BOUND}")
    fields = [pa.field(name, _ARROW[kind]) for name, kind in schema]
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)]
    table = pa.Table.from_arrays(columns, schema=pa.schema(fields))
    return F.broadcast(spark.createDataFrame(table))


def present(df: DataFrame) -> DataFrame:
    """Result columns in plain types: decimals as double, instants without zone."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(field.name))
    return df.select(*out)
