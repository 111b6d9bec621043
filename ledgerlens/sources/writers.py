"""Exports of results. Each is a distributed write: a folder of part files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat(df: DataFrame) -> DataFrame:
    """Arrays and structs as JSON text, which CSV can hold."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.withColumns({
        f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, nested)
    })


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export_results(folder: str, metrics: DataFrame, tables: Mapping[str, DataFrame]) -> list[str]:
    """``metrics.json`` and one CSV folder per table."""
    write_json(metrics, f"{folder}/metrics.json")
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}.csv")
    return ["metrics.json", *[f"{name}.csv" for name in tables]]
