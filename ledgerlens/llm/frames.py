"""Small helpers on DataFrames shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.words import CHUNK_BYTES, chunks


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that functions in tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    out = f"_{name}"
    while out in taken:
        out = f"_{name}_{uuid.uuid4().hex[:8]}"
    return out


def q(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def by_text(
    make: Callable[[Sequence[str | None]], pd.DataFrame], schema: T.StructType | str, limit: int = CHUNK_BYTES
) -> Callable[[Column], Column]:
    """A struct-valued column function: ``make`` gets chunks of texts of bounded size and returns one row per text."""
    ship(SparkSession.active())

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            parts = [make(texts[a:b]) for a, b in chunks(texts, limit)]
            yield pd.concat(parts, ignore_index=True) if parts else make([])

    return run


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and in whatever lambda ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_totals(values: Column, block: int = 256) -> Column:
    """The running totals of an array of whole numbers, by blocks: n * (block + n / block) steps, not n * n."""
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b)

    def blocks(v: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(v) - 1) / block).cast("int")), lambda b: F.slice(v, b * block + 1, F.lit(block))
        )

    def within(parts: Column, sums: Column) -> Column:
        return F.flatten(F.transform(parts, lambda part, b: let(
            total(F.slice(sums, F.lit(1), b)),
            lambda base: F.transform(part, lambda _, i: base + total(F.slice(part, F.lit(1), i + 1))),
        )))

    return let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<bigint>")).otherwise(
        let(blocks(v), lambda parts: let(F.transform(parts, total), lambda sums: within(parts, sums)))
    ))
