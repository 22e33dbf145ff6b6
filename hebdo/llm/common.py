"""What the operators share: tables, text columns, scratch tables, word classes."""

from __future__ import annotations

import os
import tempfile
import zipfile

import hebdo
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hebdo.session import forget_on_exit, scratch_path, unique_suffix

# the six white-space characters that separate words; every other character is part of a word
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def squeezed(c: Column) -> Column:
    """``c`` without its white space."""
    return F.translate(c, SPACES, "")


def once(**cols: Column) -> Column:
    """The named columns as one-row generator output. A later projection refers to them as
    plain columns, so an expensive expression is not copied into every place that uses it
    (a lambda body would otherwise run it again for each array element)."""
    return F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()])))


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: the lineage ends there,
    so work is not repeated and a lost executor costs only the tasks that follow. The folder
    is removed when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{unique_suffix()}")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    forget_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per application), as
    ``--py-files`` would: needed where the workers do not share the driver's Python path."""
    sc = spark.sparkContext
    if getattr(sc, "hebdo_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(hebdo.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="hebdo-"), "hebdo.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc.hebdo_shipped = True

