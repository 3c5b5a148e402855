"""Raw sheets from files, with declared schemas: no inference pass over the data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from altimart.sources.schemas import SHEETS, schema

_TEXT_OPTIONS = {"csv": {"header": "true", "encoding": "UTF-8", "enforceSchema": "false"}}


def read_sheet(
    spark: SparkSession, sheet: str, path: str | list[str], fmt: str = "parquet"
) -> DataFrame:
    """One raw sheet.  CSV and JSON cells are read as text; staging does the casts."""
    if sheet not in SHEETS:
        raise ValueError(f"unknown sheet {sheet!r}; known: {', '.join(SHEETS)}")
    if fmt in ("csv", "json"):
        reader = spark.read.options(**_TEXT_OPTIONS.get(fmt, {}))
        return reader.schema(schema(sheet, as_text=True)).format(fmt).load(path)
    df = spark.read.format(fmt).load(path)
    absent = [name for name in schema(sheet).names if name not in df.columns]
    if absent:
        raise ValueError(f"sheet {sheet!r} lacks columns {absent}")
    return df.select(*schema(sheet).names)


def read_sheets(
    spark: SparkSession, folder: str, fmt: str = "parquet", only: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """All sheets below a folder, one sub-folder or file ``<sheet>.<fmt>`` each."""
    return {s: read_sheet(spark, s, f"{folder}/{s}.{fmt}", fmt) for s in (only or SHEETS)}


def register_views(models: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Publish DataFrames as temporary views, so that they can be queried by name in SQL."""
    for name, df in models.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def read_triples(spark: SparkSession, *paths: str) -> DataFrame:
    """A graph from several triple files: their set union."""
    from altimart.operators.triples import union_graphs

    return union_graphs(*[spark.read.parquet(p) for p in paths])


def _unescaped(text: Column) -> Column:
    """Escapes undone in one pass: what follows an escaped backslash is not an escape."""

    def plain(part: Column) -> Column:
        for escaped, char in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"')):
            part = F.replace(part, F.lit(escaped), F.lit(char))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """Triples from N-Triples lines; blank lines and comments are skipped.

    Nodes are IRIs; texts may have a datatype or a language.  Other lines, such as ones with blank
    nodes or numeric escapes, are an error.
    """
    line = F.trim("value")
    parts = r'^<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\[nrt"\\])*)"(?:\^\^<([^>]*)>|(@[A-Za-z0-9-]+))?)\s*\.$'

    def part(i: int) -> Column:
        return F.regexp_extract(line, parts, i)

    bad = F.raise_error(F.concat(F.lit("not a readable triple: "), line)).cast("string")
    subject = F.when(F.rlike(line, F.lit(parts)), part(1)).otherwise(bad)
    kind = F.nullif(F.concat(part(5), part(6)), F.lit(""))
    return (
        spark.read.text(path)
        .where((line != "") & ~F.startswith(line, F.lit("#")))
        .select(
            subject.alias("s"),
            part(2).alias("p"),
            F.when(part(3) != "", part(3)).otherwise(_unescaped(part(4))).alias("o"),
            kind.alias("dtype"),
            (part(3) != "").alias("is_iri"),
        )
    )
