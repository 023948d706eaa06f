"""Scans with role resolution and guards.

Roles are resolved from column names alone, so no data is read to find them. The
guards stop at the first row that satisfies them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from broadsheet.config import RoleNames
from broadsheet.functions.text import strip


class CorpusError(ValueError):
    """The input cannot serve the requested job."""


@dataclass(frozen=True)
class Roles:
    """Names of the columns that play each part; null when there is none."""

    text: str | None
    label: str | None
    url: str | None


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, form: str | None = None, multi_line: bool = False) -> DataFrame:
    """Read CSV (with header), JSON, ORC or Parquet; the form defaults to the suffix.

    ``multi_line`` allows line breaks inside quoted CSV fields; such a file is one task, while
    others are split among tasks.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    form = form or (suffix if suffix in ("csv", "json", "orc", "parquet") else "parquet")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if form == "csv":
        reader = reader.options(header=True, multiLine=multi_line, escape='"')
    return reader.format(form).load(path)


def pick_column(columns, candidates) -> str | None:
    """First candidate present in any case; of equal spellings the later column wins."""
    by_name = {c.lower(): c for c in columns}
    return next((by_name[c] for c in candidates if c in by_name), None)


def resolve_roles(columns, names: RoleNames = RoleNames()) -> Roles:
    return Roles(
        text=pick_column(columns, names.text), label=pick_column(columns, names.label), url=pick_column(columns, names.url)
    )


def with_roles(df: DataFrame, order: str, require_text: bool = False, names: RoleNames = RoleNames()) -> DataFrame:
    """Project to ``(ord, raw_text, raw_label, url)``, null where a role is missing."""
    roles = resolve_roles([c for c in df.columns if c != order], names)
    if require_text and roles.text is None:
        raise CorpusError(f"no text column among {df.columns}; expected one of {names.text}")

    def role(name: str | None) -> F.Column:
        # backticks keep names with dots whole
        return F.lit(None).cast("string") if name is None else F.col(f"`{name}`").cast("string")

    # a null URL gives way to the column of exactly this name
    second = role("url" if "url" in df.columns else None)
    return df.select(
        F.col(order).alias("ord"),
        role(roles.text).alias("raw_text"),
        role(roles.label).alias("raw_label"),
        F.coalesce(strip(F.coalesce(role(roles.url), second)), F.lit("")).alias("url"),
    )


def scan_urls(df: DataFrame) -> DataFrame:
    """Usable URLs of a list: trimmed, blank and null ones dropped."""
    require_columns(df, ("url",))
    return df.select(strip(F.col("url")).alias("url")).filter(F.col("url") != "")


def require_columns(df: DataFrame, columns) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise CorpusError(f"missing columns {missing}; found {df.columns}")
    return df


def experiment_input(df: DataFrame, order: str) -> DataFrame:
    """Projection ``(ord, url, headline, label)`` of a clean corpus, label as INT."""
    require_columns(df, ("url", "headline", "label"))
    return df.select(F.col(order).alias("ord"), "url", "headline", F.col("label").cast("int").alias("label"))


def require_rows(df: DataFrame, message: str = "no usable rows") -> DataFrame:
    """Raise when there is no row; looks for one row only."""
    if df.isEmpty():
        raise CorpusError(message)
    return df


def require_text(df: DataFrame, allow_url_text: bool = False, names: RoleNames = RoleNames()) -> DataFrame:
    """Raise unless a text column exists and has a non-blank value somewhere."""
    if allow_url_text:
        return df
    name = resolve_roles(df.columns, names).text
    if name is None:
        raise CorpusError(f"no text column among {df.columns}; expected one of {names.text}")
    require_rows(df.filter(non_blank(F.col(f"`{name}`"))).select(F.lit(1)), f"text column {name!r} is empty")
    return df


def non_blank(column) -> F.Column:
    return column.isNotNull() & (strip(column.cast("string")) != "")
