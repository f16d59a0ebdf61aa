"""Identifiers: unit names, zones from names, composite ids, headings."""

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from thermolane.sources.staging import stage

# Dash characters written as "-", and blanks removed, in unit names.
DASHES = "–—−ー"
BLANKS = " 　"


def nfkc(x: Column) -> Column:
    """Compatibility normal form; Spark has no built-in for it."""

    def normal_form(names: pd.Series) -> pd.Series:
        from unicodedata import normalize

        return names.map(lambda s: normalize("NFKC", s), na_action="ignore")

    return pandas_udf(normal_form, StringType())(x)


def plain_dashes(x: Column) -> Column:
    """Remove blanks and unify dashes."""
    return F.translate(x, DASHES + BLANKS, "-" * len(DASHES))


def normalize_unit_names(df: DataFrame, column: str = "unit") -> DataFrame:
    """Replace `column` by its normal form.

    Only names with a character outside ASCII can change under NFKC, so Python sees the
    distinct names of that kind and every other row stays in the JVM. The table of names is
    stored: its true size tells Catalyst whether to broadcast it, so rows are not shuffled
    by name while it is small.
    """
    ascii_only = F.col(column).rlike(r"^[\x00-\x7F]*$")
    raw = f"__raw_{column}"
    special = (
        df.where(~ascii_only)
        .select(F.col(column).alias(raw))
        .distinct()
        .withColumn("__nfkc", nfkc(F.col(raw)))
    )
    special = stage(special, "unit-names")
    joined = df.join(special, F.col(column) == F.col(raw), "left")
    return joined.withColumn(
        column, plain_dashes(F.coalesce(F.col("__nfkc"), F.col(column)))
    ).drop(raw, "__nfkc")


def zone_from_name(name: Column) -> Column:
    """First run of Latin words in a unit name, else "Unknown"."""
    words = F.regexp_extract(name, r"([A-Za-z]+(?:\s+[A-Za-z]+)*)", 1)
    return F.when(name.isNull() | (words == ""), "Unknown").otherwise(words)


def outdoor_id(mesh: Column, addr: Column) -> Column:
    return F.concat_ws("-", mesh.cast("string"), addr.cast("string"))


def clean_outdoor_unit(x: Column) -> Column:
    """Drop trailing commas, then blanks."""
    return F.trim(F.regexp_replace(x.cast("string"), ",+$", ""))


def warehouse_name(heading: str) -> str:
    """Raw heading -> warehouse column: "A/C ON/OFF" -> "AC_ON_OFF", "Mesh ID" -> "Mesh_ID"."""
    return re.sub(r"[^0-9A-Za-z]+", "_", heading.replace("A/C", "AC")).strip("_")


def strip_bom(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace("﻿", "") for c in df.columns])
