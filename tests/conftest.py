import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Small frame from rows of literals: frame("a int, b string", (1, "x"), ...)."""

    def literal(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, str):
            return "'" + v.replace("'", "\\'") + "'"
        if isinstance(v, (list, tuple)):
            return "array(" + ", ".join(literal(x) for x in v) + ")"
        return repr(v)

    def build(schema, *rows):
        fields = [f.strip().split(" ", 1) for f in schema.split(", ")]
        names = ", ".join(f"`{n}`" for n, _ in fields)
        casts = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in fields)
        values = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in rows)
        return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")

    return build


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
