"""Dimension tables: literal lookups, hashed random fleets, Parquet read / write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from gearwatch.functions.hashing import uniform_int
from gearwatch.session import children, write_text
from gearwatch.schemas import CAR_COLORS, CAR_MODELS

SMOKE = StructType([StructField("brand", StringType(), True), StructField("model", StringType(), True)])

# Fixed values that must equal the reference: the car model and colour lookups.
CAR_MODEL_ROWS: tuple[tuple[int, str, str], ...] = (
    (1, "Mazda", "3"),
    (2, "Mazda", "6"),
    (3, "Toyota", "Corolla"),
    (4, "Hyundai", "i20"),
    (5, "Kia", "Sportage"),
    (6, "Kia", "Rio"),
    (7, "Kia", "Picanto"),
)
CAR_COLOR_ROWS: tuple[tuple[int, str], ...] = (
    (1, "Black"),
    (2, "Red"),
    (3, "Gray"),
    (4, "White"),
    (5, "Green"),
    (6, "Blue"),
    (7, "Pink"),
)
# Fixed values that must equal the reference: the storage smoke-check table.
SMOKE_ROWS: tuple[tuple[str, str], ...] = (("Mazda", "3"), ("Toyota", "Corolla"), ("Kia", "Sportage"))

# Fixed values that must equal the reference: ranges of a randomly drawn car.
CAR_ID_RANGE = (1000000, 9999999)
DRIVER_ID_RANGE = (100000000, 999999999)
MODEL_ID_RANGE = (1, 7)
COLOR_ID_RANGE = (1, 7)


def literal_table(spark: SparkSession, rows, schema: StructType) -> DataFrame:
    """A small literal table held in the JVM plan (an SQL ``VALUES`` local relation).

    Unlike ``createDataFrame`` on a Python list, no Python worker is started
    when a job reads it, the planner knows its size, and broadcasting it needs
    no job at all.  Values are bound as parameters, never spliced into SQL.
    """
    rows = [tuple(r) for r in rows]
    width = len(schema.fields)
    if not rows or any(len(r) != width for r in rows):
        raise ValueError("rows must be non-empty and match the schema width")
    types = [f.dataType.simpleString() for f in schema.fields]
    marks = ", ".join(
        "(" + ", ".join(f"CAST(:v{i}_{j} AS {types[j]})" for j in range(width)) + ")"
        for i in range(len(rows)))
    args = {f"v{i}_{j}": v for i, r in enumerate(rows) for j, v in enumerate(r)}
    names = ", ".join(f"`{f.name}`" for f in schema.fields)
    return spark.sql(f"SELECT * FROM VALUES {marks} AS t({names})", args=args)


def car_models(spark: SparkSession) -> DataFrame:
    """The 7-row model lookup (``model_id, car_brand, car_model``)."""
    return literal_table(spark, CAR_MODEL_ROWS, CAR_MODELS)


def car_colors(spark: SparkSession) -> DataFrame:
    """The 7-row colour lookup (``color_id, color_name``)."""
    return literal_table(spark, CAR_COLOR_ROWS, CAR_COLORS)


def smoke_table(spark: SparkSession) -> DataFrame:
    """The 3-row ``brand, model`` table used to check a storage round trip."""
    return literal_table(spark, SMOKE_ROWS, SMOKE)


def with_model_names(models: DataFrame) -> DataFrame:
    """Rename the model lookup to the enriched-record names."""
    return models.withColumnsRenamed({"car_brand": "brand_name", "car_model": "model_name"})


def hashed_cars(ids: DataFrame, id_col: str = "id", salt: int = 0,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """One random car per input row, drawn by a seeded hash of ``id_col``.

    Same ranges as drawing with ``randint`` per field; ``car_id`` is not made
    unique (two rows may draw the same id).  Runs as a narrow projection over
    any id source, e.g. ``spark.range(n)`` or a table's key column; ``keep``
    passes source columns through.
    """
    x = F.col(id_col)
    return ids.select(
        *keep,
        uniform_int(x, *CAR_ID_RANGE, salt=salt * 4 + 1).alias("car_id"),
        uniform_int(x, *DRIVER_ID_RANGE, salt=salt * 4 + 2).alias("driver_id"),
        uniform_int(x, *MODEL_ID_RANGE, salt=salt * 4 + 3).alias("model_id"),
        uniform_int(x, *COLOR_ID_RANGE, salt=salt * 4 + 4).alias("color_id"),
    )


def random_cars(spark: SparkSession, n: int = 20, salt: int = 0) -> DataFrame:
    """``n`` random cars generated on the executors (``spark.range`` + hashing)."""
    return hashed_cars(spark.range(n), "id", salt)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet dimension; the schema comes from the file footers."""
    return spark.read.parquet(path)


def write_dimension(df: DataFrame, path: str) -> None:
    """Replace a Parquet dimension.

    A stream joined to a dimension fails if its files are replaced under it, so
    a dimension that a running stream reads should be written to a new
    versioned path (``.../cars/v=2``) and the stream restarted on it.
    """
    df.write.mode("overwrite").parquet(path)


def publish_dimension(df: DataFrame, folder: str, version: int) -> None:
    """Write a new version of a dimension and make it the current one: its pointer appears once it is whole."""
    write_dimension(df, f"{folder}/v={version}")
    write_text(df.sparkSession, f"{folder}/_versions/{version}", "")


def current_version(spark: SparkSession, folder: str) -> int:
    """The newest version that is whole."""
    versions = [int(name) for name in children(spark, f"{folder}/_versions")]
    if not versions:
        raise ValueError(f"{folder} holds no published version")
    return max(versions)


def read_version(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return read_dimension(spark, f"{folder}/v={version}")
