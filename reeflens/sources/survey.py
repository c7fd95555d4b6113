"""Survey, trait and lookup sources (S1-S5) with explicit schemas.

Survey exports arrive as Parquet (or CSV) with the capitalised column names
of the field database; names are cleaned to snake_case after the union, as
the analysis does.  For production-scale storage, write the combined survey
once with :func:`write_survey` (partitioned by ``label``) -- most pipelines
filter on the label, so Spark prunes whole directories at planning time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import clean_name, drop_first_column, with_clean_names
from ..functions.semantics import nan_to_null, round_half_even
from ..operators.unions import union_strict

#: Cleaned survey columns and their Spark types (``degree`` is derived).
SURVEY_COLUMNS: tuple[tuple[str, T.DataType], ...] = (
    ("label", T.StringType()),
    ("year", T.IntegerType()),
    ("region", T.StringType()),
    ("reef", T.StringType()),
    ("depth", T.DoubleType()),
    ("transect", T.IntegerType()),
    ("protection_level", T.StringType()),
    ("latitude", T.DoubleType()),
    ("family", T.StringType()),
    ("species", T.StringType()),
    ("taxa2", T.StringType()),
    ("taxa3", T.StringType()),
    ("trophic_level", T.StringType()),
    ("size", T.DoubleType()),
    ("biomass", T.DoubleType()),
    ("quantity", T.DoubleType()),
)

#: Trait table: a header line and one row per species.
TRAITS_SCHEMA = T.StructType([
    T.StructField("Species", T.StringType()),
    T.StructField("groups_new", T.StringType()),
    T.StructField("groups_old", T.StringType()),
    T.StructField("functional_name", T.StringType()),
    T.StructField("Diet", T.StringType()),
    T.StructField("TrophicLevel", T.DoubleType()),
    T.StructField("MaxSizeTL", T.IntegerType()),
    T.StructField("ReefPosition", T.StringType()),
    T.StructField("FeedingType", T.StringType()),
    T.StructField("Solitary", T.IntegerType()),
    T.StructField("Schooling", T.IntegerType()),
    T.StructField("Shoaling", T.IntegerType()),
    T.StructField("Cluster", T.IntegerType()),
    T.StructField("PC1", T.DoubleType()),
    T.StructField("PC2", T.DoubleType()),
])


def export_schema(columns: Sequence[str]) -> T.StructType:
    """Types of a survey export's columns, found by their cleaned names; unknown columns are text."""
    types = dict(SURVEY_COLUMNS)
    return T.StructType([T.StructField(c, types.get(clean_name(c), T.StringType())) for c in columns])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read Parquet or CSV with an explicit schema when given.

    CSV files have a header, missing values as ``NA`` and quotes doubled inside
    quoted cells; a cell that does not fit its column's type is missing.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("nullValue", "NA").option("escape", '"').csv(path)
    return r.format(fmt).load(path)


def read_survey_export(spark: SparkSession, path: str, schema: T.StructType | None = None,
                       fmt: str | None = None) -> DataFrame:
    """One survey export; a CSV file without a given schema gets the types of ``SURVEY_COLUMNS``."""
    raw = read_table(spark, path, schema, fmt)
    if schema is None and (fmt or path.rsplit(".", 1)[-1]) == "csv":
        return read_table(spark, path, export_schema(raw.columns), "csv")
    return raw


def _col_by_clean_name(df: DataFrame, name: str) -> str:
    for c in df.columns:
        if clean_name(c) == name:
            return c
    raise ValueError(f"no column cleaning to {name!r} in {df.columns}")


def prepare_survey_export(df: DataFrame, excluded_families: Sequence[str] = (),
                          has_row_id: bool = True) -> DataFrame:
    """``degree = round(latitude)``, optional family exclusion, drop the row id.

    ``Family != x`` drops NULL families too (F1), which is why the exclusion is
    applied to one export only.  ``degree`` is appended before the row-id
    column is removed by position.
    """
    lat = _col_by_clean_name(df, "latitude")
    df = df.withColumn("degree", round_half_even(F.col(lat)))
    if excluded_families:
        fam = F.col(_col_by_clean_name(df, "family"))
        for v in excluded_families:
            df = df.filter(fam != F.lit(v))
    return drop_first_column(df) if has_row_id else df


def load_survey(spark: SparkSession, historic: str, current: str,
                excluded_families_historic: Sequence[str] = ("Carangidae",),
                schema: T.StructType | None = None, fmt: str | None = None) -> DataFrame:
    """S1 + S2 + U1 + P1: both exports, united strictly by name, names cleaned."""
    h = prepare_survey_export(read_survey_export(spark, historic, schema, fmt), excluded_families_historic)
    c = prepare_survey_export(read_survey_export(spark, current, schema, fmt))
    return nan_to_null(with_clean_names(union_strict(h, c)))


def load_export(spark: SparkSession, path: str, excluded_families: Sequence[str] = (),
                schema: T.StructType | None = None, fmt: str | None = None) -> DataFrame:
    """S3 (and each of S1, S2 by itself): one export, typed, prepared and with clean names."""
    export = prepare_survey_export(read_survey_export(spark, path, schema, fmt), excluded_families)
    return nan_to_null(with_clean_names(export))


def load_traits(spark: SparkSession, path: str) -> DataFrame:
    """The species trait table, names cleaned (``Species`` -> ``species``).

    A CSV file is read with ``TRAITS_SCHEMA``; a Parquet file has its own types.
    """
    csv = path.endswith(".csv")
    return with_clean_names(read_table(spark, path, TRAITS_SCHEMA if csv else None, "csv" if csv else "parquet"))


def write_survey(df: DataFrame, path: str, partition_by: Sequence[str] = ("label",)) -> None:
    """Store the combined survey as Parquet partitioned for label pruning."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
