"""CSV sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed value. Labelled dialogue file: all columns nullable strings.
LABELLED_SCHEMA = T.StructType([
    T.StructField("dialogue", T.StringType(), True),
    T.StructField("personality", T.StringType(), True),
    T.StructField("type", T.StringType(), True),
    T.StructField("labels", T.StringType(), True),
])

_CSV_OPTS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}


class MissingColumnError(ValueError):
    pass


def read_labelled(spark: SparkSession, path: str, schema: T.StructType = LABELLED_SCHEMA,
                  malformed: str | None = None) -> DataFrame:
    """Labelled dialogues CSV; the columns of ``schema`` taken by header
    name, in any order, among any others.  Quoted fields may hold newlines and
    doubled quotes; missing values stay null (never the text ``nan``).

    Rows with more or fewer fields than the header keep what could be read;
    ``malformed`` names a column that then holds their raw line (null on good
    rows), so that they can be counted.  Raises if a column is absent."""
    header = spark.read.options(**_CSV_OPTS).csv(path).columns
    absent = [f.name for f in schema.fields if f.name not in header]
    if absent:
        raise MissingColumnError(f"CSV must contain a '{absent[0]}' column.")
    types = {f.name: f.dataType for f in schema.fields}
    fields = [T.StructField(c, types.get(c, T.StringType()), True) for c in header]
    corrupt = malformed or "_malformed"
    read = (spark.read.schema(T.StructType([*fields, T.StructField(corrupt, T.StringType(), True)]))
            .options(**_CSV_OPTS).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).csv(path))
    return read.select(*[f.name for f in schema.fields], *([corrupt] if malformed else []))


def read_history(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    """Any CSV with a header; column types inferred (one extra pass)."""
    return spark.read.options(**_CSV_OPTS).option("inferSchema", str(infer).lower()).csv(path)


def require_columns(df: DataFrame, required=("dialogue",)) -> DataFrame:
    """Upload contract; raises with a readable message if a column is absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnError(f"CSV must contain a '{missing[0]}' column.")
    return df


def upload_summary(df: DataFrame, head: int = 5):
    """Record count and the first rows of an accepted upload."""
    return df.count(), df.limit(head)


def single_text(spark: SparkSession, text: str | None, column: str = "dialogue") -> DataFrame:
    """One text as a one-row frame; explicit type so None works."""
    return spark.createDataFrame([(text,)], f"{column} string")


def write_predictions_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``dialogue, predicted_label, confidence`` as CSV with a header;
    every field quoted so dialogues with commas, quotes and newlines
    round-trip.  Written in parallel (one file per partition)."""
    (df.select("dialogue", "predicted_label", "confidence")
       .write.mode(mode).option("header", "true").option("quoteAll", "true")
       .option("escape", '"').csv(path))
