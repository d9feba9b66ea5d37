"""Readers and writers for the tables of the workflow: transactions, features, labels, requests, run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txrisk.functions.columns import nan_to_null, named
from txrisk.schema import FEATURE_SCHEMA, LABEL_SCHEMA, REQUEST_TEXT_SCHEMA, TX_SCHEMA

# The CSV texts that mean "missing".
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a headed CSV by column name, with declared types.

    Columns are matched by header name, so their order in the file is free; columns outside ``schema`` stay as text and
    columns of ``schema`` that the file lacks are absent (``require_columns`` reports those that matter).
    """
    # Files whose header differs from that of the first one are refused.
    text = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False).csv(path)
    types = {f.name: f.dataType for f in schema.fields}
    columns = []
    for name in text.columns:
        value = F.when(~named(name).isin(MISSING_TEXTS), named(name))
        columns.append(value.cast(types.get(name, T.StringType())).alias(name))
    return text.select(*columns)


def read_transactions(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = TX_SCHEMA
) -> DataFrame:
    """Raw transactions from Parquet, CSV or JSON; NaN becomes null and the time column becomes a timestamp.

    Pass a ``schema`` with an integer ``CountryCode`` for data that codes countries as numbers, so that ties of the most
    frequent country resolve by number.
    """
    if fmt == "csv":
        tx = read_csv(spark, path, schema)
    elif fmt == "json":
        tx = spark.read.schema(schema).json(path)
    elif fmt == "parquet":
        # Parquet carries its own types; only those columns that differ from the declared ones are cast.
        raw = spark.read.parquet(path)
        types = {f.name: f.dataType for f in schema.fields}
        tx = raw.select(
            *(
                named(f.name)
                if f.dataType == types.get(f.name, f.dataType)
                else named(f.name).cast(types[f.name]).alias(f.name)
                for f in raw.schema.fields
            )
        )
    else:
        raise ValueError(f"Unknown format: {fmt!r}; use 'parquet', 'csv' or 'json'")
    return nan_to_null(tx)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests from JSON, all fields as text, for validation.

    A file is one array, laid out in any way, or one record; or one record or array per line.
    """
    return parse_requests(spark.read.text(path, wholetext=True)).select("request.*")


def parse_requests(files: DataFrame) -> DataFrame:
    """``request`` for every record in ``value``, the text of a whole request file; other columns stay.

    A file that doesn't parse as a whole is read by line; a line that doesn't parse is a record without values.
    """
    records = T.ArrayType(REQUEST_TEXT_SCHEMA)
    options = {"mode": "PERMISSIVE"}
    others = [c for c in files.columns if c != "value"]
    text = F.trim(F.regexp_replace("value", r"^\uFEFF", ""))
    # A line that closes a record and one that opens the next mean a record per line.
    by_line = text.rlike(r"[}\]][ \t\r]*\n\s*[{\[]")
    parts = F.when(by_line, F.filter(F.split(text, r"\r?\n"), lambda x: F.trim(x) != "")).otherwise(F.array(text))
    parts = files.where(text != "").select(*others, F.explode(parts).alias("part"))
    found = F.coalesce(F.from_json("part", records, options), F.array(F.lit(None).cast(REQUEST_TEXT_SCHEMA)))
    return parts.select(*others, F.explode(found).alias("request"))


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A feature table: the customer roll-up, or an encoded matrix, whose columns are all doubles but for the id."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in (*FEATURE_SCHEMA.fields, *LABEL_SCHEMA.fields)}
    encoded = T.StructType([known.get(c, T.StructField(c, T.DoubleType())) for c in header])
    return read_csv(spark, path, encoded)


def read_labels(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The ``(CustomerId, is_high_risk)`` table."""
    return read_csv(spark, path, LABEL_SCHEMA) if fmt == "csv" else spark.read.schema(LABEL_SCHEMA).parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write features, labels or scores; CSV gets a header row."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    model_name: str,
) -> None:
    """Append one training run (a few dozen rows) to the run log."""
    rows = [(run_id, "model", "name", model_name)]
    rows += [(run_id, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, "metric", k, str(v)) for k, v in metrics.items()]
    spark.createDataFrame(rows, RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str, run_ids: Sequence[str] | None = None) -> DataFrame:
    runs = spark.read.schema(RUN_LOG_SCHEMA).parquet(path)
    return runs.where(F.col("run_id").isin(list(run_ids))) if run_ids is not None else runs
