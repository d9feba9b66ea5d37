"""Scoring as a stream: every arriving request file is one request, aggregated on its own rows only."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.operators.validate import split_valid, with_errors
from txrisk.plans.scoring import score
from txrisk.schema import CUSTOMER, REQUEST_COLUMNS
from txrisk.sources.artifacts import Artifacts
from txrisk.sources.tables import parse_requests

REQUEST = "RequestId"
REQUEST_TIME = "RequestTime"


def read_request_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON request files as a stream of text rows, each with the file it came from as its request id, and that file's time."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    meta = [F.col("_metadata.file_path").alias(REQUEST), F.col("_metadata.file_modification_time").alias(REQUEST_TIME)]
    return parse_requests(reader.load(path).select("value", *meta)).select("request.*", REQUEST, REQUEST_TIME)


def score_stream(
    requests: DataFrame,
    artifacts: Artifacts,
    scores_path: str,
    rejected_path: str,
    checkpoint_path: str,
    reference=None,
    refuse_whole_request: bool = True,
    trigger: dict | None = None,
    scorer: Callable[..., DataFrame] = score,
) -> StreamingQuery:
    """Start scoring ``requests``; returns the running query.

    A micro-batch holds many requests and scores them together, grouped by request and customer, so throughput does not
    depend on the size of single requests. Valid rows become ``(RequestId, CustomerId, risk_probability)`` below
    ``scores_path``; bad rows, or with ``refuse_whole_request`` all rows of a request that has one, go to
    ``rejected_path`` with their reasons.

    Both parts of a batch are published together: an attempt writes to folders of its own and is named in a commit table only when
    both are there (``commits_path``). Read them with ``read_published``; what a killed attempt has left never shows, and a batch that
    runs again after it was published is left alone.

    ``scorer`` takes (rows, artifacts, reference, by), ``score`` by default.

    Without ``reference`` the recency of a request counts from its own ``RequestTime``, so a retry gives the same scores; from
    the clock only if ``requests`` has no such column.
    """

    commits = commits_path(scores_path)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _committed(spark, commits).where(F.col("batch_id") == batch_id).count():
            return
        checked = with_errors(batch).persist()
        try:
            valid = split_valid(checked, REQUEST if refuse_whole_request else None)
            if reference is None and REQUEST_TIME in batch.columns:
                scores = scorer(valid.accepted, artifacts, F.col(REQUEST_TIME), by=(REQUEST, REQUEST_TIME, CUSTOMER)).drop(REQUEST_TIME)
            else:
                scores = scorer(valid.accepted, artifacts, reference, by=(REQUEST, CUSTOMER))
            attempt = f"a{uuid4().hex}"
            for frame, path in ((scores, scores_path), (valid.rejected, rejected_path)):
                frame.write.parquet(f"{path}/batch_id={batch_id}/attempt={attempt}")
            # One file, which its committer renames into place.
            spark.createDataFrame([(batch_id, attempt)], _COMMIT).coalesce(1).write.mode("append").parquet(commits)
        finally:
            checked.unpersist()

    missing = [c for c in REQUEST_COLUMNS if c not in requests.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    writer = requests.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint_path)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


_COMMIT = "batch_id long, attempt string"


def commits_path(scores_path: str) -> str:
    """Where the batches of ``scores_path`` that count are listed."""
    return f"{scores_path.rstrip('/')}-published"


def _committed(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_COMMIT).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _COMMIT)


def read_published(spark: SparkSession, path: str, scores_path: str) -> DataFrame:
    """The rows below ``path`` (scores or rejected rows) of the batches that are published, each once, with their ``batch_id``.

    Scores and rejections of a batch appear in the same moment, that of its commit. Only folders of published attempts are read.
    """
    # Of two writers of one batch, the attempt with the smaller name counts for both parts.
    counted = _committed(spark, commits_path(scores_path)).groupBy("batch_id").agg(F.min("attempt").alias("attempt"))
    rows = spark.read.parquet(path)
    return rows.join(counted, ["batch_id", "attempt"], "left_semi").select([c for c in rows.columns if c != "attempt"])
