"""Scoring a stream of loan applications: valid rows and rejects in sinks committed together."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pdloom.functions.columns import risk_band
from pdloom.operators.cleaning import request_constraints
from pdloom.session import cached, small_table
from pdloom.sources.tables import ModelBundle, load_bundle, pick_bundle

Score = Callable[[DataFrame], DataFrame]


def scored_requests(requests: DataFrame, score: Score) -> DataFrame:
    """Valid requests with ``pd`` (added by ``score``) and its band; works on both kinds
    of DataFrame."""
    valid = request_constraints(requests).where("valid").drop("valid", "reject_reasons")
    return score(valid).withColumn("risk_band", risk_band(F.col("pd")))


def rejected_requests(requests: DataFrame) -> DataFrame:
    return request_constraints(requests).where(~F.col("valid")).drop("valid")


class BundleScorer:
    """Scores with the bundle that is the newest when a batch arrives; a bundle is loaded once."""

    def __init__(self, spark: SparkSession, root: str, keep: Sequence[str], name: str | None = None):
        self._spark, self._root, self._keep, self._name = spark, root, tuple(keep), name
        self._bundle: ModelBundle | None = None

    def resolve(self) -> str:
        """Version of the bundle that scores the next batch."""
        newest = pick_bundle(self._spark, self._root, self._name)
        if self._bundle is None or self._bundle.name != newest:
            self._bundle = load_bundle(self._spark, self._root, newest)
        return newest

    def __call__(self, requests: DataFrame) -> DataFrame:
        if self._bundle is None:
            self.resolve()
        scored = self._bundle.score(requests, self._keep)
        calibrated = [c for c in ("pd_calibrated",) if c in scored.columns]
        return scored.select(*self._keep, "pd", *calibrated, "margin", "model_version")


def once_per_application(
    requests: DataFrame, id_col: str, time_col: str, within: str
) -> DataFrame:
    """Drops repeated applications that arrive ``within`` the time of the first one."""
    return requests.withWatermark(time_col, within).dropDuplicatesWithinWatermark([id_col])


def score_stream(
    requests: DataFrame,
    score: Score,
    scored_path: str,
    rejected_path: str,
    checkpoint: str,
    available_now: bool = True,
    commits_path: str | None = None,
) -> StreamingQuery:
    """Start scoring a streaming source into two Parquet sinks.

    Each batch is written to a folder named by its number, so a batch run again after a failure
    replaces its own output. With ``commits_path`` a line per batch, written after both sinks,
    names the batch and the model version; ``committed`` reads batches that have one. A scorer with
    ``resolve`` picks its model version per batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        version = score.resolve() if hasattr(score, "resolve") else None
        with cached(request_constraints(batch)) as judged:
            valid = judged.where("valid").drop("valid", "reject_reasons")
            scored = score(valid).withColumn("risk_band", risk_band(F.col("pd")))
            scored.write.mode("overwrite").parquet(f"{scored_path}/batch={number}")
            rejected = judged.where(~F.col("valid")).drop("valid")
            rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={number}")
        if commits_path is not None:
            line = small_table(batch.sparkSession, [(number, version)], "batch bigint, model_version string")
            line.coalesce(1).write.mode("overwrite").json(f"{commits_path}/{number}")

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def committed(spark: SparkSession, sink_path: str, commits_path: str) -> DataFrame:
    """Rows of the batches both sinks of which are complete."""
    done = spark.read.schema("batch bigint").json(f"{commits_path}/*").distinct()
    return spark.read.parquet(sink_path).join(F.broadcast(done), "batch", "left_semi")


def model_versions(spark: SparkSession, commits_path: str) -> DataFrame:
    """Which model version scored each committed batch."""
    return spark.read.schema("batch bigint, model_version string").json(f"{commits_path}/*")
