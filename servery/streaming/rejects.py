"""Numbers of unusable messages, taken while the others are counted.

The reasons are counted as metrics of the running query itself, so nothing is read twice. A listener
adds each completed batch to totals behind a pointer, once, whatever restarts come in between.
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType

from servery.operators.quality import REASON
from servery.sources.changelog import few_rows
from servery.versions import current_version, publish_version

#: All reasons that messages are set apart for.
REASONS = ("empty", "malformed", "incomplete", "amount_not_finite")
REJECTS = StructType(
    [StructField("topic", StringType()), StructField("reason", StringType()), StructField("n", LongType())]
)


def reject_metrics(root: str, topic: str) -> str:
    """The name of a job's metrics of one topic."""
    return f"rejects of {topic} in {root}"


def counting_rejects(checked: DataFrame, metrics: str | None) -> DataFrame:
    """Checked messages, with the number of each reason as metrics of that name."""
    if metrics is None:
        return checked
    return checked.observe(metrics, *[F.count_if(F.col(REASON) == reason).alias(reason) for reason in REASONS])


def _folder(root: str, topic: str) -> str:
    return f"{root}/rejects/{topic}"


class RejectCounts(StreamingQueryListener):
    """Keeps the totals of the topics of one job."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            topic = name.removeprefix("rejects of ").removesuffix(f" in {self._root}")
            if name != reject_metrics(self._root, topic):
                continue  # of another job in this session
            _, noted = current_version(self._spark, _folder(self._root, topic))
            if progress.batchId > noted.get("batch_id", -1):
                totals = {reason: noted.get("totals", {}).get(reason, 0) + (row[reason] or 0) for reason in REASONS}
                publish_version(self._spark, _folder(self._root, topic), {"batch_id": progress.batchId, "totals": totals}, [])


def await_counts(spark: SparkSession, root: str, topic: str, queries: Iterable[StreamingQuery], seconds: int = 60) -> None:
    """Wait until the batches that these queries completed are in the totals."""
    name = reject_metrics(root, topic)
    done = [p.batchId for q in queries for p in q.recentProgress if name in p.observedMetrics]
    until = time.monotonic() + seconds
    while done and current_version(spark, _folder(root, topic))[1].get("batch_id", -1) < max(done):
        if time.monotonic() > until:
            raise TimeoutError(f"the {name} are not noted")
        time.sleep(0.05)


def read_rejects(spark: SparkSession, root: str, topics: Iterable[str]) -> DataFrame:
    """``topic``, ``reason``, ``n``; no row where there are none."""
    noted = {topic: current_version(spark, _folder(root, topic))[1].get("totals", {}) for topic in topics}
    return few_rows(spark, [(t, reason, n) for t, totals in noted.items() for reason, n in totals.items() if n], REJECTS)
