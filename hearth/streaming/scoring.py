"""M10 as a stream: requests are scored as they come and logged once each.

Every micro-batch is scored by the bundle that ``latest`` names at that time.  Bundles are read from
their own stamped folder, which doesn't change any more, and only when the stamp is another one than
before; so a run that trains anew needs no restart here.  The scored rows go to the prediction log
under the stream's name and the batch's number: a batch that is run again after a failure
replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from hearth.sources import sinks


class Serving:
    """The current model of a folder of stamped bundles."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.stamp: str | None = None
        self.model = None

    def current(self):
        stamp = sinks.latest_stamp(self.spark, self.root)
        if stamp != self.stamp:
            self.model, self.stamp = sinks.load_boosted(self.spark, f"{self.root}/{stamp}"), stamp
        return self.model


def score_stream(requests: DataFrame, root: str, log_path: str, run: str, checkpoint: str, features: Sequence[str],
                 prepare: Callable[[DataFrame], DataFrame] | None = None, **trigger) -> None:
    """Scores a stream of raw request rows (``prepare`` turns rows of another shape into such) with the bundles
    under ``root`` and logs prediction and ``features``.  Takes in what is there and ends
    (``availableNow``), unless ``trigger`` says otherwise."""
    serving = Serving(requests.sparkSession, root)

    def store(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        sinks.append_log(sinks.prediction_log(serving.current().score(rows), features), log_path, run, number)

    query = (requests.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"availableNow": True})).start())
    query.awaitTermination()
