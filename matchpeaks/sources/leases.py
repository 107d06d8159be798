"""A lease that at most one of several callers holds, kept as rows in shared storage.

Storage needs no locks for it, only that a written file is listed by every later reader. A caller
writes its claim and then reads all claims: it holds the lease if no other live claim is there.
Of two callers at once, each writes before it reads, so at least one of them sees the
other and withdraws; if both do, they try again after a moment of random length. A claim lives until it is
withdrawn or its time is over, so a caller that dies blocks others no longer than that.
Clocks of the callers should agree within the slack.
"""

from __future__ import annotations

import datetime as dt
import random
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, functions as F

CLAIM = "claim string, until timestamp, withdrawn boolean"
CLOCK_SLACK = dt.timedelta(seconds=5)


@dataclass(frozen=True)
class Lease:
    spark: SparkSession
    path: str
    claim: str

    def release(self) -> None:
        _write(self.spark, self.path, (self.claim, None, True))

    def __enter__(self) -> Lease:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def _write(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], CLAIM).coalesce(1).write.mode("append").json(path)


def live_claims(spark: SparkSession, path: str) -> list[str]:
    """Claims that are neither withdrawn nor over: as many as there are callers at one moment."""
    try:
        rows = spark.read.schema(CLAIM).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    claims = rows.groupBy("claim").agg(
        F.max("until").alias("until"), F.coalesce(F.max("withdrawn"), F.lit(False)).alias("withdrawn")
    )
    still = dt.datetime.now(dt.timezone.utc) - CLOCK_SLACK
    live = claims.where(~F.col("withdrawn") & (F.col("until") > F.lit(still)))
    return [row["claim"] for row in live.select("claim").collect()]


def acquire(
    spark: SparkSession, path: str, lasts: dt.timedelta = dt.timedelta(hours=1), tries: int = 4
) -> Lease | None:
    """The lease at ``path``, or None if another caller holds it."""
    for attempt in range(tries):
        if live_claims(spark, path):
            return None
        lease = Lease(spark, path, uuid.uuid4().hex)
        until = dt.datetime.now(dt.timezone.utc) + lasts
        _write(spark, path, (lease.claim, until, False))
        if live_claims(spark, path) == [lease.claim]:
            return lease
        lease.release()
        time.sleep(random.random() * (attempt + 1))
    return None
