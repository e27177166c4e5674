"""Payloads that wait: keyed state over (symbol, date) that offers a refused payload again after a while.

``ingest_landing`` with ``accept`` and ``waiting_root`` leaves there what it refuses, for example a payload that only a repair
makes usable, while an intact one may still come. Each run of ``retry_waiting`` adds those payloads to the state and offers the ones whose time is out
to the parser again, without any new landing. Of several for a symbol-day the first landed that is usable counts; a symbol-day that
the ledger has as done is left alone, and word of it clears its state. What is still refused waits anew, until it is
``keep_seconds`` old and expires with its state. Ingest and retry of one ledger are run one after the other.

Usable payloads never pass through Python or the state: both hold refused ones only, equal texts of a symbol-day once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from minutebook.schema import KEY
from minutebook.streaming.ingest import WAITING_SCHEMA, finished, store_outcomes

# Keyed state needs this store; empty batches are off, as a run would otherwise go from one to the next and never end.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class WaitingPayloads(StatefulProcessor):
    """Refused payloads of one symbol-day by digest, offered when the timer of the symbol-day fires."""

    def __init__(self, wait_ms: int, keep_ms: int):
        # at least a millisecond: a timer set to the very time that fires is removed with the one that fired
        self.wait_ms, self.keep_ms = max(wait_ms, 1), keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.texts = handle.getMapState("texts", "digest long", "payload string, landed timestamp, source string", self.keep_ms)

    def _wait(self, now: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(now + self.wait_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            if row.digest is None:  # done by other means
                self.texts.clear()
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                return iter(())
            if not self.texts.containsKey((row.digest,)):
                self.texts.updateValue((row.digest,), (row.payload, row.landed, row.source))
        if not list(self.handle.listTimers()):
            self._wait(timerValues.getCurrentProcessingTimeInMs())
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = [(digest[0], *value) for digest, value in self.texts.iterator()]
        if kept:  # else all have expired
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        for digest, payload, landed, source in kept:
            yield Row(symbol=key[0], date=key[1], payload=payload, landed=landed, source=source, digest=digest)

    def close(self) -> None:
        pass


def _offer(batch: DataFrame, batch_id: int, waiting_root: str, ledger_root: str, bars_root: str | None, accept: tuple[str, ...] | None) -> None:
    """Take the usable ones of the offered payloads, and tell the state which symbol-days are done."""
    spark, name = batch.sparkSession, f"retry-{batch_id}"
    if batch.isEmpty():
        return
    days = [r["date"] for r in batch.select("date").distinct().collect()]  # one text per day
    done = finished(spark, ledger_root, days, name)
    store_outcomes(batch.join(done, KEY, "left_anti"), name, ledger_root, bars_root, accept, keep_refused=False)
    over = batch.select(*KEY).distinct().join(finished(spark, ledger_root, days), KEY, "left_semi")
    over.select(*KEY, *[F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema.fields if f.name not in KEY]).write.mode(
        "overwrite").json(f"{waiting_root}/{name}-done")


def retry_waiting(
    spark: SparkSession, waiting_root: str, ledger_root: str, checkpoint: str, wait_seconds: float, keep_seconds: float,
    bars_root: str | None = None, accept: tuple[str, ...] | None = None,
) -> None:
    """Add what was left below ``waiting_root`` to the state, offer what has waited ``wait_seconds``, then return.

    ``accept`` names the parse statuses that are taken now; without it every usable payload is.
    """
    # a row without a symbol: there is then always a batch, in which due timers fire
    beat = spark.range(1).select(F.lit(None).cast("string").alias("symbol"), F.lit("beat").alias("source"))
    beat.write.json(f"{waiting_root}/beat-{uuid.uuid4().hex}")
    before = {k: spark.conf.get(k) for k in STATE_SETTINGS}
    for k, v in STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        refused = spark.readStream.schema(WAITING_SCHEMA).json(f"{waiting_root}/*").filter("symbol is not null and date is not null")
        offers = refused.groupBy(*KEY).transformWithState(
            WaitingPayloads(int(wait_seconds * 1000), int(keep_seconds * 1000)), WAITING_SCHEMA, "Append", "ProcessingTime"
        )
        query = (
            offers.writeStream.foreachBatch(lambda batch, n: _offer(batch, n, waiting_root, ledger_root, bars_root, accept))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
