"""Fetching with retries, back-off and a pace for each host, as a stream with keyed state.

A stream of ``hash, url, host``, without the repeated ones, is keyed by host. A host's state are its open items, each with its attempts so far and the
time it is due, and the time of the last fetch. Open items lie in blocks: new ones in a queue, those to be tried again with the earliest time that one of
a block is due. A micro-batch reads the blocks that it works on, not all open items, so its work doesn't grow with what is left. It takes a host's next
items, and goes on with further ones while it is young: else the largest host's items over those of a block would be the number of micro-batches, each at
the price of all stores. Items come due through processing-time timers; between two fetches of a host lies its pace. The fetcher is a function
that the caller hands in (a live one, or a table of answers), so nothing here opens a connection. A host that answers with a quota's
status to the last is stopped: its other items stay open, and the driver ends the stream between micro-batches.

State and offsets are committed together and the outcomes' sink is a ledger by batch, so each item has one outcome, also after a restart.
"""

from __future__ import annotations

import heapq
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .ledger import Ledger, first_of

OUTCOMES = "hash string, url string, host string, status string, reason string, attempts int, bytes bigint"
#: Items of a block, by field.
BLOCK = "hash array<string>, url array<string>, attempt array<int>, due array<bigint>, seq array<bigint>"
#: Of a host: time of the last fetch, items seen, whether it is stopped, the queue's first block and the one after its last, number of the
#: last block of items to be tried again (counted down from 0), and when each of these is due first.
HOST = "last bigint, seen bigint, stopped boolean, head bigint, tail bigint, low bigint, due array<bigint>, block array<bigint>"
#: Longest wait before a retry, in seconds.
LONGEST_WAIT = 60.0
#: Fetches of a host in one micro-batch at least; the rest wait for the next timer, unless the micro-batch's task is younger than SPELL seconds.
PER_BATCH, SPELL = 64, 10.0
#: Partitions of state for each core at most: each costs a store and a Python worker's start in every micro-batch, also where no key is due.
PER_CORE = 2
#: The one store that keeps state by key and timers; changes of a batch instead of copies of all state, and few batches kept.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.minBatchesToRetain": "2",
}

#: url, attempt from 0 -> (HTTP status or None for a network error, payload, Retry-After in seconds or None)
Fetcher = Callable[[str, int], tuple[int | None, bytes, float | None]]


def next_step(status: int | None, attempt: int, retries: int, worker: bool = False) -> str:
    """ok, retry, stop or fail, as ``decisions.fetch`` says; a network error (None) is retried."""
    if status == 200:
        return "ok"
    quota = status in (403, 429)
    again = status is None or status >= 500 or (status in (408, 425) and not worker)
    if not (quota or again):
        return "fail"
    return "retry" if attempt < retries else "stop" if quota else "fail"


def wait_before(attempt: int, base: float, status: int | None, retry_after: float | None) -> float:
    """Seconds before the next attempt: doubled each time, or as a quota's answer says, up to the longest."""
    asked = retry_after if status in (403, 429) and retry_after else base * 2**attempt
    return min(asked, LONGEST_WAIT)


class Fetching(StatefulProcessor):
    """State of a host: ``blocks`` of open items by number, ``host``. Rows of other micro-batches mustn't come again. Times are in milliseconds."""

    def __init__(self, fetch: Fetcher, retries: int, base: float, pace: float, worker: bool, per_batch: int, spell: float = SPELL):
        self.fetch, self.retries, self.base, self.pace, self.worker, self.per_batch, self.spell = fetch, retries, base, pace, worker, per_batch, spell

    def init(self, handle) -> None:
        self.handle, self.began = handle, time.monotonic()
        self.blocks = handle.getMapState("blocks", "number bigint", BLOCK)
        self.host = handle.getValueState("host", HOST)

    def put(self, number: int, items: list[tuple]) -> None:
        """``items``: (due, seq, hash, url, attempt)."""
        due, seq, hash_, url, attempt = (list(x) for x in zip(*items))
        self.blocks.updateValue((number,), (hash_, url, attempt, due, seq))

    def take(self, number: int) -> list[tuple]:
        hash_, url, attempt, due, seq = self.blocks.getValue((number,))
        self.blocks.removeKey((number,))
        return list(zip(due, seq, hash_, url, attempt))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, seen, stopped, head, tail, low, due, block = self.host.get() or (0, 0, False, 0, 0, 0, [], [])
        new, here = [], set()
        for r in rows:
            if r.hash in here:
                continue
            here.add(r.hash)
            new.append((0, seen, r.hash, r.url, 0))
            seen += 1
            if len(new) >= self.per_batch:
                self.put(tail, new)
                new, tail = [], tail + 1
        if new:
            self.put(tail, new)
            tail += 1
        self.host.update((last, seen, stopped, head, tail, low, list(due), list(block)))
        yield from self.work(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.work(key, timerValues)

    def work(self, key, timerValues) -> Iterator[Row]:
        last, seen, stopped, head, tail, low, due, block = self.host.get()
        if stopped:
            return
        began = timerValues.getCurrentProcessingTimeInMs()
        now = max(began, int(time.time() * 1000))
        later = sorted(zip(due, block))
        while head < tail or (later and later[0][0] <= now):
            waiting: list[tuple] = []
            while head < tail and len(waiting) < self.per_batch:
                waiting += self.take(head)
                head += 1
            # Of the blocks to be tried again, those that may hold one of the next items.
            while later and later[0][0] <= now and (len(waiting) < self.per_batch or later[0][0] < sorted(waiting)[self.per_batch - 1][0]):
                waiting += self.take(heapq.heappop(later)[1])
            waiting.sort()
            again, at = [], 0
            for when, seq, hash_, url, attempt in waiting[: self.per_batch]:
                if when > now:
                    break
                if last and (gap := last / 1000 + self.pace - time.time()) > 0:
                    time.sleep(gap)
                status, data, after = self.fetch(url, attempt)
                last = int(time.time() * 1000)
                at += 1
                step = next_step(status, attempt, self.retries, self.worker)
                if step == "retry":
                    again.append((last + int(1000 * wait_before(attempt, self.base, status, after)), seq, hash_, url, attempt + 1))
                    continue
                reason = "" if step == "ok" else "network error" if status is None else f"HTTP {status}"
                yield Row(hash=hash_, url=url, host=key[0], status=step, reason=reason, attempts=attempt + 1, bytes=len(data) if step == "ok" else 0)
                if step == "stop":
                    stopped = True
                    break
            left = waiting[at:]
            if new := [x for x in left if x[4] == 0]:
                head -= 1
                self.put(head, new)
            again = sorted(again + [x for x in left if x[4] > 0])
            for k in range(0, len(again), self.per_batch):
                low -= 1
                self.put(low, again[k : k + self.per_batch])
                heapq.heappush(later, (again[k][0], low))
            if stopped or time.monotonic() - self.began >= self.spell:
                break
            now = max(began, int(time.time() * 1000))
        self.host.update((last, seen, stopped, head, tail, low, [x for x, _ in later], [x for _, x in later]))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if (head < tail or later) and not stopped:
            soonest = 0 if head < tail else later[0][0]
            self.handle.registerTimer(max(soonest, began + 1))


def outcomes(items: DataFrame, fetch: Fetcher, retries: int = 5, base: float = 2.0, pace: float = 0.5, worker: bool = False, per_batch: int = PER_BATCH, spell: float = SPELL) -> DataFrame:
    """The stream of outcomes (OUTCOMES) of a stream of ``hash, url, host``."""
    rows = items.select("hash", "url", "host").dropDuplicates(["host", "hash"]).groupBy("host")
    return rows.transformWithState(Fetching(fetch, retries, base, pace, worker, per_batch, spell), OUTCOMES, "append", "processingTime")


def run(items: DataFrame, out: str, checkpoint: str, fetch: Fetcher, stop: Callable[[Ledger], bool], every: float = 0.5, **options) -> None:
    """Fetches till ``stop`` (asked of the ledger between micro-batches) says so. Started again with the same folders, it goes on with what is
    open, in its attempt."""
    spark = items.sparkSession
    ledger = Ledger(spark, out, OUTCOMES)
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = STATE_STORE | {"spark.sql.shuffle.partitions": str(min(dealt, PER_CORE * spark.sparkContext.defaultParallelism))}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        sink = outcomes(items, fetch, **options).writeStream.outputMode("append").foreachBatch(lambda rows, number: ledger.put(number, rows))
        query = sink.option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    try:
        while not query.awaitTermination(every):
            if stop(ledger):
                return
    finally:
        query.stop()


def results(spark: SparkSession, out: str) -> DataFrame:
    """One outcome for each item that has one."""
    return first_of(Ledger(spark, out, OUTCOMES).rows(), "hash", ["attempts", "status", "url"])


def settled(ledger: Ledger, items: int) -> bool:
    """Whether all items have an outcome or a host has stopped. Batches that others follow are counted once."""
    aggs = [F.count(F.lit(1)), F.coalesce(F.bool_or(F.col("status") == "stop"), F.lit(False))]
    n, stopped = ledger.total(aggs, lambda x, y: (x[0] + y[0], x[1] or y[1]), (0, False))
    return n >= items or stopped
