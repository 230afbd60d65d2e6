"""Requests to a service from tasks: a window of open ones, a share of one rate, and a ledger that a task run again reads.

Jobs are dealt out by key to a fixed number of tasks, so a key always belongs to the same bucket. A task may send its share of
the whole rate, the rate over the number of tasks, as no more can run at once. Within it up to ``window`` requests are
open, and replies come out in the order of the jobs. Each reply goes to the bucket's ledger in the shared folder before
its row leaves the task; a task that runs again takes the replies from there and sends only what is open.
"""

from __future__ import annotations

import asyncio
import inspect
import json
import random
import uuid
from collections import deque
from collections.abc import AsyncIterator, Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.sources import files

#: Requests that a task has open, times that a failed one is sent again, and tasks.
WINDOW, RETRIES, TASKS = 4, 4, 8


class Clock:
    """Time as the limiter and the retries see it; tests put another in its place."""

    def now(self) -> float:
        return asyncio.get_running_loop().time()

    async def sleep(self, seconds: float) -> None:
        await asyncio.sleep(seconds)


def transient(error: Exception) -> bool:
    """Whether to try again: the error has no status (a broken connection), 429, or one of 500 and more."""
    status = getattr(error, "status_code", None)
    status = getattr(getattr(error, "response", None), "status_code", None) if status is None else status
    return status is None or status == 429 or status >= 500


@dataclass
class Sender:
    """What a task needs to send requests. ``rate``: requests a second of this task, retries included; None: no limit."""

    client: Callable
    window: int = WINDOW
    rate: float | None = None
    retries: int = RETRIES
    clock: Clock = field(default_factory=Clock)
    free: float = float("-inf")

    async def turn(self) -> None:
        """Wait for the next free instant; instants lie 1 / rate apart and are given out in the order of asking."""
        if self.rate:
            at = max(self.clock.now(), self.free)
            self.free = at + 1 / self.rate
            if (wait := at - self.clock.now()) > 0:
                await self.clock.sleep(wait)

    async def call(self, prompt: str) -> str | None:
        if inspect.iscoroutinefunction(self.client):
            return await self.client(prompt)
        return await asyncio.get_running_loop().run_in_executor(self.pool, self.client, prompt)

    async def send(self, prompt: str) -> tuple[str | None, str | None]:
        """(reply, error): transient errors are tried again after 2^k seconds and up to half of one more, then told."""
        for k in range(self.retries + 1):
            await self.turn()
            try:
                return await self.call(prompt), None
            except Exception as e:
                if k == self.retries or not transient(e):
                    return None, str(e)
                await self.clock.sleep(2.0**k + random.uniform(0, 0.5))
        raise AssertionError("unreachable")

    async def replies(self, jobs: Iterable[tuple[str, str]], answered: Callable[[str, str | None, str | None], None]) -> AsyncIterator[tuple[str, str | None, str | None]]:
        """(key, reply, error) of jobs (key, prompt) in their order; ``answered`` is told as each one comes in."""
        open_: deque = deque()

        async def one(key: str, prompt: str) -> tuple[str, str | None, str | None]:
            got = (key, *await self.send(prompt))
            answered(*got)
            return got

        with ThreadPoolExecutor(self.window) as self.pool:
            try:
                for job in jobs:
                    open_.append(asyncio.ensure_future(one(*job)))
                    if len(open_) >= self.window:
                        yield await open_.popleft()
                while open_:
                    yield await open_.popleft()
            finally:
                for rest in open_:
                    rest.cancel()

    def run(self, jobs: Iterable[tuple[str, str]], answered: Callable[[str, str | None, str | None], None] = lambda *x: None) -> Iterator[tuple[str, str | None, str | None]]:
        """:meth:`replies` for code that isn't asynchronous."""
        loop = asyncio.new_event_loop()
        rows = self.replies(jobs, answered)
        try:
            while True:
                try:
                    yield loop.run_until_complete(anext(rows))
                except StopAsyncIteration:
                    return
        finally:
            loop.run_until_complete(rows.aclose())
            loop.close()


class Ledger:
    """Replies of a bucket, in files of ``each`` replies; with 1, every reply is on file before the next row leaves the task."""

    def __init__(self, folder: str, each: int):
        self.folder, self.each, self.held = folder, each, []

    def read(self) -> dict[str, tuple[str | None, str | None]]:
        """key -> (reply, error) of what attempts before this one have got; errors are not kept, so those are sent again."""
        out = {}
        for name in files.names(self.folder):
            for line in (files.get(f"{self.folder}/{name}") or b"").splitlines():
                key, reply = json.loads(line)
                out[key] = (reply, None)
        return out

    def add(self, key: str, reply: str | None, error: str | None) -> None:
        if error is None:
            self.held.append(json.dumps([key, reply]))
            if len(self.held) >= self.each:
                self.flush()

    def flush(self) -> None:
        if self.held:
            files.put(f"{self.folder}/{uuid.uuid4().hex}.jsonl", "\n".join(self.held).encode())
            self.held = []


def send_all(jobs: DataFrame, client: Callable, ledger: str | None = None, rate: float | None = None, window: int = WINDOW, retries: int = RETRIES, tasks: int = TASKS, each: int = 1, clock: Clock | None = None) -> DataFrame:
    """jobs (key, prompt) with the client's answer: key, reply, error (null without one).

    ``client`` (a function or a coroutine function) goes to the tasks. At most ``rate`` requests a second are sent by all
    ``tasks`` together, ``window`` are open in each. With ``ledger``, a folder of this run that driver and tasks share,
    what has been answered isn't asked again, by a task that is run again, by a second action on the result or by a run that
    is called anew; only requests whose answer was not on file when a task was lost are sent twice, at most ``window +
    each - 1`` of a task. Of rows that repeat a key the first by prompt is asked; rows with a null key or prompt are left out.
    """
    asked = jobs.where("key is not null and prompt is not null").select(F.col("key").cast("string").alias("key"), "prompt").repartition(tasks, "key")
    one = asked.groupBy("key").agg(F.min("prompt").alias("prompt"))  # by the same exchange
    dealt = one.select("key", "prompt", F.pmod(F.hash("key"), F.lit(tasks)).alias("bucket")).sortWithinPartitions("key")
    clock = clock or Clock()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, known, own = Sender(client, window, rate and rate / tasks, retries, clock), {}, None
        for batch in batches:
            keys, prompts, buckets = (c.to_pylist() for c in batch.columns)
            if ledger and own is None and buckets:  # a task holds one bucket
                own = Ledger(f"{ledger}/{buckets[0]:05d}", each)
                known = own.read()
            got = {k: known[k] for k in keys if k in known}
            for key, reply, error in sender.run(((k, p) for k, p in zip(keys, prompts, strict=True) if k not in got), own.add if own else lambda *x: None):
                got[key] = (reply, error)
            if own:
                own.flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([got[k][0] for k in keys], pa.string()), pa.array([got[k][1] for k in keys], pa.string())], names=["key", "reply", "error"])

    return dealt.mapInArrow(run, "key string, reply string, error string")
