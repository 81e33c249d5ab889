"""Rows into a store outside of Spark, each micro-batch once, by Spark's two-step commit.

Tasks stage their rows under a token of their own, which nobody reads. When all tasks of a micro-batch are done, the driver publishes their tokens in one
step, under the number of the run and the batch. A task that is tried again leaves a token that is not published; a batch that is run again after it was
published finds that, and drops what it has staged. So a row is there once, whatever fails.

A store is any class with the four methods of ``FileStore``; for a database, ``stage`` inserts under the token and ``publish`` writes the tokens and the
batch's number in one transaction.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import Row, StructType

from kpitide.streaming.jobs import start
from kpitide.streaming.store import run_number

SOURCE = "kpitide_once"


def _plain(value):
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return str(value)
    raise TypeError(f"cannot store {type(value).__name__}")


class FileStore:
    """A store in a folder that all executors reach as files: JSON lines per token, and a list of tokens per published batch."""

    def __init__(self, path: str):
        self.path = path

    def _at(self, *names: str) -> str:
        at = os.path.join(self.path, *names)
        os.makedirs(os.path.dirname(at), exist_ok=True)
        return at

    def stage(self, token: str, rows: Iterable[Row]) -> int:
        """Keep the rows of a task where no reader sees them; their number."""
        n = 0
        with open(self._at("staged", token), "w") as out:
            for n, row in enumerate(rows, 1):
                out.write(json.dumps(row.asDict(recursive=True), default=_plain) + "\n")
            out.flush()
            os.fsync(out.fileno())
        return n

    def publish(self, batch: str, tokens: list[str]) -> bool:
        """Make the rows of a batch visible in one step. False if the batch was published before."""
        done = self._at("batches", batch)
        draft = self._at("drafts", uuid.uuid4().hex)
        with open(draft, "w") as out:
            json.dump(tokens, out)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(draft, done)  # fails if it is there; a reader never sees a part of it
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)

    def discard(self, tokens: list[str]) -> None:
        for token in tokens:
            at = self._at("staged", token)
            if os.path.exists(at):
                os.unlink(at)

    def rows(self) -> Iterator[dict]:
        """The published rows."""
        folder = os.path.join(self.path, "batches")
        for batch in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
            with open(os.path.join(folder, batch)) as f:
                tokens = json.load(f)
            for token in tokens:
                with open(os.path.join(self.path, "staged", token)) as f:
                    yield from map(json.loads, f)


@dataclass
class Staged(WriterCommitMessage):
    token: str
    n: int


class OnceWriter(DataSourceStreamWriter):
    def __init__(self, connect: Callable[[], FileStore], run: int):
        self.connect = connect
        self.run = run

    def write(self, iterator: Iterator[Row]) -> Staged:
        token = uuid.uuid4().hex
        store = self.connect()
        try:
            return Staged(token, store.stage(token, iterator))
        except BaseException:
            store.discard([token])
            raise

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        tokens = sorted(m.token for m in messages if m is not None)
        store = self.connect()
        if not store.publish(f"{self.run}.{batchId}", tokens):
            store.discard(tokens)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self.connect().discard([m.token for m in messages if m is not None])


def once_source(connect: Callable[[], FileStore]) -> type[DataSource]:
    """A sink to register with Spark, for stores that ``connect`` makes; tasks and the driver call it."""

    class Once(DataSource):
        @classmethod
        def name(cls) -> str:
            return SOURCE

        def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
            return OnceWriter(connect, int(self.options["run"]))

    return Once


def once_stream(rows: DataFrame, connect: Callable[[], FileStore], runs: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """The rows of a stream into a store, each once. ``runs`` is a shared folder in which runs of the job are numbered."""
    spark = rows.sparkSession
    spark.dataSource.register(once_source(connect))
    writer = rows.writeStream.format(SOURCE).option("run", run_number(spark, runs, checkpoint))
    return start(writer, checkpoint, every)
