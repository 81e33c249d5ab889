"""A keyed table kept as the rows of each micro-batch and a base that older batches are folded into."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpitide.sources.folders import Folders

NO_BATCH = -1
SEED_BATCH = -2  # of the first run: rows to start from
EMPTY_BASE = -3
FIRST_RUN = 0


def run_number(spark: SparkSession, path: str, checkpoint: str) -> int:
    """Number of the run a checkpoint belongs to; a new one if the checkpoint is new.

    Batch numbers start again with a new checkpoint, so they only mean something beside the number of the run. The number is kept
    with the checkpoint and, so that none is given twice, below ``path``.
    """
    kept = [n for n in Folders(spark, checkpoint).names("run") if n.startswith("number=")]
    if kept:
        return int(kept[0].removeprefix("number="))
    taken = [int(n.removeprefix("number=")) for n in Folders(spark, path).names("runs") if n.startswith("number=")]
    number = max(taken, default=FIRST_RUN - 1) + 1
    for at in (f"{path.rstrip('/')}/runs", f"{checkpoint.rstrip('/')}/run"):
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{at}/number={number}")
    return number


class BatchStore:
    """The rows of a keyed table, by run and micro-batch, under a path all executors share. What a key's rows come to is up to ``_merged``.

    Spark may run a micro-batch again after a failure. It has the same id then and replaces its own folder, so nothing
    is stored twice. A job that starts without its checkpoint is a new run (``begin``) whose batches stand beside the old ones.

    ``compact`` merges the base before, the batches up to one that is done, and all earlier runs, into a new base, which counts only once an
    entry that is written last names it. The folders it has merged are deleted by the compaction after it, when
    nothing that reads from the base before can be running any more.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.types = {f.name: f.dataType for f in schema.fields if f.name not in keys}
        self.schema = T.StructType([*schema.fields, T.StructField("write_time", T.TimestampType())])
        self.run = FIRST_RUN
        self.folders = Folders(spark, self.path)

    def _merged(self, entries: DataFrame) -> DataFrame:
        """One row per key, with all stored columns, from the base and later batches."""
        raise NotImplementedError

    def _read(self, kind: str, *version: str) -> DataFrame:
        schema = T.StructType([*self.schema.fields, *[T.StructField(v, T.LongType()) for v in version]])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}")

    def _empty(self) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def _stored(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])

    def create(self):
        """Write the empty table, unless there is one."""
        if not self.folders.names("compacted"):
            self._empty().write.mode("ignore").parquet(f"{self.path}/batches/run={FIRST_RUN}/batch_id={NO_BATCH}")
            self._write_base(self._empty(), FIRST_RUN, EMPTY_BASE)
        return self

    def begin(self, checkpoint: str):
        """Count the batches of this checkpoint as a run of their own."""
        self.run = run_number(self.spark, self.path, checkpoint)
        base = self._base_version()
        if self.run < base[0]:
            raise ValueError(f"run {self.run} ended when run {base[0]} began")
        return self

    def has_batches(self) -> bool:
        """Whether anything was ever stored: a base, a seed or a batch."""
        stored = [f"batches/{r}/{b}" for r in self.folders.names("batches") for b in self.folders.names(f"batches/{r}")]
        whole = [at for at in stored if "_SUCCESS" in self.folders.names(at) and not at.endswith(f"={NO_BATCH}")]
        return bool(whole) or self._base_version() > (FIRST_RUN, EMPTY_BASE)

    def put(self, rows: DataFrame, batch_id: int, write_time: Column | None = None) -> None:
        """Store the rows of one micro-batch of this run, replacing what an earlier try of it left."""
        time = F.current_timestamp() if write_time is None else write_time
        stored = self._stored(rows.withColumn("write_time", time))
        stored.write.mode("overwrite").parquet(f"{self.path}/batches/run={self.run}/batch_id={batch_id}")

    def _write_base(self, rows: DataFrame, run: int, upto: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/base/run={run}/upto={upto}")
        # Written after the base it names, so a base cut short by a failure is never read.
        self.spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/compacted/{run}.{upto}")

    def _bases(self) -> list[tuple[int, int]]:
        # An entry counts once it is whole.
        found = [n.split(".") for n in self.folders.names("compacted") if "_SUCCESS" in self.folders.names(f"compacted/{n}")]
        return sorted((int(run), int(upto)) for run, upto in found)

    def _base_version(self) -> tuple[int, int]:
        return self._bases()[-1]

    def entries(self, before: int | None = None) -> DataFrame:
        """Base and later batches; of this run only the batches before ``before``, if it is given."""
        run, upto = self._base_version()
        if before is not None and (self.run, before) <= (run, upto):
            raise ValueError(f"batches up to {upto} of run {run} are compacted; cannot read the state before {before}")
        after = (F.col("run") > run) | ((F.col("run") == run) & (F.col("batch_id") > upto))
        batches = self._read("batches", "run", "batch_id").where(after)
        if before is not None:
            batches = batches.where((F.col("run") != self.run) | (F.col("batch_id") < before))
        folded = self._read("base", "run", "upto").where((F.col("run") == run) & (F.col("upto") == upto))
        return folded.drop("run", "upto").unionByName(batches.drop("run", "batch_id"))

    def batches(self) -> DataFrame:
        """The rows of batches that are not merged and deleted, with ``run`` and ``batch_id``, for views of the single batches."""
        return self._read("batches", "run", "batch_id").where(F.col("batch_id") > NO_BATCH)

    def compact(self, upto: int) -> None:
        """Merge the base, the batches of this run up to ``upto``, and all of the runs before, into a new base.

        Only batches that Spark has committed may be merged: all but the one that is running.
        """
        old = self._bases()
        if (self.run, upto) <= old[-1]:
            if len(old) > 1:  # a try before this one may have ended before it had deleted all
                self._clear(old[:-1])
            return
        self._write_base(self._stored(self._merged(self.entries(before=upto + 1))), self.run, upto)
        self._clear(old)

    def after_batch(self, batch_id: int, every: int | None) -> None:
        """Compact what is done, after every so many batches."""
        if every and batch_id and batch_id % every == 0:
            self.compact(batch_id - 1)

    def _clear(self, old: list[tuple[int, int]]) -> None:
        """Delete what the base before the newest had merged, and the bases before that one."""
        run, upto = old[-1]
        for base in old[:-1]:
            self.folders.drop(f"compacted/{base[0]}.{base[1]}")
            self.folders.drop(f"base/run={base[0]}/upto={base[1]}")
        for folder in self.folders.names("batches"):
            of_run = int(folder.removeprefix("run="))
            for name in self.folders.names(f"batches/{folder}") if of_run <= run else []:
                batch = int(name.removeprefix("batch_id=")) if name.startswith("batch_id=") else NO_BATCH
                if batch != NO_BATCH and (of_run, batch) <= (run, upto):
                    self.folders.drop(f"batches/{folder}/{name}")


class WholeResults:
    """A result that each micro-batch replaces as a whole, by run and batch; the newest few stay.

    Batch ids start again with a new checkpoint, so the newest result is that of the newest run. Only results that are written to the end are read.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keep = keep
        self.run = FIRST_RUN
        self.folders = Folders(spark, self.path)

    def begin(self, checkpoint: str) -> WholeResults:
        self.run = run_number(self.spark, self.path, checkpoint)
        return self

    def versions(self) -> list[tuple[int, int]]:
        found = []
        for run in self.folders.names("results"):
            for batch in self.folders.names(f"results/{run}"):
                if "_SUCCESS" in self.folders.names(f"results/{run}/{batch}"):
                    found.append((int(run.removeprefix("run=")), int(batch.removeprefix("batch_id="))))
        return sorted(found)

    def _at(self, version: tuple[int, int]) -> str:
        return f"results/run={version[0]}/batch_id={version[1]}"

    def put(self, result: DataFrame, batch_id: int) -> None:
        """Store the result after a micro-batch of this run, in place of an earlier try's; then drop the oldest."""
        result.write.mode("overwrite").parquet(f"{self.path}/{self._at((self.run, batch_id))}")
        for version in self.versions()[: -self.keep]:
            self.folders.drop(self._at(version))

    def newest(self) -> DataFrame:
        """The result after the last micro-batch of the newest run."""
        return self.spark.read.parquet(f"{self.path}/{self._at(self.versions()[-1])}")

    def all(self) -> DataFrame:
        """The results that stay, with ``run`` and ``batch_id``."""
        return self.spark.read.parquet(f"{self.path}/results")
