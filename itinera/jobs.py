"""Restartable batch jobs.

A job is a list of named steps.  Each step's rows are written to a folder of their own, and
only then a marker is appended to the step table; a step with a marker is read back, never
built again, and a folder without one is never read.  A job that was killed anywhere thus
goes on behind its last marker, on the rows that it already committed.  A finished job
starts a new generation when it is run again.

The step table, ``_steps/job=../batch_id=..`` under the root, is the run log as well: every
start, commit, failure and finish is a row with its time, and commits have their row counts.
Everything is read and written by Spark, so any shared file system will do.  One run at a
time works on a batch; different batches may run side by side.
"""

from __future__ import annotations

import datetime as dt
import random
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from itinera.sources.sinks import new_members, number_members, replace_batch
from itinera.sources.targets import Target

EVENTS = ("generation int, seq int, step string, status string, path string, n_rows long, "
          "at timestamp_ntz, note string")
RANGES = "owner string, first_key long, n long, token string"
KEY_MAX = {T.ShortType(): 2 ** 15 - 1, T.IntegerType(): 2 ** 31 - 1, T.LongType(): 2 ** 63 - 1}


def read_if_there(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The table at ``path``, empty where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Job:
    """One run of job ``name`` over one batch; ``root`` holds its tables."""

    def __init__(self, spark: SparkSession, root: str, name: str, batch_id):
        self.spark, self.root, self.name, self.batch_id = spark, root, name, batch_id
        self.events_path = f"{root}/_steps/job={name}/batch_id={batch_id}"
        events = self.events().collect()                       # a few rows per step of one batch
        last = max((e.generation for e in events), default=0)
        over = any(e.generation == last and e.status == "finished" for e in events)
        self.generation = last + 1 if over or not last else last
        mine = [e for e in events if e.generation == self.generation]
        self.seq = max((e.seq for e in mine), default=0)
        self.began = min((e.at for e in mine), default=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self.committed = {e.step: e.path for e in mine if e.status == "committed"}

    @property
    def owner(self) -> str:
        """Names this generation in tables that several batches share."""
        return f"{self.name}-{self.batch_id}-{self.generation}"

    def events(self) -> DataFrame:
        return read_if_there(self.spark, self.events_path, EVENTS)

    def log(self, step: str, status: str, path: str | None = None, n_rows: int | None = None,
            note: str | None = None) -> None:
        """Appends one row to the step table; it is there once its file is."""
        self.seq += 1
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) if self.seq > 1 else self.began
        row = (self.generation, self.seq, step, status, path, n_rows, now, note)
        self.spark.createDataFrame([row], EVENTS).coalesce(1).write.mode("append").parquet(self.events_path)

    def step(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The rows of a step: built and committed, or read back."""
        if name not in self.committed:
            path = f"{self.root}/_work/{self.owner}/{name}-{uuid.uuid4().hex}"
            self.log(name, "started")
            try:
                build().write.parquet(path)
                n = self.spark.read.parquet(path).count()
            except Exception as e:
                self.log(name, "failed", note=type(e).__name__)
                raise
            self.log(name, "committed", path, n)
            self.committed[name] = path
        return self.spark.read.parquet(self.committed[name])

    def publish(self, table: str, step: str, batch_col: str, rows: DataFrame | None = None,
                target: Target | None = None) -> DataFrame:
        """Replaces the batch of a table by the committed rows of a step (or what ``rows``
        makes of them), once per generation, in the shape of ``target``: a row is stamped with
        the time at which its generation began, so a repeated write stamps it alike."""
        path, name = f"{self.root}/{table}", f"publish {table}"
        if name not in self.committed:
            self.log(name, "started")
            df = rows if rows is not None else self.spark.read.parquet(self.committed[step])
            if batch_col not in df.columns:
                df = df.withColumn(batch_col, F.lit(self.batch_id))
            if target is not None:
                df = target.shape(df, self.name, self.began)
            replace_batch(df, path, batch_col, self.batch_id)
            self.log(name, "committed", path)
            self.committed[name] = path
        return self.spark.read.parquet(path).where(F.col(batch_col) == F.lit(self.batch_id))

    def finish(self) -> None:
        self.log("", "finished")

    # ---- dimensions ---------------------------------------------------------------------

    def members(self, dim: str, candidates: Callable[[], DataFrame], natural_keys: Sequence[str], key_col: str,
                seed: DataFrame, derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """The stored dimension ``dim`` after all candidates are members of it.

        ``seed`` has its columns, and its members while nothing is stored yet; ``derive``
        adds the columns that follow from the natural keys.  New members are committed
        first, then a key range is reserved for them and committed with them, and only then
        they join the stored table, in a part that this generation owns: whatever step is
        repeated, a key never gets a second meaning.  Facts take keys from the result, that
        is from members that are stored.
        """
        path = f"{self.root}/{dim}"
        schema = T.StructType([*seed.schema.fields, T.StructField("loaded_by", T.StringType())])
        if read_if_there(self.spark, path, schema).where("loaded_by = 'seed'").isEmpty() and not seed.isEmpty():
            replace_batch(seed.withColumn("loaded_by", F.lit("seed")), path, "loaded_by", "seed")

        def stored() -> DataFrame:
            return read_if_there(self.spark, path, schema).select(*seed.columns)

        def keyed() -> DataFrame:
            new = self.step(f"{dim} candidates", lambda: new_members(candidates(), stored(), natural_keys))
            n = new.count()
            top = stored().agg(F.max(key_col)).first()[0] or 0
            first = reserve_keys(self.spark, f"{path}_ranges", self.owner, n, top + 1)
            kind = seed.schema[key_col].dataType
            if first + n - 1 > KEY_MAX[kind]:
                raise OverflowError(f"{n} new members of {dim} from {first} on do not fit {kind.simpleString()}")
            return derive(number_members(new, natural_keys, key_col, first, kind)).select(*seed.columns)

        new = self.step(f"{dim} members", keyed)
        name = f"store {dim}"
        if name not in self.committed:
            replace_batch(new.withColumn("loaded_by", F.lit(self.owner)), path, "loaded_by", self.owner)
            self.log(name, "committed", path, new.count())
            self.committed[name] = path
        return stored()


def reserve_keys(spark: SparkSession, path: str, owner: str, n: int, least: int) -> int:
    """First key of a range of ``n`` that belongs to ``owner`` alone, at or above ``least``.

    Ranges are rows appended to a table; the same owner gets its range of the same size
    again.  Two loads may reserve at once: each reads the table after its own row is
    written, and one that sees another's range over its own gives it up and takes a new one.
    """
    while True:
        rows = read_if_there(spark, path, RANGES).collect()    # one row per load that had new members
        if n == 0:
            return least
        for r in rows:
            if r.owner == owner and r.n == n and not any(overlap(r, x) for x in rows):
                return r.first_key
        first = max([least, *(r.first_key + r.n for r in rows)])
        spark.createDataFrame([(owner, first, n, uuid.uuid4().hex)], RANGES).coalesce(1).write.mode("append").parquet(path)
        rows = read_if_there(spark, path, RANGES).collect()
        mine = next(r for r in rows if r.owner == owner and r.first_key == first and r.n == n)
        if not any(overlap(mine, r) for r in rows):
            return first
        time.sleep(random.random())


def overlap(a, b) -> bool:
    return a.token != b.token and a.first_key < b.first_key + b.n and b.first_key < a.first_key + a.n
