"""Packing of token sequences by best-fit decreasing.

Documents longer than a window are first cut into full windows; what is left of each, and
every shorter document, is an item.  Best-fit decreasing puts the items, longest first, each
into the open window with the least room that takes it; a segment tree indexed by room
finds that window.  Items of one length are interchangeable, and so are windows of one room,
so the items of one length go in together: the window found takes ``room // length`` of
them in a row, and all windows that were filled alike stay one run of window numbers.  The
driver thus needs the number of items of each length only, at most ``window`` rows, and its
plan has at most a few runs per length, whatever the number of documents.  A piece finds its
window from its rank among the pieces of its length.  Ranks are counted in the tasks that
encode; a table of counts by task and length shifts them.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from itinera.llm.common import table
from itinera.llm.vocab import BYTE_BPE, ByteLevel, encode, loaded, read_bytes, slices
from itinera.session import work_path

SLICE = 4 << 20                     # bytes of text encoded at a time
PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, task int, rank long"


class RoomTree:
    """Segment tree over rooms 0..n: which are held by at least one open window."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.held = [False] * (2 * self.leaves)

    def put(self, room: int, held: bool) -> None:
        node = room + self.leaves
        self.held[node] = held
        while node := node >> 1:
            self.held[node] = self.held[2 * node] or self.held[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest held room that is at least ``least``."""
        node = least + self.leaves
        if self.held[node]:
            return least
        while node > 1:
            if not node & 1 and self.held[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self.held[2 * node])
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """counts: items of each length from 1 to ``window``.  Returns runs (length, first rank,
    first window, items per window, offset in the window) with ranks ascending in each length.

    Windows of equal room are taken in the order in which they got it.
    """
    open_runs: dict[int, deque[tuple[int, int]]] = defaultdict(deque)   # room -> (first window, windows)
    tree, runs, opened = RoomTree(window), [], 0

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            open_runs[room].append((first, n))
            tree.put(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = window, opened, -(-left // (window // length))
                opened += n
            else:
                first, n = open_runs[room].popleft()
                if not open_runs[room]:
                    tree.put(room, False)
            each = room // length
            full, rest = min(n, left // each), 0
            if full < n:
                rest = left - full * each
                if full + (rest > 0) < n:
                    open_runs[room].appendleft((first + full + (rest > 0), n - full - (rest > 0)))
                    tree.put(room, True)
            if full:
                runs.append((length, rank, first, each, window - room))
                leave(room - each * length, first, full)
            if rest:
                runs.append((length, rank + full * each, first + full, each, window - room))
                leave(room - rest * length, first + full, 1)
            rank += full * each + rest
            left -= full * each + rest
    return runs


def pack(docs: DataFrame, window: int = 1024, path: str = BYTE_BPE, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its whole text and ``end_id``; null and empty texts are the end
    id alone.  A null id stays null, repeated rows are documents of their own, an empty table
    gives no rows; only doc_id and text are read.
    """
    spark = docs.sparkSession
    data = read_bytes(path)

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, task = loaded(ByteLevel, data), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                rows = []
                lists = encode(vocabulary, [t or "" for t in part.column("text").to_pylist()])
                ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4")
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), ends.tolist(), ends[1:].tolist()):
                    ids = np.append(values[a:b], np.uint32(end_id))
                    for start in range(0, len(ids), window):
                        piece = ids[start:start + window]
                        n = len(piece)
                        rows.append((doc_id, start, n, zlib.crc32(piece.tobytes()), len(ids), task, int(seen[n])))
                        seen[n] += 1
                names = [x.strip().split(" ")[0] for x in PIECES.split(",")]
                kinds = [pa.int32() if x.strip().endswith(" int") else pa.int64() for x in PIECES.split(",")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    out = work_path(spark, f"packing-{uuid.uuid4().hex}")
    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces_of, PIECES).write.parquet(out)
    pieces = spark.read.parquet(out)

    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    placed = pieces.join(shift, ["length", "task"])

    plan: dict[int, np.ndarray] = {}
    for length, *run in best_fit_decreasing(counts, window):
        plan.setdefault(length, []).append(run)
    plan = {length: np.array(runs, np.int64) for length, runs in plan.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() + batch.column("shift").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                runs = plan[int(length)]
                starts, first, each, base = runs[np.searchsorted(runs[:, 0], rank[at], "right") - 1].T
                sequence[at] = first + (rank[at] - starts) // each
                offset[at] = base + (rank[at] - starts) % each * length
            keep = {x: batch.column(x) for x in ("doc_id", "start", "ids_crc32", "doc_tokens")}
            yield pa.RecordBatch.from_pydict({**keep, "length": lengths.astype(np.int64),
                                              "sequence_id": sequence, "offset": offset})

    return placed.mapInArrow(place, "doc_id long, start long, ids_crc32 long, doc_tokens long, "
                                    "length long, sequence_id long, offset long")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
