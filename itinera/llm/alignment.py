"""Alignment of the tokens of two vocabularies, and corpus-wide statistics of it.

Each text is encoded by both; token lists are flattened to one table a side, with parent
indices and, by cumulative sums of token bytes within a document, the place where every
token ends.  A full outer Acero hash join of both tables on (document, end) has one row for
every stretch of bytes between two neighbouring ends: exactly one token of each side covers
it, so a row is a link, and rows of both sides close the groups.  ``Table.group_by`` counts
the id pairs of a slice of documents; Spark merges these partial counts.

Two passes: the first writes a row per slice (its documents, their pairs, the slice's
distinct pairs) to the shared folder; corpus-wide counts are then joined to the distinct
pairs of every slice and go back to it.  A slice holds some megabytes of text, or one long
text, and a pair takes part once per slice, so neither common pairs nor many documents make
a large group.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import table
from itinera.llm.vocab import BYTE_BPE, PIECE_BPE, ByteLevel, Pieces, encode, loaded, read_bytes, slices
from itinera.session import work_path

SLICE = 2 << 20                     # bytes of text in one slice
SLICES = ("slice long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, groups_sha256 array<string>, n_pairs array<int>, pair array<int>, times array<int>, "
          "a array<int>, b array<int>, n array<long>")
DOCUMENTS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
             "groups_sha256 string")


def sums_within(values: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """Cumulative sums that start anew with every parent."""
    total = np.cumsum(values)
    first = np.flatnonzero(np.diff(parents, prepend=-1))
    before = np.concatenate([[0], total])[first]
    return total - np.repeat(before, np.diff(np.append(first, len(parents))))


def tokens_of(lists: pa.ListArray, raw: pa.Array, side: str) -> pa.Table:
    """One row per token: its document, the byte at which it ends there, its number and id."""
    ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    sizes = pc.binary_length(raw).take(ids).to_numpy()
    end = sums_within(sizes, parents.to_numpy())
    return pa.table({"doc": parents, "end": pa.array(end, pa.int64()),
                     f"{side}_at": pa.array(np.arange(len(ids))), side: ids})


def spelled(lists: pa.ListArray, raw: pa.Array, texts: list[bytes]) -> list[bool]:
    """Whether the joined bytes of each list are the text's."""
    pieces = raw.take(pc.list_flatten(lists))
    starts = np.concatenate([[0], np.cumsum(pc.binary_length(pieces).to_numpy())])[lists.offsets.to_numpy()].tolist()
    data = memoryview(pieces.buffers()[2] or b"")
    return [bytes(data[x:y]) == t for x, y, t in zip(starts, starts[1:], texts)]


def links_of(a: pa.Table, b: pa.Table) -> pa.Table:
    """doc, end, a_at, a, b_at, b and cut (both sides end here), one row per link, in order."""
    both = a.join(b, ["doc", "end"], join_type="full outer", use_threads=False).sort_by([("doc", "ascending"), ("end", "ascending")])
    closed = pc.and_(pc.is_valid(both["a_at"]), pc.is_valid(both["b_at"]))
    filled = {x: pc.fill_null_backward(both[x].combine_chunks()) for x in ("a_at", "a", "b_at", "b")}
    return pa.table({"doc": both["doc"], "end": both["end"], **filled, "cut": closed})


def group_numbers(links: pa.Table, side: str, n: int) -> np.ndarray:
    """The group, counted over the whole slice, of each of the n tokens of a side."""
    ends = links.filter(links["cut"])[f"{side}_at"].to_numpy()
    return np.searchsorted(ends, np.arange(n))


class GroupText:
    """Writes the groups of a document, ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, n_ids: int):
        self.n = n_ids
        self.words = pa.array([f"{i}{mark}" for mark in ",|;" for i in range(n_ids)], pa.large_string())

    def digests(self, a: pa.Table, b: pa.Table, ga: np.ndarray, gb: np.ndarray, n_docs: int) -> list[str]:
        """sha256 of each document's groups, '' without tokens."""
        n = len(ga) + len(gb)
        at_a = np.arange(len(ga)) + np.searchsorted(gb, ga)               # behind the B tokens of earlier groups
        at_b = np.arange(len(gb)) + np.searchsorted(ga, gb, "right")      # behind the A tokens up to its own
        word, doc = np.empty(n, np.int64), np.empty(n, np.int64)
        for at, ids, g, last, docs in ((at_a, a["a"], ga, 1, a["doc"]), (at_b, b["b"], gb, 2, b["doc"])):
            mark = np.where(np.diff(g, append=-1) != 0, last, 0)
            word[at], doc[at] = ids.to_numpy() + self.n * mark, docs.to_numpy()
        text = self.words.take(pa.array(word))
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(text).to_numpy())])
        cuts = ends[np.searchsorted(doc, np.arange(n_docs + 1))].tolist()
        data = memoryview(text.buffers()[2] or b"")
        return [hashlib.sha256(data[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(cuts, cuts[1:])]


def align_slice(texts: list[str | None], one, two, write: GroupText) -> dict[str, list]:
    """Statistics of a slice; pairs of its documents are numbers into its distinct pairs a, b, n."""
    raws = [b"" if not t else b" " + t.encode() for t in texts]
    la = encode(one, [" " + t if t else "" for t in texts])
    lb = encode(two, [t or "" for t in texts])
    exact = [bool(t) and x and y for t, x, y in zip(raws, spelled(la, one.raw, raws), spelled(lb, two.raw, raws))]
    if not all(exact):
        none = pa.scalar([], pa.list_(pa.int32()))
        la, lb = (pc.if_else(pa.array(exact), x, none) for x in (la, lb))
    a, b = tokens_of(la, one.raw, "a"), tokens_of(lb, two.raw, "b")
    links, m = links_of(a, b), len(texts)
    doc = links["doc"].to_numpy()
    pairs = links.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
    key = lambda t: t["a"].to_numpy().astype(np.int64) << 32 | t["b"].to_numpy()
    order = np.argsort(key(pairs), kind="stable")
    pair = np.searchsorted(key(pairs)[order], key(links))
    mine = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    mine = mine.sort_by([("doc", "ascending"), ("pair", "ascending")])
    per_doc = lambda x: np.bincount(x, minlength=m)
    return {
        "n_a": per_doc(a["doc"].to_numpy()), "n_b": per_doc(b["doc"].to_numpy()), "n_links": per_doc(doc),
        "n_groups": per_doc(doc[links["cut"].to_numpy()]),
        "groups_sha256": write.digests(a, b, group_numbers(links, "a", len(a)), group_numbers(links, "b", len(b)), m),
        "n_pairs": per_doc(mine["doc"].to_numpy()), "pair": mine["pair"].to_numpy(), "times": mine["count_all"].to_numpy(),
        "a": pairs["a"].to_numpy()[order], "b": pairs["b"].to_numpy()[order], "n": pairs["count_all"].to_numpy()[order]}


def align(docs: DataFrame, first: str = BYTE_BPE, second: str = PIECE_BPE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for every row.

    ``first`` is a byte-level vocabulary applied to space and text, ``second`` a piece model.
    Null and empty texts, and those whose tokens spell other bytes than space and text (a
    literal U+2581), have no tokens: zeros and ''.  A null id stays null; repeated rows give
    a row each and count each; an empty table gives none.  Only doc_id and text are read.
    """
    spark = docs.sparkSession
    data = read_bytes(first), read_bytes(second)

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = loaded(ByteLevel, data[0]), loaded(Pieces, data[1])
        write = GroupText(max(len(one.raw), len(two.raw)))
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                row = align_slice(part.column("text").to_pylist(), one, two, write)
                row |= {"slice": number, "doc_id": part.column("doc_id")}
                number += 1
                columns = [x.strip().split(" ") for x in SLICES.split(",")]
                yield pa.RecordBatch.from_arrays([listed(row[name], kind) for name, kind in columns], [x for x, _ in columns])

    path = work_path(spark, f"alignment-{uuid.uuid4().hex}")
    docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pairs_of, SLICES).write.parquet(path)

    here = spark.read.parquet(path).select("slice", F.posexplode(F.arrays_zip("a", "b", "n")).alias("pair", "x")).select("slice", "pair", "x.*")
    counts = here.groupBy("a", "b").agg(F.sum("n").alias("count"))
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    counts = (counts.join(highest, "b")
              .select("a", "b", "count", (F.col("count") == F.col("highest")).cast("long").alias("best")))
    looked_up = here.drop("n").join(counts, ["a", "b"]).select("slice", "pair", "count", "best")

    def documents_of(part: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("pair")
        out = []
        for row in part.to_batches():
            x = {name: row.column(name).flatten() for name in row.schema.names if name != "slice"}
            at, times = x["pair"].to_numpy(), x["times"].to_numpy()
            of = np.repeat(np.arange(len(x["n_pairs"])), x["n_pairs"].to_numpy())
            for name in ("count", "best"):
                sums = np.zeros(len(x["n_pairs"]), np.int64)
                np.add.at(sums, of, known[name].to_numpy()[at] * times)
                x[{"count": "count_sum", "best": "n_best"}[name]] = pa.array(sums)
            out.append(pa.table({name: x[name] for name in (c.strip().split(" ")[0] for c in DOCUMENTS.split(","))}))
        return pa.concat_tables(out)

    found = spark.read.parquet(path).drop("a", "b", "n")
    return found.groupBy("slice").cogroup(looked_up.groupBy("slice")).applyInArrow(documents_of, DOCUMENTS)


def listed(values, kind: str) -> pa.Array:
    """A column of one row: a number, or a list of the Spark type ``kind``."""
    if kind == "long":
        return pa.array([values], pa.int64())
    item = {"array<long>": pa.int64(), "array<int>": pa.int32(), "array<string>": pa.string()}[kind]
    values = values.cast(item) if isinstance(values, pa.Array) else pa.array(values, item)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
