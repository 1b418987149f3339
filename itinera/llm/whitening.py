"""Embedding whitening by incremental eigendecomposition.

Every task keeps mean, eigenvalues and eigenvectors of its own rows' scatter and takes each
row in as a centred rank-one update: the eigenvalues are the roots of a secular equation,
components without a share in the update and repeated eigenvalues are deflated first, and
the update vector is recomputed from the roots so that eigenvectors stay orthonormal.  Two
spectra are combined by the rank-one updates of one's components and of the difference of
their means, in a tree of small groups.  A distributed Rayleigh-Ritz step then projects the
covariance of all rows on the combined basis and solves that, which gives double precision.

State is one matrix of dim x dim a task; the driver sees the last one of each dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import cut, table

FAN_IN = 16                         # partial results merged in one group
STEPS = 44                          # halvings of a root's interval
FURTHEST = 2.0 ** 52                # entries beyond are taken as this, to stay exact
SPECTRA = "dim int, task long, n long, sums array<string>, mean array<double>, values array<double>, vectors array<double>"
MOMENTS = "dim int, task long, n long, first array<double>, second array<double>"
EPS = np.finfo(float).eps


# ---- one task's spectrum --------------------------------------------------------------

def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - x)) for distinct ascending d: the index of the pole
    next to each root, and the root's distance from it."""
    n = len(d)
    right = np.append(d[1:], d[-1] + rho * z2.sum())
    middle = (right - d) / 2

    def value(pole, x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return 1 + rho * (z2 / ((d[None, :] - d[pole][:, None]) - x[:, None])).sum(1)

    own = np.arange(n)
    near = value(own, middle) >= 0               # the function rises from one pole to the next
    near[-1] = True                              # right of the last pole there is no other
    pole = np.where(near, own, np.minimum(own + 1, n - 1))
    low, high = np.where(near, 0.0, -middle), np.where(near, middle, 0.0)
    high[-1] = right[-1] - d[-1]
    for _ in range(STEPS):
        x = (low + high) / 2
        left = value(pole, x) < 0
        low, high = np.where(left, x, low), np.where(left, high, x)
    x = (low + high) / 2
    return pole, np.where(x == 0, np.where(near, 1, -1) * np.finfo(float).tiny, x)


class Spectrum:
    """Mean, eigenvalues (ascending) and eigenvectors (columns) of the scatter of n rows."""

    def __init__(self, dim: int):
        self.n, self.mean = 0, np.zeros(dim)
        self.values, self.vectors = np.zeros(dim), np.eye(dim)

    def update(self, x: np.ndarray, rho: float = 1.0) -> None:
        """Adds rho * x x' to the scatter."""
        z = x @ self.vectors
        weight = rho * float(z @ z)
        if not weight > 0:
            return
        tol = 8 * EPS * max(self.values[-1], weight)
        # repeated values: a reflection leaves the update in the last of them only
        starts = np.flatnonzero(np.append(True, np.diff(self.values) > tol))
        for a, b in zip(starts, np.append(starts[1:], len(z))):
            if b - a > 1 and np.any(z[a:b - 1]):
                v = z[a:b].copy()
                v[-1] += np.copysign(np.linalg.norm(v), v[-1])
                v /= np.linalg.norm(v)
                self.vectors[:, a:b] -= 2 * np.outer(self.vectors[:, a:b] @ v, v)
                z[a:b] -= 2 * (z[a:b] @ v) * v
                z[a:b - 1] = 0
        live = np.flatnonzero(np.sqrt(rho) * np.abs(z) * np.sqrt(weight) > tol)
        if not len(live):
            return
        d, y = self.values[live], z[live]
        pole, x0 = secular_roots(d, y * y, rho)
        gaps = (d[None, :] - d[pole][:, None]) - x0[:, None]          # d_j - root_i
        # the vector that has exactly these roots (Gu and Eisenstat)
        differ = d[:, None] - d[None, :]
        with np.errstate(divide="ignore"):
            other = np.abs(differ) + np.eye(len(d))
            logs = np.log(np.abs(gaps)).sum(0) - np.log(other).sum(0)
        y = np.copysign(np.exp(logs / 2) / np.sqrt(rho), y)
        q = y[None, :] / gaps
        q /= np.linalg.norm(q, axis=1)[:, None]
        self.vectors[:, live] = self.vectors[:, live] @ q.T
        self.values[live] = d[pole] + x0
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = np.maximum(self.values[order], 0), self.vectors[:, order]

    def add(self, x: np.ndarray) -> None:
        """Takes one row in."""
        off = x - self.mean
        self.update(off, self.n / (self.n + 1))
        self.n += 1
        self.mean += off / self.n

    def merge(self, other: Spectrum) -> None:
        """Takes all rows of another spectrum in, by its components."""
        for value, vector in zip(other.values, other.vectors.T):
            self.update(vector, float(value))
        total = self.n + other.n
        off = other.mean - self.mean
        self.update(off, self.n * other.n / total)
        self.mean += off * (other.n / total)
        self.n = total


# ---- distributed steps ----------------------------------------------------------------

def matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """dim, row numbers and rows (as integers in doubles) of the usable vectors of a batch."""
    column = batch.column("vector")
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == dim)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
        fine = np.isfinite(flat).all(1)
        if fine.any():
            with np.errstate(over="ignore"):
                yield dim, rows[fine], np.clip(np.floor(1024 * flat[fine]) + 100000, -FURTHEST, FURTHEST)


def exact_sums(x: np.ndarray) -> list[int]:
    return [sum(map(int, c)) if np.abs(c).max() * len(c) >= 2.0 ** 62 else int(c.astype(np.int64).sum()) for c in x.T]


def merged(parts: DataFrame, merge: Callable[[pd.DataFrame], dict], schema: str) -> DataFrame:
    """One row per dim: ``merge`` over groups of FAN_IN rows, level by level."""
    parts = cut(parts)
    last = parts.agg(F.max("task")).head()[0] or 0

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("task")
        first = {"dim": rows["dim"].iloc[0], "task": rows["task"].iloc[0] // FAN_IN}
        return pd.DataFrame([first | merge(rows)])

    while last > 0:
        parts = (parts.groupBy("dim", F.floor(F.col("task") / FAN_IN).alias("node"))
                 .applyInPandas(lambda rows: group(rows.drop(columns="node", errors="ignore")), schema))
        last //= FAN_IN
    return parts


def merge_spectra(rows: pd.DataFrame) -> dict:
    spectra, sums = [], None
    for r in rows.itertuples():
        s = Spectrum(r.dim)
        s.n, s.mean, s.values = r.n, np.array(r.mean), np.array(r.values)
        s.vectors = np.array(r.vectors).reshape(r.dim, r.dim)
        spectra.append(s)
        sums = [int(x) for x in r.sums] if sums is None else [a + int(x) for a, x in zip(sums, r.sums)]
    whole = spectra[0]
    for s in spectra[1:]:
        whole.merge(s)
    return row_of(whole, sums)


def row_of(s: Spectrum, sums: list[int]) -> dict:
    return {"n": s.n, "sums": [str(x) for x in sums], "mean": s.mean.tolist(), "values": s.values.tolist(),
            "vectors": s.vectors.ravel().tolist()}


def spectra_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, tuple[Spectrum, list[int]]] = {}
    for batch in batches:
        for dim, _, x in matrices(batch):
            spectrum, sums = found.setdefault(dim, (Spectrum(dim), [0] * dim))
            sums[:] = [a + b for a, b in zip(sums, exact_sums(x))]
            for row in x:
                spectrum.add(row)
    task = TaskContext.get().partitionId()
    yield from batches_of([{"dim": dim, "task": task} | row_of(*x) for dim, x in found.items()], SPECTRA)


def moments_of(fits: dict[int, tuple[np.ndarray, np.ndarray]]) -> Callable:
    """Sums and products of all rows, less a centre, projected on a basis: fits has both by dim."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for dim, _, x in matrices(batch):
                centre, basis = fits[dim]
                y = (x - centre) @ basis
                held = found.setdefault(dim, [0, 0.0, 0.0])
                held[0], held[1], held[2] = held[0] + len(y), held[1] + y.sum(0), held[2] + y.T @ y
        task = TaskContext.get().partitionId()
        yield from batches_of([{"dim": dim, "task": task, "n": n, "first": first.tolist(), "second": second.ravel().tolist()}
                               for dim, (n, first, second) in found.items()], MOMENTS)
    return run


def merge_moments(rows: pd.DataFrame) -> dict:
    return {"n": int(rows["n"].sum()), "first": np.sum(np.stack(rows["first"]), axis=0).tolist(),
            "second": np.sum(np.stack(rows["second"]), axis=0).tolist()}


def batches_of(rows: list[dict], schema: str) -> Iterator[pa.RecordBatch]:
    """Arrow rows of a schema given as Spark text; numbers and lists of numbers or strings."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "array<double>": pa.list_(pa.float64()),
             "array<string>": pa.list_(pa.string())}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (x.strip().split(" ") for x in schema.split(","))])
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=fields)


def covariances(vectors: DataFrame, fits: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, np.ndarray]:
    """Covariance of all rows of each dim on its basis, divisor n."""
    out = {}
    for r in merged(vectors.mapInArrow(moments_of(fits), MOMENTS), merge_moments, MOMENTS).collect():
        mean, k = np.array(r["first"]) / r["n"], len(r["first"])
        out[r["dim"]] = np.array(r["second"]).reshape(k, k) / r["n"] - np.outer(mean, mean)
    return out


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for every
    usable row and each of the first ``components`` components.

    Vectors that are null, empty or hold null or non-finite entries give no rows.  Vectors of
    another length have a fit of their own.  Entries count as floor(1024 * c) + 100000, at
    most 2**52 either way.  A component without variance (equal rows, fewer rows than
    components) has null ``whitened`` and no part in identity_error, which is null where
    there is no other; explained is null where no component varies.  deviation is null where
    it exceeds a long.  Null ids stay null; repeated rows count each; an empty table gives
    no rows; other columns are not read.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vector"))
    only = rows.select("vector")
    spectra = merged(only.mapInArrow(spectra_of, SPECTRA), merge_spectra, SPECTRA).collect()
    count = {r["dim"]: r["n"] for r in spectra}
    sums = {r["dim"]: [int(x) for x in r["sums"]] for r in spectra}
    centre = {d: np.array([s / count[d] for s in sums[d]]) for d in sums}
    basis = {r["dim"]: np.linalg.qr(np.array(r["vectors"]).reshape(r["dim"], r["dim"]))[0] for r in spectra}

    fits, explained = {}, {}
    for dim, projected in covariances(only, {d: (centre[d], basis[d]) for d in basis}).items():
        values, turn = np.linalg.eigh((projected + projected.T) / 2)
        values, axes = values[::-1][:components], (basis[dim] @ turn)[:, ::-1][:, :components]
        axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
        trace = float(np.trace(projected))
        varies = values > 64 * EPS * dim * max(trace, EPS * float(centre[dim] @ centre[dim]))
        scale = np.where(varies, 1 / np.sqrt(np.where(varies, values, 1.0)), 0.0)
        fits[dim] = (centre[dim], axes * scale)
        explained[dim] = [(float(v / trace) if varies.any() else None, bool(ok)) for v, ok in zip(values, varies)]
    errors = {}
    for dim, got in covariances(only, fits).items():
        ok = np.array([x for _, x in explained[dim]])
        errors[dim] = float(np.abs(got - np.eye(len(got)))[np.ix_(ok, ok)].max()) if ok.any() else None

    out = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in matrices(batch):
                k, n = len(explained[dim]), count[dim]
                middle, axes = fits[dim]
                white = (x - middle) @ axes
                varies = np.tile([ok for _, ok in explained[dim]], len(x))
                per_row = lambda values: np.repeat(values, k)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(pa.array(per_row(at))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, n, np.int64)),
                    pa.array(deviations(x, n, sums[dim]), pa.int64()).take(pa.array(per_row(np.arange(len(x))))),
                    pa.array(white.ravel(), mask=~varies),
                    pa.array([v for v, _ in explained[dim]] * len(x), pa.float64()),
                    pa.array([errors[dim]] * (len(x) * k), pa.float64())],
                    [c.strip().split(" ")[0] for c in out.split(",")])

    return rows.mapInArrow(apply, out)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """sum((n * x - S)**2) of every row, exactly; None beyond a long."""
    most = max(n * float(np.abs(x).max()), max(map(abs, sums)))
    if most < 2.0 ** 62:
        off = n * x.astype(np.int64) - np.array(sums, np.int64)
        if float(np.abs(off).max()) ** 2 * x.shape[1] < 2.0 ** 62:
            return (off * off).sum(1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return [v if v < 2 ** 63 else None for v in exact]


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
