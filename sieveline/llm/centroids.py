"""Exact Lloyd rounds over integer vectors with heap-ordered bounds.

Every vector has an upper bound of the distance to its own centroid and a lower one of
the distance to the second nearest. Instead of updating both for each vector in each
round, a cluster keeps a heap of the gaps between them, offset by the drift the cluster
had accumulated when a gap was entered: per round the accumulated drift grows by how far
its own centroid moved and the farthest move of any other. A vector whose entry is above
the accumulated drift surely stays; only those whose gap expires are popped, compared
exactly with all centroids, and entered again.

Vectors lie in blocks of ``BLOCK`` rows, one table row each, with the heaps of their
clusters (arrays in ascending order, which is a heap: the expired are its front).
A round is a pass over the blocks without a shuffle; besides its new state each block
returns the exact change of the sums and counts of its clusters, which Spark adds up to one
row per cluster and component. Nothing else reaches the driver, and a cluster that holds
a third of all vectors is as many heaps as there are blocks. Each round's blocks are
stored in the shared folder, so a lost executor costs its tasks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sieveline.functions.predicates import quoted
from sieveline.llm.common import map_batches
from sieveline.shared import delete_folder, new_folder

CLUSTERS, ROUNDS, WIDTH, SCALE, SEED = 16, 3, 64, 64, "1"
#: Vectors of a block.
BLOCK = 8192
#: Integer components are held within this bound, so that no squared distance leaves 64 bits.
MOST = 1 << 27
#: Components up to which float64 holds every squared distance exactly.
EXACT = 1 << 22


def integers(vectors: DataFrame, id_column: str, vector_column: str, width: int, scale: int) -> DataFrame:
    """``(vec_id, x)``: the vectors with exactly ``width`` finite components, each made
    the integer floor(scale * x)."""
    rows = vectors.select(quoted(id_column).alias("vec_id"), quoted(vector_column).cast("array<double>").alias("v"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    whole = lambda c: F.floor(F.least(F.greatest(c * F.lit(float(scale)), F.lit(-float(MOST))), F.lit(float(MOST)))).cast("int")
    kept = rows.where((F.size("v") == width) & F.forall("v", finite))
    return kept.select("vec_id", F.transform("v", whole).alias("x"))


def first_centroids(kept: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors with the smallest hashes of ``seed:vec_id``, in that order. Of equal
    ids the smaller vector comes first; rows without an id are never a centroid."""
    hashed = kept.where("vec_id IS NOT NULL").select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "x")
    rows = hashed.orderBy("h", "x").limit(clusters).collect()
    return np.array([r["x"] for r in rows], np.int64)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT // x.shape[1]:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None]).astype(np.int64)
    return np.stack([((x.astype(np.int64) - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def rescanned(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, the smaller number among equally near ones, and
    the gap to the second nearest."""
    far = squared(x, centroids)
    own = far.argmin(axis=1)
    if len(centroids) == 1:
        return own, np.full(len(x), np.inf)
    two = np.sqrt(np.partition(far, 1, axis=1)[:, :2].astype(np.float64))
    return own, two[:, 1] - two[:, 0]


@dataclass
class Heaps:
    """The vectors of a block by cluster, each cluster's in ascending order of their
    entries: the gap at their last scan plus the drift accumulated until then."""

    own: np.ndarray  # cluster of each row
    entries: np.ndarray  # in heap order
    rows: np.ndarray
    ends: np.ndarray  # where each cluster's heap ends

    @staticmethod
    def empty(n: int, clusters: int) -> Heaps:
        return Heaps(np.zeros(n, np.int32), np.empty(0), np.empty(0, np.int32), np.zeros(clusters, np.int64))

    def heap(self, cluster: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.ends[cluster - 1] if cluster else 0, self.ends[cluster])
        return self.entries[part], self.rows[part]

    def pop(self, drift: np.ndarray, slack: float) -> np.ndarray:
        """Take out the rows whose entries are not above their cluster's drift."""
        out, entries, rows, ends = [], [], [], []
        for c in range(len(self.ends)):
            e, r = self.heap(c)
            n = int(np.searchsorted(e, drift[c] + slack, side="right"))
            out.append(r[:n])
            entries.append(e[n:])
            rows.append(r[n:])
            ends.append(len(e) - n)
        self.entries, self.rows, self.ends = np.concatenate(entries), np.concatenate(rows), np.cumsum(ends)
        return np.concatenate(out)

    def push(self, rows: np.ndarray, gaps: np.ndarray, drift: np.ndarray) -> None:
        """Enter rows into the heaps of their clusters."""
        entries = np.concatenate((self.entries, gaps + drift[self.own[rows]]))
        rows = np.concatenate((self.rows, rows.astype(np.int32)))
        order = np.lexsort((entries, self.own[rows]))
        self.entries, self.rows = entries[order], rows[order]
        self.ends = np.cumsum(np.bincount(self.own[rows], minlength=len(self.ends)))


def _sums(x: np.ndarray, own: np.ndarray, clusters: int) -> np.ndarray:
    """Count and component sums of each cluster."""
    total = np.zeros((clusters, 1 + x.shape[1]), np.int64)
    for c in range(clusters):
        part = x[own == c]
        total[c, 0] = len(part)
        total[c, 1:] = part.sum(axis=0, dtype=np.int64)
    return total


_STATE = "x binary, width int, own binary, entries binary, rows binary, ends binary, changes array<bigint>, scanned bigint"
_NAMES = ["vec_ids", *[c.split()[0] for c in _STATE.split(", ")]]


def _row(ids: pa.Array, x: np.ndarray, heaps: Heaps, changes: np.ndarray, scanned: int) -> pa.RecordBatch:
    small = next(t for t in (np.int8, np.int16, np.int32) if not x.size or np.iinfo(t).min <= x.min() and x.max() <= np.iinfo(t).max)
    packed = x.astype(small)
    parts = [packed, heaps.own.astype(np.int32), heaps.entries.astype(np.float64), heaps.rows.astype(np.int32), heaps.ends.astype(np.int64)]
    raw = [pa.array([p.tobytes()], pa.binary()) for p in parts]
    listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    numbers = [pa.array([changes.reshape(-1)], pa.list_(pa.int64())), pa.array([scanned], pa.int64())]
    return pa.RecordBatch.from_arrays([listed, raw[0], pa.array([packed.itemsize], pa.int32()), *raw[1:], *numbers], _NAMES)


def _unpacked(batch: pa.RecordBatch, width: int) -> Iterator[tuple[pa.Array, np.ndarray, Heaps]]:
    """The blocks of a batch."""
    for i in range(batch.num_rows):
        of = {name: batch.column(name)[i] for name in _NAMES if name in batch.schema.names}
        kind = {1: np.int8, 2: np.int16, 4: np.int32}[of["width"].as_py()]
        x = np.frombuffer(of["x"].as_buffer(), kind).reshape(-1, width)
        sides = (np.frombuffer(of[name].as_buffer(), t).copy() for name, t in (("own", np.int32), ("entries", np.float64), ("rows", np.int32), ("ends", np.int64)))
        yield of["vec_ids"].values, x, Heaps(*sides)


def blocks(kept: DataFrame, centroids: np.ndarray, width: int, block: int) -> DataFrame:
    """The first assignment: every vector is compared with all centroids and entered into
    the heap of its cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0

        def made() -> Iterator[pa.RecordBatch]:
            ids = pa.concat_arrays([b.column("vec_id") for b in waiting])
            x = np.concatenate([b.column("x").flatten().to_numpy(zero_copy_only=False) for b in waiting]).reshape(-1, width)
            for start in range(0, len(ids), block):
                part = x[start : start + block]
                own, gaps = rescanned(part, centroids)
                heaps = Heaps.empty(len(part), len(centroids))
                heaps.own = own.astype(np.int32)
                heaps.push(np.arange(len(part)), gaps, np.zeros(len(centroids)))
                yield _row(ids[start : start + block], part, heaps, _sums(part, own, len(centroids)), len(part))
            waiting.clear()

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                size += batch.num_rows
            if size >= block:
                yield from made()
                size = 0
        if waiting:
            yield from made()

    kind = kept.schema["vec_id"].dataType.simpleString()
    return map_batches(kept, run, f"vec_ids array<{kind}>, {_STATE}")


def reassigned(state: DataFrame, centroids: np.ndarray, drift: np.ndarray, width: int) -> DataFrame:
    """The blocks after a round: expired vectors are popped, compared with all
    centroids and entered again; ``changes`` holds what that adds to the clusters' sums."""
    clusters = len(centroids)
    # Square roots and sums of some rounds are off by less than this.
    slack = 1e-9 * (1 + float(np.abs(centroids).max(initial=0)) * width + float(drift.max(initial=0))) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, heaps in _unpacked(batch, width):
                expired = heaps.pop(drift, slack)
                moved = x[expired]
                before = heaps.own[expired]
                own, gaps = rescanned(moved, centroids) if len(expired) else (before, np.empty(0))
                heaps.own[expired] = own
                heaps.push(expired, gaps, drift)
                yield _row(ids, x, heaps, _sums(moved, own, clusters) - _sums(moved, before, clusters), len(expired))

    return map_batches(state.select(*_NAMES[:7]), run, state.schema)


def summed(state: DataFrame, column: str, shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all blocks of an array of fixed length."""
    rows = state.select(F.posexplode(column).alias("place", "value")).groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).collect()
    total = np.zeros(int(np.prod(shape)), object)
    for r in rows:
        total[r["place"]] = int(r["s"])
    return total.reshape(shape)


def moved(centroids: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Each centroid with vectors at the componentwise floor of their mean."""
    means = [[int(v) // int(row[0]) for v in row[1:]] if row[0] else list(old) for row, old in zip(total, centroids)]
    return np.array(means, np.int64).reshape(centroids.shape)


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How much the gaps of each cluster can have shrunk: how far its centroid moved and
    the farthest move of any other."""
    far = np.sqrt(((old - new).astype(np.float64) ** 2).sum(axis=1))
    others = np.array([np.delete(far, c).max(initial=0.0) for c in range(len(far))])
    return far + others


@dataclass
class Run:
    """The folders of one clustering and how many vectors each round compared with all
    centroids."""

    folders: list[str]
    scanned: list[int]


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: str = SEED,
    block: int = BLOCK,
    run: Run | None = None,
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)``, one row
    for each vector kept: its cluster after ``rounds`` rounds and a last assignment, the
    squared distance to its centroid, the sum of these over its cluster and over all,
    and the digest of the centroid's components.

    A vector of another length, or with a null or non-finite component, is left out, so an
    empty table gives an empty one. Equally near centroids: the smaller number. Repeated
    ids and vectors are rows of their own. Rows with a null id are clustered but never start
    a centroid; if there is no id at all, the result is empty. With fewer vectors than
    ``clusters``, all are centroids. Integer components beyond ``MOST`` are held there.
    Other columns are left behind.
    """
    spark = vectors.sparkSession
    run = Run([], []) if run is None else run
    kept = integers(vectors, id_column, vector_column, width, scale)
    kind = kept.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        schema = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], schema)

    def stored(df: DataFrame) -> DataFrame:
        """Each round's blocks replace those of the round before."""
        folder = new_folder(spark, "blocks")
        df.write.parquet(folder)
        run.folders.append(folder)
        if len(run.folders) > 1:
            delete_folder(spark, run.folders.pop(0))
        state = spark.read.schema(df.schema).parquet(folder)
        run.scanned.append(state.agg(F.sum("scanned")).first()[0] or 0)
        return state

    shape = (len(centroids), 1 + width)
    state = stored(blocks(kept, centroids, width, block))
    total = summed(state, "changes", shape)
    drift = np.zeros(len(centroids))
    for _ in range(rounds):
        new = moved(centroids, total)
        drift = drift + drifts(centroids, new)
        centroids = new
        state = stored(reassigned(state, centroids, drift, width))
        total = total + summed(state, "changes", shape)
    return _result(state, centroids, kind, width)


def _result(state: DataFrame, centroids: np.ndarray, kind: str, width: int) -> DataFrame:
    """A row for each vector of the blocks."""
    ends = list(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x, heaps in _unpacked(batch, width):
                far = ((x.astype(np.int64) - centroids[heaps.own]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([ids.cast(id_type), pa.array(heaps.own, pa.int32()), pa.array(far, pa.int64())], ["vec_id", "cluster", "distance"])

    id_type = to_arrow_type(state.schema["vec_ids"].dataType.elementType)
    rows = map_batches(state.select(*_NAMES[:7]), run, f"vec_id {kind}, cluster int, distance bigint")
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in ends]
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    return rows.select(
        "vec_id",
        "cluster",
        "distance",
        of([_long(sums.get(c, 0)) for c in range(len(ends))]).alias("cluster_inertia"),
        _long(sum(sums.values())).alias("inertia"),
        of([F.lit(h) for h in hashes]).alias("centroid_sha256"),
    )


def _long(value: int) -> Column:
    """A sum as a long; null if it is none."""
    return F.lit(value if value < 1 << 63 else None).cast("bigint")
