"""Centroid clustering with heap-ordered bounds.

Vectors lie in blocks of a few thousand, one row each. Inside a block every cluster
keeps a heap of its vectors, ordered by gap: the distance to the second nearest
centroid less that to the own one, as they were when the vector was last compared with
all centroids. When centroids move, a cluster's gaps shrink by at most its own drift
plus the largest drift of another. Instead of touching every gap, a cluster adds that
to an offset, and a vector's key in the heap is its gap plus the offset at its entry.
So only vectors whose key is no longer above the offset can have got a nearer centroid
(or an equally near one of a smaller number): these are popped, compared exactly with
all centroids, and pushed anew. All others stay where they are, unread.

Components are integers, distances and sums are exact; the bounds are rounded so that
they err towards popping. A round adds up, per cluster, what has joined and left, and
the driver gets those sums: k times (dimensions + 1) numbers. Each round writes the
blocks with their heaps to the shared folder, where the next one reads them.

Nulls and odd rows: a vector that is null, has another number of components, or holds
a null, NaN or infinity is left out; rows that share a vec_id, and equal vectors, count
each on its own; a null vec_id is kept and its hash is that of ``<seed>:null``; with fewer
vectors than clusters there are as many clusters as vectors; without any there are no
rows. A component of 2**27 or more after scaling is an error.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.base import materialise, read, ship

BLOCK = 4096
_LIMIT = 1 << 27
_SLACK = 1e-11  # relative, many times the rounding of a double

_STATE = "ids array<long>, width int, data binary, keys binary, members binary, sizes array<int>"
_STATE_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("width", pa.int32()), ("data", pa.binary()),
                          ("keys", pa.binary()), ("members", pa.binary()), ("sizes", pa.list_(pa.int32()))])


def kept_vectors(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding",
                 dims: int = 64) -> DataFrame:
    """(k, e): the vectors with ``dims`` finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.where((F.size(vector) == dims) & fine)
            .select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("e")))


def scaled(values: np.ndarray, scale: int) -> np.ndarray:
    out = np.floor(scale * values)
    if out.size and np.abs(out).max() >= _LIMIT:
        raise ValueError(f"a component of {_LIMIT} or more after scaling by {scale}")
    return out.astype(np.int64)


def first_centroids(kept: DataFrame, dims: int, k: int, seed: int, scale: int) -> np.ndarray:
    """The ``k`` vectors of least hash, in the order of their hashes."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("k").cast("string"), F.lit("null"))), 256)
    rows = kept.select(name.alias("h"), "e").orderBy("h", "e").limit(k).collect()
    return scaled(np.array([r["e"] for r in rows], np.float64).reshape(len(rows), dims), scale)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, (vectors, centroids)."""
    most = max(np.abs(vectors).max(initial=1), np.abs(centroids).max(initial=1))
    if 4 * vectors.shape[1] * int(most) ** 2 < 1 << 53:  # a double holds every sum
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    return ((vectors[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the gap to the second."""
    d = distances(vectors, centroids)
    own = d.argmin(axis=1)
    at = np.arange(len(d))
    upper = np.sqrt(d[at, own].astype(np.float64))
    d[at, own] = np.iinfo(np.int64).max
    if d.shape[1] == 1:
        return own, np.full(len(d), np.inf)
    lower = np.sqrt(d.min(axis=1).astype(np.float64))
    return own, lower * (1 - _SLACK) - upper * (1 + _SLACK)


def drift(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What a round takes from the gaps of each cluster, at most: its centroid's own
    move and the longest move of another."""
    own = np.sqrt(((after - before) ** 2).sum(axis=1).astype(np.float64)) * (1 + _SLACK)
    if len(own) == 1:
        return own
    order = np.argsort(own)
    others = np.full(len(own), own[order[-1]])
    others[order[-1]] = own[order[-2]]
    return own + others


class Heaps:
    """The heaps of one block: per cluster (key, vector) pairs."""

    def __init__(self, lists: list[list[tuple[float, int]]]):
        self.lists = lists

    @classmethod
    def read(cls, keys: bytes, members: bytes, sizes: list[int]) -> "Heaps":
        k, m = np.frombuffer(keys, "<f8").tolist(), np.frombuffer(members, "<i4").tolist()
        lists, at = [], 0
        for n in sizes:
            lists.append(list(zip(k[at:at + n], m[at:at + n])))
            at += n
        return cls(lists)

    def written(self) -> tuple[bytes, bytes, list[int]]:
        every = [e for one in self.lists for e in one]
        return (np.array([e[0] for e in every], "<f8").tobytes(),
                np.array([e[1] for e in every], "<i4").tobytes(), [len(one) for one in self.lists])

    def expired(self, offsets: np.ndarray) -> tuple[list[int], list[int]]:
        """Pop the vectors whose gap has run out: (their clusters, they)."""
        clusters, vectors = [], []
        for c, (heap, offset) in enumerate(zip(self.lists, offsets.tolist())):
            limit = offset * (1 + _SLACK)
            while heap and heap[0][0] <= limit:
                vectors.append(heappop(heap)[1])
                clusters.append(c)
        return clusters, vectors

    def push(self, clusters: np.ndarray, vectors: np.ndarray, gaps: np.ndarray, offsets: np.ndarray) -> None:
        keys = gaps + offsets[clusters] * (1 - _SLACK)
        for c, v, key in zip(clusters.tolist(), vectors.tolist(), keys.tolist()):
            heappush(self.lists[c], (key, v))

    def clusters(self, n: int) -> np.ndarray:
        out = np.empty(n, np.int64)
        for c, heap in enumerate(self.lists):
            out[[v for _, v in heap]] = c
        return out


def _data(row: dict, dims: int) -> np.ndarray:
    return np.frombuffer(row["data"], f"<i{row['width']}").reshape(-1, dims)


def to_blocks(kept: DataFrame, k: int, *, dims: int, scale: int, block: int = BLOCK) -> DataFrame:
    """Scaled vectors in blocks; all of them wait in the first heap, expired."""
    def packed(ids, matrix):
        width = 2 if np.abs(matrix).max(initial=0) < 1 << 15 else 4
        n = len(matrix)
        return {"ids": ids, "width": width, "data": matrix.astype(f"<i{width}").tobytes(),
                "keys": np.full(n, -np.inf).astype("<f8").tobytes(),
                "members": np.arange(n, dtype="<i4").tobytes(), "sizes": [n, *[0] * (k - 1)]}

    def run(batches):
        ids, parts, n = [], [], 0
        for b in batches:
            ids += b.column("k").to_pylist()
            parts.append(scaled(b.column("e").flatten().to_numpy().reshape(-1, dims), scale))
            n += b.num_rows
            while n >= block:
                matrix = np.concatenate(parts)
                yield pa.RecordBatch.from_pylist([packed(ids[:block], matrix[:block])], schema=_STATE_ARROW)
                ids, parts, n = ids[block:], [matrix[block:]], n - block
        if n:
            yield pa.RecordBatch.from_pylist([packed(ids, np.concatenate(parts))], schema=_STATE_ARROW)

    return materialise(kept.mapInArrow(run, _STATE), "vector-blocks")


def reassign(blocks: DataFrame, centroids: np.ndarray, offsets: np.ndarray, *, first: bool) -> DataFrame:
    """One round's assignment: expired vectors are compared exactly with all centroids.

    Besides the blocks (``part`` 0) each task gives one row (``part`` 1) with what has
    joined and left: per cluster the sum of each component, and the count, as longs.
    """
    sc = blocks.sparkSession.sparkContext
    k, dims = centroids.shape
    sent = sc.broadcast((centroids, offsets))
    schema = pa.schema([("part", pa.int32()), *_STATE_ARROW, ("change", pa.list_(pa.int64())),
                        ("scanned", pa.int64())])

    def run(batches):
        centroids, offsets = sent.value
        change, scanned = np.zeros((k, dims + 1), np.int64), 0
        for b in batches:
            for row in b.to_pylist():
                data, heaps = _data(row, dims), Heaps.read(row["keys"], row["members"], row["sizes"])
                left, vectors = heaps.expired(offsets)
                if vectors:
                    at = np.array(vectors, np.int64)
                    own = data[at].astype(np.int64)
                    joined, gaps = nearest(own, centroids)
                    heaps.push(joined, at, gaps, offsets)
                    scanned += len(at)
                    left = np.array(left, np.int64)
                    moved = slice(None) if first else np.flatnonzero(joined != left)
                    counted = np.column_stack([own[moved], np.ones(len(own[moved]), np.int64)])
                    np.add.at(change, joined[moved], counted)
                    if not first:
                        np.subtract.at(change, left[moved], counted)
                keys, members, sizes = heaps.written()
                yield pa.RecordBatch.from_pylist([{**row, "part": 0, "keys": keys, "members": members,
                                                   "sizes": sizes, "scanned": 0}], schema=schema)
        yield pa.RecordBatch.from_pylist([{"part": 1, "change": change.ravel().tolist(),
                                           "scanned": scanned}], schema=schema)

    return materialise(blocks.select(*_STATE_ARROW.names).mapInArrow(
        run, f"part int, {_STATE}, change array<long>, scanned long"), "vector-blocks")


def _changes(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, int]:
    """The sums over all tasks' changes: k * (dims + 1) numbers; vectors scanned."""
    parts = state.where("part = 1")
    out = np.zeros(k * (dims + 1), np.int64)
    for at, total in (parts.select(F.posexplode("change").alias("at", "n")).groupBy("at")
                      .agg(F.sum("n").alias("n")).collect()):
        out[at] = total
    return out.reshape(k, dims + 1), parts.agg(F.sum("scanned")).first()[0] or 0


def fit(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", dims: int = 64,
        k: int = 16, rounds: int = 3, seed: int = 1, scale: int = 64, block: int = BLOCK):
    """(blocks after the last assignment, final centroids, vectors scanned per round)."""
    ship(vectors.sparkSession)
    kept = kept_vectors(vectors, key=key, vector=vector, dims=dims)
    centroids = first_centroids(kept, dims, k, seed, scale)
    k = len(centroids)
    if not k:
        return None, centroids, []
    state = to_blocks(kept, k, dims=dims, scale=scale, block=block)
    sums, offsets, scans = np.zeros((k, dims + 1), np.int64), np.zeros(k), []
    for r in range(rounds + 1):
        state = reassign(state, centroids, offsets, first=r == 0)
        change, scanned = _changes(state, k, dims)
        scans.append(scanned)
        state = state.where("part = 0")
        sums += change
        if r < rounds:
            some = sums[:, dims] > 0
            after = centroids.copy()
            after[some] = sums[some, :dims] // sums[some, dims:]
            offsets, centroids = offsets + drift(centroids, after), after
    return state, centroids, scans


def clusters(vectors: DataFrame, *, dims: int = 64, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every
    kept vector: its cluster after the last round, the exact squared distance to its
    centroid, that distance summed over the cluster and over all, the centroid's hash."""
    spark = vectors.sparkSession
    state, centroids, _ = fit(vectors, dims=dims, **options)
    schema = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
              "centroid_sha256 string")
    if state is None:
        return spark.createDataFrame([], schema)
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def placed(row):
        data = _data(row, dims).astype(np.int64)
        own = Heaps.read(row["keys"], row["members"], row["sizes"]).clusters(len(data))
        return own, ((data - centroids[own]) ** 2).sum(axis=1)

    def inertias(batches):
        sums = np.zeros(len(centroids), np.int64)
        for b in batches:
            for row in b.to_pylist():
                own, d = placed(row)
                np.add.at(sums, own, d)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)],
                                         names=["cluster", "n"])

    # as many rows as there are clusters
    inertia = {r["cluster"]: r["n"] for r in state.mapInArrow(inertias, "cluster int, n long")
               .groupBy("cluster").agg(F.sum("n").alias("n")).collect()}
    total, each = sum(inertia.values()), [inertia.get(c, 0) for c in range(len(centroids))]

    def rows(batches):
        for b in batches:
            for row in b.to_pylist():
                own, d = placed(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(own.astype(np.int32)), pa.array(d),
                     pa.array(np.array(each, np.int64)[own]), pa.array(np.full(len(own), total)),
                     pa.array(hashes, pa.string()).take(pa.array(own))],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return state.mapInArrow(rows, schema)


def op12_heap_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` in 16 clusters after three rounds."""
    return clusters(read(spark, sf_dir, "embeddings"), dims=64, k=16, rounds=3, seed=1, scale=64)


def _round(r: int) -> str:
    return f"""
a{r} AS (
  SELECT rid, v, c FROM (
    SELECT rid, kept.v, c, row_number() OVER (PARTITION BY rid ORDER BY
      list_inner_product(kept.v, kept.v) - 2 * list_inner_product(kept.v, m.v)
      + list_inner_product(m.v, m.v), c) AS nth
    FROM kept CROSS JOIN c{r} m) WHERE nth = 1),
c{r + 1} AS (
  SELECT c, coalesce(new.v, old.v) AS v FROM c{r} old LEFT JOIN (
    SELECT c, list(x ORDER BY i) AS v FROM (
      SELECT c, i, floor(sum(x) / count(*)) AS x
      FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i)
    GROUP BY c) new USING (c)),"""


#: The same with every vector compared with every centroid in every round (doubles hold
#: the integers exactly at the size of these components).
OP12_SQL = """
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS c, v
  FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h, v FROM kept ORDER BY h LIMIT 16)),
""" + "".join(map(_round, range(3))) + """
placed AS (
  SELECT rid, c, d FROM (
    SELECT rid, c, d, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS nth FROM (
      SELECT rid, c, list_inner_product(kept.v, kept.v) - 2 * list_inner_product(kept.v, m.v)
                     + list_inner_product(m.v, m.v) AS d
      FROM kept CROSS JOIN c3 m)) WHERE nth = 1)
SELECT kept.vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c3.v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM placed JOIN kept USING (rid) JOIN c3 USING (c)
"""
