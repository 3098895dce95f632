"""SimHash near-duplicates by tiled exact comparison.

Each text's word shingles vote on 64 bits. Distinct fingerprints are sorted by
population count and cut into tiles; a tile meets another only if their ranges
of population counts are at most ``radius`` apart (fingerprints that differ in
r bits differ in at most r of their counts). A pair of tiles is one task's
work: exclusive-or and bit counts of all pairs, in blocks, where again only
rows within the radius of counts meet. Nothing is missed, whatever the data.

A tile pair returns not all its links but fewer pairs that join the same
fingerprints (each to the least of its class), so a group of thousands stays small.

Nulls and odd rows: a null or wordless text has fingerprint 0 and is linked
like any other; fewer words than a shingle are one shingle; rows that share a
doc_id or a text are answered each on its own; component_id is the least
non-null doc_id reachable (null if there is none). No documents, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.base import lean, materialise, read, ship, spread_join, unused
from ledgerloom.llm.components import components


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits; a bit is set if it is set in over half the shingles' XXH64 (seed 42)."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    h = xxhash.xxh64_intdigest
    votes, n = np.zeros(64, np.int64), len(words) - shingle + 1
    for at in range(0, n, 1 << 16):  # bounded memory, however long the text is
        a = starts[at:min(n, at + (1 << 16))].tolist()
        b = ends[at + shingle - 1:at + shingle - 1 + len(a)].tolist()
        got = np.fromiter([h(whole[i:j], 42) for i, j in zip(a, b)], np.uint64, len(a))
        votes += np.unpackbits(got.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                      shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) of whole texts; fp as a signed long."""
    ship(docs.sparkSession)

    @lean
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("t")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("h"), pa.array(fps.view(np.int64), pa.int64())],
                names=["doc_id", "text_hash", "fp"])

    return docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"),
                       F.col(text).cast("string").alias("t")).mapInArrow(
        run, "doc_id long, text_hash long, fp long")


# -- tiles -------------------------------------------------------------------

def forest(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fewer than n links that join the same of n nodes as the links u-v."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[u], root[v])
        if (root[u] == low).all() and (root[v] == low).all():
            break
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while not (root[root] == root).all():
            root = root[root]
    own = np.flatnonzero(root != np.arange(n))
    return own, root[own]


def _near(a: np.ndarray, b: np.ndarray, radius: int, same: bool):
    """Index pairs (into a, into b) at most ``radius`` bits apart; both are sorted
    by population count. Yields arrays, block after block."""
    ca, cb = np.bitwise_count(a).astype(int), np.bitwise_count(b).astype(int)
    for i in range(0, len(a), 64):
        block = a[i:i + 64]
        lo = np.searchsorted(cb, ca[i] - radius)
        hi = np.searchsorted(cb, ca[min(i + 63, len(a) - 1)] + radius, "right")
        lo = max(lo, i + 1) if same else lo
        if lo < hi:
            x, y = np.nonzero(np.bitwise_count(block[:, None] ^ b[None, lo:hi]) <= radius)
            if len(x):
                x, y = x + i, y + lo
                yield (x[x < y], y[x < y]) if same else (x, y)


def _links(a: np.ndarray, b: np.ndarray, radius: int, same: bool, keep: int = 1_000_000):
    """A spanning forest of the links between two tiles, as fingerprint pairs."""
    both = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    u, v, size = [], [], 0
    for x, y in _near(a, b, radius, same):
        u.append(x)
        v.append(y + shift)
        size += len(x)
        if size > keep:
            x, y = forest(np.concatenate(u), np.concatenate(v), len(both))
            u, v, size = [x], [y], 0
    if not u:
        return both[:0], both[:0]
    x, y = forest(np.concatenate(u), np.concatenate(v), len(both))
    return both[x], both[y]


def links(fps: DataFrame, *, radius: int = 3, tile: int = 4096, tiles: int = 64) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) within the
    radius of each other. ``tile`` is the least size of a tile; beyond ``tiles``
    tiles they grow, up to 65,536, to keep copies of tiles few. Any size gives
    the same classes."""
    spark = fps.sparkSession
    ship(spark)
    n = fps.count()
    size = min(65_536, max(tile, n // tiles))
    ones = fps.select("fp", F.bit_count("fp").alias("ones"))
    dealt = ones.repartitionByRange(max(1, -(-n // size)), "ones", "fp").sortWithinPartitions("ones", "fp")

    def cut(batches):
        import uuid

        rest = np.zeros(0, np.int64)

        def out(part):
            c = np.bitwise_count(part.view(np.uint64))
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.array([int(c[0])], pa.int32()),
                 pa.array([int(c[-1])], pa.int32()), pa.array([part.astype("<i8").tobytes()], pa.binary())],
                names=["tile", "low", "high", "fps"])

        for b in batches:
            rest = np.concatenate([rest, b.column("fp").to_numpy()])
            while len(rest) >= size:
                yield out(rest[:size])
                rest = rest[size:]
        if len(rest):
            yield out(rest)

    cuts = materialise(dealt.select("fp").mapInArrow(cut, "tile string, low int, high int, fps binary"),
                       "tiles")
    names = cuts.select("tile", "low", "high")
    # tiles that share a population count once one of them is widened by the radius
    one = names.select(F.col("tile").alias("a"),
                       F.explode(F.sequence(F.col("low") - radius, F.col("high") + radius)).alias("c"))
    two = names.select(F.col("tile").alias("b"), F.explode(F.sequence("low", "high")).alias("c"))
    near = one.join(two, "c").where("a <= b").select("a", "b").distinct()
    pairs = (near.join(cuts.select(F.col("tile").alias("a"), F.col("fps").alias("x")), "a")
             .join(cuts.select(F.col("tile").alias("b"), F.col("fps").alias("y")), "b"))

    @lean
    def compare(batches):
        for b in batches:
            for a, c, x, y in zip(*(b.column(k).to_pylist() for k in "abxy")):
                u, v = _links(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), radius, a == c)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))],
                                                 names=["a", "b"])

    return pairs.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, *, shingle: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, class_fp, component_id), one row per document.

    ``class_fp`` is a fingerprint that names the class, ``component_id`` its least
    non-null doc_id.
    """
    own = materialise(with_fingerprints(docs, shingle=shingle), "fingerprints")
    least = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")),
                        "distinct-fps")
    roots = materialise(components(links(least.select("fp"), radius=radius)), "roots")
    members = roots.select(F.col("node").alias("fp"), "root").join(least.drop("n"), "fp")
    classes = members.groupBy("root").agg(F.min("least").alias("component_id"))
    mapped = members.join(classes, "root").select("fp", "root", "component_id")
    ids = materialise(least.join(mapped, "fp", "left").select(
        "fp", "n", F.coalesce("root", "fp").alias("class_fp"),
        F.coalesce("component_id", "least").alias("component_id")), "class-ids")
    return spread_join(own, ids, ["fp"], "n").select("doc_id", "text_hash", "fp", "class_fp", "component_id")


def one_of_each(docs: DataFrame, *, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One document of each near-duplicate class, all columns kept: the one with
    the least doc_id (null last), then the least hash of its text."""
    found = materialise(near_duplicates(docs, shingle=shingle, radius=radius), "classes")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    k, h, own = unused(docs, "_k", "_h", "_own")
    chosen = (found.groupBy("class_fp").agg(F.min(rank).alias("r"))
              .select(F.col("r.doc_id").alias(k), F.col("r.text_hash").alias(h)))
    alike = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1")
    kept = (docs.withColumn(own, F.xxhash64("text"))
            .join(chosen, F.col("doc_id").cast("long").eqNullSafe(F.col(k)) & (F.col(own) == F.col(h)),
                  "left_semi"))
    if not alike.isEmpty():  # rows alike in both count once
        kept = kept.dropDuplicates(["doc_id", own])
    return kept.drop(own)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every whole text of ``documents``."""
    found = near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")
