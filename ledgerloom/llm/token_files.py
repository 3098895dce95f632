"""Token ids as binary shards with a minimal perfect hash index over the keys.

A shard is two files. ``shard-K.ids`` holds nothing but ids, document after
document, little-endian, 16 bits each if the vocabulary allows, else 32.
``shard-K.idx`` holds the keys in order, where each record starts, and the
index: a hash-and-displace minimal perfect hash from a key to its slot, and per
slot a stored 32-bit fingerprint, the key's first record and its record count.
``manifest.json`` lists each shard's first key, records and ids, so a shard's
position in the whole run of ids is known without reading it.

Shards are ranges of the key in ascending order, so the shards one after
another are all documents in ascending key order.

Nulls and odd rows: a null text counts as empty (only the end id is written); a
null key sorts first and can be looked up as None; rows that share a key are
records one after another, ordered by text. An empty table gives no shards.
"""

from __future__ import annotations

import io
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import files
from ledgerloom.llm.base import lean, range_edges, range_of, scratch, ship, shuffle_width
from ledgerloom.llm.encoding import encoder, larger, public_path

#: Keys of one displacement bucket, on average. Few, so that many buckets hold one
#: key and take the last free slots without a search.
BUCKET = 1.5
_MASK = (1 << 64) - 1


# -- the minimal perfect hash ------------------------------------------------

def _key_hash(key: int | None, seed: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(b"" if key is None else str(key).encode(), seed)


def _slot(h: int, displace: int, n: int) -> int:
    x = (h + (displace + 1) * 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _MASK
    return (x ^ (x >> 29)) % n


class PerfectHash:
    """key -> slot in [0, n), no two keys of the built set alike.

    Buckets of keys, the fullest first, each take the first displacement that
    puts all their keys in free slots; a bucket of one takes any free slot and
    stores it. A foreign key also gets some slot: its fingerprint tells.
    """

    def __init__(self, seed: int, n: int, displace: np.ndarray, prints: np.ndarray):
        self.seed, self.n, self.displace, self.prints = seed, n, displace, prints

    @classmethod
    def build(cls, keys: list) -> tuple["PerfectHash", list[int]]:
        n = len(keys)
        if not n:
            return cls(0, 0, np.zeros(0, np.int64), np.zeros(0, np.uint32)), []
        seed = 0
        while len(set(hashes := [_key_hash(k, seed) for k in keys])) < n:
            seed += 1  # two keys share all 64 bits: hash anew
        buckets: list[list[int]] = [[] for _ in range(int(n / BUCKET) + 1)]
        for i, h in enumerate(hashes):
            buckets[h % len(buckets)].append(i)
        displace, slots, taken = np.zeros(len(buckets), np.int64), [0] * n, bytearray(n)
        free = 0
        for b in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
            own = buckets[b]
            if len(own) == 1:
                while taken[free]:
                    free += 1
                displace[b], slots[own[0]], taken[free] = -free - 1, free, 1
            elif own:
                d = 0
                while True:
                    got = [_slot(hashes[i], d, n) for i in own]
                    if len(set(got)) == len(got) and not any(taken[s] for s in got):
                        break
                    d += 1
                displace[b] = d
                for i, s in zip(own, got):
                    slots[i], taken[s] = s, 1
        prints = np.zeros(n, np.uint32)
        prints[slots] = [h >> 32 for h in hashes]
        return cls(seed, n, displace, prints), slots

    def find(self, key: int | None) -> int | None:
        """The slot of a key, or None if its fingerprint differs."""
        if not self.n:
            return None
        h = _key_hash(key, self.seed)
        d = int(self.displace[h % len(self.displace)])
        slot = -d - 1 if d < 0 else _slot(h, d, self.n)
        return slot if int(self.prints[slot]) == h >> 32 else None


# -- writing -----------------------------------------------------------------

def _write_shard(folder: str, number: int, width: str, keys: list, parts: Iterator[bytes]):
    """``keys`` is filled by ``parts`` while the payload is streamed."""
    starts = [0]

    def fill(out):
        for ids in parts:
            out.write(np.frombuffer(ids, "<u4").astype(width).tobytes())
            starts.append(starts[-1] + len(ids) // 4)

    files.publish(f"{folder}/shard-{number:06d}.ids", fill)
    firsts = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]
    table, slots = PerfectHash.build([keys[i] for i in firsts])
    first, count = np.zeros(len(firsts), np.uint32), np.zeros(len(firsts), np.uint32)
    first[slots] = firsts
    count[slots] = np.diff([*firsts, len(keys)])
    buf = io.BytesIO()
    np.savez(buf, seed=table.seed, displace=table.displace, prints=table.prints, first=first,
             count=count, starts=np.array(starts, np.uint64), width=width,
             keys=np.array([k or 0 for k in keys], np.int64),
             null=np.array([k is None for k in keys], bool))
    files.publish(f"{folder}/shard-{number:06d}.idx", lambda out: out.write(buf.getvalue()))
    return number, keys[0], len(keys), starts[-1]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str | None = None, *,
                      key: str = "doc_id", text: str = "text", end_id: int = 0,
                      shards_per_partition: int = 4) -> dict:
    """Encode every whole text, append ``end_id``, write shards and the manifest.

    One shuffle moves the texts to their key range; each range is encoded and
    streamed to its file, so a task holds one document's ids and its shard's
    keys. Returns the manifest: {"width", "shards": [{shard, first, docs, ids}]}.
    """
    spark = docs.sparkSession
    ship(spark)
    path = tokenizer or public_path("byte_bpe_50k.json")
    width = "<u2" if max(end_id, encoder(path).tok.get_vocab_size() - 1) < 1 << 16 else "<u4"
    files.make_folder(folder)
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    parts = shuffle_width(spark)
    edges = range_edges(rows, "k", shards_per_partition * parts)
    rows = (rows.withColumn("r", range_of(F.col("k"), edges).cast("int"))
            .repartition(parts, "r").sortWithinPartitions("r", "k", "t"))
    end = np.array([end_id], "<u4").tobytes()

    @lean
    def write(batches):
        done = []
        with encoder(path) as enc:
            flow = ((r, k, ids) for b in larger(batches) for r, k, ids in zip(
                b.column("r").to_pylist(), b.column("k").to_pylist(), enc.encode_column(b.column("t"))))
            for r, own in groupby(flow, lambda x: x[0]):
                keys: list = []

                def parts(own=own, keys=keys):
                    for _, k, ids in own:
                        keys.append(k)
                        yield ids + end

                done.append(_write_shard(folder, r, width, keys, parts()))
        out = list(zip(*done)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())],
                                         names=["shard", "first", "docs", "ids"])

    # one small row per shard; the number of shards follows the cluster's settings
    got = rows.mapInArrow(write, "shard int, first long, docs long, ids long").collect()
    manifest = {"width": width, "shards": sorted((r.asDict() for r in got), key=lambda s: s["shard"])}
    files.publish(f"{folder}/manifest.json", lambda out: out.write(json.dumps(manifest).encode()))
    return manifest


# -- reading -----------------------------------------------------------------

class Shard:
    """One shard opened for keyed access: a hash, a slot, one read."""

    def __init__(self, folder: str, number: int, whole: bool = False):
        """``whole``: read the payload at once, for a pass over all records."""
        with np.load(io.BytesIO(files.load(f"{folder}/shard-{number:06d}.idx"))) as z:
            self.width = str(z["width"])
            self.starts, self.first, self.count = z["starts"], z["first"], z["count"]
            self.table = PerfectHash(int(z["seed"]), len(self.first), z["displace"], z["prints"])
            self.keys = [None if null else int(k) for k, null in zip(z["keys"], z["null"])]
        name = f"{folder}/shard-{number:06d}.ids"
        self.payload = io.BytesIO(files.load(name)) if whole else files.open_random(name)

    def records(self, key: int | None) -> range:
        slot = self.table.find(key)
        if slot is None:
            return range(0)
        first = int(self.first[slot])
        return range(first, first + int(self.count[slot]))

    def ids(self, record: int) -> np.ndarray:
        a, b = int(self.starts[record]), int(self.starts[record + 1])
        size = int(self.width[-1])
        self.payload.seek(a * size)
        return np.frombuffer(self.payload.read((b - a) * size), self.width)


def lookup(folder: str, key: int | None) -> list[np.ndarray]:
    """All records of one key, through the manifest and the shard's index."""
    shards = json.loads(files.load(f"{folder}/manifest.json"))["shards"]
    lows = [-(1 << 63) if s["first"] is None else s["first"] for s in shards]
    at = max(0, bisect_right(lows, -(1 << 63) if key is None else key) - 1)
    if not shards:
        return []
    shard = Shard(folder, shards[at]["shard"])
    return [shard.ids(r) for r in shard.records(key) if shard.keys[r] == key]


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every record, fetched by its key through the index; one task per few shards.

    Columns: doc_id, start (ids of all records before it), n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers), shard, record.
    """
    ship(spark)
    shards = json.loads(files.load(f"{folder}/manifest.json"))["shards"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, record int"
    if not shards:
        return spark.createDataFrame([], schema)
    todo, base = [], 0
    for s in shards:
        todo.append((s["shard"], base))
        base += s["ids"]

    def fetch(batches):
        for b in batches:
            for number, before in zip(b.column("shard").to_pylist(), b.column("base").to_pylist()):
                shard, out = Shard(folder, number, whole=True), []
                for i, k in enumerate(shard.keys):
                    if i and k == shard.keys[i - 1]:
                        continue
                    for r in shard.records(k):
                        ids = shard.ids(r)
                        out.append((k, before + int(shard.starts[r]), len(ids),
                                    zlib.crc32(ids.astype("<u4").tobytes()), number, r))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(),) * 4 + (pa.int32(),) * 2)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "shard", "record"])

    few = min(len(todo), shuffle_width(spark))
    return (spark.createDataFrame(todo, "shard int, base long").repartition(few)
            .mapInArrow(fetch, schema))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as token files in ascending doc_id, then read back."""
    from ledgerloom.llm.base import read

    folder = scratch(spark, "token-files")
    write_token_files(read(spark, sf_dir, "documents"), folder,
                      public_path("byte_bpe_50k.json"), end_id=0)
    return read_token_files(spark, folder)
