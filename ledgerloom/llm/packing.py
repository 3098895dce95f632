"""Packing documents into fixed-size sequences by minimum bin slack.

Only lengths matter for who shares a sequence, and there are at most
``capacity`` of them. So the plan is made from the histogram of piece lengths:
the longest piece left opens a bin, a bitset subset-sum over the lengths left
finds the fullest way to complete it, and that combination is used as often as
the counts allow before the next search. Pieces then find their place by their
rank among the pieces of their length; no piece passes through the driver.

Nulls and odd rows: a null text is empty and gives one piece, the end id alone;
rows that share a doc_id are packed each on its own; an empty table gives none.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.base import lean, materialise, read, ship
from ledgerloom.llm.encoding import encoder, larger, public_path

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text",
               end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Encode every whole text, append ``end_id``, cut what is over ``capacity``."""
    ship(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    @lean
    def run(batches):
        with encoder(tokenizer) as enc:
            for b in larger(batches):
                out: list[tuple] = []
                for k, ids in zip(b.column("k").to_pylist(), enc.encode_column(b.column("t"))):
                    ids += end
                    for i, a in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[a:a + 4 * capacity]
                        out.append((k, i, a // 4, len(part) // 4, zlib.crc32(part)))
                cols = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(cols)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(key).cast("long").alias("k"),
                       F.col(text).cast("string").alias("t")).mapInArrow(run, _PIECES)


def fullest(room: int, left: dict[int, int], order: list[int]) -> list[tuple[int, int]]:
    """The combination of lengths left, each at most as often as it is left,
    with the greatest total within ``room``: [(length, times)].

    Subset-sum over a bitset of reachable totals, longer lengths first; it ends
    as soon as the room can be filled to the last token.
    """
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in order:
        if length > room or not left[length]:
            continue
        for _ in range(min(left[length], room // length)):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            steps.append((length, reach))
            reach = wider
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + 1
            total -= length
    return list(used.items())


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for a histogram of lengths: [(bins alike, [(length, times in each)])].

    Its work depends on the number of lengths, not of pieces: every step uses up
    at least one length of its combination, or leaves less than it takes.
    """
    left = {k: v for k, v in counts.items() if v}
    order = sorted(left, reverse=True)
    out = []
    at = 0
    while at < len(order):
        longest = order[at]
        if not left[longest]:
            at += 1
            continue
        left[longest] -= 1
        rest = fullest(capacity - longest, left, order[at:])
        left[longest] += 1
        each = dict(rest)
        each[longest] = each.get(longest, 0) + 1
        bins = min(left[k] // n for k, n in each.items())
        for k, n in each.items():
            left[k] -= bins * n
        out.append((bins, sorted(each.items(), reverse=True)))
    return out


def _places(bins_plan: list) -> dict[str, np.ndarray]:
    """For each length, runs of ranks and where their pieces go."""
    rows, taken, base = [], {}, 0
    for bins, each in bins_plan:
        offset = 0
        for length, times in each:
            lo = taken.get(length, 0)
            rows.append((length, lo, times, base, offset))
            taken[length] = lo + bins * times
            offset += length * times
        base += bins
    rows.sort()
    cols = list(zip(*rows)) or [()] * 5
    return dict(zip(("length", "lo", "times", "base", "offset"),
                    (np.array(c, np.int64) for c in cols)))


def pack(pieces: DataFrame, *, capacity: int = 4096, salts: int = 64,
         rows_per_salt: int = 50_000) -> DataFrame:
    """Add sequence_id and offset to pieces (written tables, not lazy plans).

    A rank among the pieces of one length is a salt group's first rank (from
    counts per length and salt) plus the rank inside it, so a length that a
    third of all pieces share is ranked by many tasks. Salts grow with the rows.
    """
    spark = pieces.sparkSession
    hist = {r["length"]: r["n"] for r in
            pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    if any(length > capacity or length < 1 for length in hist):
        raise ValueError("a piece is longer than a sequence, or empty")
    places = spark.sparkContext.broadcast(_places(plan(hist, capacity)))
    salts = max(salts, -(-sum(hist.values()) // rows_per_salt))
    salted = pieces.withColumn("salt", F.pmod(
        F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)
    firsts = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (salted.join(firsts, ["length", "salt"])
              .withColumn("rank", F.col("first") + F.row_number().over(within) - 1))

    def place(batches):
        p = places.value
        keys = p["length"] << 40 | p["lo"]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, length << 40 | rank, "right") - 1
            bin_, slot = np.divmod(rank - p["lo"][at], p["times"][at])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                 pa.array(p["base"][at] + bin_), pa.array(p["offset"][at] + slot * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return (ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
            .mapInArrow(place, f"{_PIECES}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, *, end_id: int = 1,
                   capacity: int = 4096) -> DataFrame:
    """Encode, cut and pack documents; one row per piece."""
    path = tokenizer or public_path("word_bpe_49k.json")
    pieces = cut_pieces(docs, path, end_id=end_id, capacity=capacity)
    return pack(materialise(pieces, "pieces"), capacity=capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 4096 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"),
                          end_id=1, capacity=4096)
