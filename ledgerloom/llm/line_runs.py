"""Repeated line runs by a suffix array over line ids, built by prefix doubling.

Documents are sequences of line ids. Suffixes are ranked by their first line,
then by their first two, four, eight lines: each round ranks the pairs (rank
here, rank 2**k lines on) by a distributed sort, and only suffixes whose first
2**k lines stand elsewhere too stay in the game. Suffixes that share a rank are
an interval of the suffix array whose common prefixes have at least 2**k lines;
the rounds go on until no rank is shared, so every suffix is followed to the
interval of its longest common prefix.

In each interval the first suffix in text order stays and the lines of the
common prefix of the others are later copies. A maximal repeated run is the union
of two overlapping such prefixes, the one that begins where it begins and the one
that ends where it ends, so over all rounds these are the maximal runs, of any
length from one line on.

With ``min_words`` only runs of at least so many words (split at white space)
count. Then the shortest parts of runs with that many words are compared, whose
union is every maximal run, and the rounds end at the longest such part; two
overlapping ranks name the interval of any length between.

Text order is ascending doc_id (null first), then the text's hash. Lines are
compared without spaces at their ends. Blank lines are no part of a sequence
and stay, unless nothing but blank lines is left, which makes the text empty.

Nulls and odd rows: null and empty texts have no lines and stay as they are;
of rows with the same doc_id and text one is first and the rest are copies of
it; a null doc_id is a key like any other; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.base import materialise, read, ship, spread_join, unused

_DOC = "doc_id long, h long, words array<int>, x array<long>, y array<long>"


def line_sequences(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its non-blank lines' word counts and 128-bit ids."""
    ship(docs.sparkSession)

    def run(batches):
        import xxhash

        for b in batches:
            cols: list[list] = [[], [], []]
            for t in b.column("t"):
                words, x, y = [], [], []
                for line in (t.as_py() or "").split("\n"):
                    if n := len(line.split()):
                        d = xxhash.xxh3_128_digest(line.strip(" ").encode())
                        words.append(n)
                        x.append(int.from_bytes(d[:8], "little", signed=True))
                        y.append(int.from_bytes(d[8:], "little", signed=True))
                for c, v in zip(cols, (words, x, y)):
                    c.append(v)
            kinds = (pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), b.column("h"), *(pa.array(c, pa.list_(k)) for c, k in zip(cols, kinds))],
                names=["doc_id", "h", "words", "x", "y"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"),
                       F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, _DOC)


def _place() -> Column:
    return F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "h", "pos")


def _named(pairs: DataFrame) -> DataFrame:
    """Ranks of the pairs (a, b) that stand more than once, in the order of (a, b),
    and the first place of each."""
    twice = pairs.groupBy("a", "b").agg(F.count("*").alias("n"), F.min(_place()).alias("first")).where("n > 1")
    # a global sort; the id of a row grows from one sorted partition to the next
    return materialise(twice.orderBy("a", "b")
                       .withColumn("rank", F.monotonically_increasing_id()), "ranks")


def suffix_ranks(sequences: DataFrame, longest: int | None = None) -> DataFrame:
    """(doc_id, h, pos, level, rank, later): the rank of the first 2**level lines at
    pos, where they stand more than once, and whether they stand earlier; for all
    levels up to ``longest`` lines, or until no rank is shared."""
    places = sequences.select("doc_id", "h", F.posexplode(F.arrays_zip("x", "y")).alias("pos", "p")) \
        .select("doc_id", "h", "pos", F.col("p.x").alias("a"), F.col("p.y").alias("b"))
    level, every = 0, []
    while True:
        names = _named(places)
        ranked = materialise(spread_join(places, names, ["a", "b"], "n").select(
            "doc_id", "h", "pos", "rank", (~_place().eqNullSafe(F.col("first"))).alias("later")), "suffixes")
        every.append(ranked.select("doc_id", "h", "pos", F.lit(level).alias("level"), "rank", "later"))
        step = 1 << level
        if (2 * step > longest) if longest is not None else names.isEmpty():
            break
        ahead = Window.partitionBy("doc_id", "h").orderBy("pos").rangeBetween(step, step)
        places = (ranked.withColumn("b", F.first("rank").over(ahead))
                  .where(F.col("b").isNotNull())
                  .select("doc_id", "h", "pos", F.col("rank").alias("a"), "b"))
        level += 1
    out = every[0]
    for e in every[1:]:
        out = out.union(e)
    return out


def shortest_parts(words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """(first line, lines) of the shortest stretches with ``min_words`` words that
    begin at each line and that end at each line."""
    total = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    ends = np.searchsorted(total, total[:-1] + min_words)  # of the one that begins at i
    starts = np.searchsorted(total, total[1:] - min_words, "right") - 1  # that ends before j + 1
    parts = {(i, int(e) - i) for i, e in enumerate(ends) if e <= n}
    parts |= {(int(s), j + 1 - int(s)) for j, s in enumerate(starts) if s >= 0}
    return sorted(parts)


def repeated_lines(sequences: DataFrame, *, min_words: int | None = None) -> DataFrame:
    """(doc_id, h, deleted): which of a document's non-blank lines later copies of
    repeated runs cover, as spans (pos, n), for documents that have any.
    ``sequences`` is a written table."""
    if min_words is None:
        later = suffix_ranks(sequences).where("later").select(
            "doc_id", "h", "pos", F.expr("shiftleft(1, level)").alias("n"))
    else:
        later = _later_parts(sequences, min_words)
    return later.groupBy("doc_id", "h").agg(F.collect_set(F.struct("pos", "n")).alias("deleted"))


def _later_parts(sequences: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, h, pos, n) of the shortest parts with ``min_words`` words that stand earlier."""
    def longest_part(batches):
        for b in batches:
            top = [max((n for _, n in shortest_parts(np.array(w, np.int64), min_words)), default=0)
                   for w in b.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([max(top, default=0)], pa.int32())], names=["n"])

    longest = sequences.select("words").mapInArrow(longest_part, "n int").agg(F.max("n")).first()[0] or 1
    ranks = (suffix_ranks(sequences, longest).groupBy("doc_id", "h")
             .agg(F.collect_list(F.struct("level", "pos", "rank")).alias("ranks")))
    docs = _same(sequences.select("doc_id", "h", "words"), ranks)

    def parts(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for k, h, words, ranks in zip(*(b.column(c).to_pylist() for c in (
                    "doc_id", "h", "words", "ranks"))):
                rank = {(r["level"], r["pos"]): r["rank"] for r in ranks}
                for i, n in shortest_parts(np.array(words, np.int64), min_words):
                    level = n.bit_length() - 1
                    one, two = rank.get((level, i)), rank.get((level, i + n - (1 << level)))
                    if one is not None and two is not None:
                        for c, v in zip(out, (k, h, i, n, one, two)):
                            c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)],
                                             names=["doc_id", "h", "pos", "n", "one", "two"])

    found = materialise(docs.mapInArrow(
        parts, "doc_id long, h long, pos int, n int, one long, two long"), "runs")
    earliest = materialise(
        found.groupBy("n", "one", "two").agg(F.min(_place()).alias("earliest"), F.count("*").alias("copies"))
        .where("copies > 1"), "earliest")
    return (spread_join(found, earliest, ["n", "one", "two"], "copies")
            .where(~_place().eqNullSafe(F.col("earliest"))).select("doc_id", "h", "pos", "n"))


def _same(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on the document key (doc_id, which may be null, and h)."""
    right = right.withColumnRenamed("doc_id", "__id").withColumnRenamed("h", "__h")
    return left.join(right, left["doc_id"].eqNullSafe(right["__id"]) & (left["h"] == right["__h"])).drop("__id", "__h")


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.LongType())]))
def _without(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """The text without the non-blank lines in the spans, and how many those are."""
    out: list[tuple] = []
    for t, own in zip(text, spans):
        if t is None or own is None:
            out.append((None, 0))
            continue
        lines = t.split("\n")
        full = [i for i, line in enumerate(lines) if line.split()]
        gone = {i for s in own for i in full[s["pos"]:s["pos"] + s["n"]]}
        left = "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out.append((left if len(gone) < len(full) else "", len(gone)))
    return pd.DataFrame(out, columns=["text", "n"])


def dedup_lines(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int | None = None,
                count_as: str = "n_deleted") -> DataFrame:
    """The documents, later copies of repeated line runs deleted from their text.

    All columns stay; the number of deleted lines is added as ``count_as`` (in
    place of a column of that name).
    """
    docs = docs.drop(count_as)
    sequences = materialise(line_sequences(docs, key=key, text=text), "lines")
    alike = materialise(sequences.groupBy("doc_id", "h").agg(
        F.count("*").alias("rows"), F.max(F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + w))
        .alias("words")).where("rows > 1"), "rows")
    again = not alike.isEmpty()
    k, h, id_, h_, gone, row, first, words, cut = unused(
        docs, "_k", "_h", "_id", "_hash", "_gone", "_row", "_first", "_words", "_cut")
    marked = docs.withColumns({k: F.col(key).cast("long"), h: F.xxhash64(text)})

    def with_key(left: DataFrame, other: DataFrame, to: dict) -> DataFrame:
        other = other.withColumnsRenamed({"doc_id": id_, "h": h_, **to})
        return left.join(other, F.col(k).eqNullSafe(F.col(id_)) & (F.col(h) == F.col(h_)), "left").drop(id_, h_)

    if again:  # rows alike are one document in the suffix array
        sequences = materialise(sequences.dropDuplicates(["doc_id", "h"]), "lines")
        # one of them stays: the one of least number; the numbers are written first
        marked = materialise(marked.withColumn(row, F.monotonically_increasing_id()), "numbered")
        firsts = marked.groupBy(k, h).agg(F.min(row).alias(first)).withColumnsRenamed({k: "doc_id", h: "h"})
        marked = with_key(marked, firsts, {})
    marked = with_key(marked, repeated_lines(sequences, min_words=min_words), {"deleted": gone})
    if again:
        marked = with_key(marked, alike.drop("rows"), {"words": words})
        whole = F.array(F.struct(F.lit(0).alias("pos"), F.lit(2**31 - 1).alias("n")))
        copy = (F.col(row) != F.col(first)) & (F.col(words) >= (min_words or 1))
        marked = marked.withColumn(gone, F.when(copy, whole).otherwise(F.col(gone)))
    # texts without deletions stay in the JVM
    taken = _without(F.when(F.col(gone).isNotNull(), F.col(text)), gone)
    return (marked.withColumn(cut, taken)
            .withColumn(count_as, F.coalesce(F.col(cut)["n"], F.lit(0).cast("long")))
            .withColumn(text, F.coalesce(F.col(cut)["text"], text)).select(*docs.columns, count_as))


def without_repeats(docs: DataFrame, *, min_words: int | None = None) -> DataFrame:
    """The documents with later copies of runs deleted and n_chars brought up to
    date; documents of which nothing is left go, those empty before stay."""
    n, = unused(docs, "n_deleted")
    out = dedup_lines(docs, min_words=min_words, count_as=n)
    return (out.where((F.col(n) == 0) | (F.col("text") != ""))
            .withColumn("n_chars", F.when(F.col(n) == 0, F.col("n_chars"))
                        .otherwise(F.char_length("text").cast("long"))).drop(n))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without the later copies of repeated line runs."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs.withColumn("n_lines", F.size(F.split("text", "\n")).cast("long")))
    return out.select("doc_id", "n_lines", "n_deleted", F.char_length("text").cast("long").alias("n_chars"),
                      F.sha2("text", 256).alias("text_sha256"))


#: The same by comparing the lines' text themselves (doc_id is unique in these tables): a
#: line that stands earlier is a repeated run, alone or as a part of a longer one.
OP10_SQL = r"""
WITH cut AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw,
                    unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS line FROM documents),
seq AS (SELECT *, regexp_matches(raw, '[^\s\p{Z}\x0B\x1C-\x1F\x{85}]') AS solid FROM cut),
gone AS (SELECT doc_id, line FROM (
           SELECT doc_id, line, row_number() OVER (PARTITION BY trim(raw, ' ') ORDER BY doc_id, line) AS nth
           FROM seq WHERE solid) WHERE nth > 1),
kept AS (
  SELECT seq.doc_id, count(*) AS n_lines, count(gone.line) AS n_deleted,
         coalesce(string_agg(raw, chr(10) ORDER BY seq.line) FILTER (gone.line IS NULL), '') AS left_over,
         bool_or(solid AND gone.line IS NULL) AS any_left, any_value(text) AS text
  FROM seq LEFT JOIN gone ON seq.doc_id = gone.doc_id AND seq.line = gone.line GROUP BY seq.doc_id)
SELECT doc_id, n_lines, n_deleted, length(t) AS n_chars, sha256(t) AS text_sha256
FROM (SELECT *, CASE WHEN n_deleted = 0 THEN text WHEN any_left THEN left_over ELSE '' END AS t FROM kept)
"""
