"""Benchmark decontamination over a positional inverted index of the documents.

The index is a table of shards. A shard holds the postings of some documents:
its distinct words, and per word the ascending positions at which it stands.
Every word of every document is in it, so it serves any later set of queries.
A query window is answered inside each shard: the posting list of its rarest
word there, moved back by that word's offset, is intersected with the moved
list of the next rarest, and so on until none or all words are through. What is
left are exactly the places where the whole window stands.

With ``slop`` (proximity match) up to so many other words may stand between two
neighbouring words of the window, which come in order and in one document. The
rarest word's postings leave of each other list what is near enough to them; from
the last word back to the first a posting stays that has a next one near enough.
A match begins at each posting left of the first word and goes by the nearest
posting left to the last. None of this depends on the other documents of a shard.

Windows are cut and numbered by Spark. They are searched in blocks of about
``block`` windows: what is broadcast is one block of window words, however large
the benchmark is, and blocks are added until all windows are searched. A search
returns the documents with hits; all documents come in by one join at the end.

Nulls and odd rows: a null or wordless text has no words and no hits; a null
doc_id is kept; rows that share a doc_id are answered each on its own; an item
without words has no window; a null item_id is written ``null``; equal item_ids
count once. Without documents there are no rows; without items, no hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.base import lean, materialise, read, ship, spread_join, unused

#: bytes -> bytes: A-Z in lower case, other ASCII signs but digits and letters to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
              for b in range(256))

INDEX = ("shard string, docs array<long>, hashes array<long>, words array<int>, "
         "terms binary, starts binary, positions binary")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of digits, letters and non-ASCII signs, in UTF-8."""
    return text.encode().translate(_FOLD).split() if text else []


class _Ids(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def build_index(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                shard_chars: int = 2_000_000) -> DataFrame:
    """The positional index of whole texts, written to the shared folder.

    No shuffle: each task indexes the documents it reads, a new shard after
    every ``shard_chars`` characters. ``hashes`` has each text's xxhash64.
    """
    spark = docs.sparkSession
    ship(spark)

    def shard(number, keys, hashes, texts):
        ids, counts, codes = _Ids(), [], []
        for t in texts:
            own = words_of(t)
            counts.append(len(own))
            codes.append(np.fromiter(map(ids.__getitem__, own), np.int64, len(own)))
        code = np.concatenate(codes)
        order = np.sort(code << 32 | np.arange(len(code)))
        starts = np.searchsorted(order, np.arange(len(ids) + 1) << 32).astype("<i4")
        where = (order & 0xFFFFFFFF).astype("<i4")
        return (number, keys, hashes, counts, b" ".join(ids), starts.tobytes(), where.tobytes())

    @lean
    def run(batches):
        import uuid

        held, size = ([], [], []), 0

        def flush():
            cols = list(zip(shard(uuid.uuid4().hex, *held)))
            kinds = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()),
                     pa.binary(), pa.binary(), pa.binary())
            names = ("shard", "docs", "hashes", "words", "terms", "starts", "positions")
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=list(names))

        for b in batches:
            for k, h, t in zip(b.column("k").to_pylist(), b.column("h").to_pylist(), b.column("t")):
                t = t.as_py()
                for column, v in zip(held, (k, h, t)):
                    column.append(v)
                size += len(t or "")
                if size >= shard_chars:
                    yield flush()
                    held, size = ([], [], []), 0
        if held[0]:
            yield flush()

    rows = docs.select(F.col(key).cast("long").alias("k"), F.xxhash64(text).alias("h"),
                       F.col(text).cast("string").alias("t"))
    return materialise(rows.mapInArrow(run, INDEX), "postings")


class _Shard:
    """One shard's posting lists."""

    def __init__(self, words, terms: bytes, starts: bytes, positions: bytes):
        self.starts, self.positions = np.frombuffer(starts, "<i4"), np.frombuffer(positions, "<i4")
        self.code = {t: i for i, t in enumerate(terms.split(b" "))} if terms else {}
        self.ends = np.cumsum(np.array(words, np.int64))
        self.begins = self.ends - np.array(words, np.int64)

    def postings(self, code: int) -> np.ndarray:
        return self.positions[self.starts[code]:self.starts[code + 1]]

    def find(self, codes: np.ndarray, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first, last + 1 position) of each match of a window."""
        order = np.argsort(self.starts[codes + 1] - self.starts[codes], kind="stable")
        if slop:
            return self._near(codes, int(order[0]), slop)
        at = self.postings(codes[order[0]]).astype(np.int64) - order[0]
        doc = np.searchsorted(self.ends, at + order[0], "right")
        inside = (at >= self.begins[doc]) & (at + len(codes) <= self.ends[doc])
        at, doc = at[inside], doc[inside]
        for k in order[1:]:
            if not len(at):
                break
            own = self.postings(codes[k])
            i = np.minimum(np.searchsorted(own, at + k), len(own) - 1)
            at, doc = (x[own[i] == at + k] for x in (at, doc))
        return doc, at, at + len(codes)

    def _near(self, codes: np.ndarray, rarest: int, slop: int):
        anchor = self.postings(codes[rarest]).astype(np.int64)
        lists = []
        for k, code in enumerate(codes):
            own = self.postings(code).astype(np.int64)
            # a posting of word k lies between these distances from one of the rarest word
            low, high = sorted(((k - rarest), (k - rarest) * (1 + slop)))
            lists.append(own[np.searchsorted(anchor, own - low, "right") > np.searchsorted(anchor, own - high)])
        to = [np.zeros(0, np.int64)] * len(codes)
        for k in range(len(codes) - 2, -1, -1):
            own, after = lists[k], lists[k + 1]
            i = np.searchsorted(after, own, "right")  # the nearest that is left
            following = np.append(after, np.iinfo(np.int64).max)[i]
            end = self.ends[np.searchsorted(self.ends, own, "right")]
            stays = (following - own <= 1 + slop) & (following < end)
            lists[k], to[k] = own[stays], i[stays]
        first, at = lists[0], np.arange(len(lists[0]))
        for k in range(len(codes) - 1):
            at = to[k][at]
        return np.searchsorted(self.ends, first, "right"), first, lists[-1][at] + 1


def windows_of(items: DataFrame, *, key: str = "item_id", text: str = "text", window: int = 10) -> DataFrame:
    """(words, item): every window of every item, its words parted by a space; distinct."""
    ship(items.sparkSession)

    @lean
    def run(batches):
        for b in batches:
            out = []
            for k, t in zip(b.column("k").to_pylist(), b.column("t")):
                own = words_of(t.as_py())
                for i in range(max(1, len(own) - window + 1) if own else 0):
                    out.append((b" ".join(own[i:i + window]).decode(), k))
            cols = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["words", "item"])

    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("k"),
                        F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, "words string, item string").distinct()


def search(index: DataFrame, items: DataFrame, *, key: str = "item_id", text: str = "text",
           window: int = 10, slop: int = 0, block: int = 100_000) -> DataFrame:
    """Matches of the items' windows in every indexed document, one row each.

    Columns: doc_id, text_hash, n_words, spans (merged word ranges [start, end)
    that lie in some match, in order) and items (sorted ids of the items that
    have a matching window).
    """
    spark = index.sparkSession
    ship(spark)
    named = materialise(windows_of(items, key=key, text=text, window=window), "item-windows")
    # a window's number is its place in the sorted table of distinct windows
    numbered = materialise(named.select("words").distinct().orderBy("words")
                           .withColumn("w", F.monotonically_increasing_id()), "windows")
    blocks = -(-numbered.count() // block)
    hits = None
    for i in range(blocks):
        own = numbered.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == i).collect()  # about ``block``
        found = _search_block(index, [(r["w"], r["words"].encode().split(b" ")) for r in own], slop)
        hits = found if hits is None else hits.union(found)
    every = index.mapInArrow(_documents, "shard string, row int, doc_id long, text_hash long, n_words long")
    if hits is None:
        return every.select("doc_id", "text_hash", "n_words",
                            F.array().cast("array<struct<s:int,e:int>>").alias("spans"),
                            F.array().cast("array<string>").alias("items"))
    hits = materialise(hits, "hits")
    spans = hits.groupBy("shard", "row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    of_windows = hits.select("shard", "row", F.explode("windows").alias("w"))
    # a window that very many documents hold is dealt to several tasks
    weights = materialise(of_windows.groupBy("w").agg(F.count("*").alias("n")).join(numbered, "w")
                          .join(named.groupBy("words").agg(F.collect_list("item").alias("own")), "words")
                          .select("w", "n", "own"), "hit-windows")
    ids = (spread_join(of_windows, weights, ["w"], "n").select("shard", "row", F.explode("own").alias("item"))
           .groupBy("shard", "row").agg(F.collect_set("item").alias("items")))
    return (every.join(spans.join(ids, ["shard", "row"]), ["shard", "row"], "left").select(
        "doc_id", "text_hash", "n_words",
        F.coalesce(_merged("spans"), F.array().cast("array<struct<s:int,e:int>>")).alias("spans"),
        F.coalesce(F.array_sort("items"), F.array().cast("array<string>")).alias("items")))


def _documents(batches):
    """Every document of the index: its shard and place there, ids and word count."""
    for b in batches:
        sizes = [len(d) for d in b.column("docs").to_pylist()]
        shard = [s for s, n in zip(b.column("shard").to_pylist(), sizes) for _ in range(n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard, pa.string()), pa.array([i for n in sizes for i in range(n)], pa.int32()),
             b.column("docs").flatten(), b.column("hashes").flatten(), b.column("words").flatten().cast(pa.int64())],
            names=["shard", "row", "doc_id", "text_hash", "n_words"])


def _search_block(index: DataFrame, windows: list[tuple[int, list[bytes]]], slop: int) -> DataFrame:
    """(shard, row, spans, windows) of the documents with hits of these windows."""
    vocab = sorted({w for _, words in windows for w in words})
    number = {w: i for i, w in enumerate(vocab)}
    table = np.full((len(windows), max((len(w) for _, w in windows), default=1)), len(vocab), np.int32)
    for i, (_, words) in enumerate(windows):
        table[i, :len(words)] = [number[w] for w in words]
    sent = index.sparkSession.sparkContext.broadcast((vocab, table, [w for w, _ in windows]))

    @lean
    def run(batches):
        vocab, table, numbers = sent.value
        lengths = (table < len(vocab)).sum(axis=1)
        for b in batches:
            for r in b.to_pylist():
                shard = _Shard(r["words"], r["terms"], r["starts"], r["positions"])
                here = np.array([*(shard.code.get(w, -1) for w in vocab), 0], np.int64)
                found: dict[int, set] = {}
                spans: dict[int, set] = {}
                for w in np.flatnonzero((here[table] >= 0).all(axis=1)).tolist():
                    codes = here[table[w, :lengths[w]]]
                    for d, s, e in zip(*(x.tolist() for x in shard.find(codes, slop))):
                        found.setdefault(d, set()).add(numbers[w])
                        first = int(shard.begins[d])
                        spans.setdefault(d, set()).add((s - first, e - first))
                yield pa.RecordBatch.from_pylist(
                    [{"shard": r["shard"], "row": d, "spans": [{"s": s, "e": e} for s, e in sorted(spans[d])],
                      "windows": sorted(found[d])} for d in sorted(found)], schema=_ARROW)

    return index.mapInArrow(run, "shard string, row int, spans array<struct<s:int,e:int>>, windows array<long>")


_ARROW = pa.schema([
    ("shard", pa.string()), ("row", pa.int32()),
    ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))), ("windows", pa.list_(pa.int64()))])


def _merged(name: str):
    """Overlapping or touching spans as one; few per document, so an array will do."""
    kind = "array<struct<s:int,e:int>>"

    def add(done, x):
        # done: the merged spans so far, the open one last
        last = F.get(done, F.size(done) - 1)
        open_, rest = last["e"], F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        wider = F.struct(last["s"].alias("s"), F.greatest(open_, x["e"]).alias("e"))
        return F.when(x["s"] <= open_, F.concat(rest, F.array(wider))).otherwise(
            F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(F.col(name)), F.array().cast(kind), add)


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = 10) -> DataFrame:
    """Documents without any window of any item; all their columns are kept."""
    k, h, own = unused(docs, "_k", "_h", "_own")
    hit = (search(build_index(docs), items, window=window).where(F.size("items") > 0)
           .select(F.col("doc_id").alias(k), F.col("text_hash").alias(h)).distinct())
    # few rows or many: Spark picks the join from their size
    return (docs.withColumn(own, F.xxhash64("text"))
            .join(hit, F.col("doc_id").cast("long").eqNullSafe(F.col(k)) & (F.col(own) == F.col(h)),
                  "left_anti").drop(own))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 10 words of all ``benchmark`` items in all ``documents``."""
    found = search(build_index(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"),
                   window=10)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


#: The same from the definition: every run of as many words as some window has.
OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n,
         array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT rid, n, w, unnest(generate_series(1, len(w) - n + 1)) AS i FROM words, sizes WHERE len(w) >= n)),
hits AS (SELECT rid, n, i, item FROM runs JOIN windows USING (n, phrase)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit
            FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""
