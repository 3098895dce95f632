"""Document fingerprints as invertible Bloom lookup sketches, in Spark's own functions.

A text's paragraphs are hashed to 64-bit digests, and each digest goes into
three of 24 cells; a cell keeps how many digests it holds, their exclusive-or
and that of a check of each. The fingerprint is those cells. Two fingerprints
subtract cell by cell: what both versions have cancels out, and peeling cells
that hold a single digest recovers the digests of the paragraphs that differ.
If more differ than 24 cells can tell apart, the sketch is made four times as
large (each of its parts holds the digests with its own leading bits) and tried
again, part by part, until all parts peel.

A paragraph is a line; a line of over 100 characters is parted at the first
sentence end after each 100. Blank lines are none. A paragraph that stands
twice counts twice.

Nulls and odd rows: null text is empty: no paragraphs, all cells zero, and two
empty texts are alike (1.0). A null doc_id sorts first; rows that share a
doc_id are versions each on its own, in the order of their text's hash. A
single row is its own next document; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.base import (materialise, range_edges, range_of, read, shuffle_width,
                                 text_or_empty)

_PARAGRAPH = r"[^\n]{100,}?[.!?](?=\s|$)|[^\n]+"
_ROUNDS = 8

_CELL = "struct<n:int,k:bigint,h:int>"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _pattern(masks: list[tuple[int, int]]) -> Column:
    """[(mask, value)] as an array; a digest is in slot i if digest & mask = value."""
    return F.array(*(F.struct(F.lit(_signed(m)).cast("long").alias("m"),
                              F.lit(_signed(v)).cast("long").alias("v")) for m, v in masks))


def _slots(level: int) -> Column:
    """24 cells: three tables of eight, by three bits each, other bits at each level."""
    shift = 9 * (level % 4)
    return _pattern([(7 << shift + 3 * t, i << shift + 3 * t) for t in range(3) for i in range(8)])


def _cell(n, k, h) -> Column:
    return F.struct(n.cast("int").alias("n"), k.alias("k"), h.alias("h"))


def _bind(value: Column, use) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digests(text: Column) -> Column:
    """The sorted paragraph digests of a text; the i-th copy has its own digest."""
    raw = F.array_sort(F.transform(
        F.filter(F.regexp_extract_all(text, F.lit(_PARAGRAPH), F.lit(0)), lambda p: F.trim(p) != ""),
        lambda p: F.xxhash64(p)))

    def numbered(all_):
        steps = F.array(*(F.lit(1 << b) for b in range(30, -1, -1)))

        def below(x):  # how many entries are smaller, by binary search
            return F.aggregate(steps, F.lit(0), lambda at, jump: F.when(
                F.get(all_, at + jump - 1) < x, at + jump).otherwise(at))

        return F.transform(all_, lambda x, i: F.xxhash64(x, i - below(x)))

    return _bind(raw, lambda r: F.when(
        F.size(F.array_distinct(r)) == F.size(r), F.transform(r, lambda x: F.xxhash64(x, F.lit(0))))
        .otherwise(numbered(r)))


def sketch(elements: Column, level: int = 0) -> Column:
    """The cells of an array of digests."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).alias("h"))
    return F.transform(_slots(level), lambda s: F.aggregate(elements, zero, lambda c, x: F.when(
        x.bitwiseAND(s["m"]) == s["v"],
        _cell(c["n"] + 1, c["k"].bitwiseXOR(x), c["h"].bitwiseXOR(F.hash(x)))).otherwise(c)))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda p, q: _cell(
        p["n"] - q["n"], p["k"].bitwiseXOR(q["k"]), p["h"].bitwiseXOR(q["h"])))


def peel(cells: Column, level: int = 0) -> Column:
    """struct(ok, added, removed): the digests recovered from a difference."""
    none = F.array().cast("array<bigint>")
    start = F.struct(cells.alias("cells"), none.alias("added"), none.alias("removed"))

    def step(s, _):
        pure = F.array_distinct(F.filter(s["cells"], lambda c: (F.abs(c["n"]) == 1)
                                         & (c["h"] == F.hash(c["k"]))))

        def without(p):
            left = F.zip_with(s["cells"], _slots(level), lambda c, slot: F.aggregate(
                p, c, lambda acc, q: F.when(
                    q["k"].bitwiseAND(slot["m"]) == slot["v"],
                    _cell(acc["n"] - q["n"], acc["k"].bitwiseXOR(q["k"]), acc["h"].bitwiseXOR(q["h"])))
                .otherwise(acc)))

            def keys(n):
                return F.transform(F.filter(p, lambda q: q["n"] == n), lambda q: q["k"])

            return F.when(F.size(p) == 0, s).otherwise(F.struct(
                left.alias("cells"), F.concat(s["added"], keys(1)).alias("added"),
                F.concat(s["removed"], keys(-1)).alias("removed")))

        return _bind(pure, without)

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_ROUNDS)), start, step,
        lambda s: F.struct((~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["k"] != 0))).alias("ok"),
                           s["added"].alias("added"), s["removed"].alias("removed")))


def _first_try(a: Column, b: Column) -> Column:
    """The number of differing digests if the 24 cells tell them apart, else null."""
    return _bind(peel(subtract(sketch(a), sketch(b))), lambda d: F.when(
        d["ok"], (F.size(d["added"]) + F.size(d["removed"])).cast("long")))


def serialised(cells: Column) -> Column:
    """The cells as text: base64 of count, exclusive-or and check, big-endian."""
    one = F.transform(cells, lambda c: F.concat(
        F.lpad(F.hex(c["n"]), 8, "0"), F.lpad(F.hex(c["k"]), 16, "0"),
        F.lpad(F.hex(c["h"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")))
    return F.regexp_replace(F.base64(F.unhex(F.array_join(one, ""))), "\\s", "")


def recover(pairs: DataFrame, level: int = 0) -> DataFrame:
    """(uid, kind, added, removed) of digest arrays a and b, whatever their size:
    for pairs whose sketch of 4**level parts failed, one or more rows that add up.

    Each round parts what did not peel by its next two leading bits, which makes
    the sketch four times as large, and writes what peeled and what did not. At
    the last bits what is left is compared directly.
    """
    todo, found = pairs.select("uid", "kind", "a", "b"), []
    while True:
        bits = 64 - 2 * (level + 1)
        if bits < 0:
            found.append(todo.select("uid", "kind", F.array_except("a", "b").alias("added"),
                                     F.array_except("b", "a").alias("removed")))
            break
        level += 1
        split = F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.struct(*(
            F.filter(F.col(c), lambda x: F.shiftrightunsigned(x, bits).bitwiseAND(F.lit(3)) == q).alias(c)
            for c in ("a", "b")))))
        tried = (todo.select("uid", "kind", split.alias("p")).select("uid", "kind", "p.a", "p.b")
                 .where((F.size("a") > 0) | (F.size("b") > 0))
                 .withColumn("d", peel(subtract(sketch(F.col("a"), level), sketch(F.col("b"), level)), level))
                 .select("uid", "kind", F.col("d.ok").alias("ok"),
                         *(F.when(F.col("d.ok"), F.col(f"d.{c}")).alias(c) for c in ("added", "removed")),
                         *(F.when(~F.col("d.ok"), F.col(c)).alias(c) for c in ("a", "b"))))
        tried = materialise(tried, "peeled")
        found.append(tried.where("ok").select("uid", "kind", "added", "removed"))
        todo = tried.where("not ok").select("uid", "kind", "a", "b")
        if todo.isEmpty():
            break
    every = found[0]
    for f in found[1:]:
        every = every.union(f)
    return every


def with_next(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(uid, doc_id, text, next): each row with the text after it in ascending key
    order; after the last comes the first.

    One shuffle by key range. The rows with a range's first key also go to the
    range before it (those of the first range to the last), behind its own rows,
    so no row has to look into another task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    width = shuffle_width(spark)
    edges = range_edges(rows, "doc_id", 4 * width)
    last = max(len(edges) - 1, 0)
    first_keys = F.array(*map(F.lit, edges or [0])).cast("array<bigint>")
    at = range_of(F.col("doc_id"), edges)
    own = F.struct(at.alias("r"), F.lit(False).alias("copy"))
    starts = F.col("doc_id").isNull() | (F.col("doc_id") == F.get(first_keys, at))
    before = F.struct(F.when(at == 0, F.lit(last)).otherwise(at - 1).alias("r"), F.lit(True).alias("copy"))
    dealt = (rows.withColumn("to", F.explode(F.when(starts, F.array(own, before)).otherwise(F.array(own))))
             .select("doc_id", "text", "to.r", "to.copy").repartition(width, "r")
             .withColumn("h", F.xxhash64("text")))
    order = Window.partitionBy("r").orderBy("copy", F.col("doc_id").asc_nulls_first(), "h")
    return (dealt.withColumn("next", F.lead("text").over(order))
            .withColumn("uid", F.col("r").cast("long") * F.lit(1 << 40) + F.row_number().over(order))
            .where("not copy").select("uid", "doc_id", "text", "next"))


def _likeness(n: str, m: str, d: Column) -> Column:
    both = F.col(n) + F.col(m)
    return F.when(both == 0, F.lit(1.0)).otherwise(((both - d) / both).cast("double"))


def edited_versions(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against its edited text and the next document."""
    n_chars = F.char_length("text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars") - half),
                      F.substring("next", F.lit(1), half))
    rows = (with_next(docs, key=key, text=text).withColumn("n_chars", n_chars)
            .withColumn("edited", edited)
            .select("uid", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("e"),
                    digests(F.col("next")).alias("x"))
            .select("*", *(_first_try(F.col("a"), F.col(c)).alias(f"d_{c}") for c in "ex")))
    rows = materialise(rows, "versions")
    pairs = rows.select("uid", F.explode(F.filter(F.array(*(
        F.struct(F.lit(c).alias("kind"), F.col("a"), F.col(c).alias("b"), F.col(f"d_{c}").isNull().alias("open"))
        for c in "ex")), lambda p: p["open"])).alias("p")).select("uid", "p.kind", "p.a", "p.b")
    size = (F.size("added") + F.size("removed")).cast("long")
    sums = recover(pairs).groupBy("uid").agg(
        *(F.sum(F.when(F.col("kind") == c, size)).alias(f"s_{c}") for c in "ex"))
    solved = rows.join(sums, "uid", "left").select(
        "doc_id", "n_chars", "edited_sha256", *(F.size(c).alias(f"n_{c}") for c in "aex"),
        *(F.coalesce(f"d_{c}", f"s_{c}", F.lit(0).cast("long")).alias(f"d_{c}") for c in "ex"),
        serialised(sketch(F.col("a"))).alias("fingerprint"),
        serialised(sketch(F.col("e"))).alias("edited_fingerprint"))
    return solved.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fingerprint",
        "edited_fingerprint", _likeness("n_a", "n_e", F.col("d_e")).alias("near_edited"),
        _likeness("n_a", "n_x", F.col("d_x")).alias("near_next"),
        F.col("n_a").cast("long").alias("n_paragraphs"), F.col("d_e").alias("n_differing"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` against its edited text and the next document."""
    return edited_versions(read(spark, sf_dir, "documents"))
