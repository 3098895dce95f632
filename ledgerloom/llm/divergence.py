"""How far the sources of a language differ in their words.

An Arrow compute pipeline turns batches of texts into partial counts: ``ascii_lower``,
``split_pattern_regex``, ``dictionary_encode`` and two hash ``group_by`` steps, the
first per document and term, the second per language, source and term. Spark merges
the counts by (language, term) and keeps the terms that enough documents of the
language have. The kept counts are dealt to shards of bounded size, whole terms at a
time. A shard is a matrix of terms by sources; it gives, for each pair of sources, the
divergence that its own terms add, and Spark adds the shards up.

Arithmetic is exact: probabilities are whole billionths (at least one), a term's
divergence between p and q is floor((p - q)**2 / q), and sums are carried in two
parts, so that no shard can overflow.

Nulls and odd rows: null text, language and source count as empty strings; every row
is a document of its own, whatever its doc_id; a source without terms takes part with
the counts 0; a language without kept terms has divergence 0 between its sources; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.base import materialise, read, ship
from ledgerloom.llm.encoding import larger

#: What parts terms: all ASCII signs but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Kept counts in a shard, about; the cells of a matrix in a task.
SHARD_ROWS, CELLS = 20_000, 2_000_000
_SPLIT = 20  # sums are carried as multiples of 2**20 and the rest

_COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang",
                source: str = "source") -> DataFrame:
    """Partial counts (lang, source, term, n, docs) of each few megabytes of text;
    a row with a null term for every (lang, source) there."""
    ship(docs.sparkSession)

    def counted(b: pa.RecordBatch) -> pa.RecordBatch:
        langs, sources = b.column("l").dictionary_encode(), b.column("s").dictionary_encode()
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        lists = pc.split_pattern_regex(pc.ascii_lower(b.column("t")), pattern=BETWEEN)
        words, doc = lists.flatten(), pc.list_parent_indices(lists)
        some = pc.not_equal(words, "")
        words, doc = words.filter(some).dictionary_encode(), doc.filter(some)
        by_doc = (pa.table({"doc": doc, "term": words.indices}).group_by(["doc", "term"], use_threads=False)
                  .aggregate([([], "count_all")]))
        by_group = (pa.table({"group": group[by_doc["doc"].to_numpy()], "term": by_doc["term"],
                              "n": by_doc["count_all"]})
                    .group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")]))
        here = np.unique(group)
        every = np.concatenate([by_group["group"].to_numpy(), here])
        none = pa.nulls(len(here), pa.int64())
        zeros = np.zeros(len(here), np.int64)
        return pa.RecordBatch.from_arrays(
            [langs.dictionary.take(pa.array(every // max(1, len(sources.dictionary)))),
             sources.dictionary.take(pa.array(every % max(1, len(sources.dictionary)))),
             words.dictionary.take(pa.concat_arrays(
                 [by_group["term"].combine_chunks().cast(pa.int64()), none])),
             pa.array(np.concatenate([by_group["n_sum"].to_numpy(), zeros])),
             pa.array(np.concatenate([by_group["count_all"].to_numpy(), zeros]))],
            names=["lang", "source", "term", "n", "docs"])

    def run(batches):
        for b in larger(batches):
            yield counted(b)

    def plain(name, to):
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(to)

    return docs.select(plain(lang, "l"), plain(source, "s"), plain(text, "t")).mapInArrow(run, _COUNTS)


def kept_counts(counts: DataFrame, *, min_docs: int = 3) -> DataFrame:
    """Merged counts of the terms that ``min_docs`` documents of the language have, and
    the null-term rows of all groups; ``total``: the term's count in the language;
    ``first``: one row of each (lang, term). One shuffle."""
    whole = Window.partitionBy("lang", "term")
    merged = (counts.repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return materialise(
        merged.withColumn("in_docs", F.sum("docs").over(whole)).withColumn("total", F.sum("n").over(whole))
        .withColumn("first", F.row_number().over(whole.orderBy("source")) == 1)
        .where(F.col("term").isNull() | (F.col("in_docs") >= min_docs))
        .select("lang", "source", "term", "n", "total", "first"), "kept")


def group_sizes(kept: DataFrame, *, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(lang, source, n_all, lang_all, terms, shards) of every group: its kept terms'
    count and its language's, the number of those terms and of their shards."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_all"))
    lang = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_all"),
        F.count(F.when(F.col("first") & F.col("term").isNotNull(), 1)).alias("terms"),
        F.greatest(F.lit(1), F.ceil(F.count("term") / shard_rows)).alias("shards"))
    return materialise(own.join(lang, "lang"), "groups")


def _share(n: str, total: str):
    """One more than the whole billionths of (n + 1) / (total + terms)."""
    return F.expr(f"1L + ((1000000000 * cast({n} + 1 as decimal(28,0))) div cast({total} + terms as decimal(28,0)))")


def leading_terms(kept: DataFrame, groups: DataFrame, *, most: int = 200) -> DataFrame:
    """Of each group the ``most`` terms that it has more of than its language, by
    their divergence, then by their bytes."""
    rows = (kept.where("term IS NOT NULL AND n > 0").join(groups, ["lang", "source"])
            .select("lang", "source", F.col("term").alias("item"),
                    _share("n", "n_all").alias("p"), _share("total", "lang_all").alias("q"))
            .where("p > q").withColumn("value", F.expr("((p - q) * (p - q)) div q")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
            .select("lang", "source", "item", "value", "rank"))


def _shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """:func:`_share` of many counts, by Python's integers."""
    some, at = np.unique(counts, return_inverse=True)
    return np.array([1 + 1_000_000_000 * (c + 1) // (total + terms) for c in some.tolist()],
                    np.int64)[at.reshape(counts.shape)]


def _sums(f: np.ndarray) -> np.ndarray:
    """Column sums in two parts, as a (2, columns) array."""
    return np.stack([(f >> _SPLIT).sum(axis=0), (f & ((1 << _SPLIT) - 1)).sum(axis=0)])


def shard_divergence(counts: np.ndarray, totals: list[int], terms: int) -> np.ndarray:
    """Of a (terms, sources) matrix of counts: for each pair of sources (a, b) the sum
    over the terms of floor((p_a - p_b)**2 / p_b), in two parts: (2, sources, sources).

    Most counts of a source may be 0, and these all have the same share. So a row a
    visits only the terms that a has; the others come from the counts of each b.
    """
    n = counts.shape[1]
    p = np.stack([_shares(counts[:, s], totals[s], terms) for s in range(n)], axis=1)
    none = np.array([1 + 1_000_000_000 // (t + terms) for t in totals], np.int64)
    out = np.zeros((2, n, n), np.int64)
    for b in range(n):  # all terms as if a had none of them
        some, times = np.unique(p[:, b], return_counts=True)
        f = (none[None, :] - some[:, None]) ** 2 // some[:, None]
        out[0, :, b] += ((f >> _SPLIT) * times[:, None]).sum(axis=0)
        out[1, :, b] += ((f & ((1 << _SPLIT) - 1)) * times[:, None]).sum(axis=0)
    for a in range(n):  # and those that it has put right
        own = p[counts[:, a] > 0]
        out[:, a] += _sums((own[:, [a]] - own) ** 2 // own) - _sums((none[a] - own) ** 2 // own)
    return out


def pair_divergences(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): each other source of the language as item."""
    shard = F.pmod(F.xxhash64("term"), F.col("shards"))
    sizes = groups.select("lang", "source", "n_all", "terms",
                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    rows = (kept.where("term IS NOT NULL").join(groups.select("lang", "source", "shards"), ["lang", "source"])
            .select("lang", shard.alias("shard"), "source", "term", "n"))

    def compare(counts: pa.Table, sizes: pa.Table) -> pa.Table:
        names = sizes["source"].to_pylist()
        totals, n = sizes["n_all"].to_pylist(), len(names)
        sums = np.zeros((2, n, n), np.int64)
        if len(counts):
            term = counts["term"].combine_chunks().dictionary_encode()
            order = np.argsort(term.indices.to_numpy(), kind="stable")
            code = term.indices.to_numpy()[order].astype(np.int64)
            col = pc.index_in(counts["source"].combine_chunks(),
                              value_set=pa.array(names, pa.string())).to_numpy()[order]
            value = counts["n"].to_numpy()[order]
            step = max(1, CELLS // n)
            for low in range(0, len(term.dictionary), step):
                high = min(low + step, len(term.dictionary))
                a, b = np.searchsorted(code, [low, high])
                matrix = np.zeros((high - low, n), np.int64)
                matrix[code[a:b] - low, col[a:b]] = value[a:b]
                sums += shard_divergence(matrix, totals, sizes["terms"][0].as_py())
        a, b = np.nonzero(~np.eye(n, dtype=bool))
        lang = sizes["lang"][0].as_py() if n else ""
        source = pa.array(names, pa.string())
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": source.take(pa.array(a)),
                         "item": source.take(pa.array(b)), "high": sums[0][a, b], "low": sums[1][a, b]})

    parts = rows.groupBy("lang", "shard").cogroup(sizes.groupBy("lang", "shard")).applyInArrow(
        compare, "lang string, source string, item string, high long, low long")
    value = (F.sum("high").cast("decimal(38,0)") * F.lit(1 << _SPLIT) + F.sum("low")).cast("long")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (parts.groupBy("lang", "source", "item").agg(value.alias("value"))
            .withColumn("rank", F.row_number().over(order)))


def audit(docs: DataFrame, *, min_docs: int = 3, most: int = 200) -> DataFrame:
    """Both reports, as parts ``pair`` and ``term``."""
    kept = kept_counts(term_counts(docs), min_docs=min_docs)
    groups = group_sizes(kept)

    def part(name, df):
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part("pair", pair_divergences(kept, groups)).union(
        part("term", leading_terms(kept, groups, most=most)))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language in all ``documents``."""
    return audit(read(spark, sf_dir, "documents"))


#: The same from the definition, with every count spelled out.
OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT rid, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
grp AS (SELECT DISTINCT lang, source FROM docs),
vocab AS (SELECT lang, count(term) AS v, coalesce(sum(total), 0) AS lang_all
          FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
sizes AS (SELECT grp.lang, grp.source, coalesce(sum(n), 0) AS n_all
          FROM grp LEFT JOIN counts ON counts.lang = grp.lang AND counts.source = grp.source GROUP BY ALL),
shares AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (s.n_all + v.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.total + 1)) // (v.lang_all + v.v) AS q
  FROM sizes s JOIN vocab v USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q),
every AS (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' AS part FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 200
"""
