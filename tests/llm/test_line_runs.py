import random

import numpy as np
import pytest

from ledgerloom.llm import line_runs as lr
from ledgerloom.llm.base import materialise, read
from tests.llm.conftest import documents
from tests.oracle_check import compare, duck


def brute(rows, min_words=None):
    """rows: (doc_id, text, hash, ...). All repeated runs of all lengths, one by one."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, rows[i][2]))
    seqs = []
    for i in order:
        raw = (rows[i][1] or "").split("\n")
        seqs.append([(n, x.strip(" "), len(x.split())) for n, x in enumerate(raw) if x.split()])
    first: dict[tuple, tuple] = {}
    gone = [set() for _ in rows]
    for d, seq in enumerate(seqs):
        for i in range(len(seq)):
            for j in range(i, len(seq)):
                if sum(w for _, _, w in seq[i:j + 1]) >= (min_words or 1):
                    run = tuple(s for _, s, _ in seq[i:j + 1])
                    if first.setdefault(run, (d, i)) != (d, i):
                        gone[d].update(n for n, _, _ in seq[i:j + 1])
    out = []
    for d, i in enumerate(order):
        t = rows[i][1]
        if t is not None and gone[d]:
            rest = [x for n, x in enumerate(t.split("\n")) if n not in gone[d]]
            t = "\n".join(rest) if any(x.strip() for x in rest) else ""
        out.append((str(rows[i][0]), str(t), len(gone[d])))
    return sorted(out)


def keyed(docs):
    from pyspark.sql import functions as F
    return [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64("text")).collect()]


def run(docs, **k):
    return sorted((str(r.doc_id), str(r.text), r.n_deleted) for r in lr.dedup_lines(docs, **k).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    lines = ["a", "b c", "d e f", "g h i j k", "l m n o p q r s t u v", " a ", "", "  "]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 14)))) for i in range(40)]
    docs = documents(spark, rows)
    assert run(docs, min_words=7) == brute(keyed(docs), 7)
    assert run(docs) == run(docs, min_words=1) == brute(keyed(docs))


def test_odd_rows(spark):
    body = "\n".join(f"line number {i} of a long passage that repeats" for i in range(30))
    rows = [(1, body), (2, "own first line here\n" + body + "\nown last"), (2, "own first line here\n" + body + "\nown last"),
            (2, "x"), (None, body), (None, None), (3, ""), (4, None), (5, "tiny"), (5, "tiny"), (6, "\n\n"),
            (7, "w " * 50_000), (8, "w " * 50_000 + "\nand more"), (9, body + "\n\n" + body)]
    docs = documents(spark, rows).withColumnRenamed("source", "deleted").withColumnRenamed("lang", "h")
    assert run(docs) == brute(keyed(docs))
    assert run(docs, min_words=10) == brute(keyed(docs), 10)
    assert lr.dedup_lines(docs).columns == [*docs.columns, "n_deleted"]
    assert lr.dedup_lines(documents(spark, [])).count() == 0


def test_equal_rows_and_equal_texts_lose_the_same_lines(spark):
    """Words parted by NBSP count as words everywhere."""
    for gap in (" ", "\u00a0", "\u3000"):
        line = gap.join(["word"] * 12)
        rows = [(1, line), (1, line), (2, line), (3, "\u00a0\n" + line)]
        for floor in (None, 10, 13):
            got = sorted((r.doc_id, r.n_deleted) for r in lr.dedup_lines(documents(spark, rows), min_words=floor).collect())
            assert got == ([(1, 0), (1, 1), (2, 1), (3, 1)] if floor != 13 else [(1, 0), (1, 0), (2, 0), (3, 0)])


def test_no_column_of_the_caller_is_touched(spark):
    names = ["_k", "_h", "_id", "_hash", "_gone", "_row", "_first", "_words", "_cut", "__k", "rows", "words", "h"]
    docs = documents(spark, [(1, "a\nb"), (1, "a\nb"), (2, "b\nc")])
    for n in names:
        docs = docs.selectExpr("*", f"'{n}' as {n}")
    out = lr.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_deleted"]
    assert all(r[n] == n for r in out.collect() for n in names)
    kept = lr.without_repeats(docs.withColumnRenamed("_cut", "n_deleted"))
    assert all(r.n_deleted == "_cut" for r in kept.collect()) and kept.count() == 2


def test_rounds_go_on_until_no_rank_is_shared(spark):
    body = [f"l{i}" for i in range(37)]
    rows = [(1, "\n".join(["x", *body])), (2, "\n".join([*body, "y"])), (3, "\n".join(body[5:21]))]
    seqs = materialise(lr.line_sequences(documents(spark, rows)), "t-lines")
    ranks = lr.suffix_ranks(seqs).collect()
    assert max(r.level for r in ranks) == 5  # 37 lines: 32 at two places, 64 nowhere
    shared = {r.level: {(r.doc_id, r.pos) for r in ranks if r.level == r.level and r.level == k}
              for k in range(6) for r in ranks if r.level == k}
    assert len(shared[5]) == 12 and len(shared[4]) == 2 * 22 + 1
    assert {(r.doc_id, r.pos) for r in ranks if r.level == 4 and r.later} == {(2, p) for p in range(22)} | {(3, 0)}


def test_shortest_parts():
    assert lr.shortest_parts(np.array([30, 30, 5]), 50) == [(0, 2), (0, 3)]
    assert lr.shortest_parts(np.array([3]), 5) == [] == lr.shortest_parts(np.array([], int), 5)


def test_ranks_are_suffix_order(spark):
    """Ranks of two lines order the suffixes as their first two ids do."""
    rng = random.Random(3)
    docs = documents(spark, [(i, "\n".join(rng.choices("abcd", k=12))) for i in range(15)])
    seqs = materialise(lr.line_sequences(docs), "t-lines")
    ids = {(r.doc_id, p): (r.x[p], r.y[p]) for r in seqs.collect() for p in range(len(r.x))}
    got = [r for r in lr.suffix_ranks(seqs, 2).collect() if r.level == 1]
    key = {(r.doc_id, r.pos): (ids[r.doc_id, r.pos], ids[r.doc_id, r.pos + 1]) for r in got}
    by_rank = sorted(got, key=lambda r: r["rank"])
    keys = [key[r.doc_id, r.pos] for r in by_rank]
    assert keys == sorted(keys) and len({(r["rank"]) for r in got}) == len(set(keys))


def test_query_matches_sql(spark, sf):
    n, problems = compare(spark, duck(sf), "op10", lr.op10_line_dedup, lr.OP10_SQL, sf)
    assert n and not problems, problems
    assert any(r.n_deleted for r in lr.op10_line_dedup(spark, sf).collect())
    lines = [x.strip(" ") for t, in lr.dedup_lines(read(spark, sf, "documents")).select("text").collect()
             for x in (t or "").split("\n") if x.split()]
    assert len(lines) == len(set(lines))  # no later copy is left
