import hashlib
import random
import re

import pytest

from ledgerloom.llm import decontaminate as dc
from tests.llm.conftest import documents
from tests.oracle_check import compare, duck

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(doc, items, window=10):
    own, hit, named = words(doc), set(), set()
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            part = w[i:i + window]
            for at in range(len(own) - len(part) + 1):
                if own[at:at + len(part)] == part:
                    hit.update(range(at, at + len(part)))
                    named.add(str(item) if item is not None else "null")
    return len(own), len(hit), sorted(named)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(2)
    vocab = ["a", "b", "É", "straße", "x1", "Don't", "日本"]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 60)))) for i in range(60)]
    rows += [(5, None), (None, "x1 b"), (7, rows[7][1]), (99, "b " * 30_000), (100, "")]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 5)))) for i in range(8)]
    items += [(20, rows[3][1]), (21, None), (None, rows[4][1]), (20, "a b a b"), (22, rows[9][1])]
    return rows, items


@pytest.mark.parametrize("block,chars", [(100_000, 2_000_000), (5, 100)])
def test_equals_brute_force(spark, case, block, chars):
    rows, items = case
    index = dc.build_index(documents(spark, rows), shard_chars=chars)
    found = dc.search(index, spark.createDataFrame(items, "item_id long, text string"), block=block)
    got = sorted((str(r.doc_id), r.n_words, sum(s.e - s.s for s in r.spans), r.items)
                 for r in found.collect())
    assert got == sorted((str(k), *brute(t, items)) for k, t in rows)


def test_proximity(spark):
    docs = documents(spark, [(1, "one two big three"), (2, "one two three"), (3, "one x y z two three")])
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    index = dc.build_index(docs)
    near = {r.doc_id: [tuple(s) for s in r.spans] for r in dc.search(index, items, slop=1).collect()}
    assert near == {1: [(0, 4)], 2: [(0, 3)], 3: []}
    exact = {r.doc_id for r in dc.search(index, items).collect() if r.items}
    assert exact == {2}


def near(doc, part, slop):
    """Spans of matches by trying: from each place of the first word, the nearest next
    word from which the rest can be reached."""
    def end(p, k):
        if k == len(part):
            return p + 1
        for q in range(p + 1, min(len(doc), p + 2 + slop)):
            if doc[q] == part[k] and (e := end(q, k + 1)) is not None:
                return e
        return None

    return {(p, e) for p in range(len(doc)) if doc[p] == part[0] and (e := end(p, 1)) is not None}


@pytest.mark.parametrize("slop", [1, 2, 3])
def test_proximity_equals_brute_force_whatever_the_shards(spark, slop):
    rng = random.Random(slop)
    rows = [(i, " ".join(rng.choices("abcdx", k=rng.randint(0, 25)))) for i in range(50)]
    items = [(i, " ".join(rng.choices("abcd", k=rng.randint(1, 5)))) for i in range(12)]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for k, t in rows:
        w, covered, named = words(t), set(), set()
        for i, x in items:
            for a, b in near(w, words(x), slop):
                covered.update(range(a, b))
                named.add(str(i))
        want[k] = (len(covered), sorted(named))
    for chars, more in ((2_000_000, 0), (60, 0), (200, 300)):
        extra = [(1000 + i, "b " * 9) for i in range(more)]  # makes other words the rarest
        index = dc.build_index(documents(spark, rows + extra), shard_chars=chars)
        got = {r.doc_id: (sum(s.e - s.s for s in r.spans), r.items)
               for r in dc.search(index, table, slop=slop, window=5, block=5).collect() if r.doc_id < 1000}
        assert got == want


def test_a_match_does_not_depend_on_its_neighbours(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    for more in ([], [(2, "a a a a")], [(2, "b b b b")], [(2, "c"), (0, "a x b y")]):
        index = dc.build_index(documents(spark, [(1, "a x b y c"), *more]))
        found = {r.doc_id: r.items for r in dc.search(index, items, slop=1).collect()}
        assert found.pop(1) == ["1"] and not any(found.values())


def test_no_column_of_the_caller_is_touched(spark):
    docs = documents(spark, [(1, "a b"), (2, "c d")]).selectExpr(
        "*", "1 as _own", "2 as _k", "3 as _h", "4 as __own", "5 as shard", "6 as row", "7 as items")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    kept = dc.decontaminate(docs, items)
    assert kept.columns == docs.columns and [tuple(r)[5:] for r in kept.collect()] == [(1, 2, 3, 4, 5, 6, 7)]


def test_empty_tables_and_filter(spark, case):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, [(1, "a b"), (1, "c d"), (None, "a b e"), (None, None)])
    assert all(not r.items for r in dc.search(dc.build_index(docs), none).collect())
    assert dc.search(dc.build_index(documents(spark, [])), none).count() == 0
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    kept = dc.decontaminate(docs.withColumnRenamed("source", "items"), items)
    assert [(r.doc_id, r.text) for r in kept.collect()] in ([(1, "c d"), (None, None)], [(None, None), (1, "c d")])
    assert kept.columns == ["doc_id", "text", "lang", "items", "n_chars"]


def test_query_matches_sql(spark, sf):
    n, problems = compare(spark, duck(sf), "op2", dc.op2_decontamination, dc.OP2_SQL, sf)
    assert n and not problems, problems
    none = hashlib.sha256(b"").hexdigest()
    assert any(r.items_sha256 != none for r in dc.op2_decontamination(spark, sf).collect())
