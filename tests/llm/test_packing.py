import random
import zlib
from itertools import product

from ledgerloom.llm import packing as p
from ledgerloom.llm.base import materialise, read
from ledgerloom.llm.encoding import WordEncoder, public_path
from tests.llm.conftest import documents

WORD = public_path("word_bpe_49k.json")


def test_fullest_equals_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        left = {rng.randint(1, 12): rng.randint(0, 3) for _ in range(rng.randint(1, 5))}
        room, order = rng.randint(0, 25), sorted(left, reverse=True)
        best = max(t for n in product(*(range(left[k] + 1) for k in order))
                   if (t := sum(a * k for a, k in zip(n, order))) <= room)
        got = p.fullest(room, left, order)
        assert sum(k * n for k, n in got) == best
        assert all(n <= left[k] for k, n in got)


def test_plan_uses_each_piece_once_and_few_bins():
    rng = random.Random(5)
    counts = {rng.randint(1, 100): rng.randint(1, 5000) for _ in range(60)}
    bins = p.plan(counts, 100)
    used: dict[int, int] = {}
    for n, each in bins:
        assert sum(k * t for k, t in each) <= 100
        for k, t in each:
            used[k] = used.get(k, 0) + n * t
    assert used == counts
    total = sum(k * n for k, n in counts.items())
    long_ = sum(n for k, n in counts.items() if k > 50)
    assert sum(n for n, _ in bins) <= max(-(-total // 100), long_) * 1.05 + 2
    assert len(bins) < 1000


def _check(rows, capacity):
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_odd_rows_and_long_documents(spark):
    rows = [(1, None), (1, None), (None, "a b c"), (2, ""), (3, "word " * 30), (3, "word " * 30)]
    got = p.pack_documents(documents(spark, rows), capacity=8).collect()
    assert sum(r.length for r in got) == 1 + 1 + 4 + 1 + 31 + 31
    assert _check(got, 8) == -(-69 // 8)
    assert sorted(r.piece for r in got if r.doc_id == 3) == [0, 0, 1, 1, 2, 2, 3, 3]
    assert p.pack_documents(documents(spark, [])).count() == 0


def test_hot_length(spark):
    pieces = spark.range(5000).selectExpr(
        "id as doc_id", "0 as piece", "0L as start", "if(id % 3 = 0, 7L, 1 + id % 9) as length",
        "id as ids_crc32")
    got = p.pack(materialise(pieces, "t-pieces"), capacity=20, rows_per_salt=10).collect()
    assert len({r.doc_id for r in got}) == len(got) == 5000
    assert _check(got, 20) <= 1.2 * sum(r.length for r in got) / 20


def test_query_over_whole_table(spark, sf):
    got = p.op9_best_fit_packing(spark, sf).collect()
    e, want = WordEncoder(WORD), []
    for d in read(spark, sf, "documents").collect():
        ids = e.encode(d.text) + b"\1\0\0\0"
        want += [(d.doc_id, i, a // 4, len(ids[a:a + 16384]) // 4, zlib.crc32(ids[a:a + 16384]))
                 for i, a in enumerate(range(0, len(ids), 16384))]
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    assert _check(got, 4096) <= -(-sum(w[3] for w in want) // 4096) + 1
