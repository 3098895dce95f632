import random

import numpy as np
import xxhash

from ledgerloom.llm import simhash as sh
from ledgerloom.llm.base import read
from ledgerloom.llm.components import components
from tests.llm.conftest import documents


def brute_fp(text, k=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    """rows: (doc_id, fp); least reachable non-null doc_id for each row."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    arr = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= 3):
            a, b = find(f), find(fps[i + 1 + j])
            root[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for k, f in rows:
        if k is not None:
            least[find(f)] = min(k, least.get(find(f), k))
    return sorted((str(k), f, least.get(find(f))) for k, f in rows)


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(0, 200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    rand = [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)] + [(-5, 3)]
    edges = chain + star + rand
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    parent: dict[int, int] = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert got == want


def test_forest_joins_the_same():
    rng = np.random.default_rng(1)
    u, v = rng.integers(0, 500, 2000), rng.integers(0, 500, 2000)
    x, y = sh.forest(u, v, 500)
    assert len(x) < 500
    a, _ = sh.forest(np.concatenate([u, x]), np.concatenate([v, y]), 500)
    assert len(a) == len(x)


def test_links_with_many_tiles(spark):
    rng = random.Random(8)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for f in list(fps):
        for _ in range(rng.randint(0, 6)):
            for _ in range(rng.randint(0, 4)):
                f ^= 1 << rng.randrange(64)
            fps.append(f)
    fps = sorted(set(fps))
    table = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = sh.links(table, tile=50, tiles=1000).collect()
    pairs = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64))) for r in got]
    rows = [(i, f) for i, f in enumerate(fps)]
    index = {f: i for i, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(index[a]), find(index[b])
        root[max(x, y)] = min(x, y)
    assert sorted((str(i), f, find(i)) for i, f in rows) == brute_classes(rows)


def test_spread_join_equals_join(spark):
    from ledgerloom.llm.base import materialise, spread_join
    left = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 7, id % 900) as k", "id % 2 as j")
    right = materialise(left.groupBy("k", "j").count().selectExpr("k", "j", "count as n", "k * 10 as v")
                        .where("k <> 5"), "t-right")
    got = sorted(map(tuple, spread_join(left, right, ["k", "j"], "n", share=20).select("id", "v").collect()))
    assert got == sorted(map(tuple, left.join(right, ["k", "j"]).select("id", "v").collect()))


def test_odd_rows(spark):
    text = "Alpha beta gamma delta " * 40
    rows = [(3, text), (1, text + "end"), (None, text), (9, None), (8, ""), (7, "  \n"), (3, "two words"),
            (4, "TWO\tWORDS"), (5, "Été été x y z"), (None, "alone in the dark")]
    docs = documents(spark, rows).withColumnRenamed("source", "fp")
    got = sorted((str(r.doc_id), int(np.int64(r.fp).view(np.uint64)), r.component_id)
                 for r in sh.near_duplicates(docs).collect())
    assert got == brute_classes([(k, brute_fp(t)) for k, t in rows])
    assert sh.near_duplicates(documents(spark, [])).count() == 0


def test_query_over_whole_table(spark, sf):
    got = sorted((str(r.doc_id), int(r.fingerprint, 16), r.component_id)
                 for r in sh.op7_simhash_near_dedup(spark, sf).collect())
    docs = read(spark, sf, "documents").collect()
    assert got == brute_classes([(d.doc_id, brute_fp(d.text)) for d in docs])
