import base64
import hashlib
import random
import struct
from collections import Counter

from pyspark.sql import functions as F

from ledgerloom.llm import versions as v
from ledgerloom.llm.base import read
from tests.llm.conftest import documents


def brute(rows):
    """rows: (doc_id, text, hash). Edited text and paragraph counts, by hand."""
    import re
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    texts = [t or "" for _, t, _ in rows]

    def parts(t):
        return Counter(p for p in re.findall(r"[^\n]{100,}?[.!?](?=\s|$)|[^\n]+", t) if p.strip(" "))

    def like(a, b):
        a, b = parts(a), parts(b)
        both = sum(a.values()) + sum(b.values())
        return 1.0 if not both else 1 - (sum(((a - b) + (b - a)).values())) / both

    out = []
    for i, (k, _, _) in enumerate(rows):
        t, nxt = texts[i], texts[(i + 1) % len(rows)]
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        out.append((str(k), len(t), hashlib.sha256(edited.encode()).hexdigest(),
                    round(like(t, edited), 9), round(like(t, nxt), 9)))
    return sorted(out)


def check(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64(
        F.coalesce("text", F.lit("")))).collect()]
    got = v.edited_versions(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
                  for r in got) == brute(rows)
    return got


def test_odd_rows(spark):
    rng = random.Random(7)
    line = [f"line {i} " + "x" * rng.randint(0, 50) for i in range(400)]
    rows = [(i, "\n".join(rng.choices(line, k=rng.randint(0, 60)))) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "no key\nat all"), (None, None), (205, "tie"), (205, "tie"), (205, "a tie\n\n "),
             (102, "é日本" * 3), (103, "\n".join(f"{i} long" for i in range(20_000))), (104, "same\n" * 3000)]
    got = check(spark, documents(spark, rows).withColumnRenamed("source", "copy"))
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.fingerprint)
    assert by[100] == by[101] and len(set(by[205])) == 2
    cells = base64.b64decode(by[104][0])
    assert sum(struct.unpack(">i", cells[i:i + 4])[0] for i in range(0, len(cells), 16)) == 3 * 3000


def test_small_tables(spark):
    check(spark, documents(spark, [(1, "only\none")]))
    check(spark, documents(spark, [(None, "a"), (None, "b")]))
    assert v.edited_versions(documents(spark, [])).count() == 0


def test_recovered_digests(spark):
    a, b = list(range(10**9, 10**9 + 500)), list(range(10**9 + 300, 10**9 + 900))
    one = spark.createDataFrame([(1, "e", a, b)], "uid long, kind string, a array<long>, b array<long>")
    mixed = one.select("uid", "kind", *(F.transform(c, lambda x: F.xxhash64(x)).alias(c) for c in "ab"))
    got = v.recover(mixed).collect()
    want = mixed.select(F.array_except("a", "b"), F.array_except("b", "a")).first()
    assert sorted(x for r in got for x in r.added) == sorted(want[0])
    assert sorted(x for r in got for x in r.removed) == sorted(want[1])


def test_query_over_whole_table(spark, sf):
    check(spark, read(spark, sf, "documents"))
    plan = v.op3_document_fingerprints(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
