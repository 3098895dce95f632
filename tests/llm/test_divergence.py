import random
import re

import numpy as np

from ledgerloom.llm import divergence as d
from tests.llm.conftest import documents

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, most=200):
    """The definition with plain dictionaries."""
    docs = [(l or "", s or "", [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in _TERM.findall(t or "")])
            for _, t, l, s in rows]
    out = set()
    for lang in {x[0] for x in docs}:
        own = [x for x in docs if x[0] == lang]
        seen: dict = {}
        for i, (_, _, words) in enumerate(own):
            for w in words:
                seen.setdefault(w, set()).add(i)
        kept = {w for w, at in seen.items() if len(at) >= 3}
        count = {s: {w: 0 for w in kept} for s in {x[1] for x in own}}
        for _, s, words in own:
            for w in words:
                if w in kept:
                    count[s][w] += 1
        total = {w: sum(c[w] for c in count.values()) for w in kept}

        def share(c):
            n = sum(c.values())
            return {w: 1 + 10**9 * (c[w] + 1) // (n + len(kept)) for w in kept}

        p, q = {s: share(c) for s, c in count.items()}, share(total)
        for s in count:
            parts = {"pair": [(o, sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept))
                              for o in count if o != s],
                     "term": [(w, (p[s][w] - q[w]) ** 2 // q[w]) for w in kept
                              if count[s][w] and p[s][w] > q[w]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(items, 1):
                    if part == "pair" or rank <= most:
                        out.add((lang, s, part, item, value, rank))
    return out


def _rows(df):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(set(got)) == len(got)
    return set(got)


def test_audit_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(d, "SHARD_ROWS", 5)
    monkeypatch.setattr(d, "CELLS", 12)
    rng = random.Random(5)
    words = ["the", "The", "x1y", "é", "É", "日本", "a-b", "tie", "Tie2", "rare", "\0nul"]
    rows = [(i % 30, " ".join(rng.choices(words, [9, 5, 4, 3, 3, 2, 2, 2, 1, 1, 1], k=rng.randint(0, 25))),
             rng.choice(["en", "fr", None, ""]), rng.choice(["s0", "s0", "s1", "S2", None, "é"])) for i in range(150)]
    rows += [(1, None, "de", "only"), (1, None, "de", "none"), (2, "one two", "it", "alone"),
             (3, "long " * 20_000, "en", "s1"), (None, "the the", "en", "new"), (4, "12 34 !", "xx", "digits")]
    docs = documents(spark, rows).withColumnRenamed("n_chars", "n").selectExpr("*", "lang as first", "text as term")
    assert _rows(d.audit(docs)) == brute(rows)
    assert _rows(d.audit(docs, min_docs=3, most=2)) == brute(rows, 2)


def test_empty_table(spark):
    assert d.audit(documents(spark, [])).count() == 0


def test_one_hot_source_and_many_small_ones(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(12)), "en",
             "hot" if i % 3 == 0 else f"s{i % 40}") for i in range(400)]
    assert _rows(d.audit(documents(spark, rows))) == brute(rows)


def test_shares_and_sums_are_exact_for_counts_beyond_64_bits():
    big = np.array([[10**12, 0], [3, 5]], np.int64)
    totals, terms = [10**12 + 3, 5], 2
    p = [[1 + 10**9 * (int(c) + 1) // (t + terms) for c, t in zip(row, totals)] for row in big]
    high, low = d.shard_divergence(big, totals, terms)
    for a in range(2):
        for b in range(2):
            want = sum((x[a] - x[b]) ** 2 // x[b] for x in p)
            assert int(high[a, b]) * 2**20 + int(low[a, b]) == want
