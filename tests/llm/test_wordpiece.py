import random

from ledgerloom.llm import wordpiece as wp
from ledgerloom.llm.base import read
from ledgerloom.llm.encoding import public_path
from tests.llm.conftest import documents


def greedy(word, starts, rest):
    at, n, pieces = 0, 0, starts
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in pieces:
                break
        else:
            return 1
        at, n, pieces = end, n + 1, rest
    return n


def test_equals_greedy_matching():
    rng = random.Random(6)
    for _ in range(300):
        def some():
            return {"".join(rng.choices("abc", k=rng.randint(1, 6))).encode() for _ in range(rng.randint(1, 14))}
        starts, rest = some(), some()
        c = wp.PieceCounter(sorted(starts), sorted(rest))
        for _ in range(60):
            w = "".join(rng.choices("abcd" if rng.random() < .1 else "abc", k=rng.randint(0, 14))).encode()
            assert c.count(w) == greedy(w, starts, rest), (w, starts, rest)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, " \n\t "), (3, "the the"), (3, "the the"), (4, "x" * 200_000)]
    got = wp.count_tokens(documents(spark, rows).withColumnRenamed("source", "t")).collect()
    by = sorted((str(r.doc_id), r.n_words, r.n_bytes) for r in got)
    assert by == sorted((str(k), len((t or "").split()), len(t or "")) for k, t in rows)
    assert [r.n_tokens for r in got if r.doc_id == 3] == [2, 2]
    assert wp.count_tokens(documents(spark, [])).count() == 0


def test_query_over_whole_table(spark, sf):
    import base64
    pieces = [base64.b64decode(x.split()[0]) for x in open(public_path("byte_bpe_50k.tiktoken"), "rb") if x.strip()]
    rest = {p for p in pieces if p[:1] != b" "}
    starts = {p[1:] for p in pieces if p[:1] == b" " and len(p) > 1} | {p for p in rest if len(p) == 1}
    known: dict[bytes, int] = {}
    want = {}
    for d in read(spark, sf, "documents").collect():
        own = (d.text or "").encode().split()
        for w in own:
            if w not in known:
                known[w] = greedy(w, starts, rest)
        want[d.doc_id] = (len(own), sum(known[w] for w in own))
    assert {r.doc_id: (r.n_words, r.n_tokens) for r in wp.op1_token_counts(spark, sf).collect()} == want
