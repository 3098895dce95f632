import hashlib
import random

import numpy as np
import pytest

from ledgerloom.llm import chunk_bpe as c
from ledgerloom.llm.base import read
from ledgerloom.llm.encoding import WordEncoder, public_path
from tests.llm.conftest import documents

WORD, BYTE = public_path("word_bpe_49k.json"), public_path("byte_bpe_50k.json")
_RNG = random.Random(7)
_WORDS = ["alpha", "beta,", "don't", "WE'LL", "12.5", "é", "Straße", "naïve", "\n", "x́", "日本語", "(so)", "—"]


def prose(n, rng=_RNG):
    return " ".join(rng.choice(_WORDS) for _ in range(n))


def test_cuts_depend_on_the_bytes_around_them_only():
    passage = prose(3000)
    a, b = (prose(200) + " " + passage).encode(), (prose(350) + " " + passage).encode()
    tail_a, tail_b = ({len(t) - e for e in c.cut(t)} for t in (a, b))
    in_passage = {e for e in tail_a if e < len(passage.encode()) - 2000}
    assert len(in_passage) > 10 and in_passage <= tail_b
    for t in (a, b, b"", b"short", ("é" * 5000).encode()):
        assert b"".join(x[2] for x in c.chunks(t.decode())) == t


def test_rolling_hash_equals_the_polynomial():
    data = np.frombuffer(prose(50).encode(), np.uint8)
    want = []
    for i in range(len(data) - c.WINDOW + 1):
        h = 0
        for byte in data[i:i + c.WINDOW]:
            h = (h * c._BASE + int(c._BYTE[byte])) & 0xFFFFFFFF
        want.append(h)
    assert c.rolling_hash(data).tolist() == want


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_joins_grow_until_they_agree(path):
    enc, rng = WordEncoder(path), random.Random(3)
    for n in (0, 1, 300, 900, 2000):
        text = prose(n, rng)
        known = {}
        for x, y, raw in c.chunks(text):
            if rng.random() < 0.6:
                t = raw.decode()
                known[x, y] = enc._whole(t[slice(*c.inner(t))])
        assert c.assemble(enc, [(text, known), ("", known), (text, {})]) == [
            enc._whole(text), b"", enc._whole(text)]
    # ids that do not fit their surroundings are given up, not used
    text = prose(900, rng)
    wrong = {(x, y): b"" for x, y, _ in c.chunks(text)}
    assert isinstance(c.assemble(enc, [(text, wrong)])[0], bytes)


def test_decoding_equals_the_library():
    for path in (WORD, BYTE):
        enc = WordEncoder(path)
        lists = [enc._whole(t) for t in ("", "a b", prose(200), "<|endoftext|> x")]
        want = [enc.tok.decode(np.frombuffer(i, "<u4").tolist(), skip_special_tokens=False) for i in lists]
        assert c.Decoder(enc.tok).decode(lists) == want


def test_shared_chunks_are_counted_and_encoded_once(spark):
    passage = prose(2000)
    rows = [(i, f"{prose(100)} {passage} {prose(100)}") for i in range(6)]
    shared = c.shared_chunks(documents(spark, rows).selectExpr("text as t"))
    got = {(r.x, r.y): r.n for r in shared.collect()}
    assert len(got) >= 5 and max(got.values()) >= 6
    assert sum(n >= 6 for n in got.values()) * 500 > 0.4 * len(passage)


def test_odd_rows(spark):
    passage = prose(1500)
    rows = [(1, None), (1, None), (None, "a b"), (2, ""), (3, passage), (3, passage), (4, "x" * 5000),
            (5, "nbsp and\x1ctabs\t" * 300), (6, passage + " <|endoftext|> " + passage), (7, "\0 nul")]
    docs = documents(spark, rows).withColumnRenamed("lang", "n_tokens")
    enc = WordEncoder(WORD)
    got = sorted((str(r.doc_id), tuple(r.ids)) for r in c.encode_documents(docs).collect())
    want = sorted((str(k), tuple(enc.tok.encode(t or "", add_special_tokens=False).ids)) for k, t in rows)
    assert got == want
    assert c.encode_documents(documents(spark, [])).count() == 0


def test_query_over_whole_table(spark, sf):
    enc, want = WordEncoder(WORD), {}
    for d in read(spark, sf, "documents").collect():
        ids = enc.tok.encode(d.text or "", add_special_tokens=False).ids
        want[d.doc_id] = (d.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(enc.tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: tuple(r) for r in c.op11_bpe_chunk_reuse(spark, sf).collect()}
    assert got == want
