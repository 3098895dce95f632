"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text cuts it into chunks whose borders depend on
the bytes around them alone, so a passage that stands in several documents gives the
same chunks in each. Chunks are counted over the whole corpus by their digest. What
stands more than once is shared: its inner part, from its first to its last white
space, is encoded exactly once, by one task, and its ids are joined to all documents
that hold it. What lies between two such parts (the ragged ends of the chunks and the
chunks that stand only once) is a join. It is repaired by encoding it anew: together
with the word before and the word after it must give the ids of the three encoded
apart. If not, the join takes the next shared chunk in and is tried again, at last as
the whole text; so what comes out are always the library's ids of the whole text.

Documents without a shared chunk are encoded where they are read and move nowhere.
Which documents those are is told by a bitmap of the shared digests. Its size is
fixed; when it fills up more documents are moved than need be, and no result differs.

Decoding gives what the library's ``decode(ids, skip_special_tokens=False)`` gives.

Nulls and odd rows: a null text is empty and has no ids; rows that share a doc_id, or
are equal, are encoded each on its own; a null doc_id is kept; a text without white
space is one join; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.base import materialise, read, ship, spread_join
from ledgerloom.llm.encoding import WordEncoder, encoder, larger, public_path

#: Bytes that the rolling hash sees; a chunk's least length; bits of the hash that are
#: zero where a chunk ends (512 bytes on average).
WINDOW, LEAST, ZEROS = 16, 64, 9
#: Bits of the map of shared digests: 4 MB, whatever the corpus.
MAP_BITS = 25
_BASE = 0x9E3779B1
_BYTE = np.random.default_rng(11).integers(0, 1 << 32, 256, np.uint32)


# -- chunks -------------------------------------------------------------------

def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial hash of every ``WINDOW`` bytes, by doubling the window."""
    h, step, power = _BYTE[data], 1, _BASE
    while step < WINDOW:
        h = h[:-step] * np.uint32(power) + h[step:]
        step, power = 2 * step, power * power & 0xFFFFFFFF
    return h


def cut(text: bytes) -> list[int]:
    """Where the chunks of a text end, as byte positions at character borders."""
    n = len(text)
    if n < WINDOW + LEAST:
        return [n] if n else []
    data = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(rolling_hash(data) >> np.uint32(32 - ZEROS) == 0) + WINDOW
    out, at = [], 0
    while True:
        i = int(np.searchsorted(ends, at + LEAST))
        if i == len(ends):
            break
        at = int(ends[i])
        while at < n and data[at] & 0xC0 == 0x80:
            at += 1
        if at >= n:
            break
        out.append(at)
    return [*out, n]


def chunks(text: str | None) -> list[tuple[int, int, bytes]]:
    """(first half of the digest, second half, bytes) of each chunk."""
    import xxhash

    raw = (text or "").encode()
    out, a = [], 0
    for b in cut(raw):
        d = xxhash.xxh3_128_digest(raw[a:b])
        out.append((int.from_bytes(d[:8], "little", signed=True),
                    int.from_bytes(d[8:], "little", signed=True), raw[a:b]))
        a = b
    return out


def inner(chunk: str) -> tuple[int, int]:
    """The part of a chunk that white space parts from the rest: [from, to)."""
    spots = [i for i in (chunk.find(" "), chunk.find("\n")) if i >= 0]
    first = min(spots, default=len(chunk))
    return first, max(first, chunk.rfind(" "), chunk.rfind("\n"))


def shared_chunks(docs: DataFrame) -> DataFrame:
    """(x, y, n): digests that stand more than once in the column ``t``, a written table."""
    def run(batches):
        for b in batches:
            got = [c[:2] for t in b.column("t") for c in chunks(t.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array([c[i] for c in got], pa.int64()) for i in (0, 1)],
                                             names=["x", "y"])

    every = docs.select("t").mapInArrow(run, "x long, y long")
    return materialise(every.groupBy("x", "y").agg(F.count("*").alias("n")).where("n > 1"), "chunks")


def _bitmap(shared: DataFrame) -> np.ndarray:
    """One bit for each value of a digest's low bits; made by Spark, of fixed size."""
    bit = F.col("x").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    words = (shared.select((F.shiftright(bit, 6)).alias("w"),
                           F.expr("shiftleft(1L, cast(x & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())  # at most 2**19 rows
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out


def _maybe(bits: np.ndarray, x: int) -> bool:
    low = x & ((1 << MAP_BITS) - 1)
    return bool(int(bits[low >> 6]) >> (low & 63) & 1)


# -- joins --------------------------------------------------------------------

def _together(enc: WordEncoder, texts: list[str]) -> list[bytes]:
    return list(enc.encode_column(pa.array(texts, pa.string())))


def _inner_spans(text: str, known: dict[tuple[int, int], bytes]) -> list[tuple[int, int, bytes]]:
    """(from, to, ids) of the inner parts whose ids are known."""
    spans, at = [], 0
    for x, y, raw in chunks(text):
        chunk = raw.decode()
        if (x, y) in known:
            a, b = inner(chunk)
            if b > a:
                spans.append((at + a, at + b, known[x, y]))
        at += len(chunk)
    return spans


def _joins(text: str, spans: list[tuple[int, int, bytes]]) -> list[list[str]]:
    """What lies between the spans; the same with the words around it; these words."""
    edges = [0, *(e for s in spans for e in s[:2]), len(text)]
    between = [text[a:b] for a, b in zip(edges[::2], edges[1::2])]
    before = ["", *(text[max(a, text.rfind(" ", a, b - 1)):b] for a, b, _ in spans)]
    after = []
    for a, b, _ in spans:
        to = text.find(" ", a + 1, b)
        after.append(text[a:to if to > 0 else b])
    after.append("")
    return [between, [p + t + q for p, t, q in zip(before, between, after)], before, after]


def assemble(enc: WordEncoder, docs: list[tuple[str, dict]]) -> list[bytes]:
    """The ids of (text, ids of shared chunks' inner parts by digest) pairs.

    All joins of all texts are encoded together. Those that do not agree grow over
    the next shared chunk and come again, until all agree.
    """
    out: list = [b""] * len(docs)
    todo = [(i, text, _inner_spans(text, known)) for i, (text, known) in enumerate(docs)]
    while todo:
        joins = [_joins(text, spans) for _, text, spans in todo]
        got = iter(_together(enc, [t for parts in joins for part in parts for t in part]))
        again = []
        for (i, text, spans), parts in zip(todo, joins):
            n = len(parts[0])
            apart, whole, before, after = ([next(got) for _ in range(n)] for _ in range(4))
            odd = [j for j in range(n) if whole[j] != before[j] + apart[j] + after[j]]
            if odd and spans:
                gone = {min(j, len(spans) - 1) for j in odd}
                again.append((i, text, [s for j, s in enumerate(spans) if j not in gone]))
            else:
                out[i] = b"".join(p for pair in zip(apart, [*(s[2] for s in spans), b""]) for p in pair)
        todo = again
    return out


# -- decoding -----------------------------------------------------------------

class Decoder:
    """Texts of id lists, as the library decodes them with special tokens."""

    def __init__(self, tok):
        self.tok = tok
        self.plain = json.loads(tok.to_str()).get("decoder") is None
        size = max(tok.get_vocab().values()) + 1
        self.tokens = pa.array([tok.id_to_token(i) or "" for i in range(size)], pa.string())

    def decode(self, lists: list[bytes]) -> list[str]:
        if not self.plain:
            return [self.tok.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
                    for ids in lists]
        # without a decoder the library puts a space between the tokens
        ends = np.cumsum([0, *(len(ids) >> 2 for ids in lists)])
        ids = np.frombuffer(b"".join(lists), "<u4")
        tokens = self.tokens.take(pa.array(ids.astype(np.int64)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tokens), " ").to_pylist()


# -- the operator -------------------------------------------------------------

def _as_arrays(enc: WordEncoder, keys: list, lists: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([np.frombuffer(i, "<u4").astype(np.int64) for i in lists],
                                              pa.list_(pa.int64()))], names=["doc_id", "ids"])


def encode_documents(docs: DataFrame, tokenizer: str | None = None, *, key: str = "doc_id",
                     text: str = "text", finish=_as_arrays,
                     schema: str = "doc_id long, ids array<long>") -> DataFrame:
    """Every whole text's ids, one row per document.

    ``finish(encoder, keys, id lists)`` makes a batch of ``schema`` in the task that
    has the ids, so that a caller who needs digests does not move the ids.
    """
    spark = docs.sparkSession
    ship(spark)
    path = tokenizer or public_path("word_bpe_49k.json")
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    shared = shared_chunks(rows)
    bits = spark.sparkContext.broadcast(_bitmap(shared))

    def split(b):
        """Which texts of a batch may hold a shared chunk."""
        return np.array([any(_maybe(bits.value, c[0]) for c in chunks(t.as_py()))
                         for t in b.column("t")], bool)

    def open_rows(batches):
        import secrets

        task, n = secrets.randbits(63), 0
        for b in batches:
            own = b.filter(pa.array(split(b)))
            at = pa.array(np.arange(n, n + len(own)))
            n += len(own)
            yield pa.RecordBatch.from_arrays([pa.array([task] * len(own), pa.int64()), at, *own.columns],
                                             names=["task", "row", "k", "t"])

    def closed(batches):
        with encoder(path) as enc:
            for b in larger(batches):
                own = b.filter(pa.array(~split(b)))
                yield finish(enc, own.column("k").to_pylist(), list(enc.encode_column(own.column("t"))))

    opened = materialise(rows.mapInArrow(open_rows, "task long, row long, k long, t string"), "open")

    def texts_of_chunks(batches):
        seen: set = set()
        for b in batches:
            out: list[tuple] = []
            for t in b.column("t"):
                for c in chunks(t.as_py()):
                    if c[:2] not in seen and _maybe(bits.value, c[0]):
                        if len(seen) >= 500_000:
                            seen.clear()  # a chunk sent twice is still encoded once
                        seen.add(c[:2])
                        out.append(c)
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, (pa.int64(), pa.int64(), pa.binary()))], names=["x", "y", "c"])

    def encode_chunks(batches):
        with encoder(path) as enc:
            for b in larger(batches):
                texts = [c.as_py().decode() for c in b.column("c")]
                ids = _together(enc, [t[slice(*inner(t))] for t in texts])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("x", "y", "n")),
                                                  pa.array(ids, pa.binary())], names=["x", "y", "n", "ids"])

    found = opened.select("t").mapInArrow(texts_of_chunks, "x long, y long, c binary")
    once = found.join(shared, ["x", "y"]).dropDuplicates(["x", "y"])
    encoded = materialise(once.select("x", "y", "n", "c").mapInArrow(
        encode_chunks, "x long, y long, n long, ids binary"), "chunk-ids")

    def references(batches):
        for b in batches:
            out = [(task, row, *d) for task, row, t in zip(
                b.column("task").to_pylist(), b.column("row").to_pylist(), b.column("t"))
                for d in {c[:2] for c in chunks(t.as_py()) if _maybe(bits.value, c[0])}]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["task", "row", "x", "y"])

    refs = opened.select("task", "row", "t").mapInArrow(references, "task long, row long, x long, y long")
    own_ids = (spread_join(refs, encoded, ["x", "y"], "n").groupBy("task", "row")
               .agg(F.collect_list(F.struct("x", "y", "ids")).alias("known")))

    def assembled(batches):
        with encoder(path) as enc:
            for b in larger(batches):
                ids = assemble(enc, [(t or "", {(c["x"], c["y"]): c["ids"] for c in known or ()})
                                     for t, known in zip(b.column("t").to_pylist(), b.column("known").to_pylist())])
                yield finish(enc, b.column("k").to_pylist(), ids)

    joined = opened.join(own_ids, ["task", "row"], "left").select("k", "t", "known")
    return rows.mapInArrow(closed, schema).unionByName(joined.mapInArrow(assembled, schema))


def _digests(enc: WordEncoder, keys: list, lists: list[bytes]) -> pa.RecordBatch:
    if not hasattr(enc, "decoder"):
        enc.decoder = Decoder(enc.tok)
    decoded: list[str] = []
    at = 0
    while at < len(lists):  # texts of a few million ids at a time
        to, n = at, 0
        while to < len(lists) and (to == at or n + len(lists[to]) < 4_000_000):
            n += len(lists[to])
            to += 1
        decoded += [hashlib.sha256(t.encode()).hexdigest() for t in enc.decoder.decode(lists[at:to])]
        at = to
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array([len(i) >> 2 for i in lists], pa.int64()),
         pa.array([hashlib.sha256(i).hexdigest() for i in lists], pa.string()),
         pa.array(decoded, pa.string())],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def op11_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` encoded and decoded: digests of the ids and of the decoded text."""
    return encode_documents(
        read(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"), finish=_digests,
        schema="doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
