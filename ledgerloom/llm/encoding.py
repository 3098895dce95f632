"""Token ids of whole texts with the ``tokenizers`` library, word form by word form.

A column of texts is cut by Arrow at the spaces and line ends where the tokenizer's
own pre-tokenizer cuts too, its words are dictionary-encoded, and each distinct word
gets its ids once: from a memory of letter cores (without punctuation, in lower case
where the normalizer makes them so) or, many at a time, from the library. Every id
comes from the library's normalizer, pre-tokenizer and model; a text that cannot be
cut safely is encoded whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letter cores that a process remembers while a task runs.
REMEMBERED = 200_000


class _Unsafe(Exception):
    """A cut here could change the ids."""


def _taken(flat: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``index`` of a pool of id lists that lie one after another."""
    begins, n = np.cumsum(sizes) - sizes, sizes[index]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0)
    return flat[at + np.repeat(begins[index] - (ends - n), n)], n


def _pool(lists: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b"".join(lists), "<u4"),
            np.fromiter(map(len, lists), np.int64, len(lists)) >> 2)


class WordEncoder:
    """Ids equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    Two pre-tokenizers are known to cut at single spaces: byte-level with its
    regular expression (a space belongs to the word after it) and a split that
    drops white space. Any other tokenizer encodes each text whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        self.spaced = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space") and norm is None)
        first = (pre.get("pretokenizers") or [{}])[0]
        self.dropped = (pre.get("type") == "Sequence" and first.get("type") == "Split"
                        and first.get("behavior") == "Removed" and bool(first.get("invert"))
                        and [n["type"] for n in (norm or {}).get("normalizers", [])]
                        == ["NFC", "Replace", "Lowercase"])
        added = [a for a in spec.get("added_tokens", [])]
        self.marks = [a["content"] for a in added]
        plain = all(not (a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"]))
                    for a in added)
        self.cuts = (self.spaced or self.dropped) and plain and not spec["model"].get("dropout")
        self.norm, self.pre, self.model = self.tok.normalizer, self.tok.pre_tokenizer, self.tok.model
        self.forget()
        if self.cuts:
            self.plain, self.mapped = self._plain()
            self.many = Tokenizer(self.model)  # pieces of many words, parted by spaces
            self.many.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocab, end = self.tok.get_vocab(), spec["model"].get("end_of_word_suffix") or ""
            self.line = self.pre.pre_tokenize_str("a\na")[1][0] if self.spaced else ""
            mark = self.mapped.get(0x20, "")
            #: ids that end a word (dropped) or begin one (spaced)
            self.edge = np.zeros(max(vocab.values()) + 1, bool)
            for token, i in vocab.items():
                self.edge[i] = token.endswith(end) if self.dropped else token.startswith(mark)
            self.cuts = bool(end) or self.spaced

    def forget(self) -> None:
        """Give up what is remembered, as at the end of a task."""
        self.pieces: dict[str, bytes] = {}
        self.known = (pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64))

    def __enter__(self) -> "WordEncoder":
        return self

    def __exit__(self, *_) -> None:
        self.forget()

    def _plain(self) -> tuple[str, dict]:
        """A pattern for words of Latin letters with ASCII punctuation after them,
        between which both known pre-tokenizers cut, and what the library turns
        each such sign into. A NUL or line ends may stand before a word."""
        mapped, letters, signs = {}, [], []
        for c in map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x180)]):
            normal = self.norm.normalize_str(c) if self.norm is not None else c
            if len(normal) != 1 or c == "'" or c.isdigit():
                continue
            (piece, _), = self.pre.pre_tokenize_str(normal)
            mapped[ord(c)] = piece
            (letters if normal.isalpha() else signs).append(c)
        if self.spaced:
            (piece, _), = self.pre.pre_tokenize_str(" ")
            mapped[0x20] = piece
        taken = {c for m in self.marks for c in m}  # a mark is cut out before all else
        a = re.escape("".join(letters))
        b = re.escape("".join(c for c in signs if c not in taken))
        return f"^(?P<p>\\x00|\n*)(?P<a>[{a}]+)(?P<b>[{b}]*)$", mapped

    # -- ids of parts of words ------------------------------------------------

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            if len(self.pieces) >= REMEMBERED // 10:
                self.pieces.clear()
            got = self.pieces[piece] = np.array([t.id for t in self.model.tokenize(piece)], "<u4").tobytes()
        return got

    def _lines(self, ends: str) -> bytes:
        """Line ends before a word: all but the last are one piece."""
        if not ends.startswith("\n"):
            return b""
        return (self._piece(self.line * (len(ends) - 1)) if len(ends) > 1 else b"") + self._piece(self.line)

    def _new_cores(self, cores: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, from the library, many at a time; a space first
        stands for the one before a word."""
        n = len(cores)
        if not n:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        table = {**self.mapped, 0x0A: " "}
        if self.spaced:
            marked = pc.starts_with(cores, " ").to_numpy(zero_copy_only=False)
        else:
            marked = np.ones(n, bool)
        flats, sizes = [], np.zeros(n, np.int64)
        own = np.flatnonzero(marked)
        for at in range(0, len(own), 20_000):
            some = own[at:at + 20_000]
            text = "\n".join(cores.take(pa.array(some)).to_pylist()).translate(table)
            ids = np.array(self.many.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            edges = np.flatnonzero(self.edge[ids])
            ends = edges + 1 if self.dropped else np.append(edges[1:], len(ids))
            if len(ends) != len(some):
                raise RuntimeError("the library's pieces do not end where the words do")
            flats.append(ids)
            sizes[some] = np.diff(ends, prepend=0)
        rest = np.flatnonzero(~marked)
        if len(rest):  # nothing marks where these begin
            texts = [c.translate(table) for c in cores.take(pa.array(rest)).to_pylist()]
            got = [np.array(e.ids, "<u4") for e in self.many.encode_batch_fast(texts, add_special_tokens=False)]
            flats += got
            sizes[rest] = np.fromiter(map(len, got), np.int64, len(got))
        order = np.empty(n, np.int64)
        order[np.concatenate([own, rest])] = np.arange(n)
        return _taken(np.concatenate(flats), sizes[np.concatenate([own, rest])], order)

    def _core_ids(self, cores: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same through the memory, which then holds these and what else fits."""
        words, flat, sizes = self.known
        at = pc.index_in(cores, value_set=words)
        new = at.is_null().to_numpy(zero_copy_only=False)
        new_flat, new_sizes = self._new_cores(cores.filter(pa.array(new)))
        index = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        index[new] = len(words) + np.arange(int(new.sum()))
        pool = np.concatenate([flat, new_flat]), np.concatenate([sizes, new_sizes])
        unused = np.ones(len(words), bool)
        unused[index[~new]] = False
        kept = np.concatenate([index, np.flatnonzero(unused)])[:REMEMBERED]
        every = pa.concat_arrays([words, cores.filter(pa.array(new))])
        self.known = (every.take(pa.array(kept)), *_taken(*pool, kept))
        return _taken(*pool, index)

    def _odd(self, word: str) -> bytes:
        """A word that is not plain Latin letters and punctuation."""
        lines, lead = b"", ""
        if self.spaced:
            own = word.lstrip("\n")
            lines, lead = self._lines(word[:len(word) - len(own)]), " "
            if lines or word[:1] == "\0":
                word, lead = own.removeprefix("\0"), ""
            if not word or word[0].isspace() or word[-1].isspace():
                raise _Unsafe
            word = lead + word
        for m in self.marks:
            if m in word:
                return lines + self._whole(word)
        if self.norm is not None:
            word = self.norm.normalize_str(word)
        return lines + b"".join([self._piece(piece) for piece, _ in self.pre.pre_tokenize_str(word)])

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Ids of distinct words; and the numbers of those that forbid a cut."""
        parts = pc.extract_regex(words, self.plain)
        plain = parts.is_valid()
        parts = parts.filter(plain)
        before, cores, signs = (pc.struct_field(parts, f) for f in ("p", "a", "b"))
        if self.dropped:
            cores = pc.utf8_lower(cores)
        else:
            cores = pc.binary_join_element_wise(pc.if_else(pc.equal(before, ""), " ", ""), cores, "")
        before, cores, signs = (x.dictionary_encode() for x in (before, cores, signs))
        plain = plain.to_numpy(zero_copy_only=False)
        odd, unsafe = [], []
        for i, word in zip(np.flatnonzero(~plain).tolist(), words.filter(pa.array(~plain)).to_pylist()):
            try:
                odd.append(self._odd(word))
            except _Unsafe:
                odd.append(b"")
                unsafe.append(i)
        # a word is up to three entries of one pool; entry 0 is empty
        small = [b"", *map(self._lines, before.dictionary.to_pylist()),
                 *(self._piece(s.translate(self.mapped)) if s else b"" for s in signs.dictionary.to_pylist()),
                 *odd]
        few, core = _pool(small), self._core_ids(cores.dictionary)
        n_before, n_signs = len(before.dictionary), len(signs.dictionary)
        entry = np.zeros((len(words), 3), np.int64)
        entry[plain, 0] = 1 + before.indices.to_numpy()
        entry[plain, 1] = len(small) + cores.indices.to_numpy()
        entry[plain, 2] = 1 + n_before + signs.indices.to_numpy()
        entry[~plain, 0] = 1 + n_before + n_signs + np.arange(len(odd))
        flat, sizes = _taken(np.concatenate([few[0], core[0]]), np.concatenate([few[1], core[1]]),
                             entry.ravel())
        return flat, sizes.reshape(-1, 3).sum(axis=1), unsafe

    # -- ids of texts ---------------------------------------------------------

    def encode_column(self, texts: pa.Array) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers, in order; a
        null text is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not self.cuts:
            yield from map(self._whole, texts.to_pylist())
            return
        whole = pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False)
        if self.spaced:
            if pc.any(pc.match_substring(texts, "\n\n")).as_py():
                cut = pc.replace_substring_regex(texts, r"(\n+)", r" \1")
            else:
                cut = pc.replace_substring(texts, "\n", " \n")
            cut = pc.binary_join_element_wise("\0", cut, "")  # the first word has no space before it
        else:
            cut = pc.replace_substring(texts, "\n", " ")
        lists = pc.split_pattern(cut, " ")
        words = lists.flatten().dictionary_encode()
        index, row_ends = words.indices.to_numpy(), np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()
        flat, sizes, unsafe = self._word_ids(words.dictionary)
        if unsafe:
            bad = np.zeros(len(sizes), bool)
            bad[unsafe] = True
            whole = whole | (np.add.reduceat(np.append(bad[index], False).astype(np.int64),
                                             np.append(0, row_ends[:-1])) > 0)
        if len(whole) and self.spaced:  # an empty text has no word at all
            empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
            whole = whole & ~empty
        # a stretch of texts at a time: an index over the ids of many would be large
        row = at = 0
        while row < len(row_ends):
            to = max(row + 1, int(np.searchsorted(row_ends, at + 400_000, "right")))
            got, n = _taken(flat, sizes, index[at:row_ends[to - 1]])
            raw, ends, a = got.tobytes(), np.append(0, 4 * np.cumsum(n)), 0
            for r in range(row, to):
                b = int(ends[row_ends[r] - at])
                if whole[r]:
                    yield self._whole(texts[r].as_py())
                elif self.spaced and empty[r]:
                    yield b""
                else:
                    yield raw[a:b]
                a = b
            at, row = int(row_ends[to - 1]), to

    def encode(self, text: str | None) -> bytes:
        """The ids of one text."""
        return next(self.encode_column(pa.array([text], pa.string())))


def larger(batches, most: int = 4 << 20):
    """The batches joined to about ``most`` bytes, so that a word form that stands in
    many texts is handled once for all of them."""
    held, size = [], 0

    def joined():
        table = pa.Table.from_batches(held).combine_chunks()
        return table.to_batches()

    for b in batches:
        if held and size + b.nbytes > most:
            yield from joined()
            held, size = [], 0
        held.append(b)
        size += b.nbytes
    if held:
        yield from joined()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This process's encoder for a tokenizer file, kept between tasks; ``with`` it a
    task remembers words, and forgets them at its end."""
    if path not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def public_path(name: str) -> str:
    """Where a file of the installed public tokenizers lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
