"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words.

Both tokenizers cut a text into pieces before they merge inside a piece, and a break between two
words always is such a cut. So a text's ids are its words' ids in a row, and a task encodes a word
through the library once as long as it is remembered. Texts with white space other than single blanks and line
ends between words are encoded whole.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Callable, Iterable
from itertools import chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: A task has one core; the library's own threads would only compete for it.
os.environ["TOKENIZERS_PARALLELISM"] = "false"

#: Words that a task remembers; those met later are encoded once per group of texts.
CACHE_WORDS = 600_000
#: Characters of the longest word that is worth remembering.
CACHE_CHARS = 64
#: Texts whose unknown words are encoded together, as a number and in characters.
GROUP_TEXTS = 512
GROUP_CHARS = 1 << 21
#: Bytes of texts whose words are told apart together, and ends of words that a task remembers.
GROUP_BYTES = 1 << 24
CACHE_TAILS = 100_000

#: Letters of every Unicode version, so that the library's tables and Python's agree on them.
_SURE = "A-Za-zÀ-ÖØ-öø-ɏ"
_LETTERS = re.compile(f"[{_SURE}]+")
_LETTER_AT_END = f"[{_SURE}0-9]$"
#: Byte-level models show a byte by its Latin-1 character, or by the next free one from 256 on where that is not printable.
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_BYTE_SHOWN = {byte: 256 + i for i, byte in enumerate(_HIDDEN)}
_BLANK_SHOWN = " ".translate(_BYTE_SHOWN)

Encode = Callable[[list[str]], list[bytes]]
_loaded: dict[tuple[str, bool], Callable[[Iterable[str | None]], list[bytes]]] = {}


def _library(path: str) -> Encode:
    tokenizer = Tokenizer.from_file(path)

    def encode(texts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    return encode


class _Words:
    """Ids by word: the lasting ones, and in ``now`` those of the group of texts at hand.

    The lasting table is too large for a processor's cache, so it is asked once per word and group.
    """

    def __init__(self, encode: Encode, written: Callable[[str | bytes], str]) -> None:
        self.encode, self.written = encode, written
        self.lasting: dict[str | bytes, bytes] = {}
        self.now: dict[str | bytes, bytes] = {}

    def learn(self, words: set) -> None:
        known = list(words)
        found = list(map(self.lasting.get, known))
        self.now = now = dict(zip(known, found, strict=True))
        unknown = [w for w, ids in now.items() if ids is None]
        if not unknown:
            return
        for word, ids in zip(unknown, self.encode([self.written(w) for w in unknown]), strict=True):
            now[word] = ids
            if len(self.lasting) < CACHE_WORDS and len(word) <= CACHE_CHARS:
                self.lasting[word] = ids

    def ids(self, words: list) -> Iterable[bytes]:
        return map(self.now.__getitem__, words)


def _groups(texts: Iterable[str | None]) -> Iterable[list[str]]:
    group, chars = [], 0
    for text in texts:
        group.append(text or "")
        chars += len(group[-1])
        if len(group) >= GROUP_TEXTS or chars >= GROUP_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


class _Rows(NamedTuple):
    """Rows of different lengths: where each begins in ``flat`` and how many items it has."""

    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    def pick(self, rows: np.ndarray) -> _Rows:
        return _Rows(self.flat, self.start.take(rows), self.size.take(rows))

    def first(self, n: int) -> _Rows:
        """The first rows of a table whose rows lie one after the other."""
        return _Rows(self.flat[: int(self.size[:n].sum())], self.start[:n], self.size[:n])

    def with_more(self, found: list[list[int]]) -> _Rows:
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), self.flat.dtype, int(size.sum()))
        start = np.cumsum(size) - size + len(self.flat)
        return _Rows(*map(np.concatenate, zip(self, (flat, start, size), strict=True)))

    def chained(self) -> np.ndarray:
        """The items of all rows, one row after the other."""
        at = np.repeat(self.start - (np.cumsum(self.size) - self.size), self.size)
        at += np.arange(len(at))
        return self.flat.take(at)


class _Cores:
    """Ids of words without the punctuation at their end, kept with the blank or line end before them.

    A core that begins a line has its line end with it. Row ``IRREGULAR`` stands for what is no single word.
    """

    IRREGULAR = 0

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        cutter = self.tokenizer.pre_tokenizer
        #: Whether runs of letters and of punctuation are pieces, so that they can be merged by themselves.
        self.cuts_at_letters = (
            isinstance(cutter, ByteLevel)
            and cutter.use_regex
            and not cutter.add_prefix_space
            and self.tokenizer.normalizer is None
            and not any(map(str.isalpha, added))
        )
        # An added token is searched before the text is cut, so none may reach into the end of a word.
        self.ends = "".join(c for c in string.punctuation if self.cuts_at_letters and not any(c in t for t in added))
        self.line_end = self.library(["\n"])[0]
        #: The cores remembered; the ids of the first are in row 1.
        self.known = pa.array([], pa.large_string())
        self.ids = _Rows(np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64))
        self.tails: dict[str, list[int]] = {"": []}

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, cores: list[str]) -> list[list[int]]:
        """Ids of cores; the library's merges are asked at once where a core is one piece of letters."""
        found: list[list[int]] = []
        cut: list[int] = []
        merge = self.tokenizer.model.tokenize
        for i, core in enumerate(cores):
            starts_line = core[0] == "\n"
            if not self.cuts_at_letters or not _LETTERS.fullmatch(core, starts_line):
                cut.append(i)
                found.append([])
            elif starts_line:
                found.append([*self.line_end, *[t.id for t in merge(_shown(core[1:]))]])
            else:
                found.append([t.id for t in merge(_shown(" " + core))])
        whole = [cores[i] if cores[i][0] == "\n" else " " + cores[i] for i in cut]
        for i, ids in zip(cut, self.library(whole), strict=True):
            found[i] = ids
        return found

    def rows(self, cores: pa.Array) -> tuple[np.ndarray, _Rows]:
        """The row of each core and the table it is in, which also holds those that are not remembered."""
        row = pc.fill_null(pc.index_in(cores, self.known), self.IRREGULAR - 1).to_numpy() + 1
        unknown = np.flatnonzero(row == self.IRREGULAR)
        words = cores.take(pa.array(unknown)).to_pylist()
        short: list[int] = []
        long: list[int] = []
        for i, core in enumerate(words):
            if core.split() == [core.removeprefix("\n")]:
                (short if len(core) <= CACHE_CHARS else long).append(i)
        lasting = min(len(short), max(0, CACHE_WORDS - len(self.known)))
        regular = [words[i] for i in short + long]
        first = len(self.ids.size)
        table = self.ids.with_more(self.encode(regular))
        row[unknown[short + long]] = np.arange(first, first + len(regular))
        self.known = pa.concat_arrays([self.known, pa.array(regular[:lasting], pa.large_string())])
        self.ids = table.first(first + lasting)
        return row, table

    def of_words(self, words: pa.Array) -> tuple[_Rows, np.ndarray]:
        """Ids of different words, and which of them are irregular."""
        bare = pc.ascii_rtrim(words, self.ends) if self.ends else words
        bare = pc.if_else(pc.match_substring_regex(bare, _LETTER_AT_END), bare, words).dictionary_encode()
        row, table = self.rows(bare.dictionary)
        row = row.take(bare.indices.to_numpy())
        size = pc.binary_length(bare.dictionary).to_numpy().take(bare.indices.to_numpy())
        tails = _ends_of(words, size).dictionary_encode()
        known = tails.dictionary.to_pylist()
        new = [t for t in known if t not in self.tails]
        ids = {**self.tails, **dict(zip(new, self.library(new), strict=True))}
        if len(ids) <= CACHE_TAILS:
            self.tails = ids
        both = table.with_more([ids[t] for t in known])
        pairs = np.stack([row, tails.indices.to_numpy() + len(table.size)], axis=1)
        joined = both.pick(pairs.reshape(-1))
        size = joined.size.reshape(-1, 2).sum(axis=1)
        return _Rows(joined.chained(), np.cumsum(size) - size, size), row == self.IRREGULAR


def _ends_of(words: pa.Array, size: np.ndarray) -> pa.Array:
    """What follows the first ``size`` bytes of each word."""
    _, offsets, data = words.buffers()
    stop = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    rest = np.diff(stop) - size
    flat = _Rows(np.frombuffer(data, np.uint8), stop[1:] - rest, rest).chained()
    places = np.concatenate([[0], np.cumsum(rest)])
    return pa.Array.from_buffers(pa.large_string(), len(rest), [None, pa.py_buffer(places), pa.py_buffer(flat)])


def _shown(piece: str) -> str:
    """A piece of letters, or a blank and letters, as a byte-level model sees it: one character for each byte."""
    if piece.isascii():
        return piece.replace(" ", _BLANK_SHOWN)
    return piece.encode("utf-8").decode("latin-1").translate(_BYTE_SHOWN)


def _slices(texts: pa.Array) -> Iterable[pa.Array]:
    """Texts in groups of some ``GROUP_BYTES``."""
    group = (np.cumsum(pc.binary_length(texts).to_numpy()) - 1) // GROUP_BYTES
    ends = [*(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for first, end in pairwise([0, *ends]):
        yield texts.slice(first, end - first)


def spaced_encoder(path: str) -> Callable[[Iterable[str | None]], list[bytes]]:
    """For a byte-level tokenizer that keeps white space: a word's ids depend on the blank before it.

    A piece does not go on from a letter or digit into punctuation, so the punctuation at the end of a word is
    encoded apart from its core. Words are told apart, and their ids put together, in Arrow and numpy.
    """
    cores = _Cores(path)
    line_end = pa.scalar("\n", pa.large_string())
    nothing = pa.scalar("", pa.large_string())

    def run(texts: Iterable[str | None]) -> list[bytes]:
        every = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(list(texts), pa.large_string())
        out: list[bytes] = []
        if len(every):
            for group in _slices(pc.fill_null(every, "")):
                out.extend(of_group(group))
        return out

    def of_group(texts: pa.Array) -> list[bytes]:
        # Every line, the first one too, begins with its line end and follows a blank.
        lines = pc.binary_join_element_wise(line_end, pc.replace_substring(texts, "\n", " \n"), nothing)
        split = pc.split_pattern(lines, " ")
        begin = split.offsets.to_numpy().astype(np.int64)
        begin -= begin[0]
        words = split.flatten().dictionary_encode()
        code = words.indices.to_numpy()
        rows, irregular = cores.of_words(words.dictionary)
        own = rows.pick(code)
        own.start[begin[:-1]] += len(cores.line_end)
        own.size[begin[:-1]] -= len(cores.line_end)
        whole = np.logical_or.reduceat(irregular.take(code), begin[:-1])
        own.size[np.repeat(whole, np.diff(begin))] = 0
        ids = own.chained().tobytes()
        stop = 4 * np.concatenate([[0], np.cumsum(own.size)])[begin]
        out = [ids[a:b] for a, b in pairwise(stop.tolist())]
        apart = np.flatnonzero(whole)
        for i, found in zip(apart.tolist(), cores.library(texts.take(pa.array(apart)).to_pylist()), strict=True):
            out[i] = array("I", found).tobytes()
        return out

    return run


def bare_encoder(path: str) -> Callable[[Iterable[str | None]], list[bytes]]:
    """For a tokenizer that drops white space: a word's ids do not depend on what is around it."""
    words = _Words(_library(path), bytes.decode)

    def run(texts: Iterable[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for group in _groups(texts):
            split = [t.encode("utf-8").split() for t in group]
            words.learn(set().union(*split))
            out.extend(b"".join(words.ids(own)) for own in split)
        return out

    return run


def encoder(path: str, keeps_space: bool) -> Callable[[Iterable[str | None]], list[bytes]]:
    """The encoder of a file, made once in each Python worker: texts to little-endian 32-bit ids."""
    if (path, keeps_space) not in _loaded:
        _loaded[path, keeps_space] = (spaced_encoder if keeps_space else bare_encoder)(path)
    return _loaded[path, keeps_space]
