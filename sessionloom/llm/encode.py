"""Token ids of whole texts, looked up word by word.

Both tokenizers cut a text into pre-tokens before merging, so a text's ids are those
of its parts at certain cuts one after another. Each worker keeps the parts it has
met (a bounded number); the rest go through the tokenizer together. Words are split, told
apart and put together again in Arrow, so that only what a worker hasn't met costs Python.
"""

from __future__ import annotations

import base64
import gc
import os
import re
import sys
from array import array
from collections.abc import Collection, Iterator
from contextlib import contextmanager
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts a worker remembers, none longer than MAX_PART bytes.
KEPT_PARTS = 200_000
MAX_PART = 64


@contextmanager
def no_collector() -> Iterator[None]:
    """No search for reference cycles: there are none, and it would walk all that is remembered."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def byte_characters() -> dict[int, str]:
    """The character that byte-level models have for each byte: itself if it is visible
    in Latin-1, else the next one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(others)}


BYTE_CHARACTERS = byte_characters()


def as_bytes(code: str, ids: list[int]) -> bytes:
    """Little-endian numbers, of two bytes (``H``) or four (``I``)."""
    out = array(code, ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def offsets_of(strings: pa.Array) -> np.ndarray:
    """Where each string of an array begins in its bytes, and where the last ends."""
    kind = np.int64 if pa.types.is_large_binary(strings.type) or pa.types.is_large_string(strings.type) else np.int32
    if not len(strings):
        return np.zeros(1, np.int64)
    return np.frombuffer(strings.buffers()[1], kind)[strings.offset :][: len(strings) + 1].astype(np.int64)


def endings(strings: pa.Array, lengths: pa.Array) -> pa.Array:
    """The last bytes of each string, as many as its length says."""
    lengths = lengths.to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    if not ends[-1]:
        return pa.array([b""] * len(strings), pa.binary())
    at = np.arange(ends[-1]) + np.repeat(offsets_of(strings)[1:] - ends[1:], lengths)
    found = np.frombuffer(strings.buffers()[2], np.uint8)[at]
    return pa.BinaryArray.from_buffers(pa.binary(), len(strings), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(found)])


class _Parts(dict):
    """Ids of parts as little-endian bytes.

    When half of the room is used, what isn't met again until the next time goes.
    """

    def __init__(self, encode, kept: int = KEPT_PARTS):
        self._encode, self._room, self._older = encode, kept // 2, {}

    def forget(self) -> None:
        self.clear()
        self._older = {}

    def learn(self, wanted: Collection) -> None:
        if len(self) > self._room:
            self._older = dict(self)
            self.clear()
        new = [part for part in wanted if part not in self]
        older = self._older
        if older:
            self.update([(part, older[part]) for part in new if part in older])
            new = [part for part in new if part not in older]
        self.update(zip(new, self._encode(new), strict=True))

    def forget_long(self, wanted: Collection) -> None:
        for part in wanted:
            if len(part) > MAX_PART:
                del self[part]

    def ids(self, parts: list) -> pa.Array:
        """The ids of each of many different parts, looked up in blocks."""
        out = []
        for k in range(0, max(len(parts), 1), self._room):
            block = parts[k : k + self._room]
            self.learn(block)
            out.append(pa.array([self[part] for part in block], pa.large_binary()))
            self.forget_long(block)
        return pa.concat_arrays(out)


class WordEncoder:
    """For a tokenizer that drops white space and case: parts are words. Ids have four bytes.

    The tokenizer reads ``\\s`` as more than ASCII; such white space stays inside a
    part, where the tokenizer itself handles it. Different words are looked up as
    what they share: a lower-case core, and marks after it, which are always a
    pre-token of their own behind a letter or digit.
    """

    marks = ".,!%$&#*|;:?"
    #: Cores that marks may be cut from; what ends in another letter is looked up whole.
    plain_end = "[a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]$"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._cores = _Parts(self._encode_cores, 2 * KEPT_PARTS)

    def forget(self) -> None:
        """Gives memory back at the end of a task: a worker may do other work next."""
        self._cores.forget()

    def _word_ids(self, words: pa.Array) -> pa.Array:
        """The ids of different words."""
        special = pc.match_substring(words, "<|")  # may be a special token, which is case-sensitive
        lower = pc.if_else(special, words, pc.ascii_lower(words))
        bare = pc.ascii_rtrim(lower, characters=self.marks)
        cut = pc.and_not(pc.match_substring_regex(bare, self.plain_end), special)
        core = pc.if_else(cut, bare, lower)
        marks = endings(lower, pc.subtract(pc.binary_length(lower), pc.binary_length(core)))
        cores, tails = core.dictionary_encode(), marks.dictionary_encode()
        found = [self._cores.ids(part.dictionary.cast(pa.binary()).to_pylist()).take(part.indices) for part in (cores, tails)]
        return pc.binary_join_element_wise(*found, pa.scalar(b"", pa.large_binary()))

    def _one_pretoken(self, word: bytes) -> str | None:
        """A word of lower-case Latin letters as the model reads it: by bytes."""
        if word.isalpha():  # ASCII, lower-case by now
            return word.decode()
        text = word.decode("utf-8", "replace")
        plain = text.isalpha() and max(text) < "\u0250" and text == text.lower() and is_normalized("NFC", text)
        return word.decode("latin-1").translate(BYTE_CHARACTERS) if plain else None

    def _encode_cores(self, words: list[bytes]) -> list[bytes]:
        tokenize = self._model.tokenize
        out, rest = [], []
        for k, word in enumerate(words):
            single = word.decode() if word.isalpha() else self._one_pretoken(word)
            if single is None:
                rest.append(k)
                out.append(b"")
            else:
                out.append(as_bytes("I", [token.id for token in tokenize(single)]))
        texts = [words[k].decode("utf-8", "replace") for k in rest]
        for k, found in zip(rest, self._tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            out[k] = as_bytes("I", found.ids)
        return out

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; none for a null."""
        with no_collector():
            split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
            words = split.flatten().dictionary_encode()
            # Of all words, one after the other: a text's are a run of them.
            ids = self._word_ids(words.dictionary).take(words.indices)
            ends = offsets_of(ids)[split.offsets.to_numpy()]
            runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends), ids.buffers()[2]])
            return runs.to_pylist()


class ByteEncoder:
    """For a byte-level tokenizer with GPT-2's pre-tokens. Ids have two bytes.

    A space before a character that isn't white space always begins a pre-token:
    letters, digits and marks take one space with them, and a run of white space
    leaves its last space to them. So texts can be cut there.
    """

    cut = re.compile(r" (?=\S)")

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self._tokenizer = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._parts = _Parts(self._encode)

    def _encode(self, parts: list[str]) -> list[bytes]:
        encode = self._tokenizer.encode_ordinary
        return [as_bytes("H", encode(" " + p)) for p in parts]

    def forget(self) -> None:
        """Gives memory back at the end of a task."""
        self._parts.forget()

    def encode_whole(self, text: str) -> list[int]:
        return self._tokenizer.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return self._tokenizer.decode(ids)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; none for a null.

        Whole texts: remembering parts costs more than merging them again.
        """
        encode = self._tokenizer.encode_ordinary
        with no_collector():
            return [as_bytes("H", encode(t or "")) for t in texts.to_pylist()]

    def counts(self, parts: list[str]) -> list[int]:
        """The number of ids of each part, a space before it included."""
        wanted = set(parts)
        self._parts.learn(wanted)
        out = [len(self._parts[p]) >> 1 for p in parts]
        self._parts.forget_long(wanted)
        return out


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=2)
def byte_encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(path, pattern)
