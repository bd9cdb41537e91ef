"""Ids of a tokenizer file, for many texts at once. Runs on the executors.

Texts are parted into units at places where the tokenizer's own pattern is certain to part them, so
that the ids of a text are those of its units in a row. Equal units of a batch are found as arrays
and encoded once by the library. A memo of short units is kept for the life of a worker process; it
is emptied when it is full.
"""

from __future__ import annotations

import json
import re
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from .words import SEED, chunks, mix

MEMO_UNITS = 200_000
MEMO_BYTES = 48
BATCH_BYTES = 1_000_000
RUN = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _kinds() -> dict[str, np.ndarray]:
    """Which bytes are ASCII letters, full stops or commas, white space that every pattern knows as
    such, and characters that none does; 0xC3 leads the letters from À to ÿ."""
    kinds = {name: np.zeros(256, bool) for name in ("letter", "mark", "space", "shown")}
    kinds["letter"][[*range(65, 91), *range(97, 123)]] = True
    kinds["mark"][[44, 46]] = True
    kinds["space"][[9, 10, 13, 32]] = True
    kinds["shown"][0x21:0x7F] = True
    return kinds


def _parted(data: np.ndarray, offsets: np.ndarray, byte_level: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the units, in order.

    Letters part from full stops and commas either way. A pattern that drops white space parts at
    it. The byte-level pattern keeps it with what follows: a lone space between shown characters
    begins a unit, and a lone line feed between them is one.
    """
    kinds, n = _kinds(), len(data)
    letter, mark = kinds["letter"][data], kinds["mark"][data]
    ended = letter.copy()  # the last byte of a letter; × and ÷ are none
    ended[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    starts = np.zeros(n + 1, bool)
    starts[1:n] = (ended[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    if byte_level:
        before = kinds["shown"][data]
        before[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80)
        after = kinds["shown"][data] | (data == 0xC3)
        alone = np.zeros(n, bool)
        alone[1:-1] = before[:-2] & after[2:]
        feed = alone & (data == 10)
        starts[:n] |= (alone & (data == 32)) | feed
        starts[1:] |= feed
        starts[offsets] = True
        at = np.flatnonzero(starts[:n])
        return at, np.diff(np.append(at, n))
    inside = ~kinds["space"][data]
    starts[1:n] |= ~inside[:-1]
    starts[offsets] = True
    at = np.flatnonzero(starts[:n] & inside)
    return at, np.add.reduceat(inside, at, dtype=np.int64) if len(at) else at


def _ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places begins[i] to begins[i] + lengths[i], one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)


class Codec:
    """spec: the text of a tokenizer file of the tokenizers library."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        parts = json.loads(spec)
        self.byte_level = parts["pre_tokenizer"]["type"] == "ByteLevel"
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        added = {t["id"]: t["content"].encode() for t in parts["added_tokens"]}
        letters = byte_letters()
        table = [b""] * (max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1)
        if self.byte_level:
            for token, number in self.tokenizer.get_vocab(with_added_tokens=True).items():
                table[number] = added.get(number) or bytes(letters[c] for c in token)
        self.table = table
        shown = {b: c for c, b in letters.items()}
        self.spelling = {code: "".join(shown[b] for b in chr(code).encode()) for code in (32, *range(0xC0, 0x100))}
        self.lengths = np.array([len(t) for t in table], np.int64)
        self.numbers = np.random.default_rng(SEED + 5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2)
        self.memo: dict[bytes, bytes] = {}

    def plain(self, text: str) -> np.ndarray:
        """The library's ids of one text."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _ids(self, units: list[bytes]) -> dict[bytes, bytes]:
        """Ids of units. A run of letters up to ÿ is one piece of either pattern and in normal form,
        so that it goes to the model at once, as the letters of its bytes."""
        tokenize, spelling, out, others = self.tokenizer.model.tokenize, self.spelling, {}, {}
        for u in units:
            text = u.decode()
            if u.isalpha():  # ASCII letters stand for themselves
                out[u] = array("I", [t.id for t in tokenize(text if self.byte_level else text.lower())]).tobytes()
            elif RUN.fullmatch(text):
                word = (text if self.byte_level else text.lower()).translate(spelling)
                out[u] = array("I", [t.id for t in tokenize(word)]).tobytes()
            else:
                others[u] = text
        encoded = self.tokenizer.encode_batch_fast(list(others.values()), add_special_tokens=False)
        out.update((u, array("I", e.ids).tobytes()) for u, e in zip(others, encoded))
        return out

    def _of_chunk(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        starts, lengths = _parted(data, offsets, self.byte_level)
        if not len(starts):
            return [b""] * (len(offsets) - 1)
        bytes_at = _ragged(starts, lengths)
        begins = np.cumsum(lengths) - lengths
        powers = np.multiply.accumulate(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
        place = np.arange(len(bytes_at)) - np.repeat(begins, lengths)
        hashes = mix(np.add.reduceat((self.numbers[data[bytes_at]] + np.uint64(1)) * powers[place], begins))
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        alike = np.array_equal(lengths[first][which], lengths) and np.array_equal(
            data[bytes_at], data[_ragged(starts[first][which], lengths)])
        if not alike:  # two units of one hash
            first, which = np.arange(len(starts)), np.arange(len(starts))
        raw, memo = data.tobytes(), self.memo
        units = [raw[a : a + n] for a, n in zip(starts[first].tolist(), lengths[first].tolist())]
        new = self._ids([u for u in dict.fromkeys(units) if u not in memo])
        ids = [memo[u] if u in memo else new[u] for u in units]
        memo.update((u, x) for u, x in new.items() if len(u) <= MEMO_BYTES)
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4")
        counts = sizes[which]
        out = flat[_ragged((np.cumsum(sizes) - sizes)[which], counts)].tobytes()
        rows = np.searchsorted(offsets, starts, side="right") - 1
        ends = 4 * np.cumsum(np.bincount(rows, weights=counts, minlength=len(offsets) - 1)).astype(np.int64)
        return [out[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; null is an empty text."""
        out = []
        for _, _, data, offsets in chunks(texts, BATCH_BYTES):
            if len(self.memo) > MEMO_UNITS:
                self.memo.clear()
            out += self._of_chunk(data, offsets)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids of a byte-level vocabulary stand for."""
        return b"".join([self.table[i] for i in ids.tolist()])


def codec_of(spec: str) -> Codec:
    """The codec of this worker process; it outlives a task."""
    home = sys.modules.setdefault("_marquee_llm_codecs", types.ModuleType("_marquee_llm_codecs"))
    known = home.__dict__.setdefault("codecs", {})
    if spec not in known:
        known.clear()
        known[spec] = Codec(spec)
    return known[spec]


def read_spec(path: str) -> str:
    """A tokenizer file of the machine of the driver, sent to the executors as text."""
    with open(path, encoding="utf-8") as file:
        return file.read()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
