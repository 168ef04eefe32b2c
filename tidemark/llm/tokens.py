"""Token ids of whole texts by a tokenizers file, encoded by distinct words with a cache of words.

A text's ids are the ids of its words in turn: the pre-tokenizer of the given file never takes ASCII white space into a
token, and its normaliser works on single characters and combining sequences. `split` holds after this was tried on
probes; a tokenizer that fails them encodes whole texts. Words are found in the bytes, made distinct by Arrow and looked
up in a table by hash, and by bytes where hashes agree, all in arrays: Python sees new words alone.

Letters A to Z are put into lower case beforehand, so that a word is one word in each case; not in texts with combining
marks, as some letters form one character with a mark in lower case alone, nor where special tokens may stand.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import bytes_of, entering, texts_of

#: Bytes that the newer half of a worker's table of words takes; beyond, it becomes the older half, from which words in use come back. Longer words than LONGEST bytes aren't kept.
CACHE_BYTES, LONGEST = 24 << 20, 64
#: Bytes of text whose words are looked up at once.
STRETCH = 2 << 20
_BYTES = np.arange(256)
_WHITE = ((_BYTES >= 9) & (_BYTES <= 13)) | (_BYTES == 32)
#: Bytes that are a token of their own at a word's end, after a lower-case letter or digit.
_ENDS, _PLAIN = np.isin(_BYTES, list(b".,;:!?")), ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MARKS = r"[\x{300}-\x{36F}]"
_PROBES = ("Der erste Satz, und: der zweite.\n\nIt's  <|endoftext|> a\tTEST 12.5 é́ İ ΣΣ x", " lead\x0btrail ", "'s't 're a'b (c)d ¿qué?", "İ. T\u0308 H\u0331! x\u0301.", "")

def _ragged(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... n times, for each row."""
    return np.arange(int(n.sum())) + np.repeat(first - np.cumsum(n) + n, n)


def _hashes(data: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A polynomial of each word's bytes; words lie side by side in data."""
    if not len(n):
        return np.zeros(0, np.uint64)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(n.max()), _BASE)]), dtype=np.uint64)
    value = (data.astype(np.uint64) + np.uint64(1)) * power[np.arange(len(data)) - np.repeat(first - first[0], n)]
    return np.add.reduceat(value, first - first[0], dtype=np.uint64)


class Table:
    """Words, by hash, with their ids, in arrays."""

    def __init__(self):
        self.hash, self.words, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, "<u4")
        self.first, self.n, self.first_id, self.n_ids = (np.zeros(0, np.int64) for _ in range(4))

    def __len__(self):
        return self.words.nbytes + self.ids.nbytes + 40 * len(self.hash)

    def find(self, hashes: np.ndarray, data: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The row of each word, -1 where it isn't there."""
        if not len(self.hash):
            return np.full(len(n), -1)
        row = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        hit = np.flatnonzero((self.hash[row] == hashes) & (self.n[row] == n))
        m = n[hit]
        other = data[_ragged(first[hit], m)] != self.words[_ragged(self.first[row[hit]], m)]
        out = np.full(len(n), -1)
        out[hit] = row[hit]
        out[np.repeat(hit, m)[other]] = -1
        return out

    def add(self, hashes, data, first, n, ids, n_ids) -> None:
        """Words whose ids stand side by side in ids."""
        short = n <= LONGEST
        first_id = np.cumsum(n_ids) - n_ids
        hashes, first, n, first_id, n_ids = hashes[short], first[short], n[short], first_id[short], n_ids[short]
        ids = ids[_ragged(first_id, n_ids)]
        columns = [np.concatenate(x) for x in ((self.hash, hashes), (self.first, np.cumsum(n) - n + len(self.words)), (self.n, n), (self.first_id, np.cumsum(n_ids) - n_ids + len(self.ids)), (self.n_ids, n_ids))]
        order = np.argsort(columns[0], kind="stable")
        self.words, self.ids = np.concatenate([self.words, data[_ragged(first, n)]]), np.concatenate([self.ids, ids])
        self.hash, self.first, self.n, self.first_id, self.n_ids = (x[order] for x in columns)


class Encoder:
    """The ids of texts as arrays of little-endian unsigned 32-bit integers, without special tokens at the ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.n_ids = max(vocab.values()) + 1
        self.last = np.zeros(self.n_ids, bool)
        if suffix := json.loads(self.tok.to_str())["model"].get("end_of_word_suffix"):
            self.last[[i for w, i in vocab.items() if w.endswith(suffix)]] = True
        self.new, self.old = Table(), Table()
        self.split = all(self._by_word(pa.array([t]))[0].tobytes() == self._whole(t).tobytes() for t in _PROBES)

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters alone are one pre-token each, so many of them are encoded in one go and cut at word ends."""
        out: dict[str, bytes] = {}
        letters = [w for w in words if w.isalpha()] if self.last.any() else []
        for at in range(0, len(letters), 4096):
            part = letters[at : at + 4096]
            ids = np.asarray(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                raw, begin = ids.tobytes(), 0
                for w, end in zip(part, (ends * 4).tolist()):
                    out[w] = raw[begin:end]
                    begin = end
        rest = [w for w in words if w not in out]
        for at in range(0, len(rest), 4096):
            part = rest[at : at + 4096]
            for w, e in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False)):
                out[w] = np.asarray(e.ids, "<u4").tobytes()
        return out

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, the first one's place, how many) of distinct words."""
        data, edges = bytes_of(words)
        first, n = edges[:-1], np.diff(edges)
        hashes = _hashes(data, first, n)
        row = self.new.find(hashes, data, first, n)
        pool, at, size = [self.new.ids], np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        have = row >= 0
        at[have], size[have] = self.new.first_id[row[have]], self.new.n_ids[row[have]]
        gone = np.flatnonzero(~have)
        if not len(gone):
            return pool[0], at, size
        row = self.old.find(hashes[gone], data, first[gone], n[gone])
        back, lost = gone[row >= 0], gone[row < 0]
        row = row[row >= 0]
        parts = [self.old.ids[_ragged(self.old.first_id[row], self.old.n_ids[row])]]
        many = [self.old.n_ids[row]]
        if len(lost):
            names = words.take(pa.array(lost)).to_pylist()
            learnt = self._learn(names)
            raw = [learnt[w] for w in names]
            parts.append(np.frombuffer(b"".join(raw), "<u4"))
            many.append(np.fromiter(map(len, raw), np.int64, len(raw)) // 4)
        come, ids, n_ids = np.concatenate([back, lost]), np.concatenate(parts), np.concatenate(many)
        at[come], size[come] = np.cumsum(n_ids) - n_ids + len(pool[0]), n_ids
        if len(self.new) > CACHE_BYTES:
            self.old, self.new = self.new, Table()
        self.new.add(hashes[come], data, first[come], n[come], ids, n_ids)
        return np.concatenate([*pool, ids]), at, size

    def _by_word(self, texts: pa.Array) -> list[np.ndarray]:
        texts = texts.cast(pa.large_string())
        marked = pc.match_substring(texts, "<|")  # special tokens stay as they are
        if not pc.all(pc.string_is_ascii(texts)).as_py():
            marked = pc.or_(marked, pc.match_substring_regex(texts, _MARKS))
        low = pc.if_else(marked, texts, pc.ascii_lower(texts)) if pc.any(marked).as_py() else pc.ascii_lower(texts)
        data, edges = bytes_of(low)
        inside = ~_WHITE[data]
        begins = edges[:-1][edges[:-1] < len(data)]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        first[begins] = inside[begins]  # texts touch in the bytes
        last = np.append(~inside[1:], True)
        last[begins[begins > 0] - 1] = True
        first[1:] |= _ENDS[data[1:]] & _PLAIN[data[:-1]] & last[1:] & ~first[1:]
        at = np.flatnonzero(first)
        offsets = np.append((np.cumsum(inside) - 1)[at], inside.sum()).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = words.dictionary_encode()
        pool, start, size = self._ids(coded.dictionary)
        word = coded.indices.to_numpy()
        n = size[word]
        flat = pool[_ragged(start[word], n)]
        ends = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(at, edges)].tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:])]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Null texts count as empty ones."""
        for _, part in texts_of(texts, STRETCH):
            yield from self._by_word(part) if self.split else (self._whole(t) for t in part.to_pylist())


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each file and worker."""
    entering("tokens", _encoders.clear)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
