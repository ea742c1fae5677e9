"""Token ids of whole texts, for the packing operators."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from netstream.llm.common import SPACE, Chunk, text_chunks

CACHED_WORDS = 1_000_000

_tokenizers: dict = {}

_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_POINT = np.isin(np.arange(256), list(b".,"))


def shard_words(keys: np.ndarray, raw: np.ndarray, bounds: np.ndarray) -> Chunk:
    """The words of a shard; a ``.`` or ``,`` between a letter A-Z and white
    space is a word of its own (the tokenizer parts there as well), so that
    words recur more often."""
    after = np.append(SPACE[raw[1:]], True)
    after[bounds[1:][bounds[1:] > 0] - 1] = True
    cut = np.flatnonzero(_POINT[raw] & after)
    return Chunk(keys, raw, bounds, True, cut[(cut > 0) & _LETTER[raw[np.maximum(cut, 1) - 1]]])


class WordTokenizer:
    """Ids of texts by a lower-casing tokenizer that cuts at white space and
    between letters and punctuation: each word is encoded once, and up to
    ``limit`` words are remembered by their hashes."""

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = sorted((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special)
        self.mark = special[-1] if special else None
        added = [re.escape(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile(b"|".join(added), re.IGNORECASE) if added else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # ids at which a word ends
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.limit = limit
        self.known, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and how many each has."""
        texts = [w.decode("utf-8", "replace") for w in words]
        plain = np.array([t.isalpha() for t in texts], bool)
        size, parts = np.zeros(len(texts), np.int64), [None, None]
        for kind, encode in enumerate((self._marked, self._letters)):
            rows = np.flatnonzero(plain == bool(kind))
            parts[kind], size[rows] = encode([texts[i] for i in rows.tolist()])
        ids = np.empty(int(size.sum()), "<u4")
        own = np.repeat(plain, size)
        ids[~own], ids[own] = parts
        return ids, size

    def _letters(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters only: the tokenizer takes each as one piece, whose
        last id says that a word ends; fifty at a time with a space between."""
        joined = [" ".join(texts[i:i + 50]) for i in range(0, len(texts), 50)]
        flat = [i for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False) for i in e.ids]
        ids = np.array(flat, "<u4")
        size = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(size) == len(texts) and size.sum() == len(ids):
            return ids, size
        return self._marked(texts)

    def _marked(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Any words: twenty at a time with a special token between them, at which
        the ids are cut again."""
        if not self.mark or any(self.mark[1] in t for t in texts):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)
        joined, flat = [self.mark[1].join(texts[i:i + 20]) for i in range(0, len(texts), 20)], []
        for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            flat += e.ids
            flat.append(self.mark[0])
        ids = np.array(flat, "<u4")
        cut = ids == self.mark[0]
        return ids[~cut], np.diff(np.flatnonzero(cut), prepend=-1) - 1

    def as_written(self, words: Chunk) -> np.ndarray:
        """The words that contain the text of an added token in any case: the
        tokenizer looks for it before it lower-cases."""
        found = [m.start() for m in self.added.finditer(words.raw.tobytes())] if self.added else []
        return np.unique(np.searchsorted(words.starts, np.array(found, np.int64), side="right") - 1)

    def __call__(self, words: Chunk, end_id: int) -> list[np.ndarray]:
        """Ids of each document, the end id last."""
        own, kept = words.hashes.copy(), self.as_written(words)
        for i in kept:  # remembered by the bytes as they stand
            own[i] = int.from_bytes(hashlib.blake2b(words.word(i), digest_size=8).digest(), "little")
        hashes, first, place = np.unique(own, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        new = self.known[np.minimum(at, len(self.known) - 1)] != hashes if len(self.known) else np.ones(len(hashes), bool)
        texts = [words.word(i) if w else words.word(i).lower() for i, w in zip(first[new], np.isin(first[new], kept))]
        parts = [self.encode(texts[i:i + 5_000]) for i in range(0, len(texts), 5_000)]
        size, ids = np.zeros(len(hashes), np.int64), self.ids
        begin = np.zeros(len(hashes), np.int64)
        begin[~new], size[~new] = self.begin[at[~new]], self.size[at[~new]]
        if parts:
            size[new] = np.concatenate([n for _, n in parts])
            begin[new] = len(ids) + np.cumsum(size[new]) - size[new]
            ids = np.concatenate([ids, *(i for i, _ in parts)])
        if parts and len(self.known) < self.limit:
            self.ids = ids
            self.known, self.begin, self.size = (np.insert(old, at[new], add[new]) for old, add in (
                (self.known, hashes), (self.begin, begin), (self.size, size)))
        length = size[place]
        until = np.append(0, np.cumsum(length))
        flat = ids[np.repeat(begin[place] - until[:-1], length) + np.arange(until[-1])]
        cuts = until[np.append(0, np.cumsum(words.counts))]
        return [np.append(flat[a:b], np.uint32(end_id)) for a, b in zip(cuts, cuts[1:])]


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def token_ids(batches: Iterable[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """``(keys, ids of each document with the end id)`` of some documents after
    the other; ``batches`` are ``(KEY, TEXT)``."""
    encode = tokenizer(path)
    for keys, raw, bounds in text_chunks(batches):
        yield keys, encode(shard_words(keys, raw, bounds), end_id)


def vocabulary(path: str, end_id: int) -> int:
    """One more than the largest id."""
    found = tokenizer(path).tokenizer.get_vocab(with_added_tokens=True)
    return max([end_id, *found.values()]) + 1
