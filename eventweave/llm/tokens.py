"""Token ids of whole texts with a public tokenizer file, fast enough for a corpus.

The ``tokenizers`` library does the encoding. Its pre-tokenizers cut every text at places
that can be known beforehand (a single space or line break between two visible characters
for the byte-level file; any ASCII white space for the word-end file), so the ids of a text
are the ids of its words put together. A worker encodes each word once with the library's
model and keeps its ids and its bytes in a numpy hash table of fixed size under the word's 64-bit
hash; a word found there is compared with those bytes, and words beyond the bounds are encoded
again. Texts with other white space are encoded whole. The table only saves time: ids are those
of encoding the whole text.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from eventweave.llm.textops import LONG, SPACE, WORKER_TABLES, Words, column_bytes, same_bytes, split_words
from eventweave.llm.textops import eights as view_eights

#: Words whose ids one Python worker keeps (about 100 bytes each, allocated at once); words of more
#: than ``LONG`` bytes are not kept.
MAX_WORDS = 400_000
#: Pre-tokens kept beside them (about 200 bytes each).
MAX_PARTS = 40_000

#: The pre-tokenizer patterns of the two files (fixed values; a tokenizer file states its own).
_BYTE_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_WORD_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Pieces whose normal form and cuts are plain: visible Latin-1, after one space at most.
_PLAIN = re.compile(r" ?[!-~\u00a1-\u00ff]+")


def _byte_alphabet() -> dict[int, str]:
    """Latin-1 character -> its UTF-8 bytes as byte-level BPE writes them: visible bytes stand
    for themselves, the rest for the code points from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(visible)]
    sign = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(sign[b] for b in chr(c).encode()) for c in range(256)}


_ALPHABET = _byte_alphabet()


#: Bytes that may start white space beyond ASCII, or separators that libraries see differently.
_UNSURE = np.zeros(256, dtype=bool)
_UNSURE[[0xC2, 0xE1, 0xE2, 0xE3, 0xEF, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_ODD_SPACE = SPACE.copy()
_ODD_SPACE[[0x20, 0x0A]] = False


class WordEncoder:
    """``encode(column)`` -> (ids of all texts, number of ids of each text); null is empty."""

    def __init__(self, path: str, max_words: int = MAX_WORDS, max_parts: int = MAX_PARTS):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.drops_space = self.tok.normalizer is not None
        self.split = _WORD_SPLIT if self.drops_space else _BYTE_SPLIT
        self.dtype = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        self.max_words, self.max_parts = max_words, max_parts
        self.parts: dict[str, tuple[int, ...]] = {}
        slots = 1 << (2 * max(max_words, 8)).bit_length()       # open addressing, at most half full
        self.mask, self.n_words = slots - 1, 0
        self.key = np.zeros(slots, np.uint64)                   # 0: free
        self.word = np.zeros(slots, np.int32)                   # where its bytes begin
        self.size = np.zeros(slots, np.int8)                    # and how many there are
        self.kind = np.zeros(slots, np.int8)
        spare = np.zeros(16 * max(max_words, 8) + 8, np.uint8)
        self.pool, self.n_pool = spare[:-8], 0
        self.pool_eights = np.ndarray((len(self.pool),), "<u8", buffer=spare, strides=(1,))
        self.begin = np.zeros(slots, np.int32)
        self.count = np.zeros(slots, np.int32)
        self.flat = np.zeros(8 * max(max_words, 8), self.dtype)
        self.n_flat = 0
        self.line_break = self.tok.encode("\n", add_special_tokens=False).ids[:1]

    # -- pieces the table does not hold -------------------------------------------------
    def _plain_ids(self, piece: str) -> tuple[int, ...]:
        """Ids of a plain piece: the library's BPE model on each pre-token."""
        out: tuple[int, ...] = ()
        for part in self.split.findall(piece.lower() if self.drops_space else piece):
            ids = self.parts.get(part)
            if ids is None:
                ids = tuple([t.id for t in self.model.tokenize(part.translate(_ALPHABET))])
                if len(self.parts) < self.max_parts:
                    self.parts[part] = ids
            out += ids
        return out

    def _pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = _PLAIN.fullmatch
        ids: list = [self._plain_ids(p) if plain(p) and "<|" not in p else None for p in pieces]
        rest = [i for i, x in enumerate(ids) if x is None]
        for i in range(0, len(rest), 2000):
            some = rest[i:i + 2000]
            for j, e in zip(some, self.tok.encode_batch_fast([pieces[k] for k in some], add_special_tokens=False)):
                ids[j] = e.ids
        counts = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids))
        return np.fromiter(chain.from_iterable(ids), dtype=self.dtype, count=int(counts.sum())), counts

    def _whole(self, data: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        texts = [bytes(data[offsets[r]:offsets[r + 1]]).decode() for r in rows.tolist()]
        return [np.array(self.tok.encode(t, add_special_tokens=False).ids, dtype=self.dtype) for t in texts]

    # -- the table ------------------------------------------------------------------------
    def _find(self, keys: np.ndarray, data: np.ndarray, eights: np.ndarray, start: np.ndarray, n: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot where each key stands or its probing ended, 1 known / 0 free slot / -1 another word's).
        Words of one length up to eight bytes never share a hash; longer ones are compared."""
        slot = (keys & np.uint64(self.mask)).astype(np.int64)
        state = np.zeros(len(keys), np.int8)
        left = np.arange(len(keys))
        while len(left):
            have = self.key[slot[left]]
            same = have == keys[left]
            hit = left[same]
            own = (self.size[slot[hit]] == n[hit]) & (self.kind[slot[hit]] == kind[hit])
            more = np.flatnonzero(own & (n[hit] > 8))
            at = hit[more]
            own[more] = same_bytes(self.pool, self.word[slot[at]].astype(np.int64), data, start[at], n[at], self.pool_eights, eights)
            state[hit] = np.where(own, 1, -1)
            left = left[~same & (have != 0)]
            slot[left] = (slot[left] + 1) & self.mask
        return slot, state

    def _keep(self, keys: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray, kind: np.ndarray,
              slot: np.ndarray, first: np.ndarray, n: np.ndarray) -> None:
        word = self.n_pool + np.cumsum(size) - size
        self.pool[self.n_pool:self.n_pool + int(size.sum())] = data[np.repeat(start - (word - self.n_pool), size) + np.arange(int(size.sum()))]
        self.n_pool += int(size.sum())
        slot, left = slot.copy(), np.arange(len(keys))
        while len(left):
            free = left[self.key[slot[left]] == 0]
            _, one = np.unique(slot[free], return_index=True)          # one word a slot; the others go on
            won = free[one]
            at = slot[won]
            self.key[at], self.begin[at], self.count[at] = keys[won], first[won], n[won]
            self.word[at], self.size[at], self.kind[at] = word[won], size[won], kind[won]
            left = left[self.key[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & self.mask
        self.n_words += len(keys)

    def _look_up(self, w: Words, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat ids, begin, count) of every word; kind: 0 bare, 1 after a space, 2 after a line break."""
        keys = np.maximum(w.hash ^ (kind.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)), np.uint64(1))
        uniq, at, back = np.unique(keys, return_index=True, return_inverse=True)
        # words that only share a hash stand for themselves
        size = w.end - w.start
        like = at[back]
        other = (size != size[like]) | (kind != kind[like])
        own = view_eights(w.data)
        more = np.flatnonzero(~other & (size > 8) & (like != np.arange(len(like))))
        other[more] = ~same_bytes(w.data, w.start[more], w.data, w.start[like[more]], size[more], own, own)
        alone = np.flatnonzero(other)
        back[alone] = len(uniq) + np.arange(len(alone))
        uniq, at = np.concatenate([uniq, keys[alone]]), np.concatenate([at, alone])
        s, n, kinds = w.start[at], size[at], kind[at]
        slot, state = self._find(uniq, w.data, own, s, n, kinds)
        known = state == 1
        begin, count = np.zeros(len(uniq), np.int64), np.zeros(len(uniq), np.int32)
        begin[known], count[known] = self.begin[slot[known]], self.count[slot[known]]
        flat = self.flat
        new = np.flatnonzero(~known)
        if len(new):
            raw, lead_in = w.data.tobytes(), ("", " ", "")
            pieces = [lead_in[k] + raw[a:a + m].decode() for a, m, k in zip(s[new].tolist(), n[new].tolist(), kinds[new].tolist())]
            ids, got = self._pieces(pieces)
            breaks = kinds[new] == 2
            if breaks.any():    # the line break's id stands before the word's
                where = (np.cumsum(got) - got)[breaks]
                ids, got = np.insert(ids, where, self.line_break), got + breaks
            first = self.n_flat + np.cumsum(got, dtype=np.int64) - got
            begin[new], count[new] = first, got
            own = np.flatnonzero((state[new] == 0) & (n[new] <= LONG) & (new < len(uniq) - len(alone)))
            if (self.n_words + len(own) <= self.max_words and self.n_flat + len(ids) <= len(self.flat)
                    and self.n_pool + int(n[new[own]].sum()) <= len(self.pool)):
                self.flat[self.n_flat:self.n_flat + len(ids)] = ids
                self.n_flat += len(ids)
                kept = new[own]
                self._keep(uniq[kept], w.data, s[kept], n[kept], kinds[kept], slot[kept], first[own], got[own])
            else:
                flat = np.concatenate([self.flat[: self.n_flat], ids])
        return flat, begin[back], count[back]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = column_bytes(column)
        rows = len(offsets) - 1
        w = split_words(data, offsets)
        kind = np.zeros(len(w.start), dtype=np.int8)
        whole = np.zeros(0, np.int64)
        if not self.drops_space:
            lead = w.start > offsets[w.row]
            before = data[w.start - 1]
            kind[lead] = np.where(before[lead] == 0x0A, 2, 1)
            # one space or line break between words and none at the ends; else the whole text goes to the library
            odd = _UNSURE[data] | _ODD_SPACE[data]
            twice = SPACE[data[1:]] & SPACE[data[:-1]]
            odd[1:] |= twice
            edge = np.flatnonzero(np.diff(offsets))
            odd[offsets[edge]] |= SPACE[data[offsets[edge]]]
            odd[offsets[edge + 1] - 1] |= SPACE[data[offsets[edge + 1] - 1]]
            whole = np.unique(np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1)
            if len(whole):
                keep = ~np.isin(w.row, whole)
                w = Words(data, w.start[keep], w.end[keep], w.hash[keep], w.row[keep], w.first)
                kind = kind[keep]
        flat, begin, count = self._look_up(w, kind)
        total = np.zeros(len(count) + 1, dtype=np.int64)
        np.cumsum(count, out=total[1:])
        ids = flat[np.arange(total[-1]) + np.repeat(begin - total[:-1], count)]
        edge = np.searchsorted(w.row, np.arange(rows + 1))
        n = np.diff(total[edge])
        if len(whole):
            own = self._whole(data, offsets, whole)
            parts = np.split(ids, np.cumsum(n)[:-1])
            for r, x in zip(whole.tolist(), own):
                parts[r] = x
            n = np.array([len(x) for x in parts], dtype=np.int64)
            ids = np.concatenate(parts)
        return ids, n


_encoders: dict[str, WordEncoder] = {}
WORKER_TABLES.append(_encoders)


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file (one table at a time in a worker)."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
