"""Token ids of many texts as the ``tokenizers`` library gives them, each distinct piece encoded once.

A byte-level BPE splits a text into pieces by a fixed pattern (contractions; an optional space
with letters, digits or other signs; white space) and encodes each piece alone. Here the split is
vectorised over a batch, and only pieces that the worker's table does not hold are encoded. The
table has a fixed number of slots, so memory is bounded whatever the texts contain.

Pieces are merged by ``tiktoken``, which does the same merges several times faster, if the file's
merges are in the order of their ids, as its ranks demand. Texts that hold a special token's string
or a code point that not every Unicode version assigns, and vocabularies that split or merge in
another way, go to the ``tokenizers`` library whole."""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import regex

from tablewatch.llm import bytetext as bt
from tablewatch.llm.bytetext import U

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

SLOT_BITS = 20
SHORT = 6                       # ids kept in a slot; longer pieces are encoded again when they return
CHUNK = 1 << 20                 # bytes split at a time, at document ends
OTHER, LETTER, NUMBER, SPACE, DOUBT = range(5)

_KINDS: list[np.ndarray] = []


def kinds() -> np.ndarray:
    """The class of every code point."""
    if not _KINDS:
        every = "".join(map(chr, range(0x110000)))
        table = np.zeros(0x110000, np.uint8)
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                table[m.start():m.end()] = kind
        new = [c for c in np.flatnonzero(table).tolist() if unicodedata.category(chr(c)) == "Cn"]
        table[new] = DOUBT
        _KINDS.append(table)
    return _KINDS[0]


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Start and end byte of every piece, and its row; None if a code point's class is in doubt."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)                                   # first byte of each code point
    point = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = kinds()[point]
    if (kind == DOUBT).any():
        return None
    n = len(point)
    edge = np.zeros(n + 1, bool)                                # rows begin here
    edge[np.searchsorted(at, offsets)] = True
    same_row = ~edge[:n]                                        # the code point before is of the same row
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # Something after white space: the last white space is a piece of its own, or leads it if it is a space.
    after = np.flatnonzero(start & same_row & (kind != SPACE))
    after = after[kind[after - 1] == SPACE]
    start[after - 1] = True
    start[after[point[after - 1] == 0x20]] = False
    # Contractions: a lone apostrophe that begins a piece, then s, t, m, d, re, ve or ll.
    quote = np.flatnonzero((point == 0x27) & start)
    if len(quote):
        inner = lambda i: np.where((i < n) & ~edge[np.minimum(i, n)], point[np.minimum(i, n - 1)], 0)
        one = inner(quote + 1)
        two = np.where(one > 0, inner(quote + 2), 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 2, 0)
        for a, b in ("re", "ve", "ll"):
            size = np.where((one == ord(a)) & (two == ord(b)), 3, size)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        rest = quote + size
        rest = rest[rest < n]
        rest = rest[(kind[rest] == LETTER) & ~edge[rest]]
        start[rest] = True
    begin = at[np.flatnonzero(start)]
    return begin, np.append(begin[1:], len(data)), np.searchsorted(offsets, begin, side="right") - 1


def _merger(spec: dict):
    """Bytes of a piece to its ids, if the vocabulary is one that ranks describe; else None."""
    import tiktoken

    # The byte-level alphabet: printable Latin-1 signs stand for themselves, the others from 256 up.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
    special = {t["content"] for t in spec.get("added_tokens") or ()}
    ids = [vocab.get(a + b) for a, b in merges]
    options = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout", "byte_fallback", "ignore_merges")
               if spec["model"].get(k)]
    words = {w: i for w, i in vocab.items() if w not in special}
    ordered = None not in ids and all(a < b for a, b in zip(ids, ids[1:])) and len(set(ids)) + 256 == len(words)
    if options or not ordered or any(c not in byte_of for w in words for c in w):
        return None
    ranks = {bytes(byte_of[c] for c in w): i for w, i in words.items()}
    if any(ranks.get(bytes([b]), 1 << 30) > ids[0] for b in range(256)):
        return None
    core = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    return core.encode_single_piece


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.merge = _merger(spec) if spec.get("model", {}).get("type") == "BPE" else None
        self.by_piece = (self.merge is not None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
                         and spec.get("normalizer") is None and self.tokenizer.get_vocab_size() <= 1 << 16)
        self.special = [t["content"].encode() for t in spec.get("added_tokens") or ()]
        self.keys = np.zeros(1 << SLOT_BITS, U)
        self.sizes = np.zeros(1 << SLOT_BITS, np.uint8)
        self.ids = np.zeros((1 << SLOT_BITS, SHORT), np.uint16)

    def whole(self, texts: list[str]) -> list[list[int]]:
        """The library's own ids."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Chunks ``(first row, ids, id offsets of the rows)`` that cover all rows in order."""
        n, lo = len(offsets) - 1, 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, side="right")) - 1)
            got = self._pieces(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            if got:
                yield lo, *got
            else:  # row by row: the library takes the texts that need it
                for i in range(lo, hi):
                    text = data[offsets[i]:offsets[i + 1]]
                    got = self._pieces(text, offsets[i:i + 2] - offsets[i])
                    if not got:
                        ids = np.array(self.whole([text.tobytes().decode()])[0], np.uint32)
                        got = ids, np.array([0, len(ids)])
                    yield i, *got
            lo = hi

    def _pieces(self, data, offsets):
        """Ids and the rows' offsets in them; None if the library has to take some text whole."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        raw = data.tobytes()
        if not self.by_piece or any(s in raw for s in self.special):
            return None
        split = pieces(data, offsets)
        if split is None:
            return None
        begin, end, row = split
        key = bt.word_hashes(data, begin, end)
        slot = (key >> U(64 - SLOT_BITS)).astype(np.int64)
        known = self.keys[slot] == key
        size = self.sizes[slot].astype(np.int64)
        short = self.ids[slot]
        miss = np.flatnonzero(~known)
        longer: list[tuple[int, list[int]]] = []
        if len(miss):
            fresh, first, which = np.unique(key[miss], return_index=True, return_inverse=True)
            asked = miss[first]
            got = [self.merge(raw[s:e]) for s, e in zip(begin[asked].tolist(), end[asked].tolist())]
            lengths = np.array([len(g) for g in got])
            table = np.zeros((len(got), SHORT), np.uint16)
            flat = np.array([x for g in got for x in g[:SHORT]], np.uint16)
            table[np.arange(SHORT) < np.minimum(lengths, SHORT)[:, None]] = flat
            size[miss], short[miss] = lengths[which], table[which]
            fit = lengths <= SHORT
            place = slot[asked[fit]]
            self.keys[place], self.sizes[place], self.ids[place] = fresh[fit], lengths[fit], table[fit]
            longer = [(i, got[w]) for i, w in zip(miss.tolist(), which.tolist()) if not fit[w]]
        at = np.concatenate(([0], np.cumsum(size)))
        out = np.empty(at[-1], np.uint32)
        mask = np.arange(SHORT) < size[:, None]
        if longer:
            wide = np.array([i for i, _ in longer])
            mask[wide] = False
            fill = np.ones(len(out), bool)
            for i, ids in longer:
                out[at[i]:at[i + 1]] = ids
                fill[at[i]:at[i + 1]] = False
            out[fill] = short[mask]
        else:
            out[:] = short[mask]
        return out, at[bt.first_of(row, len(offsets) - 1)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
