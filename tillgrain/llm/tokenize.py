"""Whole texts to token ids with a public tokenizer file, word by word from a cache.

The library's pre-tokenizers never join what a single space or a run of line feeds between
two visible characters separates, nor a letter and the punctuation that ends its word, so
the ids of a text are those of such pieces in a row.  A piece is encoded by the library
once; its ids are kept under its 64-bit hash.  A text whose spacing does not allow the split, or
which may hold an added token of the file, is encoded by the library as a whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .arrays import U, groups, joined, seeded, span_hash

CACHE = 400_000       # pieces a worker keeps; then those stay that were met again, half of this at most
FILL = 200_000        # characters that are cut into pieces at once, some 50 bytes of arrays each
_encoders: dict[str, "Encoder"] = {}

_space = np.zeros(256, bool)
_space[[0x20, 0x0A]] = True
_tail = np.zeros(256, bool)
_tail[list(b".,;:!?*&%$#|\"()[]-")] = True
_letter = np.zeros(256, bool)
_letter[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
# White space other than space and line feed, as the patterns of the files see it.
_odd_space = re.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def encoder(path: str) -> "Encoder":
    """One per Python worker and file; workers are reused from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        # A task has one core; threads of the library would each hold memory of their own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        # Byte-level files put a space into the word that follows; others drop it.
        self.spaced = len(self._whole("\n")) > 0
        # Added tokens are cut out before the patterns apply, so that a run of line feeds may end there.
        self.added = sorted({t.content[:2] for t in self.library.get_added_tokens_decoder().values()})
        names = self.library.get_vocab(with_added_tokens=True)
        self.begins = np.zeros(max(names.values()) + 1, bool)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        for name, k in names.items():
            self.begins[k], self.ends[k] = name.startswith("Ġ"), name.endswith("</w>")
        self._reset()

    def _reset(self) -> None:
        self.keys = [np.empty(0, U), np.empty(0, U)]        # sorted: many old, some new
        self.at = [np.empty((2, 0), np.int64), np.empty((2, 0), np.int64)]
        self.met = [np.empty(0, np.int32), np.empty(0, np.int32)]   # fills that met a piece again
        self.ids = np.empty(0, np.uint32)

    def _renew(self) -> None:
        """Forgets the pieces that were met again least, and half of what is counted of the others."""
        keys, at, met = np.concatenate(self.keys), np.concatenate(self.at, axis=1), np.concatenate(self.met)
        floor = 0
        while (met > floor).sum() > CACHE // 2:
            floor = 2 * floor + 1
        kept = np.flatnonzero(met > floor)
        kept = kept[np.argsort(keys[kept], kind="stable")]
        count = at[1, kept]
        begin = np.cumsum(count) - count
        ids = self.ids[np.repeat(at[0, kept] - begin, count) + np.arange(count.sum())]
        self._reset()
        self.keys[0], self.at[0], self.met[0], self.ids = keys[kept], np.stack([begin, count]), met[kept] // 2, ids

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """For each text its ids."""
        out: list = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if self._splits(t)]
        some, size = [], 0
        for k in plain:
            some.append(k)
            size += len(texts[k])
            if size > FILL:
                self._fill(out, texts, some)
                some, size = [], 0
        self._fill(out, texts, some)
        for k, ids in enumerate(out):
            if ids is None:
                out[k] = self._whole(texts[k])
        return out

    def _splits(self, text: str) -> bool:
        if any(mark in text for mark in self.added):
            return False
        if not self.spaced:
            return True
        return bool(text) and not (
            text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text
            or (not text.isascii() or "\t" in text or "\r" in text or "\x0b" in text
                or "\x0c" in text or "\x1c" in text or "\x1d" in text or "\x1e" in text
                or "\x1f" in text) and _odd_space.search(text))

    def _fill(self, out: list, texts: list[str], some: list[int]) -> None:
        if not some:
            return
        data, starts = joined([texts[k].encode() for k in some], b"\n")
        begin, end, led = self._pieces(data, starts)
        keys = seeded(span_hash(data, begin, end), 1)
        keys = np.where(led, seeded(keys, 2), keys)
        order, group, first = groups(keys)
        where = self._find(keys[order[first]], data, begin[order[first]], end[order[first]],
                           led[order[first]])
        of = np.empty(len(keys), np.int64)
        of[order] = group
        at, count = where[0][of], where[1][of]
        upto = np.concatenate([[0], np.cumsum(count)])
        take = np.repeat(at - upto[:-1], count) + np.arange(upto[-1])
        ids = self.ids[take]
        cut = upto[np.searchsorted(begin, starts[:-1])]
        cut = np.concatenate([cut, [upto[-1]]])
        for k, a, b in zip(some, cut[:-1], cut[1:]):
            out[k] = ids[a:b]

    def _pieces(self, data, starts):
        """Start and end of each piece, and whether a space leads it."""
        space = _space[data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate([[0], edge])
        word, stop = edge[0::2], edge[1::2]
        # The end of a word's core: after its last byte that is no closing punctuation.
        place = np.where(_tail[data], np.int32(-1), np.arange(len(data), dtype=np.int32))
        core = np.maximum.accumulate(place)[stop - 1] + 1
        whole = (core <= word) | ~_letter[data[np.maximum(core - 1, 0)]]
        core = np.where(whole, stop, core)
        led = np.zeros(len(word), bool)
        if self.spaced:
            led = (word > 0) & (data[np.maximum(word - 1, 0)] == 0x20)
            led &= ~np.isin(word, starts)
        parts = [(word, core, led), (core[core < stop], stop[core < stop], np.zeros((core < stop).sum(), bool))]
        if self.spaced:
            feed = data == 0x0A
            feed[starts[1:] - 1] = False          # the gaps between the texts
            run = np.flatnonzero(np.diff(np.concatenate([[0], feed.view(np.int8), [0]])))
            a, b = run[0::2], run[1::2]
            long = b - a > 1                      # all but the last line feed go together
            for x, y in ((a[long], b[long] - 1), (b - 1, b)):
                parts.append((x, y, np.zeros(len(x), bool)))
        begin = np.concatenate([p[0] for p in parts])
        order = np.argsort(begin, kind="stable")
        return begin[order], np.concatenate([p[1] for p in parts])[order], \
            np.concatenate([p[2] for p in parts])[order]

    def _find(self, keys, data, begin, end, led):
        """Where the ids of each distinct piece are: (offset, count)."""
        if len(self.keys[0]) + len(self.keys[1]) > CACHE:
            self._renew()
        found = np.full((2, len(keys)), -1, np.int64)
        for known, at, met in zip(self.keys, self.at, self.met):
            k = np.searchsorted(known, keys)
            hit = k < len(known)
            hit[hit] = known[k[hit]] == keys[hit]
            found[:, hit] = at[:, k[hit]]
            met[k[hit]] += 1
        new = np.flatnonzero(found[0] < 0)
        if len(new):
            raw = data.tobytes()
            pieces = [raw[a:b].decode() for a, b in zip(begin[new].tolist(), end[new].tolist())]
            ids, at, count = self._learn(pieces, led[new])
            found[0, new], found[1, new] = len(self.ids) + at, count
            self.ids = np.concatenate([self.ids, ids])
            self._keep(keys[new], found[:, new])
        return found

    def _keep(self, keys, at):
        small = 0 if 4 * len(self.keys[1]) > len(self.keys[0]) else 1
        met = np.zeros(len(keys), np.int32)
        for k in range(1, small - 1, -1):
            keys, at = np.concatenate([self.keys[k], keys]), np.concatenate([self.at[k], at], axis=1)
            met = np.concatenate([self.met[k], met])
            self.keys[k], self.at[k], self.met[k] = np.empty(0, U), np.empty((2, 0), np.int64), np.empty(0, np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys[small], self.at[small], self.met[small] = keys[order], at[:, order], met[order]

    def _learn(self, pieces: list[str], led: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of new pieces, where those of each begin and how many: letters only many in one call, all others one by one."""
        at, count = np.full(len(pieces), -1, np.int64), np.zeros(len(pieces), np.int64)
        parts, size = [], 0
        easy = [k for k, (p, s) in enumerate(zip(pieces, led.tolist()))
                if (s or not self.spaced) and p.isalpha() and (p.isascii() or p.lower().isalpha())]
        for k in range(0, len(easy), 500):
            some = easy[k:k + 500]
            line = (" " if self.spaced else "") + " ".join([pieces[j] for j in some])
            got = np.array(self.library.encode_batch_fast([line], add_special_tokens=False)[0].ids,
                           np.uint32)
            cut = np.flatnonzero(self.begins[got])[1:] if self.spaced else \
                np.flatnonzero(self.ends[got])[:-1] + 1
            if len(cut) + 1 == len(some):
                bounds = np.concatenate([[0], cut, [len(got)]])
                at[some], count[some] = size + bounds[:-1], np.diff(bounds)
                parts.append(got)
                size += len(got)
        rest = np.flatnonzero(at < 0).tolist()
        for k in range(0, len(rest), 500):
            some = rest[k:k + 500]
            lines = [" " + pieces[j] if led[j] else pieces[j] for j in some]
            for j, e in zip(some, self.library.encode_batch_fast(lines, add_special_tokens=False)):
                parts.append(np.array(e.ids, np.uint32))
                at[j], count[j] = size, len(parts[-1])
                size += len(parts[-1])
        return np.concatenate(parts), at, count
