"""Byte-level BPE encoding of whole texts with the tokenizers library.

A pre-token border always lies before a space that follows a non-space, on both sides
of a lone line break, and between an ASCII letter or digit and an ASCII sign (after an
apostrophe it may not). A text is cut there and each distinct unit is encoded by the
library once per worker. Units are hashed and looked up with array operations, a batch
of texts at a time; a batch's new units are encoded in few calls, joined by spaces or
line breaks. Texts in which those rules are not enough (runs of white space, rare
white space, what may be a special token's string) or with a unit of over LONG bytes are
encoded as a whole. Results equal those of encoding whole texts. Null counts as empty.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from .kernel import mix, prefix_sums, text_chunks

# One task has one core: threads of the library would only contend.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: log2 of the slots for units; a table that is half full, or holds IDS ids, starts afresh.
SLOTS = 22
IDS = 1 << 24
#: Units encoded in one call.
UNITS = 4096
#: Units of more bytes are not kept.
LONG = 64

_ODD = np.zeros(256, bool)
_ODD[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
#: Rarer white space: its UTF-8 bytes, of three and of two, as one number.
_WIDE_LEAD = np.zeros(256, bool)
_WIDE_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_WIDE = np.array([int.from_bytes(chr(c).encode(), "big") for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])
_WIDE_TWO = np.array([int.from_bytes(chr(c).encode(), "big") for c in (0x85, 0xA0)])
#: ASCII letters and digits, and all other ASCII signs.
_ALNUM = np.array([c < 128 and chr(c).isalnum() for c in range(256)])
_SIGN = np.array([32 < c < 127 and not chr(c).isalnum() for c in range(256)])


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts to ids; one per worker process."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        (self.line_break,) = self.whole("\n").tolist()
        self._clear()

    def _clear(self) -> None:
        self.keys, self.places = np.zeros(1 << SLOTS, np.uint64), np.zeros(1 << SLOTS, np.int32)
        self.sizes, self.lengths = np.zeros(1 << SLOTS, np.uint8), np.zeros(1 << SLOTS, np.uint8)
        self.ids, self.used, self.units = np.zeros(1 << 20, np.uint32), 0, 0

    def whole(self, text: str) -> np.ndarray:
        """The ids of one text, by the library alone."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        """Each hash's slot, or -1."""
        mask = np.uint64((1 << SLOTS) - 1)
        slot = (hashes & mask).astype(np.int64)
        found = self.keys[slot]
        out = np.where(found == hashes, slot, -1)
        left = np.flatnonzero((found != hashes) & (found != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & int(mask)
            found = self.keys[slot[left]]
            hit = found == hashes[left]
            out[left[hit]] = slot[left[hit]]
            left = left[~hit & (found != 0)]
        return out

    def _add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> None:
        """New, distinct units."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used : self.used + len(ids)] = ids
        places = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        self.units += len(hashes)
        mask = (1 << SLOTS) - 1
        left, slot = np.arange(len(hashes)), (hashes & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = hashes[free]
            got = left[self.keys[slot[left]] == hashes[left]]
            self.places[slot[got]], self.sizes[slot[got]], self.lengths[slot[got]] = places[got], sizes[got], lengths[got]
            left = left[self.keys[slot[left]] != hashes[left]]
            slot[left] = (slot[left] + 1) & mask

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, leads: np.ndarray) -> bool:
        """Encode and add new units; whether the table had to be emptied first."""
        _, first = np.unique(hashes, return_index=True)
        full = self.units > 0 and (self.units + len(first) > 1 << (SLOTS - 1) or self.used + LONG * len(first) > IDS)
        if full:
            self._clear()
        raw = data.tobytes()
        for lead in (True, False):
            own = first[leads[first] == lead]
            for at in range(0, len(own), UNITS):
                part = own[at : at + UNITS]
                texts = [raw[a:b].decode() for a, b in zip(starts[part].tolist(), ends[part].tolist(), strict=True)]
                joined = " " + " ".join(texts) if lead else "\n".join(texts)
                ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
                if lead:
                    begins = np.flatnonzero(self.opens[ids])
                    sizes = np.diff(np.append(begins, len(ids)))
                else:
                    breaks = np.flatnonzero(ids == self.line_break)
                    sizes = np.diff(np.concatenate([[-1], breaks, [len(ids)]])) - 1
                    ids = ids[ids != self.line_break]
                if len(sizes) != len(part) or sizes.min() < 1:
                    every = [self.whole(" " + t if lead else t) for t in texts]
                    ids, sizes = np.concatenate(every), np.array([len(e) for e in every])
                self._add(hashes[part], ids, sizes, ends[part] - starts[part])
        return full

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows that may be cut."""
        gap = (data == 0x20) | (data == 0x0A)
        odd = _ODD[data]
        odd[1:] |= gap[1:] & gap[:-1]
        edges = np.concatenate([offsets[:-1], offsets[1:] - 1])
        edges = edges[(edges >= 0) & (edges < len(data))]
        odd[edges] |= gap[edges]
        at = np.flatnonzero(_WIDE_LEAD[data])
        at = at[at + 1 < len(data)]
        two = data[at].astype(np.int64) << 8 | data[at + 1]
        odd[at] |= np.isin(two, _WIDE_TWO)
        at, two = at[at + 2 < len(data)], two[at + 2 < len(data)]
        odd[at] |= np.isin(two << 8 | data[at + 2], _WIDE)
        raw = data.tobytes()
        for mark in self.special:
            at = raw.find(mark)
            while at >= 0:
                odd[at] = True
                at = raw.find(mark, at + 1)
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(odd, out=sums[1:])
        return sums[offsets[1:]] == sums[offsets[:-1]]

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, start, end and whether a space leads, of all units."""
        begins = np.zeros(len(data) + 1, bool)
        breaks = data == 0x0A
        begins[1:] = (data == 0x20) | breaks
        begins[:-1] |= breaks
        alnum, sign = _ALNUM[data], _SIGN[data]
        begins[1:-1] |= alnum[:-1] & sign[1:]
        begins[1:-1] |= sign[:-1] & alnum[1:] & (data[:-1] != 0x27)
        begins[offsets[:-1]] = True
        starts = np.flatnonzero(begins[: len(data)])
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
        lead = data[np.maximum(starts - 1, 0)] == 0x20
        lead &= starts != offsets[row]
        ends = np.empty(len(starts), np.int64)
        ends[:-1] = np.where(row[1:] == row[:-1], starts[1:] - lead[1:], offsets[row[:-1] + 1])
        ends[-1:] = offsets[row[-1:] + 1]
        return row, starts, ends, lead

    def encode_column(self, column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit arrays."""
        out: list[np.ndarray] = []
        for a, b, data, offsets in text_chunks(column):
            n = b - a
            plain = self._plain(data, offsets) & (np.diff(offsets) > 0)
            row, starts, ends, lead = self._units(data, offsets)
            plain[row[ends - starts > LONG]] = False
            held = plain[row]
            row, starts, ends, lead = row[held], starts[held], ends[held], lead[held]
            sums, down = prefix_sums(data)
            hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
            hashes = np.where(lead, mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), hashes)
            hashes[hashes == 0] = 1
            slots = self._slots(hashes)
            new = np.flatnonzero(slots < 0)
            if len(new):
                if self._learn(data, hashes[new], starts[new], ends[new], lead[new]):
                    # The table was emptied: what was known before has to be learned again.
                    slots = self._slots(hashes)
                    again = np.flatnonzero(slots < 0)
                    if len(again):
                        self._learn(data, hashes[again], starts[again], ends[again], lead[again])
                    slots = self._slots(hashes)
                else:
                    slots[new] = self._slots(hashes[new])
            sizes = self.sizes[slots].astype(np.int64)
            stops = np.cumsum(sizes)
            total = int(stops[-1]) if len(stops) else 0
            flat = self.ids[np.repeat(self.places[slots] - (stops - sizes), sizes) + np.arange(total)]
            # Another unit of the same hash: its row is encoded as a whole.
            plain[row[self.lengths[slots] != ends - starts]] = False
            per_row = np.zeros(n + 1, np.int64)
            np.cumsum(np.bincount(row, weights=sizes, minlength=n).astype(np.int64), out=per_row[1:])
            raw = data.tobytes() if not plain.all() else b""
            for i, (x, y, cut) in enumerate(zip(per_row[:-1].tolist(), per_row[1:].tolist(), plain.tolist(), strict=True)):
                out.append(flat[x:y] if cut else self.whole(raw[offsets[i] : offsets[i + 1]].decode()))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
