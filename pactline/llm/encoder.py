"""Byte-level BPE of whole texts with the tokenizers library, each chunk once.

A text falls into chunks at every place where white space follows another
character. The pattern that cuts byte-level BPE texts into pieces always cuts
there and never looks back, so a chunk's ids do not depend on its neighbours.
Each different chunk goes through the library once per worker; its ids are
found again by a 128-bit hash, and memory is bounded. Texts with white space
outside ASCII, or whose hashes meet, are encoded as a whole. New chunks are put
together for the library as a text would hold them, and their ids are cut apart
by the bytes they stand for, as a call for each chunk costs as much as its ids.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from pactline.llm.words import SPACE, Slice, span_hashes

# Bytes of chunks' hashes and ids a worker remembers; it starts anew beyond that.
REMEMBERED = 32 << 20
# Chunks that go through the library as one text.
JOINED = 256
# White space that is not ASCII's six, as Unicode has it.
_WIDE_SPACE = re.compile(
    "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
_NOT_PLAIN = np.zeros(256, dtype=bool)
_NOT_PLAIN[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def wide_spaced(part: Slice) -> list[int]:
    """Rows of a slice with white space outside ASCII."""
    found = np.flatnonzero(_NOT_PLAIN[part.data])
    rows = np.unique(np.searchsorted(part.offsets, found, side="right") - 1).tolist()
    texts = (part.data[part.offsets[r] : part.offsets[r + 1]].tobytes().decode() for r in rows)
    return [r for r, text in zip(rows, texts, strict=True) if _WIDE_SPACE.search(text)]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        # A character of a byte-level token is one byte.
        self.widths = np.array([len(name or "") for name in names], dtype=np.int64)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.proofs = np.zeros(0, dtype=np.uint64)
        self.places = np.zeros(0, dtype=np.int64)
        self.begins = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint16)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [
            e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum()))
        return counts, flat

    def _encode_chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunks' order here, ids of each and all ids: first those that can stand in a row.

        They begin with white space and end without, so the text of several is
        cut where they meet.
        """
        fits = np.fromiter(
            (t[0] in " \t\n\r\v\f" and not t[-1].isspace() for t in texts), bool, len(texts)
        )
        order = np.argsort(~fits, kind="stable")
        row = [texts[i] for i in order[: fits.sum()].tolist()]
        parts = ["".join(row[i : i + JOINED]) for i in range(0, len(row), JOINED)]
        _, flat = self._encode(parts)
        ends = np.cumsum(np.fromiter((len(t.encode()) for t in row), np.int64, len(row)))
        bytes_upto = np.cumsum(self.widths[flat])
        cuts = np.searchsorted(bytes_upto, ends) + 1
        if len(row) and (cuts[-1] != len(flat) or not np.array_equal(bytes_upto[cuts - 1], ends)):
            counts, flat = self._encode(row)  # not a byte-level vocabulary
        else:
            counts = np.diff(cuts, prepend=0)
        more, rest = self._encode([texts[i] for i in order[len(row) :].tolist()])
        return order, np.concatenate([counts, more]), np.concatenate([flat, rest])

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.keys, self.proofs, self.places, self.begins, self.ids))

    def _learn(self, keys: np.ndarray, proofs: np.ndarray, texts: list[str]) -> None:
        if self.nbytes > REMEMBERED:
            self._forget()
        order, counts, flat = self._encode_chunks(texts)
        if self.ids.dtype == np.uint16 and len(flat) and flat.max() >= 1 << 16:
            self.ids = self.ids.astype(np.uint32)
        at = np.searchsorted(self.keys, keys)
        places = np.empty(len(keys), dtype=np.int64)
        places[order] = np.arange(len(keys)) + len(self.begins) - 1
        self.keys = np.insert(self.keys, at, keys)
        self.proofs = np.insert(self.proofs, at, proofs)
        self.places = np.insert(self.places, at, places)
        self.begins = np.append(self.begins, self.begins[-1] + np.cumsum(counts))
        self.ids = np.append(self.ids, flat.astype(self.ids.dtype))

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), dtype=bool)
        return at, known

    def encode(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice in order (uint32), and how many each row has."""
        rows = part.last - part.first
        data = part.data
        if not len(data):
            return np.zeros(0, dtype=np.uint32), np.zeros(rows, dtype=np.int64)
        space = SPACE[data]
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[1:-1] = space[1:] & ~space[:-1]
        begins[part.offsets] = True
        starts = np.flatnonzero(begins[:-1])
        ends = np.append(starts[1:], len(data))
        row = np.searchsorted(part.offsets, starts, side="right") - 1
        keys = span_hashes(data, starts, ends)
        proofs = span_hashes(data, starts, ends, lane=1)
        whole = np.zeros(rows, dtype=bool)
        whole[wide_spaced(part)] = True

        distinct, sample, which = np.unique(keys, return_index=True, return_inverse=True)
        _, known = self._find(distinct)
        new = sample[~known]
        if len(new):
            spans = zip(starts[new].tolist(), ends[new].tolist(), strict=True)
            buffer = data.tobytes()
            self._learn(keys[new], proofs[new], [buffer[a:b].decode() for a, b in spans])
            at, known = self._find(distinct)
            if not known.all():  # memory was cleared: learn the whole slice
                spans = zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)
                self._forget()
                self._learn(distinct, proofs[sample], [buffer[a:b].decode() for a, b in spans])
        at, _ = self._find(distinct)
        met = self.proofs[at][which] != proofs
        whole[row[met]] = True

        place = self.places[at][which]
        first, last = self.begins[place], self.begins[place + 1]
        keep = ~whole[row]
        first, sizes, row = first[keep], (last - first)[keep], row[keep]
        counts = np.bincount(row, weights=sizes, minlength=rows).astype(np.int64)
        ahead = np.cumsum(sizes) - sizes
        ids = self.ids[np.repeat(first - ahead, sizes) + np.arange(int(sizes.sum()))]
        ids = ids.astype(np.uint32)
        if not whole.any():
            return ids, counts
        pieces = np.split(ids, np.cumsum(counts)[:-1])
        for r in np.flatnonzero(whole):
            text = data[part.offsets[r] : part.offsets[r + 1]].tobytes().decode()
            _, pieces[r] = self._encode([text])
            counts[r] = len(pieces[r])
        return np.concatenate(pieces), counts
