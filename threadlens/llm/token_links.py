"""Two tokenizers over the same bytes: which tokens overlap.

A byte-level BPE (A, a ``tokenizers`` JSON file) and a sentencepiece model (B)
encode a blank and the text.  Token ends in bytes are two sorted lists; where
both have an end a group ends, and between two neighbouring ends of either
exactly one A and one B token overlap.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np

from threadlens.llm.units import UNITS_KEPT, sliced_units

BLANK = "▁"

#: Units that are encoded and aligned together.
AT_ONCE = 150_000


def byte_characters() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others for U+0100 onwards (a fixed rule)."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def ranks_of(tokenizer_json: str) -> dict[bytes, int]:
    """Token bytes -> id of a byte-level BPE file without normalizer whose i-th
    merge makes the token of id 256 + i, so that ids order the merges."""
    spec = json.loads(tokenizer_json)
    model, special = spec["model"], {t["content"] for t in spec["added_tokens"] if t["special"]}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    in_order = all(model["vocab"].get(x + y) == 256 + i for i, (x, y) in enumerate(pairs))
    if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or not in_order:
        raise ValueError("not a plain byte-level BPE whose ids follow its merges")
    byte = byte_characters()
    return {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}


class Links:
    """Tokens, groups and links of units, each unit aligned once and kept.

    A unit whose joined bytes of either side differ from its own is invalid, as
    is a text that holds one."""

    def __init__(self, tokenizer_json: str, pattern: str, model: bytes, groups: bool, kept: int = UNITS_KEPT):
        import sentencepiece
        import tiktoken
        ranks = ranks_of(tokenizer_json)
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.len_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.len_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.blank = [self.b.piece_to_id(BLANK)]
        # a blank mark after another character in a piece could join two units
        self.separable = not any(BLANK in p.lstrip(BLANK) for i, p in enumerate(pieces) if not self.b.is_byte(i))
        self.width = n
        self.groups, self.kept = groups, kept
        if groups:
            self.shown = [f"{i}{sep}" for sep, many in ((",", len(self.bytes_a)), ("|", len(self.bytes_a)),
                                                        (",", n), (";", n)) for i in range(many)]
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.valid = np.empty(0, bool)
        self.sizes = np.empty((4, 0), np.int64)  # A tokens, B tokens, groups, links
        self.keys = np.empty(0, np.uint64)       # of all units' links, in a row
        self.shape: list[str] = []               # their groups, as text

    def split(self, text: str) -> Iterator[list[str]]:
        return sliced_units(text, led=True) if self.separable else iter([[" " + text]])

    def _encode_a(self, new: list[str]) -> tuple[list[int], np.ndarray]:
        """Ids of all units in a row, and each unit's number of them."""
        ends = np.cumsum([len(u.encode()) for u in new])
        ids, at, start = [], [], 0
        while start < len(new):  # units before one that ends in white space can be encoded as one text
            stop = start + 1
            while stop < len(new) and not new[stop - 1][-1].isspace():
                stop += 1
            ids += self.a.encode_ordinary("".join(new[start:stop]))
            start = stop
        at = np.searchsorted(np.cumsum(self.len_a[np.array(ids, np.int64)]), ends, "right")
        return ids, np.diff(at, prepend=0)

    def _encode_b(self, new: list[str]) -> tuple[list[int], np.ndarray]:
        each = self.b.encode([u[1:] for u in new], num_threads=1)
        each = [self.blank if u == " " else ids for u, ids in zip(new, each)]
        return list(chain.from_iterable(each)), np.array(list(map(len, each)), np.int64)

    def unknown(self, units: Iterable[str]) -> list[str]:
        return [u for u in dict.fromkeys(units) if u not in self.index]

    def full(self, new: list[str]) -> bool:
        return bool(self.index) and len(self.index) + len(new) > self.kept

    def learn(self, new: list[str]) -> np.ndarray:
        """Align units not yet known; the new links' keys."""
        before = len(self.keys)
        for at in range(0, len(new), AT_ONCE):
            self._learn(new[at:at + AT_ONCE])
        return self.keys[before:]

    def _learn(self, new: list[str]) -> None:
        (a, n_a), (b, n_b) = self._encode_a(new), self._encode_b(new)
        whole = "".join(new).encode()
        good = np.ones(len(new), bool)
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            good = np.array([self._exact(u) for u in new])
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.valid = np.concatenate([self.valid, good])
        if not good.all():
            a, b = np.array(a, np.int64)[np.repeat(good, n_a)], np.array(b, np.int64)[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        self._align(np.array(a, np.int64), np.array(b, np.int64), n_a, n_b)

    def _exact(self, unit: str) -> bool:
        own, a, b = unit.encode(), self._encode_a([unit])[0], self._encode_b([unit])[0]
        return b"".join(map(self.bytes_a.__getitem__, a)) == own == b"".join(map(self.bytes_b.__getitem__, b))

    def _align(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        unit_end = np.concatenate([[0], end_a])[np.cumsum(n_a)]
        both = end_a[np.isin(end_a, end_b, assume_unique=True)]
        ends = np.union1d(end_a, end_b)
        per_unit = [np.diff(np.searchsorted(x, unit_end, "right"), prepend=0) for x in (both, ends)]
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, *per_unit])], 1)
        keys = a[np.searchsorted(end_a, ends)].astype(np.uint64) * np.uint64(self.width)
        self.keys = np.concatenate([self.keys, keys + b[np.searchsorted(end_b, ends)].astype(np.uint64)])
        if self.groups:
            self.shape += self._shapes(a, b, n_a, n_b, end_a, end_b, both)

    def _shapes(self, a, b, n_a, n_b, end_a, end_b, both) -> list[str]:
        """Each unit's groups as text, every group closed by a semicolon."""
        in_a, in_b, width = np.searchsorted(both, end_a), np.searchsorted(both, end_b), len(self.bytes_a)
        last_a, last_b = both[in_a] == end_a, both[in_b] == end_b
        order = np.argsort(np.concatenate([2 * in_a, 2 * in_b + 1]), kind="stable")
        signs = np.concatenate([a + width * last_a, 2 * width + b + self.width * last_b])[order]
        text, cuts = list(map(self.shown.__getitem__, signs.tolist())), np.cumsum(n_a + n_b).tolist()
        return ["".join(text[i:j]) for i, j in zip([0, *cuts], cuts)]

    def numbers(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))
