"""Tokenising by pieces: a text is cut where its tokenizer surely cuts, and each piece is encoded once.

A cut goes before white space (ASCII) that follows another ASCII character or one of two
bytes from U+00C0 on (none of which is white space), and before one of ``,.;:!?`` that
follows an ASCII letter. The pre-tokenizers of the supported files end a
pre-token at both places and look at nothing before it, so the ids of the pieces, one
after the other, are the ids of the text. Pieces are encoded by the tokenizers library.
"""

from __future__ import annotations

import os

import numpy as np

from riskloom.llm import textbytes as tb

#: Pieces that a memo holds before it starts anew; a memo only saves work.
MEMO = 1_200_000
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ",.;:!?"]] = True


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark spreads the work
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def cuts(data: np.ndarray) -> np.ndarray:
    """True where a piece begins because of the two bytes around the place; the first byte is left to the caller."""
    out = np.zeros(len(data), bool)
    space = tb.SPACES[data]
    before = ~space & (data < 0x80)
    before[1:] |= (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    out[1:] = (space[1:] & before[:-1]) | (_STOP[data[1:]] & _ASCII_LETTER[data[:-1]])
    return out


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for, and lists the new ones."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


class Memo:
    """Ids of pieces, in one flat array; survives from task to task in a reused worker."""

    _of: dict[tuple[str, str | None], Memo] = {}

    def __init__(self, path: str, joint: str | None) -> None:
        self.tokenizer, self.joint = load(path), joint
        self.joint_id = self.encode([joint])[0] if joint else []
        self.forget()

    @classmethod
    def of(cls, path: str, joint: str | None = None) -> Memo:
        """The worker's memo for one tokenizer file.

        With ``joint``, a text of one token that white space sets apart, misses are encoded many to
        a call between two joints, which is for tokenizers that drop white space.
        """
        if (path, joint) not in cls._of:
            cls._of[path, joint] = cls(path, joint)
        return cls._of[path, joint]

    def forget(self) -> None:
        self.place = _Numbers()
        self.begins, self.flat = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes], first: int) -> None:
        """Adds the ids of new pieces, whose numbers go on from ``first``."""
        joint = self.joint.encode() if self.joint and len(self.joint_id) == 1 else None
        for i in range(0, len(pieces), 256):
            part = pieces[i : i + 256]
            if joint and not any(joint in p for p in part):
                ids = np.array(self.encode([(b" " + joint + b" ").join(part).decode()])[0], np.uint32)
                apart = np.flatnonzero(ids == self.joint_id[0])
                counts = np.diff(np.concatenate([[-1], apart, [len(ids)]])) - 1
                if len(counts) == len(part):
                    self._add(first + i, np.delete(ids, apart), counts)
                    continue
            lists = self.encode([p.decode() for p in part])
            self._add(first + i, np.array([x for ids in lists for x in ids], np.uint32), np.array([len(x) for x in lists]))

    def _add(self, number: int, ids: np.ndarray, counts: np.ndarray) -> None:
        start = self.begins[number]
        while start + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while number + len(counts) >= len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
        self.flat[start : start + len(ids)] = ids
        self.begins[number + 1 : number + 1 + len(counts)] = start + np.cumsum(counts)

    def indices(self, pieces: list[bytes]) -> np.ndarray:
        """The number of each piece in the memo; misses are encoded first."""
        if len(self.place) > MEMO:
            self.forget()
        first, new = len(self.place), self.place.new
        found = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        self._learn(new, first)
        new.clear()
        return found

    def ids(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in a row, and how many each has."""
        counts = self.begins[index + 1] - self.begins[index]
        before = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(self.begins[index] - before[:-1], counts) + np.arange(before[-1])
        return self.flat[at], counts
