"""Texts as flat arrays of letters and words, for the operators that score characters."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from flowledger.llm.common import code_points

CODES = 0x110000


@lru_cache(maxsize=1)
def lower_letters() -> np.ndarray:
    """Code point → its lower-case letter; 0 for what is no letter."""
    table = np.zeros(CODES, np.uint32)
    for code in range(CODES):
        letter = chr(code)
        if letter.isalpha():
            small = letter.lower()
            table[code] = ord(small) if len(small) == 1 else code
    return table


@dataclass
class Words:
    """Words (longest runs of letters) of many texts in one array."""

    letters: np.ndarray  # lower-case letter or 0 for every code point of all texts, a 0 between and around the texts
    starts: np.ndarray  # of every word, in ``letters``
    ends: np.ndarray
    doc: np.ndarray  # number of the text of every word
    doc_starts: np.ndarray  # of every text, in ``letters``

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        letters = lower_letters()[code_points("\n" + "\n".join(texts) + "\n")]
        edges = np.diff((letters > 0).view(np.int8))
        starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
        doc_starts = np.cumsum([1, *[len(text) + 1 for text in texts]])[:-1]
        return cls(letters, starts, ends, np.searchsorted(doc_starts, starts, "right") - 1, doc_starts)

    @property
    def sizes(self) -> np.ndarray:
        return self.ends - self.starts
