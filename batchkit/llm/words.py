"""Words of a text as numbers, remembered by each worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Codes(dict):
    """Code of a word, computed once for the words met first; later ones are computed each time."""

    def __init__(self, code: Callable[[str], int], limit: int = 250_000):
        self.code, self.limit = code, limit

    def __missing__(self, word: str) -> int:
        code = self.code(word)
        if len(self) < self.limit and len(word) < 50:
            self[word] = code
        return code

    def of(self, text: str, kind: type = np.int64) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), kind, len(words))
