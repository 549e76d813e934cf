"""Many texts as one array of code points, with words and n-grams hashed by array operations."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
#: Odd multipliers of the polynomial and of the final mixing (fixed values).
BASE, MIX1, MIX2 = 0x9E3779B97F4A7C15 | 1, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
#: ASCII white space as the contracts have it: space, and tab to carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = h ^ (h >> U(33))
    h *= U(MIX1)
    h ^= h >> U(29)
    h *= U(MIX2)
    h ^= h >> U(32)
    return h


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for b in (BASE, inverse):
        p = np.full(n, b, U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of BASE and of its inverse; sizes are rounded up so that few tables are made."""
    size = 1 << max(18, int(n - 1).bit_length())
    return _powers(size)


#: No letter or digit has a code point from here on (a test holds this against the interpreter's tables).
TOP = 0x40000


@lru_cache(1)
def lower_table() -> np.ndarray:
    """For each code point below TOP its lower case, where that is one code point."""
    out = np.arange(TOP, dtype=np.uint32)
    for c in range(TOP):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


@lru_cache(1)
def alnum_table() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(TOP)), bool, TOP)


@lru_cache(1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(TOP)), bool, TOP)


def look(tab: np.ndarray, cp: np.ndarray) -> np.ndarray:
    """Look code points up; those beyond the table count as its last, which is no character."""
    return tab[np.minimum(cp, np.uint32(len(tab) - 1))]


def lowered(cp: np.ndarray) -> np.ndarray:
    """Code points in lower case; those beyond the table as they are."""
    return np.where(cp < TOP, look(lower_table(), cp), cp)


class Flat:
    """Texts joined by newlines: ``cp`` the code points, ``at``/``to`` where each text begins and ends."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        self.cp = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        lens = np.fromiter(map(len, texts), np.int64, self.n)
        self.to = np.cumsum(lens + 1) - 1
        self.at = self.to - lens
        self.lens = lens

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.to, position, "right") if self.n else np.zeros(len(position), np.int64)

    def prefix(self, cp: np.ndarray | None = None) -> np.ndarray:
        """Prefix sums of the polynomial hash of mixed code points."""
        c = mix((self.cp if cp is None else cp).astype(U) + U(1))
        c *= powers(len(c) + 1)[0][: len(c)]
        out = np.empty(len(c) + 1, U)
        out[0] = 0
        np.cumsum(c, out=out[1:])
        return out

    @staticmethod
    def spans(prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """64-bit hashes of the substrings [a, b)."""
        h = prefix[b] - prefix[a]
        h *= powers(len(prefix))[1][a]
        h += (b - a).astype(U)
        return mix(h)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of the maximal runs of True."""
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        return edge[::2], edge[1::2]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of the words between ASCII white space."""
        tab = np.ones(128, bool)
        tab[list(SPACES)] = False
        return self.runs((self.cp >= 128) | tab[np.minimum(self.cp, np.uint32(127))])


def counts(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(doc, weights, minlength=n) if n else np.zeros(0)


#: Multipliers that join the hashes of the words in a window (fixed values).
JOIN = [U(x | 1) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)]


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the windows of ``k`` neighbours (k at most 5) in a sequence of hashes."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, U)
    for j in range(k):
        out += h[j : j + n] * JOIN[j]
    return mix(out)
