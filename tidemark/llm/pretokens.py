"""Pre-tokens of the byte-level pattern as numpy arrays.

The pattern, fixed by the vocabulary:
's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .batches import buffers

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = 1, 2, 3, 4, 0
#: Fixed by the pattern: what an apostrophe may begin.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


class Classes:
    """Class of each code point as the tokenizer itself sees it, asked when one first occurs."""

    def __init__(self, split):
        self.split = split  # text to a list of (piece, (start, end))
        self.table = np.zeros(0x110000, np.uint8)

    def of(self, points: np.ndarray) -> np.ndarray:
        classes = self.table[points]
        if not classes.all():
            for point in np.unique(points[classes == UNKNOWN]).tolist():
                self.table[point] = self.ask(chr(point))
            classes = self.table[points]
        return classes

    def ask(self, char: str) -> int:
        if len(self.split(f"a{char}")) == 1:
            return LETTER
        if len(self.split(f"1{char}")) == 1:
            return NUMBER
        # After a sign another one joins it, white space does not.
        return OTHER if len(self.split(f"!{char}")) == 1 else SPACE


class Pretokens:
    """Pre-tokens of a column's texts: bytes, where they start and end, and their rows.

    An occurrence of a special token's string is a pre-token of its own.
    """

    def __init__(self, column: pa.Array, classes: Classes, special: list[str]):
        offsets, raw = buffers(column)
        whole = raw.tobytes()
        try:
            text = whole.decode("utf-8")
        except UnicodeDecodeError:  # not text: what Python makes of it
            fixed = [bytes(raw[a:b]).decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            offsets, raw = buffers(pa.array(fixed, pa.large_string()))
            text = raw.tobytes().decode("utf-8")
        self.raw, self.offsets = raw, offsets
        at_byte = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        n = len(points)
        edges = np.searchsorted(at_byte, offsets)
        first = np.zeros(n + 1, bool)  # starts of texts and of what follows a special token
        first[edges] = True
        inside_special = np.zeros(n, bool)
        for token in special:
            at = text.find(token)
            while at >= 0:
                if not first[at + 1 : at + len(token)].any() and not inside_special[at]:
                    first[[at, at + len(token)]] = True
                    inside_special[at + 1 : at + len(token)] = True
                at = text.find(token, at + 1)

        kind = classes.of(points)
        blank = kind == SPACE
        before = np.concatenate([[0], kind[:-1]]) if n else kind
        opens = (kind != before) | first[:n]
        # A single space goes with what follows it, unless a text ends between.
        plain = np.zeros(n, bool)
        plain[:-1] = (points[:-1] == 0x20) & ~blank[1:] & ~first[1:n]
        last_blank = np.zeros(n, bool)
        last_blank[:-1] = blank[:-1] & ~blank[1:] & ~first[1:n]
        starts = (opens & ~np.concatenate([[False], plain[:-1]])[:n]) | plain | last_blank
        starts |= first[:n]
        # Apostrophes that begin an ending.
        quote = np.flatnonzero((points == 0x27) & starts & opens)
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == LETTER) & ~first[quote + 1]]
        for at in quote.tolist():
            for ending in ENDINGS:
                stop = at + 1 + len(ending)
                if text[at + 1 : stop] == ending and not first[at + 1 : stop].any():
                    starts[at + 1] = False
                    if stop < n:
                        starts[stop] = True
                    break
        starts[inside_special] = False
        begin = np.flatnonzero(starts)
        self.starts = at_byte[begin]
        self.ends = at_byte[np.append(begin[1:], n)] if len(begin) else at_byte[:0]
        self.bounds = np.searchsorted(begin, edges)
        self.rows = len(column)
