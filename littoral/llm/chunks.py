"""Texts cut at spaces into chunks that tokenize on their own, and a bounded memory of what keys become.

With the public byte-level pattern no match holds white space after its first
character, so a single space between two other characters always starts a new
match. Cutting there changes no result; text with other white space next to a
space is cut by a slower, equivalent search.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from itertools import islice

CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[int, str]:
    """The characters by which byte-level vocabularies write bytes: printable ones themselves, the others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Memo:
    """``key -> value``, missing values made in bulk.

    Keys of up to ``LONGEST`` characters or bytes are remembered, ``limit`` of
    them at most; longer ones are made again each time. So memory is bounded
    whatever the texts are. At the limit the later half is forgotten: what came
    first is mostly what comes often.
    """

    LONGEST = 48

    def __init__(self, make: Callable[[list], Iterable], limit: int):
        self.make, self.limit, self.known, self.passing = make, limit, {}, []

    def want(self, keys: set) -> dict:
        """A dict that holds all of ``keys`` until the next call."""
        known = self.known
        for k in self.passing:
            known.pop(k, None)
        missing = list(keys.difference(known))
        if len(known) + len(missing) > self.limit and known:
            self.known = known = dict(islice(known.items(), self.limit // 2))
            missing = list(keys.difference(known))
        known.update(zip(missing, self.make(missing)))
        # More than the limit are held while they are wanted, not longer.
        over = max(0, len(known) - self.limit)
        self.passing = missing[len(missing) - over :] + [k for k in missing[: len(missing) - over] if len(k) > self.LONGEST]
        return known
