"""Results kept by word in a Python worker, bounded by bytes."""

from __future__ import annotations

from collections.abc import Mapping

#: About so many bytes are held a memory; a fuller one starts anew, which changes no result.
MEMORY_BYTES = 120 << 20
#: Longer words are worked out each time.
LONGEST_KEPT = 64

_ENTRY = 210  # a dictionary slot and the heads of a string and a bytes object


class ByteMemory:
    """Words with the bytes worked out for them."""

    def __init__(self, limit: int = MEMORY_BYTES):
        self.limit, self.held = limit, 0
        self.known: dict[str, bytes] = {}

    def keep(self, found: Mapping[str, bytes]) -> None:
        """Adds short words; ``known`` may be a new dictionary afterwards."""
        short = found
        if found and max(map(len, found)) > LONGEST_KEPT:
            short = {w: x for w, x in found.items() if len(w) <= LONGEST_KEPT}
        signs = "".join(short)
        size = _ENTRY * len(short) + (1 if signs.isascii() else 4) * len(signs) + sum(map(len, short.values()))
        if size > self.limit:
            return
        if self.held + size > self.limit:
            self.known, self.held = {}, 0
        self.known.update(short)
        self.held += size


class AgingMemory(ByteMemory):
    """Two halves of the bytes: what fills up becomes the older half, and words asked for again come back from there."""

    def __init__(self, limit: int = MEMORY_BYTES):
        super().__init__(limit // 2)
        self.older: dict[str, bytes] = {}

    def keep(self, found: Mapping[str, bytes]) -> None:
        before = self.known
        super().keep(found)
        if self.known is not before:
            self.older = before

    def recall(self, words: set[str]) -> dict[str, bytes]:
        """Those of the words that either half holds."""
        return {w: half[w] for half in (self.older, self.known) for w in words & half.keys()}
