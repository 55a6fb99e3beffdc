"""What an encoder made of a word, kept for the next time it occurs in a task."""

from __future__ import annotations

from collections.abc import Callable

#: Bytes of each of the two generations of a task's cache, and the longest word that is kept.
GENERATION = 48 << 20
LONGEST = 64
#: What Python needs for an entry besides its word and ids: two objects and their place in the table.
ENTRY = 200


class WordCache:
    """Two generations: when the young one is full it becomes the old one, and what is used again moves over.

    Memory is bounded by the parameters, whatever the texts, and given back by ``clear``.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = GENERATION, longest: int = LONGEST):
        self.encode, self.most, self.longest = encode, most, longest
        self.clear()

    def clear(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def all(self, words: list[str]) -> list[bytes]:
        found = list(map(self.young.get, words))
        if None in found:
            missing = {w for w, x in zip(words, found) if x is None}
            now = {w: self.old[w] for w in missing if w in self.old}
            new = [w for w in missing if w not in now]
            now.update(zip(new, self.encode(new)))
            found = [now[w] if x is None else x for w, x in zip(words, found)]
            if self.size > self.most:
                self.old, self.young, self.size = self.young, {}, 0
            kept = {w: x for w, x in now.items() if len(w) <= self.longest}
            self.size += sum(len(w) + len(x) + ENTRY for w, x in kept.items())
            self.young.update(kept)
        return found
