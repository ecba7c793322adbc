"""Encode texts through their pre-tokens: each distinct one is encoded once and then looked up."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import regex


class PreTokenEncoder:
    """``texts -> bytes of ids`` (little-endian unsigned 32-bit), by ``encode_many`` for new pre-tokens.

    The table of known pre-tokens is emptied when it exceeds ``bound``, so a
    worker's memory does not follow the vocabulary of the corpus.
    """

    def __init__(self, pattern: str, encode_many: Callable[[list[str]], list[bytes]], bound: int = 500_000):
        self._match = regex.compile(pattern).findall
        self._encode_many = encode_many
        self._bound = bound
        self._known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self._known) > self._bound:
            self._known.clear()
        cut = list(map(self._match, texts))
        new = list(set().union(*cut).difference(self._known))
        self._known.update(zip(new, self._encode_many(new)))
        get = self._known.__getitem__
        return [b"".join(map(get, tokens)) for tokens in cut]


def slabs(items: Iterable[tuple], size: Callable[[tuple], int], bound: int) -> Iterator[list[tuple]]:
    """Runs of items whose sizes add up to about ``bound``; an item is never cut."""
    run, total = [], 0
    for x in items:
        run.append(x)
        total += size(x)
        if total >= bound:
            yield run
            run, total = [], 0
    if run:
        yield run
