"""Quality rules: plain counts of each text, and repetition inside it from a suffix array of its words.

A slab of texts becomes one sequence of word codes; equal words of different
texts have different codes, so nothing matches across texts. Its suffix array is
made by prefix doubling, where only groups that are still open are sorted again. The ranks of
every round are kept: two suffixes share their first ``2**k`` words if they have equal
ranks of round k, so common prefixes are found by descending the rounds.

A longest-common-prefix interval is a range of the suffix array whose suffixes share a
prefix of ``l`` words, with shorter ones at both ends: a repeated substring that cannot be extended to the
right. It is maximal if its places do not all have the same word before them. The spans of the maximal
repeats of at least ``min_words`` words are united; a text fails if they cover more
than ``max_percent`` of its words, or if one is longer than ``max_repeat`` words. (The
union needs each suffix's innermost interval alone: where that is not maximal, the
suffix before it has a longer one, whose span holds it.)

The 3-word windows of the base rule are the same array's common prefixes of three words and more.

Defined results: a null text has no words; such texts and others under ``min_total``
words fail the base rule. Ties, repeated rows, and null or repeated ids are of no
account, since every row is judged by its text alone. A text longer than a slab is a slab of its
own, so memory follows the longest text. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from netsift.llm.common import columns_as
from netsift.llm.pretokens import slabs

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
WINDOW = 3
SLAB = 2 << 20


@dataclass(frozen=True)
class Rules:
    """``min_total``, ``max_window_percent``: the base rule. The others bound what maximal repeats cover."""

    min_total: int = 50
    max_window_percent: int = 50
    min_words: int = 8
    max_percent: int = 40
    max_repeat: int = 200


def suffix_array(code: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of a sequence of codes, and each round's ranks: equal in round k where the first ``2**k`` codes are.

    Past the end stands a code of its own, smaller than all.
    """
    n = len(code)
    sa = np.argsort(code, kind="stable")
    heads = np.r_[True, code[sa][1:] != code[sa][:-1]] if n else np.zeros(0, bool)
    place = np.arange(n, dtype=np.int32)
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(heads, place, 0))
    rounds, depth = [rank], 1
    while True:
        open_ = np.flatnonzero(~(heads & np.r_[heads[1:], True])) if n else np.zeros(0, np.int64)
        if not len(open_):
            return sa, rounds
        at = sa[open_]
        further = at + depth
        behind = np.where(further < n, rank[np.minimum(further, n - 1)] + 1, 0)
        key = rank[at].astype(np.int64) * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        key = key[order]
        sa[open_] = at[order]
        heads[open_] = np.r_[True, key[1:] != key[:-1]]
        rank = rank.copy()
        rank[sa[open_]] = np.maximum.accumulate(np.where(heads[open_], open_, 0))
        rounds.append(rank)
        depth *= 2


def common_prefixes(sa: np.ndarray, rounds: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the one before it in the array (0 for the first)."""
    n = len(sa)
    lcp = np.zeros(n, np.int32)
    if n < 2:
        return lcp
    a, b = sa[:-1].astype(np.int64), sa[1:].astype(np.int64)
    live = np.flatnonzero(rounds[0][a] == rounds[0][b])
    a, b, length = a[live], b[live], np.zeros(len(live), np.int32)
    for k in range(len(rounds) - 1, -1, -1):
        x, y = a + length, b + length
        inside = np.maximum(x, y) < n
        same = inside & (rounds[k][np.minimum(x, n - 1)] == rounds[k][np.minimum(y, n - 1)])
        length[same] += 1 << k
    lcp[live + 1] = length
    return lcp


def maximal_repeats(code: np.ndarray, sa: np.ndarray, lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``place, words, times`` of every maximal repeated substring of at least ``least`` codes.

    One pass over the runs of the array with such prefixes, with a stack of open intervals. An
    interval is left-maximal if the codes before its places differ.
    """
    big = np.flatnonzero(lcp >= least)
    before = np.where(sa > 0, code[np.maximum(sa - 1, 0)], -1)
    out = []
    cuts = np.flatnonzero(np.diff(big) > 1) + 1
    for run in np.split(big, cuts) if len(big) else []:
        # suffixes run[0] - 1 .. run[-1]; an open interval: [prefix, first place in the array, word before or None where they differ]
        first = int(run[0]) - 1
        word = before[first : int(run[-1]) + 1].tolist()
        stack: list[list] = []
        for j, l in enumerate([*lcp[run].tolist(), 0]):
            lo, left = j, word[j]
            while stack and stack[-1][0] > l:
                length, lo, mixed = stack.pop()
                left = mixed if mixed == left else None
                if left is None or left < 0:
                    out.append((first + lo, length, j - lo + 1))
            if stack and stack[-1][0] == l:
                if stack[-1][2] != left:
                    stack[-1][2] = None
            elif l:
                stack.append([l, lo, left])
    found = np.array(out, np.int64).reshape(-1, 3)
    return sa[found[:, 0]], found[:, 1], found[:, 2]


def covered(n: int, place: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in the union of spans."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, place, 1)
    np.add.at(step, place + words, -1)
    return np.cumsum(step[:-1]) > 0


def measure(texts: list[str], rules: Rules) -> dict[str, np.ndarray]:
    """The counts of every text of a slab."""
    words = [_WORD.findall(t) for t in texts]
    size = np.array([len(w) for w in words], np.int64)
    code = np.empty(int(size.sum()), np.int64)
    base = at = 0
    for w in words:
        known: dict[str, int] = {}
        code[at : at + len(w)] = [known.setdefault(x, len(known)) for x in w]
        code[at : at + len(w)] += base
        base, at = base + len(known), at + len(w)
    n = len(code)
    sa, rounds = suffix_array(code)
    lcp = common_prefixes(sa, rounds)
    del rounds
    own = np.maximum(lcp, np.r_[lcp[1:], 0]) if n else lcp  # the innermost interval of each suffix
    start = np.cumsum(size) - size
    of = np.repeat(np.arange(len(texts)), size)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.bincount(of[flags], minlength=len(texts))

    window = np.flatnonzero(own >= WINDOW)
    n_repeat = per_text(covered(n, sa[window], np.full(len(window), WINDOW)))
    wide = np.flatnonzero(own >= rules.min_words)
    n_covered = per_text(covered(n, sa[wide], own[wide]))
    place, length, _ = maximal_repeats(code, sa, lcp, rules.min_words)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, of[place], length)
    lines = [[x for x in t.split("\n") if _WORD.search(x)] for t in texts]
    base_failed = (size < rules.min_total) | (100 * n_repeat > rules.max_window_percent * size)
    repeats = (100 * n_covered > rules.max_percent * size) | (longest > rules.max_repeat)
    return {
        "n_words": size,
        "word_chars": np.array([sum(map(len, w)) for w in words], np.int64),
        "n_symbols": np.array([len(_SYMBOLS.findall(t)) for t in texts], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": n_repeat,
        "base_failed": base_failed,
        "kept": ~base_failed & ~repeats,
        "n_covered_words": n_covered,
        "longest_repeat": longest,
        "n_maximal_repeats": np.bincount(of[place], minlength=len(texts)),
    }


_TYPES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, n_covered_words bigint, longest_repeat bigint, n_maximal_repeats bigint"


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Per row: its id, the counts, ``base_failed``, ``kept``, and what maximal repeats cover."""
    rows = columns_as(docs, id=id_col, text=text_col)
    shape = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(range(batch.num_rows), batch.column("text"))
            for slab in slabs(texts, lambda x: len(x[1].as_buffer() or b""), SLAB):
                found = measure([t.as_py() or "" for _, t in slab], rules)
                ids = batch.column("id").slice(slab[0][0], len(slab))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(v) for v in found.values()]], ["id", *found])

    out = rows.mapInArrow(run, f"id {shape}, {_TYPES}")
    return out.withColumnRenamed("id", id_col)


def repeats_of(text: str, rules: Rules = Rules()) -> pd.DataFrame:
    """The maximal repeats of one text: ``repeat, words, times``."""
    words = _WORD.findall(text)
    code = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64) if words else np.zeros(0, np.int64)
    sa, rounds = suffix_array(code)
    place, length, times = maximal_repeats(code, sa, common_prefixes(sa, rounds), rules.min_words)
    return pd.DataFrame({"repeat": [" ".join(words[p : p + l]) for p, l in zip(place, length)], "words": length, "times": times})
