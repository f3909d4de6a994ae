"""Name similarity.

``token_sort_ratio`` needs the longest common subsequence of two strings, which
no Spark built-in offers.  The kernel below runs on Arrow batches: all pairs of
a batch advance together, one character of the left string per step, with the
bit-parallel recurrence on 64-bit words (strings up to 62 characters, masks once
per distinct right string) and on Python integers beyond.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.functions.text import token_key
from gazetta.functions.values import as_col

# The kernels travel with their tasks: workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WORD = 62
#: Masks (distinct right strings times characters) that a batch may hold; beyond it is halved.
_MASKS = 1 << 21


def _codepoints(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    lengths = texts.str.len().to_numpy(dtype=np.int64)
    width = max(int(lengths.max()), 1)
    table = np.array(texts.to_list(), dtype=f"U{width}")
    return table.view(np.uint32).reshape(len(texts), width), lengths


def _lcs_words(left: pd.Series, right: pd.Series) -> np.ndarray:
    a, a_len = _codepoints(left)
    code, distinct = pd.factorize(right)
    b, b_len = _codepoints(pd.Series(distinct))
    chars, own = np.unique(b, return_inverse=True)
    if len(distinct) * (len(chars) + 1) > _MASKS and len(left) > 1:
        half = len(left) // 2
        return np.concatenate([_lcs_words(left[:half], right[:half]), _lcs_words(left[half:], right[half:])])
    # places of every character in every distinct right string; the last column is that of characters it has not
    masks = np.zeros((len(distinct), len(chars) + 1), np.uint64)
    own = own.reshape(b.shape)
    for j in range(b.shape[1]):
        inside = np.flatnonzero(j < b_len)
        masks[inside, own[inside, j]] |= np.uint64(1) << np.uint64(j)
    place = np.minimum(np.searchsorted(chars, a), len(chars) - 1)
    known = (chars[place] == a) & (np.arange(a.shape[1])[None, :] < a_len[:, None])
    at = np.where(known, place, len(chars)) + code[:, None] * masks.shape[1]
    masks, at = masks.ravel(), np.ascontiguousarray(at.T)
    full = ((np.uint64(1) << b_len.astype(np.uint64)) - np.uint64(1))[code]
    state = full.copy()
    for j in range(a.shape[1]):
        hits = state & masks[at[j]]
        state = ((state + hits) | (state - hits)) & full
    return b_len[code] - np.bitwise_count(state).astype(np.int64)


def _lcs_long(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for ch in b:
        hits = state & masks.get(ch, 0)
        state = ((state + hits) | (state - hits)) & full
    return len(a) - state.bit_count()


def lcs_lengths(left: pd.Series, right: pd.Series) -> np.ndarray:
    """LCS length of every pair of a batch."""
    out = np.zeros(len(left), dtype=np.int64)
    if not len(left):
        return out
    left, right = left.reset_index(drop=True), right.reset_index(drop=True)
    short = (left.str.len().to_numpy() <= _WORD) & (right.str.len().to_numpy() <= _WORD)
    if short.any():
        out[short] = _lcs_words(left[short], right[short])
    for i in np.flatnonzero(~short):
        out[i] = _lcs_long(left.iat[i], right.iat[i])
    return out


@F.pandas_udf(T.IntegerType())
def _lcs(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(lcs_lengths(left, right).astype(np.int32))


# A filter on the score would otherwise be pushed below and run the kernel a second time.
_lcs = _lcs.asNondeterministic()


def key_ratio(left: Column | str, right: Column | str) -> Column:
    """Score 0-100 of two token keys: 200 * LCS / (len + len), rounded half to even."""
    a, b = as_col(left), as_col(right)
    total = F.length(a) + F.length(b)
    score = F.bround(F.lit(200.0) * _lcs(a, b) / total, 0).cast("int")
    return F.when((F.length(a) > 0) & (F.length(b) > 0), score).otherwise(F.lit(0))


def token_sort_ratio(left: Column | str, right: Column | str) -> Column:
    """Similarity 0-100 that ignores case, punctuation and word order; blank -> 0."""
    return key_ratio(token_key(left), token_key(right))


def _longest_block(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """Start in both and length of the longest common block; the first in ``a``, then in ``b``, of equal ones."""
    run = np.zeros(len(b), dtype=np.int64)
    best = (0, 0, 0)
    for i, char in enumerate(a):
        run = np.where(b == char, np.concatenate(([1], run[:-1] + 1)), 0)
        j = int(run.argmax())
        if run[j] > best[2]:
            best = (i - int(run[j]) + 1, j - int(run[j]) + 1, int(run[j]))
    return best


def _suffixes(text: Sequence[int]) -> tuple[list[dict[int, int]], list[int], list[int], list[int]]:
    """Suffix automaton: steps, suffix links, longest lengths and the first end of each state's strings."""
    steps, links, lengths, ends, last = [{}], [-1], [0], [-1], 0
    for at, char in enumerate(text):
        new = len(steps)
        steps.append({})
        lengths.append(at + 1)
        ends.append(at)
        links.append(0)
        state = last
        while state >= 0 and char not in steps[state]:
            steps[state][char] = new
            state = links[state]
        if state >= 0:
            target = steps[state][char]
            if lengths[target] == lengths[state] + 1:
                links[new] = target
            else:
                copy = len(steps)
                steps.append(dict(steps[target]))
                lengths.append(lengths[state] + 1)
                ends.append(ends[target])
                links.append(links[target])
                while state >= 0 and steps[state].get(char) == target:
                    steps[state][char] = copy
                    state = links[state]
                links[target] = links[new] = copy
        last = new
    return steps, links, lengths, ends


def _longest_by_suffixes(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """The same as :func:`_longest_block`, in time that grows with the two lengths."""
    steps, links, lengths, ends = _suffixes(b.tolist())
    best, state, n = (0, 0, 0), 0, 0
    for i, char in enumerate(a.tolist()):
        while state and char not in steps[state]:
            state = links[state]
            n = lengths[state]
        if char in steps[state]:
            state, n = steps[state][char], n + 1
        else:
            n = 0
        if n > best[2]:
            best = (i - n + 1, ends[state] - n + 1, n)
    return best


#: Products of lengths up to which comparing every pair of characters is faster.
_FEW = 1 << 16


def block_length(left: str, right: str) -> int:
    """Characters in common blocks: the longest one, then the same on both sides of it."""
    total, open_pairs = 0, [tuple(np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in (left, right))]
    while open_pairs:
        a, b = open_pairs.pop()
        if len(a) and len(b):
            i, j, n = (_longest_block if len(a) * len(b) <= _FEW else _longest_by_suffixes)(a, b)
            if n:
                total += n
                open_pairs += [(a[:i], b[:j]), (a[i + n :], b[j + n :])]
    return total


@F.pandas_udf(T.IntegerType())
def _blocks(left: pd.Series, right: pd.Series) -> pd.Series:
    pairs = pd.DataFrame({"a": left.to_numpy(), "b": right.to_numpy()})
    code, distinct = pd.factorize(pd.MultiIndex.from_frame(pairs))
    lengths = np.array([block_length(a, b) for a, b in distinct], dtype=np.int32)
    return pd.Series(lengths[code] if len(code) else np.zeros(0, np.int32))


def sequence_ratio(left: Column | str, right: Column | str) -> Column:
    """Ratcliff-Obershelp ratio 0-1, for pairs that are already matched; blank -> 0."""
    a, b = F.coalesce(as_col(left), F.lit("")), F.coalesce(as_col(right), F.lit(""))
    total = F.length(a) + F.length(b)
    filled = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(filled, F.lit(2.0) * _blocks(a, b) / total).otherwise(F.lit(0.0))
