"""Suffix arrays by two-stage sorting, in numpy over one block of bytes.

Only suffixes that are smaller than their successor (the suffix one byte later)
are sorted directly, on their first ``depth`` bytes. The others follow: a suffix
that is larger than its successor stands in the part of its first byte's bucket
that comes before the directly sorted ones, in the order of the successors. One
scan over the buckets in byte order places them all; a bucket's own runs of one
byte are placed run by run. Adjacent common prefixes are then read off, byte for
byte, up to ``depth``.
"""

from __future__ import annotations

import numpy as np


def words_at(s: np.ndarray, depth: int) -> np.ndarray:
    """The 8 bytes from every position as one big-endian number, zeros beyond the end."""
    padded = np.zeros(len(s) + depth + 16, dtype=np.uint64)
    padded[: len(s)] = s
    out = padded[:-8].copy()
    for j in range(1, 8):
        out <<= np.uint64(8)
        out |= padded[j: j + len(out)]
    return out


def smaller_than_successor(s: np.ndarray) -> np.ndarray:
    """Mask of the suffixes that are smaller than the suffix one byte later."""
    n = len(s)
    differs = np.ones(n, dtype=bool)
    differs[:-1] = s[:-1] != s[1:]
    decided = np.where(differs, np.arange(n), n - 1)
    decided = np.minimum.accumulate(decided[::-1])[::-1]     # where the run of equal bytes ends
    smaller = np.zeros(n, dtype=bool)                        # the last suffix is larger than the empty one
    smaller[:-1] = s[:-1] < s[1:]
    return smaller[decided]


def _mixed(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Mask of the entries whose group (numbered from 0, in order) holds different values."""
    differ = (values[1:] != values[:-1]) & (group[1:] == group[:-1])
    mixed = np.zeros(int(group[-1]) + 1, dtype=bool)
    mixed[group[1:][differ]] = True
    return mixed.take(group)


def sort_directly(at: np.ndarray, words: np.ndarray, depth: int, alike: np.ndarray) -> np.ndarray:
    """Positions ``at`` in order of their first ``depth`` bytes. ``alike`` (per
    position of ``at``) is equal for suffixes known to agree on all of these; they
    need no more rounds once they are apart from the others. A round sorts the
    groups whose next bytes differ; the others are in order as they are."""
    if not len(at):
        return at
    key = words[at]
    order = np.argsort(key)
    at, key, alike = at[order], key[order], alike[order]
    group = np.cumsum(np.r_[False, key[1:] != key[:-1]])
    open_ = np.flatnonzero(_mixed(alike, group))
    group = group[open_]
    for step in range(8, depth, 8):
        if not len(open_):
            break
        group = np.cumsum(np.r_[False, group[1:] != group[:-1]])
        key = words.take(at.take(open_) + step)
        if depth - step < 8:
            key >>= np.uint64(8 * (8 - (depth - step)))
        some = np.flatnonzero(_mixed(key, group))
        if not len(some):
            continue
        own, ranks, places = key[some], group[some], open_[some]
        order = np.lexsort((own, ranks))
        own, at[places], alike[places] = own[order], at[places[order]], alike[places[order]]
        new = np.cumsum(np.r_[False, (own[1:] != own[:-1]) | (ranks[1:] != ranks[:-1])])
        still = np.ones(len(open_), dtype=bool)
        still[some] = _mixed(alike[places], new)
        # a group that was sorted falls into new ones, all of them different from their neighbours
        group = 2 * len(open_) * group
        group[some] += new
        open_, group = open_[still], group[still]
    return at


def suffix_array(s: np.ndarray, words: np.ndarray, depth: int, alike: np.ndarray) -> np.ndarray:
    """Positions of ``s`` (bytes) in order of the first ``depth`` bytes from them.
    ``alike``: per position a fingerprint of these bytes."""
    direct = np.flatnonzero(smaller_than_successor(s))
    direct = sort_directly(direct, words, depth, alike[direct])
    edges = np.searchsorted(s[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if len(s):
        induced[int(s[-1])].append(np.array([len(s) - 1]))   # follows the empty suffix
    out = []
    for c in range(256):
        # larger than their successor: first those whose successor is in a bucket before, then runs of c
        run = np.concatenate(induced[c]) if induced[c] else np.zeros(0, dtype=np.int64)
        bucket = [run]
        while len(run):
            run = run[run > 0] - 1
            run = run[s[run] == c]
            bucket.append(run)
        bucket = np.concatenate([*bucket, direct[edges[c]: edges[c + 1]]])
        induced[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        first = s[before]
        larger = first > c
        before, first = before[larger], first[larger]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        where = np.flatnonzero(np.r_[True, first[1:] != first[:-1]]) if len(first) else []
        for a, b in zip(where, [*where[1:], len(first)]):
            induced[int(first[a])].append(before[a:b])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def common_prefixes(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to ``depth``, that each suffix shares with the next one in ``order``."""
    return shared_bytes(order[:-1], order[1:], words, depth)


def shared_bytes(a: np.ndarray, b: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Bytes, up to ``depth``, that the suffixes ``a`` and ``b`` share, pair by pair."""
    out = np.full(len(a), depth, dtype=np.int32)
    open_ = np.arange(len(out))
    for step in range(0, depth, 8):
        if not len(open_):
            break
        differ = words[a[open_] + step] ^ words[b[open_] + step]
        apart = differ != 0
        x = differ[apart]
        same = np.zeros(len(x), dtype=np.int32)
        for j in range(1, 8):
            same += x < np.uint64(1) << np.uint64(64 - 8 * j)
        out[open_[apart]] = np.minimum(step + same, depth)
        open_ = open_[~apart]
    return out


def agree_with_next(order: np.ndarray, s: np.ndarray, words: np.ndarray, depth: int, alike: np.ndarray) -> np.ndarray:
    """Mask: the suffix shares ``depth`` bytes with the next one in ``order``. Those
    whose fingerprints ``alike`` (per position) differ do not; the others are compared
    byte for byte. Where the two suffixes one byte before are such a pair as well, that
    leaves the last byte to compare."""
    prints = alike.take(order)
    out = prints[1:] == prints[:-1]
    pairs = np.flatnonzero(out)
    a, b = order[pairs], order[pairs + 1]
    to = np.full(len(s) + 1, -2, dtype=np.int64)              # the place before the first one has no pair
    to[a] = b
    follows = (to[a - 1] == b - 1) & (a > 0) & (np.maximum(a, b) + depth <= len(s))
    sure = follows.copy()
    sure[follows] = s[a[follows] + depth - 1] == s[b[follows] + depth - 1]
    rest = np.flatnonzero(~follows)
    sure[rest] = shared_bytes(a[rest], b[rest], words, depth) >= depth
    if not sure.all():                                       # fingerprints that met by chance: nothing is concluded from pairs
        sure = shared_bytes(a, b, words, depth) >= depth
    out[pairs] = sure
    return out
