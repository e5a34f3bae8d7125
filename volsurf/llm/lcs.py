"""Longest common subsequences of two lists, bit-parallel over one of them."""

from __future__ import annotations

from collections.abc import Hashable, Sequence

import numpy as np

#: Bits of a table that is kept whole; a larger one is cut in halves first.
TABLE_BITS = 1 << 27


def common(a: Sequence[Hashable], b: Sequence[Hashable]) -> list[tuple[int, int]]:
    """Index pairs of one longest common subsequence, ascending.

    Row i of the table is an integer with a zero bit where the length grows, so
    a row costs a few operations on len(b) bits.  A table of more than
    TABLE_BITS bits is never kept: the middle row, from both ends, says where
    the second list divides, and the halves are solved by themselves, so memory
    grows with the lists and not with their product.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    # only items of both sides can pair
    left, right = set(a[head : len(a) - tail]), set(b[head : len(b) - tail])
    own = [i for i in range(head, len(a) - tail) if a[i] in right]
    other = [j for j in range(head, len(b) - tail) if b[j] in left]
    pairs, todo = [], [(0, len(own), 0, len(other))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        x, y = [a[i] for i in own[i0:i1]], [b[j] for j in other[j0:j1]]
        if len(x) > 1 and len(x) * len(y) > TABLE_BITS:
            half = len(x) // 2
            forward, backward = _lengths(x[:half], y), _lengths(x[half:][::-1], y[::-1])
            cut = int(np.argmax(forward + backward[::-1]))
            todo += [(i0, i0 + half, j0, j0 + cut), (i0 + half, i1, j0 + cut, j1)]
        else:
            pairs += [(own[i0 + i], other[j0 + j]) for i, j in _aligned(x, y)]
    ends = [(len(a) - tail + k, len(b) - tail + k) for k in range(tail)]
    return [(k, k) for k in range(head)] + sorted(pairs) + ends


def _places(y: Sequence[Hashable]) -> dict[Hashable, int]:
    where: dict[Hashable, int] = {}
    for j, item in enumerate(y):
        where[item] = where.get(item, 0) | 1 << j
    return where


def _lengths(x: Sequence[Hashable], y: Sequence[Hashable]) -> np.ndarray:
    """The length of x's common subsequence with each beginning of y, from the empty one on."""
    where, full = _places(y), (1 << len(y)) - 1
    v = full
    for item in x:
        u = v & where.get(item, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _aligned(x: Sequence[Hashable], y: Sequence[Hashable]) -> list[tuple[int, int]]:
    where, full = _places(y), (1 << len(y)) - 1
    rows = [full]
    for item in x:
        v = rows[-1]
        u = v & where.get(item, 0)
        rows.append(((v + u) | (v - u)) & full)
    pairs, i, j = [], len(x), len(y)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def length(a: Sequence[Hashable], where: dict[Hashable, int], n: int) -> int:
    """The length alone; ``where`` has a bit for each place of an item in the other list of n items."""
    full = v = (1 << n) - 1
    for item in a:
        u = v & where.get(item, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()
