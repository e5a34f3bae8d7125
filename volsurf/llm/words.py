"""Word columns: split a batch of texts once, work once per distinct word.

Corpora repeat their words.  ``split`` turns an Arrow column of texts into the
distinct words of the batch and one index per occurrence, all in native code;
``WordTable`` keeps what an operator has computed for words already seen.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step works on, so that memory is bounded per task.
SLICE_BYTES = 1 << 20
#: Words a table keeps before it starts anew.
KEEP = 100_000


def give_back() -> None:
    """Returns freed memory to the system; workers stay alive between tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", length: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``length`` bytes of text; a longer text comes alone."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = int(size[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(size, base + length, side="right")))
            yield batch.slice(at, end - at)
            at = end
    give_back()


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, index of each occurrence, row offsets) of texts at ASCII white space."""
    return encode_lists(pc.ascii_split_whitespace(pc.fill_null(texts, "")))


def encode_lists(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct strings of a list column, one index per kept occurrence, row offsets; empty strings go."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False)
    offsets = offsets - offsets[0]
    full = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        keep = full[index]
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        index = (np.cumsum(full) - 1)[index[keep]]
        return coded.dictionary.filter(pa.array(full)), index, offsets
    return coded.dictionary, index, offsets


class Places:
    """Row numbers of words in the order they came, with a bound.

    When more than ``keep`` words are held, those that only one batch had go.
    """

    def __init__(self, keep: int = KEEP):
        self.keep = keep
        self.at: dict[str, int] = {}
        self.uses = np.zeros(1024, np.int32)

    def evict(self) -> np.ndarray | None:
        """If there are too many words: the old rows that stay, in their new order."""
        if len(self.at) <= self.keep:
            return None
        stay = self.uses[: len(self.at)] > 1
        if stay.sum() > self.keep // 2:
            stay[:] = False
        rows = np.nonzero(stay)[0]
        self.at = dict(zip((w for w, s in zip(self.at, stay.tolist(), strict=True) if s), range(len(rows)), strict=True))
        self.uses[:] = 0
        return rows

    def new(self, words: list[str]) -> list[str]:
        return [w for w in words if w not in self.at]

    def add(self, words: list[str]) -> None:
        base = len(self.at)
        self.at.update(zip(words, range(base, base + len(words)), strict=True))
        if len(self.at) > len(self.uses):
            self.uses = np.concatenate([self.uses, np.zeros(len(self.at), np.int32)])

    def rows(self, words: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        self.uses[out] += 1
        return out


class WordTable:
    """Rows of ``compute(words)`` by word; ``compute`` sees a word once while it is kept."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], keep: int = KEEP):
        self.compute, self.places, self.values = compute, Places(keep), compute([])

    def lookup(self, words: pa.Array) -> np.ndarray:
        """The rows of distinct words, in their order."""
        stay = self.places.evict()
        if stay is not None:
            self.values = self.values[stay]
        listed = words.to_pylist()
        new = self.places.new(listed)
        if new:
            used, got = len(self.places.at), self.compute(new)
            if used + len(new) > len(self.values):
                self.values = np.concatenate([self.values[:used], np.zeros((max(len(new), used), *got.shape[1:]), got.dtype)])
            self.values[used : used + len(new)] = got
            self.places.add(new)
        return self.values[self.places.rows(listed)]
