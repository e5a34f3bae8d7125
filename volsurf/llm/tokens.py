"""Exact tokenization of whole texts with a public tokenizer, once per distinct word.

Both tokenizers cut texts at white space before they merge anything, so a text
may be encoded chunk by chunk.  Each task keeps the ids of the chunks it has
met; the library encodes each new chunk, and numpy lays the ids out in text
order.  Texts for which chunk boundaries could matter (exotic or doubled white
space, control characters, special-token strings) are encoded whole.
"""

from __future__ import annotations

import os
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import Places, encode_lists

#: Texts that are encoded whole: special-token look-alikes; white space other than single blanks and line feeds.
_WHOLE_DROPPED = r"<\||[\x1c-\x1f\x{85}\x{a0}]|\p{Zs}\p{Zs}|\p{Zl}|\p{Zp}|[\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
_WHOLE_KEPT = r"<\||[\s\p{Z}]{2}|^[\s\p{Z}]|[\s\p{Z}]\z|[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}]|\p{Zl}|\p{Zp}|[\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of byte-level BPE for byte values 128 to 255, by rule: printable ones stand for themselves."""
    out, spare = {}, 0x100 + 33 + 1  # 33 values below 33 and 127 come first
    for b in range(128, 256):
        if 0xA1 <= b <= 0xAC or b >= 0xAE:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Encoder:
    """``encode(texts)`` gives the ids of all texts, flat, and row offsets.

    keeps_space: whether the tokenizer encodes white space (byte-level BPE) or
    drops it (BPE with word ends, after lower-casing).
    """

    def __init__(self, path: str, keeps_space: bool, keep: int = 250_000):
        self.tokenizer, self.keeps_space = load(path), keeps_space
        self.places = Places(keep)
        self.flat, self.ends = np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64)
        self.letters = _byte_letters()
        self.stops = {c: self._whole([c])[0] for c in (".", ",", "\n")}

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pretoken(self, chunk: str) -> str | None:
        """The chunk as the model takes it, if it is one run of letters that normalization leaves alone."""
        word = chunk
        if self.keeps_space:
            if chunk[0] != " ":
                return None
            word = chunk[1:]
        if word.isascii():
            if not word.isalpha():
                return None
        elif not word.isalpha() or not self.keeps_space and (word != word.lower() or not is_normalized("NFC", word)):
            return None
        else:
            word = word.encode().decode("latin-1").translate(self.letters)
        return "\u0120" + word if self.keeps_space else word

    def _chunk_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of new chunks; a last full stop or comma after a letter is a token of its own."""
        cut = lambda c: c[:-1] if c[-1] in ".," and c[-2:-1].isascii() and c[-2:-1].isalpha() else c
        model, at, flat, ends = self.tokenizer.model, self.places.at, self.flat, self.ends
        known: dict[str, list[int]] = {}
        rest = []
        for core in dict.fromkeys(map(cut, chunks)):
            if (k := at.get(core)) is not None:
                known[core] = flat[ends[k] : ends[k + 1]].tolist()
            elif (p := self._pretoken(core)) is not None:
                known[core] = [t.id for t in model.tokenize(p)]
            else:
                rest.append(core)
        known.update(zip(rest, self._whole(rest), strict=True))
        return [known[c] if c in known else known[c[:-1]] + self.stops[c[-1]] for c in chunks]

    def _rows(self, chunks: pa.Array) -> np.ndarray:
        stay = self.places.evict()
        if stay is not None:
            sizes = self.ends[stay + 1] - self.ends[stay]
            ends = np.concatenate(([0], np.cumsum(sizes)))
            self.flat = self.flat[np.repeat(self.ends[stay] - ends[:-1], sizes) + np.arange(ends[-1])]
            self.ends = ends
        listed = chunks.to_pylist()
        new = self.places.new(listed)
        if new:
            got = self._chunk_ids(new)
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            used, more = int(self.ends[-1]), int(sizes.sum())
            if used + more > len(self.flat):
                self.flat = np.concatenate([self.flat[:used], np.zeros(max(more, used), np.uint32)])
            self.flat[used : used + more] = np.fromiter(chain.from_iterable(got), np.uint32, more)
            self.ends = np.concatenate([self.ends, used + np.cumsum(sizes)])
            self.places.add(new)
        return self.places.rows(listed)

    def _by_chunk(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.keeps_space:
            # "\nThe cat\nsat" is cut into "\nThe", " cat", "\nsat"; the first line feed is taken off below
            marked = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
            lists = pc.split_pattern(marked, " ")
        else:
            lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words, index, offsets = encode_lists(lists)
        if self.keeps_space:
            words = pc.if_else(pc.starts_with(words, "\n"), words, pc.binary_join_element_wise(" ", words, ""))
        rows = self._rows(words)[index]
        starts, sizes = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        total = np.concatenate(([0], np.cumsum(sizes)))
        ids = self.flat[np.repeat(starts - total[:-1], sizes) + np.arange(total[-1])]
        ends = total[offsets]
        if self.keeps_space:
            full = ends[1:] > ends[:-1]
            first = np.ones(len(ids), bool)
            first[ends[:-1][full]] = False
            ids, ends = ids[first], ends - np.concatenate(([0], np.cumsum(full)))
        return ids, ends

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "").cast(pa.string())
        whole = pc.match_substring_regex(texts, _WHOLE_KEPT if self.keeps_space else _WHOLE_DROPPED).to_numpy(zero_copy_only=False)
        if self.keeps_space:
            whole = whole & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
            empty = pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0
        else:
            empty = np.zeros(len(texts), bool)
        plain = pc.if_else(pa.array(whole | empty), pa.scalar("x"), texts)
        ids, ends = self._by_chunk(plain)
        odd = np.nonzero(whole | empty)[0]
        if not len(odd):
            return ids, ends
        parts, at = [], 0
        sizes = np.diff(ends)
        coded = iter(self._whole([texts[int(k)].as_py() for k in odd]))
        for k in odd.tolist():
            parts += [ids[ends[at] : ends[k]], np.array(next(coded), np.uint32)]
            sizes[k], at = len(parts[-1]), k + 1
        return np.concatenate([*parts, ids[ends[at] :]]), np.concatenate(([0], np.cumsum(sizes)))


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each row."""
    n = len(ends) - 1
    return np.insert(ids, ends[1:], np.full(n, end_id, ids.dtype)), ends + np.arange(n + 1)
