"""Token ids of whole texts by a public tokenizer file, each distinct piece encoded once.

Both kinds of BPE tokenizer below cut a text into words before they merge, and no merge crosses such
a cut. These places are always cuts, so a text's ids are the ids of the pieces between them in a row:

- a space or line break with a character on either side that is surely not white space (the
  byte-level kind keeps the space with the word after it, the other kind drops white space);
- a mark of punctuation after a letter.

A worker keeps the ids of the pieces it has met, by 128 bits of their length and bytes; only new ones
go to the tokenizers library: a word of plain letters straight to its merges, the rest through the
whole tokenizer, many at a time with a special token between them. A text that holds a special token,
and every text under another kind of tokenizer, goes through the library as a whole.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from winnow.llm.arrays import BLOCK_BYTES, blocks, lower_ascii, word_codes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

#: Pieces a worker keeps in each of two generations, at some 170 bytes each, and the longest of them.
KEPT, KEPT_LENGTH = 200_000, 64
#: UTF-8 bytes of text that are encoded at once.
GROUP_BYTES = 2 * BLOCK_BYTES
_encoders: dict[str, Encoder] = {}


def _set(*ranges: tuple[int, int]) -> np.ndarray:
    member = np.zeros(256, bool)
    for low, high in ranges:
        member[low : high + 1] = True
    return member


_SPACES = _set((0x20, 0x20), (0x0A, 0x0A))
_PRINTED = _set((0x21, 0x7E))
_ASCII_LETTERS = _set((0x41, 0x5A), (0x61, 0x7A))
_BEGINS = _set((0x21, 0x7E), (0xC3, 0xDF), (0xE4, 0xF4))  # first bytes that no white space has
_TWO = _set((0xC3, 0xDF))
_LETTERS = _set((0x41, 0x5A), (0x61, 0x7A))
_MARKS = _set(*((b, b) for b in b".,!*%&$#|;:?"))


def cuts(data: np.ndarray) -> np.ndarray:
    """Places before which a text may be cut, as above; ``data`` is UTF-8 of one or more texts."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    at = np.flatnonzero((_SPACES | _MARKS)[data[1:-1]]) + 1
    last, lead = data[at - 1], data[np.maximum(at - 2, 0)]
    latin = (lead == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
    mark = _MARKS[data[at]] & (_LETTERS[last] | latin)
    solid = _PRINTED[last] | (_TWO[lead] & (last >= 0x80))
    space = _SPACES[data[at]] & solid & _BEGINS[data[at + 1]]
    return at[mark | space]


class Encoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        added = made.get("added_tokens") or ()
        self.marks = tuple(t["content"].encode() for t in added)
        self.special = next((t for t in added if t["special"]), None)
        self.kind = _kind(made) if self.special else "whole"
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Groups of texts: the first row, the number of ids of each text, and all ids in a row.

        A null counts as empty. A group has a few MB of text, or one text that is longer.
        """
        for row, offsets, data in blocks(texts, GROUP_BYTES):
            if self.kind == "whole":
                yield row, *self._whole(offsets, data)
            else:
                yield row, *self._pieces(offsets, data)

    def _whole(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        found = [np.array(e.ids, np.uint32) for e in self._batch(texts)]
        counts = np.array([len(f) for f in found], np.int64)
        return counts, np.concatenate([np.zeros(0, np.uint32), *found])

    def _pieces(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = len(offsets) - 1
        filled = offsets[:-1][offsets[1:] > offsets[:-1]]
        if not len(filled):
            return np.zeros(rows, np.int64), np.zeros(0, np.uint32)
        begins = np.zeros(len(data), bool)
        begins[cuts(data)] = True
        begins[filled] = True
        start = self._uncut(np.flatnonzero(begins), offsets, data)
        end = np.append(start[1:], len(data))
        body = lower_ascii()[data] if self.kind == "words" else data
        if self.kind == "words":
            begins[filled] = False
            start = start + (_SPACES[data[start]] & begins[start])
        code = np.empty((len(start), 2), np.uint64)
        for a in range(0, len(start), 1 << 19):
            code[a : a + (1 << 19)] = word_codes(body, start[a : a + (1 << 19)], end[a : a + (1 << 19)])
        _, first, same = np.unique(code[:, 0], return_index=True, return_inverse=True)
        if not np.array_equal(code[first[same], 1], code[:, 1]):
            _, first, same = np.unique(code, axis=0, return_index=True, return_inverse=True)
            same = same.reshape(-1)
        found = self._look_up(np.ascontiguousarray(code[first]), body, start[first], end[first])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), "<u4")
        places = np.cumsum(sizes) - sizes
        length = sizes[same]
        ends = np.cumsum(length)
        total = int(ends[-1])
        ids = pool[np.repeat(places[same] - (ends - length), length) + np.arange(total)]
        piece_row = np.searchsorted(offsets, np.minimum(start, len(data) - 1), "right") - 1
        counts = np.bincount(piece_row, weights=length, minlength=rows).astype(np.int64)
        return counts, ids

    def _uncut(self, start: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Make one piece of each text that holds a special token."""
        whole = data.tobytes()
        for mark in self.marks:
            place = whole.find(mark)
            while place >= 0:
                row = int(np.searchsorted(offsets, place, "right")) - 1
                start = start[(start <= offsets[row]) | (start >= offsets[row + 1])]
                place = whole.find(mark, max(int(offsets[row + 1]) - len(mark) + 1, place + 1))
        return start

    def _look_up(self, code: np.ndarray, body: np.ndarray, start: np.ndarray, end: np.ndarray):
        keys = code.view("V16").reshape(-1).tolist()
        found = list(map(self.known.get, keys))
        missing = [i for i, f in enumerate(found) if f is None]
        if missing and self.before:
            for i in missing:
                f = self.before.get(keys[i])
                if f is not None:
                    found[i] = self.known[keys[i]] = f
            missing = [i for i in missing if found[i] is None]
        if missing:
            plain, odd = [], []
            tokenize, known = self.tokenizer.model.tokenize, self.known
            space, whole = self.kind == "bytes", body.tobytes()
            start, end = start[missing], end[missing]
            ahead = (body[np.minimum(start, len(body) - 1)] == 0x20) & (end > start) & space
            others = np.concatenate([[0], np.cumsum(~_ASCII_LETTERS[body])])
            easy = (others[end] == others[start + ahead]) & (end > start + ahead)
            rows = zip(missing, start.tolist(), end.tolist(), ahead.tolist(), easy.tolist(), strict=True)
            for i, a, b, spaced, simple in rows:
                if simple:
                    name = _SPACE + whole[a + 1 : b].decode() if spaced else whole[a:b].decode()
                    found[i] = array("I", [t.id for t in tokenize(name)]).tobytes()
                    continue
                text = whole[a:b].decode()
                word = text[1:] if space and text[:1] == " " else text
                if _letters(word):
                    if not space:
                        text = text.lower()
                    name = text.replace(" ", _SPACE) if text.isascii() else _byte_names(text)
                    found[i] = array("I", [t.id for t in tokenize(name)]).tobytes()
                else:
                    (odd if "<" in text or ">" in text or len(text) > 1000 else plain).append((i, text))
            for i, ids in zip((i for i, _ in odd), self._batch([t for _, t in odd]), strict=True):
                found[i] = np.array(ids.ids, "<u4").tobytes()
            self._joined(plain, found)
            for i, kept in zip(missing, (end - start <= KEPT_LENGTH).tolist(), strict=True):
                if kept:
                    known[keys[i]] = found[i]
        if len(self.known) > KEPT:
            self.before, self.known = self.known, {}
        return found

    def _joined(self, items: list[tuple[int, str]], found: list, at_once: int = 64) -> None:
        mark, stop = self.special["content"], self.special["id"]
        groups = [items[i : i + at_once] for i in range(0, len(items), at_once)]
        texts = [mark.join([t for _, t in group]) for group in groups]
        for group, one in zip(groups, self._batch(texts), strict=True):
            ids = np.array(one.ids, "<u4")
            ends, data, start = np.flatnonzero(ids == stop).tolist(), ids.tobytes(), 0
            for (i, _), end in zip(group, [*ends, len(ids)], strict=True):
                found[i] = data[4 * start : 4 * end]
                start = end + 1

    def _batch(self, texts: list[str]):
        for i in range(0, len(texts), 64):
            yield from self.tokenizer.encode_batch(texts[i : i + 64], add_special_tokens=False)


def _letters(text: str) -> bool:
    """Letters that compose and change case one by one: ASCII and Latin ones, without dotted I."""
    return text.isalpha() and (text.isascii() or (max(text) < "ɐ" and "İ" not in text))


def _names() -> dict[int, str]:
    """Byte-level vocabularies write printable Latin-1 bytes as they are, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


_NAMES = _names()
_SPACE = _NAMES[32]


def _byte_names(text: str) -> str:
    return text.encode().decode("latin-1").translate(_NAMES)


def _kind(made: dict) -> str:
    """"bytes" and "words" are the two kinds of which a text's pieces can be encoded apart."""

    def name(part):
        return (part or {}).get("type")

    if made["model"]["type"] != "BPE" or made.get("post_processor") or made.get("truncation"):
        return "whole"
    cut, shape = made.get("pre_tokenizer"), made.get("normalizer")
    if name(cut) == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and not shape:
        return "bytes"
    steps = [name(p) for p in (cut or {}).get("pretokenizers", ())]
    forms = [name(p) for p in (shape or {}).get("normalizers", ())]
    if steps == ["Split", "ByteLevel"] and forms == ["NFC", "Replace", "Lowercase"]:
        split = cut["pretokenizers"][0]
        if split["invert"] and split["pattern"].get("Regex", "").endswith(r"|[^\s\p{L}\p{N}]+"):
            return "words"
    return "whole"


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, one in each worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
