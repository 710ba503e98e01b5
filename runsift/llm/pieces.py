"""Exact merge-type encoding with a public piece vocabulary, and decoding.

Encoding goes by backtracking, not by merging: an Aho-Corasick automaton gives the longest piece at a position; a piece may follow another
only if merging the characters of both again gives just these two; where no piece fits, the last one is given up, its position is marked as
failed in a bit field, and the next shorter one is tried. The one sequence in which all neighbours fit is what merging would give.

No piece holds a word boundary (the mark of a space) after another character, and characters that are in no longer piece end what can be
merged; so a text is cut there and words are encoded one by one. A worker keeps the encoding of words it has met, up to a stated number.

A null text is an empty one and gives no ids. Repeated rows are encoded alike; an empty table gives an empty result. Ids that are no bytes
of valid UTF-8 decode to U+FFFD as the public library does. Result columns replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from runsift.llm.frames import append_columns

SPACE = "▁"
#: Words of which a worker keeps the encoding, before they become the older half of what it keeps; fewer beside other stages.
KEPT_WORDS, KEPT_WORDS_BESIDE = 250_000, 80_000
#: Pairs of pieces of which a worker keeps whether they fit.
KEPT_PAIRS = 300_000
_BYTES = -1


def _fields(raw: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            size = varint()
            yield key >> 3, raw[at : at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[key & 7]
            yield key >> 3, raw[at : at + size]
            at += size


_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


class Pieces:
    """A vocabulary file of merge type with byte fallback and without normalisation rules."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS) -> None:
        self.kept_words = kept_words
        self.names: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer, rules = {}, {}
        with open(path, "rb") as file:
            raw = file.read()
        for number, value in _fields(raw):
            if number == 1:
                piece = dict(_fields(value))
                self.names.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, _NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                rules = dict(_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or rules.get(2) or rules.get(4, 1) or _USER in self.kinds or _UNUSED in self.kinds:
            raise ValueError("not a merge-type vocabulary with byte fallback and no normalisation")
        self.dummy_prefix = bool(rules.get(3, 1))
        self.score = {n: s for n, s, k in zip(self.names, scores, self.kinds, strict=True) if k == _NORMAL}
        self.ids = {n: i for i, (n, k) in enumerate(zip(self.names, self.kinds, strict=True)) if k == _NORMAL}
        self.byte_ids = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(self.names, self.kinds, strict=True)) if k == _BYTE}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.spaced = [n.replace(SPACE, " ") if k == _NORMAL else None for n, k in zip(self.names, self.kinds, strict=True)]
        self.shown = [n if k == _NORMAL else " ⁇ " if k == _UNKNOWN else "" for n, k in zip(self.names, self.kinds, strict=True)]
        if any(SPACE in n.lstrip(SPACE) for n in self.ids):
            raise ValueError("a piece goes over the end of a word")
        self.inner = {c for n in self.ids if len(n) > 1 for c in n}
        newline = "\n" not in self.inner
        self.word = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if newline else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.finder = ahocorasick.Automaton()
        for name in self.ids:
            if len(name) > 1:
                self.finder.add_word(name, len(name))
        self.finder.make_automaton()
        self.fits: dict[tuple[str, str], int | None] = {}
        self.kept: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging: the best-scored pair first, the leftmost of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, left: str, right: str) -> int | None:
        """The id of `right` if it may stand after `left` ("" at the start): if merging both gives just these two.

        None if it may not; _BYTES for a character that only has bytes.
        """
        pair = left, right
        if pair not in self.fits:
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            fit = self.merged(left + right) == ([left, right] if left else [right]) and (not left or self.follows("", right) is not None)
            self.fits[pair] = self.ids.get(right, _BYTES) if fit else None
        return self.fits[pair]

    def word_ids(self, word: str) -> list[int]:
        """Ids of a word; characters that no piece holds end as their bytes."""
        n = len(word)
        longest = [1] * n
        for end, length in self.finder.iter(word):
            longest[end - length + 1] = length  # ends rise, so the last one at a start is the longest
        out: list[int] = []
        names: list[str] = []
        left, at, failed = "", 0, 0  # bit i of failed: what was tried has no valid rest from position i
        length, known = longest[0] if n else 0, self.fits
        while at < n:
            while length:
                if not failed >> (at + length) & 1:
                    right = word[at : at + length]
                    fit = known[left, right] if (left, right) in known else self.follows(left, right) if length == 1 or right in self.ids else None
                    if fit is not None:
                        out.append(fit)
                        names.append(right)
                        left = right
                        at += length
                        length = longest[at] if at < n else 0
                        break
                length -= 1
            else:
                failed |= 1 << at
                out.pop()
                gone = names.pop()
                at -= len(gone)
                length = len(gone) - 1
                left = names[-1] if names else ""
        if _BYTES in out:
            return [i for fit, name in zip(out, names, strict=True) for i in ([fit] if fit != _BYTES else [self.byte_ids[b] for b in name.encode()])]
        return out

    def marked(self, text: str) -> str:
        text = text.replace(" ", SPACE)
        return SPACE + text if text and self.dummy_prefix else text

    def encode(self, text: str | None) -> list[int]:
        return [i for word in self.word.findall(self.marked(text or "")) for i in self.word_ids(word)]

    def decode(self, ids: list[int]) -> str:
        plain = [self.spaced[i] for i in ids]
        if None not in plain:
            text = "".join(plain)
            return text.removeprefix(" ") if self.dummy_prefix else text
        out: list[str] = []
        held = bytearray()
        leading = self.dummy_prefix  # a mark at the very start is the one that encoding put there
        for i in ids:
            byte = self.bytes_of.get(i)
            if byte is not None:
                held.append(byte)
                leading = False
                continue
            if held:
                out.append(self._utf8(held))
                held = bytearray()
            shown = self.shown[i]
            if leading and shown:
                shown = shown.removeprefix(SPACE)
                leading = False
            out.append(shown.replace(SPACE, " ") if self.kinds[i] == _NORMAL else shown)
        if held:
            out.append(self._utf8(held))
        return "".join(out)

    @staticmethod
    def _utf8(held: bytearray) -> str:
        """Bytes as text; each byte that is not part of a valid character becomes U+FFFD."""
        out, at = [], 0
        while at < len(held):
            first = held[at]
            size = 1 if first < 0x80 else 2 if first >> 5 == 6 else 3 if first >> 4 == 14 else 4 if first >> 3 == 30 else 1
            try:
                out.append(held[at : at + size].decode())
                at += size
            except UnicodeDecodeError:
                out.append("�")
                at += 1
        return "".join(out)

    def _word_digest(self, word: str) -> tuple[int, str, str]:
        made = self.word_ids(word)
        # A leading mark is only dropped at the start of a whole text, in `text_digest`.
        plain = self.decode([self.ids[SPACE], *made] if self.dummy_prefix else made)
        return len(made), ",".join(map(str, made)), plain

    def text_digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, and the text that they decode to."""
        words = self.word.findall(self.marked(text or ""))
        if not words:
            return 0, "", ""
        kept, older = self.kept, self.older
        for word in set(words).difference(kept):
            kept[word] = older.get(word) or self._word_digest(word)
        counts, ids, shown = zip(*map(kept.__getitem__, words), strict=True)
        if len(kept) >= self.kept_words:
            self.kept, self.older = {}, {w: x for w, x in kept.items() if len(w) <= 64}
        decoded = "".join(shown)
        return sum(counts), ",".join(ids), decoded.removeprefix(" ") if self.dummy_prefix else decoded


@lru_cache(maxsize=2)
def load(path: str, kept_words: int = KEPT_WORDS) -> Pieces:
    return Pieces(path, kept_words)


def _forget(path: str) -> Callable[[], None]:
    def done() -> None:
        pieces = load(path, KEPT_WORDS_BESIDE)
        pieces.kept, pieces.older, pieces.fits = {}, {}, {}

    return done


def encode_documents(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """`docs` with `token_ids` and their number, `n_tokens`."""

    def work(column: pa.Array) -> list:
        pieces = load(path)
        counts, parts = [0], [np.zeros(0, np.int32)]
        for text in column:
            count, ids, _ = pieces.text_digest(text.as_py())
            counts.append(count)
            parts.append(np.array(json.loads(f"[{ids}]"), np.int32))
        ends = np.cumsum(counts).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts))), np.array(counts[1:], np.int64)]

    return append_columns(docs, "token_ids array<int>, n_tokens bigint", work, (text,), keep)


def decode_documents(docs: DataFrame, path: str, keep: list[str] | None = None, ids: str = "token_ids") -> DataFrame:
    """`docs` with `decoded`, the text of `token_ids`."""
    return append_columns(docs, "decoded string", lambda column: [[load(path).decode(x.as_py() or []) for x in column]], (ids,), keep)


def digest(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """`docs` with n_tokens, ids_sha256 and decoded_sha256."""

    def work(column: pa.Array) -> list:
        pieces, rows = load(path), []
        for text in column:
            count, ids, decoded = pieces.text_digest(text.as_py())
            rows.append((count, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        return [list(x) for x in zip(*rows, strict=True)] if rows else [[], [], []]

    return append_columns(docs, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", work, keep=keep)


def with_tokens(docs: DataFrame, path: str) -> DataFrame:
    """`docs` with their ids, number of ids, and whether the ids decode to the text; both ways in one worker, which keeps one set of words."""

    def work(column: pa.Array) -> list:
        pieces = load(path, KEPT_WORDS_BESIDE)
        counts, parts, same = [0], [np.zeros(0, np.int32)], []
        for value in column:
            text = value.as_py() or ""
            count, ids, decoded = pieces.text_digest(text)
            counts.append(count)
            parts.append(np.array(json.loads(f"[{ids}]"), np.int32))
            same.append(decoded == text)
        ends = np.cumsum(counts).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts))), np.array(counts[1:], np.int64), same]

    return append_columns(docs, "token_ids array<int>, n_tokens bigint, round_trip boolean", work, done=_forget(path))
