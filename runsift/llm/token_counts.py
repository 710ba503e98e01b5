"""Token counts that follow edits without encoding whole texts again.

A text is cut into pre-tokens by the public pattern of a byte-level merge vocabulary; each has its number of tokens. A segment tree over
them holds characters and tokens of every subtree. An edit goes down the tree to where it begins, encodes again from the last pre-token that
can't depend on what follows (boundary context) to the first old boundary after the edit at which old and new cuts agree, puts the new
pre-tokens in place of the old ones, and updates the sums above them. The total is the root's.

A pre-token's end depends on at most two characters after it, so all that end two characters or more before an edit stay. A cut at a
boundary depends on what follows only, so everything after an agreed boundary stays too.

Edits are (start, stop, text) in code points of the text as the edits before left it; ends beyond the text are taken as its end, reversed
ones as empty. Null texts are empty and have no tokens; null edits are none. Repeated rows are counted alike; an empty table gives an empty
result. Result columns replace columns of the same name.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsift.llm.frames import append_columns
from runsift.llm.secrets import base_spans

LEAF = 32  # pre-tokens of a leaf when a tree is built
_CONTEXT = 2
KEPT_WORDS = 300_000


class Counter:
    """Pre-tokens of texts and their numbers of tokens."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
        self.encoding = tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        # The same pattern for this library: its \s holds more than white space.
        self.pattern = regex.compile(public_tokenizers.PATTERN.replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.kept: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def counts(self, parts: list[str]) -> list[int]:
        kept = self.kept
        new = set(parts).difference(kept)
        if new:
            if len(kept) + len(new) > KEPT_WORDS:
                kept.clear()
                new = set(parts)
            for part in new:
                kept[part] = len(self.encoding.encode_ordinary(part))
        return list(map(kept.__getitem__, parts))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


class TokenTree:
    """Pre-tokens of one text in leaves, and sums of characters and tokens above them."""

    def __init__(self, counter: Counter, text: str, lengths: list[int] | None = None, counts: list[int] | None = None) -> None:
        self.counter, self.text = counter, text
        if lengths is None or counts is None:
            parts = counter.split(text)
            lengths, counts = list(map(len, parts)), counter.counts(parts)
        self._build(lengths, counts)

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        self.leaves = [(lengths[k : k + LEAF], counts[k : k + LEAF]) for k in range(0, len(lengths), LEAF)] or [([], [])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for k, (a, b) in enumerate(self.leaves):
            self.chars[self.size + k], self.tokens[self.size + k] = sum(a), sum(b)
        for k in range(self.size - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def arrays(self) -> tuple[list[int], list[int]]:
        """Lengths and token counts of all pre-tokens, as they can be stored and given back."""
        return [x for a, _ in self.leaves for x in a], [x for _, b in self.leaves for x in b]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at `place`, and where it begins."""
        k, begin = 1, 0
        while k < self.size:
            k *= 2
            if place >= begin + self.chars[k] and begin + self.chars[k] < self.chars[1]:
                begin += self.chars[k]
                k += 1
        return k - self.size, begin

    def edit(self, start: int, stop: int, inserted: str) -> int:
        """Put `inserted` in place of the characters from `start` to `stop`; how many pre-tokens were encoded again."""
        old = self.text
        start = min(max(start, 0), len(old))
        stop = min(max(stop, start), len(old))
        text = self.text = old[:start] + inserted + old[stop:]
        shift = len(text) - len(old)
        leaf, begin = self._leaf_at(max(0, start - _CONTEXT))
        lengths, counts = self.leaves[leaf]
        ends = list(accumulate(lengths, initial=begin))
        kept = max(0, bisect_right(ends, start - _CONTEXT) - 1)
        place, last, number = ends[kept], leaf, kept
        old_end = place  # end of the last old pre-token that has been passed
        parts: list[str] = []
        match = self.counter.pattern.match
        while not (place == old_end + shift and old_end >= stop):
            if place < len(text):
                part = match(text, place)[0]
                parts.append(part)
                place += len(part)
            while old_end < len(old) and (old_end < stop or old_end + shift < place):
                while number == len(self.leaves[last][0]):
                    last, number = last + 1, 0
                old_end += self.leaves[last][0][number]
                number += 1
        new = self.counter.counts(parts)
        rest = self.leaves[last]
        held = lengths[:kept] + list(map(len, parts)) + rest[0][number:], counts[:kept] + new + rest[1][number:]
        for k in range(leaf, last + 1):
            self.leaves[k] = ([], [])
        self.leaves[leaf] = held
        if len(held[0]) > 8 * LEAF:
            self._build(*self.arrays)
            return len(parts)
        above = set()
        for k in range(leaf, last + 1):
            at = self.size + k
            self.chars[at], self.tokens[at] = (sum(held[0]), sum(held[1])) if k == leaf else (0, 0)
            above.add(at // 2)
        while above and above != {0}:
            for k in above:
                self._sum(k)
            above = {k // 2 for k in above}
        return len(parts)


Edit = tuple[int, int, str]


def cleaning_edits(text: str) -> list[Edit]:
    """A mark in place of each secret, and nothing in place of each line that an earlier one equals; from the last to the first."""
    edits = []
    seen: set[str] = set()
    begin = 0
    for line in text.split("\n"):
        end = begin + len(line)
        if line.strip() and line in seen:
            edits.append((max(0, begin - 1), end, ""))
        seen.add(line)
        begin = end + 1
    free = 0
    gone = sorted(edits)
    for _, a, b in base_spans(text):
        if a >= free and not any(x < b and a < y for x, y, _ in gone):
            edits.append((a, b, "[secret]"))
            free = b
    return sorted(edits, reverse=True)


def build_trees(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """`docs` with n_tokens and `tree`, lengths and token counts of its pre-tokens, for `apply_edits` to go on from."""

    def work(column: pa.Array) -> list:
        n, trees = [], []
        for text in column:
            parts = counter(path).split(text.as_py() or "")
            counts = counter(path).counts(parts)
            n.append(sum(counts))
            trees.append({"lengths": list(map(len, parts)), "counts": counts})
        return [n, trees]

    return append_columns(docs, "n_tokens bigint, tree struct<lengths: array<int>, counts: array<int>>", work, keep=keep)


def apply_edits(trees: DataFrame, path: str, edits: str = "edits", keep: list[str] | None = None) -> DataFrame:
    """`trees` (text, tree, edits: array of (start, stop, text)) with text, tree and n_tokens after the edits, and n_reencoded."""

    def work(column: pa.Array, tree: pa.Array, edits: pa.Array) -> list:
        out = []
        for text, held, todo in zip(column.to_pylist(), tree.to_pylist(), edits.to_pylist(), strict=True):
            own = TokenTree(counter(path), text or "", *((held["lengths"], held["counts"]) if held else (None, None)))
            again = sum(own.edit(e["start"], e["stop"], e["text"] or "") for e in todo or () if e)
            lengths, counts = own.arrays
            out.append((None if text is None and not own.text else own.text, {"lengths": lengths, "counts": counts}, own.n_tokens, again))
        return [list(x) for x in zip(*out, strict=True)] if out else [[], [], [], []]

    fields = "text string, tree struct<lengths: array<int>, counts: array<int>>, n_tokens bigint, n_reencoded bigint"
    return append_columns(trees, fields, work, ("text", "tree", edits), keep)


def edited_counts(docs: DataFrame, path: str, edits_of: Callable[[str], Iterable[Edit]] = cleaning_edits, keep: list[str] | None = None) -> DataFrame:
    """`docs` with the token counts before and after the edits that `edits_of` makes from each text, without storing trees in between."""
    fields = "n_tokens bigint, n_pretokens bigint, n_edits bigint, n_tokens_after bigint, n_reencoded bigint"

    def rows(column: pa.Array) -> Iterator[tuple[int, ...]]:
        own = counter(path)
        for value in column:
            text = value.as_py() or ""
            parts = own.split(text)
            counts = own.counts(parts)
            before = sum(counts)
            edits = list(edits_of(text))
            if not edits:
                yield before, len(parts), 0, before, 0
                continue
            tree = TokenTree(own, text, list(map(len, parts)), counts)
            again = sum(tree.edit(*e) for e in edits)
            yield before, len(parts), len(edits), tree.n_tokens, again

    def work(column: pa.Array) -> list:
        found = list(rows(column))
        return [list(x) for x in zip(*found, strict=True)] if found else [[] for _ in range(5)]

    return append_columns(docs, fields, work, keep=keep, done=lambda: counter(path).kept.clear())


def token_digest(docs: DataFrame, path: str) -> DataFrame:
    return edited_counts(docs, path, keep=["doc_id"]).withColumn("n_saved", F.col("n_pretokens") - F.least("n_pretokens", "n_reencoded"))
