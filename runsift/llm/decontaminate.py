"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Texts are lower-cased (A-Z) and cut into words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. The automaton accepts every run of words of
every item. A document streams through it and the length of the longest match that ends at each word is tracked; where it is `window`
or more, those words are hit. An item of fewer words counts when all of it occurs.

Items reach the tasks in blocks of at most `block_words` words, one broadcast each, so that a broadcast never grows with the benchmark;
documents pass each block, and are written after every `_CHAINED` of them, so that a task never holds more automata at once. A word that no item holds sends the automaton to its root, so only runs of known words are looked at.

Null and empty texts have no words, no hits and stay. Repeated rows are judged alike. Repeated item ids count as one item. Without items
nothing is hit. Result columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runsift.llm.frames import append_columns, follow_length, settled, slices
from runsift.llm.words import LETTER_OR_DIGIT, LOWER, hash_word, hashes, prefix_sums, spans, text_bytes

WINDOW = 10
BLOCK_WORDS = 50_000
_CHAINED = 4


def item_words(text: str | None) -> list[bytes]:
    data, offsets = text_bytes(pa.array([text], pa.string()))
    data = LOWER[data]
    found = spans(data, offsets, LETTER_OR_DIGIT)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(found.starts, found.ends, strict=True)]


class SuffixAutomaton:
    """Of runs of word numbers of many items; `items[s]` are the items that hold the runs of state s."""

    def __init__(self, pieces: list[tuple[str, list[bytes], bool]], window: int) -> None:
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        paths = []
        for _, words, _ in pieces:
            last, path = 0, []
            for word in words:
                last = self._extend(last, self.words.setdefault(word, len(self.words)))
                path.append(last)
            paths.append(path)
        self.items: list[set[str]] = [set() for _ in self.next]
        self.whole: dict[int, list[tuple[int, str]]] = {}
        for (item, words, short), path in zip(pieces, paths, strict=True):
            for state in path:
                while state > 0 and item not in self.items[state]:
                    self.items[state].add(item)
                    state = self.link[state]
            if short and path:
                self.whole.setdefault(path[-1], []).append((len(words), item))
        self.least = min([window, *(n for held in self.whole.values() for n, _ in held)])
        #: For each state, the nearest state of its suffixes, itself included, that ends a whole short item.
        self.nearest = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.nearest[state] = state if state in self.whole else self.nearest[self.link[state]]
        pairs = sorted((hash_word(w), n, w) for w, n in self.words.items())
        self.hashes = np.array([h for h, _, _ in pairs], np.uint64)
        self.numbers = np.array([n for _, n, _ in pairs], np.int64)
        self.known = np.zeros(1 << 16, bool)
        self.known[(self.hashes >> np.uint64(48)).astype(np.int64)] = True
        self.spelled = list(self.words)

    def _clone(self, state: int, word: int, target: int) -> int:
        made = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = made
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = made
            state = self.link[state]
        return made

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._clone(last, word, target)
        made, state = self._state(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = made
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[made] = target if self.length[target] == self.length[state] + 1 else self._clone(state, word, target)
        return made

    def scan(self, numbers: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, end, items) of each hit run of a sequence of known words."""
        state = length = 0
        for i, word in enumerate(numbers):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            if length >= self.window:
                held = state
                while self.length[self.link[held]] >= self.window:
                    held = self.link[held]
                yield i + 1 - self.window, i + 1, self.items[held]
            held = self.nearest[state]
            while held > 0:
                for n, item in self.whole[held]:
                    if n <= length:
                        yield i + 1 - n, i + 1, {item}
                held = self.nearest[self.link[held]]

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[list[int]]], list[list[str]]]:
        """For each text its number of words, the byte spans that are hit, and the items found."""
        data = LOWER[data]
        found = spans(data, offsets, LETTER_OR_DIGIT)
        counts = np.diff(found.first)
        rows = len(counts)
        where: list[list[list[int]]] = [[] for _ in range(rows)]
        items: list[set[str]] = [set() for _ in range(rows)]
        if len(found.starts) and len(self.hashes):
            hashed = hashes(prefix_sums(data), found.starts, found.ends)
            known = self.known[(hashed >> np.uint64(48)).astype(np.int64)]
            at = np.flatnonzero(known)
            place = np.minimum(np.searchsorted(self.hashes, hashed[at]), len(self.hashes) - 1)
            sure = self.hashes[place] == hashed[at]
            at, number = at[sure], self.numbers[place[sure]]
            row = np.searchsorted(found.first, at, side="right") - 1
            broken = np.flatnonzero((np.diff(at) != 1) | (np.diff(row) != 0)) + 1
            edges = np.concatenate([[0], broken, [len(at)]])
            raw = None
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a < self.least:
                    continue
                raw = data.tobytes() if raw is None else raw
                numbers = number[a:b].tolist()
                first = int(at[a])
                # Equal hashes were taken for equal words; here the words themselves are compared.
                numbers = [n if raw[found.starts[first + k] : found.ends[first + k]] == self.spelled[n] else -1 for k, n in enumerate(numbers)]
                r = int(row[a])
                for low, high, names in self.scan(numbers):
                    items[r] |= names
                    span = where[r]
                    low, high = first + low, first + high
                    if span and low <= span[-1][1]:
                        span[-1][0] = min(span[-1][0], low)
                        span[-1][1] = max(span[-1][1], high)
                        while len(span) > 1 and span[-1][0] <= span[-2][1]:
                            low, high = span.pop()
                            span[-1] = [min(span[-1][0], low), max(span[-1][1], high)]
                    else:
                        span.append([low, high])
        for r, held in enumerate(where):
            # Word numbers of the slice become word numbers of the document, followed by the bytes from the first word to the last.
            where[r] = [[int(a - found.first[r]), int(b - found.first[r]), int(found.starts[a] - offsets[r]), int(found.ends[b - 1] - offsets[r])] for a, b in held]
        return counts, where, [sorted(x) for x in items]


def blocks(benchmark: DataFrame, window: int, block_words: int, item: str, text: str) -> Iterator[list[tuple[str, list[bytes], bool]]]:
    """Items in blocks of at most `block_words` words; a longer item is cut so that each of its windows is whole in one part."""
    held, size = [], 0
    for row in benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where("item is not null").toLocalIterator():
        words = item_words(row["text"])
        step = block_words - window + 1
        for low in range(0, max(1, len(words) - window + 1), step):
            part = words[low : low + block_words]
            if not part:
                continue
            if size + len(part) > block_words and held:
                yield held
                held, size = [], 0
            held.append((row["item"], part, len(words) < window))
            size += len(part)
    yield held


HIT_FIELDS = "n_words bigint, hit_spans array<array<bigint>>, hit_items array<string>"


def find_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, text: str = "text", item: str = "item_id"
) -> DataFrame:
    """`docs` with `n_words`, `hit_spans` (first word, end, first byte, end byte) and `hit_items` (sorted as strings)."""
    spark = docs.sparkSession
    result = docs
    for k, block in enumerate(blocks(benchmark, window, block_words, item, "text")):
        shared = spark.sparkContext.broadcast(SuffixAutomaton(block, window))

        def work(column: pa.Array, *before: pa.Array, shared=shared) -> list:
            automaton = shared.value
            data, offsets = text_bytes(column)
            counts, where, items = [], [], []
            for low, high in slices(offsets):
                part = automaton.hits(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                counts.append(part[0])
                where += part[1]
                items += part[2]
            if before:
                where = [merged([*a, *b]) for a, b in zip(before[0].to_pylist(), where, strict=True)]
                items = [sorted({*a, *b}) for a, b in zip(before[1].to_pylist(), items, strict=True)]
            return [np.concatenate(counts) if counts else np.zeros(0, np.int64), where, items]

        if k and k % _CHAINED == 0:
            result = settled(result)
        result = append_columns(result, HIT_FIELDS, work, (text, "hit_spans", "hit_items") if k else (text,))
    return result


def merged(held: list[list[int]]) -> list[list[int]]:
    """Spans of words that overlap or touch, as one."""
    out: list[list[int]] = []
    for span in sorted(held):
        if out and span[0] <= out[-1][1]:
            if span[1] > out[-1][1]:
                out[-1] = [out[-1][0], span[1], out[-1][2], span[3]]
        else:
            out.append(list(span))
    return out


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    most_coverage: float = 0.5,
    most_span: int | None = None,
    block_words: int = BLOCK_WORDS,
    length: str | None = None,
) -> DataFrame:
    """`docs` without the hit spans; documents whose hit words exceed `most_coverage` of all, or `most_span` in one run, go as a whole.

    What lies between the removed spans is kept as it is; documents without a hit are not touched. The column `length`, if named, follows
    the text where that changes.
    """
    found = find_hits(docs, benchmark, window, block_words)
    kept = docs.columns

    def cut(column: pa.Array, hit: pa.Array, n_words: pa.Array) -> list:
        if not pc.any(pc.greater(pc.list_value_length(hit), 0)).as_py():
            return [column, np.ones(len(column), bool), np.zeros(len(column), bool)]
        texts, stays, changed = [], [], []
        for text, where, n in zip(column.to_pylist(), hit.to_pylist(), n_words.to_pylist(), strict=True):
            runs = [b - a for a, b, _, _ in where]
            stays.append(not runs or (sum(runs) <= most_coverage * n and (most_span is None or max(runs) <= most_span)))
            if runs:
                raw, edges = text.encode(), [0, *(x for _, _, a, b in where for x in (a, b)), None]
                text = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()
            texts.append(text)
            changed.append(bool(runs))
        return [texts, stays, changed]

    cleaned = append_columns(found, "text string, __stays boolean, __changed boolean", cut, ("text", "hit_spans", "n_words"), [c for c in kept if c.lower() != "text"])
    return follow_length(cleaned.where("__stays"), length).select(*kept)


def contamination_digest(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    found = find_hits(docs.select("doc_id", "text"), benchmark, window)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )

