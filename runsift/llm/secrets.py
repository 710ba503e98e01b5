"""Secret scans: fixed patterns, and guess-cost of the values that stand in a credential context.

The patterns find assigned values, access keys and long hex runs, leftmost and non-overlapping per kind. Then each value in a credential
context (a credential word, optionally further name parts, and an assignment or a space-separated value after `is`) is cut into words,
dates, repeats, keyboard walks and brute-force spans so that the sum of their guess costs (log2 of the guesses) is least; a value that costs
`least_bits` or more is taken for a secret and added as kind `guess`. The value is cut in whole, whatever its length.

Only texts that hold a credential word are looked at for values. A credential word ends where its part of a name ends: `author` and
`secretary` are none. Words rank as in three public vocabularies (see `ranked_words`). Null and empty texts have no secrets. Positions are code points. Repeated
rows are judged alike; an empty table gives an empty result. Result columns replace columns of the same name.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import math
import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from runsift.llm.frames import append_columns, follow_length
from runsift.llm.pieces import SPACE, _fields

LEAST_BITS = 40.0
REPLACEMENT = "[secret]"

# The patterns of the base kinds and their least lengths.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

#: Credential words: a plain beginning, by which texts without any are passed over, and the rest of the pattern.
_CREDENTIALS = (
    ("password", "s?"), ("passwd", "s?"), ("passphrase", "s?"), ("pwd", "s?"), ("secret", "s?"), ("token", "s?"), ("api", "[_-]?keys?"),
    ("access", "[_-]?keys?"), ("private", "[_-]?keys?"), ("credential", "s?"), ("auth", "(?:orization|entication)?"),
)
_CUES = tuple(begin for begin, _ in _CREDENTIALS)
#: Parts of a name that often follow without a mark between, as in `passwordhash`.
_JOINED = "key|id|hash|salt|string|str|text|value|val|field|file|name|prod|dev|test|live|admin|user|root|db"
# Where a word of a name ends: no letter follows, or a capital after a small letter. `author` and `secretary` go on.
_END = "(?:(?![A-Za-z])|(?<=[a-z])(?=[A-Z]))"
# Before the word any letters may stand (`PGPASSWORD`, `dbpwd`, `oauth`): hardly a plain word ends like a credential word.
#: A credential word, more parts of a name, an assignment, and a value without spaces or quotes.
_CONTEXT = re.compile(
    rf"""(?i:{"|".join(map("".join, _CREDENTIALS))})(?:{_END}|(?i:{_JOINED}){_END})[A-Za-z0-9_-]*["']?[\x20\t]*(?::=|=>|[:=]|\x20(?i:is)\x20)[\x20\t]*["']?([!#-&(-~]+)""",
    re.ASCII,
)
# Common words of passwords and settings, from most to least usual; the rank is what a guesser pays.
_WORDS = (
    "password admin secret token test user login welcome qwerty dragon master monkey letmein football baseball shadow sunshine princess "
    "iloveyou trustno superman batman hello freedom whatever starwars default changeme example sample dummy demo guest root pass key "
    "api access auth client server database public private local dev prod stage config value string none null true false your here my the"
).split()
#: Public vocabularies whose words rank after those: English, and two of many languages. About 50,000 words and parts together.
WORD_FILES = tuple(public_tokenizers.path(f) for f in ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"))
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
_NEXT = {(a, b) for row in _ROWS for a, b in (*zip(row, row[1:]), *zip(row[1:], row))}
_LEET = str.maketrans("@4301$5!7", "aaeoissit")
_DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")
_STEP_BITS = 1.0  # that another segment begins


def _brute_bits(c: str) -> float:
    return math.log2(10 if c.isdigit() else 26 if c.isalpha() else 33)


def _vocabulary(path: str) -> list[str]:
    """Pieces of a vocabulary file by rank; a space stands before those that begin a word."""
    with open(path, "rb") as file:
        raw = file.read()
    if path.endswith(".model"):
        return [dict(_fields(v))[1].decode().replace(SPACE, " ") for k, v in _fields(raw) if k == 1]
    ranks = sorted((int(rank), base64.b64decode(piece)) for piece, rank in map(bytes.split, raw.splitlines()))
    return [piece.decode("utf-8", "replace") for _, piece in ranks]


@functools.lru_cache(maxsize=2)
def ranked_words(files: tuple[str, ...] = WORD_FILES) -> tuple[dict[str, int], frozenset[str], int]:
    """Rank of each word in small letters, all beginnings of words, and the length of the longest.

    The common words of passwords come first; then the whole words of the vocabularies (ASCII, three letters or more), each at its best place
    among those of one file; then their parts of words of four letters or more, so that words that no vocabulary holds are few parts.
    """
    whole: dict[str, int] = {}
    parts: dict[str, int] = {}
    for path in files:
        seen: tuple[set, set] = (set(), set())
        for piece in _vocabulary(path):
            word = piece.strip(" ").lower()
            if not (word.isascii() and word.isalpha()):
                continue
            begins = piece.startswith(" ")
            if len(word) >= (3 if begins else 4) and word not in seen[begins]:
                seen[begins].add(word)
                held = whole if begins else parts
                held[word] = min(held.get(word, len(seen[begins])), len(seen[begins]))
    ordered = [*_WORDS, *sorted(whole, key=lambda w: (whole[w], w)), *sorted(parts, key=lambda w: (parts[w], w))]
    ranks = {w: k + 1 for k, w in enumerate(dict.fromkeys(ordered))}
    return ranks, frozenset(w[:k] for w in ranks for k in range(1, len(w) + 1)), max(map(len, ranks))


@functools.lru_cache(maxsize=1 << 14)
def guess_bits(value: str, files: tuple[str, ...] = WORD_FILES) -> float:
    """Least sum of log2 guesses over all segmentations of `value`; words rank as in the vocabulary `files`."""
    ranks, begun, longest = ranked_words(files)
    n = len(value)
    lower = value.lower()
    plain = lower.translate(_LEET)
    best = [0.0] + [math.inf] * n
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if m := _DATE.match(value, i):
            dates.setdefault(i, []).append(m.end())
    walk, same = [1] * n, [1] * n  # length of the walk, and of the run of one character, that ends at i
    for i in range(1, n):
        if (lower[i - 1], lower[i]) in _NEXT:
            walk[i] = walk[i - 1] + 1
        if lower[i] == lower[i - 1]:
            same[i] = same[i - 1] + 1
    # period[p][i]: how many characters up to i equal those p places before
    period = [[0] * n for _ in range(9)]
    for p in range(2, 9):
        for i in range(p, n):
            period[p][i] = period[p][i - 1] + 1 if lower[i] == lower[i - p] else 0
    spent = [0.0] * (n + 1)
    for i, c in enumerate(value):
        spent[i + 1] = spent[i] + _brute_bits(c)

    def run(i: int, k: int, least: int, scale: int) -> float:
        """Least cost of a run of `least` to `k` characters that ends at `i`, of log2(scale * length) bits.

        Another segment may hold the first characters of the run, a word at most, or a date. Only segments of another kind that begin
        before the run can make a later start better: within it, a longer run costs less than a shorter one after anything else.
        """
        return min(best[j] + math.log2(scale * (i - j)) for j in range(i - k, min(i - k + reach, i - least) + 1))

    reach = max(longest, 10)
    brute = math.inf  # least of best[j] - spent[j] so far: a brute-force span that began at the best place
    for i in range(n + 1):
        if i:
            end = i - 1
            best[i] = min(best[i], brute + spent[i] + _STEP_BITS)  # a word or a date may have reached here before
            if same[end] >= 3:
                best[i] = min(best[i], run(i, same[end], 3, 1) + _brute_bits(value[end]) + _STEP_BITS)
            if walk[end] >= 3:
                best[i] = min(best[i], run(i, walk[end], 3, 47 * 2) + _STEP_BITS)
            for p in range(2, 9):
                if period[p][end] >= p:
                    best[i] = min(best[i], run(i, period[p][end], p, 1) + _STEP_BITS)
        for spelled, factor in ((lower, 1), (plain, 2)) if plain != lower else ((lower, 1),):
            stop = i + 1
            while stop <= n and (word := spelled[i:stop]) in begun:
                if word in ranks:
                    shape = 0.0 if value[i:stop].islower() else 1.0
                    best[stop] = min(best[stop], best[i] + math.log2(factor * ranks[word] + 1) + shape + _STEP_BITS)
                stop += 1
        for stop in dates.get(i, ()):
            bits = math.log2(120) if stop - i == 4 else math.log2(120 * 365 * 4)
            best[stop] = min(best[stop], best[i] + bits + _STEP_BITS)
        brute = min(brute, best[i] - spent[i])
    return best[n] - _STEP_BITS if n else 0.0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by start, then kind."""
    lower = text.lower()
    found = []
    if any(w in lower for w in ("passw", "secret", "token", "api")):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def guessed_spans(text: str, least_bits: float) -> list[tuple[str, int, int]]:
    lower = text.lower()
    if not any(w in lower for w in _CUES):
        return []
    out = []
    for m in _CONTEXT.finditer(text):
        value = m[1].rstrip(",;.)")
        if value and guess_bits(value) >= least_bits:
            out.append(("guess", m.start(1), m.start(1) + len(value)))
    return out


def find_secrets(text: str | None, least_bits: float = LEAST_BITS) -> tuple[list, list]:
    """Base spans, and all spans; a guessed value that a base span covers is not told again."""
    if not text:
        return [], []
    base = base_spans(text)
    more = [g for g in guessed_spans(text, least_bits) if not any(a <= g[1] and g[2] <= b for _, a, b in base)]
    return base, sorted([*base, *more], key=lambda s: (s[1], KINDS.index(s[0])))


def _said(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, least_bits: float = LEAST_BITS, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """`docs` with `secrets`, an array of (kind, start, stop, base), by start."""
    fields = "secrets array<struct<kind: string, start: bigint, stop: bigint, base: boolean>>"

    def work(column: pa.Array) -> list:
        out = []
        for text in column:
            base, every = find_secrets(text.as_py(), least_bits)
            held = set(base)
            out.append([{"kind": k, "start": a, "stop": b, "base": (k, a, b) in held} for k, a, b in every])
        return [out]

    return append_columns(docs, fields, work, (text,), keep)


def redact(docs: DataFrame, least_bits: float = LEAST_BITS, length: str | None = None) -> DataFrame:
    """`docs` with each secret replaced by a mark: of an assignment only the value goes. Other text is kept as it is.

    The column `length`, if named, follows the text where that changes.
    """

    def work(column: pa.Array) -> list:
        before = column.to_pylist()
        after = [_redacted(x, least_bits) for x in before]
        return [after, [a != b for a, b in zip(before, after, strict=True)]]

    return follow_length(append_columns(docs, "text string, __changed boolean", work), length).select(*docs.columns)


def _redacted(text: str | None, least_bits: float) -> str | None:
    _, every = find_secrets(text, least_bits)
    if not every:
        return text
    cut = []
    for kind, a, b in every:
        if kind == "assign":
            m = _ASSIGN.match(text, a)
            a, b = m.start(2), m.end(2)
        if cut and a <= cut[-1][1]:
            cut[-1][1] = max(cut[-1][1], b)
        else:
            cut.append([a, b])
    edges = [0, *(x for span in cut for x in span), len(text)]
    return REPLACEMENT.join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def secrets_digest(docs: DataFrame) -> DataFrame:
    fields = "n_assign bigint, n_access bigint, n_hex bigint, n_guess bigint, base_sha256 string, spans string"

    def work(column: pa.Array) -> list:
        rows = []
        for text in column:
            base, every = find_secrets(text.as_py())
            kinds = [k for k, _, _ in every]
            rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(_said(base).encode()).hexdigest(), _said(every)))
        return [list(x) for x in zip(*rows, strict=True)] if rows else [[] for _ in range(6)]

    return append_columns(docs, fields, work, keep=["doc_id"])
