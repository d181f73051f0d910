"""Secret scans: fixed patterns, and a guess-cost estimate for values that stand beside credential words.

The patterns find assignments of at least 6 characters, access keys and long hexadecimal runs. Beside them, every value
in a credential context is cut, by dynamic programming, into the cheapest sequence of ranked words, dates, repeats,
keyboard walks and brute-force spans; values that would still take 2^GUESS_BITS guesses are secrets too, unless a pattern
has them already. The ranked words are a short fixed list and then the words that the documents themselves use most
(counted over all of them, outside assignments), so that a value of letters costs what its words cost. The segmentation
is a true minimum over all segments of all lengths; repeats are looked up in tables of minima over powers of two, so a
value of any length takes time in proportion to its length, but for a logarithm.

Spans are (kind, start, end) in code points, end exclusive, by start, then kind in the order of KINDS.

Defined results: a null or empty text has no spans and no words; texts are searched whole; repeated rows are searched one
by one, and counted as often; words used equally often rank in alphabetical order; empty tables give empty tables; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, buffer_of, lean, ready, slices, word_hashes, words

KINDS = ("assign", "access", "hex", "guess")
BASE = KINDS[:3]
#: Bits of guesses from which a value counts as a secret, and its least length.
GUESS_BITS, LEAST_VALUE = 32.0, 6
#: Words of the documents that are ranked at most, their least and largest length, and words that a task counts at once.
VOCABULARY, LEAST_WORD, LONGEST_WORD, COUNT_WORDS = 1 << 17, 3, 24, 1 << 20


def _either(word: str) -> str:
    """A pattern for a word in either case, for ASCII letters only."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_WORDS = ["password", "passwd", "secret", "token"]
_ASSIGN = re.compile("(" + "|".join([*map(_either, _WORDS), _either("api") + "_?" + _either("key")]) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Words that announce a credential.
_CONTEXT_WORDS = ["password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "credential", "credentials", "auth", "bearer", "pin"]
_KEYED = ["api", "access", "private", "auth", "secret"]
_CONTEXT = re.compile(
    r"(?<![A-Za-z0-9])(?:" + "|".join([*map(_either, sorted(_CONTEXT_WORDS, key=len, reverse=True)), "(?:" + "|".join(map(_either, _KEYED)) + ")[_-]?" + _either("key")])
    + r""")["']?\x20{0,8}(?:[:=]|\x20(?=[Ii][Ss]\x20)[Ii][Ss])\x20{0,8}["'`]?([^\s"'`<>,;]{%d,})""" % LEAST_VALUE
)
#: RE2 patterns that a text has to match for the ones above to be tried.
_MAYBE_BASE = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
_MAYBE_CONTEXT = r"(?i:pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|auth|bearer|pin|key)[\"']?\x20{0,8}(?:[:=]|(?i:is)\x20)"

#: Common passwords and words, by how soon they are guessed.
COMMON = (
    "password 123456 qwerty admin letmein welcome monkey dragon master login abc123 football baseball iloveyou trustno1 sunshine "
    "princess shadow superman batman michael jordan ashley bailey charlie donald hello freedom whatever secret changeme default "
    "example test testing user guest root pass passwd token key api demo sample placeholder none null true false your here "
    "the and for you this that with from have love summer winter spring autumn january february march april may june july "
    "august september october november december monday tuesday wednesday thursday friday saturday sunday company server "
    "database access account system service public private local host client state value string redacted hidden xxxx"
).split()
_RANK = {w: i + 1 for i, w in reversed(list(enumerate(COMMON)))}
_PLAIN = str.maketrans("013457@$!", "oieastasi")
_ROWS = ["`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./"]
#: Whole dates, with the bits that they take: a year, year and month, day and month, and all three.
_DATES = [
    (7.0, re.compile(r"(?:19|20)\d\d")),
    (11.0, re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])")),
    (16.0, re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d")),
]


def _near_keys() -> set[tuple[str, str]]:
    """Pairs of neighbouring keys: along a row, and to the row below, which is shifted by half a key."""
    out = set()
    for y, row in enumerate(_ROWS):
        for x, c in enumerate(row):
            beside = [row[x + 1 : x + 2]]
            if y + 1 < len(_ROWS):
                shift = 1 if y == 0 else 0
                beside += [_ROWS[y + 1][i : i + 1] for i in (x - 1 - shift + 1, x - shift) if i >= 0]
            for d in beside:
                if d:
                    out |= {(c, d), (d, c)}
    return out


_NEAR = _near_keys()


def _char_bits(c: str) -> float:
    return 3.33 if c.isdigit() else 4.71 if c.isalpha() and c.isascii() else 5.05 if c.isascii() else 8.0


def word_bits(part: str, rank: dict[str, int]) -> float | None:
    """Bits of a ranked word, in any case and with usual signs for letters, or None."""
    low, extra = part.lower(), 0.0
    place = rank.get(low)
    if place is None:
        place, extra = rank.get(low.translate(_PLAIN)), 2.0
    if place is None:
        return None
    caps = 0.0 if part == low else 1.0 if part in (low.capitalize(), part.upper()) else 3.0
    return place.bit_length() + 1.0 + extra + caps


def date_bits(part: str) -> float | None:
    return next((bits for bits, form in _DATES if form.fullmatch(part)), None)


def walk_step(a: str, b: str) -> bool:
    """Whether the second key is next to the first one on the keyboard, or in the alphabet or the digits."""
    a, b = a.lower(), b.lower()
    return (a, b) in _NEAR or (a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1)


#: Bits paid for each segment's kind, for a walk, and for each of its keys.
KIND_BITS, WALK_BITS, KEY_BITS = 1.0, 6.0, 1.0
#: Longest block of a repeat, and repeats at least, of one character and of longer blocks.
BLOCK_CHARS, LEAST_TIMES, LEAST_BLOCKS = 8, 3, 2
#: Characters of a date, at least and at most.
_DATE_CHARS = (4, 10)


class _Least:
    """Minima of the costs at positions b, b - step, ..., over any number of them, as tables over powers of two."""

    def __init__(self, cost: list[float]) -> None:
        self.cost = cost
        self.known: dict[tuple[int, int, int], tuple[float, int]] = {}

    def _power(self, step: int, p: int, b: int) -> tuple[float, int]:
        if p == 0:
            return self.cost[b], b
        key = (step, p, b)
        if key not in self.known:
            self.known[key] = min(self._power(step, p - 1, b), self._power(step, p - 1, b - (step << (p - 1))))
        return self.known[key]

    def of(self, step: int, b: int, many: int) -> tuple[float, int]:
        p = many.bit_length() - 1
        return min(self._power(step, p, b), self._power(step, p, b - (many - (1 << p)) * step))


def guess_segments(value: str, rank: dict[str, int] = _RANK) -> tuple[float, list[tuple[str, int, int]]]:
    """(bits of guesses, segments (kind, start, end)) of the cheapest segmentation; KIND_BITS are paid for each segment."""
    n, longest = len(value), max(map(len, rank), default=0) if rank is _RANK else LONGEST_WORD
    bits = [_char_bits(c) for c in value]
    paid = [0.0, *accumulate(bits)]
    cost: list[float] = [0.0] + [float("inf")] * n
    back: list[tuple[int, str]] = [(0, "")] * (n + 1)
    least = _Least(cost)
    same = [0] * (BLOCK_CHARS + 1)  # characters up to here that equal those a block before
    brute: tuple[float, int] = (float("inf"), 0)  # cost and start of the brute span that ends here
    walk: tuple[float, int] = (float("inf"), 0)
    keys = 1  # length of the walk that ends here

    def offer(i: int, j: int, total: float, kind: str) -> None:
        if total < cost[j]:
            cost[j], back[j] = total, (i, kind)

    for j in range(1, n + 1):
        brute = min((cost[j - 1] + KIND_BITS, j - 1), brute)
        brute = (brute[0] + bits[j - 1], brute[1])
        offer(brute[1], j, brute[0], "brute")
        keys = keys + 1 if j > 1 and walk_step(value[j - 2], value[j - 1]) else 1
        if keys < 3:
            walk = (float("inf"), 0)
        else:
            walk = min((walk[0] + KEY_BITS, walk[1]), (cost[j - 3] + KIND_BITS + WALK_BITS + 3 * KEY_BITS, j - 3))
            offer(walk[1], j, walk[0], "walk")
        for i in range(j - LEAST_WORD, max(j - longest, 0) - 1, -1):
            if (b := word_bits(value[i:j], rank)) is not None:
                offer(i, j, cost[i] + KIND_BITS + b, "word")
        for i in range(j - _DATE_CHARS[0], max(j - _DATE_CHARS[1], 0) - 1, -1):
            if value[i].isdigit() and (b := date_bits(value[i:j])) is not None:
                offer(i, j, cost[i] + KIND_BITS + b, "date")
        for unit in range(1, min(BLOCK_CHARS, j - 1) + 1):
            same[unit] = same[unit] + 1 if value[j - 1] == value[j - 1 - unit] else 0
            most, k = same[unit] // unit + 1, LEAST_TIMES if unit == 1 else LEAST_BLOCKS
            while k <= most:  # times k to z take equally many bits
                z = min(most, (1 << k.bit_length()) - 1)
                total, i = least.of(unit, j - k * unit, z - k + 1)
                offer(i, j, total + KIND_BITS + paid[j] - paid[j - unit] + k.bit_length(), "repeat")
                k = z + 1
    out, j = [], n
    while j:
        i, kind = back[j]
        out.append((kind, i, j))
        j = i
    return cost[n], out[::-1]


def ranked_words(df: DataFrame, text: str = "text", most: int = VOCABULARY) -> dict[str, int]:
    """The place of each of the `most` words that all texts together use most, behind the fixed ones.

    A word is a run of LEAST_WORD to LONGEST_WORD letters A-Z between blanks, quotes or punctuation that no colon or
    equals sign precedes, as those announce values.
    """
    ready(df.sparkSession)
    letter = np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123)]] = True
    edge = np.zeros(256, bool)
    edge[[*b" \t\r\n\f\v.,;:!?()\"'"]] = True
    sign = np.zeros(256, np.int64)
    sign[[*b":="]] = 1

    def counted(held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        """(word, n) of all the words held, as (hash, size, first byte, bytes)."""
        h, size, chars = (np.concatenate([x[k] for x in held]) for k in range(3))
        start = np.cumsum(size) - size
        _, first, n = np.unique(h, return_index=True, return_counts=True)
        own = size[first]
        at = np.repeat(start[first], own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        offsets = np.r_[0, np.cumsum(own)].astype(np.int32)
        found = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(chars[at].tobytes())])
        return pa.RecordBatch.from_arrays([found, pa.array(n, pa.int64())], ["word", "n"])

    def run(batches):
        held, many = [], 0
        for b in batches:
            data, offsets = buffer_of(b.column(0))
            for i, j in slices(offsets):
                d, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                start, end, doc = words(d, o, ~letter)
                if not len(start):
                    continue
                text_start, text_end = o[doc], o[doc + 1]
                ok = (end - start >= LEAST_WORD) & (end - start <= LONGEST_WORD)
                ok &= (start == text_start) | edge[d[np.maximum(start - 1, 0)]]
                ok &= (end == text_end) | edge[d[np.minimum(end, len(d) - 1)]]
                signs = np.r_[0, np.cumsum(sign[d])]
                last = np.r_[0, np.where(doc[1:] == doc[:-1], end[:-1], text_start[1:])] if len(doc) else start
                start, end = start[ok & (signs[start] == signs[last])], end[ok & (signs[start] == signs[last])]
                if not len(start):
                    continue
                size = end - start
                at = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                held.append((word_hashes(d, start, end), size, LOWER[d[at]]))
                many += len(start)
                if many >= COUNT_WORDS:
                    yield counted(held)
                    held, many = [], 0
        if held:
            yield counted(held)

    found = df.select(text).mapInArrow(lean(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = found.filter("n > 1").orderBy(F.desc("n"), "word").limit(most).toArrow().column("word").to_pylist()  # most rows at most
    fixed = dict(_RANK)
    return fixed | {w: i for i, w in enumerate([w for w in top if w not in fixed], len(fixed) + 1)}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The patterns' spans, unsorted."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def spans(text: str, bits: float = GUESS_BITS, base: bool = True, context: bool = True, rank: dict[str, int] = _RANK) -> list[tuple[str, int, int]]:
    """All spans of one text, sorted."""
    out = base_spans(text) if base else []
    if context:
        starts = sorted((a, b) for _, a, b in out)
        ends = list(accumulate((b for _, b in starts), max))
        for m in _CONTEXT.finditer(text):
            a, b = m.span(1)
            if text[a - 1] not in "\"'`":  # an open value may end a sentence
                b -= len(m[1]) - len(m[1].rstrip(".:!?)]}"))
            before = bisect_right(starts, (a, len(text) + 1))
            if b - a >= LEAST_VALUE and not (before and ends[before - 1] >= b) and guess_segments(text[a:b], rank)[0] >= bits:
                out.append(("guess", a, b))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _searched(texts: pa.Array, bits: float, rank: dict[str, int]) -> list[list[tuple[str, int, int]]]:
    base = pc.match_substring_regex(texts, _MAYBE_BASE).to_pylist()
    context = pc.match_substring_regex(texts, _MAYBE_CONTEXT).to_pylist()
    return [spans(texts[i].as_py(), bits, p, q, rank) if p or q else [] for i, (p, q) in enumerate(zip(base, context, strict=True))]


def found_spans(df: DataFrame, key: str = "doc_id", text: str = "text", bits: float = GUESS_BITS, rank: dict[str, int] | None = None) -> DataFrame:
    """(key, spans array<struct<kind, start, end>>) of every row. rank: the places of words, or None for those of df's texts."""
    ready(df.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    shared = df.sparkSession.sparkContext.broadcast(ranked_words(df, text) if rank is None else rank)

    def run(batches):
        for b in batches:
            found = _searched(b.column(1).fill_null(""), bits, shared.value)
            found = [[{"kind": k, "start": x, "end": y} for k, x, y in own] for own in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], [key, "spans"])

    return df.select(key, text).mapInArrow(lean(run), f"`{key}` {df.schema[key].dataType.simpleString()}, spans array<struct<kind string, start int, end int>>")


def redacted(text: str, found: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by one mark."""
    out, at = [], 0
    for _, a, b in sorted(found, key=lambda s: (s[1], s[2])):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redactions(df: DataFrame, text: str = "text", length: str | None = "n_chars", mark: str = "[SECRET]", rank: dict[str, int] | None = None) -> DataFrame:
    """df with its secrets replaced by marks, and the length column brought up to date where a text has changed."""
    ready(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(ranked_words(df, text) if rank is None else rank)
    names, schema = df.columns, df.schema
    at, size = names.index(text), names.index(length) if length in names else -1

    def run(batches):
        for b in batches:
            texts = b.column(at)
            found = _searched(texts.fill_null(""), GUESS_BITS, shared.value)
            new = {i: redacted(texts[i].as_py(), own, mark) for i, own in enumerate(found) if own}
            cols = list(b.columns)
            if new:
                cols[at] = pa.array([new.get(i, t) for i, t in enumerate(texts.to_pylist())], texts.type)
                if size >= 0:
                    cols[size] = pa.array([len(new[i]) if i in new else n for i, n in enumerate(cols[size].to_pylist())], cols[size].type)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return df.mapInArrow(lean(run), schema)


def joined(column: str, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined."""
    some = F.filter(column, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts by kind, the digest of the patterns' spans and all spans as text."""

    def many(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(key, *map(many, BASE), F.sha2(joined("spans", BASE), 256).alias("base_sha256"), joined("spans", KINDS).alias("spans"))
