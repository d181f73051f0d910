"""Exact BPE by dynamic programming over prefixes.

For every prefix of a word there is just one token that can end its encoding. An automaton over all vocabulary entries
(Aho and Corasick's, which leads from each prefix to the longest of its suffixes in the vocabulary, and on along suffix
links) gives the tokens that are suffixes of a prefix; the right one is the token that the last token of the shorter prefix can
stand beside, i.e. no merge across their boundary would have come first. Back-pointers then give the ids. A word costs
time in proportion to its length and the matches in it, however long it is; words that come again are remembered in a
table of bounded size.

Defined results: null and empty texts have no tokens; texts are taken whole; special tokens written out in a text become
their ids, as the library does it; where several fit, the longest does; texts with letters that Unicode got later than
Python's own tables are cut into words by the tokenizer's own rules, i.e. by the library, since the two may differ there;
repeated rows are encoded one by one; empty tables give empty tables; other columns are ignored, whatever their names.
The tokenizer's file is read on the driver and its text is broadcast.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache
from pathlib import Path

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import lean, ready

#: Words in a table of remembered ones (there are two), and the longest that is remembered.
MEMO_WORDS, MEMO_CHARS = 80_000, 64
#: Pairs of tokens whose test is remembered.
PAIRS = 1 << 18
_END = "\0"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it prints, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def late_letters() -> str:
    """Letters and numbers that the regex module knows, but Python's own, older Unicode tables don't.

    On these the installed libraries may differ, so the tokenizer's own rules cut texts that hold one.
    """
    free = "".join([c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn"])
    return "".join(regex.findall(r"[\p{L}\p{N}]", free))


class _Memo(dict):
    """word -> (ids as text, tokens as text), of the latest words: a full table becomes the old one, which is looked up
    until the next is full."""

    def __init__(self, codec: Codec) -> None:
        self.codec, self.old = codec, {}

    def __missing__(self, word: str) -> tuple[str, str]:
        out = self.old.get(word)
        if out is None:
            ids = self.codec.word(word)
            out = " ".join(map(str, ids)), " ".join([self.codec.tokens[i] for i in ids])
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = out
        return out


class Codec:
    """Encoder and decoder of a word-level BPE file of the tokenizers library (lower case, word ends, byte letters)."""

    def __init__(self, path: str, text: str | None = None) -> None:
        """From a file, or from its text where that is given."""
        text = Path(path).read_text(encoding="utf-8") if text is None else text
        spec = json.loads(text)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self._cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        #: (left, right) -> (rank, whole); of each whole its rank and parts.
        self.merge: dict[tuple[int, int], int] = {}
        self.rank = dict.fromkeys(vocab.values(), -1)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            whole = vocab[a + b]
            self.merge[vocab[a], vocab[b]] = rank
            if whole not in self.left:
                self.rank[whole], self.left[whole], self.right[whole] = rank, vocab[a], vocab[b]
        self._beside: dict[int, bool] = {}  # left << 32 | right -> whether they stay apart
        self.automaton = ahocorasick.Automaton()
        sound: set[int] = set()
        for token in sorted(vocab.values(), key=self.rank.__getitem__):
            if self.rank[token] >= 0:
                a, b = self.left[token], self.right[token]
                if a not in sound or b not in sound or not self._uncrossed(a, b, self.rank[token]):
                    continue
            elif len(self.tokens[token].removesuffix(end)) != 1:
                continue
            sound.add(token)
            spelt = self.tokens[token]
            key = spelt.removesuffix(end) + _END if spelt.endswith(end) and spelt != end else spelt
            self.automaton.add_word(key, (token, len(key)))
        self.automaton.make_automaton()
        self.letters = byte_letters()
        self.memo = _Memo(self)
        self._ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
        self._any = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
        late = late_letters()
        self._late, self._far = frozenset(late), re.compile(f"[{min(late, default=chr(0x10FFFF))}-{chr(0x10FFFF)}]")
        self._file, self._byte = text, {c: b for b, c in enumerate(self.letters)}

    def _uncrossed(self, x: int, y: int, own: int = -1) -> bool:
        """Whether x and y stay apart, side by side: no merge across their boundary (but the one ranked own) comes first.

        Goes back in time through the last part of x and the first part of y, undoing the later merge each time. A merge
        across is taken while both parts wait: before x's next merge, or no later than y's, as the leftmost of equals goes first.
        """
        till_x = till_y = 1 << 60
        while True:
            across = self.merge.get((x, y))
            if across is not None and across != own and across < till_x and across <= till_y:
                return False
            rx, ry = self.rank[x], self.rank[y]
            if rx < 0 and ry < 0:
                return True
            own = -1
            if rx > ry:
                till_x, x = rx, self.right[x]
            else:
                till_y, y = ry, self.left[y]

    def word(self, word: str) -> list[int]:
        """The ids of one pre-token."""
        spelt = "".join([self.letters[b] for b in word.encode()]) + _END
        n = len(spelt)
        last: list[int] = [-1] * (n + 1)
        back = [0] * (n + 1)
        beside = self._beside
        for at, (token, size) in self.automaton.iter(spelt):
            to = at + 1
            if last[to] >= 0:
                continue
            start = to - size
            if start:
                before = last[start]
                if before < 0:
                    continue
                pair = before << 32 | token
                apart = beside.get(pair)
                if apart is None:
                    if len(beside) >= PAIRS:
                        beside.clear()
                    apart = beside[pair] = self._uncrossed(before, token)
                if not apart:
                    continue
            last[to], back[to] = token, start
        out, at = [], n
        while at:
            out.append(last[at])
            at = back[at]
        return out[::-1]

    def words(self, text: str) -> list[str]:
        """Normalise and cut a text without special tokens into pre-tokens."""
        if text.isascii():
            return self._ascii.findall(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if self._far.search(text) and not self._late.isdisjoint(text):
            own = library(self._file)
            pieces = own.pre_tokenizer.pre_tokenize_str(own.normalizer.normalize_str(text))
            return [bytes([self._byte[c] for c in p]).decode() for p, _ in pieces]
        return self._any.findall(text.replace("Σ", "σ").lower())

    def _parts(self, text: str) -> list[tuple[str, str]]:
        memo = self.memo
        if self._cut is None or not self._cut.search(text):
            return [memo[w] for w in self.words(text)]
        out, at = [], 0
        for m in self._cut.finditer(text):
            out += [memo[w] for w in self.words(text[at : m.start()])]
            out.append((str(self.special[m[0]]), m[0]))
            at = m.end()
        return out + [memo[w] for w in self.words(text[at:])]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for p in self._parts(text or "") for i in p[0].split(" ")]

    def encode_text(self, text: str | None) -> tuple[str, str]:
        """(ids in decimal, joined by a space; what they decode to)."""
        parts = self._parts(text or "")
        return " ".join([p[0] for p in parts]), " ".join([p[1] for p in parts])

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a space: the file names no decoder."""
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


@lru_cache(2)
def library(text: str) -> Tokenizer:
    return Tokenizer.from_str(text)


@lru_cache(2)
def codec_of(text: str) -> Codec:
    return Codec("", text)


def _shipped(df: DataFrame, path: str):
    """The text of the tokenizer's file, as a broadcast."""
    return df.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def encoded(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every row."""
    ready(df.sparkSession)
    file = _shipped(df, path)

    def run(batches):
        c = codec_of(file.value)
        for b in batches:
            ids = [c.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    return df.select(key, text).mapInArrow(lean(run), f"`{key}` {df.schema[key].dataType.simpleString()}, ids array<int>")


def decoded(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of every row of ids."""
    ready(df.sparkSession)
    file = _shipped(df, path)

    def run(batches):
        c = codec_of(file.value)
        for b in batches:
            texts = [c.decode(x or []) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], [key, "text"])

    return df.select(key, ids).mapInArrow(lean(run), f"`{key}` {df.schema[key].dataType.simpleString()}, text string")


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass, only the digests leave it."""
    ready(df.sparkSession)
    file = _shipped(df, path)

    def run(batches):
        c = codec_of(file.value)
        for b in batches:
            n, ids, back = [], [], []
            for t in b.column(1).to_pylist():
                i, d = c.encode_text(t)
                n.append(i.count(" ") + 1 if i else 0)
                ids.append(hashlib.sha256(i.encode()).hexdigest())
                back.append(hashlib.sha256(d.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(lean(run), f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
