"""Byte-level BPE (op 6) and exact prefix token counts (op 3), for one text at a time.

Both rest on one fact about BPE: a run of tokens is the encoding of its bytes if and only if each two
neighbours are the encoding of theirs. ``Vocabulary.adjoin`` memoises that test.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from itertools import accumulate, chain
from typing import Any

import ahocorasick
import regex

from tracklode.llm.common import CACHES

#: Fixed value: the pattern that splits text before merges, as published with the vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Marks that are one piece and one token after a word, and a bound below which letters are letters in every edition of Unicode.
MARKS, LATIN = tuple(".,;:!?"), "\u0250"
#: Entries that each of a memo's two generations holds.
MEMO = 500_000
#: Only strings up to this length are kept in a memo.
MEMO_CHARS = 48


def unicode_bytes() -> dict[str, int]:
    """The printable stand-ins of bytes in JSON vocabularies: printable Latin-1 as is, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_ranks(path: str) -> tuple[list[bytes], dict[str, int]]:
    """Tokens by id and the special strings, from a ``.tiktoken`` rank file or a byte-level BPE ``.json``."""
    if not path.endswith(".json"):
        ranks = {base64.b64decode(a): int(i) for a, i in map(bytes.split, open(path, "rb"))}
        return sorted(ranks, key=ranks.__getitem__), {}
    data, table = json.load(open(path, encoding="utf-8")), unicode_bytes()
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    plain = sorted((i, t) for t, i in data["model"]["vocab"].items() if t not in special)
    return [bytes(table[c] for c in t) for _, t in plain], special


class Memo(dict):
    """Values by key, made on first use; when full, the entries become the old generation, which goes next."""

    def __init__(self, make: Callable[[str], Any]):
        self.make, self.old, self.share = make, {}, 1.0

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= MEMO_CHARS:
            if len(self) >= MEMO * self.share:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class NotOneWord(Exception):
    """A part between two spaces that is empty or has white space at an end."""


class Vocabulary:
    """Tokens in the order of their ids; for the files used here that is the order of the merges too."""

    def __init__(self, tokens: list[bytes], special: dict[str, int] | None = None):
        self.tokens, self.special = tokens, special or {}
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.names = [str(i) for i in range(len(tokens))]
        self.find = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, t in enumerate(tokens):
            self.find.add_word(t.decode("latin-1"), i)
        self.find.make_automaton()
        self.split = regex.compile(PATTERN)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.size = [len(t) for t in tokens]
        self.back = [len(t) - 1 for t in tokens]
        self.shorter: list[int | None] = [None] * len(tokens)
        self.pairs: dict[int, bool] = {}
        self.halves: list[tuple[int, int] | None | bool] = [False] * len(tokens)
        self.blank = regex.compile(r"\s+")
        self.pieces = Memo(lambda piece: tuple(self.encode_piece(piece.encode())))
        self.words = Memo(self.word)
        self.tables = Memo(self.make_table)
        self.piece_counts = Memo(lambda piece: self.counts(piece)[-1])
        self.word_counts = Memo(self.word_count)

    def word_pieces(self, word: str) -> list[str]:
        """Pieces of a word and the one space before it. No piece crosses such a space from the left."""
        if not word or word[0].isspace() or word[-1].isspace():
            raise NotOneWord
        return self.split.findall(" " + word)

    def word(self, word: str) -> tuple[int, ...]:
        if word.isalpha() and max(word) < LATIN:  # letters alone are one piece
            return tuple(self.encode_piece(b" " + word.encode()))
        if word[-1:] in MARKS and word[:-1].isalpha() and max(word) < LATIN:  # and so is a mark after them
            return (*self.words[word[:-1]], self.rank[word[-1].encode()])
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, self.word_pieces(word))))

    def word_count(self, word: str) -> int:
        if word.isalpha() and max(word) < LATIN:  # letters alone are one piece
            return self.counts(" " + word)[-1]
        if word[-1:] in MARKS and word[:-1].isalpha() and max(word) < LATIN:  # and so is a mark after them
            return self.word_counts[word[:-1]] + 1
        return sum(map(self.piece_counts.__getitem__, self.word_pieces(word)))

    # -- adjacent tokens ------------------------------------------------------------------------------

    def merge(self, data: bytes) -> list[int]:
        """The definition: merge the neighbours of the lowest rank, leftmost first, while any has one."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            known = [r for r in ranks if r >= 0]
            if not known:
                break
            at = ranks.index(min(known))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def adjoin(self, a: int, b: int) -> bool:
        key = a * len(self.tokens) + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 2 * MEMO:
                self.pairs.clear()
            known = self.pairs[key] = self.fits(a, b)
        return known

    def split_token(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``t``; none for single bytes and for tokens that merges do not make."""
        known = self.halves[t]
        if known is False:
            data, known = self.tokens[t], None
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                ranks = [self.rank.get(a + b, t) for a, b in zip(parts, parts[1:])]
                low = min(ranks)
                if low >= t:
                    break
                at = ranks.index(low)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                known = self.rank[parts[0]], self.rank[parts[1]]
            self.halves[t] = known
        return known

    def fits(self, a: int, b: int) -> bool:
        """Whether no merge crosses from ``a`` to ``b``, found by undoing the merges next to the border, the last one first.

        Between two undone merges the tokens at the border were those now at hand; had their own merge come before
        the merge undone last, it would have been made. At equal ranks what stands further left is merged first.
        """
        tokens, rank, limit = self.tokens, self.rank, len(self.tokens)
        x, y = a, b
        if (len(tokens[a]) > 1 and self.split_token(a) is None) or (len(tokens[b]) > 1 and self.split_token(b) is None):
            return self.merge(tokens[a] + tokens[b]) == [a, b]
        while True:
            if rank.get(tokens[x] + tokens[y], limit) < limit:
                return False
            left, right = self.split_token(x), self.split_token(y)
            if left and (x > y or not right):
                limit, x = x, left[1]
            elif right:
                limit, y = y + 1, right[0]
            else:
                return True

    def prefix_token(self, t: int) -> int:
        """The longest token that begins ``t`` and is shorter; -1 if there is none."""
        known = self.shorter[t]
        if known is None:
            data = self.tokens[t]
            known = self.shorter[t] = next((self.rank[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.rank), -1)
        return known

    # -- encoding -------------------------------------------------------------------------------------

    def encode_piece(self, data: bytes) -> list[int]:
        """Longest matches with backtracking: a position from which no way leads on is never entered again."""
        if (whole := self.rank.get(data)) is not None:
            return [whole]
        size, back, n = self.size, self.back, len(data)
        longest = [-1] * n
        for end, t in self.find.iter(data.decode("latin-1")):  # by rising end, so the last one for a start is the longest
            longest[end - back[t]] = t
        dead, out, at = bytearray(n + 1), [], 0
        t = longest[0]
        while at < n:
            end = at + size[t]
            if not dead[end] and (not out or self.adjoin(out[-1], t)):
                out.append(t)
                at = end
                t = longest[at] if at < n else -1
                continue
            t = self.prefix_token(t)
            while t < 0:  # no token leads on from here
                dead[at] = 1
                t = out.pop()
                at -= size[t]
                t = self.prefix_token(t)
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of ordinary text: strings of special tokens count as text."""
        first, *words = text.split(" ")
        try:
            if not words or not first or first[-1].isspace():
                raise NotOneWord
            head = map(self.pieces.__getitem__, self.split.findall(first))
            return list(chain.from_iterable(chain(head, map(self.words.__getitem__, words))))
        except NotOneWord:
            return list(chain.from_iterable(map(self.pieces.__getitem__, self.split.findall(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    # -- prefix counts --------------------------------------------------------------------------------

    def make_table(self, piece: str) -> tuple[int, ...]:
        return tuple(self.counts(piece))

    def counts(self, piece: str) -> list[int]:
        """Token counts of the piece's first 1, 2, ... bytes, each taken as a text that no pattern splits.

        The last token of a prefix is the one token at its end that fits the last token of what stands
        before it; so each count is one more than a count further left.
        """
        data = piece if piece.isascii() else piece.encode().decode("latin-1")
        size, known, width = self.size, self.pairs.get, len(self.tokens)
        counts = [1] * len(data)
        last = [-1] * len(data)  # the last token of the prefix that ends at this byte
        for end, t in self.find.iter(data):
            if last[end] < 0:
                before = end - size[t]
                if before >= 0:
                    ok = known(last[before] * width + t)
                    if ok is None:
                        ok = self.adjoin(last[before], t)
                    if not ok:
                        continue
                    counts[end] = counts[before] + 1
                last[end] = t
        return counts

    def runs(self, text: str) -> list[str]:
        """The text between special strings; each special string is one token."""
        return self.cut.split(text) if self.cut else [text]

    def count(self, text: str) -> int:
        """Tokens of the text; special strings count one each, as the library's default has it."""
        runs = self.runs(text)
        return len(runs) - 1 + sum(map(self._plain, runs))

    def _plain(self, text: str) -> int:
        first, *words = text.split(" ")
        try:
            if not words or not first or first[-1].isspace():
                raise NotOneWord
            return sum(map(self.piece_counts.__getitem__, self.split.findall(first))) + sum(map(self.word_counts.__getitem__, words))
        except NotOneWord:
            return sum(map(self.piece_counts.__getitem__, self.split.findall(text)))

    def prefix_counts(self, text: str) -> list[int]:
        """Exact token counts of text[:0], text[:1], ... text[:len(text)], each as if it stood alone.

        A prefix may end inside a piece of the whole text. Such an end is a piece itself, but for two cases:
        white space at the end stays in one piece, and a contraction cut short falls apart into its quote and
        letters. A prefix that ends inside a special string has its beginning as plain text.
        """
        out, base, at = [0], 0, 0
        marks = list(self.cut.finditer(text)) if self.cut else []
        for mark in [*marks, None]:
            run = text[at : mark.start() if mark else len(text)]
            base = self._run_counts(run, base, out)
            if mark:
                stop = mark.end()
                cut = at + self.last_cut(run)  # what stands before is split as it is, whatever follows
                head = self._plain(text[cut : mark.start()])
                for end in range(mark.start() + 1, stop):
                    out.append(base - head + self._plain(text[cut:end]))
                base += 1
                out.append(base)
                at = stop
        return out

    @staticmethod
    def last_cut(run: str) -> int:
        """Place of the last space between two others that are no white space; 0 if there is none."""
        at = len(run) - 1
        while (at := run.rfind(" ", 1, at)) > 0:
            if not run[at - 1].isspace() and not run[at + 1].isspace():
                return at
        return 0

    def _run_counts(self, run: str, base: int, out: list[int]) -> int:
        # a prefix that ends in white space has all of that in one piece: its beginning, the count up to there, the
        # table of the whole, and where each of its characters ends in bytes
        begin = stop = -1
        for m in self.split.finditer(run):
            piece = m[0]
            white = self.blank.match(run, m.start())
            if white and not begin <= m.start() < stop:
                begin, stop, before = m.start(), white.end(), base
                table_of_white, widths = self.tables[white[0]], list(accumulate(len(c.encode()) for c in white[0]))
            if white and white.end() >= m.end():
                for end in range(m.start(), m.end()):
                    out.append(before + table_of_white[widths[end - begin] - 1])
                base += self.piece_counts[piece]
                continue
            table, width = self.tables[piece], 0
            quote = piece[0] == "'" and len(piece) > 1 and piece[1].isalpha()
            for k, c in enumerate(piece, 1):
                width += len(c.encode())
                if k == 1 and white:
                    out.append(before + table_of_white[widths[m.start() - begin] - 1])
                elif quote and 1 < k < len(piece):
                    out.append(base + self._plain(piece[:k]))
                else:
                    out.append(base + table[width - 1])
            base += table[-1]
        return base

    def longest_within(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        counts = self.prefix_counts(text)
        return max(i for i, n in enumerate(counts) if n <= budget)


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at a path, read once a process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(*read_ranks(path))
    CACHES["bpe"] = _LOADED.clear
    return _LOADED[path]
