"""Exact merge-type (byte pair) encoding without a merge loop over the text.

A token sequence is the one that merging would give exactly when each two neighbours stay apart if just the two of
them are merged again. ``MergeTable.compatible`` answers that by re-merging a pair once and remembering it. Two
encoders build on it: ``MergeTable.backtrack`` walks forward over longest matches and steps back at dead ends,
``CountTransducer`` reads left to right, and its transitions carry the change in the number of tokens.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Callable

import ahocorasick

#: Entries a worker remembers of words, in each of two generations, and of pairs.
MEMORY = 600_000
#: Bytes that the keys and values of a generation may have, and those of a dictionary's slot: entries are not all short.
HELD_BYTES, SLOT = 100 << 20, 40


class Remembered(dict):
    """A mapping that forgets what has not been asked for since it last was full, by entries or by bytes; ``make`` fills gaps
    of short keys."""

    def __init__(self, make: Callable[[str], object], widest: int = 48, most_bytes: int | None = None):
        self.make, self.widest, self.most_bytes = make, widest, most_bytes or HELD_BYTES
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.older, self.held = {}, 0

    def __missing__(self, key: str):
        got = self.older.get(key)
        if got is None:
            got = self.make(key)
        if len(key) <= self.widest:
            if len(self) >= MEMORY or self.held >= self.most_bytes:
                self.older = {}  # goes before the copy is made
                self.older = dict(self)
                self.clear()
                self.held = 0
            self[key] = got
            self.held += sys.getsizeof(key) + sys.getsizeof(got) + SLOT
        return got


class MergeTable:
    """Vocabulary and merge order of one tokenizer. Symbols are strings; ``rank`` orders merges, lowest first."""

    def __init__(self, vocabulary: dict[str, int], rank: Callable[[str, str], float | None]):
        self.vocabulary, self.rank = vocabulary, rank
        self.automaton = ahocorasick.Automaton()
        for piece in vocabulary:
            self.automaton.add_word(piece[::-1], len(piece))
        self.automaton.make_automaton()
        #: For each way in the automaton the longest entry on it, and for each entry the next shorter one ('': none).
        self.longest: dict[str, str] = {}
        self.shorter: dict[str, str] = {}
        for piece in sorted(vocabulary, key=len):
            on_way = ""
            for n in range(1, len(piece) + 1):
                way = piece[:n]
                if way in vocabulary:
                    if n == len(piece):
                        self.shorter[way] = on_way
                    on_way = way
                self.longest.setdefault(way, on_way)
        self.own = {piece: piece for piece in vocabulary}
        self.forget()

    def forget(self) -> None:
        self.pairs: dict[str, dict[str, bool]] = defaultdict(dict)
        self.n_pairs = 0

    def merge(self, text: str) -> list[str]:
        """The plain merge loop: join the best-ranked neighbours, leftmost first, until none can be joined."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank(parts[i], parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, left: str, right: str) -> bool:
        known = self.pairs[left].get(right)
        return self.compatible(left, right) if known is None else known

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the two tokens' characters again gives just these two tokens."""
        if self.n_pairs >= 4 * MEMORY:
            self.pairs.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        known = self.merge(left + right) == [left, right]
        self.pairs[self.own.get(left, left)][self.own.get(right, right)] = known  # no copy of a piece is kept for each pair
        return known

    def longest_matches(self, text: str) -> list[int]:
        """Length of the longest entry that starts at each place (0: none), by one run of the automaton over the mirrored text."""
        out, n = [0] * len(text), len(text)
        for end, size in self.automaton.iter(text[::-1]):
            if size > out[n - 1 - end]:
                out[n - 1 - end] = size
        return out

    def backtrack(self, text: str) -> list[str]:
        """Longest matches first; a position from which no way leads on is marked in a bit field and never met again."""
        n, pairs, shorter, longest = len(text), self.pairs, self.shorter, self.longest_matches(text)
        failed, tokens, last, start, token = bytearray((n >> 3) + 1), [], "", 0, None
        while start < n:
            if token is None:
                token = text[start : start + (longest[start] or 1)]  # what no entry starts with stands for itself
            known = pairs[last] if last else None
            while token:
                end = start + len(token)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if not last:
                        break
                    ok = known.get(token)
                    if self.compatible(last, token) if ok is None else ok:
                        break
                token = shorter.get(token, "")
            if token:
                tokens.append(token)
                start += len(token)
                last, token = token, None
            elif not last:
                raise ValueError("the text has no encoding")
            else:
                failed[start >> 3] |= 1 << (start & 7)
                start -= len(last)
                token = shorter.get(tokens.pop(), "")
                last = tokens[-1] if tokens else ""
        return tokens


class CountTransducer:
    """Deterministic transducer from symbols to numbers of tokens, compiled as its transitions are first taken.

    A state is what the past can still do: the longest end of the text that an entry of the vocabulary begins with, the last
    token of the encoding up to each place in it, and how many tokens fewer there are up to there. Reading a symbol moves
    to the only token that ends there and agrees with the last token before it; the transition emits the difference to
    the count so far (negative, where merges swallow tokens). There are finitely many states; ``most`` of their transitions
    are kept, then compiling starts anew.
    """

    def __init__(self, table: MergeTable, most: int = 2_000_000):
        self.table, self.most = table, most
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = [("", ("",), (0,))]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.next: dict[tuple[int, str], tuple[int, int]] = {}

    def compile(self, state: int, symbol: str) -> tuple[int, int]:
        """(state, emitted count) behind one symbol."""
        way, last, fewer = self.states[state]
        table, text = self.table, way + symbol
        for k in range(len(text)):
            token = text[k:]
            if token in table.vocabulary and (not last[k] or table.agree(last[k], token)):
                break
        else:
            raise ValueError("a symbol is not in the vocabulary, or the text has no encoding")
        emitted = fewer[k] + 1
        last, fewer = (*last, token), (*fewer, emitted)
        k = next((k for k in range(len(text)) if text[k:] in table.longest), len(text))
        to = (text[k:], last[k:], tuple(n - emitted for n in fewer[k:]))
        number = self.number.setdefault(to, len(self.states))
        if number == len(self.states):
            self.states.append(to)
        self.next[state, symbol] = number, emitted
        return number, emitted

    def count(self, text: str) -> int:
        if len(self.next) > self.most:
            self.reset()
        state, total, known = 0, 0, self.next
        for symbol in text:
            state, emitted = known.get((state, symbol)) or self.compile(state, symbol)
            total += emitted
        return total
