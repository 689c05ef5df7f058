"""Token counts without the tokens: one pass of dynamic programming over the vocabulary's matches in a text.

An Aho-Corasick automaton enumerates the matches by their ends; what is carried from place to place is the number of
pieces and what the tokenizer's own rule needs to choose between the matches that end there.

* Unigram vocabularies (count-only Viterbi): the best score is carried; a later start replaces an earlier one only if its
  score is higher, which is the tokenizer's rule for ties.
* BPE vocabularies: the last piece is carried. Of the matches that end at a place exactly one follows from the text up to
  there: the one that stays apart from the last piece before it when both are tokenized together. Merges go by the
  highest score and, among equal ones, by the leftmost place.

A text is searched word by word, and words are remembered, if that can't change the result: no piece may go on across the
start of a word, and sums of scores must be exact.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Words remembered in a task, none of them longer than so many characters; a memory is emptied when full.
_KNOWN, _LONG = 300_000, 64
_NEVER = float("-inf")


@dataclass
class Counter:
    """``vocabulary`` has (piece, score) pairs. With ``byte_fallback`` a character that no piece covers counts as its UTF-8
    bytes, else a run of such characters counts as one piece. A space is put in front of a text: with ``always`` of every
    one, else of those that don't start with one."""

    vocabulary: list[tuple[str, float]]
    byte_fallback: bool = True
    always: bool = False
    known: dict[str, int] = field(default_factory=dict)
    automaton: object = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}, "automaton": None}

    def __post_init__(self) -> None:
        # a piece may start with spaces but not hold one after anything else
        self.by_word = self.byte_fallback and not any(SPACE in p.lstrip(SPACE) for p, _ in self.vocabulary)

    def _build(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in self.vocabulary:
            if piece:
                self.automaton.add_word(piece, self._entry(piece, score))
        self.automaton.make_automaton()

    def _entry(self, piece: str, score: float) -> tuple:
        return piece, len(piece)

    def search(self, text: str) -> int:
        """Pieces of one stretch of text, in which spaces are already ``SPACE``."""
        raise NotImplementedError

    def _unknown(self, char: str, after_unknown: bool) -> int:
        return len(char.encode("utf-8", "surrogatepass")) if self.byte_fallback else 0 if after_unknown else 1

    def count(self, text: str | None) -> int:
        """Pieces of a text; null and empty: 0."""
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        if self.always or text[0] != SPACE:
            text = SPACE + text
        if not self.by_word:
            return self.search(text)
        total, known = 0, self.known
        for word in _SEGMENT.findall(text):
            n = known.get(word)
            if n is None:
                n = self.search(word)
                if len(word) <= _LONG:
                    if len(known) >= _KNOWN:
                        known.clear()
                    known[word] = n
            total += n
        return total


@dataclass
class UnigramCounter(Counter):
    """Counts on the path of the highest total score."""

    penalty: float = 10.0
    single: set[str] = field(default_factory=set)

    def __post_init__(self) -> None:
        super().__post_init__()
        scores = [s for _, s in self.vocabulary]
        self.unknown_score = min(scores, default=0.0) - self.penalty
        self.single = {p for p, _ in self.vocabulary if len(p) == 1}
        self.by_word = self.by_word and all(float(s).is_integer() for s in scores)

    def _entry(self, piece: str, score: float) -> tuple:
        return len(piece), score

    def search(self, text: str) -> int:
        if self.automaton is None:
            self._build()
        n = len(text)
        best, count, covered = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.automaton.iter(text)
        match = next(matches, None)
        for end in range(1, n + 1):
            top, pieces, unk = None, 0, False
            while match is not None and match[0] == end - 1:  # longest first
                length, score = match[1]
                start = end - length
                reached = score + best[start]
                if top is None or reached > top:
                    top, pieces = reached, count[start] + 1
                match = next(matches, None)
            char = text[end - 1]
            if char not in self.single:
                reached = self.unknown_score + best[end - 1]
                if top is None or reached > top:
                    unk, top, pieces = True, reached, count[end - 1] + self._unknown(char, covered[end - 1])
            best[end], count[end], covered[end] = top, pieces, unk
        return count[n]


@dataclass
class MergeCounter(Counter):
    """Counts the pieces that merging the best-scored neighbours again and again ends with."""

    scores: dict[str, float] = field(default_factory=dict)
    pairs: dict[tuple[str, str], bool] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return super().__getstate__() | {"pairs": {}}

    def __post_init__(self) -> None:
        super().__post_init__()
        self.scores = dict(self.vocabulary)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text, merge by merge."""
        parts, score = list(text), self.scores.get
        found = [score(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while found and (best := max(found)) != _NEVER:
            k = found.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del found[k]
            if k:
                found[k - 1] = score(parts[k - 1] + parts[k], _NEVER)
            if k < len(found):
                found[k] = score(parts[k] + parts[k + 1], _NEVER)
        return parts

    def apart(self, last: str, piece: str) -> bool:
        """Whether ``piece`` is a piece after ``last`` (empty at a start): both come out of the two together."""
        key = (last, piece)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= _KNOWN:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(last + piece) == ([last, piece] if last else [piece])
        return found

    def search(self, text: str) -> int:
        if self.automaton is None:
            self._build()
        pairs, scores = self.pairs, self.scores
        last, count = [""] * (len(text) + 1), [0] * (len(text) + 1)
        done = 0  # up to here the last pieces are known

        def unknown(end: int) -> None:  # a character that no piece covers stays one symbol
            char, before = text[end - 1], last[end - 1]
            last[end], count[end] = char, count[end - 1] + self._unknown(char, len(before) == 1 and before not in scores)

        for place, (piece, size) in self.automaton.iter(text):
            end = place + 1
            if end == done:
                continue
            while done < place:
                done += 1
                unknown(done)
            start = end - size
            before = last[start]
            fits = pairs.get((before, piece))
            if fits if fits is not None else self.apart(before, piece):
                last[end], count[end], done = piece, count[start] + 1, end
        while done < len(text):
            done += 1
            unknown(done)
        return count[-1]


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message: numbers, and values as integers or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
            yield key >> 3, data[at : at + size]
            at += size


def counter_for(path: str) -> Counter:
    """The counter for a SentencePiece file, by the kind of model that it says it is.

    Control, unknown and byte pieces match no text, as in the tokenizer. Files whose rules are not those above are
    refused: other kinds of models, texts that are normalized, pieces defined by the user, unused pieces."""
    with open(path, "rb") as f:
        top = list(_fields(f.read()))
    part = lambda n: dict(_fields(next((v for k, v in top if k == n), b"")))
    trainer, normalizer = part(2), part(3)
    vocabulary, kinds = [], set()
    for number, value in top:
        if number == 1:
            piece = dict(_fields(value))
            kinds.add(kind := piece.get(3, 1))
            if kind == 1:
                vocabulary.append((piece[1].decode("utf-8"), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]))
    # fixed values of the format: models 1 unigram, 2 BPE; pieces 1 normal, 2 unknown, 3 control, 4 user's, 5 unused, 6 byte
    model = {1: UnigramCounter, 2: MergeCounter}.get(trainer.get(3, 1))
    if model is None or kinds & {4, 5} or trainer.get(24, 0) or normalizer.get(2, b"") or normalizer.get(4, 1) or not normalizer.get(5, 1) or not normalizer.get(3, 1):
        raise ValueError(f"tokens of {path} can't be counted: unigram and BPE files without normalization, user-defined and unused pieces can")
    return model(vocabulary, byte_fallback=bool(trainer.get(35, 0)), always=True)


def token_count(counter: Counter, text: Column) -> Column:
    """Tokens of each whole text, as a long; 0 for null and empty texts. Ties are the tokenizer's; a text's count depends on
    the text alone, so repeated rows agree, and other columns play no part."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([counter.count(t) for t in texts], np.int64))

    return count(text)
