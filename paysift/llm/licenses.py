"""Licence scan: templates in markup become token automata that accept texts with the exact mandatory wording."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import over_texts
from .license_templates import PHRASES, TEMPLATES

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MARK = re.compile(r"<<(beginOptional|endOptional|var;.*?)>>")
ANY = re.compile(r"\.\{(\d+),(\d+)\}")
COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches string"


def tokens(text: str) -> list[bytes]:
    """Words of the text in lower case (A-Z only): runs of digits, a-z and characters beyond ASCII."""
    return WORD.findall(text.encode().lower())


class Automaton:
    """A template as a token automaton: states are numbers, `step` maps a state and a word to states, `wild` takes any word.

    Optional regions add empty moves past them; replaceable regions become parallel wordings or a chain of `wild`
    states.  Empty moves are closed at compile time, so a scan only follows words.
    """

    def __init__(self, markup: str):
        self.step: list[dict[bytes, set[int]]] = [{}]
        self.wild: list[set[int]] = [set()]
        self._empty: list[set[int]] = [set()]
        self.mandatory: set[bytes] = set()
        end = self._compile(MARK.split(markup))
        closures = [self._closure({s}) for s in range(len(self.step))]
        self.final = [end in c for c in closures]
        self.closed = closures
        self.first = {w for s in closures[0] for w in self.step[s]}
        if self.final[0] or any(self.wild[s] for s in closures[0]):
            raise ValueError("a template must begin with wording of its own")

    def _state(self) -> int:
        self.step.append({})
        self.wild.append(set())
        self._empty.append(set())
        return len(self.step) - 1

    def _words(self, at: int, words: Sequence[bytes]) -> int:
        for word in words:
            after = self._state()
            self.step[at].setdefault(word, set()).add(after)
            at = after
        return at

    def _compile(self, parts: list[str]) -> int:
        at, opened = 0, []
        for i, part in enumerate(parts):
            if i % 2 == 0:  # plain wording
                words = tokens(part)
                at = self._words(at, words)
                if not opened:
                    self.mandatory.update(words)
            elif part == "beginOptional":
                opened.append(at)
            elif part == "endOptional":
                after = self._state()
                self._empty[opened.pop()].add(after)
                self._empty[at].add(after)
                at = after
            else:
                match = re.search(r'match="([^"]*)"', part).group(1)
                after = self._state()
                if bounds := ANY.fullmatch(match):
                    least, most = int(bounds[1]), int(bounds[2])
                    for n in range(most + 1):
                        if n >= least:
                            self._empty[at].add(after)
                        if n < most:
                            chained = self._state()
                            self.wild[at].add(chained)
                            at = chained
                else:
                    for wording in match.split("|"):
                        self._empty[self._words(at, tokens(wording))].add(after)
                at = after
        if opened:
            raise ValueError("an optional region is not closed")
        return at

    def _closure(self, states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self._empty[todo.pop()] - seen:
                seen.add(nxt)
                todo.append(nxt)
        return frozenset(seen)

    def longest(self, words: Sequence[bytes], start: int) -> int | None:
        """End of the longest accepted run of words from `start`, None if none is accepted."""
        states, end = self.closed[0], None
        for at in range(start, len(words)):
            reached: set[int] = set()
            for s in states:
                reached |= self.step[s].get(words[at], frozenset())
                reached |= self.wild[s]
            if not reached:
                break
            states = frozenset().union(*(self.closed[s] for s in reached))
            if any(self.final[s] for s in reached):
                end = at + 1
        return end

    def matches(self, words: Sequence[bytes], present: set[bytes]) -> list[tuple[int, int]]:
        """Leftmost longest runs without overlap.  A text that lacks a mandatory word cannot match."""
        if not self.mandatory <= present:
            return []
        found, at = [], 0
        while at < len(words):
            if words[at] in self.first and (end := self.longest(words, at)) is not None:
                found.append((at, end))
                at = end
            else:
                at += 1
        return found


def scan_text(text: str, automata: Sequence[tuple[str, Automaton]], phrases: Sequence[tuple[list[bytes], str]]) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, matches) of one whole text."""
    words = tokens(text)
    present = set(words)
    places = []
    for phrase, label in phrases:
        if present.issuperset(phrase):
            size = len(phrase)
            places += [(i, label) for i, w in enumerate(words) if w == phrase[0] and words[i:i + size] == phrase]
    accepted = [(start, end, label) for label, automaton in automata for start, end in automaton.matches(words, present)]
    base = {label for _, label in places}
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {label for *_, label in accepted})), 1.0 if accepted else 0.5 if places else 0.0,
            ",".join(f"{label}:{start}:{end}" for start, end, label in sorted(accepted)))


def scan_licenses(df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text",
                  templates: Sequence[tuple[str, str]] = tuple(TEMPLATES), phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """Licence labels of every whole text.

    A phrase counts wherever its words stand consecutively.  A template counts where its automaton accepts the words:
    mandatory wording exactly (case, punctuation and layout aside), optional regions there or not, replaceable regions
    within their bounds.  `score` is 1 for an accepted template, 0.5 for a phrase alone, else 0; `matches` lists the
    accepted runs as label:start:end in words.

    NULL and empty texts have no words, empty labels and score 0; rows are independent, so repeated rows give repeated
    results and an empty table gives an empty one; other columns are not read.
    """
    phrases, templates = dict(phrases), list(templates)

    def work(texts: pa.Array) -> dict[str, object]:
        automata = [(label, Automaton(markup)) for label, markup in templates]
        wanted = [(tokens(phrase), label) for phrase, label in phrases.items()]
        rows = [scan_text(t, automata, wanted) for t in texts.to_pylist()]
        made = list(zip(*rows))
        return {name: pa.array(values, kind) for name, values, kind in zip(
            ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"], made,
            [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string()])}

    return over_texts(df, keep, text, COLUMNS, work)
