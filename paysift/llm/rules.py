"""Quality rules by weak supervision: rules vote or abstain, EM learns how far to trust each, a posterior decides."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scale import materialise
from .common import Words, over_texts

WINDOW = 8
SYMBOLS = "[#*$%&|<>]"
MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_lines long, n_bare long, n_shouts long, n_echoes long, n_marked long")
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """Votes good where `good` holds, bad where `bad` holds (bad wins), else abstains; NULL conditions do not hold."""

    name: str
    good: str
    bad: str

    def vote(self) -> Column:
        """2 good, 1 bad, 0 abstains."""
        return F.expr(f"CASE WHEN {self.bad} THEN 1 WHEN {self.good} THEN 2 ELSE 0 END")


RULES = (
    Rule("length", "n_words >= 50", "n_words < 25"),
    Rule("word length", "word_chars BETWEEN 3 * n_words AND 9 * n_words AND n_words >= 20", "word_chars > 12 * n_words OR word_chars < 2 * n_words"),
    Rule("symbols", "20 * n_symbols <= n_words", "4 * n_symbols > n_words"),
    Rule("repeated lines", "n_lines >= 3 AND n_dup_lines = 0", "2 * n_dup_lines > n_lines"),
    Rule("repeated windows", "n_words >= 20 AND 50 * n_repeat_words <= n_words", "5 * n_repeat_words > n_words"),
    Rule("echoes", "n_words >= 20 AND 50 * n_echoes <= n_words", "8 * n_echoes > n_words"),
    Rule("shouting", "n_words >= 20 AND 50 * n_shouts <= n_words", "4 * n_shouts > n_words"),
    Rule("marked words", "n_words >= 20 AND 50 * n_marked <= n_words", "4 * n_marked > n_words"),
    Rule("bare marks", "n_words >= 20 AND 50 * n_bare <= n_words", "8 * n_bare > n_words"),
)


def measure(texts: pa.Array) -> dict[str, object]:
    """The counts of `MEASURES` for a batch of whole texts."""
    n, words = len(texts), Words(texts)
    per_text = lambda mask: np.bincount(words.doc, weights=mask[words.ids] if len(words.ids) else None, minlength=n).astype(np.int64)
    number = lambda values: values.to_numpy(zero_copy_only=False).astype(np.int64)
    test = lambda pattern: pc.match_substring_regex(words.names, pattern).to_numpy(zero_copy_only=False).astype(float)
    starts, equal = words.windows(WINDOW)
    order = np.lexsort((equal, words.doc[starts]))
    same = (np.diff(equal[order]) == 0) & (np.diff(words.doc[starts][order]) == 0) if len(order) else np.zeros(0, bool)
    again = np.zeros(len(starts), bool)
    if len(order):
        again[order[1:]] |= same
        again[order[:-1]] |= same
    cover = np.zeros(len(words.ids) + 1, np.int64)
    np.add.at(cover, starts[again], 1)
    np.add.at(cover, starts[again] + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0
    lines = pc.split_pattern(texts, "\n")
    flat = lines.flatten()
    line_doc = np.repeat(np.arange(n), number(pc.list_value_length(lines)))
    wordy = pc.match_substring_regex(flat, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False).astype(bool)
    codes, line_doc = number(flat.dictionary_encode().indices)[wordy], line_doc[wordy]
    n_lines = np.bincount(line_doc, minlength=n)
    distinct = np.unique(line_doc * np.int64(len(flat) + 1) + codes) // (len(flat) + 1) if len(codes) else np.zeros(0, np.int64)
    echo = np.zeros(len(words.ids), bool)
    if len(echo) > 1:
        echo[1:] = (words.ids[1:] == words.ids[:-1]) & (words.doc[1:] == words.doc[:-1])
    lengths = number(pc.utf8_length(words.names)) if len(words.names) else np.zeros(0, np.int64)
    return {"n_words": words.counts, "word_chars": per_text(lengths), "n_symbols": number(pc.count_substring_regex(texts, SYMBOLS)),
            "n_dup_lines": n_lines - np.bincount(distinct, minlength=n), "n_repeat_words": np.bincount(words.doc[covered], minlength=n),
            "n_lines": n_lines, "n_bare": per_text(1 - test(r"[\p{L}\p{N}]")), "n_shouts": per_text(test("!!")),
            "n_echoes": np.bincount(words.doc[echo], minlength=n), "n_marked": per_text(test(r"[#*$%&|<>]{2}"))}


@dataclass(frozen=True)
class VoteModel:
    """Class prior and, per rule, the chance of each vote (bad, good) given a bad and a good document, if it votes."""

    prior: float
    outcomes: np.ndarray  # rule, class (0 bad, 1 good), vote (0 bad, 1 good)

    def evidence(self) -> np.ndarray:
        """Log-odds that each outcome (abstains, bad, good) of each rule adds; abstaining adds none."""
        return np.insert(np.log(self.outcomes[:, 1]) - np.log(self.outcomes[:, 0]), 0, 0.0, axis=1)

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        return np.log(self.prior / (1 - self.prior)) + self.evidence()[np.arange(len(self.outcomes)), votes].sum(axis=1)

    def posterior(self, votes: Sequence[Column]) -> Column:
        """The probability of a good document, as an expression of its votes."""
        terms = [F.element_at(F.array(*[F.lit(float(x)) for x in row]), v + 1) for row, v in zip(self.evidence(), votes)]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(float(np.log(self.prior / (1 - self.prior)))))))


def fit_votes(votes: np.ndarray, weights: np.ndarray, prior: float = 0.85, rounds: int = 200, tolerance: float = 1e-9) -> VoteModel:
    """Expectation-maximisation over vote patterns and how often each occurs.

    Starts from rules that seldom call a good document bad and that each miss most bad ones, since a rule knows one fault.
    Pseudo-counts in proportion to the whole weight keep every chance above zero and results alike at every size.
    """
    rules, total = votes.shape[1], float(weights.sum())
    start = np.array([[0.27, 0.73], [0.002, 0.998]])
    model = VoteModel(prior, np.repeat(start[None], rules, axis=0))
    if not total:
        return model
    weights, before = weights / total, -np.inf
    pseudo = 0.01 * start
    for _ in range(rounds):
        good = 1 / (1 + np.exp(-model.log_odds(votes)))
        mass = np.stack([weights * (1 - good), weights * good], axis=1)
        outcomes = np.array([[[mass[votes[:, j] == v, c].sum() for v in (1, 2)] for c in (0, 1)] for j in range(rules)]) + pseudo
        model = VoteModel(float(np.clip(mass[:, 1].sum(), 0.01, 0.99)), outcomes / outcomes.sum(axis=2, keepdims=True))
        now = float(good @ weights)
        if abs(now - before) < tolerance:
            break
        before = now
    return model


def vote_patterns(measured: DataFrame, rules: Sequence[Rule]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct vote patterns and their counts: at most 3^rules rows reach the driver, whatever the input."""
    if len(rules) > 9:
        raise ValueError("more than nine rules would collect more than 20,000 patterns")
    code = reduce(lambda a, b: a * 3 + b, [r.vote() for r in rules], F.lit(0))
    rows = measured.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n")).collect()
    codes = np.array(sorted((r["code"], r["n"]) for r in rows), dtype=np.int64).reshape(-1, 2)
    votes = np.stack([codes[:, 0] // 3 ** (len(rules) - 1 - j) % 3 for j in range(len(rules))], axis=1)
    return votes, codes[:, 1].astype(float)


def judge_quality(df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts, base verdict, posterior and final verdict of every whole text.

    Rules vote from the counts of a text; EM over the vote patterns of all documents estimates their accuracies without
    labels; a document stays when its posterior is at least 0.5 and the base rule does not fail it.

    NULL and empty texts have counts of 0 and fail the base rule; equal texts get equal verdicts; an empty table gives an
    empty one; other columns are not read.
    """
    measured = materialise(over_texts(df, keep, text, MEASURES, measure))
    model = fit_votes(*vote_patterns(measured, rules))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    posterior = model.posterior([r.vote() for r in rules])
    return (measured.withColumn("posterior", posterior)
            .select(*keep, *BASE, failed.alias("base_failed"), (~failed & (F.col("posterior") >= 0.5)).alias("kept"), "posterior"))
