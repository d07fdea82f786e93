"""Finding vocabulary items in texts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.values import share
from ..scale import col, md5_number, top_per_key, with_row

# A matcher's spellings travel with every task, so their size is checked; larger vocabularies use `match_terms`.
MATCHER_BYTES = 64 << 20
RUN = re.compile("[a-z0-9]+")


def spelling_words(form: str) -> list[str]:
    """Words of a spelling; between them a text may have blanks, hyphens or nothing."""
    return [w for w in re.split(r"[\s\-]+", form) if w]


def spelling_pattern(forms: Sequence[str]) -> str:
    """The regex of `functions.text.form_pattern`."""
    escape = lambda word: re.sub(r"([^a-z0-9])", r"\\\1", word)
    return "(?<![a-z0-9])(?:" + "|".join(r"[\s\-]*".join(map(escape, spelling_words(f))) for f in forms) + ")(?![a-z0-9])"


def alternatives(pattern: str) -> list[str]:
    """A pattern cut at its outermost bars."""
    parts, depth, inside, at, start = [], 0, False, 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 1
        elif inside:
            inside = c != "]"
        elif c == "[":
            inside = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and not depth:
            parts.append(pattern[start:at])
            start = at + 1
        at += 1
    return [*parts, pattern[start:]]


def anchors(pattern: str) -> set[str] | None:
    """Letter runs of which every match of the pattern holds at least one; None if the pattern does not tell."""
    found: set[str] = set()
    for part in alternatives(pattern):
        bare = re.sub(r"\[[^\]]*\][?*+]?(?:\{[^}]*\})?\??|\\.[?*+]?", "\0", re.sub(r"\(\?(?:<!|!|<=|=)(?:\[[^\]]*\]|[^()])*\)", "\0", part))
        outer, groups, depth, start = "", [], 0, 0
        for at, c in enumerate(bare):
            if c == "(":
                if not depth:
                    start, outer = at, outer + "\0"
                depth += 1
            elif c == ")":
                depth -= 1
                if not depth and bare[at + 1:at + 2] not in ("?", "*", "{"):
                    groups.append(bare[start + 1:at].removeprefix("?:"))
            elif not depth:
                outer += c
        runs = re.findall(r"[a-z0-9]{2,}", re.sub(r".[?*]|.\{[^}]*\}", "\0", outer))
        options = [{max(runs, key=len)}] if runs else [a for a in map(anchors, groups) if a]
        if not options:
            return None
        found |= max(options, key=lambda own: min(map(len, own)))
    return found


def spelt_in(words: Sequence[str], runs: set[str]) -> bool:
    """Whether some way to join neighbouring words of a spelling gives only letter runs of the text."""
    reached = {0}
    for end in range(1, len(words) + 1):
        if any(start in reached and all(run in runs for run in RUN.findall("".join(words[start:end]))) for start in range(end)):
            reached.add(end)
    return len(words) in reached


class PhraseMatcher:
    """Matcher for one text: nested phrases first, longest first, each blanked once found.

    Spellings are indexed by the letter runs they may begin with.  One pass over a text gives its runs; a spelling of one run
    is found by that alone, and one of several words is searched for only where its runs, with joints or without, are all
    there.  Patterns that are not made from spellings run where a trie (Aho-Corasick) finds one of their anchors.
    """

    def __init__(self, entries: Sequence[tuple[str, str, Sequence[str]]], exclusions: Mapping[str, str]):
        self.entries = [(skill, pattern, tuple(forms or ())) for skill, pattern, forms in entries]
        self.exclusions = dict(exclusions)
        self._ready = None

    def __getstate__(self):
        return {**self.__dict__, "_ready": None}

    def _prepare(self):
        begins, anchored, always = {}, {}, []
        for skill, pattern, forms in self.entries:
            if forms and all(map(spelling_words, forms)) and pattern == spelling_pattern(forms):
                for form in forms:
                    words = tuple(spelling_words(form))
                    if not RUN.search(words[0]):
                        always.append(skill)
                        continue
                    for i in range(1, len(words) + 1):
                        lead = RUN.search("".join(words[:i])).group()
                        begins.setdefault(lead, set()).add((skill, words))
            elif marks := anchors(pattern):
                for mark in marks:
                    anchored.setdefault(mark, []).append(skill)
            else:
                always.append(skill)
        trie = ahocorasick.Automaton()
        for mark, skills in anchored.items():
            trie.add_word(mark, skills)
        if len(trie):
            trie.make_automaton()
        self._ready = {"begins": begins, "trie": trie, "always": list(dict.fromkeys(always)), "patterns": {skill: pattern for skill, pattern, _ in self.entries}, "compiled": {}}
        longest, nested = {}, set()
        for skill, _, forms in self.entries:
            longest[skill] = max(map(len, forms), default=0)
            if any(other != skill for form in forms for other in self.hits(form)):
                nested.add(skill)
        order = sorted((skill for skill, _, _ in self.entries if skill in nested), key=lambda s: -longest[s])
        self._ready |= {"nested": order, "place": {s: i for i, s in enumerate(order)}}
        return self._ready

    def _state(self) -> dict:
        return self._ready or self._prepare()

    @property
    def nested(self) -> list[str]:
        """Skills whose spelling contains another skill, in matching order."""
        return self._state()["nested"]

    def regex(self, skill: str) -> re.Pattern:
        compiled = self._state()["compiled"]
        if skill not in compiled:
            compiled[skill] = re.compile(self._state()["patterns"][skill])
        return compiled[skill]

    def hits(self, text: str) -> set[str]:
        """Skills whose pattern the (lower-case) text holds."""
        state, runs = self._ready, set(RUN.findall(text))
        found, tried = set(), set(state["always"])
        for run in runs & state["begins"].keys():
            for skill, words in state["begins"][run]:
                if len(words) == 1 and words[0] == run:
                    found.add(skill)
                elif spelt_in(words, runs):
                    tried.add(skill)
        if len(state["trie"]):
            for _, skills in state["trie"].iter(text):
                tried.update(skills)
        return found | {skill for skill in tried - found if self.regex(skill).search(text)}

    def match(self, text: str | None) -> list[str]:
        """Matched skills in vocabulary order."""
        state, text, found, done = self._state(), (text or "").lower(), set(), -1
        occurs = lambda skill: skill not in self.exclusions or self.regex(skill).search(re.sub(self.exclusions[skill], " ", text)) is not None
        held = self.hits(text)
        while later := [place for s in held if (place := state["place"].get(s, -1)) > done]:
            done = min(later)
            skill = state["nested"][done]
            if occurs(skill):
                found.add(skill)
            text, blanked = self.regex(skill).subn(" ", text)
            held = self.hits(text) if blanked else held
        found.update(skill for skill in held if skill not in state["place"] and occurs(skill))
        return [skill for skill, _, _ in self.entries if skill in found]


def matcher_from(vocabulary: DataFrame, exclusions: Mapping[str, str] = K.EXCLUSION_PHRASES) -> PhraseMatcher:
    """Collect a vocabulary (skill, pattern, forms, position) of checked size into a matcher."""
    listed = vocabulary.select("skill", "pattern", "forms", "position")
    size = listed.agg(F.sum(F.length("skill") + F.length("pattern") + F.length(F.array_join(F.coalesce("forms", F.array()), ";")))).first()[0] or 0
    if size > MATCHER_BYTES:
        raise ValueError(f"a vocabulary of {size} characters; use match_terms")
    rows = sorted(listed.collect(), key=lambda r: r["position"])
    return PhraseMatcher([(r["skill"], r["pattern"], r["forms"]) for r in rows], exclusions)


def match_skills(df: DataFrame, text: Column | str, matcher: PhraseMatcher, into: str = "matched_skills") -> DataFrame:
    """Add the list of matched skills per row (Arrow batches, one index of the spellings per worker)."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def matched(texts: pd.Series) -> pd.Series:
        return texts.map(matcher.match)

    return df.withColumn(into, matched(col(text)))


def posting_text(description: Column | str, extra: Column | str | None = None) -> Column:
    """Description and optional skill text as one string."""
    first = F.coalesce(col(description), F.lit(""))
    return F.concat(first, F.lit(" "), F.coalesce(col(extra), F.lit("")) if extra is not None else F.lit(""))


TOKEN = r"[\p{L}\p{N}+#]+"


def match_terms(df: DataFrame, id: str, text: Column | str, terms: DataFrame, form: str = "form", term: str = "term",
                max_words: int | None = None) -> DataFrame:
    """Distinct (id, term) found by joining words to the first words of spellings; for plain vocabularies of any size.

    A match inside a longer match does not count.  Spellings are words joined by one blank, of any length unless `max_words`
    says otherwise.  Every word goes with as many of its followers as the longest spelling has; the rest of a spelling is
    compared in the row, where its first word was met.
    """
    longest = max_words or terms.agg(F.max(F.size(F.split(form, " ")))).first()[0] or 1
    spelt = terms.select(F.split(form, " ").alias("words"), F.col(term).alias("term")).distinct().filter(F.size("words") <= longest)
    first = spelt.select(F.element_at("words", 1).alias("word"), "words", "term")
    tokens = df.select(id, F.regexp_extract_all(F.lower(col(text)), F.lit(TOKEN), F.lit(0)).alias("w"))
    placed = tokens.select(id, "w", F.posexplode("w").alias("at", "word")).select(id, "at", "word", F.slice("w", F.col("at") + 1, longest).alias("run"))
    hits = (placed.join(first, "word").filter(F.slice("run", 1, F.size("words")) == F.col("words"))
            .select(id, "at", F.size("words").alias("n"), "term").withColumn("end", F.col("at") + F.col("n")))
    # In order of start and falling length, a match is covered when an earlier, longer one reaches as far.
    earlier = (Window.partitionBy(id).orderBy("at", F.col("n").desc(), "term")
               .rowsBetween(Window.unboundedPreceding, -1))
    reach = F.max(F.struct("end", "n")).over(earlier)
    covered = F.coalesce((reach["end"] > F.col("end")) | ((reach["end"] == F.col("end")) & (reach["n"] > F.col("n"))),
                         F.lit(False))
    return hits.withColumn("__covered", covered).filter(~F.col("__covered")).select(id, "term").distinct()


def extraction_comparison(df: DataFrame, text: str, skill: str, baseline: PhraseMatcher, proposed: PhraseMatcher) -> DataFrame:
    """Whether the row's skill is matched by the baseline and by the proposed rules."""
    both = match_skills(match_skills(df, text, baseline, "__b"), text, proposed, "__p")
    return (both.withColumn("baseline", F.array_contains("__b", F.col(skill)))
            .withColumn("proposed", F.array_contains("__p", F.col(skill))).drop("__b", "__p"))


def merged_exclusions(base: Mapping[str, str], more: Mapping[str, str]) -> dict[str, str]:
    """Exclusions of both sets; phrases of a shared skill are alternatives."""
    return {**base, **{s: f"(?:{base[s]})|(?:{p})" if s in base else p for s, p in more.items()}}


def label_scores(df: DataFrame, label: str, predicted: str, skill: str | None = None) -> DataFrame:
    """tp, fp, fn, tn, precision and recall overall ('all') and per skill; unlabelled rows are ignored."""
    known = df.filter(F.col(label).isNotNull())
    rows = known.withColumn("__s", F.explode(F.array(F.lit("all"), F.col(skill)) if skill else F.array(F.lit("all"))))
    y, p = F.col(label), F.col(predicted)
    counts = rows.groupBy(F.col("__s").alias("skill")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    return counts.withColumns({"precision": share("tp", F.col("tp") + F.col("fp")),
                               "recall": share("tp", F.col("tp") + F.col("fn"))})


def rank_for_display(df: DataFrame, items: str, vocabulary: DataFrame, last: Sequence[str] = ()) -> DataFrame:
    """Reorder each list: technical first, then the rarest; the `last` skills at the end.

    The vocabulary goes along as one map, so lists need no shuffle.
    """
    entry = F.struct(F.when(F.col("skill").isin(list(last)), 1).otherwise(0).alias("late"),
                     F.when(F.col("forced"), 0).otherwise(1).alias("plain"), F.col("job_count").alias("n"))
    listed = with_row(df, vocabulary.agg(F.map_from_entries(F.collect_list(F.struct("skill", entry))).alias("__table")))
    default = F.struct(F.lit(0).alias("late"), F.lit(1).alias("plain"), F.lit(0).cast("bigint").alias("n"))
    keyed = F.transform(items, lambda s, i: F.struct(F.coalesce(F.try_element_at("__table", s), default).alias("k"),
                                                     i.alias("i"), s.alias("s")))
    return listed.withColumn(items, F.transform(F.array_sort(keyed), lambda x: x["s"])).drop("__table")


def coverage(df: DataFrame, items: str, technical: Sequence[str]) -> DataFrame:
    """Postings, mean list length, shares with any item and with a technical one."""
    n = F.size(items)
    wanted = F.array(*[F.lit(t) for t in technical]) if technical else F.array().cast("array<string>")
    return df.agg(F.count(F.lit(1)).alias("postings"), F.avg(n).alias("mean_items"),
                  F.avg((n > 0).cast("int")).alias("share_any"),
                  F.avg(F.arrays_overlap(items, wanted).cast("int")).alias("share_technical"))


def never_matched(df: DataFrame, items: str, vocabulary: DataFrame, skill: str = "skill") -> DataFrame:
    """Vocabulary entries no posting uses."""
    used = df.select(F.explode(items).alias(skill)).distinct()
    return vocabulary.select(skill).join(used, skill, "left_anti")


def context_audit(df: DataFrame, id: str, text: str, items: str, patterns: DataFrame, top: int = 40, samples: int = 5,
                  width: int = 70, seed: int | str = 42) -> DataFrame:
    """Keyword-in-context snippets: `samples` random postings for each of the `top` most frequent items.

    Postings are drawn first, so the regex runs on the drawn texts only.
    """
    exploded = df.select(id, F.explode(F.array_distinct(items)).alias("skill"))
    frequent = (exploded.groupBy("skill").agg(F.count(F.lit(1)).alias("jobs"))
                .orderBy(F.col("jobs").desc(), "skill").limit(top))
    drawn = top_per_key(exploded.join(frequent, "skill"), ["skill"], [md5_number(id, "skill", F.lit(seed)), F.col(id)], samples)
    texts = drawn.join(df.select(id, F.lower(text).alias("__t")), id).join(patterns.select("skill", "pattern"), "skill")
    snippet = F.regexp_substr("__t", F.concat(F.lit(f"(?s).{{0,{width}}}(?:"), F.col("pattern"), F.lit(f").{{0,{width}}}")))
    return texts.select("skill", "jobs", id, snippet.alias("snippet"))


def neighbour_words(df: DataFrame, text: str, word: str) -> DataFrame:
    """How often each word stands directly before or after a word."""
    tokens = F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0))
    around = df.select(tokens.alias("w")).select(F.explode(F.flatten(F.transform("w", lambda x, i: F.when(x == word, F.array(
        F.struct(F.lit("before").alias("side"), F.get("w", i - 1).alias("word")),
        F.struct(F.lit("after").alias("side"), F.get("w", i + 1).alias("word")))).otherwise(
            F.array().cast("array<struct<side:string,word:string>>"))))).alias("e"))
    return around.filter(F.col("e.word").isNotNull()).groupBy("e.side", "e.word").agg(F.count(F.lit(1)).alias("n"))


def match_changes(before: DataFrame, after: DataFrame, id: str, items: str) -> DataFrame:
    """Per item: postings before and after, dropped and added."""
    a = before.select(id, F.explode(F.array_distinct(items)).alias("skill"), F.lit(1).alias("b"))
    b = after.select(id, F.explode(F.array_distinct(items)).alias("skill"), F.lit(1).alias("a"))
    return a.join(b, [id, "skill"], "full_outer").groupBy("skill").agg(
        F.count("b").alias("before"), F.count("a").alias("after"),
        F.count_if(F.col("a").isNull()).alias("dropped"), F.count_if(F.col("b").isNull()).alias("added"))
