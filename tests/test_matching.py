"""Vocabulary and text matching on literal cases."""

import random
import re
import time

from paysift import constants as K
from paysift.operators import matching as m
from paysift.operators import vocabulary as v


def vocabulary(spark, skills, overrides=None):
    rows = [(s, [s, *K.EXTRA_FORMS.get(s, [])], i) for i, s in enumerate(skills)]
    return v.with_patterns(spark.createDataFrame(rows, "skill string, forms array<string>, position int"), overrides)


def found(spark, skills, texts, exclusions=K.EXCLUSION_PHRASES):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r["matched_skills"] for r in m.match_skills(df, "t", m.matcher_from(vocabulary(spark, skills), exclusions)).collect()]


def test_fixed_senses(spark):
    cases = [("driving", "must have a clean driving record", True), ("driving", "driving sales results", False), ("organization", "strong organizational skills", True),
             ("organization", "our organization is growing", False), ("supervision", "supervision of staff", True), ("supervision", "works under general supervision", False),
             ("security", "network security", True), ("security", "social security number", False), ("reporting", "financial reporting", True), ("reporting", "reporting to the manager", False),
             ("excel", "excel and word", True), ("excel", "you excel at sales", False), ("r", "python, r", True), ("r", "r & d", False), ("go", "go to market", False), ("c++", "uses C++.", True)]
    skills = sorted({s for s, _, _ in cases})
    for (skill, text, expected), got in zip(cases, found(spark, skills, [t for _, t, _ in cases])):
        assert (skill in got) is expected, (skill, text)


def test_nested_phrases_are_blanked(spark):
    got = found(spark, ["management", "project management"], ["project management", "project management and staff management", "Project-Management", None])
    assert got == [["project management"], ["management", "project management"], ["project management"], []]


class PlainMatcher:
    """Every pattern over every text, as the matcher is defined."""

    def __init__(self, entries, exclusions):
        self.entries, self.regex = entries, {s: re.compile(p) for s, p, _ in entries}
        self.excluded = {s: re.compile(p) for s, p in exclusions.items()}
        self.nested = [s for s, _, forms in entries if any(o != s and r.search(f) for o, r in self.regex.items() for f in forms)]
        longest = {s: max(map(len, forms)) for s, _, forms in entries}
        self.nested.sort(key=lambda s: -longest[s])

    def match(self, text):
        text, found = (text or "").lower(), set()
        occurs = lambda s: bool(self.regex[s].search(self.excluded[s].sub(" ", text) if s in self.excluded else text))
        for s in self.nested:
            found |= {s} if occurs(s) else set()
            text = self.regex[s].sub(" ", text)
        found |= {s for s in self.regex if s not in self.nested and occurs(s)}
        return [s for s, _, _ in self.entries if s in found]


def test_trie_agrees_with_every_pattern_over_every_text():
    rng = random.Random(6)
    words = ["a", "b", "ab", "data", "c++", "c#", "r", "go", "rust", "base", "database", "x1", "node.js", "ba", "é"]
    skills = {" ".join(rng.choices(words, k=rng.randrange(1, 4))) for _ in range(60)} | set(K.SENSE_PATTERNS) | set(K.EXCLUSION_PHRASES)
    entries = [(s, K.SENSE_PATTERNS.get(s) or m.spelling_pattern(forms), forms) for s in sorted(skills) for forms in [[s, *(["-".join(reversed(s.split()))] if rng.random() < 0.3 else [])]]]
    trie, plain = m.PhraseMatcher(entries, K.EXCLUSION_PHRASES), PlainMatcher(entries, K.EXCLUSION_PHRASES)
    assert trie.nested == plain.nested
    more = ["python", "or", "and", "apache", "spark", "driving", "record", "truck", "social", "security", "to", "excel", "strong", "organization", "skills", "golang", ".", ",", "under", "supervision", "reporting", "hugging face", "transformers"]
    joints = [" ", " ", "-", "", "\u00a0", "\n", " - ", ", "]
    for _ in range(1500):
        text = "".join(rng.choice(words + more).upper() + rng.choice(joints) for _ in range(rng.randrange(0, 14)))
        assert trie.match(text) == plain.match(text), text
    assert trie.match(None) == []


def test_anchors_are_in_every_match():
    rng = random.Random(2)
    for skill, pattern in K.SENSE_PATTERNS.items():
        assert (marks := m.anchors(pattern)) or skill == "r", skill
    assert m.anchors("(?:ab|cd)?x") is None and m.anchors("(?:abc|de)f{2}") == {"abc", "de"} and m.anchors("[abc]") is None
    assert m.anchors(r"colou?rs|(?<![a-z])gr[ae]y(?:ish)?") == {"colo", "gr"}


def test_fifty_thousand_spellings(spark):
    rng = random.Random(9)
    names = sorted({" ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(rng.randrange(1, 4))) for _ in range(50_000)})
    entries = [(s, m.spelling_pattern([s]), [s]) for s in names]
    matcher, start = m.PhraseMatcher(entries, {}), time.perf_counter()
    texts = [" ".join(rng.choices(names, k=30)) for _ in range(100)]
    found = [matcher.match(t) for t in texts]
    assert all(len(f) >= 20 for f in found) and time.perf_counter() - start < 60


def test_spellings_of_forced_skills(spark):
    assert found(spark, ["kubernetes", "nlp"], ["we use k8s and natural  language processing"]) == [["kubernetes", "nlp"]]


def test_terms_agree_with_the_matcher_on_plain_phrases(spark):
    skills = ["management", "project management", "data", "big data project"]
    texts = ["project management", "big data project management data", "data management, big data", "none"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    terms = spark.createDataFrame([(s, s) for s in skills], "form string, term string")
    got = {}
    for row in m.match_terms(df, "id", "t", terms).collect():
        got.setdefault(row["id"], set()).add(row["term"])
    assert got == {0: {"project management"}, 1: {"big data project", "project management", "data"}, 2: {"data", "management"}}
    assert {(r["id"], r["term"]) for r in m.match_terms(df, "id", "t", terms, max_words=1).collect()} == {(0, "management"), (1, "management"), (1, "data"), (2, "data"), (2, "management")}


def test_vocabulary_merges_spellings_and_forces_skills(spark):
    rows = [["problem solving"], ["problemsolving"], ["* problem solving."], ["401k"], ["excel"], ["microsoft excel"], ["python"], ["rare"], ["Rare"]]
    df = spark.createDataFrame([([x.lower() for x in r],) for r in rows], "items array<string>")
    got = {r["skill"]: r for r in v.build_vocabulary(df, "items", top_n=2, forced=["python", "go"]).collect()}
    assert set(got) == {"problem solving", "excel", "python", "go"} or set(got) == {"problem solving", "rare", "python", "go"}
    assert got["problem solving"]["job_count"] == 3 and got["problem solving"]["n_variants"] == 2
    assert got["go"]["job_count"] == 0 and got["go"]["forms"] == ["go", "golang"] and got["go"]["forced"]
    assert got["python"]["pattern"] == "(?<![a-z0-9])(?:python)(?![a-z0-9])" and "golang" in got["go"]["pattern"]


def test_label_scores_ignore_unlabelled_rows(spark):
    df = spark.createDataFrame([(True, True, "a"), (False, True, "a"), (True, False, "b"), (None, True, "b"), (False, False, "b")], "y boolean, p boolean, s string")
    got = {r["skill"]: r for r in m.label_scores(df, "y", "p", "s").collect()}
    assert (got["all"]["n"], got["all"]["tp"], got["all"]["fp"], got["all"]["fn"], got["all"]["tn"], got["all"]["precision"]) == (4, 1, 1, 1, 1, 0.5)
    assert got["b"]["precision"] is None and got["b"]["recall"] == 0.0


def test_context_audit_draws_before_searching(spark):
    df = spark.createDataFrame([(i, f"xx {i} use python daily", ["python"]) for i in range(20)], "id int, t string, items array<string>")
    rows = m.context_audit(df, "id", "t", "items", vocabulary(spark, ["python"]), samples=3, width=5).collect()
    assert len(rows) == 3 and all(r["snippet"].endswith(" use python dail") or "python" in r["snippet"] for r in rows)


def test_load_item_lists(spark):
    df = spark.createDataFrame([("l1", "A , b, a", 0), ("l1", "c", 1), ("l2", None, 2), ("l3", " , ", 3)], "link string, s string, o int")
    assert [(r["link"], r["skills_list"]) for r in v.load_item_lists(df, "link", "s", "o").collect()] == [("l1", ["a", "b"])]


def test_neighbour_words(spark):
    df = spark.createDataFrame([("our organization grows. The organization",)], "t string")
    got = {(r["side"], r["word"]): r["n"] for r in m.neighbour_words(df, "t", "organization").collect()}
    assert got == {("before", "our"): 1, ("after", "grows"): 1, ("before", "the"): 1}
