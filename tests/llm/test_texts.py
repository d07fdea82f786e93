"""Licences, quality rules, personal data, packing and pages against plain versions."""

import hashlib
import html
import random
import re
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paysift.llm import licenses, packing, pages, personal, rules
from paysift.llm.queries import tokenizer_path

from .cases import documents, nothing, texts

WORD = r"[^\x20\x09-\x0D]+"


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# Licences

def plain_base(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places})))


def test_license_base_counts(spark):
    given_texts = [t for _, t, _ in texts()] + ["MIT License mit LICENSE; Apache-License", "GNU general PUBLIC license, general public license 3", "mit\nlicense", "miT licenſe", "İMIT license"]
    df = licenses.scan_licenses(documents(spark, [(i, t, "s") for i, t in enumerate(given_texts)]))
    got = rows_of(df, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted(((i, *plain_base(t)) for i, t in enumerate(given_texts)), key=repr)
    assert licenses.scan_licenses(nothing(spark)).count() == 0


def test_template_matches_exact_wording_only():
    mit = licenses.TEMPLATES[0][1]
    automaton = licenses.Automaton(mit)
    plain = re.sub(r"<<(begin|end)Optional>>", "", mit)
    plain = re.sub(r'<<var;name="holder";match="[^"]*">>', "2024 Some Body", plain)
    plain = re.sub(r'<<var;name="who";match="([^"|]*)[^"]*">>', r"\1", plain)
    accept = lambda text: bool(automaton.matches(w := licenses.tokens(text), set(w)))
    assert accept(plain) and accept("Before. " + plain.upper() + " After.")
    assert accept(plain.replace("(including the next paragraph)", "")) and accept(plain.replace("Copyright 2024 Some Body", ""))
    assert not accept(plain.replace("free of charge", "for a fee")) and not accept(plain.replace("sublicense, ", ""))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("a b c d".split()), max_size=12))
def test_automaton_equals_regular_expression(words):
    automaton = licenses.Automaton('a <<beginOptional>>b<<endOptional>> <<var;name="x";match=".{0,2}">> c <<var;name="y";match="d|a b">>')
    pattern = re.compile(r"a (?:b )?(?:\w ){0,2}c (?:d|a b) ")
    encoded = [w.encode() for w in words]
    expected = [start for start in range(len(words)) if pattern.match(" ".join(words[start:]) + " ")]
    assert [s for s in range(len(words)) if automaton.longest(encoded, s) is not None] == expected


# Quality rules

def plain_measures(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {i + j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_rule_counts_and_verdicts(spark):
    more = ["one two\none two\n\n  \nthree", "a b c d e f g h a b c d e f g h i", "x\x0by\x1cz\xa0w " * 9]
    rows = texts() + [(900 + i, t, "s") for i, t in enumerate(more)]
    df = rules.judge_quality(documents(spark, rows))
    got = rows_of(df, "doc_id", *rules.BASE)
    assert got == sorted(((i, *plain_measures(t)) for i, t, _ in rows), key=repr)
    for r in df.collect():
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert rules.judge_quality(nothing(spark)).count() == 0


def test_em_finds_the_bad_class():
    draw = np.random.RandomState(3)
    bad = draw.rand(4000) < 0.15
    votes = np.where(bad[:, None], np.where(draw.rand(4000, 6) < 0.4, 1, 2), np.where(draw.rand(4000, 6) < 0.01, 1, 2))
    votes[draw.rand(4000, 6) < 0.1] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = rules.fit_votes(patterns, counts.astype(float))
    assert abs(model.prior - 0.85) < 0.05
    assert ((model.log_odds(votes) < 0) == bad).mean() > 0.93


# Personal data

def plain_spans(text):
    text = text or ""
    quads = lambda m: all(int(p) <= 255 for p in m.split("."))
    digits = lambda m: re.sub(r"[^0-9]", "", m)
    check = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if quads(m[0])]
    found += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and check(digits(m[0]))]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@b.%+-0123 (9)45\n", max_size=60))
def test_spans_equal_plain_patterns(text):
    assert personal.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "1 " * 100_000):
        personal.base_spans(text)


def test_personal_query_columns(spark):
    df = personal.find_personal(documents(spark))
    for r in df.collect():
        match = [t for i, t, _ in texts() if i == r["doc_id"]]
        if r["doc_id"] is not None:
            base = ",".join(":".join(map(str, s)) for s in plain_spans(match[0]))
            assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and r["spans"].startswith(base)
    assert df.count() == len(texts()) and personal.find_personal(nothing(spark)).count() == 0


def test_terms_that_reveal_are_generalised_and_clean_texts_stay(spark):
    secret = [(i, f"note {i} about harbour zanzibar john@corp.example.com and weather {i}", "s") for i in range(6)]
    clean = [(100 + i, f"plain text {i} about harbour and weather without anything else in it", "s") for i in range(40)]
    df = documents(spark, secret + clean)
    spans = {r["doc_id"]: r["spans"] for r in personal.find_personal(df).collect()}
    assert all("term:" in spans[i] for i in range(6)) and all(spans[100 + i] == "" for i in range(40))
    cleaned = {r["doc_id"]: r["text"] for r in personal.sanitise(df).collect()}
    assert "zanzibar" not in cleaned[0] and "[EMAIL]" in cleaned[0] and "harbour" in cleaned[0] and cleaned[105] == clean[5][1]
    copies = documents(spark, [(i, secret[0][1], "s") for i in range(9)] + clean)
    assert all("term:" not in r["spans"] for r in personal.find_personal(copies).collect())


def test_rare_term_reveals_an_entity_of_one_text(spark):
    secret = [(1, "harbour weather zanzibar john@corp.example.com harbour weather", "s")]
    clean = [(100 + i, f"plain harbour and weather {i}", "s") for i in range(400)]
    df = documents(spark, secret + clean)
    spans = {r["doc_id"]: r["spans"] for r in personal.find_personal(df).collect()}
    assert spans[1] == "email:25:46,term:16:24" and all(spans[100 + i] == "" for i in range(400))
    assert {r["doc_id"]: r["text"] for r in personal.sanitise(df).collect()}[1] == "harbour weather [TERM] [EMAIL] harbour weather"


@pytest.mark.parametrize("text, cleaned", [
    ("host 10.0.0.0 4111 1111 1111 1111", "host [CARD]"),
    ("to 4111111111111111@bank.com now", "to [EMAIL] now"),
    ("10.0.0.1@host.example.org", "[EMAIL]"),
    ("+15551234567@sms.example.org or 10.0.0.1", "[EMAIL] or [IP]"),
    ("a@b.cc,10.0.0.1", "[EMAIL],[IP]"),
])
def test_overlapping_spans_go_whole(text, cleaned):
    assert personal.replaced(text, personal.joined(personal.base_spans(text))) == cleaned


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a@b.%+-0123 (9)45", max_size=60))
def test_no_character_of_a_span_stays(text):
    spans = personal.base_spans(text)
    covered = {i for _, start, end in spans for i in range(start, end)}
    left = re.sub(r"\[(?:EMAIL|IP|CARD|PHONE)\]", "", personal.replaced(text, personal.joined(spans)))
    assert left == "".join(c for i, c in enumerate(text) if i not in covered)


def test_terms_of_words():
    terms = lambda word: [(t, word[a:b]) for t, a, b in personal.terms_of(word)]
    assert terms("Ann,") == [("ann", "Ann")] and terms("(O'Neil)") == [("o'neil", "O'Neil")] and terms("Anne-Marie's") == [("anne-marie", "Anne-Marie")]
    assert terms("\u674e\u660e\uff0c") == [("\u674e\u660e", "\u674e\u660e")] and terms("Zoe\u0308:x") == [("zoe\u0308", "Zoe\u0308")]
    assert terms("Lee:ann@corp.example.com;Ng/Wu") == [("lee", "Lee"), ("ng", "Ng"), ("wu", "Wu")] and terms("a") == [] and terms("\u0130lk") == [("i\u0307lk", "\u0130lk")]


def test_terms_go_everywhere_in_the_text_of_the_entity(spark):
    letter = "Ann O'Neil " + "plain harbour and weather " * 3 + "ann@corp.example.com " + "harbour and weather " * 60 + "Anne-Marie, \u674e\u660e and O'Neil"
    clean = [(100 + i, f"plain harbour and weather {i}", "s") for i in range(400)]
    df = documents(spark, [(1, letter, "s"), (2, letter, "s")] + clean)
    cleaned = {r["doc_id"]: r["text"] for r in personal.sanitise(df).collect()}
    assert cleaned[1] == cleaned[2] == "[TERM] [TERM] " + "plain harbour and weather " * 3 + "[EMAIL] " + "harbour and weather " * 60 + "[TERM], [TERM] and [TERM]"
    assert all(cleaned[i] == text for i, text, _ in clean)


# Packing

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def test_ids_equal_the_whole_tokenizer(tokenizer):
    chunks, draw = packing.chunks_of(tokenizer_path()), random.Random(5)
    letters = [chr(i) for i in range(0x250)] + list("́ΣςσİKÅ漢　﻿​²½ﬁ😀") + ["'s", "'LL", "<|endoftext|>", "\x1c", "\x85", " "]
    for text in [t or "" for _, t, _ in texts()] + ["".join(draw.choice(letters) for _ in range(draw.randint(0, 50))) for _ in range(1500)]:
        assert np.frombuffer(chunks.ids(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_cover_every_id_once(spark, tokenizer):
    pieces = packing.pack(documents(spark), tokenizer_path(), longest=64, with_ids=True).collect()
    assert len({p["sequence_id"] for p in pieces}) == len(pieces) and all(p["offset"] == 0 for p in pieces)
    assert all(p["length"] & (p["length"] - 1) == 0 and 1 <= p["length"] <= 64 for p in pieces)
    assert all(zlib.crc32(np.array(p["ids"], "<u4")) == p["ids_crc32"] and len(p["ids"]) == p["length"] for p in pieces)
    expected = Counter()
    for i, text, _ in texts():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for length in [64] * (len(ids) // 64) + [1 << b for b in range(5, -1, -1) if len(ids) % 64 >> b & 1]:
            expected[i, at, tuple(ids[at:at + length])] += 1
            at += length
    assert Counter((p["doc_id"], p["start"], tuple(p["ids"])) for p in pieces) == expected
    assert packing.pack(nothing(spark), tokenizer_path()).count() == 0


def test_buckets_hold_one_length(spark, tmp_path):
    packing.bucketed(packing.pack(documents(spark), tokenizer_path()), str(tmp_path / "b"))
    assert {r["length"] for r in spark.read.parquet(str(tmp_path / "b")).collect()} <= {1 << b for b in range(12)}


# Pages

class Plain(HTMLParser):
    """The blocks of the article alone, by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.inside = [], False

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        self.parts.append("\0" if tag in ("p", "h1", "article") else "")

    def handle_endtag(self, tag):
        self.parts.append("\0" if tag in ("p", "h1") else "")
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


def test_packing_memory_is_bounded(monkeypatch):
    """Ids are the tokenizer's own while the memories are emptied again and again; long chunks are not kept."""
    monkeypatch.setattr(packing, "REMEMBERED", 3_000)
    chunks, draw = packing.Chunks(tokenizer_path()), random.Random(8)
    words = ["".join(draw.choices("abcdé1'-", k=draw.randrange(1, 9))) for _ in range(300)] + ["x" * 500, "\u6f22\u5b57" * 100]
    for _ in range(20):
        text = " ".join(draw.choices(words, k=60))
        assert chunks.ids(text) == np.array(chunks.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()
        assert len(chunks) <= 3_000 // packing.ENTRY and len(chunks.parts) <= 3_000 // packing.ENTRY
        assert not any(len(c) > packing.LONG for c in [*chunks, *chunks.parts])


def test_pages_equal_the_article(spark):
    got = {r["page_id"]: r for r in pages.extract_pages(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        plain = Plain()
        plain.feed(r["html"])
        plain.close()
        blocks = [re.sub(r"\s+", " ", b).strip() for b in "".join(plain.parts).split("\0")]
        assert got[r["page_id"]]["text"] == "\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


LONG = "This is the story of a man who was in the house with all of his books and it was not his own house but that of the town he had come from. " * 2


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain", ""), ("<p>", ""), ("<!-- a", ""), ("<script>x", ""), ("a < b", ""),
    (f"<div class='ad'>Buy</div><p>{LONG}</p><p>So it was.</p><p>{LONG}</p><div id=comments><p>{LONG}</p></div>", f"{LONG.strip()}\nSo it was.\n{LONG.strip()}"),
    (f"<header>Site</header><main><header><h1>Head</h1></header><p>A&nbsp;b &lt;c&gt;<br>d</p><aside>x</aside><form><p>f</p></form><ul><li>one<li>two</ul></main><p>{LONG}</p>", "Head\nA b <c> d\none\ntwo"),
    (f"<article><p>one <a href='>'>link</a> in a long line of plain words</p><p><a>more</a> <a>links</a></p><div class='cookie notice'>We use</div></article>", "one link in a long line of plain words"),
    (f"<h2>Title</h2><p>{LONG}</p><p><a href=x>Read more of this here</a></p><footer>{LONG}</footer>", f"Title\n{LONG.strip()}"),
])
def test_page_cases(page, text):
    assert pages.extract_page(page or "", pages.Limits()) == text


@pytest.mark.parametrize("page, text", [
    (f"<article class='post has-comments'><p>{LONG}</p></article>", LONG.strip()),
    (f"<main class='with-sidebar'><p>{LONG}</p></main>", LONG.strip()),
    (f"<main class='sidebar'><p>{LONG}</p></main>", LONG.strip()),
    (f"<div id='search-results-page'><p>{LONG}</p></div>", LONG.strip()),
    (f"<body><form id=aspnet><div class='site-nav'>Home</div><p>{LONG}</p><div class='ad'>Buy</div></form></body>", LONG.strip()),
    (f"<form><article><p>Short</p></article></form><div class='comment-list'><article><p>{LONG}</p></article></div>", "Short"),
    (f"<p>{LONG}</p><div id='comments'><p>{LONG}</p><p>{LONG}</p></div>", LONG.strip()),
    (f"<p>{LONG}</p><div class='related'><article><p>Card</p></article></div>", LONG.strip()),
    (f"<div class='widget'><p>{LONG}</p><form><p>{LONG}</p></form><p>{LONG}</p></div>", f"{LONG.strip()}\n{LONG.strip()}"),
    (f"<p>{LONG}<span class='ad'>Buy</span></p>", LONG.strip()),
])
def test_marks_are_evidence(page, text):
    assert pages.extract_page(page, pages.Limits()) == text


def test_page_rows(spark):
    df = spark.createDataFrame([(1, "u", None, "t"), (None, None, "<article><p>x</p></article>", "t"), (1, "u", "", "t")], "page_id long, url string, html string, text string")
    assert rows_of(pages.extract_pages(df), "text", "n_chars") == [("", 0), ("", 0), ("x", 1)]
    assert pages.extract_pages(df.where("false")).count() == 0


def test_odd_pages_take_linear_time():
    for page in ("<a " * 100_000, "<" * 100_000, "<p>" * 50_000, "&amp" * 50_000, "<a href='" * 50_000, "</p>" * 50_000, "<!" * 50_000, "<div>" * 3_000,
                 "<b>" * 50_000 + "x</i>" * 50_000, "<b>" * 50_000 + "<div></div>" * 50_000, "<b>" * 50_000 + "<p>x" * 50_000, "<i><nav>" + "<b>" * 50_000 + "x</i>" * 50_000):
        began = time.monotonic()
        pages.extract_page(page, pages.Limits())
        assert time.monotonic() - began < 10
    assert html.unescape("&am") == "&am"


PLAIN_TEXT = ("It was the year in which the river rose and they had to leave the house by the mill for the hills that lie to the north. " * 3).strip()


@pytest.mark.parametrize("page, text", [
    # a teaser marked as an article does not hide the text beside it
    (f"<div><article><p>Card text short</p></article></div><p>{PLAIN_TEXT}</p><p>{PLAIN_TEXT}</p>", [PLAIN_TEXT, PLAIN_TEXT]),
    # a whole paragraph with a copyright sign is text, a short line is not
    (f"<p>{PLAIN_TEXT}</p><p>\xa9 {PLAIN_TEXT}</p><p>{PLAIN_TEXT}</p><p>\xa9 2020 Firm</p>", [PLAIN_TEXT, "\xa9 " + PLAIN_TEXT, PLAIN_TEXT]),
    # the references of an article stay, its short menu goes with the separator between its entries
    (f"<article><p><a>Home</a></p><p>|</p><p><a>About</a></p><p>{PLAIN_TEXT}</p><ul><li><a>The rise of the river and of the mill, volume one</a></li></ul><p>End.</p></article>",
     [PLAIN_TEXT, "The rise of the river and of the mill, volume one", "End."]),
    # unknown words inside a region stay, the same outside go
    (f"<article><h1>Otsikko</h1><p>{'joki nousi ' * 20}</p></article><p>{'joki nousi ' * 20}</p>", ["Otsikko", ("joki nousi " * 20).strip()]),
])
def test_region_is_a_prior(page, text):
    assert pages.extract_page(page, pages.Limits()) == "\n".join(text)


def plain_second_pass(blocks, region):
    """Labels of the second pass, looking for the neighbours of every block anew."""
    labels = [b.label(pages.Limits(), region) for b in blocks]

    def nearest(places):
        found = [labels[j] for j in places if labels[j] in ("good", "bad") and (blocks[j].main or not region)]
        return (found or ["good" if region else "bad"])[0]

    kept = []
    for i, label in enumerate(labels):
        before, after = nearest(range(i - 1, -1, -1)), nearest(range(i + 1, len(blocks)))
        if label in ("good", "bad"):
            kept.append(label == "good")
        elif before == after:
            kept.append(before == "good" or label == "near" and "good" not in labels)
        else:
            kept.append(bool(region or label == "near" or blocks[i].heading and after == "good"))
    return kept


def test_two_passes_equal_a_plain_version():
    source, seen = random.Random(3), set()
    for _ in range(400):
        share, blocks = source.choice((0.0, 0.3, 1.0)), []
        for _ in range(source.randrange(1, 12)):
            text = source.choice(("Short", PLAIN_TEXT[:110], PLAIN_TEXT, "joki nousi " * 20, "\xa9 Firm"))
            blocks.append(pages.Block(text, source.choice((0, 0, 0, len(text))), source.random() < 0.2, int(source.random() < share), 0))
        region = pages.trusted_region(blocks, pages.Limits())
        kept = pages.classify(blocks, pages.Limits())
        assert kept == plain_second_pass(blocks, region)
        seen |= {(region, b.label(pages.Limits(), region)) for b in blocks}
    assert seen == {(region, label) for region in (True, False) for label in ("good", "near", "short", "bad")}
