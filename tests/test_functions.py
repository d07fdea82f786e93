"""Column functions on literal cases."""

from pyspark.sql import functions as F

from paysift import constants
from paysift.functions import dates, places, text, values
from paysift.sources.readers import parse_list_column


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_annualise_per_period(spark):
    rows = [(20.0, 40.0, None, p, None) for p in ("HOURLY", "WEEKLY", "biweekly", "MONTHLY", "YEARLY")] + [(20.0, 40.0, None, "HOURLY", 12345.0), (20.0, 40.0, None, "UNKNOWN", None),
            (20.0, None, None, "YEARLY", None), (None, None, 7.0, "MONTHLY", None)]
    df = spark.createDataFrame(rows, "lo double, hi double, mid double, period string, known double")
    got = [r[0] for r in df.select(values.annualise("known", "lo", "hi", "mid", "period")).collect()]
    assert got == [62400, 1560, 780, 360, 30, 12345, None, 20, 84]


def test_fixed_tiers_are_right_closed(spark):
    df = spark.createDataFrame([(10000.0,), (62400.0,), (62400.01,), (109200.0,), (200000.0,), (None,)], "s double")
    assert [r[0] for r in df.select(values.fixed_tier("s")).collect()] == ["Low", "Low", "Mid", "Mid", "High", None]


def test_salary_drop_reason_keeps_missing_currency_and_missing_amounts(spark):
    rows = [(None, None, "USD"), (None, 5.0, "USD"), (50000.0, None, None), (50000.0, None, "EUR"), (9000.0, None, "USD"), (2e6, None, "USD")]
    df = spark.createDataFrame(rows, "s double, lo double, c string")
    assert [r[0] for r in df.select(values.salary_drop_reason("s", "lo", "c")).collect()] == ["no salary", None, None, "non-USD", "implausible", "implausible"]


def test_ordinal_bucket(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (10,), (11,), (10000,), (10001,)], "n int")
    assert [r[0] for r in df.select(values.ordinal_bucket("n")).collect()] == [0, 0, 1, 1, 2, 7, 8]


def test_flags_and_numbers(spark):
    df = spark.createDataFrame([("True",), (" false ",), ("1",), ("yes",), (None,)], "t string")
    assert [tuple(r) for r in df.select(values.strict_bool("t"), values.lenient_bool("t")).collect()] == [(True, True), (False, False), (None, True), (None, False), (None, False)]
    df = spark.createDataFrame([("1.5",), ("NaN",), ("-inf",), ("true",), (None,)], "t string")
    assert [r[0] for r in df.select(values.finite_or_null("t")).collect()] == [1.5, None, None, None, None]


def test_missing_tokens(spark):
    df = spark.createDataFrame([("N/A",), ("null",), (" NA",), ("x",), ("",)], "t string")
    assert [r[0] for r in df.select(values.blank_missing("t")).collect()] == [None, None, " NA", "x", None]


def test_clean_items_keep_first_order_and_unicode_blanks(spark):
    df = spark.createDataFrame([(["  B x ", "a", None, "b x", " ", "A"],), (None,)], "l array<string>")
    assert [r[0] for r in df.select(text.clean_items("l")).collect()] == [["b x", "a"], []]


def test_keys_and_forms(spark):
    assert one(spark, text.item_key(F.lit("C++ / C# (Adv.)"))) == "c++c#adv"
    assert one(spark, text.clean_form(F.lit(" * Problem   Solving. "))) == "problem solving"
    assert one(spark, text.is_ascii(F.lit("naïve"))) is False


def test_split_joined_and_itemset(spark):
    assert one(spark, text.split_joined(F.lit("a; b ;; c"))) == ["a", "b", "c"]
    assert one(spark, text.split_joined(F.lit("Unknown"))) == []
    assert one(spark, text.parse_itemset(F.lit("b, a , b,"))) == ["a", "b"]


def test_form_pattern_joins_words_and_respects_boundaries(spark):
    pattern = text.form_pattern(F.array(F.lit("c++"), F.lit("problem solving")))
    for sample, expected in (("uses c++ daily", True), ("problem-solving", True), ("problemsolving.", True), ("xproblem solving", False), ("c+", False)):
        assert one(spark, F.regexp_like(F.lit(sample), pattern)) is expected


def test_html_variants(spark):
    page = "<p>A <b>JOB</b>&amp; Skills<script>x</script>&lt;i&gt;</p><!-- c --><a title='a>b'>z</a>"
    assert one(spark, text.html_to_text(F.lit(page))) == "A JOB & Skills <i> z"
    assert one(spark, text.normalised_description(F.lit("A <b>JOB</b> &amp; Skills"))) == "a job & skills"
    assert one(spark, text.normalised_description(F.lit("a &lt;b&gt; c"))) == "a c"  # decoded first, so dropped as a tag


def test_masking_counts_and_hashes(spark):
    assert one(spark, text.masked_template(F.lit("see https://x.io/1?a=2 pay 1,234.50"))) == "see <url> pay <num>"
    assert one(spark, text.word_count(F.lit("  a b \n c "))) == 3 and one(spark, text.word_count(F.lit(" "))) == 0
    same = spark.createDataFrame([("a", None, 1.5), ("a", "null", 1.5), ("a", None, 1.5)], "a string, b string, c double").select(text.values_hash("a", "b", "c")).collect()
    assert same[0] == same[2] and same[0] != same[1]


def test_scrub_and_search(spark):
    assert one(spark, text.scrub(F.lit("k=abc&i=abc.d"), ["abc.d", "", "abc"])) == "k=***&i=***"
    assert one(spark, text.contains_text("Acme x", F.lit("ACME"), F.lit("X1"))) is True


def test_locations(spark):
    parse = lambda s: tuple(one(spark, places.parse_location(F.lit(s))))
    assert parse("Austin, TX") == ("Austin", "TX", "United States", "city")
    assert parse("Texas, United States") == (None, "TX", "United States", "state")
    assert parse("Columbus, Ohio Metropolitan Area") == ("Columbus", "OH", "United States", "metro")
    assert parse("United States") == (None, None, "United States", "country")
    assert parse("Greater Boston") == (None, None, "United States", "metro")
    assert one(spark, places.first_state(F.array(F.lit("Remote"), F.lit("New York, New York")))) == "NY"
    assert one(spark, places.posting_state(F.array(F.lit("US"), F.lit("Oregon")), F.lit("Austin, TX"))) == "OR"


def test_dates(spark):
    assert str(one(spark, dates.epoch_ms_to_date(F.lit(1704067199000)))) == "2023-12-31"
    label = lambda d: one(spark, dates.snapshot_label(F.lit(d), F.to_date(F.lit("2026-03-03"))))
    assert [label("2026-03-01"), label("2026-01-01"), label("2026-13-01"), label("2027-01-01"), label("x")] == ["fresh", "stale", "unknown", "unknown", "unknown"]


def test_list_literals(spark):
    assert one(spark, parse_list_column(F.lit("""['a', "driver's license"]"""))) == ["a", "driver's license"]


def test_sense_patterns_compile_in_both_dialects(spark):
    import re

    for pattern in constants.SENSE_PATTERNS.values():
        re.compile(pattern)
        one(spark, F.lit("x").rlike(pattern))
