import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from marquee import functions as fn


def results(spark, function, values, kind="string", **options):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = rows.select("i", function("v", **options).alias("r")).collect()
    return [row.r for row in sorted(out, key=lambda row: row.i)]


def test_parse_rating(spark):
    given = ["8.5", "N/A", "", None, "abc", "8.5d", " 8.5 ", "+7", "1_000", "1__0", ".5", "5.", "1e3", "0x10", "1,5"]
    expected = [8.5, None, None, None, None, None, 8.5, 7.0, 1000.0, None, 0.5, 5.0, 1000.0, None, None]
    assert results(spark, fn.parse_rating, given) == expected
    assert results(spark, fn.parse_rating, ["inf", "-Infinity"]) == [float("inf"), float("-inf")]
    assert str(results(spark, fn.parse_rating, ["NaN"])[0]) == "nan"


def test_parse_votes(spark):
    given = ["1,234,567", "N/A", "12.5", "", None, "5,", ",,7", "12345678901", "9" * 30]
    assert results(spark, fn.parse_votes, given) == [1234567, None, None, None, None, 5, 7, 12345678901, None]


def test_parse_metascore(spark):
    assert results(spark, fn.parse_metascore, ["80", "80.5", "N/A", None, " 80\n", "9999999999"]) == [
        80, None, None, None, 80, None
    ]


def test_year_from_date(spark):
    given = ["1994-09-23", "abcd", "", None, "199", "19940923"]
    assert results(spark, fn.year_from_date, given) == [1994, None, None, None, 199, 1994]


@pytest.mark.parametrize("length, expected", [(999, 999), (1000, 1000), (1001, 1000), (5000, 1000)])
def test_truncate(spark, length, expected):
    text = "x" * length
    [cut] = results(spark, fn.truncate_text, [text])
    assert len(cut) == expected
    assert cut == (text if length <= 1000 else "x" * 997 + "...")


def test_truncate_variants(spark):
    assert results(spark, fn.truncate_text, ["abcdef", "abc"], limit=4, suffix_outside=True) == ["abcd...", "abc"]
    assert results(spark, fn.truncate_or_null, ["", None, "abcdef"], limit=5) == [None, None, "ab..."]
    assert results(spark, fn.truncate_text, ["😀" * 6], limit=5) == ["😀😀..."]
    with pytest.raises(ValueError):
        fn.truncate_text(F.lit("x"), 2)


def test_slug_cases(spark):
    given = ["-Mission: Impossible - Fallout & Co-", "Amélie", "A & B", "ﬁlm ½", "", None, "  _ - ", "im ß nicht"]
    expected = ["mission-impossible-fallout--co", "amelie", "a--b", "film-12", "", None, "", "im-nicht"]
    assert results(spark, fn.title_slug, given) == expected


CHARACTERS = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]


def test_every_character_is_folded(spark):
    """One by one, against the decomposition that the standard library gives."""
    folded = results(spark, fn.ascii_fold, CHARACTERS)
    for char, got in zip(CHARACTERS, folded):
        assert got == "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80"), hex(ord(char))


@pytest.mark.parametrize("sep", ["-", "_"])
def test_slug_properties(spark, sep):
    random.seed(5)
    texts = ["".join(random.choices(CHARACTERS[:0x600], k=12)) for _ in range(400)]
    texts += ["a" + "".join(CHARACTERS[i:i + 400]) for i in range(0, len(CHARACTERS), 400)]
    slugs = results(spark, fn.title_slug, texts, sep=sep)
    allowed = re.compile(rf"[a-z0-9{sep}]*")
    for text, slug in zip(texts, slugs):
        assert allowed.fullmatch(slug)
        assert not slug.startswith(sep) and not slug.endswith(sep)
    # what a slug keeps are the folded letters and digits, in order
    letters = [re.sub("[^a-z0-9]", "", (t or "").lower()) for t in results(spark, fn.ascii_fold, texts)]
    assert [s.replace(sep, "") for s in slugs] == letters
    assert results(spark, fn.title_slug, slugs, sep=sep) == [re.sub(f"{sep}+", sep, s) for s in slugs]
    plain = ["one two", "one - two", "one_two", "one\u2003two", " one\ttwo_"]
    assert results(spark, fn.title_slug, plain, sep=sep) == [f"one{sep}two"] * 5


def test_digit_runs(spark):
    given = ["1,234 Reviews", "no digits", "Based on 57", ", 5", None]
    assert results(spark, fn.first_integer, given) == [1, None, 57, 5, None]
    assert results(spark, fn.first_integer, given, thousands=True) == [1234, None, 57, None, None]


def test_percent_and_words(spark):
    assert results(spark, fn.parse_percent, [" 97% ", "--", "", None]) == [97.0, None, None, None]
    assert results(spark, fn.strip_word, [" 25,000+ Ratings ", "Ratings"]) == ["25,000+", ""]


def test_years_in_text(spark):
    assert results(spark, fn.year_in_text, ["Released Sep 23, 1994", "1894", "20011999", None]) == [
        1994, None, 2001, None
    ]
    assert results(spark, fn.parenthesized_year, ["Film (1994)", "1994", "(19945)"]) == [1994, None, None]


def test_ratings_json(spark):
    kind = "array<struct<Source:string,Value:string>>"
    given = [[("IMDb", "8.5/10")], [], None]
    text = '[{"Source":"IMDb","Value":"8.5/10"}]'
    assert results(spark, fn.ratings_json, given, kind) == [text, None, None]
    assert results(spark, fn.ratings_json, given, kind, empty="[]") == [text, "[]", "[]"]


def test_file_stamp(spark):
    rows = spark.sql("select timestamp_ntz'2025-08-21 12:58:04' as t").select(fn.file_stamp("t").alias("s"))
    assert rows.first().s == "20250821_125804"


def number(kind, text):
    try:
        return kind(text)
    except ValueError:
        return None


def test_numbers_parse_as_in_python(spark):
    random.seed(11)
    alphabet = "0123456789" * 2 + "+-._eE \t naifty,%x"
    texts = ["".join(random.choices(alphabet, k=random.randint(1, 6))) for _ in range(6000)]
    texts += ["inf", "+Infinity", "-nan", "iNf ", "infinit", "1_2.3_4e1_0", "1._2", "1_.2", "1e_2", "0_0", "　7"]
    for text, got in zip(texts, results(spark, fn.parse_rating, texts)):
        expected = number(float, text)
        assert str(got) == str(expected) or got == expected, text
    for text, got in zip(texts, results(spark, fn.parse_votes, texts)):
        assert got == number(int, text.replace(",", "")), text
    for text, got in zip(texts, results(spark, fn.year_from_date, texts)):
        assert got == number(int, text[:4]), text
