"""Format-preserving pseudonyms for personal data.

Candidates are found by pattern and validated: card numbers by their check digit, bank accounts by
their rest by 97, dates by the calendar, addresses by their octets, telephones by their length. Each value is permuted inside its own format by a keyed
Feistel network, so that equal values stay equal across documents, different ones stay different,
and the result passes the same validation. Only DataFrame functions run, in one pass without a
shuffle.

Cases: a null or empty text stays as it is. What fails its validation, and any other text, is left
alone. A value of one or two characters may map to itself; nothing else is left out. Secrets may have
any length; more than 128 digits without a letter are none. Each row is read by itself, so equal
rows get equal results, and an empty table gives an empty result. Columns of other names are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import packed

ROUNDS = 10
#: 1900-01-01 to 2099-12-31 are 17 * 4297 days.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)
CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Classes of hex digits in one case, and in both.
HEX = ("0123456789abcdef", "0123456789ABCDEF")
MIXED = ("0123456789", "abcdef", "ABCDEF")

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
SECRET = r"(?<![0-9A-Za-z])(?:(?=[0-9]*+[A-Fa-f])[0-9A-Fa-f]{32,}+|[0-9]{32,128})(?![0-9A-Za-z])"
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
DATE = (
    r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})"
    r"(?![0-9]|[./-][0-9])"
)
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
#: National numbers of ten digits, and international ones in any groups; these have 8 to 15 digits.
PHONE = (
    r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}"
    r"|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}|\+[0-9]{1,3}[ .-]\(?[0-9]{1,5}\)?(?:[ .-][0-9]{2,5}){1,5}|\+[0-9]{8,15})(?![0-9])"
)
PHONE_DIGITS = (8, 15)
ACCOUNT = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"
ACCOUNT_SIGNS = (15, 34)
CARD = (
    r"(?<![0-9])(?:[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9])"
)
CANDIDATE = "|".join((EMAIL, SECRET, ACCOUNT, ADDRESS, DATE, SOCIAL, PHONE, CARD))
KINDS = ("email", "secret", "account", "address", "date", "social", "phone", "card")


def _digest(key: str, tweak: str, round_: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), round_.cast("string"), value), 256)


def permute_pair(left: Column, right: Column, a: Column, b: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of the pairs from Z_a x Z_b, as struct(l, r)."""
    def number(round_: Column, value: Column, modulus: Column) -> Column:
        word = F.conv(F.substring(_digest(key, tweak, round_, value.cast("string")), 1, 15), 16, 10)
        return F.pmod(word.cast("long"), modulus)

    def round_of(pair: Column, i: Column) -> Column:
        l, r = pair["l"], pair["r"]
        return F.when(
            i % 2 == 1, F.struct(F.pmod(l + number(i, r, a), a).alias("l"), r.alias("r"))
        ).otherwise(F.struct(l.alias("l"), F.pmod(r + number(i, l, b), b).alias("r")))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_of)


def _half(value: Column) -> Column:
    return F.floor(F.length(value) / 2).cast("int")


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def permute_digits(digits: Column, key: str, tweak: str) -> Column:
    """A keyed permutation of the digit strings of a length from 1 to 36."""
    u = _half(digits)
    v = F.length(digits) - u
    modulus = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
    left = F.when(u == 0, F.lit("0")).otherwise(F.substring(digits, F.lit(1), u))
    return _let(
        permute_pair(left, F.substring(digits, u + 1, v), modulus(u), modulus(v), key, tweak),
        lambda p: F.concat(
            F.when(u == 0, F.lit("")).otherwise(F.lpad(p["l"].cast("string"), u, "0")),
            F.lpad(p["r"].cast("string"), v, "0"),
        ),
    )


def permute_characters(text: Column, classes: tuple[str, ...], key: str, tweak: str) -> Column:
    """A keyed permutation of the strings of one length; each character stays in its class, and
    characters of no class stay."""
    def shifted(half: Column, other: Column, round_: Column) -> Column:
        def shift(stream: Column) -> Column:
            def one(c: Column, i: Column) -> Column:
                by = F.conv(F.substring(stream, i % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
                out = c
                for letters in reversed(classes):
                    at = F.instr(F.lit(letters), c)
                    moved = F.substring(F.lit(letters), F.pmod(at - 1 + by, F.lit(len(letters))) + 1, F.lit(1))
                    out = F.when(at > 0, moved).otherwise(out)
                return out

            return F.array_join(F.transform(F.regexp_extract_all(half, F.lit("(?s)."), F.lit(0)), one), "")

        return _let(_digest(key, tweak, round_, other), shift)

    def round_of(pair: Column, i: Column) -> Column:
        l, r = pair["l"], pair["r"]
        return F.when(i % 2 == 1, F.struct(shifted(l, r, i).alias("l"), r.alias("r"))).otherwise(
            F.struct(l.alias("l"), shifted(r, l, i).alias("r"))
        )

    u = _half(text)
    start = F.struct(F.substring(text, F.lit(1), u).alias("l"), F.substring(text, u + 1, F.length(text)).alias("r"))
    return _let(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_of), lambda p: F.concat(p["l"], p["r"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _in_form(text: Column, digits: Column, signs: str = "0-9") -> Column:
    """`text` with its digits, or other signs, replaced by `digits`, in order."""
    def one(c: Column, i: Column) -> Column:
        so_far = F.regexp_replace(F.substring(text, F.lit(1), i + 1), f"[^{signs}]", "")
        return F.when(c.rlike(f"^[{signs}]$"), F.substring(digits, F.length(so_far), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), one), "")


def luhn_sum(digits: Column) -> Column:
    """The weighted sum of a number with its check digit; valid if it divides by 10."""
    def weighted(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((F.length(digits) - i) % 2 == 0, twice).otherwise(d)

    each = F.transform(F.regexp_extract_all(digits, F.lit("[0-9]"), F.lit(0)), weighted)
    return F.aggregate(each, F.lit(0), lambda total, d: total + d)


def rest_of_97(account: Column) -> Column:
    """The rest by 97 of an account number, its first four signs at the end, letters as 10 to 35."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        value = F.instr(F.lit(CLASSES[0] + CLASSES[2]), c) - 1
        return (rest * F.when(value < 10, 10).otherwise(100) + value) % 97

    return F.aggregate(F.regexp_extract_all(turned, F.lit("[0-9A-Z]"), F.lit(0)), F.lit(0), add)


def _date_of(text: Column) -> Column:
    year_first = F.try_to_date(text, "yyyy-M-d")
    plain = F.translate(text, ".", "/")
    return F.when(text.rlike("^[0-9]{4}-"), year_first).otherwise(
        F.coalesce(F.try_to_date(plain, "d/M/yyyy"), F.try_to_date(plain, "M/d/yyyy"))
    )


def _in_range(day: Column) -> Column:
    return F.coalesce((F.datediff(day, F.lit(FIRST_DAY).cast("date")) >= 0)
                      & (F.datediff(day, F.lit(FIRST_DAY).cast("date")) < DAYS[0] * DAYS[1]), F.lit(False))


def kind_of(value: Column) -> Column:
    """The kind of a candidate that is valid, else null."""
    digits = _digits(value)
    signs = F.replace(value, F.lit(" "), F.lit(""))
    octets = F.split(value, r"\.")
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike("^[0-9A-Fa-f]{32,}+$"), "secret")
        .when(value.rlike("^[A-Z]"), F.when(
            F.length(signs).between(*ACCOUNT_SIGNS) & (rest_of_97(signs) == 1), "account"))
        .when(value.rlike(f"^(?:{ADDRESS})$"), F.when(F.forall(octets, lambda o: o.cast("int") < 256), "address"))
        .when(value.rlike(f"^(?:{DATE})$"), F.when(_in_range(_date_of(value)), "date"))
        .when(value.rlike(f"^(?:{SOCIAL})$"), F.when(
            ~value.rlike("^(?:000|666|9[0-9]{2})-") & ~value.rlike("-00-|-0000$"), "social"))
        .when(value.rlike("^[0-9]{13,19}$") | value.rlike("^[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}$")
              | value.rlike("^[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}$"), F.when(luhn_sum(digits) % 10 == 0, "card"))
        .when(value.rlike(f"^(?:{PHONE})$"), F.when(F.length(digits).between(*PHONE_DIGITS), "phone"))
    )


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The value that stands for a valid one."""
    digits = _digits(value)
    at = F.instr(value, "@")
    email = F.concat(
        permute_characters(F.substring(value, F.lit(1), at - 1), CLASSES, key, "email"),
        F.substring(value, at, F.length(value)),
    )
    secret = (
        F.when(value.rlike("[A-F]") & value.rlike("[a-f]"), permute_characters(value, MIXED, key, "secret"))
        .when(value.rlike("[A-F]"), permute_characters(value, HEX[1:], key, "secret"))
        .otherwise(permute_characters(value, HEX[:1], key, "secret"))
    )
    signs = F.replace(value, F.lit(" "), F.lit(""))
    country = F.substring(signs, F.lit(1), F.lit(2))
    account = _let(
        permute_characters(F.substring(signs, F.lit(5), F.length(signs)), CLASSES[::2], key, "account"),
        lambda own: _in_form(value, F.concat(
            country, F.lpad((98 - rest_of_97(F.concat(country, F.lit("00"), own))).cast("string"), 2, "0"), own), "0-9A-Z"),
    )
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    address = _let(octets, lambda o: _let(
        permute_pair(F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1)), F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3)),
                     F.lit(65536), F.lit(65536), key, "address"),
        lambda p: F.concat_ws(".", *(x.cast("string") for x in (
            F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256))),
    ))
    day = F.datediff(_date_of(value), F.lit(FIRST_DAY).cast("date"))
    moved = _let(
        permute_pair(F.floor(day / DAYS[1]), day % DAYS[1], F.lit(DAYS[0]), F.lit(DAYS[1]), key, "date"),
        lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAYS[1] + p["r"]).cast("int")),
    )
    month_first = F.try_to_date(F.translate(value, ".", "/"), "d/M/yyyy").isNull()

    def shown(day: str, month: str) -> Column:
        return (
            F.when(value.rlike("^[0-9]{4}-"), F.date_format(moved, f"yyyy-{month}-{day}"))
            .when(value.contains(".") & month_first, F.date_format(moved, f"{month}.{day}.yyyy"))
            .when(value.contains("."), F.date_format(moved, f"{day}.{month}.yyyy"))
            .when(month_first, F.date_format(moved, f"{month}/{day}/yyyy"))
            .otherwise(F.date_format(moved, f"{day}/{month}/yyyy"))
        )

    # a part of one digit: no zeros are filled in
    date = F.when(value.rlike(r"(?<![0-9])[0-9](?![0-9])"), shown("d", "M")).otherwise(shown("dd", "MM"))
    body = permute_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    card = _let(body, lambda b: _in_form(value, F.concat(
        b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string"))))
    # the country code stays
    code = F.when(value.startswith("+"), F.length(digits) - F.least(F.length(digits) - 1, F.lit(10))).otherwise(0)
    phone = _let(
        F.concat(F.substring(digits, F.lit(1), code),
                 permute_digits(F.substring(digits, code + 1, F.length(digits)), key, "phone")),
        lambda d: _in_form(value, d),
    )
    social = _let(permute_digits(digits, key, "social"), lambda d: _in_form(value, d))
    return (
        F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "account", account).when(kind == "address", address)
        .when(kind == "date", date).when(kind == "card", card).when(kind == "phone", phone)
        .when(kind == "social", social).otherwise(value)
    )


def pseudonymise(
    docs: DataFrame, key: str, *, text: str = "text", into: str = "text", found: str = "found",
) -> DataFrame:
    """`docs` with pseudonyms in place of personal data (column `into`), and the kinds found, in
    order, one for each value (column `found`); all other columns pass through."""
    source = F.col("text")
    maybe = source.rlike("[0-9@]")
    taken = F.when(maybe, F.regexp_extract_all(source, F.lit(CANDIDATE), F.lit(0)))
    rows = packed(docs, text=text).withColumn("values", taken).withColumn("kinds", F.transform("values", kind_of))
    hit = F.coalesce(F.exists("kinds", lambda k: k.isNotNull()), F.lit(False))
    new = F.zip_with("values", "kinds", lambda v, k: pseudonym(v, k, key))
    woven = F.array_join(F.flatten(F.zip_with(
        F.split(source, CANDIDATE, -1), new, lambda gap, value: F.array(gap, F.coalesce(value, F.lit("")))
    )), "")
    there = F.coalesce(F.filter("kinds", lambda k: k.isNotNull()), F.array().cast("array<string>"))
    out = {into: F.when(hit, woven).otherwise(source), found: there}
    return rows.select(
        *(out.get(c, F.col("row")[c]).alias(c) for c in docs.columns),
        *(column.alias(name) for name, column in out.items() if name not in docs.columns),
    )


def digest(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_found, kinds): each text with pseudonyms, how many, and of which kinds."""
    out = pseudonymise(docs.select("doc_id", "text"), key)
    return out.select(
        "doc_id", "text", F.size("found").cast("long").alias("n_found"),
        F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("kinds"),
    )
