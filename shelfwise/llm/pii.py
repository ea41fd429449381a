"""Format-preserving pseudonyms for personal numbers, dates and mail addresses.

Everything is DataFrame expressions. A value is found by its format, then
validated (card numbers by their check digit, dates by the calendar, network
addresses by their range); what does not validate stays as it is. A valid
value is a short list of numbers, each with its own radix (digits 10, letters
26, address bytes 256, a date 189 x 773: the days of the 400 years from
1800). A keyed Feistel network over the two halves of the list permutes all
lists of the same radices: in each round every number of one half gets added,
modulo its radix, a number that a keyed SHA-256 draws from the other half.
The result is written back in the value's own format.

So the same value becomes the same pseudonym in every document, different
values of one kind stay different, and whoever holds the key can undo it.

| kind  | format                                   | kept as it is                  |
|-------|------------------------------------------|--------------------------------|
| email | name@host.domain                         | host, punctuation, letter case |
| phone | + and 8 to 15 digits in any grouping; (NNN) NNN-NNNN and its usual variants | country code, punctuation |
| ssn   | NNN-NN-NNNN                              | punctuation                    |
| card  | 13 to 19 digits, four groups of four, 4-6-4 and 4-6-5 | punctuation, a valid check digit |
| iban  | as long as its country has it, with or without spaces | country, spaces, valid check digits |
| ip    | four numbers up to 255 with dots         |                                |
| date  | YYYY-MM-DD, YYYY/MM/DD, MM/DD/YYYY or else DD/MM/YYYY, DD.MM.YYYY, of the years 1800 to 2199 | order, punctuation |

Days and months may have one digit; the pseudonym of a date with such a part
has no leading zeros. DD/MM dates have a day after the 12th, and so have
their pseudonyms (9 x 9833 of them), which keeps them apart from MM/DD ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: For tests and examples; pass a secret of your own.
EXAMPLE_KEY = "example key, not a secret"
ROUNDS = 8

#: A name of at most 64 characters, from a border on, and a host of at most 127 labels of 63 each:
#: what is tried at one place of a text has a bound.
_EMAIL = (r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@"
          r"(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{1,63}")
_PHONE = (r"\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}\b"
          r"|\+[1-9](?:[ ./-]?[()]?[ ./-]?[0-9]){7,14}\b(?![./-]?[0-9])"
          r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}\b|\b[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}\b")
#: Country codes, at the front of the digits; the rest have three.
_COUNTRY = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
_SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
_DATE = (r"\b(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"
         r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})\b")
_IP = r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"
_CARD = (r"\b(?:[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{4,5}"
         r"|[0-9]{4}-[0-9]{6}-[0-9]{4,5}|[0-9]{13,19})\b")
#: Characters of an IBAN, by country.
_IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_IBAN = r"\b(?:" + "|".join(
    f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, c in _IBAN_SIZES.items()) + r")\b"
VALUES = "|".join((_EMAIL, _PHONE, _SSN, _DATE, _IP, _CARD, _IBAN))

_DAYS, _FIRST_DAY, _LOW_RADIX = 146097, "1800-01-01", 773
#: Of those days, the ones after the 12th of a month.
_LATE_DAYS, _LATE_LOW_RADIX = 88497, 9833


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _permuted(kind: Column, values: Column, radices: Column, key: str) -> Column:
    """The Feistel network: a permutation of the lists with these radices."""
    half = F.floor(F.size(values) / 2).cast("int")

    def round_(now: Column, r: Column) -> Column:
        other = F.array_join(F.when(r % 2 == 0, F.slice(now, half + 1, F.size(values) - half))
                             .otherwise(F.slice(now, 1, half)).cast("array<string>"), ",")
        salt = F.concat_ws("|", F.lit(key), kind, F.size(values).cast("string"), r.cast("string"), other)

        def step(salt: Column, x: Column, i: Column) -> Column:
            drawn = F.conv(F.substring(F.sha2(F.concat_ws("|", salt, i.cast("string")), 256), 1, 12), 16, 10).cast("long")
            return F.when((i < half) == (r % 2 == 0), (x + drawn) % F.get(radices, i)).otherwise(x)

        return _let(salt, lambda known: F.transform(now, lambda x, i: step(known, x, i)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values, round_)


def _only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _numbers(text: Column) -> Column:
    return F.transform(_characters(text), lambda c: c.cast("long"))


def _check_digit(payload: Column) -> Column:
    """The digit that makes a card number valid, from the digits before it (a list of numbers)."""
    n = F.size(payload)
    doubled = F.transform(payload, lambda d, i: F.when(
        (n - i) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return (10 - F.aggregate(doubled, F.lit(0).cast("long"), lambda s, d: s + d) % 10) % 10


def _first_day() -> Column:
    return F.lit(_FIRST_DAY).cast("date")


def _day(value: Column) -> Column:
    """The date a value means, or null; with slashes month first, if that is a date."""
    a, b, c = (F.get(F.split(value, "[./-]"), F.lit(k)) for k in range(3))

    def valid(*parts: Column) -> Column:
        day = F.concat_ws("-", *parts).try_cast("date")
        return F.when(F.datediff(day, _first_day()).between(0, _DAYS - 1), day)

    return (F.when(value.rlike("^[0-9]{4}"), valid(a, b, c))
            .when(value.contains("/"), F.coalesce(valid(c, a, b), valid(c, b, a)))
            .otherwise(valid(c, b, a)))


def _day_first(value: Column) -> Column:
    """Whether a date with slashes has its day first: one after the 12th."""
    return value.contains("/") & ~value.rlike("^[0-9]{4}") & (F.substring_index(value, "/", 1).cast("int") > 12)


def _late_days_before(month: Column) -> Column:
    """Days after the 12th in the months before that one; months are numbered from the first day's."""
    return F.datediff(F.add_months(_first_day(), month), _first_day()) - 12 * month


def _late_day(number: Column) -> Column:
    """The day after the 12th with that number."""
    near = F.floor(number * 4800 / _LATE_DAYS).cast("int")  # the month, or one beside it
    month = F.array_max(F.filter(F.sequence(near - 1, near + 1), lambda m: _late_days_before(m) <= number))
    return _let(month, lambda m: F.date_add(F.add_months(_first_day(), m), (number - _late_days_before(m) + 12).cast("int")))


def _day_number(value: Column) -> Column:
    """The number of a value's date: of all days, or where the day is first, of those after the 12th."""
    return _let(_day(value), lambda day: F.datediff(day, _first_day()) - F.when(
        _day_first(value), 12 * ((F.year(day) - int(_FIRST_DAY[:4])) * 12 + F.month(day))).otherwise(0)).cast("long")


def _low_radix(value: Column) -> Column:
    return F.when(_day_first(value), _LATE_LOW_RADIX).otherwise(_LOW_RADIX).cast("long")


def _iban_check(value: Column) -> Column:
    """The check digits that make an IBAN valid, from its other characters (no spaces)."""
    rest = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 2), F.lit("00"))
    left = F.aggregate(_characters(rest), F.lit(0).cast("long"), lambda s, c: F.when(
        c.rlike("[0-9]"), s * 10 + c.cast("long")).otherwise(s * 100 + F.ascii(c) - 55) % 97)
    return F.lpad((98 - left).cast("string"), 2, "0")


def _no_spaces(value: Column) -> Column:
    return F.regexp_replace(value, " ", "")


def _national(value: Column) -> Column:
    """The digits of a phone number after its country code."""
    digits = _only_digits(value)
    return (F.when(value.startswith("+"), F.regexp_replace(digits, _COUNTRY, ""))
            .otherwise(F.substring(digits, F.length(digits) - 9, F.lit(10))))


def _codes(text: Column) -> Column:
    return F.transform(_characters(text), lambda c: F.ascii(c).cast("long"))


def _email_name(value: Column) -> Column:
    return _codes(F.substring_index(value, "@", 1))


def _account(value: Column) -> Column:
    """The characters of an IBAN after its check digits."""
    return _codes(F.substring(_no_spaces(value), 5, 30))


def _first_of_class(code: Column) -> Column:
    """The code of 0, A or a for digits and letters; others stand for themselves."""
    return (F.when(code.between(48, 57), 48).when(code.between(65, 90), 65).when(code.between(97, 122), 97)
            .otherwise(code).cast("long"))


def kind_of(value: Column) -> Column:
    """Which kind a found value validates as; null if none."""
    digits = _numbers(_only_digits(value))
    return (F.when(value.contains("@"), "email")
            .when(value.rlike(f"^(?:{_PHONE})$"), "phone")
            .when(value.rlike(f"^(?:{_SSN})$"), "ssn")
            .when(value.rlike(f"^(?:{_DATE})$"), F.when(_day(value).isNotNull(), "date"))
            .when(value.rlike(f"^(?:{_IP})$"), F.when(
                F.forall(F.split(value, r"\."), lambda x: x.cast("int") <= 255), "ip"))
            .when(value.rlike("^[A-Z]"), _let(_no_spaces(value), lambda v: F.when(F.substring(v, 3, 2) == _iban_check(v), "iban")))
            .when(_let(digits, lambda d: F.get(d, F.size(d) - 1) == _check_digit(F.slice(d, 1, F.size(d) - 1))), "card"))


def _values(x: Column) -> Column:
    """The list of numbers that is permuted: of a mail address its name, of a phone number the digits after the country code."""
    value, digits = x["value"], _only_digits(x["value"])
    low = _low_radix(value)
    return (F.when(x["kind"] == "email", F.transform(_email_name(value), lambda c: c - _first_of_class(c)))
            .when(x["kind"] == "phone", _numbers(_national(value)))
            .when(x["kind"] == "iban", F.transform(_account(value), lambda c: c - _first_of_class(c)))
            .when(x["kind"] == "ssn", _numbers(digits))
            .when(x["kind"] == "date", _let(_day_number(value), lambda n: F.array(F.floor(n / low), n % low)))
            .when(x["kind"] == "ip", F.transform(F.split(value, r"\."), lambda b: b.cast("long")))
            .when(x["kind"] == "card", _numbers(F.substring(digits, F.lit(1), F.length(digits) - 1))))


def _radices(x: Column) -> Column:
    same = lambda radix: F.transform(x["values"], lambda _: F.lit(radix).cast("long"))
    letters = lambda codes: F.transform(codes, lambda c: F.when(c.between(48, 57), 10)
                                        .when(c.between(65, 90) | c.between(97, 122), 26).otherwise(1).cast("long"))
    high = F.when(_day_first(x["value"]), _LATE_DAYS // _LATE_LOW_RADIX).otherwise(_DAYS // _LOW_RADIX).cast("long")
    return (F.when(x["kind"] == "email", letters(_email_name(x["value"]))).when(x["kind"] == "ip", same(256))
            .when(x["kind"] == "iban", letters(_account(x["value"])))
            .when(x["kind"] == "date", F.array(high, _low_radix(x["value"])))
            .otherwise(same(10)))


def _digits_after(x: Column) -> Column:
    """All digits of the pseudonym of a phone, ssn or card number; all characters of an IBAN's, without spaces."""
    old, moved = _only_digits(x["value"]), F.array_join(x["moved"].cast("array<string>"), "")
    return (F.when(x["kind"] == "phone", F.concat(F.substring(old, F.lit(1), F.length(old) - F.size(x["moved"])), moved))
            .when(x["kind"] == "ssn", moved)
            .when(x["kind"] == "card", F.concat(moved, _check_digit(x["moved"]).cast("string")))
            .when(x["kind"] == "iban", _let(F.concat(F.substring(x["value"], 1, 4), F.array_join(F.zip_with(
                x["moved"], _account(x["value"]), lambda m, c: F.char(m + _first_of_class(c))), "")),
                lambda v: F.concat(F.substring(v, 1, 2), _iban_check(v), F.substring(v, 5, 30)))))


def _written(x: Column) -> Column:
    """The pseudonym in the value's own format; null where the kind is null."""
    value, moved = x["value"], x["moved"]
    name = F.zip_with(moved, _email_name(value), lambda m, c: F.char(m + _first_of_class(c)))
    number = (F.get(moved, F.lit(0)) * _low_radix(value) + F.get(moved, F.lit(1))).cast("int")
    day = F.when(_day_first(value), _late_day(number)).otherwise(F.date_add(_first_day(), number))
    sep, short = F.regexp_extract(value, "[./-]", 0), value.rlike("(?:^|[./-])[0-9](?:[./-]|$)")

    def date(d: Column) -> Column:
        yyyy, mm, dd = F.date_format(d, "yyyy"), *(F.when(short, F.date_format(d, p)).otherwise(F.date_format(d, p * 2)) for p in "Md")
        return (F.when(value.rlike("^[0-9]{4}"), F.concat(yyyy, sep, mm, sep, dd))
                .when(value.contains("/") & ~_day_first(value), F.concat(mm, sep, dd, sep, yyyy))
                .otherwise(F.concat(dd, sep, mm, sep, yyyy)))

    iban = F.array_join(F.transform(_characters(value), lambda c, i: F.when(
        c != " ", F.substring(x["digits"], F.length(_no_spaces(F.substring(value, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")
    digits = F.array_join(F.transform(_characters(value), lambda c, i: F.when(
        c.rlike("^[0-9]$"), F.substring(x["digits"], F.length(_only_digits(F.substring(value, F.lit(1), i + 1))), F.lit(1)))
        .otherwise(c)), "")
    return (F.when(x["kind"] == "email", F.concat(
                F.array_join(name, ""), F.substring(value, F.size(moved) + 1, F.length(value))))
            .when(x["kind"] == "date", _let(day, date))
            .when(x["kind"] == "iban", iban)
            .when(x["kind"] == "ip", F.array_join(moved.cast("array<string>"), "."))
            .when(x["kind"].isNotNull(), digits))


def pseudonyms(values: Column, key: str) -> Column:
    """(value, kind, pseudonym) of each found value; kind and pseudonym null where it isn't valid.

    Step by step, so that each step's result is computed once a value.
    """
    def step(items: Column, old: list[str], **new) -> Column:
        return F.transform(items, lambda x: F.struct(*[x[c].alias(c) for c in old], *[f(x).alias(c) for c, f in new.items()]))

    items = F.transform(values, lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")))
    items = step(items, ["value", "kind"], values=_values)
    items = step(items, ["value", "kind", "values"], radices=_radices)
    items = step(items, ["value", "kind"], moved=lambda x: F.when(
        x["kind"].isNotNull(), _permuted(x["kind"], x["values"], x["radices"], key)))
    items = step(items, ["value", "kind", "moved"], digits=_digits_after)
    return step(items, ["value", "kind"], pseudonym=_written)


def pseudonymized(docs: DataFrame, text_col: str = "text", key: str = EXAMPLE_KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``, and ``pii`` (value, kind, pseudonym of each replaced one, in order).

    No shuffle: each row is rewritten where it is read. Null text stays null
    with an empty list; empty text stays empty. Repeated rows and equal
    values get equal pseudonyms. A column of ``docs`` named ``pii`` is
    replaced; all others are kept. Time grows with the length of a text,
    whatever it holds; of a mail address whose name has more than 64
    characters only what follows a punctuation mark in it can be found.
    """
    text = F.col(text_col)
    none = F.array().cast("array<string>")
    # most texts have nothing that the long pattern could match
    some = F.coalesce(text.rlike("[0-9@]"), F.lit(False))
    found = F.when(some, F.regexp_extract_all(text, F.lit(VALUES), F.lit(0))).otherwise(none)
    names = [c for c in docs.columns if c != "pii"]
    listed = (docs.select(*names, found.alias("__found"))
              .withColumn("__gaps", F.when(F.size("__found") > 0, F.split(text, VALUES, -1)))
              .withColumn("__listed", pseudonyms(F.col("__found"), key)))
    parts = F.transform("__listed", lambda x, i: F.concat(F.coalesce(x["pseudonym"], x["value"]), F.get("__gaps", i + 1)))
    new_text = (F.when(F.size("__listed") == 0, text)
                .otherwise(F.concat(F.get("__gaps", F.lit(0)), F.array_join(parts, ""))))
    return listed.select(*[new_text.alias(c) if c == text_col else F.col(c) for c in names],
                         F.filter("__listed", lambda x: x["kind"].isNotNull()).alias("pii"))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = pseudonymized(docs)
    return out.select("doc_id", "text", F.size("pii").cast("long").alias("n_pii"),
                      F.array_join(F.transform("pii", lambda x: x["kind"]), ",").alias("kinds"))
