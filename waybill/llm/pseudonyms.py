"""Pseudonyms for personal data that keep the format, by keyed permutations.

Numbers and dates that pass their validity rules are permuted within the set of
valid values of their format, so equal values get equal pseudonyms in every
document and the text stays well-formed: payment card numbers keep their length
and their check digit rule, social security numbers their ranges, addresses
their four octets, dates the calendar, phone numbers their prefix and layout.
Mail addresses are no numbers; they become a keyed digest in address form.

Dates may have the year, the day, or between slashes the month first, days and
months of one digit, or English names of months. Where day and month could
change places the day comes first: 04/07/1990 is the 4th of July, 12/25/1990 can
only be month first. A pseudonym is written in the form its date was read in.

The permutation is a Feistel network over two halves of sizes `a` and `b`, whose
product is the number of valid values: rounds add a keyed hash of one half to
the other, modulo its size, in turn. That is a bijection on exactly these
values, so no step has to be repeated until it lands among them.

Everything is DataFrame functions. Texts are cut at the matches of one pattern
and joined again with the replacements in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.columns import free_name, hash60, quoted

ROUNDS = 8
KINDS = ("mail", "date", "card", "social", "address", "phone")

# The formats.
# A domain goes on to the last label that begins with two letters. Labels are taken for good (`++`, `*+`), as the JVM
# calls itself once for every round of a group that it may give back.
_LABEL, _NO_NAME = r"[A-Za-z0-9-]++", r"(?:\.(?![A-Za-z]{2})[A-Za-z0-9-]++)*+"
DOMAIN = (rf"{_LABEL}{_NO_NAME}\.(?:[A-Za-z]{{2}}[A-Za-z0-9-]*+(?={_NO_NAME}\.[A-Za-z]{{2}}){_NO_NAME}\.)*+"
          r"[A-Za-z]{2,}")
MAIL = rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@{DOMAIN}"
DAY, MONTH, YEAR = r"(?:0?[1-9]|[12]\d|3[01])", r"(?:0?[1-9]|1[0-2])", r"(?:19|20)\d\d"
NAME = (r"(?i:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?"
        r"|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)")
DATE = (rf"(?<![0-9A-Za-z./-])(?:{YEAR}-{MONTH}-{DAY}|{DAY}/{MONTH}/{YEAR}|{MONTH}/{DAY}/{YEAR}|{DAY}\.{MONTH}\.{YEAR}"
        rf"|{DAY} {NAME} {YEAR}|{NAME} {DAY},? {YEAR})(?![0-9A-Za-z]|[./-]\d)")
CARD = (r"(?<![0-9A-Za-z+])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![0-9A-Za-z])")
SOCIAL = r"(?<![0-9A-Za-z-])\d{3}-\d{2}-\d{4}(?![0-9A-Za-z]|-\d)"
ADDRESS = (r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
           r"(?![0-9A-Za-z]|\.\d)")
PHONE = (r"(?<![0-9A-Za-z+])(?:(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}"
         r"|(?:\+\d{1,3}[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5})(?![0-9A-Za-z])")
ANY = "|".join((MAIL, DATE, CARD, SOCIAL, ADDRESS, PHONE))
MAYBE = "[0-9@]"

# 1900-01-01 to 2099-12-31 are 73,049 days, 17 times 4,297.
FIRST_DAY = "1900-01-01"
DAY_SIZES = (17, 4297)
# What a date looks like and its form; the first one that gives a valid date counts.
DATE_FORMS = (
    ("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"), ("^[0-9]{4}-", "yyyy-M-d"),
    ("^[0-9]{2}/[0-9]{2}/", "dd/MM/yyyy"), ("^[0-9]{2}/[0-9]{2}/", "MM/dd/yyyy"), ("/", "d/M/yyyy"), ("/", "M/d/yyyy"),
    ("^[0-9]{2}[.][0-9]{2}[.]", "dd.MM.yyyy"), ("[.]", "d.M.yyyy"),
    ("^[0-9]+ [A-Za-z]", "d MMMM yyyy"), ("^[0-9]+ [A-Za-z]", "d MMM yyyy"),
    ("^[A-Za-z].*,", "MMMM d, yyyy"), ("^[A-Za-z].*,", "MMM d, yyyy"),
    ("^[A-Za-z][^,]*$", "MMMM d yyyy"), ("^[A-Za-z][^,]*$", "MMM d yyyy"))
# Areas 001 to 899 without 666; groups 01 to 99 with serials 0001 to 9999.
SOCIAL_SIZES = (898, 99 * 9999)
PHONE_DIGITS = 10


def _whole(value: Column) -> Column:
    return value.cast("bigint")


def _quotient(value: Column, by: Column | int) -> Column:
    return F.call_function("div", value, by if isinstance(by, Column) else F.lit(by))


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, rounds: int = ROUNDS) -> Column:
    """The struct `l`, `r` into which a keyed permutation of pairs below `a` and `b` takes a pair."""
    def step(state: Column, number: Column) -> Column:
        even = number % 2 == 0
        other = F.when(even, state["r"]).otherwise(state["l"])
        moved = hash60(F.lit(key), number.cast("string"), other.cast("string"))
        return F.struct(F.when(even, F.pmod(state["l"] + moved, a)).otherwise(state["l"]).alias("l"),
                        F.when(even, state["r"]).otherwise(F.pmod(state["r"] + moved, b)).alias("r"))

    start = F.struct(_whole(left).alias("l"), _whole(right).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)


def _using(value: Column, function) -> Column:
    """`function` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), function), 1)


def permute_digits(digits: Column, key: str) -> Column:
    """A keyed permutation of the digit strings of each length from 2 to 18."""
    size = F.length(digits)
    head = F.floor(size / 2).cast("int")
    tail = size - head
    ten = F.lit(10.0)
    halves = feistel(F.substr(digits, F.lit(1), head), F.substr(digits, head + 1, tail),
                     _whole(F.pow(ten, head)), _whole(F.pow(ten, tail)), key)
    return _using(halves, lambda pair: F.concat(F.lpad(pair["l"].cast("string"), head, F.lit("0")),
                                                F.lpad(pair["r"].cast("string"), tail, F.lit("0"))))


def luhn_sum(digits: Column) -> Column:
    """The weighted digit sum that is a multiple of ten for a valid card number."""
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(digits, size + 1 - place, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add)


def _card(digits: Column, key: str) -> Column:
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    return _using(permute_digits(body, f"card {key}"), lambda moved: F.concat(
        moved, F.pmod(10 - F.pmod(luhn_sum(F.concat(moved, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")))


def _social_valid(digits: Column) -> Column:
    area, group, serial = (F.substr(digits, F.lit(low), F.lit(size)) for low, size in ((1, 3), (4, 2), (6, 4)))
    return (area < "900") & ~area.isin("000", "666") & (group != "00") & (serial != "0000")


def _social(digits: Column, key: str) -> Column:
    area, group, serial = (F.substr(digits, F.lit(low), F.lit(size)).cast("bigint")
                           for low, size in ((1, 3), (4, 2), (6, 4)))
    left = area - 1 - F.when(area > 666, 1).otherwise(0)
    right = (group - 1) * 9999 + serial - 1
    a, b = SOCIAL_SIZES
    moved = feistel(left, right, _whole(F.lit(a)), _whole(F.lit(b)), f"social {key}")
    return _using(moved, lambda pair: F.concat(
        F.lpad((pair["l"] + 1 + F.when(pair["l"] >= 665, 1).otherwise(0)).cast("string"), 3, "0"),
        F.lpad((_quotient(pair["r"], 9999) + 1).cast("string"), 2, "0"),
        F.lpad((pair["r"] % 9999 + 1).cast("string"), 4, "0")))


def _address(found: Column, key: str) -> Column:
    octet = [F.element_at(F.split(found, r"\."), i).cast("bigint") for i in range(1, 5)]
    size = _whole(F.lit(1 << 16))
    moved = feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], size, size, f"address {key}")
    return _using(moved, lambda pair: F.concat_ws(
        ".", *[part.cast("string") for half in (pair["l"], pair["r"]) for part in (_quotient(half, 256), half % 256)]))


def _day(found: Column) -> Column:
    """The date a match stands for; null if the calendar has none."""
    return F.coalesce(*[F.when(found.rlike(look), F.try_to_date(found, form)) for look, form in DATE_FORMS])


def _date(found: Column, key: str) -> Column:
    first, (a, b) = F.to_date(F.lit(FIRST_DAY)), DAY_SIZES
    days = _whole(F.datediff(_day(found), first))
    moved = feistel(_quotient(days, b), days % b, _whole(F.lit(a)), _whole(F.lit(b)), f"date {key}")
    day = _using(moved, lambda pair: F.date_add(first, (pair["l"] * b + pair["r"]).cast("int")))
    return _using(day, lambda day: F.coalesce(*[
        F.when(found.rlike(look) & F.try_to_date(found, form).isNotNull(), F.date_format(day, form))
        for look, form in DATE_FORMS]))


def _with_digits(found: Column, digits: Column) -> Column:
    """A match with its digits replaced one by one."""
    start = F.struct(F.lit("").alias("out"), digits.alias("rest"))

    def put(state: Column, character: Column) -> Column:
        digit = character.rlike("^[0-9]$")
        return F.struct(
            F.concat(state["out"], F.when(digit, F.substring(state["rest"], 1, 1)).otherwise(character)).alias("out"),
            F.when(digit, F.substr(state["rest"], F.lit(2))).otherwise(state["rest"]).alias("rest"))

    return F.aggregate(F.split(found, ""), start, put, lambda state: state["out"])


def _phone(digits: Column, key: str) -> Column:
    """Only the last digits change; what stands before them is the country."""
    kept = F.greatest(F.length(digits) - PHONE_DIGITS, F.lit(0))
    return F.concat(F.substr(digits, F.lit(1), kept), permute_digits(F.substr(digits, kept + 1), f"phone {key}"))


def kind_of(found: Column) -> Column:
    """The kind of a match of `ANY`; null if it is not valid."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    return (F.when(found.contains("@"), "mail")
            .when(found.rlike(f"^(?:{DATE})$"), F.when(_day(found).isNotNull(), "date"))
            .when(found.rlike(f"^(?:{ADDRESS})$"), "address")
            .when(found.rlike(f"^(?:{SOCIAL})$"), F.when(_social_valid(digits), "social"))
            .when(found.rlike(f"^(?:{CARD})$"), F.when(luhn_sum(digits) % 10 == 0, "card"))
            .otherwise("phone"))


def pseudonym(found: Column, kind: Column, key: str) -> Column:
    """The replacement of a match of a kind; the match itself without one."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    mail = F.concat(F.lit("user-"), F.substring(F.sha2(F.concat(F.lit(f"mail {key}|"), F.lower(found)), 256), 1, 12),
                    F.lit("@mail.example"))
    return (F.when(kind == "mail", mail)
            .when(kind == "date", _date(found, key))
            .when(kind == "address", _address(found, key))
            .when(kind == "social", _with_digits(found, _social(digits, key)))
            .when(kind == "card", _with_digits(found, _card(digits, key)))
            .when(kind == "phone", _with_digits(found, _phone(digits, key)))
            .otherwise(found))


def _of_kind(kind: str):
    return lambda one: one["kind"] == kind


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """The columns of `docs`, with pseudonyms in `text`, and the number of
    replaced values of each kind in `n_mail`, `n_date`, `n_card`, `n_social`,
    `n_address`, `n_phone` (with underscores appended if a name is taken).

    What looks like a number or date but is not valid stays. A null text stays
    null, with counts of zero; an empty text stays empty. Rows are independent,
    so repeated rows stay equal; an empty table gives an empty result.
    """
    cut, counts = free_name(docs, "_cut"), [free_name(docs, f"n_{kind}") for kind in KINDS]
    matches = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))

    def replaced(found: Column) -> Column:
        return _using(kind_of(found), lambda kind: F.struct(kind.alias("kind"), pseudonym(found, kind, key).alias("put")))

    found = F.when(F.col("text").rlike(MAYBE), F.transform(matches, replaced))
    between = F.split("text", ANY, -1)
    puts = F.concat(F.transform(cut, lambda one: one["put"]), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(between, puts, lambda text, put: F.concat(text, put)), "")
    text = F.when(F.size(cut) > 0, joined).otherwise(F.col("text"))
    marked = docs.withColumn(cut, found)
    return marked.select(
        *[text.alias(name) if name == "text" else F.col(quoted(name)) for name in docs.columns],
        *[F.coalesce(F.size(F.filter(cut, _of_kind(kind))), F.lit(0)).alias(name)
          for kind, name in zip(KINDS, counts)])
