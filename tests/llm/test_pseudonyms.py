import datetime
import hashlib
import random
import re

from pyspark.sql import functions as F

from waybill.llm import pseudonyms
from waybill.llm.pseudonyms import DAY_SIZES, SOCIAL_SIZES, feistel, pseudonymize

KEY = "test key"


def brute_feistel(left, right, a, b, key):
    for number in range(1, pseudonyms.ROUNDS + 1):
        other = right if number % 2 == 0 else left
        moved = int(hashlib.sha256(f"{key}|{number}|{other}".encode()).hexdigest()[:15], 16)
        if number % 2 == 0:
            left = (left + moved) % a
        else:
            right = (right + moved) % b
    return left, right


def brute_digits(digits, key):
    head = len(digits) // 2
    tail = len(digits) - head
    left, right = brute_feistel(int(digits[:head]), int(digits[head:]), 10 ** head, 10 ** tail, key)
    return f"{left:0{head}d}{right:0{tail}d}"


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def put(text, digits):
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in text)


def brute_card(text):
    body = brute_digits(re.sub(r"\D", "", text)[:-1], f"card {KEY}")
    return put(text, next(body + str(c) for c in range(10) if luhn(body + str(c))))


def brute_phone(text):
    digits = re.sub(r"\D", "", text)
    kept = max(len(digits) - 10, 0)
    return put(text, digits[:kept] + brute_digits(digits[kept:], f"phone {KEY}"))


def brute_address(text):
    o = list(map(int, text.split(".")))
    left, right = brute_feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, f"address {KEY}")
    return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"


def brute_date(text, form):
    first = datetime.date(1900, 1, 1)
    days = (datetime.datetime.strptime(text, form).date() - first).days
    left, right = brute_feistel(days // 4297, days % 4297, *DAY_SIZES, f"date {KEY}")
    return (first + datetime.timedelta(left * 4297 + right)).strftime(form)


def brute_social(text):
    area, group, serial = map(int, text.split("-"))
    left, right = brute_feistel(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, *SOCIAL_SIZES, f"social {KEY}")
    area = left + 1 + (left >= 665)
    return f"{area:03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}"


def brute_mail(text):
    return f"user-{hashlib.sha256(f'mail {KEY}|{text.lower()}'.encode()).hexdigest()[:12]}@mail.example"


VALUES = [
    ("mail", "Ab.c@mail1.example.com", brute_mail), ("card", "4349000490986231", brute_card),
    ("card", "4349 0004 9098 6231", brute_card), ("card", "3782-822463-10005", brute_card),
    ("phone", "+1 (334) 555-3192", brute_phone), ("phone", "555-123-4567", brute_phone),
    ("phone", "+44 20 7946 0958", brute_phone), ("address", "64.149.193.29", brute_address),
    ("address", "255.0.0.1", brute_address), ("social", "123-45-6789", brute_social),
    ("social", "899-99-9999", brute_social), ("social", "667-01-0001", brute_social),
    ("date", "1987-02-28", lambda t: brute_date(t, "%Y-%m-%d")), ("date", "29/02/2000", lambda t: brute_date(t, "%d/%m/%Y")),
    ("date", "01.01.1900", lambda t: brute_date(t, "%d.%m.%Y")),
    ("date", "2099-12-31", lambda t: brute_date(t, "%Y-%m-%d")),
]
UNTOUCHED = ["4349000490986232", "666-45-6789", "900-12-1234", "123-00-1234", "31/02/1987", "2001-02-29", "256.1.1.1",
             "1.2.3", "4349000490986231x", "a64.149.193.29", "917ea4e9feb9cda83477b57ac2654884f485", "12345", "a@b"]


def test_against_brute_force(documents):
    rng = random.Random(2)
    rows, expected = [], []
    for number in range(60):
        parts, count, out = [], dict.fromkeys(pseudonyms.KINDS, 0), []
        for _ in range(rng.randrange(6)):
            word = rng.choice(["", "word", "é\n", "$1 \\"])
            if rng.random() < 0.7:
                kind, value, brute = rng.choice(VALUES)
                count[kind] += 1
                out += [word, brute(value)]
            else:
                value = rng.choice(UNTOUCHED)
                out += [word, value]
            parts += [word, value]
        rows.append((number, " ; ".join(parts)))
        expected.append((number, " ; ".join(out), *count.values()))
    rows += [(100, None), (101, ""), (101, ""), (102, "1" * 40), (103, "x" * 200_000 + " 1987-02-28")]
    zero = (0,) * 6
    expected += [(100, None, *zero), (101, "", *zero), (101, "", *zero), (102, "1" * 40, *zero),
                 (103, "x" * 200_000 + " " + brute_date("1987-02-28", "%Y-%m-%d"), 0, 1, 0, 0, 0, 0)]
    found = pseudonymize(documents(rows), KEY).drop("lang", "source", "n_chars").collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_forms_of_dates(documents):
    forms = [("12/25/1990", "%m/%d/%Y"), ("04/07/1990", "%d/%m/%Y"), ("4/7/1990", "%d/%m/%Y"), ("4/27/1990", "%m/%d/%Y"),
             ("04/7/1990", "%d/%m/%Y"), ("7.4.1990", "%d.%m.%Y"), ("1990-4-7", "%Y-%m-%d"), ("7 April 1990", "%d %B %Y"),
             ("17 Apr 1990", "%d %b %Y"), ("April 7, 1990", "%B %d, %Y"), ("dec 31, 1990", "%b %d, %Y"),
             ("FEBRUARY 28 1990", "%B %d %Y")]
    stay = ["2/30/1990", "13/13/1990", "February 30, 1990", "1990-13-1", "1/2/90", "May 1990", "11/2/1990/5", "Mayor 5 1990"]
    found = {row.doc_id: row for row in pseudonymize(documents(
        [(i, f"born {text}, ok") for i, text in enumerate([one for one, _ in forms] + stay)]), KEY).collect()}
    for i, (text, form) in enumerate(forms):
        out = brute_date(text, form)
        if not re.match(r"\d\d/\d\d/", text):  # one digit where one is enough
            out = re.sub(r"\b0", "", out)
        assert (found[i].text, found[i].n_date) == (f"born {out}, ok", 1)
    for i, text in enumerate(stay, len(forms)):
        assert (found[i].text, found[i].n_date) == (f"born {text}, ok", 0)


def test_permutations(spark):
    """Every value of a small domain is hit once."""
    pairs = spark.range(35).select((F.col("id") % 5).alias("a"), F.expr("id div 5").alias("b"))
    moved = pairs.select(feistel(F.col("a"), F.col("b"), F.lit(5).cast("bigint"), F.lit(7).cast("bigint"), KEY).alias("p"))
    assert {(r.p.l, r.p.r) for r in moved.collect()} == {(a, b) for a in range(5) for b in range(7)}


def test_no_python_in_the_plan(documents):
    plan = pseudonymize(documents([(1, "x")]), KEY)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_and_clashing(documents, clashing):
    assert pseudonymize(documents([]), KEY).count() == 0
    docs = clashing(documents([(1, "64.149.193.29")]), "N_mail", "_cut", "a b")
    row = pseudonymize(docs, KEY).first()
    assert (row["N_mail"], row["n_mail_"], row["n_address"], row["_cut"], row["a b"]) == ("own N_mail", 0, 1, "own _cut", "own a b")


OLD_MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"


def test_mail_pattern_gives_nothing_back():
    """The pattern without steps back finds what the plain one finds."""
    rng = random.Random(1)
    parts = ["a", "b1", "com", "c", ".", ".", "@", "-", "1", " ", "x@", "x@a.", "x@b.com"]
    for _ in range(60_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        assert [m.span() for m in re.finditer(OLD_MAIL, text)] == [m.span() for m in re.finditer(pseudonyms.MAIL, text)], text


def test_long_runs(documents):
    """A megabyte of what each pattern repeats, and mail addresses of that size."""
    rows = [(i, part * (1_000_000 // len(part)) + " end") for i, part in enumerate(
        ["a.", "1.", "1 ", "+1-", "@a", "a@", "1-", "a@b.", "a-", "12 ", "123-", "1/", "May ", "(1)", "a%"])]
    mail = "x@" + "a." * 500_000 + "com"
    rows += [(100, f"to {mail} now"), (101, "x@" + "a1.b2." * 150_000), (102, "a" * 500_000 + "@b.de"), (103, "x@" + "ab." * 300_000 + "c")]
    found = {row.doc_id: row for row in pseudonymize(documents(rows), KEY).collect()}
    assert found[100].text == f"to {brute_mail(mail)} now" and found[102].text == brute_mail(rows[-2][1])
    assert found[103].text == brute_mail("x@" + "ab." * 299_999 + "ab") + ".c"
    for i, text in rows:
        if i not in (100, 102, 103):
            assert (found[i].text, [found[i][f"n_{kind}"] for kind in pseudonyms.KINDS]) == (text, [0] * 6), text[:20]
