"""Format-preserving Feistel pseudonyms of personal data, in DataFrame functions only.

Validated values (card numbers by Luhn, IBANs by modulo 97, calendar dates, IPv4 octets,
North American phone numbers and social security numbers by their ranges) are replaced by
another value of the same format through a keyed permutation, so equal values stay linked
across documents and the same key maps them back. E-mail addresses, access keys and
secrets are permuted sign by sign within their alphabets.

Two Feistel networks are used. ``permute_signs`` swaps and adds two halves of a string,
each sign within its own alphabet. ``permute_pair`` does the same to a pair of numbers
modulo two sizes whose product is the number of valid values, so no walk to a valid value
is needed. The round function is SHA-256 of key, kind, round and the other half.

Scale: one projection over the rows, no shuffle and no Python. The one pattern is applied
only to texts that hold a digit or an @, as all kinds do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.schemas import unused

ROUNDS = 8  # even, so halves of unequal length end where they began
KEY = "tidecast"

# The patterns of the kinds of value looked for, in order of preference.
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9][A-Za-z0-9.\-]*\.[A-Za-z]{2,}"
SECRET = r"""(?i:(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key))\s{0,3}[=:]\s{0,3}"?[^\s"]{5,}[^\s"'.,;:!?)\]]"""
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
DATE_ISO = r"(?<![0-9\-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9\-])"
DATE_SLASH = r"(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9/])"
DATE_DOT = r"(?<![0-9.])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9])(?!\.[0-9])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])"
SSN = r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])"
PHONE = (r"(?<![0-9A-Za-z])\+1[ .\-]?\(?[0-9]{3}\)?[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])"
         r"|(?<![0-9A-Za-z])\+[2-9][0-9]{0,2}[ .\-]?\(?[0-9]{2,4}\)?(?:[ .\-]?[0-9]{2,4}){2,3}(?![0-9])"
         r"|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z.\-])[0-9]{3}([.\-])[0-9]{3}\1[0-9]{4}(?![0-9])")
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9])"
KINDS = (EMAIL, SECRET, ACCESS_KEY, IBAN, DATE_ISO, DATE_SLASH, DATE_DOT, IPV4, SSN, PHONE, CARD)
FOUND = "|".join(KINDS)
HEX = "0123456789abcdef"


# ---- keyed permutations ---------------------------------------------------------------

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _keyed(key: str, *parts: Column | str) -> Column:
    """48 bits of SHA-256 as a long."""
    text = F.concat_ws("|", F.lit(key), *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def _shift(sign: Column, by: Column, hexadecimal: Column) -> Column:
    """Moves a sign within digits, small or large letters (or hexadecimal digits); others stay."""
    def within(first: str, size: int) -> Column:
        return F.char(F.lit(ord(first)) + F.pmod(F.ascii(sign) - ord(first) + by, F.lit(size)))

    return (F.when(hexadecimal & sign.rlike("^[0-9a-f]$"), F.substring(F.lit(HEX), (F.pmod(F.instr(F.lit(HEX), sign) - 1 + by, F.lit(16)) + 1).cast("int"), 1))
            .when(sign.rlike("^[0-9]$"), within("0", 10)).when(sign.rlike("^[a-z]$"), within("a", 26))
            .when(sign.rlike("^[A-Z]$"), within("A", 26)).otherwise(sign))


def permute_signs(value: Column, key: str, kind: Column | str, hexadecimal: Column | None = None) -> Column:
    """Feistel permutation of strings that keeps length, sign classes and other signs."""
    hexadecimal = F.lit(False) if hexadecimal is None else hexadecimal

    def halves(v: Column) -> Column:
        n = F.length(v)
        half = F.floor(n / 2).cast("int")

        def signs(begin: Column, count: Column) -> Column:
            return F.when(count > 0, F.transform(F.sequence(begin, begin + F.greatest(count, F.lit(1)) - 1), lambda i: F.substring(v, i, F.lit(1)))
                          ).otherwise(F.array().cast("array<string>"))

        return F.struct(signs(F.lit(1), half).alias("a"), signs(half + 1, n - half).alias("b"))

    def step(s: Column, r: Column) -> Column:
        moved = let(F.array_join(s["b"], ""), lambda other: F.transform(
            s["a"], lambda sign, i: let(_keyed(key, kind, r, i, other), lambda by: _shift(sign, by, hexadecimal))))
        return F.struct(s["b"].alias("a"), moved.alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), let(value, halves), step, lambda s: F.array_join(F.concat(s["a"], s["b"]), ""))


def permute_pair(x: Column, y: Column, nx: int, ny: int, key: str, kind: str, finish: Callable[[Column, Column], Column]) -> Column:
    """Feistel permutation of pairs (x, y) with 0 <= x < nx and 0 <= y < ny."""
    def step(s: Column, r: Column) -> Column:
        odd = r % 2 == 1
        return F.struct(F.when(odd, F.pmod(s["x"] + _keyed(key, kind, r, s["y"]), F.lit(nx))).otherwise(s["x"]).cast("long").alias("x"),
                        F.when(odd, s["y"]).otherwise(F.pmod(s["y"] + _keyed(key, kind, r, s["x"]), F.lit(ny))).cast("long").alias("y"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: finish(s["x"], s["y"]))


# ---- formats --------------------------------------------------------------------------

def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(value: Column, signs: Column, kept: str = "0-9") -> Column:
    """``value`` with its signs of the class ``kept`` replaced by ``signs`` in order."""
    def put(i: Column, signs: Column) -> Column:
        sign = F.substring(value, i, F.lit(1))
        place = F.length(F.regexp_replace(F.substring(value, F.lit(1), i), f"[^{kept}]", ""))
        return F.when(sign.rlike(f"^[{kept}]$"), F.substring(signs, place, F.lit(1))).otherwise(sign)

    return let(signs, lambda signs: F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: put(i, signs)), ""))


def _number(value: Column, begin: int, n: int) -> Column:
    return F.substring(value, begin, n).cast("int")


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum modulo 10; every second digit from the right is doubled, from the last or from the one before."""
    def add(total: Column, i: Column, digits: Column) -> Column:
        twice = (F.length(digits) - i) % 2 == (0 if doubled_last else 1)
        return total + let(F.substring(digits, i, F.lit(1)).cast("int"),
                           lambda d: F.when(twice, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))

    return let(digits, lambda v: F.aggregate(F.sequence(F.lit(1), F.length(v)), F.lit(0), lambda total, i: add(total, i, v)) % 10)


def _card(value: Column, key: str) -> Column:
    def renewed(digits: Column) -> Column:
        payload = permute_signs(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
        return let(payload, lambda p: F.concat(p, ((10 - luhn_sum(p, True)) % 10).cast("string")))

    return let(_digits(value), lambda digits: F.when(
        (luhn_sum(digits, False) == 0) & ~digits.rlike("^(.)\\1*$"), _refill(value, renewed(digits))).otherwise(value))


def _mod97(signs: Column) -> Column:
    def add(rest: Column, sign: Column) -> Column:
        return F.when(sign.rlike("^[0-9]$"), (rest * 10 + F.ascii(sign) - 48) % 97).otherwise((rest * 100 + F.ascii(sign) - 55) % 97)

    return let(signs, lambda v: F.aggregate(F.sequence(F.lit(1), F.length(v)), F.lit(0), lambda rest, i: add(rest, F.substring(v, i, F.lit(1)))))


def _iban(value: Column, key: str) -> Column:
    def change(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain) - 4)
        valid = (_mod97(F.concat(account, F.substring(plain, 1, 4))) == 1) & F.length(plain).between(15, 34)
        renewed = let(permute_signs(account, key, "iban"), lambda new: F.concat(
            country, F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0"), new))
        return F.when(valid, _refill(value, renewed, "0-9A-Z")).otherwise(value)

    return let(F.regexp_replace(value, " ", ""), change)


FIRST_DAY, DAYS_X, DAYS_Y = "1900-01-01", 17, 4297  # 17 * 4297 = 73049 days up to 2099-12-31


def _date(value: Column, key: str, year: Column, month: Column, day: Column, write: Callable[[Column, Column, Column], Column]) -> Column:
    y, m, d = year.cast("int"), month.cast("int"), day.cast("int")
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    last = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = y.between(1900, 2099) & m.between(1, 12) & (d >= 1) & (d <= last)
    number = F.date_diff(F.make_date(y, m, d), F.lit(FIRST_DAY).cast("date"))

    def finish(x: Column, rest: Column) -> Column:
        return let(F.date_add(F.lit(FIRST_DAY).cast("date"), (rest * DAYS_X + x).cast("int")),
                   lambda new: write(F.year(new), F.month(new), F.dayofmonth(new)))

    return F.when(valid, permute_pair(number % DAYS_X, F.floor(number / DAYS_X), DAYS_X, DAYS_Y, key, "date", finish)).otherwise(value)


def _parts_date(value: Column, key: str, mark: str, day_first: Column) -> Column:
    """Day and month in either order and a year; written with leading zeros unless the value has a part of one digit."""
    part = F.split(value, "[./]")
    wide = (F.length(part[0]) == 2) & (F.length(part[1]) == 2)

    def write(y: Column, m: Column, d: Column) -> Column:
        def two(c: Column) -> Column:
            return F.when(wide, F.lpad(c.cast("string"), 2, "0")).otherwise(c.cast("string"))
        return F.concat(F.when(day_first, two(d)).otherwise(two(m)), F.lit(mark), F.when(day_first, two(m)).otherwise(two(d)), F.lit(mark), y.cast("string"))

    return _date(value, key, part[2], F.when(day_first, part[1]).otherwise(part[0]), F.when(day_first, part[0]).otherwise(part[1]), write)


def _iso_date(value: Column, key: str) -> Column:
    return _date(value, key, _number(value, 1, 4), _number(value, 6, 2), _number(value, 9, 2),
                 lambda y, m, d: F.concat_ws("-", y.cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")))


def _ipv4(value: Column, key: str) -> Column:
    o = [F.split(value, "[.]")[i].cast("int") for i in range(4)]
    valid = F.greatest(*o) <= 255

    def finish(x: Column, y: Column) -> Column:
        return F.concat_ws(".", *(F.floor(v / 256).cast("string") if high else (v % 256).cast("string") for v in (x, y) for high in (True, False)))

    return F.when(valid, permute_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ipv4", finish)).otherwise(value)


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = _number(value, 1, 3), _number(value, 5, 2), _number(value, 8, 4)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)

    def finish(x: Column, y: Column) -> Column:
        new = F.when(x < 665, x + 1).otherwise(x + 2)
        return F.concat_ws("-", F.lpad(new.cast("string"), 3, "0"), F.lpad((F.floor(y / 9999) + 1).cast("string"), 2, "0"),
                           F.lpad((y % 9999 + 1).cast("string"), 4, "0"))

    return F.when(valid, permute_pair(F.when(area < 666, area - 1).otherwise(area - 2), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn", finish)).otherwise(value)


def _phone(value: Column, key: str) -> Column:
    """Ten digits after +1 or alone, of the form NXX NXX XXXX, stay of that form; other
    international numbers keep two digits and permute the rest."""
    digits = _digits(value)
    n = F.length(digits)
    local = F.substring(digits, -10, 10)
    american = (value.rlike(r"^\+1") | (n == 10) & ~value.startswith("+")) & local.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$")
    prefix = F.substring(digits, F.lit(1), n - 10)

    def finish(x: Column, y: Column) -> Column:
        return F.concat((x + 200).cast("string"), (y + 2_000_000).cast("string"))

    renewed = permute_pair(_number(local, 1, 3) - 200, _number(local, 4, 7) - 2_000_000, 800, 8_000_000, key, "phone", finish)
    other = F.concat(F.substring(digits, 1, 2), permute_signs(F.substring(digits, F.lit(3), n - 2), key, "phone"))
    return F.when(american, _refill(value, F.concat(prefix, renewed))).when(n.between(7, 15), _refill(value, other)).otherwise(value)


def _email(value: Column, key: str) -> Column:
    name, domain = F.substring_index(value, "@", 1), F.lower(F.substring_index(value, "@", -1))
    top = F.substring_index(domain, ".", -1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(top))
    return F.concat(permute_signs(name, key, F.concat(F.lit("email "), domain)), F.lit("@"), permute_signs(host, key, "domain"), top)


def _secret(value: Column, key: str) -> Column:
    """Only values that hold a digit count as secrets, not words of a sentence."""
    body = F.regexp_extract(value, r"""^[^=:]*[=:]\s{0,3}"?(.*)$""", 1)
    lead = F.substring(value, F.lit(1), F.length(value) - F.length(body))
    return F.when(body.rlike("[0-9]"), F.concat(lead, permute_signs(body, key, "secret", body.rlike("^[0-9a-f]+$")))).otherwise(value)


def pseudonym(value: Column, key: str = KEY) -> Column:
    """The pseudonym of one value found by the patterns, or the value itself if it is not valid."""
    def like(pattern: str) -> Column:
        return value.rlike(f"^(?:{pattern})$")

    slash_day_first = F.split(value, "/")[0].cast("int") > 12
    return (F.when(like(SECRET), _secret(value, key)).when(F.contains(value, F.lit("@")), _email(value, key))
            .when(like(ACCESS_KEY), F.concat(F.lit("AKIA"), permute_signs(F.substring(value, 5, 16), key, "access key")))
            .when(like(DATE_ISO), _iso_date(value, key)).when(like(DATE_SLASH), _parts_date(value, key, "/", slash_day_first))
            .when(like(IPV4), _ipv4(value, key)).when(like(DATE_DOT), _parts_date(value, key, ".", F.lit(True)))
            .when(like(SSN), _ssn(value, key)).when(like(PHONE), _phone(value, key)).when(like(CARD), _card(value, key))
            .when(like(IBAN), _iban(value, key)).otherwise(value))


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = KEY, count_col: str = "n_pii") -> DataFrame:
    """``docs`` with the text's valid values replaced, and ``count_col``, how many were.

    All other columns stay (one named like ``count_col`` is replaced). A null text stays
    null with count 0; an empty text stays empty. Repeated rows get equal results, as a
    pseudonym depends on key and value only. Values that fail their check stay as they are.
    Dates of 1900 to 2099 count as valid; in a date with slashes the month comes first
    unless the first number is over 12, in one with dots the day comes first.
    """
    found, new = unused(docs.columns, "_found", "_new")
    text = F.col(text_col).cast("string")
    none = F.array().cast("array<string>")
    values = docs.withColumn(found, F.coalesce(F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(FOUND), 0)), none))
    renewed = values.withColumn(new, F.transform(found, lambda v: pseudonym(v, key)))
    gaps = F.split(text, FOUND, -1)
    whole = F.array_join(F.zip_with(gaps, F.col(new), lambda gap, value: F.concat(gap, F.coalesce(value, F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x)).cast("long")
    return renewed.withColumns({count_col: changed, text_col: F.when(F.size(found) > 0, whole).otherwise(text)}).drop(found, new)
