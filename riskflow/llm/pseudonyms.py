"""Format-preserving pseudonyms for personal data, in DataFrame operations only.

Found and validated: payment card numbers (check digit), IBANs (remainder 97), social security
numbers (valid areas, groups, serials), phone numbers, IPv4 and e-mail addresses, calendar
dates, where no letter or digit adjoins. Each value goes through a keyed Feistel permutation of its own format and takes its
place in the text: separators, length, letter case, country and issuer-independent check digits stay
right, so the result validates again. Equal values of a kind get equal pseudonyms in all
documents, whatever their separators. What does not validate stays as it is.

Null texts stay null, empty ones empty. Only what is found is rewritten; the rest of a text,
however long, is kept to the byte. Whoever knows the key can link values; keep it secret.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# Country codes of one and two digits; all others have three.
_SHORT_CODES = (
    "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63"
    "|64|65|66|81|82|84|86|90|91|92|93|94|95|98"
)
_CODE = rf"(?:{_SHORT_CODES}|[2-9][0-9]{{2}})"
# Digits after the country code, least and most, that are tried first where a country has its own;
# others, and numbers that do not fit, have as many as make 8 to 15 with the code.
_NATIONAL = {
    "31": (9, 9), "32": (8, 9), "33": (9, 9), "34": (9, 9), "36": (8, 9), "41": (9, 9), "43": (7, 13),
    "44": (9, 10), "45": (8, 8), "46": (7, 9), "47": (8, 8), "48": (9, 9), "49": (7, 11), "351": (9, 9),
    "352": (6, 9), "353": (7, 9),
}
_TRUNK = r"(?:[ .\-]?\(0\))?"


def _national(least: int, most: int) -> str:
    """Groups of digits with that many in all: to where no further group follows, or else to the
    end of the last group that fits."""
    digits = rf"(?:[ .\-]?\(?[0-9]\)?){{{least},{most}}}"
    return (
        rf"(?:{digits}(?![0-9A-Za-z]|[ .\-]?\(?[0-9])|{digits}(?![0-9A-Za-z]|[.\-][0-9]))"
    )


_ABROAD = r"\+(?:" + "|".join(
    [rf"{code}{_TRUNK}{_national(*sizes)}" for code, sizes in _NATIONAL.items()]
    + [
        rf"(?!1){code}{_TRUNK}{_national(8 - size, 15 - size)}"
        for code, size in ((rf"(?:{_SHORT_CODES})", 2), (rf"(?!{_SHORT_CODES})[2-9][0-9]{{2}}", 3))
    ]
) + ")"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# In this order: at one place of a text the first that fits is taken. Repeated groups are bounded, as
# the engine recurses for each turn; a domain has 127 labels at most, and what follows stays anyway.
_FORMS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++){1,126}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": (
        r"(?<![0-9/.\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
        r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9]|[/.\-][0-9])"
    ),
    "ip": rf"(?<![0-9A-Za-z])(?<![0-9]\.)(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "card": (
        r"(?<![0-9A-Za-z])(?:[0-9]{13,19}"
        + "".join(
            rf"|[0-9]{{4}}{x}[0-9]{{4}}{x}[0-9]{{4}}{x}[0-9]{{1,7}}|[0-9]{{4}}{x}[0-9]{{6}}{x}[0-9]{{5}}"
            for x in (" ", "-")
        )
        + r")(?![0-9A-Za-z])"
    ),
    # As many digits as the country has, 15 at most, so that a number right behind is not taken
    # for a part.
    "phone": (
        r"\+1[ .\-]?(?:\([0-9]{3}\)|[0-9]{3})[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9A-Za-z])"
        rf"|{_ABROAD}"
        r"|(?<![0-9A-Za-z])(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .\-])[2-9][0-9]{2}[ .\-][0-9]{4}(?![0-9A-Za-z])"
    ),
}
KINDS = tuple(_FORMS)
_BY_LETTERS = ("email", "iban")
_ANY = "|".join(
    [f"(?:{_FORMS[kind]})" for kind in _BY_LETTERS]
    + ["(?=[0-9(+])(?:" + "|".join(f for k, f in _FORMS.items() if k not in _BY_LETTERS) + ")"]
)
# Every form has one of these; most texts have none, which is quick to see.
_HINT = r"@[A-Za-z0-9\-]|[0-9][0-9./ \-]"

# 400 years of the calendar are 146,097 days, 27 times 5,411.
_FIRST_DAY, _DAY_SPLIT = "1700-01-01", (27, 5411)
_SSN_SPLIT = (898, 99 * 9999)
_IP_SPLIT = (1 << 16, 1 << 16)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(text: Column, of: Callable[[Column, Column], Column]) -> Column:
    """The text made of ``of(character, position from 1)``."""
    return F.when(F.length(text) == 0, "").otherwise(
        F.array_join(
            F.transform(
                F.sequence(F.lit(1), F.length(text)),
                lambda i: of(F.substring(text, i, F.lit(1)), i),
            ),
            "",
        )
    )


def _word(digest: Column, i: Column | int) -> Column:
    """The i-th of 32 numbers below 65,536 in a digest of 128 hexadecimal digits."""
    at = F.pmod(F.lit(i) if isinstance(i, int) else i, F.lit(32)) * 4 + 1
    return F.conv(F.substring(digest, at, F.lit(4)), 16, 10).cast("long")


def _digest(key: str, kind: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn, half).cast("binary"), 512)


def _shifted(text: Column, digest: Column, alone: bool = False) -> Column:
    """Digits and letters moved on within their kind by the digest's numbers; never by
    nothing if ``alone``."""

    def moved(char: Column, i: Column) -> Column:
        def within(first: str, size: int) -> Column:
            by = _word(digest, i) % (size - 1) + 1 if alone else _word(digest, i)
            return F.char(F.pmod(F.ascii(char) - ord(first) + by, F.lit(size)) + ord(first))

        return (
            F.when(char.between("0", "9"), within("0", 10))
            .when(char.between("a", "z"), within("a", 26))
            .otherwise(within("A", 26))
        )

    return _chars(text, moved)


def permute_text(text: Column, key: str, kind: str) -> Column:
    """A permutation of the ASCII letters and digits that keeps each one's kind: Feistel
    rounds that move one half on by numbers drawn from the other. One character alone just
    moves on."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(
        F.substring(text, F.lit(1), half).alias("l"),
        F.substring(text, half + 1, F.length(text)).alias("r"),
    )

    def turn(state: Column, i: Column) -> Column:
        def moved(one: str, other: str) -> Column:
            tag = F.concat_ws("/", i.cast("string"), F.length(state[one]))
            return _let(_digest(key, kind, tag, state[other]), lambda d: _shifted(state[one], d))

        return F.struct(
            F.when(i % 2 == 1, moved("l", "r")).otherwise(state["l"]).alias("l"),
            F.when(i % 2 == 0, moved("r", "l")).otherwise(state["r"]).alias("r"),
        )

    mixed = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["l"], s["r"])
    )
    single = _shifted(text, _digest(key, kind, F.lit("0"), F.lit("")), alone=True)
    return F.when(F.length(text) == 1, single).otherwise(mixed)


def permute_number(value: Column, split: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of 0 to ``split[0] * split[1] - 1``."""
    a, b = split
    start = F.struct(
        F.floor(value / b).cast("long").alias("l"), F.pmod(value, F.lit(b)).cast("long").alias("r")
    )

    def drawn(i: Column, half: Column) -> Column:
        return _let(
            _digest(key, kind, i.cast("string"), half.cast("string")),
            lambda d: _word(d, 0) + _word(d, 1) * 65536 + _word(d, 2) * (1 << 32),
        )

    def turn(state: Column, i: Column) -> Column:
        return F.struct(
            F.when(i % 2 == 1, F.pmod(state["l"] + drawn(i, state["r"]), F.lit(a).cast("long")))
            .otherwise(state["l"]).alias("l"),
            F.when(i % 2 == 0, F.pmod(state["r"] + drawn(i, state["l"]), F.lit(b).cast("long")))
            .otherwise(state["r"]).alias("r"),
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: s["l"] * b + s["r"]
    )


def _signs(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9A-Za-z]", "")


def _refilled(form: Column, signs: Column) -> Column:
    """``form`` with its letters and digits replaced, in order, by ``signs``."""
    return _chars(
        form,
        lambda char, i: F.when(char.rlike("[^0-9A-Za-z]"), char).otherwise(
            F.substring(signs, F.length(_signs(F.substring(form, F.lit(1), i))), F.lit(1))
        ),
    )


def _email(value: Column, key: str) -> Column:
    local = F.substring_index(value, "@", 1)
    domain = F.substring_index(value, "@", -1)
    return F.concat(
        _let(local, lambda x: _refilled(x, permute_text(_signs(x), key, "email"))),
        F.lit("@"), domain,
    )


def _card(value: Column, key: str) -> Column:
    def body(digits: Column) -> Column:
        payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
        moved = _let(
            permute_text(payload, key, "card"),
            lambda p: F.concat(
                p,
                F.get(
                    F.filter(
                        F.sequence(F.lit(0), F.lit(9)),
                        lambda c: F.call_function("luhn_check", F.concat(p, c.cast("string"))),
                    ),
                    F.lit(0),
                ).cast("string"),
            ),
        )
        checked = F.when(F.call_function("luhn_check", digits), _let(moved, lambda m: _refilled(value, m)))
        return checked.otherwise(value)

    return _let(F.regexp_replace(value, "[^0-9]", ""), body)


def _remainder_97(signs: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        code = F.ascii(F.substring(signs, i, F.lit(1)))
        return F.when(code <= 57, (acc * 10 + code - 48) % 97).otherwise(
            (acc * 100 + code - 55) % 97
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(signs)), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    def body(signs: Column) -> Column:
        country, account = F.substring(signs, 1, 2), F.substring(signs, F.lit(5), F.length(signs))
        valid = _remainder_97(F.concat(account, F.substring(signs, 1, 4))) == 1
        moved = _let(
            permute_text(account, key, "iban"),
            lambda p: F.concat(
                country,
                F.lpad((98 - _remainder_97(F.concat(p, country, F.lit("00")))).cast("string"), 2, "0"),
                p,
            ),
        )
        return F.when(valid, _let(moved, lambda m: _refilled(value, m))).otherwise(value)

    return _let(_signs(value), body)


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(n)).cast("long") for n in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    number = (area - F.when(area > 666, 2).otherwise(1)) * _SSN_SPLIT[1] + (group - 1) * 9999 + serial - 1

    def written(n: Column) -> Column:
        a = F.floor(n / _SSN_SPLIT[1]) + 1
        rest = F.pmod(n, F.lit(_SSN_SPLIT[1]))
        return F.concat_ws(
            "-",
            F.lpad((a + F.when(a >= 666, 1).otherwise(0)).cast("string"), 3, "0"),
            F.lpad((F.floor(rest / 9999) + 1).cast("string"), 2, "0"),
            F.lpad((rest % 9999 + 1).cast("string"), 4, "0"),
        )

    return F.when(
        valid, _let(permute_number(number, _SSN_SPLIT, key, "ssn"), written)
    ).otherwise(value)


def _phone(value: Column, key: str) -> Column:
    def abroad(form: Column) -> Column:
        digits = F.regexp_replace(form, "[^0-9]", "")
        size = F.length(F.regexp_extract(digits, f"^{_CODE}", 0))
        moved = F.concat(
            F.substring(digits, F.lit(1), size),
            permute_text(F.substring(digits, size + 1, F.length(digits)), key, "phone"),
        )
        return F.when(
            F.length(digits).between(8, 15), _let(moved, lambda m: _refilled(form, m))
        ).otherwise(form)

    def at_home(digits: Column) -> Column:
        # Area and exchange begin with 2 to 9.
        area, exchange = F.substring(digits, 1, 3).cast("long"), F.substring(digits, 4, 3).cast("long")
        split = (800, 800 * 10_000)
        number = (area - 200) * split[1] + (exchange - 200) * 10_000 + F.substring(digits, 7, 4).cast("long")
        written = _let(
            permute_number(number, split, key, "home phone"),
            lambda n: F.concat(
                (F.floor(n / split[1]) + 200).cast("string"),
                (F.floor(F.pmod(n, F.lit(split[1])) / 10_000) + 200).cast("string"),
                F.lpad((n % 10_000).cast("string"), 4, "0"),
            ),
        )
        return _let(written, lambda m: _refilled(value, m))

    # A trunk zero in brackets is no part of the number and stays.
    form = F.replace(value, F.lit("(0)"), F.lit("(\x00)"))
    return F.when(
        value.startswith("+"), F.replace(_let(form, abroad), F.lit("(\x00)"), F.lit("(0)"))
    ).otherwise(_let(F.regexp_replace(value, "[^0-9]", ""), at_home))


def _ip(value: Column, key: str) -> Column:
    parts = [F.split_part(value, F.lit("."), F.lit(n)).cast("long") for n in (1, 2, 3, 4)]
    number = ((parts[0] * 256 + parts[1]) * 256 + parts[2]) * 256 + parts[3]
    return _let(
        permute_number(number, _IP_SPLIT, key, "ip"),
        lambda n: F.concat_ws(
            ".", *((F.floor(n / (1 << s)) % 256).cast("string") for s in (24, 16, 8, 0))
        ),
    )


def _date(value: Column, key: str) -> Column:
    """Year first; with slashes month first if that is a date, else day first; with points
    day first."""
    sign = F.regexp_extract(value, r"([/.\-])", 1)
    parts = [F.split_part(value, sign, F.lit(n)) for n in (1, 2, 3)]

    def day(year: Column, month: Column, day_: Column) -> Column:
        iso = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day_, 2, "0"))
        return F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date")

    us, eu = day(parts[2], parts[0], parts[1]), day(parts[2], parts[1], parts[0])
    forms = [
        (sign == "-", day(*parts), lambda y, m, d: F.concat_ws("-", y, m, d)),
        ((sign == "/") & us.isNotNull(), us, lambda y, m, d: F.concat_ws("/", m, d, y)),
        (sign == "/", eu, lambda y, m, d: F.concat_ws("/", d, m, y)),
        (sign == ".", eu, lambda y, m, d: F.concat_ws(".", d, m, y)),
    ]
    first, days = F.to_date(F.lit(_FIRST_DAY)), _DAY_SPLIT[0] * _DAY_SPLIT[1]

    def moved(date: Column, written: Callable) -> Column:
        number = F.datediff(date, first)
        new = F.date_add(first, permute_number(number, _DAY_SPLIT, key, "date").cast("int"))
        return F.when(
            number.between(0, days - 1),
            _let(new, lambda x: written(
                F.date_format(x, "yyyy"), F.date_format(x, "MM"), F.date_format(x, "dd"))),
        ).otherwise(value)

    result = F.when(F.lit(False), value)
    for applies, date, written in forms:
        result = result.when(applies, F.coalesce(moved(date, written), value))
    return result.otherwise(value)


_REPLACED: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "card": _card,
    "phone": _phone,
}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one value that has any of the forms; itself if it does not validate."""
    result = F.when(F.lit(False), value)
    for kind, form in _FORMS.items():
        result = result.when(value.rlike(rf"\A(?:{form})\z"), _REPLACED[kind](value, key))
    return result.otherwise(value)


def pseudonymize(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with every validated value in ``text`` replaced; ``count``, if given, names a
    column for the number of values replaced."""
    found = F.regexp_extract_all(text, F.lit(_ANY), F.lit(0))
    marked = docs.withColumn("__found", F.when(F.col(text).rlike(_HINT), found)).withColumn(
        "__new", F.transform("__found", lambda v: pseudonym(v, key))
    )
    between = F.split(text, _ANY, -1)
    rebuilt = F.concat(
        F.array_join(F.zip_with(between, "__new", lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")
    )
    columns = {text: F.when(F.coalesce(F.size("__found"), F.lit(0)) < 1, F.col(text)).otherwise(rebuilt)}
    if count:
        changed = F.zip_with("__found", "__new", lambda a, b: (a != b).cast("long"))
        columns[count] = F.coalesce(
            F.aggregate(changed, F.lit(0).cast("long"), lambda acc, x: acc + x), F.lit(0).cast("long")
        )
    return marked.withColumns(columns).drop("__found", "__new")
