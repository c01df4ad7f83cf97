"""Format-preserving pseudonyms for personal data, by a keyed Feistel permutation in Spark SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 10

# Lengths of IBANs by country, from the IBAN registry.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ DJ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI FR GR IT MC SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
# Digits of telephone numbers after the country code, fewest and most, where they are known; else
# numbers have 8 to 15 digits in all.
PHONE_LENGTHS = {
    (8, 8): "45 47 53 65",
    (8, 9): "31 32 36 41 66",
    (9, 9): "33 34 40 48 51 56 61 93 94",
    (6, 10): "20 27 30 44 46 52 54 55 57 58 60 63 64 81 82 84 90 91 92 95 98",
    (6, 11): "39 49 86",
    (6, 12): "43 62",
    (10, 10): "1 7",
}


def _iban_form() -> str:
    """IBANs as long as their country has them; of 15 to 34 characters where it is unknown."""
    forms = []
    for length, countries in IBAN_LENGTHS.items():
        whole, part = divmod(length - 4, 4)
        tail = f" [A-Z0-9]{{{part}}}" if part else ""
        start = f"(?:{countries.replace(' ', '|')})[0-9]{{2}}"
        forms.append(f"{start}(?:[A-Z0-9]{{{length - 4}}}|(?: [A-Z0-9]{{4}}){{{whole}}}{tail})")
    known = " ".join(IBAN_LENGTHS.values()).replace(" ", "|")
    other = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?)"
    return "|".join([*forms, other])


def _phone_form() -> str:
    """Numbers with a plus end where those of their country do, others after 8 to 15 digits."""
    digit = r"[ .-]?\(?[0-9](?:\)(?=[ .-]?[0-9]))?"
    trunk = r"(?:[ .-]?\(0\))?"
    forms = [
        rf"\+(?:{codes.replace(' ', '|')}){trunk}(?:{digit}){{{least},{most}}}(?![A-Za-z0-9])(?![.-][0-9])"
        for (least, most), codes in PHONE_LENGTHS.items()
    ]
    plain = (
        r"1-[0-9]{3}-[0-9]{3}-[0-9]{4}",
        r"1[ -]?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}",
        r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}",
        r"[0-9]{3}-[0-9]{3}-[0-9]{4}",
    )
    return "|".join([*forms, rf"\+[0-9]{trunk}(?:{digit}){{7,14}}", *plain])


# Characters of a mail address before the at sign, at most: so a line of dots, where an address may
# start at each, takes time in proportion to its length. Of a longer run the end is the address.
LOCAL_PART = 64
LOCAL = rf"[A-Za-z0-9._%+-]{{1,{LOCAL_PART}}}+@"
# The formats that are recognised, in the order in which they are tried.
FORMATS = {
    "email": LOCAL + r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,126}\.[A-Za-z]{2,24}",
    "iban": _iban_form(),
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}",
    "phone": _phone_form(),
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "card": r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19}",
}
# A value stands alone: no letter or digit touches it, but for the time after a date; a number is no
# part of a longer one with dots or dashes.
END = r"(?:(?![A-Za-z0-9])(?![.-][0-9])|(?<=[0-9]{4}-[0-9]{2}-[0-9]{2})(?=T[0-9]{2}))"
# Whether an IBAN or a card is valid only its check tells. What follows is taken along, so that
# where the check fails values are sought from each later part on.
CHAIN = (
    rf"(?:{FORMATS['iban']}|{FORMATS['card']}){END}"
    rf"(?:[ -](?!{LOCAL})[A-Z0-9]++(?![a-z]|[.,/][0-9]))*+"
)
NUMBERS = "|".join(f"(?:{FORMATS[kind]}){END}" for kind in ("ip", "date", "phone", "ssn"))
ANY = (
    rf"(?<![A-Za-z0-9])(?:{FORMATS['email']}(?![A-Za-z0-9])|(?<![0-9][.-])(?:{CHAIN}|{NUMBERS}))"
)
# A chain is searched part by part; no value has more parts than this.
CHAIN_PARTS = 12
# Country codes of one and two digits as assigned by the ITU; all others have three.
COUNTRY_CODE = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "dd.MM.yyyy")
# The Gregorian calendar repeats after 400 years of 146,097 = 189 * 773 days.
FIRST_DAY, DAYS, DAY_PARTS = "1800-01-01", 146_097, (189, 773)
# Numbers 001-01-0001 to 899-99-9999 without the area 666, as area times the rest.
AREAS, REST = 898, 99 * 9999


def _prf(key: Column, *parts: Column) -> Column:
    """60 bits that depend on the key and all parts."""
    text = F.concat_ws("|", key, *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def permute(a: Column, b: Column, a_size: Column, b_size: Column, key: Column, tweak: Column) -> Column:
    """Struct ``a, b``: a keyed permutation of the pairs with 0 <= a < a_size, 0 <= b < b_size.

    Each round adds to one part a keyed function of the other, modulo the size of the first, which
    can be undone; so no two values share a pseudonym.
    """

    def turn(state: Column, i: Column) -> Column:
        left, right = state["a"], state["b"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, F.pmod(left + F.pmod(_prf(key, tweak, i, right), a_size), a_size))
            .otherwise(left)
            .alias("a"),
            F.when(even, right)
            .otherwise(F.pmod(right + F.pmod(_prf(key, tweak, i, left), b_size), b_size))
            .alias("b"),
        )

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _power(base: int, exponent: Column) -> Column:
    powers = F.array(*[F.lit(base**k).cast("long") for k in range(13 if base == 26 else 19)])
    return F.element_at(powers, exponent.cast("int") + 1)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def permute_digits(digits: Column, key: Column, tweak: Column) -> Column:
    """A string of up to 36 digits, permuted among the strings of its length."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    right = (n - left).cast("int")
    a = F.coalesce(F.substring(digits, F.lit(1), left).try_cast("long"), F.lit(0))
    b = F.coalesce(F.substring(digits, left + 1, right).try_cast("long"), F.lit(0))
    full = F.concat_ws("/", tweak, n.cast("string"))
    mixed = permute(a, b, _power(10, left), _power(10, right), key, full)
    return _let(
        mixed,
        lambda m: F.concat(
            F.when(left == 0, "").otherwise(F.lpad(m["a"].cast("string"), left, F.lit("0"))),
            F.lpad(m["b"].cast("string"), right, F.lit("0")),
        ),
    )


def permute_numbers(digits: Column, key: Column, tweak: Column) -> Column:
    """Digits of any number, permuted in chunks of up to 36 among the strings of their length."""
    chunks = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.floor(F.length(digits) / 36).cast("int")),
            lambda k: F.struct(k.alias("k"), F.substring(digits, k * 36 + 1, F.lit(36)).alias("s")),
        ),
        lambda c: F.length(c["s"]) > 0,
    )

    def one(chunk: Column) -> Column:
        own = F.when(chunk["k"] == 0, tweak).otherwise(F.concat_ws("/", tweak, chunk["k"].cast("string")))
        return permute_digits(chunk["s"], key, own)

    return F.array_join(F.transform(chunks, one), "")


def _letters_value(letters: Column) -> Column:
    """Lower-case letters as a number of base 26."""
    codes = F.transform(_characters(letters), lambda c: F.ascii(c).cast("long") - ord("a"))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda total, c: total * 26 + c)


def _value_letters(value: Column, n: Column) -> Column:
    places = F.when(n > 0, F.sequence(n - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    each = F.transform(
        places, lambda p: F.char(F.lit(ord("a")) + F.pmod(F.floor(value / _power(26, p)), F.lit(26)))
    )
    return F.array_join(each, "")


def _characters(text: Column) -> Column:
    n = F.length(text)
    none = F.array().cast("array<string>")
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, F.lit(1)))).otherwise(none)


def permute_letters(letters: Column, key: Column, tweak: Column) -> Column:
    """Lower-case letters, permuted in chunks of up to 16 among the strings of their length."""
    chunks = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.floor(F.length(letters) / 16).cast("int")),
            lambda k: F.struct(k.alias("k"), F.substring(letters, k * 16 + 1, F.lit(16)).alias("s")),
        ),
        lambda c: F.length(c["s"]) > 0,
    )

    def one(chunk: Column) -> Column:
        n = F.length(chunk["s"])
        left = F.floor(n / 2).cast("int")
        right = (n - left).cast("int")
        full = F.concat_ws("/", tweak, n.cast("string"), chunk["k"].cast("string"))
        mixed = permute(
            _letters_value(F.substring(chunk["s"], F.lit(1), left)),
            _letters_value(F.substring(chunk["s"], left + 1, right)),
            _power(26, left),
            _power(26, right),
            key,
            full,
        )
        return _let(mixed, lambda m: F.concat(_value_letters(m["a"], left), _value_letters(m["b"], right)))

    return F.array_join(F.transform(chunks, one), "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refill(text: Column, kind: str, new: Column) -> Column:
    """``text`` with its characters of one kind replaced by those of ``new``, in order."""
    return F.array_join(
        F.zip_with(
            F.split(text, kind, -1),
            _characters(new),
            lambda gap, c: F.concat(gap, F.coalesce(c, F.lit(""))),
        ),
        "",
    )


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits, the last one counted singly."""
    n = F.length(digits)
    values = F.transform(
        _characters(digits),
        lambda c, i: _let(
            c.cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda total, d: total + d)


def _card(text: Column, key: Column) -> Column:
    digits = _digits(text)
    n = F.length(digits)

    def new(body: Column) -> Column:
        check = F.pmod(10 - _luhn_sum(F.concat(body, F.lit("0"))), F.lit(10))
        return F.concat(body, check.cast("string"))

    body = permute_digits(F.substring(digits, F.lit(1), n - 1), key, F.lit("card"))
    return F.when(_luhn_sum(digits) % 10 == 0, _refill(text, "[0-9]", _let(body, new))).otherwise(text)


def _phone(text: Column, key: Column) -> Column:
    """The country code after a plus stays, so that the number remains one of that country.

    It is read from the digits alone, whatever blanks the number is written with. A zero in brackets
    after it, which is not dialled, stays and is no part of the number.
    """
    digits = _digits(text)
    plus = text.startswith("+")
    code = F.when(plus, F.regexp_extract(digits, f"^(?:{COUNTRY_CODE})", 0)).otherwise(
        F.when(F.length(digits) == 11, "1").otherwise("")
    )
    trunk = F.when(text.rlike(rf"^\+(?:{COUNTRY_CODE})[ .-]?\(0\)"), "0").otherwise("")
    start = F.length(code) + F.length(trunk)
    rest = F.substring(digits, start + 1, F.length(digits))
    valid = (F.length(digits) - F.length(trunk)).between(8, 15) & (F.length(rest) >= 4)
    new = F.concat(code, trunk, permute_digits(rest, key, F.concat(F.lit("phone"), code)))
    return F.when(valid, _refill(text, "[0-9]", new)).otherwise(text)


def _ip(text: Column, key: Column) -> Column:
    parts = F.transform(F.split(text, r"\."), lambda p: p.cast("int"))
    valid = F.forall(parts, lambda p: p <= 255) & ~text.rlike(r"(^|\.)0[0-9]")
    size = F.lit(65536)
    mixed = permute(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], size, size, key, F.lit("ip"))

    def joined(m: Column) -> Column:
        bytes_ = [F.shiftright(m["a"], 8), m["a"] % 256, F.shiftright(m["b"], 8), m["b"] % 256]
        return F.concat_ws(".", *[b.cast("string") for b in bytes_])

    return F.when(valid, _let(mixed, joined)).otherwise(text)


def _ssn(text: Column, key: Column) -> Column:
    digits = _digits(text)
    area, group, serial = [F.substring(digits, a, n).cast("int") for a, n in ((1, 3), (4, 2), (6, 4))]
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    number = F.when(area > 666, area - 2).otherwise(area - 1)
    mixed = permute(number, (group - 1) * 9999 + serial - 1, F.lit(AREAS), F.lit(REST), key, F.lit("ssn"))

    def joined(m: Column) -> Column:
        back = F.when(m["a"] + 1 >= 666, m["a"] + 2).otherwise(m["a"] + 1)
        return F.concat_ws(
            "-",
            F.lpad(back.cast("string"), 3, "0"),
            F.lpad((F.floor(m["b"] / 9999) + 1).cast("string"), 2, "0"),
            F.lpad((m["b"] % 9999 + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, _let(mixed, joined)).otherwise(text)


def _date(text: Column, key: Column) -> Column:
    first = F.lit(FIRST_DAY).cast("date")
    shapes = (r"^[0-9]{4}-", r"/", r"/", r"\.")
    read = [
        F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(f)).cast("date"))
        for shape, f in zip(shapes, DATE_FORMATS)
    ]
    found = F.coalesce(
        *[F.when(d.isNotNull(), F.struct(F.datediff(d, first).alias("day"), F.lit(f).alias("f"))) for d, f in zip(read, DATE_FORMATS)]
    )

    def new(x: Column) -> Column:
        high, low = DAY_PARTS
        mixed = permute(
            F.floor(x["day"] / low), x["day"] % low, F.lit(high), F.lit(low), key, F.lit("date")
        )

        def joined(m: Column) -> Column:
            day = F.date_add(first, (m["a"] * low + m["b"]).cast("int"))
            out = F.lit(None).cast("string")
            for f in dict.fromkeys(DATE_FORMATS):
                out = F.when(x["f"] == f, F.date_format(day, f)).otherwise(out)
            return out

        return F.when(x["day"].between(0, DAYS - 1), _let(mixed, joined))

    return F.coalesce(_let(found, new), text)


def _email(text: Column, key: Column) -> Column:
    """Letters and digits of the local part change within their kind; the domain stays."""
    local = F.substring_index(text, "@", 1)
    domain = F.lower(F.substring_index(text, "@", -1))
    letters = F.lower(F.regexp_replace(local, "[^A-Za-z]", ""))
    digits = _digits(local)
    old = F.regexp_extract_all(local, F.lit("[A-Za-z]"), F.lit(0))

    def with_letters(new: Column) -> Column:
        cased = F.array_join(
            F.zip_with(old, _characters(new), lambda o, c: F.when(o.rlike("[A-Z]"), F.upper(c)).otherwise(c)), ""
        )
        changed = _let(cased, lambda c: _refill(local, "[A-Za-z]", c))
        numbers = F.when(F.length(digits) > 0, permute_numbers(digits, key, F.concat(F.lit("email"), domain, new)))
        return F.when(
            F.length(digits) > 0,
            _let(F.struct(changed.alias("t"), numbers.alias("d")), lambda x: _refill(x["t"], "[0-9]", x["d"])),
        ).otherwise(changed)

    mixed = permute_letters(letters, key, F.concat_ws("/", F.lit("email"), domain, digits))
    return F.concat(_let(mixed, with_letters), F.lit("@"), F.substring_index(text, "@", -1))


def _iban_remainder(text: Column) -> Column:
    """Remainder by 97 of an IBAN with its first four characters moved to the end."""
    moved = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))
    codes = F.transform(_characters(moved), lambda c: F.conv(c, 36, 10).cast("long"))
    return F.aggregate(
        codes, F.lit(0).cast("long"), lambda r, c: (r * F.when(c > 9, 100).otherwise(10) + c) % 97
    )


def _iban(text: Column, key: Column) -> Column:
    """The digits of the account change; country and bank letters stay and the check is renewed."""
    plain = F.regexp_replace(text, " ", "")
    country = F.substring(plain, 1, 2)
    account = F.substring(plain, F.lit(5), F.length(plain))
    digits = _digits(account)

    def checked(new: Column) -> Column:
        body = _let(new, lambda d: _refill(account, "[0-9]", d))

        def whole(b: Column) -> Column:
            check = 98 - _iban_remainder(F.concat(country, F.lit("00"), b))
            return F.concat(F.lpad(check.cast("string"), 2, "0"), _digits(b))

        return _let(body, whole)

    valid = F.length(plain).between(15, 34) & (_iban_remainder(plain) == 1) & (F.length(digits) > 3)
    mixed = permute_digits(digits, key, F.concat(F.lit("iban"), F.regexp_replace(plain, "[0-9]", "")))
    return F.when(valid, _let(_let(mixed, checked), lambda d: _refill(text, "[0-9]", d))).otherwise(text)


CHANGES = {
    "email": _email,
    "iban": _iban,
    "ip": _ip,
    "date": _date,
    "phone": _phone,
    "ssn": _ssn,
    "card": _card,
}


def pseudonym(value: Column, key: Column, kinds: tuple[str, ...] = tuple(FORMATS)) -> Column:
    """The pseudonym of one value of a known format; other and invalid values stay as they are."""
    out = value
    for kind in reversed(kinds):
        out = F.when(value.rlike(f"^(?:{FORMATS[kind]})$"), CHANGES[kind](value, key)).otherwise(out)
    return out


def _found(text: Column, key: Column) -> Column:
    """Struct ``new, n``: a match of ``ANY`` with its values replaced, and their number."""

    def alone(new: Column) -> Column:
        return F.struct(new.alias("new"), (new != text).cast("int").alias("n"))

    chained = text.rlike(f"^(?:{CHAIN})$") & ~text.rlike("^[A-Z0-9]+$")
    return F.when(chained, _chain(text, key)).otherwise(_let(pseudonym(text, key), alone))


def _chain(text: Column, key: Column) -> Column:
    """Struct ``new, n``: parts from left to right, each the start of a value if a valid one is there."""
    parts = F.regexp_extract_all(text, F.lit("[A-Z0-9]+[ -]?"), F.lit(0))
    kinds = tuple(k for k in FORMATS if k not in ("email", "ip"))

    def walk(all_parts: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            part = F.element_at(all_parts, i)
            before = F.when(i > 1, F.element_at(all_parts, F.greatest(i - 1, F.lit(1)))).otherwise("")
            rest = F.array_join(F.slice(all_parts, i, F.lit(CHAIN_PARTS)), "")
            plain = F.struct(F.concat(state["new"], part).alias("new"), state["n"].alias("n"), (i + 1).alias("next"))

            def tried(rest: Column) -> Column:
                none = F.struct(F.lit("").alias("old"), F.lit("").alias("new"))
                values = F.array(*[F.regexp_extract(rest, f"^(?:{FORMATS[k]}){END}", 0) for k in kinds])
                pairs = F.transform(
                    F.filter(values, lambda v: v != ""),
                    lambda v: F.struct(v.alias("old"), pseudonym(v, key, kinds).alias("new")),
                )
                changed = F.filter(pairs, lambda p: p["old"] != p["new"])
                return F.element_at(F.concat(changed, F.array(none)), 1)

            def put(hit: Column) -> Column:
                # What of its last part is no part of the value stays.
                count = F.regexp_count(hit["old"], F.lit("[A-Z0-9]+"))
                covered = F.array_join(F.slice(all_parts, i, F.greatest(count, F.lit(1))), "")
                gap = F.substring(covered, F.length(hit["old"]) + 1, F.length(covered))
                return F.when(hit["old"] == "", plain).otherwise(
                    F.struct(F.concat(state["new"], hit["new"], gap).alias("new"), (state["n"] + 1).alias("n"), (i + count).alias("next"))
                )

            inside = before.rlike("[0-9]-$")
            return F.when(i < state["next"], state).otherwise(
                F.when(inside, plain).otherwise(_let(_let(rest, tried), put))
            )

        start = F.struct(F.lit("").alias("new"), F.lit(0).alias("n"), F.lit(1).alias("next"))
        return F.aggregate(F.sequence(F.lit(1), F.size(all_parts)), start, step)

    return _let(_let(parts, walk), lambda s: F.struct(s["new"].alias("new"), s["n"].alias("n")))


def pseudonymize(
    docs: DataFrame, key: str, *, text_column: str = "text", count_column: str = "n_replaced"
) -> DataFrame:
    """``docs`` with personal data in ``text_column`` replaced, and the number of values replaced.

    Found are mail addresses, account numbers (IBAN, valid check digits), IPv4 addresses, dates of
    the years 1800 to 2199, telephone numbers (8 to 15 digits), social security numbers of valid
    ranges and card numbers (13 to 19 digits, valid Luhn sum). Each is permuted among the values of
    its own format with ``key``: a card number stays a valid card number, a date a date, and layout
    and letter case stay. The same value gets the same pseudonym in every document, written with or
    without blanks, and different values never share one. Numbers that are not valid stay.
    Dates with slashes are read month first, else day first. IBANs and telephone numbers end where
    those of their country do; where a check fails, values are sought again from the next part on.

    All is built from SQL expressions: one scan, no shuffle, no Python. Texts without a digit or an
    at sign are passed by; very long texts are searched whole, in time that grows with their length.
    Defined cases: null stays null with 0 replaced; empty texts stay; an empty table gives no rows;
    repeated rows are treated alike; other columns pass through; an existing ``count_column`` is
    refused.
    """
    if count_column.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column already there: {count_column}")
    text = docs[text_column]
    secret = F.lit(key)
    old = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    new = F.transform(old, lambda v: _found(v, secret))
    found = F.when(text.rlike("[0-9@]"), new)
    name = "_found"
    while name in docs.columns:
        name += "_"
    rows = docs.withColumn(name, found)
    gaps = F.split(text, ANY, -1)
    changed = F.array_join(
        F.zip_with(gaps, F.col(name), lambda gap, v: F.concat(gap, F.coalesce(v["new"], F.lit("")))), ""
    )
    count = F.aggregate(name, F.lit(0), lambda total, v: total + v["n"])
    some = F.col(name).isNotNull() & (F.size(name) > 0)
    return rows.select(
        *[F.when(some, changed).otherwise(text).alias(c) if c == text_column else rows[c] for c in docs.columns],
        F.when(some, count).otherwise(0).cast("long").alias(count_column),
    )
