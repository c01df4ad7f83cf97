import datetime
import hashlib
import re
import time

import pytest

from millrace.llm.pseudonyms import pseudonymize
from tests.llm.conftest import ODD

CASES = [
    "jo.81@mail7.example.com",
    "JO.81@MAIL7.EXAMPLE.COM!!",
    "+1 (017) 555-7713",
    "4845168114407329",
    "4845-1681-1440-7329",
    "4845168114407328",
    "233.254.104.120",
    "256.1.1.1",
    "1980-02-29",
    "02/29/1980",
    "25/12/1990",
    "1981-02-30",
    "078-05-1120",
    "666-05-1120",
    "GB82 WEST 1234 5698 7654 32",
    "GB82WEST12345698765432",
    "GB82WEST12345698765433",
    "5c572391524f37a8",
    "10.2.3.4.5",
    "no data",
]


@pytest.fixture(scope="module")
def new(spark):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(CASES)], "doc_id long, text string")
    found = pseudonymize(rows, "secret").orderBy("doc_id").collect()
    return {c: r["text"] for c, r in zip(CASES, found)}


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def iban(number):
    plain = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def test_valid_values_change_and_keep_their_layout(new):
    shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
    for case in CASES[:4] + CASES[8:11] + ["078-05-1120", CASES[14], CASES[15]]:
        assert new[case] != case and shape(new[case]) == shape(case), case


def test_other_values_stay(new):
    for case in (CASES[5], CASES[7], CASES[11], CASES[13], *CASES[16:]):
        assert new[case] == case


def test_pseudonyms_are_valid(new):
    assert luhn(new["4845168114407329"]) and iban(new["GB82WEST12345698765432"])
    assert all(0 <= int(p) <= 255 for p in new["233.254.104.120"].split("."))


def test_equal_values_stay_linked_in_any_writing(new):
    assert new["4845-1681-1440-7329"].replace("-", "") == new["4845168114407329"]
    assert new["GB82 WEST 1234 5698 7654 32"].replace(" ", "") == new["GB82WEST12345698765432"]
    assert new["JO.81@MAIL7.EXAMPLE.COM!!"] == new["jo.81@mail7.example.com"].upper() + "!!"
    year, month, day = new["1980-02-29"].split("-")
    assert new["02/29/1980"] == f"{month}/{day}/{year}"


def replaced(spark, cases):
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    return [r["text"] for r in pseudonymize(rows, "secret").orderBy("doc_id").collect()]


@pytest.mark.parametrize(
    "code, writings",
    [
        ("49", ["+49 30 1234567", "+49301234567", "+49-30-123-4567", "+49 (30) 123 4567"]),
        ("1", ["+1 555 123 4567", "+15551234567", "+1 (555) 123-4567", "+1-555-123-4567"]),
        ("44", ["+44 20 7946 0958", "+442079460958", "+44.20.7946.0958"]),
        ("353", ["+353 21 234 5678", "+353212345678"]),
    ],
)
def test_one_phone_number_has_one_pseudonym_in_any_writing(spark, code, writings):
    out = replaced(spark, writings)
    digits = {re.sub("[^0-9]", "", t) for t in out}
    assert len(digits) == 1 and digits != {re.sub("[^0-9]", "", writings[0])}
    assert digits.pop().startswith(code)
    assert [re.sub("[0-9]", "9", t) for t in out] == [re.sub("[0-9]", "9", t) for t in writings]


def test_values_next_to_numbers_and_capitals(spark):
    """Each row is a value among other text, which stays; the value has the pseudonym it has alone."""
    rows = [
        ("", "BE68 5390 0754 7034", " USA"),
        ("USA ", "BE68 5390 0754 7034", " 2024"),
        ("", "GB82 WEST 1234 5698 7654 32", " AB 12"),
        ("", "+33 6 12 34 56 78", " 2024"),
        ("", "+39 06 12 34 56 78", ""),
        ("", "+44 2079 4609 5812", " 2024"),
        ("", "+1 555 123 4567", " 2020"),
        ("", "+49 30 1234567", " 2020."),
        ("call ", "1-800-555-1234", ""),
        ("", "2024-05-06", "T12:00:00Z"),
        ("1234 ", "4845 1681 1440 7329", ""),
        ("1234 5678 ", "4845 1681 1440 7329", " 12."),
        ("DE12 ", "4845 1681 1440 7329", " 12"),
        ("AB12 ", "BE68 5390 0754 7034", " USA"),
        ("4845168114407328 ", "078-05-1120", " X"),
        ("1234567890123 ", "1980-02-29", "T12:00:00"),
    ]
    alone = replaced(spark, [value for _, value, _ in rows])
    together = replaced(spark, ["".join(row) for row in rows])
    for (before, value, after), new, text in zip(rows, alone, together):
        assert new != value and text == before + new + after, (value, text)


def test_every_value_of_a_chain_is_counted(spark):
    row = "4845168114407329 078-05-1120 1234 4845 1681 1440 7329 JO.81@MAIL7.EXAMPLE.COM"
    out = pseudonymize(spark.createDataFrame([(1, row)], "doc_id long, text string"), "secret").first()
    parts = replaced(spark, ["4845168114407329", "078-05-1120", "4845 1681 1440 7329", "JO.81@MAIL7.EXAMPLE.COM"])
    assert out["text"] == f"{parts[0]} {parts[1]} 1234 {parts[2]} {parts[3]}" and out["n_replaced"] == 4


def test_numbers_that_follow_each_other_are_values_of_their_own(spark, new):
    row = "+1 (017) 555-7713 1234, 4845168114407329 4845168114407329"
    out = pseudonymize(spark.createDataFrame([(1, row)], "doc_id long, text string"), "secret").first()
    card = new["4845168114407329"]
    assert out["text"] == f"{new['+1 (017) 555-7713']} 1234, {card} {card}" and out["n_replaced"] == 3


def test_no_two_values_share_a_pseudonym(spark):
    """A permutation: all days of 400 years, and all phone numbers of a block, stay apart."""
    days = spark.range(146_097).selectExpr("id AS doc_id", "CAST(date_add(DATE'1800-01-01', CAST(id AS INT)) AS STRING) AS text")
    out = pseudonymize(days, "secret")
    assert out.select("text").distinct().count() == 146_097
    assert out.where("n_replaced = 0").count() < 20
    phones = spark.range(10_000).selectExpr("id AS doc_id", "concat('+1 (017) 555-', lpad(id, 4, '0')) AS text")
    assert pseudonymize(phones, "secret").select("text").distinct().count() == 10_000


def test_mail_addresses_of_many_digits_stay_apart(spark):
    """Also where they differ only after the 36th digit, whose followers are permuted too."""
    out = replaced(spark, [f"a{'7' * 40}{k:02}@example.com" for k in range(100)])
    assert len(set(out)) == 100 and all(re.fullmatch(r"[a-z][0-9]{42}@example\.com", t) for t in out)


def test_long_runs_take_time_in_proportion(spark):
    """Far below what a search from each place to the end of the run would take."""
    runs = ["7 " + unit * (400_000 // len(unit)) for unit in (".", "-", "a.", "x@a.", "A-", "1-", "+1 ", "a@")]
    begun = time.monotonic()
    assert replaced(spark, runs) == runs
    assert time.monotonic() - begun < 90


def test_addresses_after_lines_of_dots(spark, new):
    """Also after lines that are longer than an address can be, of which dots stay."""
    alone = new["jo.81@mail7.example.com"]
    out = replaced(spark, [f"see {'.' * n}jo.81@mail7.example.com" for n in (1, 30, 90, 5000)])
    assert [t.split("@")[0].strip("se .") for t in out] == [alone.split("@")[0]] * 4
    assert [t.count(".") for t in out] == [n + 3 for n in (1, 30, 90, 5000)]


# --- the permutation in plain Python --------------------------------------------------------


def drawn(*parts):
    return int(hashlib.sha256("|".join(map(str, ("secret", *parts))).encode()).hexdigest()[:15], 16)


def feistel(a, b, a_size, b_size, tweak):
    for i in range(10):
        if i % 2 == 0:
            a = (a + drawn(tweak, i, b)) % a_size
        else:
            b = (b + drawn(tweak, i, a)) % b_size
    return a, b


def digits_by_hand(digits, tweak):
    n = len(digits)
    left = n // 2
    sizes = 10**left, 10 ** (n - left)
    a, b = feistel(int(digits[:left] or 0), int(digits[left:]), *sizes, f"{tweak}/{n}")
    return (f"{a:0{left}}" if left else "") + f"{b:0{n - left}}"


def refilled(value, digits):
    rest = iter(digits)
    return re.sub("[0-9]", lambda _: next(rest), value)


def by_hand(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "card":
        body = digits_by_hand(digits[:-1], "card")
        return refilled(value, body + next(c for c in "0123456789" if luhn(body + c)))
    if kind == "phone":
        return refilled(value, "1" + digits_by_hand(digits[1:], "phone1"))
    if kind == "ip":
        p = [int(x) for x in value.split(".")]
        a, b = feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], 65536, 65536, "ip")
        return ".".join(map(str, (*divmod(a, 256), *divmod(b, 256))))
    if kind == "ssn":
        area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
        a, b = feistel(area - (2 if area > 666 else 1), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "ssn")
        return f"{a + (2 if a + 1 >= 666 else 1):03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}"
    first = datetime.date(1800, 1, 1)
    a, b = feistel(*divmod((datetime.date.fromisoformat(value) - first).days, 773), 189, 773, "date")
    return (first + datetime.timedelta(a * 773 + b)).isoformat()


def test_values_are_permuted_as_by_hand(spark):
    values = [("card", f"48451681144073{k:02}") for k in range(100)]
    values = [(k, v) for k, v in values if luhn(v)] + [("card", "4845-1681-1440-7329")]
    values += [("phone", f"+1 (017) 555-77{k:02}") for k in range(30)]
    values += [("ip", f"{k}.254.{255 - k}.120") for k in range(1, 40)]
    values += [("ssn", f"{k:03}-05-11{k % 90 + 10}") for k in (1, 78, 665, 667, 899)]
    values += [("date", d) for d in ("1800-01-01", "1980-02-29", "2199-12-31", "2024-05-06")]
    out = replaced(spark, [f"told ({value}), and" for _, value in values])
    for (kind, value), text in zip(values, out):
        assert text == f"told ({by_hand(kind, value)}), and", (kind, value)


def test_another_key_gives_other_pseudonyms(spark, new):
    row = spark.createDataFrame([(1, CASES[3])], "doc_id long, text string")
    assert pseudonymize(row, "other").first()["text"] != new[CASES[3]]


def test_odd_rows(odd, none):
    out = pseudonymize(odd, "secret").collect()
    assert sorted(map(repr, (r["text"] for r in out))) == sorted(map(repr, (r[1] for r in ODD)))
    assert {r["n_replaced"] for r in out} == {0} and out[0]["id"] == "x"
    assert pseudonymize(none, "secret").count() == 0
    with pytest.raises(ValueError):
        pseudonymize(odd.withColumnRenamed("key", "N_REPLACED"), "secret")


def test_runs_without_python(odd):
    from tests.conftest import plan_text

    assert not re.search("PythonUDF|MapIn|Pandas|ArrowEval|Exchange", plan_text(pseudonymize(odd, "secret")))
