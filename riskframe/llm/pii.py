"""Format-preserving Feistel pseudonyms for personal data, in column expressions only.

Found and validated values are replaced by keyed permutations within their format, so equal
values stay equal across documents and sources, and the key holder can undo it:

- card numbers of 13 to 19 digits that pass the Luhn check: all digits but the last are permuted,
  the last is the new check digit; separators stay;
- phone numbers with a country code and 7 to 14 more digits: those digits are permuted;
- IPv4 addresses (parts up to 255): the 32-bit number is permuted;
- dates from 1900-01-01 on, 72,900 days, as 2024-12-31, 31.12.2024 or 12/31/2024 (month first):
  the day number is permuted;
- e-mail addresses: letters and digits before the @ are permuted within their alphabets, those of
  other scripts within their run of code points;
- secrets of 16 to 128 hex digits after token/secret/password/key and = or : likewise.

Strings go through a Feistel network over characters: each half is shifted, character by
character within its alphabet, by amounts taken from SHA-512 of key, round and other half.
Numbers go through one over two residues with modular sums, so every image is again a valid value
and no walking is needed. ``invert`` runs the rounds backwards.

Defined results: null text stays null; text without a digit, an @ or 16 hex letters in
a row is unchanged; values that fail validation are left alone; a value counts as often as it
occurs. Only the text column changes.
"""

from __future__ import annotations

import itertools
import json
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# Formats of the values looked for.
EMAIL = r"(?<![\p{L}\p{N}])[\p{L}\p{N}][\p{L}\p{N}._+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}+"
DATE = (
    r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
    r"(?![0-9A-Za-z/-]|\.[0-9])"
)
IP = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
# A group of a phone number must not be the first part of an address that follows it.
PHONE = (
    r"(?<![0-9A-Za-z])\+(?:1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
    r"|[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}+(?!\.[0-9]{1,3}\.[0-9])){2,4})(?![0-9A-Za-z])"
)
CARD_FORMS = "[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
CARD = rf"(?<![0-9A-Za-z+])(?:{CARD_FORMS})(?![0-9A-Za-z])"
SECRET = r"(?i:(?<=(?:token|secret|password|key)[ ]{0,2}[=:][ ]{0,2}[\"']?))[0-9a-fA-F]{16,128}(?![0-9A-Za-z])"
PATTERN = "|".join([EMAIL, DATE, IP, PHONE, CARD, SECRET])
KINDS = ("email", "phone", "card", "ip", "date", "secret")

# Alphabets; other characters stay in place.
DIGITS = "0123456789"
ALPHABETS = (
    DIGITS,
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
)
HEX = ("0123456789abcdef",)
# With an upper-case digit, digits and the letters of each case stay what they are, so the key
# holder sees which alphabets were used.
HEX_UPPER = (DIGITS, "abcdef", "ABCDEF")
DATE_FORMS = (("yyyy-MM-dd", r"^[0-9]{4}-"), ("dd.MM.yyyy", r"^[0-9]{2}\."), ("MM/dd/yyyy", r"^[0-9]{2}/"))
DATE_SIDE = 270  # 270 * 270 days from 1900-01-01


def _digest(key: str, tweak: str, turn: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"), other.cast("string")), 512)


def _amount(digest: Column, at: Column) -> Column:
    """The ``at``-th (from 0) number of 16 bits in a digest, repeating after 32."""
    return F.conv(F.substring(digest, at % 32 * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _other_runs() -> list[tuple[int, int]]:
    """Runs (first, last) of code points with letters and numbers outside ALPHABETS.

    Letters that Unicode 3.2 knows form runs of their own: every engine in use knows their images.
    """

    def group(code: int) -> int:
        c = chr(code)
        if c in known or unicodedata.category(c)[0] not in "LN":
            return 0
        return 1 if unicodedata.ucd_3_2_0.category(c)[0] in "LN" else 2

    known, runs = set("".join(ALPHABETS)), []
    for kind, codes in itertools.groupby(range(128, 0x32000), group):
        if kind:
            codes = list(codes)
            runs.append((codes[0], codes[-1]))
    return runs


def _split_runs() -> tuple[str, str]:
    """Runs of several code points as JSON, and the code points that stand alone as an alphabet."""
    runs = _other_runs()
    several = [{"lo": lo, "n": hi - lo + 1} for lo, hi in runs if hi > lo]
    return json.dumps(several), "".join(chr(lo) for lo, hi in runs if hi == lo)


OTHER_RUNS, OTHER_SINGLE = _split_runs()


def _shift_other(c: Column, amount: Column) -> Column:
    """A letter outside ALPHABETS, moved within its run of letters."""
    code = F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("int")
    runs = F.from_json(F.lit(OTHER_RUNS), "array<struct<lo:int,n:int>>")
    run = F.filter(runs, lambda r: code.between(r["lo"], r["lo"] + r["n"] - 1))
    new = F.transform(run, lambda r: r["lo"] + F.pmod(code - r["lo"] + amount, r["n"]))
    moved = F.transform(new, lambda v: F.decode(F.unhex(F.lpad(F.hex(v), 8, "0")), "UTF-32"))
    return F.when(F.size(moved) > 0, F.element_at(moved, 1)).otherwise(c)


def _shift(half: Column, digest: Column, alphabets: tuple[str, ...], sign: int, other_letters: bool = False) -> Column:
    if other_letters:
        alphabets = (OTHER_SINGLE, *alphabets)

    def move(c: Column, i: Column) -> Column:
        out = _shift_other(c, sign * _amount(digest, i)) if other_letters else c
        for alphabet in alphabets:
            n, at = len(alphabet), F.instr(F.lit(alphabet), c)
            new = F.pmod(at - 1 + sign * _amount(digest, i), F.lit(n)) + 1
            out = F.when(at > 0, F.substring(F.lit(alphabet), new, F.lit(1))).otherwise(out)
        return F.when(c == "", c).otherwise(out)

    return F.array_join(F.transform(F.split(half, ""), move), "")


def _rounds(invert: bool) -> Column:
    first, last = (ROUNDS, 1) if invert else (1, ROUNDS)
    return F.sequence(F.lit(first), F.lit(last))


def permute_text(
    value: Column,
    key: str,
    tweak: str,
    alphabets: tuple[str, ...] = ALPHABETS,
    invert: bool = False,
    other_letters: bool = False,
) -> Column:
    """Permute the characters of a string within their alphabets; needs two or more characters.

    With ``other_letters``, letters and numbers outside ALPHABETS move too.
    """
    half = F.floor(F.char_length(value) / 2).cast("int")
    sign = -1 if invert else 1

    def step(s: Column, turn: Column) -> Column:
        left = _shift(s["l"], _digest(key, tweak, turn, s["r"]), alphabets, sign, other_letters)
        right = _shift(s["r"], _digest(key, tweak, turn, s["l"]), alphabets, sign, other_letters)
        return F.when(turn % 2 == 1, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), right.alias("r"))
        )

    start = F.struct(F.substring(value, F.lit(1), half).alias("l"), F.substring(value, half + 1, F.lit(1 << 20)).alias("r"))
    return F.aggregate(_rounds(invert), start, step, lambda s: F.concat(s["l"], s["r"]))


def permute_number(value: Column, side: int, key: str, tweak: str, invert: bool = False) -> Column:
    """Permute the numbers 0 to side * side - 1 (``side`` up to 65,536)."""
    sign = -1 if invert else 1

    def step(s: Column, turn: Column) -> Column:
        left = F.pmod(s["l"] + sign * _amount(_digest(key, tweak, turn, s["r"]), F.lit(0)), F.lit(side))
        right = F.pmod(s["r"] + sign * _amount(_digest(key, tweak, turn, s["l"]), F.lit(0)), F.lit(side))
        odd = turn % 2 == 1
        return F.struct(F.when(odd, left).otherwise(s["l"]).alias("l"), F.when(odd, s["r"]).otherwise(right).alias("r"))

    value = value.cast("bigint")
    start = F.struct(F.floor(value / side).cast("bigint").alias("l"), (value % side).alias("r"))
    return F.aggregate(_rounds(invert), start, step, lambda s: s["l"] * side + s["r"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced, in order, by those of ``digits``."""

    def put(c: Column, i: Column) -> Column:
        rank = F.char_length(_digits(F.substring(template, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, rank, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(template, ""), put), "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum from the right; every second digit, starting at place ``doubled``, counts doubled."""

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return F.coalesce(F.when(i % 2 == doubled, twice).otherwise(d), F.lit(0))

    weighed = F.transform(F.split(F.reverse(digits), ""), weigh)
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b)


def luhn_valid(value: Column) -> Column:
    return _luhn_sum(_digits(value), 1) % 10 == 0


def _card(value: Column, key: str, invert: bool) -> Column:
    digits = _digits(value)
    body = permute_text(F.substring(digits, F.lit(1), F.char_length(digits) - 1), key, "card", (DIGITS,), invert)
    check = (10 - _luhn_sum(body, 0) % 10) % 10
    return _refill(value, F.concat(body, check.cast("string")))


def _phone(value: Column, key: str, invert: bool) -> Column:
    code = F.regexp_extract(value, r"^\+[0-9]{1,3}", 0)
    rest = F.substring(value, F.char_length(code) + 1, F.char_length(value))
    return F.concat(code, _refill(rest, permute_text(_digits(rest), key, "phone", (DIGITS,), invert)))


def _phone_valid(value: Column) -> Column:
    return F.char_length(_digits(value)).between(8, 15)


def _ip_parts(value: Column) -> Column:
    return F.transform(F.split(value, r"\."), lambda c: c.cast("bigint"))


def _ip_valid(value: Column) -> Column:
    return F.forall(_ip_parts(value), lambda p: p <= 255)


def _ip(value: Column, key: str, invert: bool) -> Column:
    number = F.aggregate(_ip_parts(value), F.lit(0).cast("bigint"), lambda a, p: a * 256 + p)
    new = permute_number(number, 1 << 16, key, "ip", invert)
    digits = F.lpad(F.hex(new), 8, "0")
    pairs = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.substring(digits, i * 2 + 1, F.lit(2)))
    return F.array_join(F.transform(pairs, lambda p: F.conv(p, 16, 10)), ".")


def _day(value: Column) -> Column:
    """Days since 1900-01-01, or null where the value is no date of the range."""
    day = F.lit(None).cast("int")
    for form, test in DATE_FORMS:
        parsed = F.to_date(F.try_to_timestamp(value, F.lit(form)))
        day = F.when(value.rlike(test), F.date_diff(parsed, F.lit("1900-01-01").cast("date"))).otherwise(day)
    return F.when(day.between(0, DATE_SIDE * DATE_SIDE - 1), day)


def _date(value: Column, key: str, invert: bool) -> Column:
    moved = permute_number(_day(value), DATE_SIDE, key, "date", invert).cast("int")
    new = F.date_add(F.lit("1900-01-01").cast("date"), moved)
    out = F.lit(None).cast("string")
    for form, test in DATE_FORMS:
        out = F.when(value.rlike(test), F.date_format(new, form)).otherwise(out)
    return out


def _email(value: Column, key: str, invert: bool) -> Column:
    local = F.regexp_extract(value, "^[^@]+", 0)
    domain = F.substring(value, F.char_length(local) + 1, F.char_length(value))
    other = permute_text(local, key, "email", ALPHABETS, invert, other_letters=True)
    latin = permute_text(local, key, "email", ALPHABETS, invert)
    return F.concat(F.when(local.rlike(f"[^._+{''.join(ALPHABETS)}-]"), other).otherwise(latin), domain)


def _secret(value: Column, key: str, invert: bool) -> Column:
    return F.when(value.rlike("[A-F]"), permute_text(value, key, "secret", HEX_UPPER, invert)).otherwise(
        permute_text(value, key, "secret", HEX, invert)
    )


def kind_of(value: Column) -> Column:
    """The kind of a found value, or null where validation fails."""
    return (
        F.when(value.contains("@"), F.lit("email"))
        .when(value.rlike(r"^\+"), F.when(_phone_valid(value), F.lit("phone")))
        .when(value.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), F.when(_ip_valid(value), F.lit("ip")))
        .when(value.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([./])[0-9]{2}\2[0-9]{4})$"), F.when(_day(value).isNotNull(), F.lit("date")))
        .when(value.rlike(f"^(?:{CARD_FORMS})$") & luhn_valid(value), F.lit("card"))
        .when(value.rlike(r"^[0-9A-Fa-f]{16,128}$") & ~value.rlike(r"^[0-9]{13,19}$"), F.lit("secret"))
    )


def pseudonym(value: Column, kind: Column, key: str, invert: bool = False) -> Column:
    return (
        F.when(kind == "email", _email(value, key, invert))
        .when(kind == "phone", _phone(value, key, invert))
        .when(kind == "card", _card(value, key, invert))
        .when(kind == "ip", _ip(value, key, invert))
        .when(kind == "date", _date(value, key, invert))
        .when(kind == "secret", _secret(value, key, invert))
        .otherwise(value)
    )


def found_values(text: Column) -> Column:
    """All candidates of a text in order, as (value, kind); kind is null where validation fails."""
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    values = F.transform(found, lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")))
    return F.when(text.rlike("[0-9@]|[a-fA-F]{16}"), values).otherwise(F.array().cast("array<struct<value:string,kind:string>>"))


def _filled(text: Column, found: Column, key: str, invert: bool) -> Column:
    pieces = F.split(text, PATTERN, -1)
    new = F.transform(found, lambda f: pseudonym(f["value"], f["kind"], key, invert))
    whole = F.zip_with(pieces, new, lambda p, v: F.concat(p, F.coalesce(v, F.lit(""))))
    return F.when(F.size(found) > 0, F.array_join(whole, "")).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", invert: bool = False) -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced; all other columns unchanged."""
    found = docs.withColumn("__found", found_values(F.col(text_col)))
    return found.withColumn(text_col, _filled(F.col(text_col), F.col("__found"), key, invert)).drop("__found")


def pseudonymise_counted(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """As ``pseudonymise``, with ``n_<kind>`` per kind."""
    found = docs.withColumn("__found", found_values(F.col(text_col)))

    def count(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("__found", lambda f: f["kind"] == kind)), F.lit(0))

    return (
        found.withColumns({f"n_{k}": count(k) for k in KINDS})
        .withColumn(text_col, _filled(F.col(text_col), F.col("__found"), key, False))
        .drop("__found")
    )
