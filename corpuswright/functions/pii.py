"""Personal data: national ids, bank accounts, phones, plates, e-mail and IP addresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The placeholders that stand for redacted data.
PLACEHOLDERS = {"tc_kimlik": "<TC_KIMLIK>", "phone": "<TELEFON>", "iban": "<IBAN>", "plate": "<PLAKA>"}
EMAIL, IP = "email@example.com", "22.214.171.124"

_NO_WORD_BEFORE, _NO_WORD_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_NO_DIGIT_BEFORE, _NO_DIGIT_AFTER = "(?<![0-9])", "(?![0-9])"


def _grouped(unit: str, sizes: tuple[int, ...], separator: str) -> str:
    """Groups of so many characters, each with an optional separator before it."""
    return "".join(f"{separator}?{unit}{{{n}}}" for n in sizes)


# Formats of the public standards.
#: National identity numbers have eleven digits.
ID_PATTERN = _NO_DIGIT_BEFORE + "[0-9]{11}" + _NO_DIGIT_AFTER
#: ISO 13616, registry entry for Turkey: country, two check digits, 22 characters; printed in groups of four.
_ACCOUNT_GROUPS = (4, 4, 4, 4, 4, 2)
IBAN_PATTERN = "(?i)" + _NO_DIGIT_BEFORE + "TR[0-9]{2}" + _grouped("[A-Z0-9]", _ACCOUNT_GROUPS, "[ -]") + _NO_WORD_AFTER
#: The national numbering plan: a code of three digits (2 to 4 is geographic, 5 mobile) and seven more, written 3-2-2. A code
#: follows the trunk prefix or the country's, in brackets or not; only mobile numbers are written without either.
_TRUNK = ("0", "[+]90", "0090")
_CODE, _MOBILE, _NUMBER_GROUPS, _PHONE_SEPARATOR = "[2-5][0-9]{2}", "5[0-9]{2}", (3, 2, 2), "[\\s.-]"
PHONE_PATTERN = _NO_WORD_BEFORE + f"(?:(?:{'|'.join(sorted(_TRUNK, key=len, reverse=True))}){_PHONE_SEPARATOR}?[(]?{_CODE}[)]?|{_MOBILE})" + _grouped("[0-9]", _NUMBER_GROUPS, _PHONE_SEPARATOR) + _NO_WORD_AFTER
#: Number plates: a province (01 to 81), one to three letters, two to four digits.
_PROVINCE = "(?:0[1-9]|[1-7][0-9]|8[01])"
PLATE_PATTERN = rf"(?iU)\b{_PROVINCE}\s?[A-ZÇĞİÖŞÜ]{{1,3}}\s?[0-9]{{2,4}}\b"
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}\b"
_BYTE = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IP_PATTERN = rf"\b{_BYTE}(?:\.{_BYTE}){{3}}\b"
#: RFC 4291: eight groups of hexadecimal digits, one run of them left out at most, or the last two an IPv4 address.
_HEX = "[0-9A-Fa-f]{1,4}"
_IP6_FORMS = [f"(?:{_HEX}:){{6}}{_BYTE}(?:\\.{_BYTE}){{3}}", f"(?:{_HEX}:){{7}}{_HEX}", *(f"(?:{_HEX}:){{1,{n}}}(?::{_HEX}){{1,{7 - n}}}" for n in range(1, 7)), f"::(?:[Ff]{{4}}:)?{_BYTE}(?:\\.{_BYTE}){{3}}", f"(?:{_HEX}:){{1,7}}:", f":(?::{_HEX}){{1,7}}"]
#: Each begins with a colon, or digits and a colon: looked at first, as most words do not.
IP6_PATTERN = r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{0,4}:)(?:" + "|".join(_IP6_FORMS) + r")(?![0-9A-Za-z:]|\.[0-9])"


def _digit(text: Column, place: int) -> Column:
    return F.substring(text, place, 1).try_cast("int")


def is_national_id(text: Column | str) -> Column:
    """Eleven digits, the first not zero, with both check digits right; false for anything else."""
    text = F.col(text) if isinstance(text, str) else text
    odd = sum((_digit(text, i) for i in (3, 5, 7, 9)), _digit(text, 1))
    even = sum((_digit(text, i) for i in (4, 6, 8)), _digit(text, 2))
    tenth, last = _digit(text, 10), _digit(text, 11)
    right = (F.pmod(odd * 7 - even, F.lit(10)) == tenth) & (F.pmod(odd + even + tenth, F.lit(10)) == last)
    return F.coalesce(text.rlike("^[1-9][0-9]{10}$") & right, F.lit(False))


def is_iban(text: Column | str) -> Column:
    """A Turkish account number, grouped by spaces or dashes or not, whose remainder by 97 is 1."""
    text = F.upper(F.regexp_replace(F.col(text) if isinstance(text, str) else text, "[ -]", ""))
    turned = F.concat(F.substr(text, F.lit(5)), F.substring(text, 1, 4))
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda rest, c: F.pmod(rest * F.when(c.rlike("^[0-9]$"), 10).otherwise(100) + value(c), F.lit(97)).cast("int")
    rest = F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step)
    return F.coalesce(text.rlike("^TR[A-Z0-9]{24}$") & (rest == 1), F.lit(False))


def replace_valid(text: Column, pattern: str, valid: Callable[[Column], Column], placeholder: str) -> tuple[Column, Column]:
    """The text with those matches replaced that are valid, and how many. A text without a match is not taken apart."""
    some = text.rlike(pattern)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    # an empty match behind the last stretch of text
    pairs = F.arrays_zip(between.alias("gap"), F.concat(found, F.array(F.lit(""))).alias("hit"))
    joined = F.transform(pairs, lambda p: F.concat(p["gap"], F.when((p["hit"] != "") & valid(p["hit"]), placeholder).otherwise(p["hit"])))
    return F.when(some, F.array_join(joined, "")).otherwise(text), F.when(some, F.size(F.filter(found, valid))).when(text.isNotNull(), 0)


def _steps(iban: bool, phone: bool, national_id: bool, plate: bool, validate_iban: bool) -> list[tuple[str, str, Callable[[Column], Column] | None]]:
    every = [
        ("iban", IBAN_PATTERN, is_iban if validate_iban else None, iban),
        ("phone", PHONE_PATTERN, None, phone),
        ("tc_kimlik", ID_PATTERN, is_national_id, national_id),
        ("plate", PLATE_PATTERN, None, plate),
    ]
    return [(kind, pattern, valid) for kind, pattern, valid, wanted in every if wanted]


def redact(df: DataFrame, text_col: str = "text", counts_col: str = "pii", *, iban: bool = True, phone: bool = True, national_id: bool = True, plate: bool = False, validate_iban: bool = True) -> DataFrame:
    """The rows with personal data replaced in ``text_col``, and a map of how many of each kind (kinds without any are left
    out).

    In this order: account numbers, phones, national ids, plates. Account numbers are checked unless told otherwise, ids
    always. Run it on normalised text, so that invisible characters hide nothing. A null text stays null, with no counts.
    Each kind is a projection of its own, so no pattern is matched twice for the next.
    """
    steps = _steps(iban, phone, national_id, plate, validate_iban)
    others = [c for c in df.columns if c not in (text_col, counts_col)]
    numbers: list[str] = []
    for kind, pattern, valid in steps:
        text = F.col(text_col)
        if valid is None:
            new, n = F.regexp_replace(text, pattern, PLACEHOLDERS[kind]), F.regexp_count(text, F.lit(pattern))
        else:
            new, n = replace_valid(text, pattern, valid, PLACEHOLDERS[kind])
        df = df.select(*others, *numbers, new.alias(text_col), n.alias(f"__{kind}"))
        numbers.append(f"__{kind}")
    entries = F.array(*[F.struct(F.lit(n[2:]).alias("key"), F.col(n).alias("value")) for n in numbers]).cast("array<struct<key:string,value:int>>")
    counts = F.map_from_entries(F.filter(entries, lambda e: F.coalesce(e["value"], F.lit(0)) > 0))
    return df.select(*others, text_col, counts.alias(counts_col))


def redact_addresses(text: Column | str) -> Column:
    """E-mail, IPv4 and IPv6 addresses replaced by fixed ones."""
    text = F.col(text) if isinstance(text, str) else text
    text = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL_PATTERN, EMAIL)).otherwise(text)
    for pattern in (IP6_PATTERN, IP_PATTERN):
        text = F.regexp_replace(text, pattern, IP)
    return text
