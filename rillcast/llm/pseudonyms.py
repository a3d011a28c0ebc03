"""Format-preserving pseudonyms for personal data in texts (operator 1)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from rillcast.llm.feistel import ANY_SCRIPT, DIGITS, HEX_LARGE, HEX_SMALL, permuted, permuted_text, same_kind

FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
# What may stand between the parts of a number or around a sign of assignment.
GAP = r"[^0-9A-Za-z\n]{0,6}"
NUMBERS = re.compile(
    r"[0-9+(](?:"
    r"(?<=\+)1" + GAP + r"(?P<p1>[0-9]{3})" + GAP + r"(?P<p2>[0-9]{3})" + GAP + r"(?P<p3>[0-9]{4})(?![0-9])"
    r"|(?<=\()(?P<q1>[0-9]{3})\)[ .-]?(?P<q2>[0-9]{3})[ .-](?P<q3>[0-9]{4})(?![0-9])"
    r"|(?<![0-9.][0-9])(?<=[0-9])(?P<ip>[0-9]{0,2}(?:\.[0-9]{1,3}){3})(?![0-9]|\.[0-9])"
    r"|(?<![0-9][0-9])(?<=[0-9])(?P<iso>[0-9]{3}-[0-9]{2}-[0-9]{2})(?![0-9]|-[0-9])"
    r"|(?<![0-9./][0-9])(?<=[0-9])(?P<dmy>[0-9]?(?P<s>[./])[0-9]{1,2}(?P=s)[0-9]{4})(?![0-9])"
    r"|(?<![0-9-][0-9])(?<=[0-9])(?P<ssn>[0-9]{2}-[0-9]{2}-[0-9]{4})(?![0-9]|-[0-9])"
    r"|(?<![0-9][0-9])(?<=[0-9])(?P<t1>[0-9]{2}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9]|[.-][0-9])"
    r"|(?<![0-9][0-9])(?<=[0-9])(?P<card>[0-9]{12,18}|[0-9]{3}(?:[ -][0-9]{4}){3}|[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"
    r")"
)
# Country code (not 1) and groups, as many as hold 8 to 15 digits in all. A blank, point, hyphen, slash or bracket may stand between.
ABROAD = re.compile(r"(?<![0-9A-Za-z+])\+(?P<number>[2-9][0-9]{0,2}(?:[ ./-]?\(?[0-9]+\)?)*[0-9])(?![0-9])")
MAIL_END = re.compile(r"@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
MAIL_START = re.compile(r"[\w.%+-]{1,64}$")
SECRET_VALUE = re.compile(r"[=:]" + GAP + r"(?P<value>[A-Za-z0-9+/_-]{8,})")
SECRET_NAME = re.compile(r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer)" + GAP + "$")
# Openings of widely used access keys, which stay, and what follows them.
KEYS = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)(?P<id>[A-Z0-9]{16})|gh[pousr]_(?P<hub>[A-Za-z0-9]{36})|xox[abprs]-(?P<chat>[A-Za-z0-9-]{10,})"
    r"|AIza(?P<api>[A-Za-z0-9_-]{35})|sk-(?P<sk>[A-Za-z0-9_-]{20,}))(?![A-Za-z0-9])"
)
IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}))")
# The country codes' lengths follow the IBAN registry; other countries' accounts are tried at every end.
IBAN_CHARS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18, DO=28, EE=20, EG=29,
    ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20,
    LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, LY=25, MC=27, MD=24, ME=22, MK=19, MR=27, MT=31, MU=30, NL=18, NO=15, PK=24, PL=28, PS=29, PT=25,
    QA=29, RO=24, RS=22, SA=24, SC=31, SE=24, SI=19, SK=24, SM=27, ST=25, SV=28, TL=23, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20,
)


class Found(NamedTuple):
    kind: str
    start: int
    end: int
    image: str


def luhn_digit(payload: str) -> str:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 - k % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def put(form: str, digits: str) -> str:
    """The text with its digits replaced in order; everything else keeps its place."""
    image = iter(digits)
    return "".join(next(image) if c in DIGITS else c for c in form)


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def card(text: str, key: bytes, back: bool) -> str | None:
    """A number with a right check digit: the others are permuted, the check digit follows."""
    digits = digits_of(text)
    if digits[0] == "0" or len(set(digits)) == 1 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    low, n = 10 ** (len(digits) - 2), 9 * 10 ** (len(digits) - 2)
    payload = str(low + permuted(int(digits[:-1]) - low, n, key, "card", back))
    return put(text, payload + luhn_digit(payload))


def phone(text: str, key: bytes, back: bool) -> str:
    return put(text, permuted_text(digits_of(text), [DIGITS] * len(digits_of(text)), key, "phone", back))


# Country codes of two digits (ITU-T E.164); 7 has one, all others three.
TWO_DIGITS = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def calling_code(number: str) -> str:
    return number[:1] if number[0] == "7" else number[:2] if number[:2] in TWO_DIGITS else number[:3]


def address(text: str, key: bytes, back: bool) -> str | None:
    """An IPv4 address, kept among those of four numbers up to 255 without zeros in front."""
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    x = permuted(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "address", back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def social(text: str, key: bytes, back: bool) -> str | None:
    """A number ddd-dd-dddd whose parts are in use."""

    def used(x: int) -> bool:
        area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    x = int(digits_of(text))
    return put(text, f"{permuted(x, 10**9, key, 'social', back, used):09d}") if used(x) else None


def date(text: str, key: bytes, back: bool) -> str | None:
    """A date of 1900 to 2099 as y-m-d, d.m.y, m/d/y or, where that is no date, d/m/y; widths of day and month follow the text's."""
    numbers = [int(p) for p in re.split(r"[-./]", text)]
    sign = "-" if "-" in text else "/" if "/" in text else "."
    # A day over 12 in front: images keep it, so the order can be told from them.
    day_first = sign == "/" and numbers[0] > 12
    order = {"-": (0, 1, 2), ".": (2, 1, 0), "/": (2, 1, 0) if day_first else (2, 0, 1)}[sign]
    try:
        day = dt.date(*(numbers[k] for k in order)).toordinal()
    except ValueError:
        return None
    padded = all(len(p) > 1 for p in re.split(r"[-./]", text))

    def written(d: dt.date) -> str:
        parts = {"-": (d.year, d.month, d.day), ".": (d.day, d.month, d.year), "/": (d.day, d.month, d.year) if day_first else (d.month, d.day, d.year)}[sign]
        return sign.join(f"{p:02d}" if padded else str(p) for p in parts)

    if not FIRST_DAY <= day <= LAST_DAY or written(dt.date.fromordinal(day)) != text:
        return None

    def same_form(x: int) -> bool:
        # Without padding, dates whose numbers have one digit are kept apart, so the form can be told from the image.
        image = dt.date.fromordinal(FIRST_DAY + x)
        return (not day_first or image.day > 12) and (padded or not all(len(p) > 1 for p in re.split(r"[-./]", written(image))))

    # One permutation of days for all forms: a day that a form can hold is the same day in every form.
    x = permuted(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date", back, same_form)
    return written(dt.date.fromordinal(FIRST_DAY + x))


def account(text: str, key: bytes, back: bool) -> str | None:
    """An account number with right check digits: the account is permuted, country kept, check digits made anew."""
    bare = text.replace(" ", "")
    remainder = lambda a, c: int("".join(str(int(x, 36)) for x in a + c)) % 97
    if not 15 <= len(bare) <= 34 or remainder(bare[4:], bare[:4]) != 1:
        return None
    body = same_kind(bare[4:], key, f"account{bare[:2]}", back)
    image = bare[:2] + f"{98 - remainder(body, bare[:2] + '00'):02d}" + body
    # Check digits 98 and 97 also stand for 01 and 00: those that come out are the usual ones.
    letters = iter(image)
    return "".join(c if c == " " else next(letters) for c in text)


def account_at(text: str, start: int, span: str, key: bytes, back: bool) -> tuple[int, str] | None:
    """End and image of the account number that a span of capitals, digits and single blanks begins with.

    It ends where its country's numbers do, elsewhere at the longest end with right check digits; no letter or digit follows.
    """
    length = IBAN_CHARS.get(span[:2])
    places = [k + 1 for k, c in enumerate(span) if c != " "]
    for n in [length] if length else range(min(len(places), 34), 14, -1):
        if n > len(places):
            continue
        after = text[start + places[n - 1] : start + places[n - 1] + 1]
        if not (after.isascii() and after.isalnum()) and (image := account(span[: places[n - 1]], key, back)) is not None:
            return start + places[n - 1], image
    return None


def alphabet_of(text: str) -> str | None:
    """The smallest alphabet that holds all characters of a secret, None if it isn't decimal or hexadecimal."""
    return next((a for a in (DIGITS, HEX_SMALL, HEX_LARGE) if all(c in a for c in text)), None)


def secret(text: str, key: bytes, back: bool) -> str:
    """Image of a secret of the same alphabet: decimal stays decimal, hexadecimal keeps a letter, others don't become either."""
    alphabet = alphabet_of(text)
    same = lambda image: alphabet_of(image) == alphabet
    if alphabet is None:
        return same_kind(text, key, "secret", back, same)
    return permuted_text(text, [alphabet] * len(text), key, f"secret{len(alphabet)}{alphabet[-1]}", back, same)


def found_in(text: str, key: bytes, back: bool = False) -> list[Found]:
    """Personal data of a text with their images, from left to right, without overlaps."""
    spans: list[Found] = []

    def take(kind: str, start: int, end: int, image: str | None) -> None:
        if image is not None:
            spans.append(Found(kind, start, end, image))

    for m in SECRET_VALUE.finditer(text):
        if SECRET_NAME.search(text, max(0, m.start() - 32), m.start()):
            a, b = m.span("value")
            take("secret", a, b, secret(text[a:b], key, back))
    for m in KEYS.finditer(text):
        a, b = m.span(m.lastgroup)
        take("secret", a, b, same_kind(text[a:b], key, "key", back))
    for m in MAIL_END.finditer(text):
        if name := MAIL_START.search(text, max(0, m.start() - 64), m.start()):
            take("mail", name.start(), m.end(), same_kind(name[0], key, "mail", back, letters=ANY_SCRIPT) + m[0])
    for m in IBAN.finditer(text):
        if ended := account_at(text, m.start(), m[1], key, back):
            take("account", m.start(), *ended)
    for m in ABROAD.finditer(text):
        a, b = m.start("number"), m.start("number")
        for group in re.finditer("[0-9]+", m["number"]):
            if len(digits_of(m["number"][: group.end()])) > 15:
                break
            b = a + group.end()
        if len(digits_of(text[a:b])) >= 8:
            a += len(calling_code(m["number"]))
            take("phone", a, b, phone(text[a:b], key, back))
    for m in NUMBERS.finditer(text):
        a, b = m.span()
        kind = m.lastgroup
        if m["p1"] or m["q1"]:
            a = m.start("p1") if m["p1"] else m.start("q1")
            take("phone", a, b, phone(text[a:b], key, back))
        elif m["t1"]:
            take("phone", a, b, phone(m[0], key, back))
        elif m["ip"] is not None:
            take("address", a, b, address(m[0], key, back))
        elif m["iso"] or kind == "dmy" or m["dmy"]:
            take("date", a, b, date(m[0], key, back))
        elif m["ssn"]:
            take("social", a, b, social(m[0], key, back))
        elif m["card"]:
            take("card", a, b, card(m[0], key, back))
    spans.sort(key=lambda f: (f.start, -f.end))
    out: list[Found] = []
    for f in spans:
        if not out or f.start >= out[-1].end:
            out.append(f)
    return out


def replaced(text: str, found: list[Found]) -> str:
    parts, at = [], 0
    for f in found:
        parts += [text[at : f.start], f.image]
        at = f.end
    return "".join([*parts, text[at:]])


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False, name: str = "private") -> DataFrame:
    """Documents with personal data in ``text`` replaced, and a list ``name`` of (kind, start, end) in the new text.

    Card, account and social numbers, dates and addresses are replaced when
    they are valid, and their images are valid in the same format; phone
    numbers, names in mail addresses, access keys and values of passwords and
    tokens are replaced as they are written. The image depends on value, kind and key
    alone: equal values stay linked across documents, and whoever holds the
    key gets them back with ``back``. Every image has its value's length, but
    for dates without zeros in front and addresses.

    Each row is handled alone and nothing is shuffled. Null and clean texts
    stay as they are (an empty list); repeated rows, null ids and other columns
    are kept whatever their names; only a column called ``name`` is replaced.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must hold 16 to 64 bytes")

    def run(batches) -> Iterator[pa.RecordBatch]:
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts, spans = [], []
            for text in batch.column("text").to_pylist():
                found = found_in(text, key, back) if text else []
                places, moved = [], 0
                for f in found:
                    start = f.start + moved
                    moved += len(f.image) - (f.end - f.start)
                    places.append({"kind": f.kind, "start": start, "end": start + len(f.image)})
                texts.append(replaced(text, found) if found else text)
                spans.append(places)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(spans, kinds)], names=["row", "text", "found"])

    empty = F.struct("*").withField("text", F.lit(None).cast("string"))
    rows = docs.select(empty.alias("row"), F.col("text").cast("string").alias("text"))
    spans = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))
    out = rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("found", spans)]))
    whole = F.col("row").withField("text", F.col("text"))
    if name in docs.columns:
        whole = whole.dropFields(f"`{name}`")
    return out.select(whole.alias("row"), "found").select("row.*", F.col("found").alias(name))
