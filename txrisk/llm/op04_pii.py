"""Format-preserving pseudonyms for personal data.

Addresses, phone, card, bank and social security numbers and dates are found in whole texts and validated (check digits, octets,
calendar). Each becomes another valid value of its own format by a keyed permutation: a Feistel network over the ranks of the
format's valid values, walked until it falls on a rank. Equal values become equal pseudonyms in every document and in every run with
the same key, also where they are punctuated differently or, for e-mail addresses, differ in case. Different values of one format
stay different. The permutation is ``P(P^-1(x) + 1)``, so no value is its own pseudonym.

A pseudonym is as long as its value, with digits, letters and separators in the same places: days, months and octets written with
one digit keep one. Dates are those of the years 1900 to 2099; phone numbers have a country code, or the grouping 3-3-4, and 7 to 12
digits without the code. Where numbers stand side by side, each is found: what isn't valid as a whole is looked at again from each
of its groups of digits.

One narrow pass, no shuffle. Defined cases: a null text stays null, an empty one empty; numbers that fail validation stay; texts are
scanned whole; repeated rows give repeated results; other columns pass through unchanged.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EMAIL = re.compile(r"(?<![\w.+-])([A-Za-z0-9](?:[\w.+-]*\w)?)@((?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})(?![\w-])", re.A)
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)", re.A)
# Anything that a number or date can be part of; cheap to find, as it starts with one of a few characters.
_RUN = re.compile(r"[+(]?[0-9](?:[0-9() ./-]*[0-9])?")
_NUMBER = re.compile(
    r"(?<![\w.])(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)"
    r"|(?<!\w)(?P<iso>\d{4}([-/.])\d{1,2}\3\d{1,2})(?![\w]|[-/.]\d)"
    r"|(?<![\w.])(?P<dmy>\d{1,2}([-/.])\d{1,2}\5\d{4})(?![\w]|[-/.]\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w]|-\d)"
    r"|(?<![\w.])(?P<card>\d(?:[ -]?\d){12,18})(?![\w]|[ -]?\d)"
    r"|(?<![\w.])(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}([ .-])\d{3}\9\d{4})(?!\w|[.-]\d)",
    re.A,
)
# What a number may be whose longest reading isn't valid: cards in their usual groups, and the other kinds as above.
_AGAIN = {
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?!\w|-\d)", re.A),
    "card": re.compile(r"(?<![\w.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{4,5})(?!\w)", re.A),
    "phone": re.compile(
        r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}([ .-])\d{3}\1\d{4})(?!\w|[.-]\d)",
        re.A,
    ),
}
_GROUP = re.compile(r"[+(]*\d+")
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # to the end of 2099
KEY_SETTING = "spark.txrisk.pii.key"


def configured_key(spark: SparkSession) -> bytes:
    """The key that ``spark.txrisk.pii.key`` names; without it a public one for trials, with which anybody can undo the pseudonyms."""
    return spark.conf.get(KEY_SETTING, "trial key, not secret").encode()


@lru_cache(4)
def _days(month_width: int, day_width: int) -> list[int]:
    """The days from 1900 to 2099 that can be written with so many digits for month and day."""
    every = (datetime.date.fromordinal(_FIRST_DAY + i) for i in range(_DAYS))
    return [d.toordinal() for d in every if d.month < 10**month_width and d.day < 10**day_width]


class Permutation:
    """A keyed permutation of 0 .. size-1 without fixed points (if size is over 1), the same wherever key and name are."""

    ROUNDS = 10

    def __init__(self, key: bytes, name: str, size: int):
        self.size, self.half = size, max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.rounds = [hashlib.blake2b(f"{name}:{size}:{i}".encode(), key=key[:64], digest_size=32).digest() for i in range(self.ROUNDS)]

    def _mix(self, i: int, value: int) -> int:
        data = value.to_bytes((self.half + 7) // 8, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.rounds[i], digest_size=min(64, (self.half + 15) // 8)).digest(), "big") & self.mask

    def _walk(self, value: int, forward: bool) -> int:
        while True:
            left, right = value >> self.half, value & self.mask
            if forward:
                for i in range(self.ROUNDS):
                    left, right = right, left ^ self._mix(i, right)
            else:
                for i in reversed(range(self.ROUNDS)):
                    left, right = right ^ self._mix(i, left), left
            value = left << self.half | right
            if value < self.size:
                return value

    def __call__(self, value: int) -> int:
        return self._walk((self._walk(value, False) + 1) % self.size, True)


def luhn_digit(body: str) -> str:
    """The check digit that makes ``body`` plus it valid."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (1 if i % 2 else 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _relaid(layout: str, characters: str) -> str:
    """``characters`` in the places of the letters and digits of ``layout``."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in layout)


class Pseudonyms:
    """Pseudonyms of one key; made once per task."""

    def __init__(self, key: bytes):
        self.key = key
        self.permutation = lru_cache(4096)(lambda name, size: Permutation(key, name, size))
        self.value = lru_cache(65_536)(self._value)

    def _by_class(self, name: str, text: str) -> str:
        """Letters become letters of the same case and digits digits, as one rank over all of them."""
        size, rank, bases = 1, 0, []
        for c in text:
            first, base = (("0", 10) if c.isdigit() else ("a", 26) if c.islower() else ("A", 26)) if c.isalnum() else ("", 0)
            if base:
                rank, size = rank * base + ord(c) - ord(first), size * base
                bases.append((first, base))
        rank, out = self.permutation(f"{name}:{''.join(f for f, _ in bases)}", size)(rank), []
        for first, base in reversed(bases):
            rank, d = divmod(rank, base)
            out.append(chr(ord(first) + d))
        return _relaid(text, "".join(reversed(out)))

    def _value(self, kind: str, text: str) -> str | None:
        """The pseudonym, or None where the value isn't valid."""
        return getattr(self, f"_{kind}")(text)

    def _email(self, text: str) -> str:
        local, _, domain = text.partition("@")
        # A short local part has few pseudonyms, the domain's first label adds more; the rest of the domain stays.
        label, _, rest = domain.partition(".")
        named = f"{local}@{label}"
        new = self._by_class("email", named.lower())
        return "".join(n.upper() if c.isupper() else n for c, n in zip(named, new)) + f".{rest}"

    def _iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        check = lambda s: int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97
        if not 15 <= len(plain) <= 34 or check(plain) != 1:
            return None
        body = plain[:2] + "00" + self._by_class("iban" + plain[:2], plain[4:])
        return _relaid(text, f"{body[:2]}{98 - check(body):02}{body[4:]}")

    def _ip(self, text: str) -> str | None:
        parts = text.split(".")
        if max(map(int, parts)) > 255:
            return None
        # Octets stay among those of as many digits; with a leading zero, among those too.
        ranges = [((0 if p[0] == "0" else 10 ** (len(p) - 1)) if len(p) > 1 else 0, 10 ** (len(p) - (p[0] == "0" and len(p) > 1))) for p in parts]
        ranges = [(first, min(end, 256)) for first, end in ranges]
        rank, size = 0, 1
        for p, (first, end) in zip(parts, ranges):
            rank, size = rank * (end - first) + int(p) - first, size * (end - first)
        rank, out = self.permutation("ip:" + ",".join(f"{len(p)}{p[0] == '0'}" if len(p) > 1 else "1" for p in parts), size)(rank), []
        for p, (first, end) in reversed(list(zip(parts, ranges))):
            rank, d = divmod(rank, end - first)
            out.append(f"{first + d:0{len(p)}}")
        return ".".join(reversed(out))

    def _card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = self._by_class("card", digits[:-1])
        return _relaid(text, body + luhn_digit(body))

    def _phone(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        country = len(re.match(r"\+?(\d*)", text)[1]) if text[0] == "+" and re.match(r"\+\d{1,3}[ .(-]", text) else 0
        if not 7 <= len(digits) - country <= 12:
            return None
        return _relaid(text, digits[:country] + self._by_class("phone", digits[country:]))

    def _ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        rank, serial = divmod(self.permutation("ssn", 898 * 99 * 9999)(rank), 9999)
        area, group = divmod(rank, 99)
        return f"{area + 1 + (area >= 665):03}-{group + 1:02}-{serial + 1:04}"

    def _day(self, year: int, month: str, day: str) -> tuple[str, str, str] | None:
        """Year, month and day of the pseudonym, as wide as they were."""
        try:
            own = datetime.date(year, int(month), int(day)).toordinal()
        except ValueError:
            return None
        days = _days(len(month), len(day))
        rank = bisect_left(days, own)
        if rank == len(days) or days[rank] != own:
            return None
        name = "date" if len(month) == len(day) == 2 else f"date{len(month)}{len(day)}"
        new = datetime.date.fromordinal(days[self.permutation(name, len(days))(rank)])
        return str(new.year), f"{new.month:0{len(month)}}", f"{new.day:0{len(day)}}"

    def _iso(self, text: str) -> str | None:
        sep = text[4]
        year, month, day = text.split(sep)
        return (new := self._day(int(year), month, day)) and sep.join(new)

    def _dmy(self, text: str) -> str | None:
        """With slashes the month comes first where that is valid; with points and hyphens the day does."""
        sep = re.search(r"[-/.]", text)[0]
        a, b, year = text.split(sep)
        month_first = sep == "/" and int(a) <= 12
        if not (new := self._day(int(year), *((a, b) if month_first else (b, a)))):
            return None
        return sep.join([*((new[1], new[2]) if month_first else (new[2], new[1])), new[0]])

    def number(self, text: str, m: re.Match[str], limit: int, inner: bool) -> tuple[int, str, str] | None:
        """End, kind and pseudonym of the number that starts where ``m`` does, if one of its readings is valid.

        ``inner`` says that it starts inside one that isn't valid; a card in odd groups would be found there by chance.
        """
        kind = m.lastgroup or next(k for k, v in m.groupdict().items() if v)
        if not (inner and kind == "card") and (new := self.value(kind, m[0])):
            return m.end(), kind, new
        for kind, pattern in _AGAIN.items():
            if (again := pattern.match(text, m.start(), limit)) and (new := self.value(kind, again[0])):
                return again.end(), kind, new
        return None


def find_and_replace(text: str, names: Pseudonyms) -> tuple[str, list[str]]:
    """The text with pseudonyms, and ``kind:start:end`` of each replaced value in the old text."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", names.value("email", m[0])) for m in _EMAIL.finditer(text)]
    for m in _IBAN.finditer(text):
        # Capitals or digits after the number can look like a part of it; the longest valid start counts.
        whole = m[0]
        for end in range(len(whole), 14, -1):
            if (end == len(whole) or whole[end] == " ") and (new := names.value("iban", whole[:end])):
                found.append((m.start(), m.start() + end, "iban", new))
                break
    for run in _RUN.finditer(text):
        if run.end() - run.start() < 7:
            continue
        at, end, failed = run.start(), min(run.end() + 2, len(text)), 0
        while m := _NUMBER.search(text, at, end):
            if number := names.number(text, m, end, m.start() < failed):
                at, kind, new = number
                found.append((m.start(), at, "date" if kind in ("iso", "dmy") else kind, new))
            else:
                at, failed = _GROUP.match(text, m.start(), end).end(), max(failed, m.end())
    parts, spans, done = [], [], 0
    for start, end, kind, new in sorted(found):
        if start >= done:
            parts += [text[done:start], new]
            spans.append(f"{kind}:{start}:{end}")
            done = end
    return "".join([*parts, text[done:]]) if parts else text, spans


def pseudonymise(docs: DataFrame, key: bytes, text_column: str = "text", spans_column: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_column``; ``spans_column`` adds what was replaced, as text."""
    at = docs.columns.index(text_column)
    frame = docs.withColumn(text_column, F.col(text_column).cast("string"))
    schema = T.StructType([*frame.schema.fields, *([T.StructField(spans_column, T.StringType())] if spans_column else [])])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key)
        for batch in batches:
            done = [(None, []) if t is None else find_and_replace(t, names) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], pa.string())
            columns += [pa.array([",".join(s) for _, s in done], pa.string())] * (spans_column is not None)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return frame.mapInArrow(replace, schema)
