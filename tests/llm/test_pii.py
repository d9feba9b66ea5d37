"""Pseudonyms against planted values: numbers side by side, widths, linked spellings, one-to-one formats, the key."""

from __future__ import annotations

import datetime
import ipaddress
import random
import re

import pytest

from txrisk.llm import op04_pii
from txrisk.llm.op04_pii import Pseudonyms, configured_key, find_and_replace, luhn_digit

NAMES = Pseudonyms(b"test")


def shape(text: str) -> str:
    return re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", text)))


def planted(rng: random.Random) -> str:
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    day = datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(73_049))
    body = "4" + digits(14)
    card = body + luhn_digit(body)
    return rng.choice(
        [
            f"{rng.randint(1, 665):03}-{rng.randint(1, 99):02}-{rng.randint(1, 9999):04}",
            " ".join(card[i : i + 4] for i in range(0, 16, 4)),
            card,
            f"{rng.randint(200, 999)}-555-{digits(4)}",
            f"({rng.randint(200, 999)}) 555-{digits(4)}",
            day.isoformat(),
            f"{day.year}-{day.month}-{day.day}",
            f"{day.day}.{day.month}.{day.year}",
            ".".join(str(rng.randint(0, 255)) for _ in range(4)),
            f"{rng.choice(['Ann', 'bob', 'C.D'])}{rng.randint(0, 99)}@mail{rng.randint(0, 9)}.example.org",
        ]
    )


@pytest.mark.parametrize("seed", range(200))
def test_every_planted_value_goes_and_keeps_its_shape(seed):
    rng = random.Random(seed)
    values = [planted(rng) for _ in range(6)]
    text = "see " + "; ".join(values) + " and 12 of 345."
    new, spans = find_and_replace(text, NAMES)
    assert shape(new) == shape(text)
    assert len(spans) == len(values)
    parts = new.removeprefix("see ").removesuffix(" and 12 of 345.").split("; ")
    for old, own in zip(values, parts):
        assert own != old and find_and_replace(old, NAMES)[0] == own


def test_numbers_side_by_side():
    for text, spans in [
        ("order 12 4111 1111 1111 1111", ["card:9:28"]),
        ("017-555-7713 123-45-6789", ["phone:0:12", "ssn:13:24"]),
        ("4111 1111 1111 1111 12", ["card:0:19"]),
        ("+1 555 123 4567 123-45-6789", ["phone:0:15", "ssn:16:27"]),
        ("1 2 3 4 5 6 7 8 9 10 11 12 13", []),
        ("4111 1111 1111 1112", []),
        ("2020-13-05 2020-02-30 256.1.1.1 000-12-3456", []),
    ]:
        new, found = find_and_replace(text, NAMES)
        assert found == spans and shape(new) == shape(text)
        assert (new == text) == (not spans)


@pytest.mark.parametrize("widths", [(1, 1), (1, 2), (2, 1), (2, 2)])
def test_dates_are_permuted_within_their_widths(widths):
    days = op04_pii._days(*widths)
    step = max(1, len(days) // 4_000)
    seen = {}
    for ordinal in days[::step]:
        d = datetime.date.fromordinal(ordinal)
        text = f"{d.year}-{d.month:0{widths[0]}}-{d.day:0{widths[1]}}"
        new = NAMES.value("iso", text)
        assert shape(new) == shape(text) and new != text
        year, month, day = map(int, new.split("-"))
        datetime.date(year, month, day)
        seen[new] = text
    assert len(seen) == len(days[::step])


def test_addresses_are_permuted_one_to_one():
    seen = {NAMES.value("ip", f"1.2.{a}.{b}") for a in range(10) for b in range(10, 100)}
    assert len(seen) == 900 and all(shape(v) == "0.0.0.00" and ipaddress.ip_address(v) for v in seen)
    assert len({NAMES.value("ip", f"0.0.0.{b:03}") for b in range(100)}) == 100
    assert all(shape(NAMES.value("ip", v)) == shape(v) for v in ("255.255.255.255", "0.0.0.0", "010.01.1.100"))


def test_spellings_of_one_value_are_linked():
    a, b = NAMES.value("email", "Bob.Lee@x.com"), NAMES.value("email", "bob.lee@X.com")
    assert a.lower() == b.lower() and shape(a) == "Aaa.Aaa@a.aaa"
    assert NAMES.value("card", "4111 1111 1111 1111").replace(" ", "") == NAMES.value("card", "4111111111111111")


def test_another_key_gives_other_pseudonyms(spark):
    assert Pseudonyms(b"other").value("ssn", "123-45-6789") != NAMES.value("ssn", "123-45-6789")
    trial = configured_key(spark)
    spark.conf.set(op04_pii.KEY_SETTING, "secret")
    try:
        assert configured_key(spark) == b"secret" != trial
    finally:
        spark.conf.unset(op04_pii.KEY_SETTING)
