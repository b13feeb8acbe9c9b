"""Spoken Hebrew of numbers, times, dates, phone numbers and units.

Genders: ``m`` and ``f`` cardinal, ``m0`` and ``f0`` ordinal up to ten, ``mn`` and ``fn`` before a noun.
Everything here is a pure function of its arguments.
"""

from __future__ import annotations

import re
from functools import lru_cache

from . import lexicon as lx

_TIME = re.compile(r"(\d\d):(\d\d)\n?")
_NUMERAL = re.compile(r"(-?)(?:([1-9]\d{0,2}(?:,\d{3})*)|(\d+))(?:\.(\d+))?\n?")
_QUANTITY = re.compile(r"([+-]?\d[\d,]*(?:\.\d+)?)(°[CF]|[A-Za-z%]{1,4})\n?")
_PHONE = re.compile(r"0\d{1,2}-?\d{7}\n?")
_LONG_DATE = re.compile(r"(\d{1,2})([./-])(\d{1,2})\2(\d{2,4})\n?")
_SHORT_DATE = re.compile(r"(\d{1,2})[/-](\d{1,2})\n?")
_MASCULINE = ("m", "m0", "mn")


def _unit(n: int, gender: str) -> str:
    """0 to 19 on its own."""
    if gender in ("m0", "f0") and 1 <= n <= 10:
        return (lx.ORDINALS_M if gender == "m0" else lx.ORDINALS_F)[n]
    return (lx.UNITS_M if gender in ("m", "mn") else lx.UNITS_F)[n]  # ordinals beyond ten are feminine cardinals


def _two_of(gender: str) -> str | None:
    return {"mn": lx.TWO_OF_M, "fn": lx.TWO_OF_F}.get(gender)


def _below_hundred(n: int, gender: str) -> str:
    if n < 20:
        return _unit(n, gender)
    tens, units = divmod(n, 10)
    if not units:
        return lx.TENS[tens]
    last = (_two_of(gender) if units == 2 else None) or (lx.UNITS_M if gender in _MASCULINE else lx.UNITS_F)[units]
    return f"{lx.TENS[tens]} {lx.AND}{last}"


def integer(value: int, gender: str = "f", compat: bool = True) -> str:
    """A whole number from 0 up, of any size.

    With ``compat``, a number that ends in 2 before a noun is just that "two": all that leads up to it
    is lost (102 and 1002 become "two of"; 22 does not). Without, the rest is kept.
    """
    parts = []
    for size, word in ((10**9, lx.BILLION), (10**6, lx.MILLION)):
        count, value = divmod(value, size)
        if count:
            parts.append(word if count == 1 else f"{integer(count, 'm', compat)} {word}")
    count, value = divmod(value, 1000)
    if count:
        parts.append(lx.THOUSANDS[count] if count < len(lx.THOUSANDS) else f"{integer(count, 'm', compat)} {lx.THOUSANDS[1]}")
    hundreds, rest = divmod(value, 100)
    if hundreds:
        parts.append(lx.HUNDREDS[hundreds])
    if rest or not parts:
        two = _two_of(gender) if rest == 2 else None
        if two and compat:
            return two
        joined = parts and (hundreds == 1 or rest < 20 or rest % 10 == 0)
        parts.append((lx.AND if joined else "") + (two or _below_hundred(rest, gender)))
    return " ".join(parts)


def numeral(token: str) -> tuple[int, str] | None:
    """Whole part and digits after the point of a plain or comma-grouped number."""
    m = _NUMERAL.fullmatch(token)
    if not m:
        return None
    sign, grouped, plain, fraction = m.groups()
    return int(sign + (grouped.replace(",", "") if grouped else plain)), fraction or ""


def fraction(digits: str) -> str:
    """Digits after a point: "and a half", a two-digit number, or digit by digit."""
    if digits == "5":
        return lx.AND_HALF
    if len(digits) == 2 and digits[0] != "0":
        return f"{lx.POINT} {integer(int(digits), 'f')}"
    return " ".join([lx.POINT, *(lx.UNITS_F[int(d)] for d in digits)])


def number(token: str, gender: str = "f", compat: bool = True) -> str | None:
    """A numeral; negative ones are feminine, and a minus before zero is not heard."""
    found = numeral(token)
    if found is None:
        return None
    whole, digits = found
    if whole == 0 and digits == "5":
        return lx.HALF
    words = f"{lx.MINUS} {integer(-whole, 'f', compat)}" if whole < 0 else integer(whole, gender, compat)
    return f"{words} {fraction(digits)}" if digits else words


def clock(hour: int, minute: int) -> str | None:
    """A time of day; None outside 00:00 to 23:59. Noon and midnight are both "in the morning"."""
    if hour > 23 or minute > 59:
        return None
    words = lx.UNITS_F[hour % 12 or 12]
    if minute not in (0, 15, 30):
        return f"{words} {lx.AND + integer(minute, 'm') if minute % 10 == 0 else integer(minute, 'f')}"
    part = {0: "", 15: " " + lx.AND_QUARTER, 30: " " + lx.AND_HALF}[minute]
    return f"{words}{part} {lx.AFTERNOON if hour > 12 else lx.MORNING}"


@lru_cache(1 << 16)
def spoken(token: str, gender: str = "f", compat: bool = True) -> str | None:
    """A number, time or amount, perhaps after prepositions with a dash; None if it is none of these."""
    for prefix in lx.PREPOSITIONS:
        if token.startswith(prefix) and (rest := spoken(token[len(prefix) :], gender, compat)):
            return prefix[:-1] + rest
    if m := _TIME.fullmatch(token):
        return clock(int(m[1]), int(m[2]))
    if token and token[-1] in lx.SYMBOL_UNITS:
        word, own = lx.SYMBOL_UNITS[token[-1]]
        if amount := number(token[:-1], own, compat):
            return f"{amount} {word}"
    return number(token, gender, compat)


def quantity(token: str, compat: bool = True) -> str | None:
    """A number with a unit, like 2.5kg or 20°C; whole numbers stand before the unit's noun."""
    m = _QUANTITY.fullmatch(token)
    if not m:
        return None
    amount, unit = m.groups()
    if unit in lx.DEGREES:
        word, gender = lx.DEGREES[unit], "f"
    else:
        word, gender = lx.UNIT_WORDS.get(unit) or lx.UNIT_WORDS.get(unit.lower()), "m"
    if not word:
        return None
    return f"{spoken(amount, gender if '.' in amount else gender + 'n', compat) or amount} {word}"


def phone(token: str) -> str | None:
    """A phone number, digit by digit."""
    return " ".join(lx.UNITS_F[int(d)] for d in token if d.isdigit()) if _PHONE.fullmatch(token) else None


def date(token: str) -> str | None:
    """Day and month, perhaps a year; None if out of range."""
    if m := _LONG_DATE.fullmatch(token):
        day, month, year = m[1], m[3], m[4]
    elif m := _SHORT_DATE.fullmatch(token):
        day, month, year = m[1], m[2], None
    else:
        return None
    if not (1 <= int(day) <= 31 and 1 <= int(month) <= 12):
        return None
    words = [lx.FIRST_OF_MONTH if int(day) == 1 else integer(int(day), "f"), lx.MONTHS[int(month) - 1]]
    return " ".join(words + ([integer(int(year), "f")] if year else []))
