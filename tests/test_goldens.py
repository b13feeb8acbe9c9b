"""Texts and numbers with known results, read off FIXTURES.md."""

from pathlib import Path

import pytest

from voxloom.functions import rewrite, spoken

FIXTURES = (Path(__file__).resolve().parents[1] / "FIXTURES.md").read_text(encoding="utf8")
MODES = {"C": lambda t: rewrite.for_speech(t, rewrite.CAUTIOUS), "E": lambda t: rewrite.for_speech(t, rewrite.EXPANDED), "P": lambda t: rewrite.for_speech(t, rewrite.PREPARATION), "S": rewrite.for_transcript}


def _cases():
    source = None
    for line in FIXTURES[FIXTURES.index("## 3. Text goldens") : FIXTURES.index("### 3.1")].splitlines():
        cells = [c.strip() for c in line.strip()[1:-1].split("|")]
        if len(cells) < 4 or cells[0] in ("#", "---") and cells[1] in ("input", "---"):
            continue
        if cells[1].startswith("`"):
            source = cells[1].strip("`")
        elif cells[1].startswith("U+"):
            source = "❤️\U0001f642"
        if cells[3].startswith("`"):
            expected = cells[3].split("` (")[0].strip("`")
        elif cells[3] == "unchanged":
            expected = source
        elif cells[3].startswith("U+FE0F"):
            expected = "️"
        else:
            continue
        for mode in cells[2].split(", "):
            yield pytest.param(source, mode, expected, id=f"{cells[0]}-{mode}-{source[:12]}")


@pytest.mark.parametrize("text, mode, expected", list(_cases()))
def test_text(text, mode, expected):
    assert MODES[mode](text) == expected


def test_enough_cases():
    assert len(list(_cases())) >= 30


INTEGERS = [
    (0, "f", "אפס"), (12, "f", "שתים עשרה"), (2, "mn", "שני"), (2, "fn", "שתי"), (22, "mn", "עשרים ושני"), (102, "mn", "שני"), (1002, "mn", "שני"), (110, "m", "מאה ועשרה"), (125, "f", "מאה ועשרים וחמש"),
    (205, "f", "מאתיים וחמש"), (225, "f", "מאתיים עשרים וחמש"), (5, "f0", "חמישית"), (11000, "f", "אחד עשר אלף"), (2026, "f", "אלפיים עשרים ושש"), (3000001, "f", "שלושה מיליון ואחת"),
]


@pytest.mark.parametrize("value, gender, expected", INTEGERS)
def test_integer(value, gender, expected):
    assert spoken.integer(value, gender) == expected


TOKENS = [
    ("-5", "f", "מינוס חמש"), ("-0.5", "f", "חצי"), ("0.25", "f", "אפס נקודה עשרים וחמש"), ("3.05", "f", "שלוש נקודה אפס חמש"), ("1,234.5", "f", "אלף מאתיים שלושים וארבע וחצי"), ("12,34", "f", None), ("+5", "f", None),
    ("00:00", "f", "שתים עשרה בבוקר"), ("12:15", "f", "שתים עשרה ורבע בבוקר"), ("09:20", "f", "תשע ועשרים"), ("09:05", "f", "תשע חמש"), ("24:00", "f", None), ("9:30", "f", None), ("ב-27", "f", "בעשרים ושבע"), ("לכ-5", "f", None), ("", "f", None),
]


@pytest.mark.parametrize("token, gender, expected", TOKENS)
def test_token(token, gender, expected):
    assert spoken.spoken(token, gender) == expected


def test_units_phone_date():
    assert spoken.quantity("2.5kg") == "שניים וחצי קילוגרם"
    assert spoken.quantity("2kg") == "שני קילוגרם"
    assert spoken.quantity("+5km") == "+5 קילומטר"
    assert spoken.quantity("5gb") is None and spoken.quantity("5mb") is None
    assert spoken.phone("050-1234567") == "אפס חמש אפס אחת שתיים שלוש ארבע חמש שש שבע"
    assert spoken.date("1/2") == "הראשון לשני"
    assert spoken.date("32/01") is None
    assert rewrite.for_speech("32/01", rewrite.EXPANDED) == "שלושים ושתיים אחת"


def test_marks_and_dashes():
    assert rewrite.for_speech("...") == ".." and rewrite.for_speech("א ...") == "א.."
    assert [rewrite.split_dashes(x) for x in ("א-ב-ג", "1-2-a", "a-1-2")] == ["א ב-ג", "1-2-a", "a 1-2"]


def test_corrected_numbers():
    assert spoken.integer(102, "mn", compat=False) == "מאה ושני"
    assert spoken.integer(1002, "fn", compat=False) == "אלף ושתי"


def test_replacements():
    table = {"אבג": "דהו", "יז": "כל"}
    assert rewrite.for_speech("ואבג, יז", rewrite.EXPANDED, table) == "ודהו, כל"
    assert rewrite.for_speech("אבג", rewrite.CAUTIOUS, table) == "אבג"
    assert rewrite.for_transcript('"יז."', replacements=table) == "כל ."


def test_playground():
    assert rewrite.playground("  '3 ילדות'  ") == ("3 ילדות", "שלוש ילדות")
    assert rewrite.playground("") == ("", "")
