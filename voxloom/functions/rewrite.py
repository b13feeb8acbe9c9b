"""Two rewriters of Hebrew text: one for speech synthesis and an older one for transcripts.

Both take a text through character clean-up and then word by word; what a number becomes depends on
its neighbours. :func:`for_speech` looks at the word written before, :func:`for_transcript` at the
word read before. Pure functions; null handling is left to the column functions in ``columns``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import lru_cache

from . import lexicon as lx
from . import spoken


def _translator(table: Mapping[int, int | None]) -> Callable[[str], str]:
    """``str.translate`` for texts with few characters of the table, which it looks up one by one."""
    to = {chr(a): "" if b is None else chr(b) for a, b in table.items()}
    found = re.compile("[" + re.escape("".join(to)) + "]")
    return lambda text: found.sub(lambda m: to[m[0]], text)


_CLEAN_OLDER = str.maketrans(lx.BLANKS + lx.HYPHENS + lx.QUOTES + lx.APOSTROPHES, " " * len(lx.BLANKS) + "-" * len(lx.HYPHENS) + '"' * len(lx.QUOTES) + "'" * len(lx.APOSTROPHES), lx.DELETED)
_CLEAN = _CLEAN_OLDER | {ord("\\"): None}
_clean_older, _clean = _translator(_CLEAN_OLDER), _translator(_CLEAN)
_EMOJI = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in lx.EMOJI) + "]+")
_PARENTHESES, _BRACKETS = re.compile(r"\(.*?\)"), re.compile(r"\[.*?\]")
_GLUE = re.compile(r"\s+([.,?!])")
_DIGIT = re.compile(r"\d")  # numbers, times, dates, amounts and phone numbers all have one
_MARKS = sorted(lx.CLOSING_MARKS, key=len, reverse=True)


@dataclass(frozen=True)
class SpeechOptions:
    """What :func:`for_speech` does. The defaults are the cautious preset."""

    normalize_unicode: bool = True
    remove_parentheses: bool = True
    remove_brackets: bool = True
    collapse_whitespace: bool = True
    keep_punctuations: bool = True
    attach_punctuations_to_token: bool = True
    strip_parentheses: bool = True  # accepted; wrappers are always stripped from words
    apply_word_replacements: bool = False
    expand_numbers: bool = False
    expand_abbreviations: bool = True
    translate_units: bool = True
    remove_emojis: bool = True
    split_dashes_between_words: bool = True
    split_markers: tuple[str, ...] = ("/", "-")
    stt_compat_mode: bool = False  # accepted, without effect
    compat: bool = True


CAUTIOUS = SpeechOptions()
EXPANDED = replace(CAUTIOUS, apply_word_replacements=True, expand_numbers=True)
PREPARATION = replace(EXPANDED, remove_parentheses=False)
PRESETS = {"cautious": CAUTIOUS, "expanded": EXPANDED, "preparation": PREPARATION}


def split_dashes(text: str) -> str:
    """A dash between two characters becomes a blank unless both are digits; a match uses up both."""
    out, start, free, at = [], 0, 0, text.find("-", 1)
    while 0 < at < len(text) - 1:
        before, after = text[at - 1], text[at + 1]
        if at > free and not before.isspace() and not after.isspace():
            free = at + 2
            if not (before.isdigit() and after.isdigit()):
                out += [text[start:at], " "]
                start = at + 1
        at = text.find("-", at + 1)
    return "".join([*out, text[start:]]) if out else text


def clean(text: str, o: SpeechOptions) -> str:
    """The text before it is cut into words."""
    if o.normalize_unicode:
        text = _clean(text)
    for wanted, pattern in ((o.remove_emojis, _EMOJI), (o.remove_parentheses, _PARENTHESES), (o.remove_brackets, _BRACKETS)):
        if wanted:
            text = pattern.sub("", text)
    if o.split_dashes_between_words:
        text = split_dashes(text)
    return " ".join(text.split()) if o.collapse_whitespace else text


def unwrap(word: str) -> str:
    """Without quotes and brackets around it."""
    return word.lstrip(lx.OPENERS).rstrip(lx.CLOSERS)


def closing_mark(word: str) -> tuple[str, str]:
    """The word without its closing mark, the longest first, and what that becomes; a mark alone stays."""
    word = word.strip()
    for mark in _MARKS:
        if len(word) > len(mark) and word.endswith(mark):
            return word[: -len(mark)], lx.CLOSING_MARKS[mark]
    return word, ""


def _core(raw: str) -> tuple[str, str]:
    """A word as read, without what stands around it, and its mark."""
    word, mark = closing_mark(unwrap(raw))
    return unwrap(word.strip()), mark


def _plural(word: str, masculine_plurals: frozenset[str]) -> str | None:
    """``m`` or ``f`` of a plural noun after a number, by ending and exceptions, with or without "the"."""
    forms = {word, word.removeprefix(lx.THE)}
    if word.endswith(lx.PLURAL_M):
        return "f" if forms & lx.FEMININE_PLURALS else "m"
    if word.endswith(lx.PLURAL_F):
        return "m" if forms & masculine_plurals else "f"
    return None


def _bare(word: str, trailing: frozenset[str]) -> str:
    while len(word) > 1 and word[-1] in trailing:
        word = word[:-1]
    return word


def speech_gender(before: str, after: str | None) -> str:
    """Gender of a number from the word written before it and, with precedence, the noun read after it."""
    if after is not None:
        noun = _bare(after, lx.TRAILING)
        found = "m" if noun in lx.MASCULINE_NOUNS else _plural(noun, lx.MASCULINE_PLURALS)
        if found:
            return found + "n"
    if before == lx.TIMES:
        return "m"
    return "f0" if before.endswith(lx.HUNDRED) else "f"


def abbreviation(word: str, replacements: Mapping[str, str]) -> str | None:
    """The word in full, from the caller's map or the built-in one, perhaps after a one-letter word."""
    word = word.replace("״", '"').replace("׳", "'")
    for lead, rest in (("", word), (word[:1], word[1:])):
        if rest and (not lead or lead in lx.ABBREVIATION_PREFIXES):
            for table in (replacements, lx.ABBREVIATIONS):
                if rest in table:
                    return lead + table[rest]
    return None


@lru_cache(1 << 14)
def _number_words(word: str, gender: str, split_markers: tuple[str, ...], compat: bool) -> str:
    word = spoken.date(word) or spoken.phone(word) or spoken.spoken(word, gender, compat) or word
    marker = next((m for m in split_markers if m in word), None)
    if marker:
        parts = [spoken.spoken(p.strip(), "f", compat) for p in word.split(marker)]
        if all(parts):
            return " ".join(parts)
    return word


class _Words(dict):
    """What a word read becomes, kept for the next time: None for nothing, or a word and its mark if its neighbours decide."""

    MOST, LONGEST = 1 << 15, 64

    def __init__(self, options: SpeechOptions, own: Mapping[str, str]):
        self.options, self.own = options, own

    def __missing__(self, raw: str) -> str | tuple[str, str] | None:
        out = self._becomes(raw)
        if len(raw) <= self.LONGEST:
            if len(self) >= self.MOST:
                self.clear()
            self[raw] = out
        return out

    def _becomes(self, raw: str) -> str | tuple[str, str] | None:
        o, own = self.options, self.own
        if raw.isalpha():
            word, mark = raw, ""
        elif raw[:-1].isalpha() and raw[-1] in lx.CLOSING_MARKS:
            word, mark = raw[:-1], lx.CLOSING_MARKS[raw[-1]]
        else:
            word, mark = _core(raw)
        if not word:
            return None
        if not o.expand_abbreviations:
            out = own.get(word, word)
        elif own or not word.isalnum():  # the built-in abbreviations have quotes in them
            out = abbreviation(word, own) or word
        else:
            out = word
        mark = mark if o.keep_punctuations else ""
        if mark and not o.attach_punctuations_to_token:
            mark = " " + mark
        if out.isalpha() or not _DIGIT.search(out):
            return out + mark
        amount = spoken.quantity(out, o.compat) if o.translate_units else None
        if amount or not o.expand_numbers:
            return (amount or out) + mark
        return out, mark


class Speaker:
    """:func:`for_speech` for many texts with the same options and replacements, which it copies."""

    def __init__(self, options: SpeechOptions = CAUTIOUS, replacements: Mapping[str, str] | None = None):
        self.options = options
        self.words = _Words(options, dict(replacements or {}) if options.apply_word_replacements else {})

    def __call__(self, text: str) -> str:
        return self.write(clean(text, self.options))

    def write(self, text: str) -> str:
        """A text that is clean already."""
        if not text:
            return ""
        o, words = self.options, self.words
        read = text.split(" ")
        written: list[str] = []
        own, leads = words.own, lx.ABBREVIATION_PREFIXES if words.own else ()  # letters alone stay as they are, but for the caller's
        for i, raw in enumerate(read):
            if raw.isalpha() and raw not in own and raw[0] not in leads:
                written.append(raw)
                continue
            out = words[raw]
            if out is None:
                continue
            if type(out) is tuple:
                gender = speech_gender(written[-1] if written else "", read[i + 1] if i + 1 < len(read) else None)
                out = _number_words(out[0], gender, tuple(o.split_markers), o.compat) + out[1]
            written.append(out)
        result = " ".join(written)
        return (_GLUE.sub(r"\1", result) if o.keep_punctuations else result).strip()


class Comparison:
    """The cautious and the preparation form of texts; cleaned once, as they differ in parentheses only."""

    def __init__(self, replacements: Mapping[str, str] | None = None):
        self.cautious, self.expanded = Speaker(CAUTIOUS, replacements), Speaker(PREPARATION, replacements)

    def __call__(self, text: str) -> tuple[str, str]:
        ready = clean(text, CAUTIOUS)
        return self.cautious.write(ready), self.expanded.write(clean(text, PREPARATION) if "(" in text else ready)


def for_speech(text: str, options: SpeechOptions = CAUTIOUS, replacements: Mapping[str, str] | None = None) -> str:
    """The text as it would be read out."""
    return Speaker(options, replacements)(text)


def transcript_gender(before: str | None, after: str | None) -> str:
    """Gender of a number in the older rewriter: the word read before it comes first, then the noun after."""
    if before == lx.TIMES:
        return "m"
    if before is not None and before.endswith(lx.HUNDRED):
        return "f0"
    noun = _bare(after, lx.TRAILING_OLDER) if after is not None else ""
    return _plural(noun, lx.MASCULINE_PLURALS_OLDER) or "f"


@lru_cache(1 << 16)
def _peel(word: str) -> tuple[str, str]:
    """The word without marks around it, and the mark to keep: the first one dropped that stands for any."""
    while mark := next((m for m in lx.LEADING_MARKS_OLDER if word.startswith(m) and word != m), None):
        word = word[len(mark) :]
    kept = ""
    while mark := next((m for m in lx.CLOSING_MARKS_OLDER if word.endswith(m)), None):
        kept = kept or lx.CLOSING_WORDS_OLDER.get(mark, "")
        word = word[: -len(mark)]
    return word, kept


def _drop_quote(word: str) -> str:
    """Without a double quote after a preposition, unless it stands where acronyms have it."""
    at = word.find('"')
    acronym = len(word) - (4 if word.endswith((lx.PLURAL_M, lx.PLURAL_F)) else 2)
    if at > 0 and at != acronym and word[:at] + "-" in lx.PREPOSITIONS:
        return word[:at] + word[at + 1 :]
    return word


def transcript_word(word: str, keep_marks: bool, gender: str, split_markers: tuple[str, ...], replacements: Mapping[str, str], compat: bool = True) -> str:
    """One word in the older rewriter; a kept mark follows as a word of its own."""
    if word in replacements:
        return replacements[word]
    if not replacements and word.isalpha():
        return word
    word, mark = _peel(word)

    def parts(marker: str) -> str | None:
        found = [transcript_word(p, False, "f", (), {}, compat) for p in word.split(marker)]
        return " ".join(found) if all(found) else None

    out = replacements.get(word)
    if not out and _DIGIT.search(word):
        out = spoken.spoken(word, gender, compat)
    if not out:
        out = next((p for m in split_markers if m in word and (p := parts(m))), None)
    if not out:
        out = _drop_quote(word)
    return f"{out} {mark}" if keep_marks and mark else out


def for_transcript(
    text: str,
    remove_parentheses: bool = True,
    remove_brackets: bool = True,
    keep_punctuations: bool = True,
    split_markers: tuple[str, ...] = ("/", "-"),
    replacements: Mapping[str, str] | None = None,
    compat: bool = True,
) -> str:
    """The text as the older rewriter writes it. Runs of blanks collapse unless the text begins with one."""
    text = _clean_older(text)
    for wanted, pattern in ((remove_parentheses, _PARENTHESES), (remove_brackets, _BRACKETS)):
        if wanted:
            text = pattern.sub("", text)
    while text.find("  ") > 0:
        text = text.replace("  ", " ")
    read = text.split(" ")
    written = []
    for i, word in enumerate(read):
        if word:
            numeric = _DIGIT.search(word)  # only then the gender counts
            gender = transcript_gender(read[i - 1] if i else None, read[i + 1] if i + 1 < len(read) else None) if numeric else "f"
            written.append(transcript_word(word, keep_punctuations, gender, tuple(split_markers), replacements or {}, compat))
    return " ".join(w for w in written if w)


def playground(text: str, replacements: Mapping[str, str] | None = None) -> tuple[str, str]:
    """The cautious and the preparation form of a text pasted in, without one pair of equal quotes around it."""
    text = text.strip()
    if text and text[0] == text[-1] and text[0] in "\"'":
        text = text[1:-1]
    return for_speech(text, CAUTIOUS, replacements), for_speech(text, PREPARATION, replacements)
