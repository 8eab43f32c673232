"""Strings as Column expressions, with Python's meaning of white space, lines and letters."""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of str.isspace, as a regex class.
WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The same without the plain space; the class is tried only on characters that are not printed ASCII.
WS_BUT_SPACE = r"(?=[^ -~])[\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Its characters, one by one.
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Letters whose Unicode name has LATIN, as ranges.
ROMAN_RANGES = (
    "41-5A 61-7A C0-D6 D8-F6 F8-2AF 1D00-1D25 1D62-1D65 1D6B-1D77 1D79-1D9A 1E00-1EFF 2071 207F 2090-209C 2184 2C2E 2C5E "
    "2C60-2C7C 2C7E-2C7F A722-A76F A771-A787 A78B-A7CA A7D0-A7D1 A7D3 A7D5-A7D9 A7F5-A7F7 A7FA-A7FF AB30-AB5A AB60-AB64 "
    "AB66-AB68 FB00-FB06 FF21-FF3A FF41-FF5A 1DF00-1DF1E 1DF25-1DF2A"
)
# Where letters were added to Unicode after the version that Java 17 knows.
NEWER = (
    "870-8C9 C5D CDD 170D-171F 1B4C 2C2F-2C5F 9FFD-9FFF A7F2-A7F4 10570-105BC 10780-107BA 10F70-10F81 11071-11075 1123F-11240 "
    "11740-11746 11AB0-11ABF 11F02-11F33 12F90-12FF0 1342F-13446 16A70-16ABE 1AFF0-1AFFE 1B11F-1B155 1E030-1E06D 1E290-1E2AD "
    "1E4D0-1E4EB 1E7E0-1E7FE 2A6DE-2A6DF 2B735-2B739 2EBF0-2EE5D 31350-323AF"
)


def _class(ranges: str) -> str:
    return "".join("-".join(rf"\x{{{x}}}" for x in r.split("-")) for r in ranges.split())


def newer_letters() -> str:
    """Ranges of the letters in NEWER that are not Roman, by Python's tables."""
    out: list[list[int]] = []
    for r in NEWER.split():
        low, _, high = r.partition("-")
        for c in range(int(low, 16), int(high or low, 16) + 1):
            if chr(c).isalpha() and "LATIN" not in unicodedata.name(chr(c), ""):
                if out and out[-1][1] == c - 1:
                    out[-1][1] = c
                else:
                    out.append([c, c])
    return " ".join(f"{a:X}-{b:X}" for a, b in out)


ROMAN_CLASS, NEWER_CLASS = _class(ROMAN_RANGES), _class(newer_letters())


def normalize_ws(c: Column) -> Column:
    """Words joined by single spaces.  The patterns skip single plain spaces, which most of a text's white space is."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, WS_BUT_SPACE, " "), " {2,}", " "))


def strip(c: Column) -> Column:
    """The text without white space at its ends; what is between them is not searched."""
    return F.btrim(c, F.lit(WS_CHARS))


def token_count(c: Column) -> Column:
    """Number of white-space separated words."""
    return word_count(normalize_ws(c))


def word_count(normal: Column) -> Column:
    """Number of words of a text that is normalised already."""
    return F.size(F.array_remove(F.split(normal, " "), ""))


def more_words(c: Column, n: int) -> Column:
    """Whether a text has more than ``n`` words; it is read no further than that."""
    word = WS.replace("[", "[^", 1)
    return c.rlike(f"^{WS}*+(?:{word}++{WS}++){{{n}}}{word}")


def split_lines(c: Column) -> Column:
    """Lines with their terminators; an empty text has none."""
    parts = F.split(c, "(?<=\r\n)|(?<=[\n\x0b\f\x1c-\x1e\x85\u2028\u2029])|(?<=\r)(?!\n)")
    return F.filter(parts, lambda x: x != "")


def is_roman(c: Column) -> Column:
    """Every letter is a Roman one; other characters do not count and null stays null.

    The long classes are tried only on characters outside two ranges without any other letter, which most of a text is in.
    """
    return ~c.rlike(rf"(?=[^\x00-\xa9\xc0-\x{{2af}}])(?:[\p{{L}}&&[^{ROMAN_CLASS}]]|[{NEWER_CLASS}])")


def clean_label(c: Column) -> Column:
    return F.replace(c, F.lit("__label__"), F.lit(""))


def last_segment(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def strip_prefix_int(c: Column, prefix: str) -> Column:
    """The number behind a prefix, null where there is none."""
    return F.when(c.startswith(prefix), F.replace(c, F.lit(prefix), F.lit("")).try_cast("int"))


def contains_any(c: Column, phrases: list[str]) -> Column:
    """Case-insensitive search for any of some literal phrases."""
    import re

    return c.rlike("(?iu)" + "|".join(re.escape(p).replace(r"\ ", " ") for p in phrases)) if phrases else F.lit(False)


# ---- on the driver ----


def resolve_text(value: str) -> str:
    """The content of the file that ``value`` names, or ``value`` itself."""
    try:
        if os.path.isfile(value):
            with open(value, encoding="utf-8") as f:
                return f.read()
    except (OSError, ValueError):
        pass
    return value


def placeholders(template: str) -> set[str]:
    return {name for _, name, _, _ in Formatter().parse(template) if name}


def fill_languages(prompt: str, src_lang: str | None = None, tgt_lang: str | None = None) -> str:
    """Fills the language placeholders for which both sides are there; a prompt without any stays verbatim."""
    given = {k: v for k, v in {"src_lang": src_lang, "tgt_lang": tgt_lang}.items() if v and "{" + k + "}" in prompt}
    return prompt.format(**given) if given else prompt


def check_languages(prompt: str, src_lang: str | None, tgt_lang: str | None) -> None:
    for name, value in (("src_lang", src_lang), ("tgt_lang", tgt_lang)):
        if "{" + name + "}" in prompt and not value:
            raise ValueError(f"the prompt has a placeholder for {name}, which is not given")


def check_ids(prompt: str, user_id: str, assistant_id: str) -> None:
    for name, value in (("user_id", user_id), ("assistant_id", assistant_id)):
        if not value or value not in prompt:
            raise ValueError(f"{name} must not be empty and must occur in the prompt")


def fill_columns(template: str, values: Mapping[str, Column]) -> Column:
    """A template filled per row; filled-in text is not searched for placeholders again."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if name not in values:
                raise KeyError(name)
            parts.append(values[name])
    return F.concat(*parts) if parts else F.lit("")
