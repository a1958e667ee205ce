"""Text expressions. Column in, Column out; no Python runs per row."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqspark.fixed import EMAIL_SHAPE

#: Unicode white space plus the four ASCII separator controls.
SPACES = r"[\s\x1c-\x1f]"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def strip(c: Column) -> Column:
    """Remove white space (Unicode) at both ends."""
    return F.regexp_replace(c, f"(?U)^{SPACES}+|{SPACES}+$", "")


def collapse_spaces(c: Column) -> Column:
    """Remove outer white space and turn every inner run into one blank."""
    return F.trim(F.regexp_replace(c, f"(?U){SPACES}+", " "))


def title_case(c: Column) -> Column:
    """Upper-case the first letter after anything that is not a cased letter."""
    runs = F.regexp_extract_all(c, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    words = F.transform(
        runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.lower(F.substr(run, F.lit(2))))
    )
    return F.array_join(words, "")


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition without combining marks.

    Derived by rule from the Unicode database (every plane that decomposes):
    characters that become one other character, characters that vanish, and
    those that become several. Hangul follows from arithmetic instead.
    """
    single, gone, several = {}, [], {}
    for code in range(0x80, 0x30000):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        plain = "".join(p for p in unicodedata.normalize("NFKD", char) if not unicodedata.combining(p))
        if plain == char:
            continue
        if not plain:
            gone.append(char)
        elif len(plain) == 1:
            single[char] = plain
        else:
            several[char] = plain
    return "".join(single) + "".join(gone), "".join(single.values()), several


def _char_class(codes) -> str:
    """Regular-expression class of the given code points, as ranges."""
    codes = sorted(codes)
    parts, start = [], codes[0]
    for here, following in zip(codes, codes[1:] + [None]):
        if following != here + 1:
            parts.append(f"\\x{{{start:X}}}-\\x{{{here:X}}}")
            start = following
    return "[" + "".join(parts) + "]"


@lru_cache(maxsize=1)
def _several_classes() -> tuple[str, str]:
    """A wide, cheap class that Latin text does not meet, and the exact one."""
    codes = {ord(c) for c in _accent_tables()[2]} | set(range(0xAC00, 0xD7A4))
    low = {c for c in codes if c < 0x100}
    lowest = min(codes - low)
    return _char_class(low)[:-1] + f"\\x{{{lowest:X}}}-\\x{{10FFFF}}]", _char_class(codes)


def _letters(first: int, count: int) -> Column:
    return F.split(F.lit(",".join(chr(first + i) for i in range(count))), ",")


def _expand_char(char: Column) -> Column:
    several = _accent_tables()[2]
    # One literal, folded to a map when the plan is optimised.
    entries = "\x01".join(f"{k}\x02{v}" for k, v in several.items())
    table = F.str_to_map(F.lit(entries), F.lit("\x01"), F.lit("\x02"))
    # A Hangul syllable is lead, vowel and optional tail by arithmetic on its code.
    index = F.ascii(char) - F.lit(0xAC00)
    syllable = F.concat(
        F.get(_letters(0x1100, 19), F.floor(index / 588).cast("int")),
        F.get(_letters(0x1161, 21), F.floor((index % 588) / 28).cast("int")),
        F.when(index % 28 > 0, F.get(_letters(0x11A8, 27), index % 28 - 1)).otherwise(""),
    )
    return F.coalesce(F.when(char.between("가", "힣"), syllable), F.try_element_at(table, char), char)


def strip_accents(c: Column) -> Column:
    """Compatibility-decompose and drop combining marks.

    ``translate`` handles most text in one pass; only strings that hold a
    ligature, fraction, Hangul syllable or the like are expanded before,
    character by character.
    """
    source, target, _ = _accent_tables()
    wide, exact = _several_classes()
    expanded = F.array_join(F.transform(F.split(c, ""), _expand_char), "")
    plain = F.translate(F.when(c.rlike(wide) & c.rlike(exact), expanded).otherwise(c), source, target)
    return F.when(c.rlike(r"[^\x00-\x7F]"), plain).otherwise(c)


def norm_key(c: Column) -> Column:
    """Comparison key: no accents, no outer white space, lower case."""
    return F.lower(strip(strip_accents(c)))


def clean_email(c: Column) -> Column:
    """Lower case with every white space removed."""
    return F.lower(F.regexp_replace(c, f"(?U){SPACES}+", ""))


def is_email(c: Column) -> Column:
    """True for ``user@domain.tld`` shapes; missing is False."""
    return F.coalesce(c.rlike("(?U)" + EMAIL_SHAPE), F.lit(False))


def sorted_tokens(c: Column) -> Column:
    """White-space tokens in alphabetical order, joined by one blank."""
    return F.array_join(F.array_sort(F.split(collapse_spaces(c), " ")), " ")
