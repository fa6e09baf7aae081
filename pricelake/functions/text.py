"""Text columns: prices, labels, accents, search tokens. All Column -> Column."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters trimmed at the ends of a label: the Unicode blanks.
BLANK_CODES = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]
STRIPPED_BLANKS = "".join(map(chr, BLANK_CODES))

# Fixed values of Unicode: Hangul syllables, and (first, number, last one that is left out) of their three kinds of parts.
HANGUL, HANGUL_END = 0xAC00, 0xD7A4
JAMO = ((0x1100, 19, 0), (0x1161, 21, 0), (0x11A7, 28, 0x11A7))

#: No letter up to here becomes several ones.
NEAR = 0x0902
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str, dict[str, str]]:
    """Built from the Unicode data: `translate` arguments (letter -> bare letter, lone marks dropped), and letters that become several.

    Hangul syllables, which follow a rule, are not among the latter.
    """
    letters, bare, marks, longer = [], [], [], {}
    for code in [*range(0x80, HANGUL), *range(HANGUL_END, 0x110000)]:
        char = chr(code)
        kept = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")
        if not kept:
            marks.append(char)
        elif len(kept) > 1:
            longer[char] = kept
        elif kept != char:
            letters.append(char)
            bare.append(kept)
    return "".join(letters + marks), "".join(bare), longer


def strip_accents(c: Column | str) -> Column:
    """NFD without marks, for every script, natively."""
    return _bare(_col(c), _col(c))


def _bare(source: Column, text: Column) -> Column:
    """`text`, made from `source`, without accents; a plain ASCII source has nothing to replace."""
    ascii_only = F.octet_length(source) == F.length(source)
    accented, bare, longer = _accent_table()
    # Most accented texts hold no character beyond the first scripts: there a short table does, and no letter becomes several.
    near = ~F.rlike(text, F.lit(f"[^\\x00-{chr(NEAR)}]"))
    few = [c for c in accented if ord(c) <= NEAR]
    few, bare_few = "".join(few), "".join(bare[i] for i, c in enumerate(accented[: len(bare)]) if ord(c) <= NEAR)
    several = F.rlike(text, F.lit(f"[{chr(HANGUL)}-{chr(HANGUL_END - 1)}{''.join(longer)}]"))
    names = F.create_map(*[F.lit(x) for pair in longer.items() for x in pair])

    def spell(char: Column) -> Column:
        n = F.ascii(char) - HANGUL
        jamo = [F.array(*[F.lit(chr(first + i) if first + i > skip else "") for i in range(k)]) for first, k, skip in JAMO]
        syllable = F.concat(F.get(jamo[0], F.floor(n / 588).cast("int")), F.get(jamo[1], F.floor(n % 588 / 28).cast("int")), F.get(jamo[2], n % 28))
        return F.when((n >= 0) & (n < HANGUL_END - HANGUL), syllable).otherwise(F.coalesce(F.try_element_at(names, char), char))

    spelt = F.when(several, F.array_join(F.transform(F.split(text, ""), spell), "")).otherwise(text)
    return F.when(ascii_only, text).when(near, F.translate(text, few, bare_few)).otherwise(F.translate(spelt, accented, bare))


@F.pandas_udf(T.StringType())
def strip_accents_exact(s: pd.Series) -> pd.Series:
    """Drop accents of any script (NFD without marks), in Arrow batches."""
    decomposed = s.str.normalize("NFD")
    return decomposed.map(
        lambda t: "".join(c for c in t if unicodedata.category(c) != "Mn"), na_action="ignore"
    )


def standardize(c: Column | str, collapse: bool = False) -> Column:
    """Lower-case, trim and strip accents; `collapse` also turns runs of spaces into one."""
    c = _col(c)
    if collapse:
        return _bare(c, F.trim(F.lower(F.regexp_replace(c, " +", " "))))
    return _bare(c, F.trim(F.lower(c), F.lit(STRIPPED_BLANKS)))


def parse_price(c: Column | str, inner_spaces: bool = False) -> Column:
    """ "1,58 €" -> 1.58; what is not a number becomes null.

    Blanks at the ends (non-breaking ones too) never matter. `inner_spaces` also allows "1 234,5 €".
    """
    text = F.replace(F.replace(_col(c), F.lit("€"), F.lit("")), F.lit(","), F.lit("."))
    if inner_spaces:
        text = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\u00a0"), F.lit(""))
    text = F.trim(text, F.lit(STRIPPED_BLANKS))
    # The cast alone would also read "1d", "NaN" and hexadecimal.
    return F.regexp_extract(text, NUMBER, 0).try_cast("double")


def parse_unit(c: Column | str) -> Column:
    """ "1,89 €/kg" -> "kg" (null without a unit)."""
    return F.nullif(F.regexp_extract(_col(c), r"(?iU)€/(\w+)", 1), F.lit(""))


def parse_unit_amount(c: Column | str) -> Column:
    """ "1,89 €/kg" -> 1.89"""
    return parse_price(F.regexp_replace(_col(c), r"(?U)€/\w+", ""), inner_spaces=True)


def tokens(c: Column | str) -> Column:
    """Distinct search tokens of a text: accent- and case-free runs of letters and digits."""
    c = _col(c)
    words = F.split(_bare(c, F.lower(c)), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.array_remove(words, ""))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
