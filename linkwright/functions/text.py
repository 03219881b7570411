"""Normalization as column expressions: everything here stays in generated JVM code, but for scripts
beyond Latin, which an Arrow UDF spells out for the rows that need it."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import fixed

ID_BASE = 10**12


def _latin() -> tuple[str, str, dict[str, str]]:
    """Latin letters with marks and what they lose them to, by decomposition; and those of two letters."""
    one_from, one_to, two = "", "", {"ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "Th", "þ": "th"}
    single = {"Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Ł": "L", "ł": "l", "ı": "i"}
    for c in map(chr, range(0xC0, 0x250)):
        base = single.get(c) or "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if c not in two and len(base) == 1 and base.isascii():
            one_from, one_to = one_from + c, one_to + base
    return one_from, one_to, two


LATIN_FROM, LATIN_TO, LATIN_TWO = _latin()


#: The usual romanisation of Greek and Cyrillic letters, in alphabetical order.
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a v g d e z i th i k l m n x o p r s s t y f ch ps o".split()))
CYRILLIC = dict(zip("абвгдежзийклмнопрстуфхцчшщъыьэюяєіїґ", "a b v g d e zh z i y k l m n o p r s t u f kh ts ch sh shch _ y _ e yu ya ye i yi g".split()))
LETTERS = {a: b.replace("_", "") for a, b in (GREEK | CYRILLIC).items()}

_INDIC = re.compile(r"^(?:DEVANAGARI|BENGALI|GURMUKHI|GUJARATI|ORIYA|TAMIL|TELUGU|KANNADA|MALAYALAM) (LETTER|VOWEL SIGN|SIGN) (.+)$")
_NAMED = re.compile(r"(?:LETTER|SYLLABLE|DIGIT) (?:SMALL |CAPITAL )?([A-Z]+)")


def _indic(kind: str, name: str) -> tuple[str, bool]:
    """(spelling, whether an inherent a may follow) of an Indic character by the parts of its Unicode name."""
    if kind == "SIGN":
        return {"ANUSVARA": "n", "CANDRABINDU": "n", "VISARGA": "h"}.get(name, ""), False
    word = name.split(" ")[-1].lower()
    if kind == "LETTER" and len(word) > 1 and word.endswith("a") and not word.startswith(("a", "i", "u", "e", "o")):
        return word[:-1], True
    return word.replace("aa", "a").replace("ii", "i").replace("uu", "u"), False


def spell(text: str) -> str:
    """ASCII spelling of any script. Marks go. Greek and Cyrillic letters by table; Indic ones by their names,
    a consonant with its a unless a vowel sign, a virama or the word's end follows; digits as digits;
    all other letters by the last word of their names."""
    out = []
    open_ = False  # whether a consonant waits for its vowel
    for c in unicodedata.normalize("NFKD", text.replace("й", "\0").replace("Й", "\0").replace("ї", "\1").replace("Ї", "\1")):
        low = {"\0": "й", "\1": "ї"}.get(c, c.lower())
        name = "" if low.isascii() else unicodedata.name(c, "")
        found = _INDIC.match(name)
        sound, waits = _indic(*found.groups()) if found and not c.isdigit() else ("", False)
        if open_ and (found and found[1] == "LETTER" or "ANUSVARA" in name or "CANDRABINDU" in name):
            out.append("a")
        open_ = waits or (open_ and "NUKTA" in name)
        if low.isascii():
            out.append(c)
        elif low in LETTERS:
            out.append(LETTERS[low])
        elif c.isdigit():
            out.append(str(unicodedata.digit(c, "")))
        elif found:
            out.append(sound)
        elif not unicodedata.combining(c):
            named = _NAMED.search(name)
            out.append(named[1].lower() if named else " " if c.isspace() else "")
    return "".join(out)


@F.pandas_udf(StringType())
def _spell(texts: pd.Series) -> pd.Series:
    return texts.map(spell, na_action="ignore")


def latin(c: Column) -> Column:
    """Latin letters without marks."""
    c = F.translate(c, LATIN_FROM, LATIN_TO)
    for a, b in LATIN_TWO.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def transliterate(c: Column, any_script: bool = False) -> Column:
    """ASCII spelling. any_script also spells what is left over after Latin; a UDF reads every row it is
    planned on, so ask for it only where such rows are to be expected."""
    c = latin(c)
    return F.when(c.rlike(r"^[\x00-\x7F]*$"), c).otherwise(_spell(c)) if any_script else c


def clean(c: Column, pattern: str, to: str = " ") -> Column:
    return F.regexp_replace(c, pattern, to)


def squeeze(c: Column) -> Column:
    return F.trim(clean(c, "[ \t\n\f\r]+"))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def lookup(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))


def canonical(c: Column, table: dict[str, str]) -> Column:
    """Each token by the table; an entry may become two tokens."""
    return squeeze(F.array_join(F.transform(F.split(c, " "), lambda t: F.coalesce(F.try_element_at(lookup(table), t), t)), " "))


def without(c: Column, words) -> Column:
    """The distinct tokens, in order, that are not among the words."""
    return F.array_join(F.array_distinct(F.filter(tokens(c), lambda t: ~t.isin(*words))), " ")


@dataclass(frozen=True)
class Rules:
    """A version of the tables: name variants, words the core drops, address variants."""

    names: tuple
    drop: tuple
    addresses: tuple


RULES = {
    "n1": Rules(tuple(fixed.LEGAL.items()), (*fixed.LEGAL_WORDS, *fixed.NOISE_WORDS), tuple(fixed.ADDRESS.items())),
    "n2": Rules(tuple((fixed.LEGAL | fixed.LEGAL_2 | fixed.NAME_2).items()), (*fixed.LEGAL_WORDS, *fixed.NOISE_WORDS, *fixed.COUNTRY_WORDS_2), tuple((fixed.ADDRESS | fixed.ADDRESS_2).items())),
}


def script(name: Column) -> Column:
    """0: ASCII only, 1: with Latin letters up to U+024F, 2: anything else."""
    return F.when(name.rlike("^[\\x00-\\x7F]*$"), 0).when(name.rlike("^[\\x00-\\x7FÀ-ɏ]*$"), 1).otherwise(2)


#: What a skeleton loses: vowels and y but at the front, and every h.
_MUTE = "(?<!^)[aeiouyh]|^h"
#: A letter that its next one repeats, and an m that a consonant follows.
_REPEATED, _NASAL = f"([{fixed.RUNS}])(?=\\1)", "m(?=[^aeiouym])"
_SOUNDS_FROM, _SOUNDS_TO = ("".join(x) for x in zip(*((c, to) for letters, to in fixed.SOUNDS for c in letters)))


def skeleton(word: Column) -> Column:
    """Phonetic skeleton: the sounds of a word's consonants, each run of one told once, and its first
    letter; an h only matters where it makes a p an f."""
    heard = F.regexp_replace(F.replace(word, F.lit("ph"), F.lit("f")), _MUTE, "")
    heard = F.replace(F.translate(heard, _SOUNDS_FROM, _SOUNDS_TO), F.lit("x"), F.lit("ks"))
    return F.regexp_replace(F.regexp_replace(heard, _NASAL, "n"), _REPEATED, "")


def skeleton_of(word: str) -> str:
    """The same for a single word, to make stop lists with."""
    heard = re.sub(_MUTE, "", word.replace("ph", "f")).translate(str.maketrans(_SOUNDS_FROM, _SOUNDS_TO, "")).replace("x", "ks")
    return re.sub(_REPEATED, "", re.sub(_NASAL, "n", heard))


PHONETIC_STOP = tuple(sorted({skeleton_of(w) for x in (*fixed.LEGAL_WORDS, *fixed.NOISE_WORDS, *fixed.PHONETIC_EXTRA) for w in x.split(" ")}))
PHONETIC_LEGAL = tuple(sorted({skeleton_of(x) for x in (*fixed.LEGAL_WORDS, *fixed.PHONETIC_EXTRA)}))


def skeletons(text: Column) -> Column:
    return F.array_join(F.transform(tokens(text), skeleton), " ")


def encode_id(c: Column) -> Column:
    """S<k>-<n> to k * 10^12 + n; null if it has another form."""
    good = F.when(c.rlike(r"^S[123]-\d{1,12}$"), c)
    return F.substring(good, 2, 1).cast("long") * ID_BASE + F.substring(good, 4, 12).cast("long")


def decode_id(c: Column) -> Column:
    return F.concat(F.lit("S"), ((c - c % ID_BASE) / ID_BASE).cast("long").cast("string"), F.lit("-"), (c % ID_BASE).cast("string"))


def stable_rank(c: Column, seed: int) -> Column:
    """A rank that any engine reproduces: the first 12 hex digits of md5 of seed:value."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), c.cast("string")).cast("binary")), 1, 12)


def fold(c: Column) -> Column:
    """The older folding: marks off, lower case, & as a word, punctuation as space."""
    c = F.replace(F.replace(F.lower(latin(F.coalesce(c, F.lit("")))), F.lit("&"), F.lit(" and ")), F.lit("'"), F.lit(""))
    return squeeze(clean(c, r"[^\p{L}\p{M}\p{N}_ \t\n\f\r]"))


def joined(a: Column) -> Column:
    return F.array_join(a, " ")
