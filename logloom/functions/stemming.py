"""Stemming of word lists after Porter (1980), with the usual later additions, as column expressions.

A word is read as runs of consonants and vowels; the number of vowel-consonant
runs of a stem, on which most rules depend, becomes a prefix of a pattern. Each
step is a list of rules ``(suffix, guard, pattern, replacement)``: the first rule
whose suffix and guard (if any) fit decides, and its pattern replaces or leaves
the word.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffix tables of steps 2, 3 and 4.
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
# Words with a stem of their own.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning", "inning": "inning",
    "outings": "outing", "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}
STEP4 = (
    "al ance ence er ic able ible ant ement ment ent sion tion ou ism ate iti ous ive ize"
).split()


# y is a vowel after a consonant, elsewhere a consonant; runs can be read in one way only
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
_HAS_VOWEL = f"(?:{_C}{_V}|[aeiou]+)"
_ONCE = f"{_HAS_VOWEL}{_C}"  # at least one vowel-consonant run
_TWICE = f"{_ONCE}{_V}{_C}"
_ENDS_IN_C = f"(?:{_C}|{_ONCE}(?:{_V}{_C})*)"
# one run, short: consonant, vowel, consonant other than w, x, y; or vowel and consonant alone
_SHORT = f"(?:{_C}[aeiouy][^aeiouwxy]|[aeiou][^aeiou])"
_DOUBLE = "|".join(c + c for c in "bcdfghjkmnpqrtvwx0123456789")

Rule = tuple[str, str, str, str]


def _suffixes(table: dict[str, str], stem: str) -> list[Rule]:
    return [(s, "", f"^({stem}.*){s}$", f"$1{table[s]}") for s in sorted(table, key=len, reverse=True)]


# a bar marks a word that lost -ed or -ing
STEPS: list[list[Rule]] = [
    # 1a plurals
    [("ies", "^.ies$", "s$", ""), ("ies", "", "es$", ""), ("sses", "", "es$", ""), ("ss", "", "^$", ""), ("s", "", "s$", "")],
    # 1b past and progressive
    [
        ("ied", "^.ied$", "d$", ""), ("ied", "", "ed$", ""), ("eed", "", f"^({_ONCE}.*)eed$", "$1ee"),
        ("ed", "", f"^({_HAS_VOWEL}.*)ed$", "$1|"), ("ing", "", f"^({_HAS_VOWEL}.*)ing$", "$1|"),
    ],
    [
        *[(f"{s}|", "", "\\|$", "e") for s in ("at", "bl", "iz")], ("|", f"(?:{_DOUBLE})\\|$", ".\\|$", ""),
        ("yy|", f"^{_ENDS_IN_C}yy\\|$", ".\\|$", ""), ("|", f"^{_SHORT}\\|$", "\\|$", "e"), ("|", "", "\\|$", ""),
    ],
    # 1c final y
    [("y", "..y$", f"^({_ENDS_IN_C})y$", "$1i")],
    # 2: -alli is cut first and the rest looked at again; -logi keeps its l when measured
    [("alli", "", f"^({_ONCE}.*)alli$", "$1al")],
    [("logi", "", f"^({_ONCE}.*|{_HAS_VOWEL}l)ogi$", "$1og"), *_suffixes(STEP2, _ONCE)],
    # 3
    _suffixes(STEP3, _ONCE),
    # 4: -ion needs s or t before it
    [(s, "", f"^({_TWICE}.*)ion$", "$1") for s in ("sion", "tion")]
    + _suffixes({s: "" for s in STEP4 if s not in ("sion", "tion")}, _TWICE),
    # 5 final e and double l
    [("e", f"^{_TWICE}.*e$", "e$", ""), ("e", f"^{_SHORT}e$", "^$", ""), ("e", "", f"^({_ONCE}.*)e$", "$1")],
    [("ll", "", f"^({_TWICE}.*)l$", "$1")],
]


def _step(rules: list[Rule]):
    last: dict[str, list[Rule]] = {}
    for rule in rules:
        last.setdefault(rule[0][-1], []).append(rule)

    def decided(word: Column, among: list[Rule]) -> Column:
        chosen = F.when(F.lit(False), word)
        for suffix, guard, pattern, replacement in among:
            fits = F.endswith(word, F.lit(suffix))
            chosen = chosen.when(fits & word.rlike(guard) if guard else fits, F.regexp_replace(word, pattern, replacement))
        return chosen.otherwise(word)

    def applied(word: Column) -> Column:
        # rules of other last letters cannot fit
        chosen = F.when(F.lit(False), word)
        for letter, among in last.items():
            chosen = chosen.when(F.endswith(word, F.lit(letter)), decided(word, among))
        return chosen.otherwise(word)

    return applied


def stem_words(words: Column) -> Column:
    """Words longer than three letters are stemmed."""
    stems = words
    for rules in STEPS:
        stems = F.transform(stems, _step(rules))
    fixed = F.create_map(*[F.lit(x) for pair in IRREGULAR.items() for x in pair])
    return F.zip_with(words, stems, lambda w, s: F.when(F.length(w) <= 3, w).otherwise(F.coalesce(F.try_element_at(fixed, w), s)))
