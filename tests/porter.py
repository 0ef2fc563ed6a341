"""Porter's stemmer letter by letter: what the patterns of functions/stemming are tested against."""

import re
from functools import lru_cache

from logloom.functions.stemming import IRREGULAR, STEP2, STEP3, STEP4


def _shape(stem: str) -> str:
    """The word as ``c`` and ``v`` letters; ``y`` after a consonant is a vowel."""
    shape = ""
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and shape[-1] == "c")
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short_end(stem: str) -> bool:
    """consonant-vowel-consonant, the last one not w, x or y; or just vowel-consonant"""
    shape = _shape(stem)
    return (shape.endswith("cvc") and stem[-1] not in "wxy") or shape == "vc"


def _replace(word: str, table: dict[str, str], least: int) -> str:
    for suffix in sorted((s for s in table if word.endswith(s)), key=len, reverse=True)[:1]:
        stem = word[: -len(suffix)]
        if _measure(stem) >= least:
            return stem + table[suffix]
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """Porter's algorithm; words of up to two letters stay."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    # 1a plurals
    if word.endswith("ies"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("sses"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # 1b past and progressive
    ending = re.search("(eed|ed|ing)$", word)
    if word.endswith("ied"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif ending:
        base = word[: ending.start()]
        if ending.group() == "eed":
            word = base + "ee" if _measure(base) > 0 else word
        elif "v" in _shape(base):
            word = base
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short_end(word):
                word += "e"
    # 1c final y
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    # 2: -alli is cut first and the rest looked at again; -logi keeps its l when measured
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        word = word[:-2]
    if word.endswith("logi"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        word = _replace(word, STEP2, 1)
    word = _replace(word, STEP3, 1)
    # 4: -ion needs s or t before it
    for suffix in sorted((s for s in STEP4 if word.endswith(s)), key=len, reverse=True)[:1]:
        cut = 3 if suffix in ("sion", "tion") else len(suffix)
        if _measure(word[:-cut]) > 1:
            word = word[:-cut]
    # 5 final e and double l
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _short_end(base)):
            word = base
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word
