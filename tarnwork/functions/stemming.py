"""Porter's stemmer (1980), from the published rules."""

from __future__ import annotations

from functools import lru_cache

# The rule tables of steps 2, 3 and 4.
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _consonant(w: str, i: int) -> bool:
    if w[i] in "aeiou":
        return False
    return w[i] != "y" or i == 0 or not _consonant(w, i - 1)


def _measure(stem: str) -> int:
    kinds = [_consonant(stem, i) for i in range(len(stem))]
    return sum(1 for a, b in zip(kinds, kinds[1:]) if not a and b)


def _vowel(stem: str) -> bool:
    return any(not _consonant(stem, i) for i in range(len(stem)))


def _double(w: str) -> bool:
    return len(w) > 1 and w[-1] == w[-2] and _consonant(w, len(w) - 1)


def _cvc(w: str) -> bool:
    n = len(w)
    return n > 2 and _consonant(w, n - 3) and not _consonant(w, n - 2) and _consonant(w, n - 1) and w[-1] not in "wxy"


def _replace(w: str, rules, least: int) -> str:
    for end, new in sorted(rules, key=lambda r: -len(r[0])):
        if w.endswith(end):
            stem = w[: len(w) - len(end)]
            return stem + new if _measure(stem) > least - 1 else w
    return w


@lru_cache(maxsize=200_000)
def stem(w: str) -> str:
    if len(w) < 3 or not w.isascii():
        return w
    for end, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(end):
            w = w[: len(w) - len(end)] + new
            break
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    else:
        for end in ("ed", "ing"):
            if w.endswith(end) and _vowel(w[: -len(end)]):
                w = w[: -len(end)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif _double(w) and w[-1] not in "lsz":
                    w = w[:-1]
                elif _measure(w) == 1 and _cvc(w):
                    w += "e"
                break
    if w.endswith("y") and _vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _replace(w, STEP2, 1)
    w = _replace(w, STEP3, 1)
    for end in sorted(STEP4, key=len, reverse=True):
        if w.endswith(end):
            s = w[: len(w) - len(end)]
            if _measure(s) > 1 and (end != "ion" or s.endswith(("s", "t"))):
                w = s
            break
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w
