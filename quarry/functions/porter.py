"""Porter (1980) suffix stripping, in the "extended" mode of the common Python
implementation the ranking semantics were defined with.

Departures from the 1980 paper that this mode makes (and that the golden
report shows, e.g. ``news`` stays ``news`` and two-letter words are kept):

* a short table of irregular whole words;
* words of one or two letters are returned unchanged;
* ``ies``/``ied`` on four-letter words become ``ie``; other ``ied`` -> ``i``;
* ``y`` -> ``i`` only after a consonant that is not the first letter;
* step 2 runs ``alli`` -> ``al`` first and re-runs itself, uses ``bli`` ->
  ``ble``, and adds ``fulli`` -> ``ful`` and ``logi`` -> ``log``;
* a two-letter stem vowel+consonant counts as "cvc".

This is a per-word helper. It is applied to the *distinct* words of each
Arrow batch (see ``quarry.functions.stem``), never row by row.
"""

from __future__ import annotations

_VOWELS = frozenset("aeiou")

# Irregular forms of the extended mode, word -> stem.
IRREGULAR_FORMS = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}

# Suffix rules (suffix, replacement) of steps 2, 3 and 4, in the
# order they are tried. The first suffix that matches decides; if its
# condition fails the word is left as it is.
STEP2_RULES = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
)
STEP3_RULES = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP4_SUFFIXES = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def cv_pattern(word: str) -> str:
    """'c'/'v' per letter; ``y`` is a vowel exactly when it follows a consonant."""
    out: list[str] = []
    for ch in word:
        if ch in _VOWELS:
            out.append("v")
        elif ch == "y":
            out.append("v" if out and out[-1] == "c" else "c")
        else:
            out.append("c")
    return "".join(out)


def measure(stem: str) -> int:
    """Porter's m: the number of vowel->consonant transitions."""
    return cv_pattern(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in cv_pattern(stem)


def _double_consonant(word: str) -> bool:
    return len(word) >= 2 and word[-1] == word[-2] and cv_pattern(word)[-1] == "c"


def _cvc(word: str) -> bool:
    pat = cv_pattern(word)
    if len(word) >= 3:
        return pat[-3:] == "cvc" and word[-1] not in "wxy"
    return len(word) == 2 and pat == "vc"


def _step1a(w: str) -> str:
    if len(w) == 4 and w.endswith("ies"):
        return w[:-3] + "ie"
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith("ies"):
        return w[:-2]
    if w.endswith("ss"):
        return w
    if w.endswith("s"):
        return w[:-1]
    return w


def _step1b(w: str) -> str:
    if w.endswith("ied"):
        return w[:-3] + ("ie" if len(w) == 4 else "i")
    if w.endswith("eed"):
        return w[:-1] if measure(w[:-3]) > 0 else w
    if w.endswith("ed") and _has_vowel(w[:-2]):
        s = w[:-2]
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        s = w[:-3]
    else:
        return w
    if s.endswith(("at", "bl", "iz")):
        return s + "e"
    if _double_consonant(s):
        return s if s[-1] in "lsz" else s[:-1]
    if measure(s) == 1 and _cvc(s):
        return s + "e"
    return s


def _step1c(w: str) -> str:
    if w.endswith("y"):
        s = w[:-1]
        if len(s) > 1 and cv_pattern(s)[-1] == "c":
            return s + "i"
    return w


def _step2(w: str) -> str:
    if w.endswith("alli") and measure(w[:-4]) > 0:
        return _step2(w[:-4] + "al")
    for suffix, repl in STEP2_RULES:
        if w.endswith(suffix):
            # 'logi' keeps its 'l' with the stem when measuring
            stem = w[: -len(suffix)]
            probe = w[:-3] if suffix == "logi" else stem
            return stem + repl if measure(probe) > 0 else w
    return w


def _step3(w: str) -> str:
    for suffix, repl in STEP3_RULES:
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            return stem + repl if measure(stem) > 0 else w
    return w


def _step4(w: str) -> str:
    for suffix in STEP4_SUFFIXES:
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            ok = measure(stem) > 1
            if suffix == "ion":
                ok = ok and stem[-1:] in ("s", "t")
            return stem if ok else w
    return w


def _step5(w: str) -> str:
    if w.endswith("e"):
        s = w[:-1]
        m = measure(s)
        if m > 1 or (m == 1 and not _cvc(s)):
            w = s
    if w.endswith("ll") and measure(w[:-1]) > 1:
        w = w[:-1]
    return w


def stem(word: str) -> str:
    """Stem one lower-cased word."""
    w = word.lower()
    if w in IRREGULAR_FORMS:
        return IRREGULAR_FORMS[w]
    if len(w) <= 2:
        return w
    for step in (_step1a, _step1b, _step1c, _step2, _step3, _step4, _step5):
        w = step(w)
    return w
