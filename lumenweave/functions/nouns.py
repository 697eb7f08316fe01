"""Number of English nouns by rules, for Python strings and for columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plurals that follow no rule.
IRREGULAR = {
    "person": "people", "man": "men", "woman": "women", "child": "children", "foot": "feet", "tooth": "teeth", "goose": "geese", "mouse": "mice", "ox": "oxen",
    "leaf": "leaves", "knife": "knives", "wife": "wives", "life": "lives", "shelf": "shelves", "loaf": "loaves", "calf": "calves", "half": "halves", "wolf": "wolves", "scarf": "scarves", "thief": "thieves",
    "lens": "lenses", "gas": "gases", "canvas": "canvases", "atlas": "atlases", "iris": "irises", "quiz": "quizzes",
}
# Words without a plural, and words that end like one.
NO_PLURAL = frozenset("sheep deer fish aircraft furniture luggage equipment grass water snow sand rice bread hair clothing scissors trousers pants jeans shorts glasses".split())
NO_NOUN = frozenset("does has was is this its his us yes as".split())
# Singulars in -ie and -use, and those in -o whose plural has an e.
IN_IE = frozenset("movie cookie brownie zombie calorie selfie smoothie hoodie birdie pixie rookie tie pie eerie collie".split())
IN_USE = frozenset("use fuse muse excuse cause pause clause".split())
IN_O = frozenset("potato tomato hero echo mosquito mango buffalo volcano tornado torpedo".split())

_SINGULAR = {v: k for k, v in IRREGULAR.items()}
#: Rules for words in small letters, in order: pattern, and what its group or end becomes.
_RULES = (
    (rf"^({'|'.join(sorted(IN_IE | IN_USE))})s$", "$1"),
    (r"^(.{2,})ies$", "$1y"),
    (rf"^({'|'.join(sorted(IN_O))})es$", "$1"),
    (r"^(.*(?:ss|x|zz|ch|sh))es$", "$1"),
    (r"^(.*[^oa]us)es$", "$1"),
    (r"^(.*[^sui])s$", "$1"),
)
_FOR_PYTHON = [(re.compile(p), r.replace("$1", r"\1")) for p, r in _RULES]
_HISS = re.compile(r"(?:s|x|z|ch|sh)$")


def singular_word(word: str) -> str:
    low = word.lower()
    if len(low) < 3 or low in NO_PLURAL or low in NO_NOUN or low in IRREGULAR:
        return word
    if low in _SINGULAR:
        return _SINGULAR[low]
    for pattern, into in _FOR_PYTHON:
        if pattern.match(low):
            new = pattern.sub(into, low)
            return word[: len(new)] if low.startswith(new) else word[: len(new) - 1] + new[-1]
    return word


def plural_word(word: str) -> str:
    low = word.lower()
    if low in NO_PLURAL or low in _SINGULAR or singular_word(low) != low:
        return word
    if low in IRREGULAR:
        return IRREGULAR[low]
    if low.endswith("y") and low[-2:-1] not in tuple("aeiou"):
        return word[:-1] + "ies"
    return word + ("es" if _HISS.search(low) or low in IN_O else "s")


def singular(phrase: str) -> str:
    """Every word of a phrase in the singular."""
    return " ".join(singular_word(w) for w in phrase.split(" "))


def plural(phrase: str) -> str:
    """The phrase's last word in the plural; ``a`` and ``an`` become ``some``; a capital stays."""
    words = phrase.split()
    if not words:
        return phrase
    out = ["some" if w.lower() in ("a", "an") else w for w in words]
    out[-1] = plural_word(out[-1])
    return " ".join(out)


def singular_phrase(text: Column) -> Column:
    """:func:`singular` of a column, for words in small letters; others follow the same rules by their own letters."""
    irregular = F.create_map(*[F.lit(x) for pair in _SINGULAR.items() for x in pair])

    def one(word: Column) -> Column:
        out = word
        for pattern, into in reversed(_RULES):
            out = F.when(word.rlike(pattern), F.regexp_replace(word, pattern, into)).otherwise(out)
        return F.when((F.length(word) < 3) | word.isin(*NO_PLURAL, *NO_NOUN, *IRREGULAR), word).otherwise(F.coalesce(irregular[word], out))

    return F.array_join(F.transform(F.split(text, " "), one), " ")
