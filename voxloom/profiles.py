"""What the text scores know of a language."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    """Letters, digits and words of a language, and the replacements that unify its spelling."""

    letters: str
    digits: str
    variants: str
    replace_from: str
    replace_to: str
    common: tuple[str, ...]
    verbs: tuple[str, ...]
    vowels: str
    consonants: str
    first: str  # character class of a proper first letter
    pauses: str


# Fixed values.
PERSIAN = Profile(
    letters="آابپتثجچحخدذرزژسشصضطظعغفقکگلمنوهی",
    digits="۰۱۲۳۴۵۶۷۸۹",
    variants="أإئؤةك",
    replace_from="كيأإةؤئ",
    replace_to="کیااهوی",
    common=("که", "در", "از", "به", "با", "این", "آن", "را", "و", "است", "یک", "تا", "کرد", "کند", "شد", "شده", "می‌شود", "خواهد", "باید", "دارد", "داشت", "بود", "بوده", "هست", "نیست", "برای", "روی", "زیر", "بین", "کنار"),
    verbs=("است", "بود", "شد", "می‌", "خواهد"),
    vowels="اآوی",
    consonants="بپتدکگ",
    first="؀-ۿ",
    pauses="،؛",
)

LATIN = Profile(
    letters="abcdefghijklmnopqrstuvwxyz",
    digits="0123456789",
    variants="",
    replace_from="",
    replace_to="",
    common=("the", "of", "and", "to", "in", "a", "is", "was", "for", "that"),
    verbs=(" is ", " was ", " are ", " has "),
    vowels="aeiou",
    consonants="bdkptg",
    first="A-Za-z",
    pauses=",;",
)
