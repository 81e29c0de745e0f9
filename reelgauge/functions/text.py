"""Title expressions: length class, words, keywords, emoji."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelgauge import fixed_values as fixed

# A word boundary spelled out, so that it does not depend on the Java release:
# letters, digits of any script and the underscore are word characters.
_W = r"[\p{L}\p{N}_]"
_EDGE = rf"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"
WORD_PATTERN = rf"{_EDGE}[{fixed.WORD_LETTERS}]{{{fixed.WORD_MIN_LENGTH},}}{_EDGE}"


def emoji_pattern(strict: bool = False) -> str:
    """Character class of emoji; ``strict`` leaves out the wide last range."""
    ranges = fixed.EMOJI_RANGES + ([] if strict else [fixed.WIDE_EMOJI_RANGE])
    return "[" + "".join(rf"\x{{{low}}}-\x{{{high}}}" for low, high in ranges) + "]"


def has_emoji(title: Column, strict: bool = False) -> Column:
    return title.rlike(emoji_pattern(strict))


def words(title: Column) -> Column:
    """Lower-case words of three letters or more, stopwords removed."""
    found = F.regexp_extract_all(F.lower(title), F.lit(WORD_PATTERN), F.lit(0))
    stop = F.array(*[F.lit(word) for word in fixed.STOPWORDS])
    return F.filter(found, lambda word: ~F.array_contains(stop, word))


def held_keywords(title: Column, keywords: Column) -> Column:
    """Those of the lower-case ``keywords`` (structs with ``word``) a title holds.

    Substring match, not whole word: "art" is found in "party". The outer
    transform lower-cases a title once instead of once per keyword.
    """
    return F.flatten(
        F.transform(
            F.array(F.lower(title)),
            lambda text: F.filter(keywords, lambda keyword: F.contains(text, keyword["word"])),
        )
    )


GRAM = 3
#: Overlapping runs of that many characters, in one pass over the text.
_GRAMS = rf"(?s)(?=(.{{{GRAM}}}))"


def grams(text: Column) -> Column:
    """Distinct runs of ``GRAM`` characters of a text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(_GRAMS), F.lit(1)))


def rarest_grams(words: list[str]) -> dict[str, str]:
    """For each word the run of ``GRAM`` characters that fewest of the words hold; words without one are left out.

    Characters beyond the basic plane are two for Java, so words with them are left out too.
    """
    held = {
        word: sorted({word[i : i + GRAM] for i in range(len(word) - GRAM + 1)})
        for word in dict.fromkeys(words)
        if all(ord(c) < 0x10000 for c in word)
    }
    shared = Counter(gram for found in held.values() for gram in found)
    return {word: min(found, key=lambda gram: (shared[gram], gram)) for word, found in held.items() if found}


def title_length(title: Column) -> Column:
    return F.length(title)


def length_bin(length: Column) -> Column:
    """1-based class of a title length; NULL outside all classes."""
    return F.coalesce(*[
        F.when((length > low) & (length <= high), number)
        for number, (low, high, _) in enumerate(fixed.TITLE_LENGTH_BINS, 1)
    ])


def length_bins() -> Column:
    """All classes as an array of structs, to explode."""
    return F.array(*[
        F.struct(F.lit(number).alias("bin_no"), F.lit(label).alias("label"))
        for number, (_, _, label) in enumerate(fixed.TITLE_LENGTH_BINS, 1)
    ])
