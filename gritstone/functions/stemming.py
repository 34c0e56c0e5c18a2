"""English word stems by suffix rules, as expressions.

A step tries its rules in order and applies the first that fits, so no rule of a step meets what another one has made.
The same list serves as SQL text. Stemming is meant for tables of different words, not for every word of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The suffixes of the English stemmer of Porter (second version) and where each may be cut, without its lists of exceptions. The place is
# a pattern for what stands before the suffix: a first or second syllable closed by a consonant lies in it, say.
ANY, LONG, VOWEL, VOWEL_BEFORE = ".*", "...*", ".*[aeiouy].*", ".*[aeiouy].+"
ONE, TWO = ".*[aeiouy][^aeiouy].*", ".*[aeiouy][^aeiouy].*[aeiouy][^aeiouy].*"
# "~" marks a word that has lost ed or ing, until the step after it.
STEPS: list[list[tuple[str, str, str]]] = [
    [(ANY, "sses", "ss"), (LONG, "ies", "i"), (ANY, "ies", "ie"), (ANY, "us", "us"), (ANY, "ss", "ss"), (VOWEL_BEFORE, "s", "")],
    [(ONE, "eedly", "ee"), (ONE, "eed", "ee"), (ANY, "eed", "eed"), (VOWEL, "ingly", "~"), (VOWEL, "edly", "~"), (VOWEL, "ing", "~"), (VOWEL, "ed", "~")],
    [(ANY, "at~", "ate"), (ANY, "bl~", "ble"), (ANY, "iz~", "ize"), *[(ANY, f"{c}{c}~", c) for c in "bdfgmnprt"],
     ("[^aeiouy]*[aeiouy][^aeiouywx]", "~", "e"), (ANY, "~", "")],
    [(".+[^aeiouy]", "y", "i")],
    [(ONE, "ization", "ize"), (ONE, "ational", "ate"), (ONE, "fulness", "ful"), (ONE, "ousness", "ous"), (ONE, "iveness", "ive"), (ONE, "tional", "tion"),
     (ONE, "biliti", "ble"), (ONE, "lessli", "less"), (ONE, "entli", "ent"), (ONE, "ation", "ate"), (ONE, "alism", "al"), (ONE, "aliti", "al"), (ONE, "ousli", "ous"),
     (ONE, "iviti", "ive"), (ONE, "fulli", "ful"), (ONE, "enci", "ence"), (ONE, "anci", "ance"), (ONE, "abli", "able"), (ONE, "izer", "ize"), (ONE, "ator", "ate"),
     (ONE, "alli", "al"), (ONE, "bli", "ble"), (ONE, "logi", "log"), (f"{ONE[:-2]}.*[cdeghkmnrt]", "li", "")],
    [(ONE, "ational", "ate"), (ONE, "tional", "tion"), (ONE, "alize", "al"), (ONE, "icate", "ic"), (ONE, "iciti", "ic"), (ONE, "ical", "ic"), (TWO, "ative", ""), (ONE, "ness", ""), (ONE, "ful", "")],
    [*[(TWO, s, "") for s in ("ement", "ance", "ence", "able", "ible", "ment")], *[(TWO, s, "") for s in ("ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize")],
     (TWO, "sion", "s"), (TWO, "tion", "t"), *[(TWO, s, "") for s in ("al", "er", "ic")]],
    [(TWO, "e", ""), (f"{ONE}[aeiouy]|{ONE}[^aeiouy][aeiouy][wxy]|{ONE}[^aeiouy][^aeiouy]", "e", ""), (".*[aeiouy][^aeiouy].*[aeiouy](?:[^aeiouy].*)?l", "l", "")],
]


def _pattern(place: str, suffix: str) -> str:
    return f"^({place}){suffix}$"


def with_stems(words: DataFrame, word: str, out: str) -> DataFrame:
    """Add the stem of a column of lower-case words; words of fewer than three letters are their own."""
    def step(current: Column, rules: list[tuple[str, str, str]]) -> Column:
        choice = F.when(F.length(word) < 3, current)
        for place, suffix, put in rules:
            pattern = _pattern(place, suffix)
            fits = current.endswith(suffix) & current.rlike(pattern)  # the cheap test first
            choice = choice.when(fits, F.regexp_replace(current, pattern, f"$1{put}"))
        return choice.otherwise(current)

    frame = words.withColumn(out, F.col(word))
    for rules in STEPS:
        frame = frame.withColumn(out, step(F.col(out), rules))
    return frame


def stem_ctes(source: str, word: str) -> dict[str, str]:
    """The same rules as SQL: named expressions, of which ``stems`` has every (word, stem) of ``source``."""
    ctes = {"stem0": f"SELECT DISTINCT {word} AS word, {word} AS s FROM {source}"}
    for k, rules in enumerate(STEPS):
        cases = " ".join(f"WHEN regexp_matches(s, '{_pattern(p, x)}') THEN regexp_replace(s, '{_pattern(p, x)}', '\\1{put}')" for p, x, put in rules)
        ctes[f"stem{k + 1}"] = f"SELECT word, CASE WHEN length(word) < 3 THEN s {cases} ELSE s END AS s FROM stem{k}"
    return {**ctes, "stems": f"SELECT word, s AS stem FROM stem{len(STEPS)}"}
