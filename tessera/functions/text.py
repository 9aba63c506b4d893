"""Text normalization, abbreviations, Soundex and n-grams as column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.rules import ADDRESS, BUSINESS, token_map

#: White space as Unicode knows it, in Java's syntax.
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def lowered(c: Column) -> Column:
    """Unicode lower case without white space about it."""
    return strip(F.lower(c))


def spaced(c: Column) -> Column:
    """Every character that is neither word nor white space becomes one space."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x85\p{Z}]", " ")


@lru_cache(maxsize=1)
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """What NFKD leaves of each character in ASCII: one character each for a translation, and the longer ones."""
    one_from, one_to, more = [], [], {}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        if unicodedata.decomposition(c) == "":
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if x < "\x80")
        if len(plain) == 1:
            one_from.append(c)
            one_to.append(plain)
        elif plain:
            more[c] = plain
    return "".join(one_from), "".join(one_to), more


def ascii_folded(c: Column) -> Column:
    """NFKD, then only ASCII stays. The decomposition works code point by code point, so it is a translation."""
    source, target, more = _ascii_forms()
    table = F.create_map(*[F.lit(x) for kv in more.items() for x in kv])
    kind = "[" + "".join(re.escape(x) for x in more) + "]"
    widened = F.when(c.rlike(kind), F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.element_at(table, x), x)), "")).otherwise(c)
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(widened, source, target), r"[^\x00-\x7F]", "")).otherwise(c)


def collapsed(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"[\s\x0B\x1C-\x1F]+", " "))


def expanded_tokens(c: Column, rules: dict[str, str]) -> Column:
    """Each token looked up once; for text that N1 to N3 left."""
    pairs = [F.lit(x) for kv in token_map(rules).items() for x in kv]
    return collapsed(F.array_join(F.transform(F.split(collapsed(c), " "), lambda t: F.coalesce(F.element_at(F.create_map(*pairs), t), t)), " "))


def normalized(c: Column, rules: dict[str, str]) -> Column:
    """N1 to N5; null is the empty text."""
    return expanded_tokens(ascii_folded(spaced(lowered(F.coalesce(c, F.lit(""))))), rules)


def normalize_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Normalize columns in place; ids, countries and columns that aren't there are left alone. `business_name` has the rules of names, all others those of addresses."""
    names = [c for c in columns if c not in ("entity_id", "country") and c in df.columns]
    # step by step, so that no step's expression stands in the next one many times
    for step in (lambda c, _: spaced(lowered(F.coalesce(c, F.lit("")))), lambda c, _: ascii_folded(c), expanded_tokens):
        df = df.withColumns({c: step(F.col(c), BUSINESS if c == "business_name" else ADDRESS) for c in names})
    return df


def expand_abbreviations(c: Column, rules: dict[str, str]) -> Column:
    """Lower case, the rules one after the other at word boundaries, collapsed; punctuation and accents stay. Null and empty stay."""
    out = lowered(c)
    for short, long_ in rules.items():
        if short == "&":
            out = F.regexp_replace(out, f"(?<={WORD})&(?={WORD})", long_)
        else:
            body = r"\s*".join(map(re.escape, short.split(" ")))
            out = F.regexp_replace(out, f"(?<!{WORD}){body}(?!{WORD})", long_)
    return F.when(c == "", c).otherwise(strip(F.regexp_replace(out, f"{SPACE}+", " ")))


def expand_business_name(c: Column) -> Column:
    return expand_abbreviations(c, BUSINESS)


def expand_address(c: Column) -> Column:
    return expand_abbreviations(c, ADDRESS)


def parsed_ids(c: Column) -> Column:
    """I4: a comma list to an array; white space about items and blank items go, order and repeats stay. Null is no items."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda x: x != "")


def first_word(c: Column) -> Column:
    """P2."""
    return F.coalesce(F.get(F.split(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")), " "), F.lit(0)), F.lit(""))


def soundex(c: Column) -> Column:
    """The letter, then up to three codes of the letters after it; a letter without a code, H and W included, parts equal codes. Empty without letters."""
    letters = F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z]", "")
    # fixed values: the code of each letter
    codes = F.translate(letters, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "01230120022455012623010202")
    runs = F.regexp_replace(codes, r"(.)\1+", "$1")
    tail = F.substring(F.replace(F.substring(runs, 2, 1 << 20), F.lit("0"), F.lit("")), 1, 3)
    return F.when(letters == "", F.lit("")).otherwise(F.rpad(F.concat(F.substring(letters, 1, 1), tail), 4, "0"))


def tokens(c: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\s+"), lambda t: t != "")


def word_grams(c: Column, low: int = 2, high: int = 4) -> Column:
    """N-grams of each word with one space about it; a word shorter than n with its spaces has none of n."""

    def of_word(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        size = F.length(w) + 2
        return F.flatten(F.transform(F.sequence(F.lit(low), F.least(F.lit(high), size)), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: padded.substr(i, n))))

    return F.flatten(F.transform(tokens(F.lower(c)), of_word))


def grams_of(word: str, low: int = 2, high: int = 4) -> list[str]:
    """`word_grams` of one word in lower case, as a list."""
    padded = f" {word} "
    return [padded[i : i + n] for n in range(low, min(high, len(padded)) + 1) for i in range(len(padded) - n + 1)]
