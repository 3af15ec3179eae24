"""Text normalisation and token functions, as Spark column expressions.

All lengths, prefixes and orders are those of UTF-8 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accented letters that are folded, the address words that
# are abbreviated, and the legal words that are dropped from names.
ACCENTS = {
    "e": "éèêëÉ",
    "a": "àâäÀá",
    "c": "çÇ",
    "i": "îïí",
    "o": "ôöó",
    "u": "ùûüú",
    "n": "ñ",
    "oe": "œ",
}
ADDRESS_WORDS = {
    "apartment": "apt",
    "avenue": "ave",
    "boulevard": "blvd",
    "drive": "dr",
    "east": "e",
    "highway": "hwy",
    "lane": "ln",
    "nagar": "ngr",
    "north": "n",
    "road": "rd",
    "south": "s",
    "street": "st",
    "suite": "ste",
    "west": "w",
}
LEGAL_WORDS = (
    "and", "corp", "corporation", "inc", "incorporated", "limited", "llc", "llp",
    "ltd", "plc", "private", "pvt", "sarl", "sas", "the",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SINGLE = [(x, plain) for plain, accented in ACCENTS.items() if len(plain) == 1 for x in accented]
MULTIPLE = [(x, plain) for plain, accented in ACCENTS.items() if len(plain) > 1 for x in accented]
SPACED = "[^a-zA-Z0-9\\x{80}-\\x{10FFFF}]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def fold_accents(s: Column) -> Column:
    for accented, plain in MULTIPLE:
        s = F.replace(s, F.lit(accented), F.lit(plain))
    return F.translate(s, "".join(x for x, _ in SINGLE), "".join(p for _, p in SINGLE))


def fold_punct_case(s: Column) -> Column:
    """``&`` reads "and"; ASCII letters are lower-cased; other ASCII becomes a space."""
    s = F.replace(s, F.lit("&"), F.lit(" and "))
    return F.translate(F.regexp_replace(s, SPACED, " "), UPPER, LOWER)


def words(s: Column) -> Column:
    return F.filter(F.split(s, " "), lambda w: w != "")


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def expand_address(tokens: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ADDRESS_WORDS.items() for x in pair])
    return F.transform(tokens, lambda w: F.coalesce(F.try_element_at(known, w), w))


def strip_legal(tokens: Column) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(*LEGAL_WORDS))


def normalize_name(s: Column) -> Column:
    return join_tokens(strip_legal(words(fold_punct_case(fold_accents(s)))))


def normalize_address(s: Column) -> Column:
    return join_tokens(expand_address(words(fold_punct_case(fold_accents(s)))))


def compact(s: Column) -> Column:
    return F.replace(s, F.lit(" "), F.lit(""))


def unique_words(tokens: Column) -> Column:
    return F.array_sort(F.array_distinct(tokens))


def numbers(s: Column) -> Column:
    """Maximal runs of ASCII digits, in order, with repeats."""
    return F.regexp_extract_all(s, F.lit("([0-9]+)"), F.lit(1))


def long_numbers(nums: Column, least: int = 4) -> Column:
    return F.filter(nums, lambda n: F.length(n) >= least)


def hex_bytes(s: Column) -> Column:
    return F.hex(F.encode(s, "UTF-8"))


def prefix(s: Column, n: int) -> Column:
    """The first ``n`` bytes, as hexadecimal digits (a cut may fall inside a character)."""
    return F.substring(hex_bytes(s), 1, 2 * n)


def longest_first(tokens: Column) -> Column:
    """Distinct tokens by falling byte length, then by bytes."""
    keyed = F.transform(
        F.array_distinct(tokens),
        lambda w: F.concat(F.lpad((F.lit(99_999_999) - F.octet_length(w)).cast("string"), 8, "0"), w),
    )
    return F.transform(F.array_sort(keyed), lambda w: F.substr(w, F.lit(9)))


def split_ids(s: Column) -> Column:
    """A comma-separated list; the empty text is the empty list."""
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, ","))


def _halves(s: Column) -> Column:
    """FNV-1a over the bytes, as two 32-bit halves in BIGINTs (no step can overflow)."""
    return let(hex_bytes(s), lambda digits: _fnv(digits, F.octet_length(s)))


def _fnv(digits: Column, n: Column) -> Column:
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    # The 64-bit offset basis, and the low part of the prime 2**40 + 435.
    basis, prime = 0xCBF29CE484222325, 435
    mask = F.lit(0xFFFFFFFF).cast("long")
    start = F.struct(
        F.lit(basis >> 32).cast("long").alias("hi"), F.lit(basis & 0xFFFFFFFF).cast("long").alias("lo")
    )

    def step(state: Column, place: Column) -> Column:
        byte = F.conv(F.substr(digits, 2 * place - 1, F.lit(2)), 16, 10).cast("long")
        x = state["lo"].bitwiseXOR(byte)
        low = x * prime
        high = state["hi"] * prime + F.shiftright(low, 32) + F.shiftleft(x, 8)
        return F.struct(high.bitwiseAND(mask).alias("hi"), low.bitwiseAND(mask).alias("lo"))

    return F.aggregate(places, start, step)


def hash64(s: Column) -> Column:
    """The unsigned 64-bit hash as DECIMAL(20,0)."""
    h = _halves(s)
    return (h["hi"].cast("decimal(20,0)") * F.lit(2**32).cast("decimal(11,0)") + h["lo"].cast("decimal(20,0)")).cast(
        "decimal(20,0)"
    )


def hash_mod(s: Column, mod: int) -> Column:
    """``hash64(s) % mod``, for ``mod`` below 2**31."""
    if not 1 <= mod < 1 << 31:
        raise ValueError("mod must be from 1 to 2**31 - 1")
    h = _halves(s)
    return F.pmod(h["hi"] * F.lit((1 << 32) % mod) + h["lo"], F.lit(mod).cast("long"))


def fold_of(entity_id: Column, folds: int = 10) -> Column:
    """The evaluation fold, salted so that it does not depend on sampling."""
    return hash_mod(F.concat(F.lit("evaluation:"), entity_id), folds)


def split_of(fold: Column) -> Column:
    return F.when(fold < 6, "fitting").when(fold < 8, "tuning").otherwise("holdout")
