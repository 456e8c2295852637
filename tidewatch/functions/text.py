"""Headlines: tokens, shingles, fingerprints, names, entities of markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import CAPITAL_STOP_WORDS, TITLE_STOP_WORDS
from .values import units

#: A publisher after a bar or dash with blanks on both sides; a hyphen inside a word is none.
SUFFIX = r"\s+[|–—-]\s+[A-Za-z0-9 .]+$"
OFFSET_HIGH, OFFSET_LOW = 0xCBF29CE4, 0x84222325  # 64-bit FNV offset basis
WORD32 = 0xFFFFFFFF


def title_tokens(title: Column) -> Column:
    """Significant words of a headline, in order, small letters and digits only."""
    bare = F.regexp_replace(F.lower(F.regexp_replace(title, SUFFIX, "")), "['’]", "")
    words = F.split(F.regexp_replace(bare, "[^a-z0-9]+", " "), " ")
    return F.filter(words, lambda w: (w != "") & ~w.isin(*TITLE_STOP_WORDS))


def title_key(title: Column) -> Column:
    return F.array_join(title_tokens(title), " ")


def shingles(tokens: Column, size: int = 3) -> Column:
    """Runs of ``size`` tokens; all of them as one if there are fewer; none of none."""
    runs = F.transform(F.sequence(F.lit(1), F.size(tokens) - size + 1), lambda i: F.array_join(F.slice(tokens, i, size), " "))
    return F.when(F.size(tokens) == 0, F.array().cast("array<string>")).when(F.size(tokens) < size, F.array(F.array_join(tokens, " "))).otherwise(runs)


def hash64(text: Column) -> Column:
    """64-bit FNV-1a as two 32-bit halves (hi, lo), since 64-bit products would overflow.

    The prime is 2**40 + 435, so low' = low * 435 and high' = high * 435 + low * 2**8 + carry.
    """
    codes = units(text)

    def step(acc: Column, c: Column) -> Column:
        low = acc["lo"].bitwiseXOR(c)
        product = low * 435
        high = (acc["hi"] * 435 + F.shiftleft(low, 8) + F.shiftright(product, 32)).bitwiseAND(F.lit(WORD32))
        return F.struct(high.alias("hi"), product.bitwiseAND(F.lit(WORD32)).alias("lo"))

    start = F.struct(F.lit(OFFSET_HIGH).cast("bigint").alias("hi"), F.lit(OFFSET_LOW).cast("bigint").alias("lo"))
    return F.aggregate(codes, start, step)


def _voted(hashes: Column, half: str) -> Column:
    """32 bits: those set in more than half of the hashes."""

    def bit(acc: Column, b: Column) -> Column:
        votes = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.when(h[half].bitwiseAND(F.expr("1L") * F.pow(F.lit(2.0), b).cast("bigint")) != 0, 1).otherwise(-1))
        return acc + F.when(votes > 0, F.pow(F.lit(2.0), b).cast("bigint")).otherwise(F.lit(0).cast("bigint"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(31)), F.lit(0).cast("bigint"), bit)


def title_simhash(title: Column) -> Column:
    """Fingerprint of a headline as two 32-bit halves; zero without tokens."""
    hashed = F.transform(F.array(F.transform(shingles(title_tokens(title)), hash64)), lambda hs: F.struct(_voted(hs, "hi").alias("hi"), _voted(hs, "lo").alias("lo")))
    return hashed[0]


def simhash_hex(fingerprint: Column, padded: bool = True) -> Column:
    full = F.concat(F.lpad(F.lower(F.hex(fingerprint["hi"])), 8, "0"), F.lpad(F.lower(F.hex(fingerprint["lo"])), 8, "0"))
    return full if padded else F.regexp_replace(full, "^0+(?=.)", "")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a["hi"].bitwiseXOR(b["hi"])) + F.bit_count(a["lo"].bitwiseXOR(b["lo"]))


def capital_entities(title: Column) -> Column:
    """Names: runs of capitalised words, joined and in small letters, each once, sorted.

    A stop word ends a run; a single word that starts the title is a matter of
    sentence case and names nothing.
    """
    tokens = F.filter(F.split(title, r"\s+"), lambda t: t != "")
    none = F.array().cast("array<string>")

    def closed(acc: Column) -> Column:
        drop = (F.size(acc["run"]) == 0) | ((acc["start"] == 0) & (F.size(acc["run"]) == 1))
        phrase = F.array_join(acc["run"], " ")
        return F.when(drop | phrase.isin(*CAPITAL_STOP_WORDS), acc["names"]).otherwise(F.concat(acc["names"], F.array(F.lower(phrase))))

    def step(acc: Column, token: Column) -> Column:
        word = F.regexp_replace(token, r"[^\p{L}\p{N}]", "")
        capital = word.rlike("^[A-Z]") & ~word.isin(*CAPITAL_STOP_WORDS)
        fresh = F.size(acc["run"]) == 0
        return F.struct(
            (acc["at"] + 1).alias("at"),
            F.when(capital & fresh, acc["at"]).when(capital, acc["start"]).otherwise(F.lit(-1)).alias("start"),
            F.when(capital, F.concat(acc["run"], F.array(word))).otherwise(none).alias("run"),
            F.when(capital, acc["names"]).otherwise(closed(acc)).alias("names"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("start"), none.alias("run"), none.alias("names"))
    return F.array_sort(F.array_distinct(F.aggregate(tokens, start, step, closed)))


def decode_entities(text: Column) -> Column:
    """Markup entities to characters: numbered ones first, then ``&amp;`` before the other names.

    Code points beyond the first plane become surrogate pairs, as UTF-16 has them.
    """

    def char(n: Column) -> Column:
        low = F.when((n > 0) & (n < 0x10000), F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE"))
        m = n - 0x10000
        pair = F.concat(F.lpad(F.hex(F.lit(0xD800) + F.shiftright(m, 10)), 4, "0"), F.lpad(F.hex(F.lit(0xDC00) + m.bitwiseAND(F.lit(0x3FF))), 4, "0"))
        return F.coalesce(low, F.when((n >= 0x10000) & (n <= 0x10FFFF), F.decode(F.unhex(pair), "UTF-16BE")), F.lit(""))

    def numbered(value: Column, pattern: str, base: int) -> Column:
        found = F.array_distinct(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)))
        digits = lambda ref: F.regexp_extract(ref, pattern, 1)
        code = lambda ref: F.conv(F.when(F.length(digits(ref)) <= 12, digits(ref)).otherwise(F.lit("0")), base, 10).cast("bigint")
        return F.aggregate(found, value, lambda acc, ref: F.replace(acc, ref, char(code(ref))))

    out = numbered(numbered(text, "&#x([0-9a-fA-F]+);", 16), "&#([0-9]+);", 10)
    for name, sign in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'")):
        out = F.replace(out, F.lit(name), F.lit(sign))
    return out


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct members; 0 if there is none."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def long_tokens(text: Column, least: int = 4) -> Column:
    """Distinct words of small letters and digits, of ``least`` characters or more."""
    words = F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " ")
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= least))


def slug(title: Column, key: Column) -> Column:
    base = F.substring(F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, 60)
    return F.concat(F.coalesce(F.nullif(base, F.lit("")), F.lit("situation")), F.lit("-"), F.substring(F.sha1(key.cast("binary")), 1, 6))


def article_id(canonical_url: Column) -> Column:
    return F.concat(F.lit("art-"), F.substring(F.sha1(canonical_url.cast("binary")), 1, 16))
