"""Canonical URLs for exact matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import TRACKING_PREFIXES
from .values import fnv32, hex_digits, let, trimmed

#: scheme, authority, path, query, fragment of a web address.
WEB = r"(?i)^(https?):[\\/]*([^/?#\\]+)([^?#]*)(\?[^#]*)?(#.*)?$"


def _decoded(text: Column) -> Column:
    """Form decoding; a stray percent sign stays what it is."""
    return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))


def canonical_url(raw: Column) -> Column:
    """Small host without ``www.``, no tracking parameters, the others sorted by key, no fragment, no slash at the end.

    Parameters of one key keep their order.  Text that is no web address comes back trimmed.
    """
    return let(F.regexp_replace(trimmed(raw), r"[\t\n\r]", ""), lambda text: F.when(text.rlike(WEB), let(_parts(text), _rebuilt)).otherwise(text))


def _parts(text: Column) -> Column:
    part = lambda n: F.regexp_extract(text, WEB, n)
    return F.struct(F.lower(part(1)).alias("scheme"), F.lower(part(2)).alias("host"), part(3).alias("path"), part(4).alias("query"))


def _rebuilt(p: Column) -> Column:
    host = F.regexp_replace(F.regexp_replace(p["host"], r"^((?:[^@]*@)?)www\.(?=.)", "$1"), r":$", "")
    port = F.when(p["scheme"] == "http", F.regexp_replace(host, ":80$", "")).otherwise(F.regexp_replace(host, ":443$", ""))
    path = F.coalesce(F.nullif(let(F.regexp_replace(p["path"], r"\\", "/"), _path), F.lit("")), F.lit("/"))
    path = let(path, lambda x: F.when((F.length(x) > 1) & x.endswith("/"), F.substring(x, F.lit(1), F.length(x) - 1)).otherwise(x))
    return F.concat(p["scheme"], F.lit("://"), port, path, let(_query(p["query"]), lambda q: F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit(""))))


#: Characters that stand for themselves in a path (fixed value of the URL standard); others are written as escaped UTF-8.
PLAIN = r"[\x21\x24-\x3B\x3D\x40-\x5D\x5F\x61-\x7A\x7C\x7E]"


def _path(path: Column) -> Column:
    """Without ``.`` and ``..`` segments, escaped where the standard asks for it; plain paths come back as they are."""

    def escaped(text: Column) -> Column:
        one = lambda c: F.when(c.rlike(PLAIN), c).when(c == " ", "%20").otherwise(F.url_encode(c))
        return F.when(text.rlike(rf"^{PLAIN}*$"), text).otherwise(F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), one), ""))

    def resolved(text: Column) -> Column:
        parts = F.split(text, "/", -1)
        none = F.array().cast("array<string>")
        plain = let(parts, lambda ps: F.zip_with(ps, F.sequence(F.lit(1), F.size(ps)), lambda s, i: F.struct(s.alias("s"), (i == F.size(ps)).alias("last"))))

        def step(acc: Column, x: Column) -> Column:
            dots = F.replace(F.lower(x["s"]), F.lit("%2e"), F.lit("."))
            end = F.when(x["last"], F.array(F.lit(""))).otherwise(none)  # a path that ends with dots ends with a slash
            up = F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)
            return F.when(dots == "..", F.concat(up, end)).when(dots == ".", F.concat(acc, end)).otherwise(F.concat(acc, F.array(x["s"])))

        return F.when(text.rlike(r"(?i)/(?:\.|%2e){1,2}(?:/|$)"), F.array_join(F.aggregate(plain, none, step), "/")).otherwise(text)

    return let(escaped(path), resolved)


def _query(raw: Column) -> Column:
    """Parameters without tracking ones, by key."""
    pairs = F.filter(F.split(F.regexp_replace(raw, r"^\?", ""), "&"), lambda p: p != "")

    def field(pair: Column, i: Column) -> Column:
        at = F.locate("=", pair)
        key = F.when(at > 0, F.substring(pair, F.lit(1), at - 1)).otherwise(pair)
        value = F.when(at > 0, F.substring(pair, at + 1, F.length(pair))).otherwise(F.lit(""))
        key = _decoded(key)
        return F.struct(F.collate(key, "UNICODE").alias("order"), i.alias("i"), key.alias("k"), _decoded(value).alias("v"))

    def tracking(f: Column) -> Column:
        out = F.lit(False)
        for prefix in TRACKING_PREFIXES:
            out = out | F.lower(f["k"]).startswith(prefix)
        return out

    kept = F.array_sort(F.filter(F.transform(pairs, field), lambda f: ~tracking(f)))
    return F.array_join(F.transform(kept, lambda f: F.concat(F.url_encode(f["k"]), F.lit("="), F.url_encode(f["v"]))), "&")


def url_hash(raw: Column) -> Column:
    return hex_digits(fnv32(canonical_url(raw)), 8)


def host_of(url: Column) -> Column:
    """Host without ``www.``, null if the text is no web address."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), WEB, 2)
    return F.nullif(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(host), "^.*@", ""), r":\d*$", ""), r"^www\.", ""), F.lit(""))


def quote_url(symbol: Column, exchange: Column) -> Column:
    return F.concat(F.lit("https://www.google.com/finance/quote/"), F.replace(F.url_encode(symbol), F.lit("+"), F.lit("%20")), F.lit(":"), exchange)
