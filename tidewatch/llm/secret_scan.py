"""Secret scans: candidate spans judged by who else in the corpus holds them.

Three base kinds are found by fixed patterns.  Further kinds name shapes that
are often secrets and as often harmless examples: keys of known issuers, web
tokens, private-key blocks, and long mixed strings.  The value of every span of
either sort is hashed, and for each hash the corpus tells how many repositories
and how many owners hold it.  A value that more than ``MOST_OWNERS`` owners or
``MOST_REPOSITORIES`` repositories hold is a copied example (or a template's
placeholder); a value that stays with its owner looks live.  Each span carries
this verdict.  Copied spans of further kinds are left out of ``spans``, base
spans always stay there.

One pass over the texts; after it only hashes and places move.  Owners are
counted after a sum over (hash, owner, repository), which is combined before
the shuffle, so a value that a third of all rows hold is a few rows per task by
then; the verdicts of such values come back by a broadcast of bounded size
(``common.met``).  Values themselves never leave the scan.

``documents`` has one column of origin: ``source`` is taken as the owner, and
a (source, lang) pair as a repository of that owner.

Defined results
  * null and empty texts: no spans, the digest of an empty list;
  * spans count code points, the end is exclusive; order is by start, then by
    kind as listed; spans of different kinds may overlap, but a further kind
    gives way to an overlapping base span, but for whole private keys;
  * a null owner or repository counts as one of its own;
  * repeated rows and null doc_ids: each row gets its own result row; an empty
    table gives no rows; other columns are not used.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import met, table, unused, written
from .tokens import slices

#: Base patterns (fixed values): the letters of the first are matched in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: The last two ask for their least length at once: their runs can't match anew inside a run that was too short.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")
LEAST_VALUE = 6

#: Further kinds: prefixes of issued keys are public knowledge (fixed values).
ISSUED = re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|glpat-[A-Za-z0-9_-]{20,})")
#: A token's parts begin after other than their own characters, so each part is read three times at most.
JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")
#: A private key runs to its END line, or over its base64 lines where that line is missing.
PRIVATE = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----")
PRIVATE_END = re.compile(r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----")
BREAK = r"(?:\s|\\[nrt])"
CUT_OFF = re.compile(rf"(?:{BREAK}*(?:Proc-Type|DEK-Info):[^\n\\]*)*(?:{BREAK}*[A-Za-z0-9+/]{{16,}}={{0,2}})*(?:{BREAK}+[A-Za-z0-9+/]{{1,15}}={{1,2}})?")
BREAKS = re.compile(rf"{BREAK}+")
MIXED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/_-])")
#: A mixed string holds a digit somewhere; asked of the whole match, so that no window cuts the search.
DIGIT = re.compile(r"[0-9]")
FURTHER = (("issued", ISSUED, 0.0), ("jwt", JWT, 0.0), ("private", PRIVATE, 0.0), ("mixed", MIXED, 3.5))
KINDS = (*BASE, *(k for k, _, _ in FURTHER))
MOST_OWNERS = 2
MOST_REPOSITORIES = 4

SCANNED = "row string, doc_id long, owner string, repository string, spans array<struct<kind:string,start:int,end:int,hash:long>>"
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.int64())])


def entropy(text: str) -> float:
    """Bits a character."""
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values())


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE] if "=" in text or ":" in text else []
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def private_spans(text: str) -> list[tuple[str, int, int]]:
    """Whole private keys, from the header on."""
    out = []
    for m in PRIVATE.finditer(text) if "PRIVATE KEY-----" in text else ():
        at = text.find("-----", m.end())
        end = PRIVATE_END.match(text, at) if at >= 0 else None
        out.append(("private", m.start(), (end or CUT_OFF.match(text, m.end())).end()))
    return out


def hashed(kind: str, value: str) -> int:
    """Hash of a span's value: what is assigned, or a private key's body without line breaks, since its header is everybody's."""
    import xxhash

    if kind == "assign":
        value = ASSIGN.match(value).group(2)
    if kind == "private":
        value = BREAKS.sub("", PRIVATE_END.sub("", PRIVATE.sub("", value, count=1))) or value
    return xxhash.xxh3_64_intdigest(value.encode()) - (1 << 63)


class _Taken:
    """Spans that hold each other's places; asks whether a span overlaps any by bisection."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [], []
        for s, e in sorted(spans):  # overlapping ones as one
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def free(self, s: int, e: int) -> bool:
        at = bisect_left(self.starts, e)  # the first that starts at e or later
        return not at or self.ends[at - 1] <= s


def further_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Private keys, and candidates of the other further kinds that overlap no base span, no private key and no candidate of an earlier kind."""
    out = private_spans(text)
    for kind, pattern, least in FURTHER:
        if kind == "private":
            continue
        taken = _Taken([(s, e) for _, s, e in base + out])
        for m in pattern.finditer(text):
            if (kind != "mixed" or DIGIT.search(m.group())) and (not least or entropy(m.group()) >= least) and taken.free(*m.span()):
                out.append((kind, *m.span()))
    return out


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def candidates(docs: DataFrame, owner: Column, repository: Column, key: Column | None = None) -> DataFrame:
    """One row a document: its spans, each with the hash of its value; doc_id is ``key`` where that is given."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, "text"):
                found = []
                for text in rows["text"].to_pylist():
                    text = text or ""
                    base = base_spans(text)
                    spans = ordered(base + further_spans(text, base))
                    found.append([{"kind": k, "start": s, "end": e, "hash": hashed(k, text[s:e])} for k, s, e in spans])
                names = [f"{part}:{n + i}" for i in range(rows.num_rows)]
                n += rows.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(names), rows["doc_id"], rows["owner"], rows["repository"], pa.array(found, pa.list_(SPAN))], names=["row", "doc_id", "owner", "repository", "spans"])

    key = F.col("doc_id").cast("long") if key is None else key
    rows = docs.select(key.alias("doc_id"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, SCANNED)


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, owners, repositories, n) of every candidate value; n spans hold it."""
    each = spans.select("owner", "repository", F.explode("spans").alias("s")).select(F.col("s.hash").alias("hash"), "owner", "repository")
    held = each.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("n"))


def verdicts(spans: DataFrame) -> DataFrame:
    """(hash, live, n) of every candidate value, stored."""
    live = (F.col("owners") <= MOST_OWNERS) & (F.col("repositories") <= MOST_REPOSITORIES)
    return written(ownership(spans).select("hash", live.alias("live"), "n"), "secret-verdicts")


def scanned(docs: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """(doc_id, base, spans, live, copied): arrays of (start, order, kind, end); ``spans`` has all base and the live further ones, ``live`` and ``copied`` have all by verdict."""
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", F.col("source"), F.coalesce("lang", F.lit(""))) if repository is None else repository
    found = written(candidates(docs, owner, repository), "secret-spans")
    each = written(found.select("row", F.explode("spans").alias("s")).select("row", F.col("s.hash").alias("hash"), "s"), "secret-each")
    order = F.create_map(*[x for n, k in enumerate(KINDS) for x in (F.lit(k), F.lit(n))])
    s = F.col("s")
    place = F.struct(s["start"].alias("start"), order[s["kind"]].alias("nth"), s["kind"].alias("kind"), s["end"].alias("end"))
    judged = met(each, verdicts(found), ["hash"], "n").select("row", place.alias("place"), F.coalesce("live", F.lit(False)).alias("live"))
    held = judged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "live"))).alias("all"))
    empty = F.array().cast("array<struct<place:struct<start:int,nth:int,kind:string,end:int>,live:boolean>>")
    joined = found.select("row", "doc_id").join(held, "row", "left").withColumn("all", F.coalesce("all", empty))

    def those(test) -> Column:
        return F.transform(F.filter("all", test), lambda x: x["place"])

    base = lambda x: x["place"]["nth"] < len(BASE)
    return joined.select(
        "doc_id", those(base).alias("base"), those(lambda x: base(x) | x["live"]).alias("spans"), those(lambda x: x["live"]).alias("live"), those(lambda x: ~x["live"]).alias("copied")
    )


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def query(spark, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[number(k) for k in BASE], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), *[listed(F.col(c)).alias(c) for c in ("spans", "live", "copied")])


#: What stands in the place of a secret.
MASK = "[secret]"


def redacted(docs: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by a mark; n_chars, where there is one, follows.

    A row is matched with its live values by a hash of its text, so a null or repeated doc_id does
    not matter; texts that share a hash could only lend each other values that are live anyhow.
    """
    base_owner = F.col("source") if owner is None else owner
    base_repository = F.concat_ws("/", F.col("source"), F.coalesce("lang", F.lit(""))) if repository is None else repository
    mark, print_ = unused(docs, "_live"), unused(docs, "_print")
    of_text = F.xxhash64(F.col("text").cast("string"))
    found = written(candidates(docs, base_owner, base_repository, of_text), "secret-spans")
    more = written(found.select(F.col("doc_id").alias(print_), F.explode("spans").alias("s")).filter(~F.col("s.kind").isin(*BASE)).select(print_, F.col("s.hash").alias("hash")), "secret-each")
    # Stored, so that its true size decides how it meets the texts: few live values need no shuffle of them.
    spans = written(met(more, verdicts(found), ["hash"], "n").filter("live").groupBy(print_).agg(F.collect_set("hash").alias(mark)), "secret-live")
    names, kinds = docs.columns, docs.schema
    marked = docs.withColumn(print_, of_text).join(spans, print_, "left").select(*[F.col(f"`{c}`") for c in names], mark)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            for rows in slices(batch, "text"):
                texts, held = [], rows[mark].to_pylist()
                for text, live in zip(rows["text"].to_pylist(), held, strict=True):
                    if text:
                        base = base_spans(text)
                        cut = list(base)
                        if live:
                            known = set(live)
                            cut += [x for x in further_spans(text, base) if hashed(x[0], text[x[1] : x[2]]) in known]
                        text = _masked(text, cut)
                    texts.append(text)
                columns = [rows[c] for c in names]
                columns[at] = pa.array(texts, rows["text"].type)
                if "n_chars" in names:
                    columns[names.index("n_chars")] = pa.array([None if t is None else len(t) for t in texts], rows["n_chars"].type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return marked.mapInArrow(mask, kinds)


def _masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]])
