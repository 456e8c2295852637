"""Line dedup: lines that many documents share stay in one of them.

Normalised lines are exploded with their place, hashed, and the distinct
documents of each hash counted.  Hashes over the threshold lose their lines in
every document but the last that holds them; what is left is put together
again by place.

What moves is a line's 128-bit hash, its document and its place, never its
text.  A line that most documents hold is counted before the shuffle, and its
verdict is broadcast (``met``), so no task gets its rows.  Texts move once, to
meet the places that they lose.

Defined results
  * null or empty text: one empty line, which is kept;
  * a document is a doc_id: rows that repeat one count once, and a line stays
    in all rows of its last document; a row without a doc_id is no document, so
    it is not counted and loses nothing;
  * a line that one document holds many times counts once, and goes or stays
    at all its places;
  * texts of any length: work is linear in the number of lines;
  * ties can't arise (doc_ids are ordered); an empty table gives no rows;
  * other columns pass through; one that has the name of a result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, met, table, without, written

MIN_CHARS = 20
MIN_DOCUMENTS = 3
#: Space and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(line: Column) -> Column:
    """Stripped of blanks at both ends, A-Z lower-cased."""
    inner = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(inner) == F.length(inner)  # ASCII alone: the quick way says the same
    return F.when(plain, F.lower(inner)).otherwise(F.translate(inner, UPPER, LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _mark(text: Column) -> Column:
    """Tells apart the rows of one doc_id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def places(docs: DataFrame, min_chars: int = MIN_CHARS, text: str = "text") -> DataFrame:
    """(doc_id, mark, pos, h, g) of every line that is long enough to count; h and g are 128 bits of its normal form."""
    rows = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", _mark(F.col(text)).alias("mark"), _lines(F.col(text)).alias("lines"))
    each = rows.select("doc_id", "mark", F.posexplode("lines").alias("pos", "line")).select("doc_id", "mark", "pos", normalised(F.col("line")).alias("line"))
    return each.filter(F.length("line") >= min_chars).select("doc_id", "mark", "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))


def shared(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(h, g, last, n_rows) of lines that at least so many documents hold, with the last of them."""
    once = lines.groupBy("h", "g", "doc_id").agg(F.count("*").alias("n"))
    return once.groupBy("h", "g").agg(F.max("doc_id").alias("last"), F.sum("n").alias("n_rows"), F.count("*").alias("n_docs")).filter(F.col("n_docs") >= min_documents).drop("n_docs")


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, text: str = "text") -> DataFrame:
    """``docs`` with shared lines taken out of the text, and ``n_lines``, ``n_dropped``; a null text that loses nothing stays null."""
    lines = written(places(docs, min_chars, text), "line-places")
    facts = written(shared(lines, min_documents), "line-shared")
    lost = met(lines, facts, ["h", "g"], "n_rows").filter(F.col("doc_id") < F.col("last")).groupBy("doc_id", "mark").agg(F.collect_set("pos").alias("_lost"))
    kept = [c for c in without(docs, "n_lines", "n_dropped").columns]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col("doc_id").alias("_id"), _mark(F.col(text)).alias("_mark"))
    both = rows.join(lost.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"}), ["_id", "_mark"], "left")
    whole = F.col(f"_row.`{text}`")

    def rest(ls: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("_lost"))
        return F.array_join(F.transform(stay, lambda p: F.get(ls, p)), "\n")

    left = F.when(F.col("_lost").isNull(), whole).otherwise(let(_lines(whole), rest))
    return both.select(
        *[(left if c == text else F.col(f"_row.`{c}`")).alias(c) for c in kept],
        F.size(_lines(whole)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def oracle() -> str:
    """DuckDB SQL for ``query``."""
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {blanks}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}),
m AS (SELECT r, doc_id, pos, line, coalesce(doc_id < last, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id"""
