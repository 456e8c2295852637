"""Quality rules: a threshold table compiled into one Spark projection.

Everything here is built-in functions, so a corpus is judged in the scan stage
itself: no shuffle, no Python worker, one row in, one row out.

Defined results
  * null or blank text: no words, all counts zero, not kept (too few words);
  * repeated rows: each is judged alone, equal rows get equal verdicts;
  * very long texts: work is O(words log words) inside the row;
  * other columns pass through; a column that has the name of one of the
    results is replaced by the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, table, without

#: Characters that part words: space and tab to carriage return.
SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Function words of the corpus languages (en, de, fr, es), fixed values.
STOP_WORDS = (
    "the of and to in is that for it was on with as be are this by at from or an have not they which you "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "le la les de et un une du en que qui dans pour pas sur au par est il elle "
    "el los las y se una con su no del al lo como más pero sus"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep rows whose ``metric`` lies in [low, high]; None leaves a side open."""

    metric: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value, out = F.col(self.metric), F.lit(True)
        if self.low is not None:
            out = out & (value >= F.lit(self.low))
        if self.high is not None:
            out = out & (value <= F.lit(self.high))
        return out


#: The production threshold table; ratios are per word, character or line.
RULES = (
    Rule("mean_word_chars", 2.0, 25.0),
    Rule("symbol_ratio", None, 0.10),
    Rule("shout_ratio", None, 0.15),
    Rule("upper_ratio", None, 0.40),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.50),
    Rule("stutter_ratio", None, 0.30),
)
METRICS = ("mean_word_chars", "symbol_ratio", "shout_ratio", "upper_ratio", "stop_word_ratio", "dup_line_ratio", "stutter_ratio")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that the text holds twice or more."""

    def window(i: Column) -> Column:
        return F.slice(words, i + 1, WINDOW)

    def covered(hashes: Column) -> Column:
        # 64 + 32 bits name a window; equal ones are neighbours after sorting.
        named = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), F.hash(window(i)).alias("g"), i.alias("i"))))

        def same(p: Column, q: Column) -> Column:
            return F.coalesce((p["h"] == q["h"]) & (p["g"] == q["g"]), F.lit(False))

        def starts(ps: Column) -> Column:
            twice = F.transform(ps, lambda p, k: F.when(same(p, F.get(ps, k - 1)) | same(p, F.get(ps, k + 1)), p["i"]))
            return F.array_sort(F.filter(twice, lambda i: i.isNotNull()))

        return F.aggregate(
            let(named, starts),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")),
            lambda a: a["n"],
        )

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(window(i)))
    some = let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(covered(hs)))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(some)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and the ratios that rules speak of."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def of_words(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.aggregate(ws, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            _repeated(ws).cast("long").alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: F.lower(w).isin(*STOP_WORDS))).alias("stop_words"),
            F.size(F.filter(ws, lambda w: w.endswith("!!"))).alias("shouts"),
            F.size(F.filter(ws, lambda w, i: w == F.get(ws, i + 1))).alias("stutters"),
        )

    def of_lines(ls: Column) -> Column:
        return F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"))

    def per(n: Column, of: Column) -> Column:
        return F.when(of > 0, n / of).otherwise(F.lit(0.0))

    kept = [c for c in without(docs, *COUNTS, *METRICS, "base_failed", "kept").columns]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("_row"), whole.alias("_text"))
    text_ = F.col("_text")
    words = F.filter(F.split(text_, SEPARATORS), lambda w: w != "")
    lines = F.filter(F.split(text_, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = rows.select(
        "_row",
        let(words, of_words).alias("_w"),
        let(lines, of_lines).alias("_l"),
        (F.length(text_) - F.length(F.translate(text_, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.regexp_count(text_, F.lit(r"\p{Lu}")).alias("_upper"),
    )
    return out.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in kept],
        F.col("_w.n_words").alias("n_words"),
        F.col("_w.word_chars").alias("word_chars"),
        "n_symbols",
        F.col("_l.dup").alias("n_dup_lines"),
        F.col("_w.n_repeat_words").alias("n_repeat_words"),
        per(F.col("_w.word_chars"), F.col("_w.n_words")).alias("mean_word_chars"),
        per(F.col("n_symbols"), F.col("_w.n_words")).alias("symbol_ratio"),
        per(F.col("_w.shouts"), F.col("_w.n_words")).alias("shout_ratio"),
        per(F.col("_upper"), F.col("_w.word_chars")).alias("upper_ratio"),
        per(F.col("_w.stop_words"), F.col("_w.n_words")).alias("stop_word_ratio"),
        per(F.col("_l.dup"), F.col("_l.n")).alias("dup_line_ratio"),
        per(F.col("_w.stutters"), F.col("_w.n_words")).alias("stutter_ratio"),
    )


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with counts, ratios, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    verdict = ~failed
    for rule in rules:
        verdict = verdict & rule.holds()
    return measured(docs, text).withColumns({"base_failed": failed, "kept": verdict})


def filtered(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that the rules keep, with their own columns only."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"))
    return judged(whole, rules).filter("kept").select("_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", *COUNTS, "base_failed", "kept")


def oracle() -> str:
    """DuckDB SQL for ``query``."""
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
         coalesce(text, '') AS t, row_number() OVER () AS r
  FROM documents),
win AS (
  SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW} + 2)) AS i FROM w WHERE len(ws) > {WINDOW})),
twice AS (SELECT r, k FROM win GROUP BY r, k HAVING count(*) > 1),
hit AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT win.r, unnest(range(i, i + {WINDOW})) AS p FROM win JOIN twice ON win.r = twice.r AND win.k = twice.k)
  GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines,
         len(list_filter(ws, lambda x: lower(x) IN ({stops}))) AS stops,
         len(list_filter(ws, lambda x: ends_with(x, '!!'))) AS shouts,
         len(list_filter(ws, lambda x, i: x = ws[i + 1])) AS stutters,
         length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')) AS uppers
  FROM w LEFT JOIN hit ON w.r = hit.r),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 25.0 AND n_symbols / n_words <= 0.10
       AND shouts / n_words <= 0.15 AND uppers / word_chars <= 0.40 AND stops / n_words >= 0.02
       AND n_dup_lines / n_lines <= 0.50 AND stutters / n_words <= 0.30 AS kept
FROM b"""
