"""Operator 7 (native): line-first cleaning with DataFrame functions only.

Each line is judged first: symbols, shouting, navigation bars, boilerplate phrases, missing closing punctuation. Failing
lines are removed; a document goes if it fails the base rules (fewer than 10 words, or over 20 % of its words in repeated
five-word windows), has no line left, or loses more than ``LOSS`` of its word characters (lines that are removed as
boilerplate count neither as text nor as loss). ``clean`` is stricter: only the first ``EXEMPT_LINES`` boilerplate lines are
no loss, and what is left must have ``LEAST_WORDS`` too. All work stays within a row: no shuffle.

Windows are compared by a 64-bit hash within one document, where a false match has a probability of about n**2 / 2**65.

Edge cases: a null text counts as empty: no words, ``base_failed``, not kept; ties and repeated rows are judged each; a very
long text is one row, whose arrays of words and windows (some 50 bytes a word) must fit a task's memory; an empty table gives
no rows; other columns are ignored (``clean`` keeps them, also those named as the measures are).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm.common import table

LEAST_WORDS, MOST_REPEATED = 10, 20  # per cent
LOSS = 0.4
EXEMPT_LINES = 2  # of boilerplate, such as a licence, that a document may lose besides
WORD = r"[^\x20\x09-\x0D]"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
BOILERPLATE = r"(?i)(licensed under|all rights reserved|copyright|cookie|privacy policy|terms of (use|service)|enable javascript|click here|subscribe|sign (in|up)|log ?in|powered by|share this)"
CLOSED = r"""[.!?:;"'”’»)\]…][\x20\x09-\x0D]*$"""


def _words(line: Column) -> Column:
    """The words of a line; the plain split at blanks needs no regular expression."""
    other = r"[\x09\x0B-\x0D]"
    plain = F.when(line.rlike(other), F.regexp_replace(line, other, " ")).otherwise(line)
    return F.array_remove(F.split(plain, " "), "")


def _count(line: Column, characters: str) -> Column:
    """Code points of the given class; runs of all others go at once."""
    return F.length(F.regexp_replace(line, f"[^{characters}]+", ""))


def _is_boilerplate(x: Column) -> Column:
    return (x["words"] <= 20) & x["line"].rlike(BOILERPLATE)


def _fails(x: Column) -> Column:
    """Whether a line is removed; a line without a word is neither kept nor lost text. The costly tests come last."""
    line, words = x["line"], x["words"]
    letters, capitals = _count(line, r"\p{L}"), _count(line, r"\p{Lu}")
    bars = _count(line, "|»•·")
    symbolic = x["symbols"] * 10 > x["chars"]
    open_ended = (words <= 2) & ~line.rlike(CLOSED)
    navigation = (bars >= 3) & (bars * 4 > words)
    shouting = (capitals > 5) & (letters >= 10) & (capitals * 2 > letters)
    return symbolic | open_ended | navigation | shouting | x["boilerplate"]


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and the columns ``n_words`` … ``kept`` and ``cleaned``, in steps so that each array is made once."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    at = lambda a, i: F.get(F.col(a), i)
    hashed = F.transform(F.flatten("__parts.words"), lambda w: F.xxhash64(w))
    window = F.slice(F.transform("__words", lambda h, i: F.xxhash64(h, at("__words", i + 1), at("__words", i + 2), at("__words", i + 3), at("__words", i + 4))), 1, F.greatest(F.size("__words") - 4, F.lit(0)))
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    ordered = F.when(repeats, F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    same = lambda x, i, d: F.coalesce(x["h"] == at("__ordered", i + d)["h"], F.lit(False))
    places = F.sort_array(F.filter(F.transform("__ordered", lambda x, i: F.when(same(x, i, -1) | same(x, i, 1), x["i"])), lambda p: p.isNotNull()))
    covered = F.aggregate(F.transform("__places", lambda p, i: F.coalesce(F.least(F.lit(5), at("__places", i + 1) - p), F.lit(5))), F.lit(0).cast("long"), lambda a, b: a + b)
    lines = F.filter(F.split(F.col("__t"), "\n"), lambda x: x.rlike(WORD))
    parts = F.transform("__lines", lambda x: F.struct(x.alias("line"), _words(x).alias("words")))
    counts = lambda p: F.struct(p["line"].alias("line"), F.size(p["words"]).alias("words"), F.length(F.array_join(p["words"], "")).alias("chars"), _count(p["line"], SYMBOLS).alias("symbols"))
    plated = lambda x: x.withField("boilerplate", _is_boilerplate(x))
    judged = F.transform(F.transform(F.transform("__parts", counts), plated), lambda x: x.withField("fails", _fails(x)))
    total = lambda rows, of: F.aggregate(rows, F.lit(0).cast("long"), lambda n, x: n + x[of])
    good = F.filter("__judged", lambda x: ~x["fails"])
    out = docs.withColumn("__t", t).withColumn("__lines", lines).withColumn("__parts", parts).withColumn("__judged", judged)
    out = out.withColumn("__words", hashed).withColumn("__windows", window).withColumn("__ordered", ordered)
    # The row number keeps the optimiser from copying all steps up to here into a later filter on a measure.
    out = out.withColumn("__places", F.when(F.monotonically_increasing_id() >= 0, places))
    out = out.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": total("__judged", "chars"),
            "n_symbols": total("__judged", "symbols"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            "cleaned": F.concat_ws("\n", F.transform(good, lambda x: x["line"])),
            "kept_chars": total(good, "chars"),
            "kept_words": total(good, "words"),
            "exempt_chars": total(F.slice(F.filter("__judged", lambda x: x["boilerplate"]), 1, EXEMPT_LINES), "chars"),
            "boilerplate_chars": total(F.filter("__judged", lambda x: x["boilerplate"]), "chars"),
        }
    )
    out = out.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("kept_chars") > 0) & (F.col("kept_chars") >= (1 - LOSS) * (F.col("word_chars") - F.col("boilerplate_chars"))))
    return out.drop("__t", "__words", "__windows", "__ordered", "__places", "__lines", "__parts", "__judged")


def clean(docs: DataFrame) -> DataFrame:
    """The documents kept that are not mostly boilerplate, their failing lines removed, ``n_chars`` (if any) counted anew;
    the same columns as before."""
    names = [f"__c{k}" for k in range(len(docs.columns))]  # the measures may clash with the table's own names
    place = docs.columns.index("text")
    whole = (F.col("kept_words") >= LEAST_WORDS) & (F.col("kept_chars") >= (1 - LOSS) * (F.col("word_chars") - F.col("exempt_chars")))
    out = measured(docs.toDF(*names), names[place]).where(F.col("kept") & whole).withColumn(names[place], F.col("cleaned"))
    if "n_chars" in docs.columns:
        n = docs.columns.index("n_chars")
        out = out.withColumn(names[n], F.length("cleaned").cast(docs.schema["n_chars"].dataType))
    return out.select(*names).toDF(*docs.columns)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return measured(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_W = r"[^\x20\x09-\x0D]"
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '{_W}+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS ls FROM d),
five AS (SELECT r, i, list_aggregate(ws[i:i+4], 'string_agg', ' ') AS five FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS c FROM five) WHERE c > 1),
cover AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) AS s(k) GROUP BY r),
lines AS (SELECT r, unnest(ls) AS x FROM w),
judged AS (SELECT r, x, length(regexp_replace(x, '{SPACE}', '', 'g')) AS chars, len(regexp_extract_all(x, '{_W}+')) AS words,
  length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS symbols, length(regexp_replace(x, '[^\p{{L}}]', '', 'g')) AS letters,
  length(regexp_replace(x, '[^\p{{Lu}}]', '', 'g')) AS capitals, length(regexp_replace(x, '[^|»•·]', '', 'g')) AS bars FROM lines),
plate AS (SELECT r, sum(chars) AS chars FROM judged WHERE words <= 20 AND regexp_matches(x, '{BOILERPLATE}') GROUP BY r),
good AS (SELECT r, sum(chars) AS chars FROM judged WHERE NOT (symbols * 10 > chars OR (letters >= 10 AND capitals * 2 > letters)
  OR (bars >= 3 AND bars * 4 > words) OR (words <= 20 AND regexp_matches(x, '{BOILERPLATE}'))
  OR (words <= 2 AND NOT regexp_matches(x, '{CLOSED.replace("'", "''")}'))) GROUP BY r),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{SPACE}', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words, coalesce(good.chars, 0) AS kept_chars, coalesce(plate.chars, 0) AS plate_chars
  FROM d JOIN w USING (r) LEFT JOIN cover USING (r) LEFT JOIN good USING (r) LEFT JOIN plate USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
  NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND kept_chars > 0 AND kept_chars >= {1 - LOSS} * (word_chars - plate_chars) AS kept
FROM m
"""
