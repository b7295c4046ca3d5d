"""Quality rules: counts of each text, and how many documents of a host share its lines. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import every, private, saved

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class LineLimits:
    """A line goes if more different texts of its host hold it than `texts` and than `share` of the host's texts.

    A document is depleted if a removal leaves less than `left` of its words, or fewer than `least`: so many the base rules ask for.
    """

    texts: int = 20
    share: float = 0.002
    left: float = 0.5
    least: int = 50


def _lines(text: Column) -> Column:
    """Hash and number of words of each line, blank ones too: in lower case, digits as 0, white space as single spaces."""
    flat = F.regexp_replace(F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " "), "[0-9]+", "0")
    words = lambda x: F.when(x == "", 0).otherwise(F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1)
    return F.transform(F.transform(F.split(flat, "\n"), F.trim), lambda x: F.struct(F.xxhash64(x).alias("line"), words(x).alias("n")))


def _repeat_words() -> Column:
    """Words in three-word windows found twice, from `places`: the windows' hashes and starts, sorted."""
    same = F.expr("""filter(places, (x, j) -> coalesce(get(places, j - 1).gram = x.gram, false) or coalesce(get(places, j + 1).gram = x.gram, false))""")
    starts = F.sort_array(F.transform(same, lambda x: x.start))
    merge = lambda a, s: F.struct(s.alias("last"), (a.n + F.least(F.lit(3), s - a["last"])).alias("n"))
    return F.aggregate(starts, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), merge, lambda a: a.n).cast("long")


def base_counts(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed; a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    out = docs.withColumns({"words": F.filter(F.split(text, SPACE), lambda w: w != ""), "lines": lines})
    out = out.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "places": F.expr("sort_array(transform(words, (w, k) -> named_struct('gram', if(k + 2 < size(words), xxhash64(w, get(words, k + 1), get(words, k + 2)), null), 'start', k)))"),
    })
    out = out.withColumn("places", F.filter("places", lambda x: x.gram.isNotNull())).withColumn("n_repeat_words", _repeat_words())
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("words", "lines", "places")


def _judged(docs: DataFrame, limits: LineLimits) -> DataFrame:
    """Of every row: doc_id, host, text_hash, the base counts, lines to remove, kept. Written once, so that text is parsed once."""
    rows = base_counts(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), "text"))
    lines = F.filter(_lines(F.coalesce("text", F.lit(""))), lambda x: x.n > 0)
    rows = saved(rows.withColumns({"row": F.monotonically_increasing_id(), "text_hash": F.xxhash64("text"), "held": lines}).drop("text"))
    texts = rows.groupBy("host").agg(F.count_distinct("text_hash").alias("texts"))
    once = rows.select("host", "text_hash", F.explode(F.array_distinct(F.transform("held", lambda x: x.line))).alias("line"))
    counted = once.groupBy("host", "line").agg(F.count_distinct("text_hash").alias("holders")).where(F.col("holders") > limits.texts)
    # A table, so that Spark knows its size and broadcasts it only if it is small.
    common = saved(counted.join(texts, "host").where(F.col("holders") > limits.share * F.col("texts")).select("host", "line"))
    placed = rows.select("row", "host", F.explode("held").alias("x")).select("row", "host", "x.line", "x.n")
    removed = placed.join(common, ["host", "line"]).groupBy("row").agg(F.sum("n").alias("gone"), F.collect_set("line").alias("removed_lines"))
    out = rows.drop("held").join(removed, "row", "left").withColumn("n_removed", F.coalesce("gone", F.lit(0)).cast("long"))
    stay = F.col("n_words") - F.col("n_removed")
    depleted = (F.col("n_removed") > 0) & ((stay < limits.left * F.col("n_words")) | (stay < limits.least))
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def quality_rules(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """doc_id, the base counts, base_failed, n_removed, kept of every row of docs(doc_id, text, source, ...).

    Lines of any length are normalised and hashed; different texts (copies count once) are counted for each host and line.
    Lines above the limits are removed, and a document that is depleted by it is rejected. The host of a document is its
    source; a null one is the empty host. Null and empty texts have no word and fail; so do very short ones. Rows that
    repeat a document get the same verdict. Other columns are not read.
    """
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed", "kept"]
    return _judged(docs, limits).select(*columns)


def apply_quality_rules(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """docs without rejected documents, and without the common lines in those that stay; n_chars follows if there is one.

    All columns stay, whatever their names.
    """
    doc, host, text_hash, gone = private(docs.columns, "_doc", "_host", "_hash", "_gone")
    verdicts = _judged(docs, limits).where("kept").select(F.col("doc_id").alias(doc), F.col("host").alias(host), F.col("text_hash").alias(text_hash), F.col("removed_lines").alias(gone))
    verdicts = verdicts.dropDuplicates([doc, host, text_hash])
    joined = docs.join(verdicts, docs["doc_id"].eqNullSafe(F.col(doc)) & (F.coalesce(docs["source"], F.lit("")) == F.col(host)) & F.xxhash64(docs["text"]).eqNullSafe(F.col(text_hash)))
    left = F.filter(F.arrays_zip(F.split("text", "\n").alias("raw"), _lines(F.col("text")).alias("held")), lambda x: ~F.array_contains(gone, x.held.line))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda x: x.raw), "\n"))
    out = joined.withColumn("text", text).select(*every(docs))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
