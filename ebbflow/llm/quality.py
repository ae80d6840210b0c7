"""Quality rules: base text statistics and cross-document line frequency. DataFrame functions only.

**Base statistics** are taken per document from its whole text: words (``[^\\x20\\x09-\\x0D]+``), their code
points, symbols, lines that repeat an earlier one, and words inside five-word windows that occur twice or more.
A document fails with fewer than ten words, or when more than 20 % of its words are in repeated windows.

**Line frequency.** Lines are normalised (lower case, white space runs to one space, digits to 0) and hashed. Per
host, a line is *common* when more than ``max_docs`` distinct documents have it. Exact copies of a text count as one
document. A line also has to stand between different neighbours: the distinct lines before it, or after it, must
be at least ``min_context`` of its documents. A line of a block (notice, licence, menu) has the same neighbours
everywhere; it counts by the lines around the block too: the lines above ``max_docs`` that follow each other in a text are
a run, and the distinct lines before, or after, one run that holds the line may reach that share instead. Copied or lightly edited texts share runs of neighbouring lines; they
are left to near-duplicate detection, which keeps one of them, instead of being removed here with all their copies; edits at
different places give each copy other runs. (Copies that all differ in one and the same line look like a block and count as one.)
Common lines are removed from the text (``clean_text``), and a document is *depleted* when less than ``min_left`` of its
words remain.

Scale: the statistics are one narrow projection. The lines are normalised and hashed once and written as one array per document. For the line counts only hashes travel, one row per line: first
distinct (host, line, text) combinations, spread by all three, then a map-side combined count per (host, line), so a
host with a third of all documents or a line in every document does not meet in one task. The common lines are few;
they go back by a join that Spark plans from measured sizes (broadcast when small, else sort-merge with skew split).

Defined results: null text has no words and fails the base rules. A null host is a host of its own. Repeated rows
are one document in the counts and each keep their row. Extra columns are carried along, and helper columns take names that none of them has. Counts equal to a limit are
not above it. An empty table gives no rows; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import fresh, materialize

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
MAX_DOCS, MIN_CONTEXT, MIN_LEFT = 20, 0.5, 0.2


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _windows(word_hashes: Column, width: int) -> Column:
    """64-bit hashes of the windows of ``width`` words, from the words' hashes; empty below ``width`` words."""
    starts = F.when(F.size(word_hashes) >= width, F.sequence(F.lit(1), F.size(word_hashes) - (width - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(word_hashes, i, width)))


def _placed(hashes: Column) -> Column:
    """(hash, place) of every window in hash order; null where no hash occurs twice."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(hashes) != F.size(F.array_distinct(hashes)), placed)


def _repeated(placed: str) -> Column:
    """Places, in text order, of the windows whose hash occurs twice or more."""
    # ``placed`` is a column of its own: an expression inside a lambda is evaluated again for every element.
    at = F.transform(
        placed,
        lambda x, k: F.when((F.get(placed, k - 1)["h"] == x["h"]) | (F.get(placed, k + 1)["h"] == x["h"]), x["i"]),
    )
    return F.array_sort(F.filter(at, lambda i: i.isNotNull()))


def _covered(starts: str, width: int) -> Column:
    """Words inside the windows that begin at ``starts``."""
    gaps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.coalesce(F.least(F.lit(width), b - a), F.lit(width)))
    return F.coalesce(F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g), F.lit(0).cast("long"))


def base_columns(text: Column, word_list: Column) -> dict[str, Column]:
    """The base statistics that need no windows."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "word_chars": F.length(F.array_join(word_list, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOL, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def base_statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` plus one struct column with the base statistics; also returns its name."""
    out, w, h = fresh(docs, "base"), fresh(docs, "word_list"), fresh(docs, "window_hashes")
    p, r, e = fresh(docs, "window_places"), fresh(docs, "repeats"), fresh(docs, "word_hashes")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    step = docs.withColumn(w, words(text)).withColumn(e, F.transform(w, lambda x: F.xxhash64(x))).withColumn(h, _windows(F.col(e), WINDOW)).withColumn(p, _placed(F.col(h))).withColumn(r, _repeated(p))
    n_words, repeat = F.size(w).cast("long"), _covered(r, WINDOW)
    base = F.struct(n_words.alias("n_words"), *(c.alias(name) for name, c in base_columns(text, F.col(w)).items()), repeat.alias("n_repeat_words"))
    # One row from an array of one: a filter on the statistics is then not pushed down and written out again inside the
    # lambdas above, where it would be evaluated for every element.
    step = step.select("*", F.explode(F.array(base)).alias(out))
    failed = (F.col(f"{out}.n_words") < MIN_WORDS) | (100 * F.col(f"{out}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{out}.n_words"))
    step = step.withColumn(out, F.col(out).withField("base_failed", failed))
    return step.drop(w, e, h, p, r), out


def normalised(line: Column) -> Column:
    """The form in which lines are compared."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), SPACE, " ")), r"[0-9]", "0")


def host_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per line with a word: host, text id, line hash, words, place, hashes of the lines before and after."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    lines = F.filter(F.transform(F.split(text, "\n"), normalised), lambda x: x != "")
    one = docs.select(
        F.coalesce(F.concat(F.lit("h"), F.col(f"`{host_col}`").cast("string")), F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_id"),
        lines.alias("lines"),
    )
    hashed = F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).alias("n_words")))
    one = materialize(one.select("host", "text_id", hashed.alias("lines")), "hashed-lines")  # read three times
    placed = F.transform(
        "lines",
        lambda x, i: F.struct(
            x["line"].alias("line"),
            x["n_words"].alias("n_words"),
            i.alias("place"),
            F.when(i > 0, F.get("lines", i - 1)["line"]).alias("before"),
            F.get("lines", i + 1)["line"].alias("after"),
        ),
    )
    return one.select("host", "text_id", F.inline(placed))


def common_lines(lines: DataFrame, max_docs: int = MAX_DOCS, min_context: float = MIN_CONTEXT) -> DataFrame:
    """(host, line, n_docs) of the lines above the limit."""
    counted = lines.groupBy("host", "line").agg(
        F.count_distinct("text_id").alias("n_docs"),
        F.count_distinct("before").alias("n_before"),
        F.count_distinct("after").alias("n_after"),
    )
    above = materialize(counted.filter(F.col("n_docs") > max_docs), "lines-above-limit")
    around = F.greatest("n_before", "n_after", F.coalesce("n_around", F.lit(0)))
    return above.join(_around_runs(lines, above), ["host", "line"], "left").filter(around >= min_context * F.col("n_docs")).select("host", "line", "n_docs")


def _around_runs(lines: DataFrame, above: DataFrame) -> DataFrame:
    """host, line, n_around: most distinct lines before, or after, any one run of lines of ``above`` that holds the line."""
    found = lines.join(above.select("host", "line"), ["host", "line"])
    found = found.groupBy("host", "text_id", "place").agg(*[F.first(c).alias(c) for c in ("line", "before", "after")])  # copies once
    in_text = Window.partitionBy("host", "text_id").orderBy("place")
    found = found.withColumn("run", F.col("place") - F.row_number().over(in_text))  # the same for consecutive places
    held = F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]).alias("held")
    runs = found.groupBy("host", "text_id", "run").agg(held, F.min_by("before", "place").alias("before"), F.max_by("after", "place").alias("after"))
    runs = runs.select("host", F.xxhash64("held").alias("run"), "held", "before", "after")
    spread = runs.groupBy("host", "run").agg(F.count_distinct("before").alias("b"), F.count_distinct("after").alias("a"))
    each = runs.groupBy("host", "run").agg(F.first("held").alias("held")).join(spread, ["host", "run"])
    return each.select("host", F.explode("held").alias("line"), F.greatest("a", "b").alias("n")).groupBy("host", "line").agg(F.max("n").alias("n_around"))


def depleted_texts(lines: DataFrame, common: DataFrame, min_left: float = MIN_LEFT) -> DataFrame:
    """(host, text_id, left) of the texts of which less than ``min_left`` of the words remain."""
    # Repeated rows of a text scale both sums alike, so the ratio is that of the text.
    marked = lines.select("host", "text_id", "line", "n_words").join(common.select("host", "line", F.lit(True).alias("common")), ["host", "line"], "left")
    total = F.sum(F.col("n_words").cast("long"))
    kept = F.sum(F.when(F.col("common"), F.lit(0)).otherwise(F.col("n_words")).cast("long"))
    sums = marked.groupBy("host", "text_id").agg(kept.alias("kept_words"), total.alias("all_words"))
    return sums.filter(F.col("kept_words") < min_left * F.col("all_words")).select("host", "text_id", (F.col("kept_words") / F.col("all_words")).alias("left"))


def judge(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    max_docs: int = MAX_DOCS,
    min_context: float = MIN_CONTEXT,
    min_left: float = MIN_LEFT,
) -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` plus a struct column: the base statistics, ``left`` (share of words that
    remain, null when not depleted) and ``kept``. Also returns the column's name."""
    lines = host_lines(docs, host_col, text_col)
    gone = depleted_texts(lines, common_lines(lines, max_docs, min_context), min_left)
    based, b = base_statistics(docs, text_col)
    h, t, left = fresh(based, "host_key"), fresh(based, "text_key"), fresh(based, "left_share")
    keyed = based.withColumn(h, F.coalesce(F.concat(F.lit("h"), F.col(f"`{host_col}`").cast("string")), F.lit(""))).withColumn(
        t, F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    )
    gone = gone.select(F.col("host").alias(h), F.col("text_id").alias(t), F.col("left").alias(left))
    out = keyed.join(gone, [h, t], "left")
    verdict = F.col(b).withField("left", F.col(left)).withField("kept", ~F.col(f"{b}.base_failed") & F.col(left).isNull())
    return out.withColumn(b, verdict).select(*[F.col(f"`{c}`") for c in docs.columns], F.col(b)), b


def remove_common_lines(docs: DataFrame, common: DataFrame, host_col: str = "source", text_col: str = "text", name: str = "clean_text") -> DataFrame:
    """``docs`` plus ``clean_text``: the text without the host's common lines. The different lines of a text meet ``common`` in a join by (host,
    line); what a text has of them returns to its rows as one array, never longer than the text has lines."""
    key, found, gone = fresh(docs, "host_key"), fresh(docs, "text_key"), fresh(docs, "common_lines")
    text = F.col(f"`{text_col}`").cast("string")
    host = F.coalesce(F.concat(F.lit("h"), F.col(f"`{host_col}`").cast("string")), F.lit(""))
    keyed = docs.withColumn(key, host).withColumn(found, F.xxhash64(F.coalesce(text, F.lit(""))))
    own = host_lines(docs, host_col, text_col).join(common.select("host", "line"), ["host", "line"])
    own = own.groupBy(F.col("host").alias(key), F.col("text_id").alias(found)).agg(F.collect_set("line").alias(gone))
    kept = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(gone, F.xxhash64(normalised(x))))
    joined = keyed.join(own, [key, found], "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.when(F.col(gone).isNull(), text).otherwise(F.concat_ws("\n", kept)).alias(name))


def quality_report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The report of the contract: one row per document."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col("text"), F.col("source"))
    judged, b = judge(source, **options)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[F.col(f"{b}.{n}").alias(n) for n in names])


def passing(docs: DataFrame, **options) -> DataFrame:
    """The documents that the rules keep, all columns unchanged."""
    judged, b = judge(docs, **options)
    return judged.filter(F.col(f"{b}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
