"""Line-first quality rules, in DataFrame functions only.

Each line is judged by itself (punctuation, navigation, boilerplate), failing lines are removed, and a document
that loses too much of its text is rejected. All of it happens inside a row, so there is no shuffle and no key
that could be hot; memory is bounded by the longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import one_row

#: White space of the contract, its symbols, and the rules' word lists.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BOILERPLATE = ("all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies", "click here", "subscribe to our newsletter", "licensed under the", "copyright (c)", "javascript is disabled", "javascript is required")
NAVIGATION = ("home", "menu", "login", "sign in", "sign up", "search", "next", "previous", "back to top", "skip to content", "share", "contact us", "about us")
#: A text without any of these has no line that fails for its separators or symbols.
MARKS = ("|", "›", "»", "·", "!!", "#", "*", "$", "%", "&", "<", ">")
WINDOW = 8


def menu_entry(line: Column) -> Column:
    return (F.length(line) <= 30) & F.lower(F.trim(line)).isin(*NAVIGATION)


def line_verdicts(line: Column) -> dict[str, Column]:
    """Rule name -> whether the line fails it.

    navigation: three or more separators of a menu (|, ›, », ·), at least one for every four words, or a menu entry alone.
    punctuation: eight words or more of which over a quarter carry a symbol of SYMBOLS, or over a quarter end in two exclamation marks.
    boilerplate: a phrase of BOILERPLATE.
    """
    words = F.size(F.split(F.trim(line), SPACE))
    bars = F.regexp_count(line, F.lit(r"[|›»·]"))
    return {
        "navigation": ((bars >= 3) & (bars * 4 >= words)) | menu_entry(line),
        "punctuation": (words >= 8) & ((F.regexp_count(line, F.lit(r"[#*$%&<>]+(?=\s|[.,;:!?]|$)")) * 4 > words) | (F.regexp_count(line, F.lit("!!")) * 4 > words)),
        "boilerplate": _any({p: F.lower(line).contains(p) for p in BOILERPLATE}),
    }


def repeat_words(hashes: Column, window: int) -> Column:
    """Words inside windows whose hash occurs twice or more; hashes[i] is that of the window at word i."""
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        same = lambda k, d: F.coalesce(F.get(s, k + d)["h"] == F.get(s, k)["h"], F.lit(False))
        starts = F.array_sort(F.transform(F.filter(s, lambda x, k: same(k, -1) | same(k, 1)), lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(starts, zero, lambda a, i: F.struct((i + window).alias("end"), (a["n"] + (i + window) - F.greatest(i, a["end"])).alias("n")), lambda a: a["n"])

    # a lambda over a one-element array binds the sorted array once
    return F.element_at(F.transform(F.array(ordered), covered), 1)


def quality_rules(docs: DataFrame, text: str = "text", *, min_words: int = 20, max_repeat_pct: int = 30, keep_pct: int = 50) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines_failed, cleaned, base_failed, kept.

    kept: not base_failed, and at least keep_pct percent of the text's characters stay in `cleaned`, the lines that pass.
    Null and empty texts have no words, fail and are cleaned to "". Repeated rows are judged one by one. Columns of
    docs keep their names and values; any that clash with the result's are replaced by the result's.
    """
    keep = [c for c in docs.columns if c not in RESULT]
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, one_row(_w=F.array_remove(F.split(t, SPACE), ""), _low=F.lower(t)))
    n = F.size("_w")
    # hashes of windows of 2, 4 and 8 words, each made of two of the one before; the last only where windows of 4 repeat
    step = lambda a, d: F.transform(a, lambda h, i: F.xxhash64(h, F.get(F.col(a), i + d)))
    rows = rows.select("*", one_row(_h2=step("_w", 1))).select("*", one_row(_h4=step("_h2", 2)))
    doubled = F.size(F.array_distinct("_h4")) < n
    rows = rows.select("*", one_row(_h8=F.when(doubled & (n >= WINDOW), F.slice(step("_h4", 4), F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))))))
    # a line can only fail where the text has what the rules look for
    lines = F.split(t, "\n")
    suspect = _any({p: t.contains(p) for p in MARKS} | {p: F.col("_low").contains(p) for p in BOILERPLATE})
    good = F.when(suspect, F.filter(lines, lambda x: ~F.coalesce(_any(line_verdicts(x)), F.lit(False)))).otherwise(F.filter(lines, lambda x: ~menu_entry(x)))
    rows = rows.select("*", one_row(_wl=F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]")), _good=good))
    repeats = F.when(F.size("_h8") > F.size(F.array_distinct("_h8")), repeat_words(F.col("_h8"), WINDOW)).otherwise(F.lit(0).cast("long"))
    out = rows.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_wl") - F.size(F.array_distinct("_wl"))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        (F.size(lines) - F.size("_good")).cast("long").alias("lines_failed"),
        F.array_join("_good", "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (100 * F.length("cleaned") >= keep_pct * F.length(t)))


RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines_failed", "cleaned", "base_failed", "kept")


def _any(found: dict[str, Column]) -> Column:
    out = F.lit(False)
    for c in found.values():
        out = out | c
    return out
