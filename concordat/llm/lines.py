"""Line-first cleaning with built-in functions only: rules drop lines, then documents that lost too much text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases of menus and page furniture in English, German, French and Spanish; a short line that holds one is boilerplate.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "sign up",
    "log in",
    "subscribe to our",
    "share this",
    "read more",
    "skip to content",
    "powered by",
    "enable javascript",
    "alle rechte vorbehalten",
    "hier klicken",
    "jetzt anmelden",
    "zum inhalt springen",
    "tous droits réservés",
    "politique de confidentialité",
    "mentions légales",
    "cliquez ici",
    "todos los derechos reservados",
    "política de privacidad",
    "aviso legal",
    "haga clic aquí",
)
#: Fixed value: marks with which a sentence, a quotation or the head of a list ends.
ENDS = r"""[.!?…:;"'»”’)\]]"""
#: Fixed value: characters that prose hardly uses.
SYMBOLS = r"[#*$%&|<>{}~^=]"


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words between ASCII white space; plain replacements, as they cost a third of splitting by a pattern."""
    for space in "\n\t\r\x0b\x0c":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def windows(ws: Column, width: int) -> Column:
    """A 64-bit hash for each window of width words (a power of two): hashes of words, then of pairs of hashes 1, 2, 4 ... apart."""

    def doubled(hashes: Column, step: int) -> Column:
        if step == width:
            return F.slice(hashes, F.lit(1), F.size(hashes) - (width - 1))
        return let(F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + step))), lambda h: doubled(h, 2 * step))

    return F.when(F.size(ws) >= width, let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: doubled(h, 1))).otherwise(F.array().cast("array<bigint>"))


def repeated_words(windows: Column, width: int) -> Column:
    """Words in windows found twice or more: sorts (window, place), keeps places whose window has an equal neighbour, and adds up the union of their spans."""

    def covered(sorted_: Column) -> Column:
        places = F.transform(
            F.filter(sorted_, lambda x, i: (F.get(sorted_, i - 1)["w"] == x["w"]) | (F.get(sorted_, i + 1)["w"] == x["w"])),
            lambda x: x["at"],
        )
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            F.sort_array(places),
            start,
            lambda acc, p: F.struct((acc["n"] + width - F.greatest(acc["end"] - p, F.lit(0))).cast("int").alias("n"), (p + width).cast("int").alias("end")),
            lambda acc: acc["n"],
        )

    pairs = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("at")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(F.sort_array(pairs), covered))


def line_fails(line: Column, min_words: int, symbol_share: float, upper_share: float) -> Column:
    """The rules on one line with a word. Navigation: half as many bars as words, from three bars. Punctuation: symbols
    make up a share of its characters beyond symbol_share, or fewer than min_words words end without one of ENDS. Capitals: beyond upper_share of the characters of a line of at
    least min_words words. Boilerplate: a phrase of BOILERPLATE on a line of at most 20 words."""
    bars = F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    capitals = F.regexp_count(line, F.lit(r"\p{Lu}"))
    return let(
        words(line),
        lambda ws: ((bars >= 3) & (2 * bars >= F.size(ws) - bars))
        | (symbols > symbol_share * F.length(line))
        | ((F.size(ws) < min_words) & ~line.rlike(ENDS + r"[\x20\x09-\x0D]*$"))
        | ((F.size(ws) >= min_words) & (capitals > upper_share * F.length(F.array_join(ws, ""))))
        | ((F.size(ws) <= 20) & boilerplate(line)),
    )


def boilerplate(text: Column) -> Column:
    return let(F.lower(text), lambda t: reduce(lambda a, b: a | b, (t.contains(p) for p in BOILERPLATE)))


def suspect(text: Column, min_words: int) -> Column:
    """Whether a line of the text can fail: it has a symbol, a phrase, a line of few words, or two capitals with only white space between (a
    line of which most characters are capitals has two such). Spares clean texts the rules; never changes a verdict
    while upper_share is at least one half."""
    space, other = r"[\x20\x09\x0B-\x0D]", r"[^\x20\x09-\x0D]"
    few = rf"(?:^|\n){space}*{other}+(?:{space}+{other}+){{0,{max(0, min_words - 2)}}}{space}*(?:\n|$)"
    return text.rlike(SYMBOLS) | text.rlike(r"\p{Lu}[\x20\x09-\x0D]*\p{Lu}") | text.rlike(few) | boilerplate(text)


def clean_lines(
    docs: DataFrame, min_words: int = 20, repeat_percent: int = 30, width: int = 8, line_words: int = 3, symbol_share: float = 0.1, upper_share: float = 0.5, lost_share: float = 0.5
) -> DataFrame:
    """docs (doc_id, text, ...) with the counts of the base rules, the cleaned text and the verdict.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept (boolean), clean_text
    (lines that pass, joined by a newline) and lost_chars (long). kept: not base_failed, and lines that fail hold at most
    lost_share of the characters in words. A null text has no words: counts are 0, it fails, clean_text is empty. Columns of
    docs that have one of these names are replaced; others pass through. No shuffle: every row is judged alone, whatever
    its neighbours, so repeated rows get equal results.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    fresh = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text", "lost_chars")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    ws = words(text)
    counts = let(
        ws,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            let(windows(w, width), lambda x: repeated_words(x, width)).cast("long").alias("n_repeat_words"),
        ),
    )
    by_line = let(
        lines,
        lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(x).alias("n"),
            F.when(suspect(text, line_words) if upper_share >= 0.5 and symbol_share >= 0 else F.lit(True), F.filter(x, lambda y: ~line_fails(y, line_words, symbol_share, upper_share))).otherwise(x).alias("good"),
        ),
    )
    kept_columns = [c for c in docs.columns if c.lower() not in fresh]
    step = docs.select(*(F.col(f"`{c}`") for c in kept_columns), counts.alias("__counts"), by_line.alias("__lines"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    step = step.select(
        *(F.col(f"`{c}`") for c in kept_columns),
        "__counts.n_words",
        "__counts.word_chars",
        "n_symbols",
        "__lines.n_dup_lines",
        "__counts.n_repeat_words",
        F.array_join("__lines.good", "\n").alias("clean_text"),
        (F.col("__counts.word_chars") - F.when(F.size("__lines.good") < F.col("__lines.n"), F.length(F.array_join(words(F.array_join("__lines.good", "\n")), ""))).otherwise(F.col("__counts.word_chars"))).cast("long").alias("lost_chars"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return step.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") <= lost_share * F.col("word_chars")))
