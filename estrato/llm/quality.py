"""Quality rules: a table of thresholds compiled into one projection of native functions.

Null text counts as a text without words. A ratio whose denominator is 0 passes. Repeated
rows are judged each for itself, long texts as a whole; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from estrato.llm.common import SPACE

WINDOW = 8

# Frequent short words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that it for on with as was at by be this have from or "
    "le la les de des et en un une que qui dans pour du est au "
    "der die das und zu den von mit ist nicht ein eine auf sich "
    "el los y una por con para es del las se"
).split()


@dataclass(frozen=True)
class Rule:
    """least <= 1000 * part / whole <= most; either limit may be missing."""

    part: str
    whole: str
    least: int | None = None
    most: int | None = None

    def holds(self) -> Column:
        part, whole = F.col(self.part) * 1000, F.col(self.whole)
        tests = [part >= self.least * whole] if self.least is not None else []
        tests += [part <= self.most * whole] if self.most is not None else []
        return reduce(lambda a, b: a & b, tests)


RULES = (
    Rule("word_chars", "n_words", least=1_500, most=20_000),
    Rule("n_symbols", "n_words", most=300),
    Rule("n_dup_lines", "n_lines", most=500),
    Rule("n_marked_lines", "n_lines", most=900),
    Rule("n_stop_words", "n_words", least=20),
)
COUNTS = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_marked_lines n_stop_words n_repeat_words"
).split()


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the struct `quality` of the counts that the rules use."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim("t", F.lit(SPACE))
    word = F.when(bare != "", F.split(bare, r"[\x20\x09-\x0D]+")).otherwise(F.array())
    line = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), whole.alias("t"))
    rows = rows.select("row", "t", word.alias("w"), line.alias("l"))
    rows = rows.select(
        "row", "w",
        F.size("w").alias("n"),
        F.char_length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).alias("symbols"),
        F.size("l").alias("lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).alias("again"),
        F.size(F.filter("l", lambda x: x.rlike(r"^[\x20\x09]*[-*•]"))).alias("marked"),
    )
    stops = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    rows = rows.select(
        "row", "n", "symbols", "lines", "again", "marked",
        F.char_length(F.array_join("w", "")).alias("chars"),
        F.size(F.filter("w", lambda w: w.isin(*stops))).alias("stop"),
        F.when(F.col("n") >= WINDOW, F.transform("w", lambda w: F.xxhash64(w))).alias("h"),
    )
    # Hashes of 1, 2, 4 and then 8 words from each word on; the last 7 are no windows.
    for step in (1, 2, 4):
        ahead = F.slice("h", step + 1, F.greatest(F.size("h"), F.lit(0)))
        rows = rows.withColumn("h", F.zip_with("h", ahead, lambda a, b: F.xxhash64(a, b)))
    rows = rows.withColumn("h", F.slice("h", 1, F.col("n") - (WINDOW - 1)))
    # A generator evaluates the counts once; a filter above would else be pushed below the
    # projections and repeat them all.
    counts = F.struct(*[
        F.col(c).cast("long").alias(name)
        for name, c in zip(
            COUNTS, ["n", "chars", "symbols", "lines", "again", "marked", "stop", "covered"]
        )
    ])
    rows = _with_repeats(rows).select("row", F.explode(F.array(counts)).alias("quality"))
    return rows.select("row.*", "quality")


def _with_repeats(rows: DataFrame) -> DataFrame:
    """Adds `covered`: words inside windows that occur twice or more. Windows are sorted by
    hash, equal neighbours picked and the union of their places summed; the first test
    spares texts without a repeated window, which are nearly all."""
    sort = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    rows = rows.withColumn("s", F.when(F.size(F.array_distinct("h")) < F.size("h"), sort))
    twins = F.filter(
        "s",
        lambda x, j: F.coalesce(x["h"] == F.get("s", j - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("s", j + 1)["h"], F.lit(False)),
    )
    rows = rows.withColumn("p", F.sort_array(F.transform(twins, lambda x: x["i"])))
    steps = F.zip_with(
        F.slice("p", 2, F.size("p")), F.slice("p", 1, F.size("p")),
        lambda b, a: F.least(F.lit(WINDOW), b - a),
    )
    covered = F.aggregate(steps, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(WINDOW)))
    return rows.withColumn("covered", F.coalesce(covered, F.lit(0)))


def base_failed() -> Column:
    """The fixed test: too few words, or too many of them repeated."""
    q = F.col("quality")
    return (q["n_words"] < 20) | (100 * q["n_repeat_words"] > 30 * q["n_words"])


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows with their counts, `base_failed` and `kept`."""
    return measured(docs, text).withColumns(
        {"base_failed": base_failed(), "kept": verdict(rules)}
    )


def verdict(rules: tuple[Rule, ...]) -> Column:
    tests = [
        Rule(f"quality.{r.part}", f"quality.{r.whole}", r.least, r.most).holds() for r in rules
    ]
    return ~base_failed() & reduce(lambda a, b: a & b, tests, F.lit(True))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Only the rows that pass, with the columns they came with."""
    return judged(docs, rules).filter("kept").select(*docs.columns)
