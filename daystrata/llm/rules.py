"""Quality rules: a table of thresholds compiled into one projection of Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Windows of so many words that come twice count as repetition.
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``per`` times ``measure`` must lie between the bounds times ``base``; whole numbers only, so
    that no ratio is ever rounded or divided by zero."""

    measure: str
    base: str
    per: int = 1
    least: int | None = None
    most: int | None = None


#: English, German, French and Spanish stop words.
STOP_WORDS = (
    "the be to of and that have with a in is it for on as by this "
    "der die das und ist von zu den mit nicht ein "
    "le la les de des et un une en que qui dans pour "
    "el los las y del se por con su para"
).split(" ")

#: The thresholds. Measures are listed in ``measures``.
RULES = (
    Rule("word_chars", "n_words", least=2, most=15),
    Rule("n_symbols", "n_words", per=100, most=30),
    Rule("n_dup_lines", "n_lines", per=100, most=50),
    Rule("n_stop_words", "n_words", per=100, least=1),
    Rule("n_upper_words", "n_words", per=100, most=50),
    Rule("n_exclaimed", "n_words", per=100, most=50),
    Rule("n_piped_lines", "n_lines", per=100, most=60),
)

_SPACES = " \t\n\x0b\x0c\r"


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and every measure a rule may name, all ``bigint``.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (with a word), ``n_dup_lines``,
    ``n_repeat_words``, ``n_stop_words``, ``n_upper_words``, ``n_exclaimed``, ``n_piped_lines``.
    Narrow: one row in, one row out, no shuffle; work and memory grow with a text's length.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    spaced = F.translate(text, _SPACES, " " * len(_SPACES))
    worded = F.filter(
        F.split(text, "\n"), lambda line: F.ltrim(F.translate(line, _SPACES, " " * 6)) != ""
    )
    split = docs.select(
        doc_id,
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).alias("n_symbols"),
        F.length(F.translate(text, _SPACES, "")).alias("word_chars"),
        F.filter(F.split(spaced, " "), lambda word: word != "").alias("words"),
        worded.alias("lines"),
    )

    def count(array: str, test) -> Column:
        return F.size(F.filter(array, test))

    counted = split.select(
        "doc_id",
        "n_symbols",
        "word_chars",
        F.size("words").alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        count("words", lambda w: F.lower(w).isin(*STOP_WORDS)).alias("n_stop_words"),
        count("words", lambda w: w.rlike("^[^a-z]*[A-Z][^a-z]*$")).alias("n_upper_words"),
        count("words", lambda w: F.contains(w, F.lit("!!"))).alias("n_exclaimed"),
        count("lines", lambda line: F.contains(line, F.lit("|"))).alias("n_piped_lines"),
        # Each word once as a number: a window is then one hash of eight numbers.
        F.transform("words", lambda word: F.xxhash64(word)).alias("codes"),
    )
    starts = F.sequence(F.lit(0), F.size("codes") - WINDOW)
    window = lambda i: F.xxhash64(*[F.get("codes", i + k) for k in range(WINDOW)])
    windowed = counted.withColumn(
        "windows", F.when(F.size("codes") > WINDOW, F.transform(starts, window))
    ).drop("codes")
    # Sorted by hash, equal windows are neighbours; most texts have none and skip the sort.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda code, i: F.struct(code.alias("code"), i.alias("i")))
    ordered = windowed.withColumn("ordered", F.when(repeats, F.array_sort(placed))).drop("windows")

    def twice(pair: Column, k: Column) -> Column:
        near = [F.get("ordered", k + step)["code"] == pair["code"] for step in (-1, 1)]
        return F.coalesce(near[0], F.lit(False)) | F.coalesce(near[1], F.lit(False))

    found = F.transform(F.filter("ordered", twice), lambda pair: pair["i"])
    starting = ordered.withColumn("found", F.array_sort(found)).drop("ordered")
    # Each repeated window covers the words up to the next one, its whole length at most.
    covered = F.aggregate(
        F.transform(
            "found",
            lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("found", k + 1) - i, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda total, step: total + step,
    )
    names = (
        "n_words word_chars n_symbols n_lines n_dup_lines n_stop_words n_upper_words n_exclaimed "
        "n_piped_lines"
    ).split(" ")
    return starting.select(
        "doc_id",
        *[F.col(name).cast("bigint").alias(name) for name in names],
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def passes(rules: Sequence[Rule]) -> Column:
    """The rule table as one boolean expression over the measures."""
    tests = F.lit(True)
    for rule in rules:
        value, base = F.col(rule.measure) * rule.per, F.col(rule.base)
        if rule.least is not None:
            tests &= value >= base * rule.least
        if rule.most is not None:
            tests &= value <= base * rule.most
    return tests


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measures of every row, ``base_failed`` and ``kept``.

    Null text counts as empty: no words, so it fails. A text of any length is judged whole. Values on a
    bound pass. Repeated rows stay; an empty table gives no rows; other columns are ignored. Windows
    are compared by 64-bit hashes within one text.
    """
    found = measures(docs)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & passes(rules)
    )


def judge_sql(rules: Sequence[Rule] = RULES) -> str:
    """The same in DuckDB, over ``documents``, windows compared word by word."""
    tests = []
    for rule in rules:
        value = f"{rule.per} * {rule.measure}"
        if rule.least is not None:
            tests.append(f"{value} >= {rule.least} * {rule.base}")
        if rule.most is not None:
            tests.append(f"{value} <= {rule.most} * {rule.base}")
    stops = ", ".join(f"'{word}'" for word in STOP_WORDS)
    return f"""
    with base as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
    split as (select r, doc_id, text,
        regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
      from base),
    windows as (select r, unnest(range(len(words) - {WINDOW - 1})) as i, words from split
      where len(words) > {WINDOW}),
    keyed as (select r, i, array_to_string(words[i + 1:i + {WINDOW}], ' ') as w from windows),
    twice as (select r, i from keyed qualify count(*) over (partition by r, w) > 1),
    steps as (select r, least({WINDOW}, coalesce(lead(i) over (partition by r order by i) - i, {WINDOW}))
      as step from twice),
    covered as (select r, sum(step)::bigint as n from steps group by r),
    found as (select doc_id, len(words)::bigint as n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        len(lines)::bigint as n_lines,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        len(list_filter(words, lambda x: lower(x) in ({stops})))::bigint as n_stop_words,
        len(list_filter(words, lambda x: regexp_matches(x, '^[^a-z]*[A-Z][^a-z]*$')))::bigint
          as n_upper_words,
        len(list_filter(words, lambda x: contains(x, '!!')))::bigint as n_exclaimed,
        len(list_filter(lines, lambda x: contains(x, '|')))::bigint as n_piped_lines,
        coalesce(n, 0)::bigint as n_repeat_words
      from split left join covered using (r)),
    failed as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from found)
    select *, not base_failed and {" and ".join(tests)} as kept from failed
    """
