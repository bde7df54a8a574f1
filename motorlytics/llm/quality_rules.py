"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Metrics come from built-in expressions over the words and lines of a text, nested in one expression that computes each part
once. Stop words judge only the languages that have a list, and word lengths only scripts with spaces. Each row of ``RULES`` names a metric and the range it must stay in; ``verdict`` turns the table into one Boolean
expression. The same table gives the SQL of the check, for texts of the listed languages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm.common import let, table

# The base rule.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

# Frequent words of English, German, French and Spanish: what the stop-word bound can judge.
STOP_WORDS = ("the of and to in a is that it for on was be with as by this are der die und den von zu das mit des auf "
              "ist ein le la les et en un une du de que el los las y por con para se del al est pour dans").split()

# metric, least, most (None: open). A metric is a ratio of counts, so the rules don't depend on length; the bounds are wide
# enough that prose stays. ``UNJUDGED`` names the texts that a bound says nothing about.
RULES = (
    ("n_words", LEAST_WORDS, None),
    ("symbols_per_word", None, 0.2),
    ("mean_word_chars", 2.0, 15.0),
    ("stop_word_ratio", 0.02, None),
    ("capital_word_ratio", None, 0.5),
    ("duplicate_line_ratio", None, 0.5),
)
# Signs of a language without stop words above: letters that the four languages don't have, or its own frequent words.
OTHER_LETTERS = r"[^\p{L}]|[\x00-\x7FäöüßàâæçéèêëîïôœùûÿñáíóúÄÖÜẞÀÂÆÇÉÈÊËÎÏÔŒÙÛŸÑÁÍÓÚºª]"
OTHER_WORDS = ("ja ei hän että joka oli mutta kun niin kui ning és egy hogy nem az yang dan dengan untuk dari ini itu tidak pada "
               "na ya wa kwa ni katika za ang ng sa mga ay ve bir bu için ile się nie jest że och att det som av är og ikke er på "
               "het een niet di che il non della sono não uma em da și să este je su eta ez dhe një nuk kaj estas waa oo iyo "
               "dat nie het vir yn yr ac ir kad tai ar ka").split()
OTHER_LETTERS_EVERY, OTHER_WORDS_EVERY = 10, 20  # one such letter in so many words, or one such word
SPACED_LETTERS = r"[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]+"
CAPITALS = r"(?<![^\x20\x09-\x0D])[A-Z][A-Z]+[.,!?;:]*(?![^\x20\x09-\x0D])"
SPACES = r"[\x20\x09-\x0D]+"


def window_hashes(words: Column) -> Column:
    """A long for each 3-word window: 32 bits of its hash, then its place; sorted."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: (
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.lit(-(1 << 32)))
    ).bitwiseOR(i.cast("long")))
    return F.when(F.size(words) < 4, F.array().cast("array<bigint>")).otherwise(F.sort_array(hashed))


def repeats(rows: Column, key) -> Column:
    """The items of a sorted array whose key equals that of the item before or after."""
    either = F.filter(rows, lambda x, i: (
        F.coalesce(key(x) == key(F.get(rows, i - 1)), F.lit(False)) | F.coalesce(key(x) == key(F.get(rows, i + 1)), F.lit(False))
    ))
    ahead = F.filter(rows, lambda x, i: key(x) == key(F.get(rows, i + 1)))
    return F.when(F.size(ahead) == 0, ahead).otherwise(either)


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window found at least twice in the text.

    Windows are sorted by a 32-bit hash; only those that meet an equal hash are compared as text.
    """
    place = lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    shown = lambda alike: F.sort_array(F.transform(alike, lambda x: F.struct(
        F.concat_ws(" ", F.slice(words, place(x) + 1, 3)).alias("window"), place(x).alias("at"))))
    covered = lambda found: F.aggregate(
        F.sort_array(F.transform(found, lambda x: x["at"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")), lambda a: a["n"])
    return let(window_hashes(words), lambda hashed: let(
        repeats(hashed, lambda x: F.shiftright(x, 32)), lambda alike: F.when(F.size(alike) == 0, F.lit(0).cast("long")).otherwise(
            let(shown(alike), lambda rows: let(repeats(rows, lambda x: x["window"]), covered)))))


def measures(text: Column, rules=None) -> Column:
    """One expression: counts, ratios and verdicts of a text as a struct. A null text counts as empty."""
    rules = RULES if rules is None else rules
    text = F.coalesce(text, F.lit(""))
    split = lambda t: F.filter(F.split(t, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    plain = F.lower(F.regexp_replace(text, r"[.,!?;:]+(?=[\x20\x09-\x0D]|\z)", ""))
    counts = lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
        repeated_words(words).alias("n_repeat_words"),
        F.size(F.filter(F.split(plain, SPACES), lambda w: w.isin(STOP_WORDS))).alias("n_stop_words"),
        F.size(F.regexp_extract_all(text, F.lit(CAPITALS), F.lit(0))).alias("n_capitals"),
    )
    few = lambda c: F.greatest(c["n_words"], F.lit(1))
    ratios = lambda c: F.struct(
        *[c[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_repeat_words")],
        c["lines"]["dup"].alias("n_dup_lines"),
        (c["n_stop_words"] / few(c)).alias("stop_word_ratio"),
        (c["n_capitals"] / few(c)).alias("capital_word_ratio"),
        (c["n_symbols"] / few(c)).alias("symbols_per_word"),
        (c["word_chars"] / few(c)).alias("mean_word_chars"),
        (c["lines"]["dup"] / F.greatest(c["lines"]["n"], F.lit(1))).alias("duplicate_line_ratio"),
    )
    failed = lambda m: (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"])
    other_words = lambda: F.size(F.filter(F.split(plain, SPACES), lambda w: w.isin(OTHER_WORDS)))
    unjudged = lambda m: {
        "stop_word_ratio": (F.length(F.regexp_replace(text, OTHER_LETTERS, "")) * OTHER_LETTERS_EVERY >= m["n_words"])
        | (other_words() * OTHER_WORDS_EVERY >= m["n_words"]),
        "mean_word_chars": F.length(F.regexp_replace(text, SPACED_LETTERS, "")) * 2 >= m["word_chars"]}
    judged = lambda m: F.struct(*[m[x].alias(x) for x in METRICS], failed(m).alias("base_failed"),
                                (~failed(m) & verdict(m, rules, unjudged(m))).alias("kept"))
    return let(split(text), lambda words: let(counts(words), lambda c: let(ratios(c), judged)))


def verdict(metrics: Column, rules, unjudged=None) -> Column:
    """The table as one expression: every metric within its range, or the text ``unjudged`` by it (looked at only outside)."""
    good = F.lit(True)
    for metric, least, most in rules:
        within = F.lit(True)
        if least is not None:
            within = within & (metrics[metric] >= least)
        if most is not None:
            within = within & (metrics[metric] <= most)
        good = good & (within | unjudged[metric] if unjudged and metric in unjudged else within)
    return good


def judged(docs: DataFrame, rules=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, all metrics, ``base_failed`` and ``kept``, one row per input row.

    Null and empty texts have no words and fail. Nothing is grouped or shuffled: null ids, repeated rows and further
    columns don't matter; an empty table gives no rows.
    """
    return docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col), rules).alias("m")).select("doc_id", "m.*")


def good_documents(docs: DataFrame, rules=None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    return docs.where(measures(F.col(text_col), rules)["kept"])


METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "stop_word_ratio", "capital_word_ratio",
           "symbols_per_word", "mean_word_chars", "duplicate_line_ratio")
CONTRACT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(*CONTRACT)


def _rules_sql() -> str:
    bounds = [f"{m} >= {a!r}" for m, a, _ in RULES if a is not None] + [f"{m} <= {b!r}" for m, _, b in RULES if b is not None]
    return " AND ".join(bounds)


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT k, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
    FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT k, count(DISTINCT i + o) AS n FROM (SELECT k, i, unnest([0, 1, 2]) AS o FROM r) GROUP BY k),
m AS (SELECT w.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: lower(regexp_replace(x, '[.,!?;:]+$', '')) IN ({_STOPS}))) / greatest(len(words), 1)::DOUBLE AS stop_word_ratio,
    len(list_filter(words, lambda x: regexp_matches(x, '^[A-Z][A-Z]+[.,!?;:]*$'))) / greatest(len(words), 1)::DOUBLE AS capital_word_ratio
    FROM w LEFT JOIN c USING (k)),
s AS (SELECT *, n_symbols / greatest(n_words, 1)::DOUBLE AS symbols_per_word,
    word_chars / greatest(n_words, 1)::DOUBLE AS mean_word_chars,
    n_dup_lines / greatest(n_lines, 1)::DOUBLE AS duplicate_line_ratio,
    n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {_rules_sql()} AS kept FROM s
"""
