"""Secret scans through a trigram inverted index, on DataFrame functions only.

Each rule is a small tree of literals, character sets and choices. From the tree come both the pattern and a Boolean query
over trigrams that every match must contain: all trigrams of a run of literals (and), any of a choice's branches (or). The
index holds, for the trigrams that some rule asks for, the documents that have them (case folded). A rule's posting lists
are intersected to get its candidates, and the pattern is matched on these only. A rule without a mandatory trigram, such
as a run of hexadecimal digits, is matched on every text.
"""

from __future__ import annotations

import functools
import itertools
import operator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlytics.llm.common import free_name, let, table
from motorlytics.session import written


@dataclass(frozen=True)
class Rule:
    """``parts``: tuples of literals to choose from, and strings of pattern text.

    ``group`` and ``least``: a match counts if that group has so many characters at least. ``fold``: letters of the
    literals match in either case.
    """

    kind: str
    parts: tuple
    group: int = 0
    least: int = 0
    fold: bool = False

    linear: tuple = ()

    @property
    def linear_pattern(self) -> str:
        """The pattern for an engine without atomic groups."""
        return replace(self, parts=self.linear or self.parts).pattern

    @property
    def pattern(self) -> str:
        either = lambda x: "".join(f"[{c}{c.upper()}]" if self.fold and c.isalpha() else c for c in x)
        return "".join(p if isinstance(p, str) else "(" + "|".join(map(either, p)) + ")" for p in self.parts)


# What follows a key's header: all up to its END line (no other line of dashes lies between, so a scan ends at the next header);
# where that is missing, PEM fields and all base64 from a first long run on.
_FIELD, _KEY = r"[\x20\x09-\x0D]*[A-Z][A-Za-z0-9-]*:[^\x0A]*\x0A", r"""[\\"'+>#*\x20\x09-\x0D]*[A-Za-z0-9+/]{16,}[A-Za-z0-9+/=\\"'>#*\x20\x09-\x0D]*"""
PEM_BODY = rf"(?:(?>[\s\S]*?-----)-?END [A-Z ]*PRIVATE KEY-----|(?:{_FIELD})*+{_KEY})?"
# The same for engines that match in linear time and know no atomic groups; Java would need stack for each of its repetitions.
PEM_BODY_LINEAR = rf"(?:[^-]*(?:-{{1,4}}[^-]+)*-{{5,6}}END [A-Z ]*PRIVATE KEY-----|(?:{_FIELD})*{_KEY})?"

# Assign, access and hex are the base rules; the others are well-known shapes of tokens and keys. A run that
# must have so many characters is written with that count where this finds the same matches as a test afterwards.
RULES = (
    Rule("assign", (("password", "passwd", "secret", "token", "api_?key"),
                    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), group=2, least=12, fold=True),
    Rule("access", (("AKIA",), "[A-Z0-9]{14,}")),
    Rule("hex", ("[0-9a-f]{16,}",)),
    Rule("pem", (("-----BEGIN ",), "[A-Z ]*", ("PRIVATE KEY-----",), PEM_BODY),
         linear=(("-----BEGIN ",), "[A-Z ]*", ("PRIVATE KEY-----",), PEM_BODY_LINEAR)),
    Rule("github", (("ghp_", "gho_", "ghs_", "github_pat_"), "[A-Za-z0-9_]{20,}")),
    Rule("slack", (("xoxb-", "xoxp-", "xoxa-"), "[A-Za-z0-9-]{15,}")),
    Rule("stripe", (("sk_live_", "rk_live_"), "[A-Za-z0-9]{16,}")),
    Rule("google", (("AIza",), "[A-Za-z0-9_-]{35,}")),
)
BASE_KINDS = ("assign", "access", "hex")


SPANS = "array<struct<start:int,ord:int,kind:string,end:int>>"
RUN = 512
# Bits of the sieve of candidates: with n of them, n / 2**FILTER_BITS of the other documents pass too.
FILTER_BITS = 24


def literals(text: str) -> list[str]:
    """A literal with optional characters (``x?``) as the literals it stands for."""
    if "?" not in text:
        return [text]
    at = text.index("?")
    return [x for head in (text[:at], text[: at - 1]) for x in literals(head + text[at + 1 :])]


def trigrams(text: str) -> frozenset[str]:
    folded = text.lower()
    return frozenset(folded[i : i + 3] for i in range(len(folded) - 2))


def trigram_query(rule: Rule) -> list[frozenset[str]]:
    """The rule's query as alternatives of trigrams that must all be there; empty: no mandatory trigram, scan fully."""
    choices = []
    for part in rule.parts:
        if not isinstance(part, str):
            branches = [trigrams(x) for literal in part for x in literals(literal)]
            if all(branches):  # a branch without a trigram would match anything
                choices.append(branches)
    if not choices:
        return []
    return list(dict.fromkeys(frozenset().union(*picked) for picked in itertools.product(*choices)))


def postings(docs: DataFrame, wanted: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: ``trigram`` and ``doc_id`` for every wanted trigram in a text, case folded."""
    folded = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    listed = F.array(*[F.lit(t) for t in wanted])
    return docs.select(F.col(id_col).alias("doc_id"), folded.alias("folded")).select(
        F.explode(F.filter(listed, lambda t: F.contains(F.col("folded"), t))).alias("trigram"), "doc_id")


def candidates(docs: DataFrame, rules=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``kinds``: the rules whose query the document's trigrams satisfy. Documents without any are absent.

    Posting lists are intersected as bit sets: a trigram of the rules is a bit, and a document's bits are or-ed before the
    shuffle, so a document costs one row there and no list is gathered anywhere.
    """
    rules, spark = RULES if rules is None else rules, docs.sparkSession
    queries = {r.kind: q for r in rules if (q := trigram_query(r))}
    wanted = sorted({t for q in queries.values() for alternative in q for t in alternative})
    place = {t: divmod(i, 62) for i, t in enumerate(wanted)}
    lists = postings(docs, wanted, id_col, text_col)
    terms = spark.createDataFrame([(t, w, 1 << b) for t, (w, b) in place.items()], "trigram string, word int, bit long")
    words = range(1 + max(w for w, _ in place.values()))
    had = lists.join(F.broadcast(terms), "trigram").groupBy("doc_id").agg(
        *[F.bit_or(F.when(F.col("word") == w, F.col("bit")).otherwise(F.lit(0))).alias(f"w{w}") for w in words])

    def holds(alternative: frozenset[str]) -> Column:
        needed = {w: sum(1 << place[t][1] for t in alternative if place[t][0] == w) for w in words}
        return functools.reduce(operator.and_, [F.col(f"w{w}").bitwiseAND(F.lit(n)) == n for w, n in needed.items() if n])

    kinds = [F.when(functools.reduce(operator.or_, map(holds, q)), F.lit(kind)) for kind, q in queries.items()]
    return had.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds")).where(F.size("kinds") > 0)


def in_runs(items: Column, kind: str, step, done) -> Column:
    """``done(at, out)`` after ``step(at, run)``, a ``struct(at, out)``, over runs of ``RUN`` items from where the run before ended.

    An array that grows by an item is copied as a whole, and a place in a text is found by a pass over what lies before it.
    Runs keep both short, so a text with very many secrets costs a pass per run, not one per secret. Needs an item.
    """
    def runs(held: Column) -> Column:
        last = F.size(held) - 1
        return F.transform(F.sequence(F.lit(0), last, F.lit(RUN)), lambda i: F.transform(
            F.sequence(i, F.least(i + (RUN - 1), last)), lambda j: F.get(held, j)))

    ended = lambda past: F.coalesce(F.get(past, F.size(past) - 1)["at"], F.lit(0))
    return F.aggregate(
        let(items, runs), F.array().cast(f"array<struct<at:int,out:{kind}>>"),
        lambda past, run: F.concat(past, F.array(step(ended(past), run))),
        lambda past: done(ended(past), F.flatten(F.transform(past, lambda x: x["out"]))))


def matches(text: Column, rule: Rule, order: int) -> Column:
    """Matches of a rule in a text as ``struct(start, ord, kind, end)``, in code points, leftmost and non-overlapping.

    Text between matches and the matches themselves alternate, so lengths add up to places. A match that fails the test of
    its length takes its place in the sum and is dropped.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else None

    def added(whole: Column) -> Column:
        pairs = F.arrays_zip(whole.alias("m"), (tested if rule.group else whole).alias("g"))
        sizes = F.zip_with(F.slice(gaps, 1, F.size(whole)), pairs, lambda gap, m: F.struct(
            F.length(gap).alias("gap"), F.length(m["m"]).alias("size"), (F.length(m["g"]) >= rule.least).alias("good")))
        spans = lambda at, part: F.aggregate(
            part, F.struct(at.alias("at"), F.array().cast(SPANS).alias("out")),
            lambda a, x: F.struct(
                (a["at"] + x["gap"] + x["size"]).alias("at"),
                F.when(x["good"], F.concat(a["out"], F.array(F.struct(
                    (a["at"] + x["gap"]).alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"),
                    (a["at"] + x["gap"] + x["size"]).alias("end"))))).otherwise(a["out"]).alias("out")))
        return in_runs(sizes, SPANS, spans, lambda at, out: out)

    return F.when(text.rlike(rule.pattern), let(F.regexp_extract_all(text, pattern, F.lit(0)), added)).otherwise(
        F.array().cast(SPANS))


def scanned(docs: DataFrame, rules=None, id_col: str = "doc_id", text_col: str = "text", output: str = "secrets") -> DataFrame:
    """``docs`` with a column ``output``, which must be a new name: spans ``struct(start, ord, kind, end)`` sorted by start, then rule.

    Null and empty texts have none. Documents that share an id, null included, share candidates and are verified each by
    itself, so repeated rows stay and are right. Further columns stay; an empty table gives no rows.

    Candidates are stored first. A sieve of their ids, of fixed size, lets all other documents be finished where they are read:
    they are scanned by the rules without mandatory trigrams, and only texts that pass it are shuffled. ``docs`` is read three times.
    """
    rules = RULES if rules is None else rules
    if free_name(docs, output) != output:
        raise ValueError(f"there is a column {output} already")
    ids, kinds, at, bits = (free_name(docs, n) for n in ("found_id", "found_kinds", "found_at", "found_bits"))
    found = written(candidates(docs, rules, id_col, text_col).select(F.col("doc_id").alias(ids), F.col("kinds").alias(kinds)), "secret-candidates")
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS))
    bit = lambda c: F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{c}`), 32) AS int))")
    # At most 2**(FILTER_BITS - 5) rows of two numbers, whatever the number of candidates.
    sieve = found.groupBy(F.shiftright(slot(F.col(ids)), 5).alias(at)).agg(F.bit_or(bit(ids)).alias(bits))
    sifted = docs.join(F.broadcast(sieve), F.shiftright(slot(docs[id_col]), 5) == F.col(at), "left")
    passed = F.coalesce(F.col(bits).bitwiseAND(bit(id_col)) != 0, F.lit(False))
    text, nothing = F.coalesce(F.col(text_col), F.lit("")), F.array().cast(SPANS)

    def with_spans(rows: DataFrame, indexed) -> DataFrame:
        parts = [indexed(rule, i) if trigram_query(rule) else matches(text, rule, i) for i, rule in enumerate(rules)]
        return rows.select(*docs.columns, F.array_sort(F.concat(*parts)).alias(output))

    rest = with_spans(sifted.where(~passed), lambda rule, i: nothing)
    near = sifted.where(passed).join(found, F.col(id_col).eqNullSafe(F.col(ids)), "left")
    return rest.unionByName(with_spans(
        near, lambda rule, i: F.when(F.array_contains(kinds, rule.kind), matches(text, rule, i)).otherwise(nothing)))


def shown(secrets: Column) -> Column:
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, secrets: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of secret characters replaced by ``mark``; secrets that overlap become one."""
    pieces = lambda at, run: let(
        F.substring(text, at + 1, F.greatest(F.element_at(run, -1)["start"] - at, F.lit(0))),
        lambda near: F.aggregate(
            run, F.struct(at.alias("at"), F.array().cast("array<string>").alias("out")),
            lambda a, s: F.struct(
                F.greatest(a["at"], s["end"]).alias("at"),
                F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(F.concat(
                    F.substring(near, a["at"] - at + 1, s["start"] - a["at"]), F.lit(mark))))).alias("out"))))
    rest = in_runs(secrets, "array<string>", pieces, lambda at, out: F.concat(
        F.array_join(out, ""), F.substring(text, at + 1, F.length(text))))
    return F.when(F.size(secrets) > 0, rest).otherwise(text)


def without_secrets(docs: DataFrame, rules=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with secrets replaced in the text column; all columns and rows stay."""
    spans = free_name(docs, "secrets")
    found = scanned(docs, rules, id_col, text_col, spans)
    return found.withColumn(text_col, redacted(F.col(text_col), F.col(spans))).select(*docs.columns)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scanned(table(spark, sf_dir, "documents")).select("doc_id", "secrets")
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id", *map(of, BASE_KINDS),
        F.sha2(shown(F.filter("secrets", lambda s: s["kind"].isin(list(BASE_KINDS)))), 256).alias("base_sha256"),
        shown(F.col("secrets")).alias("spans"))


def _sql() -> str:
    """The same spans by gaps and matches of each rule, over whole texts and without an index."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    each = " UNION ALL ".join(
        f"SELECT k, {i} AS ord, '{r.kind}' AS kind, {r.least} AS least, regexp_split_to_array(text, {quoted(r.linear_pattern)}) AS gaps, "
        f"regexp_extract_all(text, {quoted(r.linear_pattern)}) AS whole, regexp_extract_all(text, {quoted(r.linear_pattern)}, {r.group}) AS tested FROM d"
        for i, r in enumerate(RULES))
    base = ", ".join(f"'{k}'" for k in BASE_KINDS)
    line = "kind || ':' || (e - size) || ':' || e"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
e AS ({each}),
u AS (SELECT k, ord, kind, least, i, length(gaps[i]) AS gap, length(whole[i]) AS size, length(tested[i]) AS tested
    FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM e)),
p AS (SELECT *, sum(gap + size) OVER (PARTITION BY k, ord ORDER BY i)::BIGINT AS e FROM u),
f AS (SELECT * FROM p WHERE tested >= least),
s AS (SELECT k, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg({line}, ',' ORDER BY e - size, ord) FILTER (WHERE kind IN ({base})) AS base,
    string_agg({line}, ',' ORDER BY e - size, ord) AS spans FROM f GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (k)
"""


SQL = _sql()
