r"""Operator 1: personal data by bootstrapped contextual extraction, in DataFrame operations only.

Base identifiers (e-mail, IP address, payment card, phone) are matched by their fixed patterns and
checked (address parts, Luhn sum, digit counts). They seed a graph of lexical patterns and
instances: patterns are the words next to an identifier, instances are identifier values, those
found by wider shapes included (addresses with a spelt-out "at" and "dot" or without a domain's end,
colon-separated addresses, card-like numbers, phone numbers without a plus). For ``ROUNDS`` rounds a
pattern's confidence is the mean score of its instances, and an unknown instance's score the
noisy-or of its confident patterns (``LEAST_SUPPORT`` known instances and ``CONFIDENT`` at least).
Occurrences of instances that reach ``ACCEPTED``, and overlap no base identifier, are added as spans.

The texts are read once, by expressions; only matches go on. The expressions are linear in the text:
possessive, started at the head of a run, and evaluated only where the text has their key character.
Positions are running sums over a document's matches. Edges are distinct before they are joined, so
a pattern that very many documents share costs its distinct values.

Positions are code points, end exclusive. Defined results: null or empty text has no spans (the hash
of the empty string); rows are told apart, also repeated ones and null doc_ids. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import written

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
LEAST_SUPPORT = 5
CONFIDENT = 0.8
ACCEPTED = 0.9
CONTEXT = 60  # characters beside a match that are searched for its neighbouring words

_LOCAL = r"[A-Za-z0-9._%+-]"
_RUN = r"(?:(?<![A-Za-z0-9._%+-])|\G)" + _LOCAL + "++"
#: The fixed base patterns in a form without backtracking: same matches, or matches that the checks
#: below drop.
BASE = {
    "email": _RUN + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?){14})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDER = {
    "email": _RUN + r"(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){4,7}:?[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z])(?<![0-9][\x20-])(?=(?:[0-9][\x20-]?){12})[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{2,4}[\x20.-]?[0-9]{3,4}(?![0-9A-Za-z])",
}
#: A text without this cannot match.
KEY = {"email": "contains(text, '@')", "ip": "contains(text, '.')", "card": "text RLIKE '[0-9]'", "phone": "contains(text, '+')"}
WIDER_KEY = {"email": "(contains(text, '@') OR contains(text, 'at)') OR contains(text, 'at]'))", "ip": "contains(text, ':')",
             "card": "text RLIKE '[0-9]'", "phone": "text RLIKE '[0-9][ .)-]'"}


def _quoted(regex: str) -> str:
    return "r'" + regex + "'"


def _matches(kind: int, base: bool) -> str:
    """SQL: one struct per piece of the text between matches, with the match that follows it."""
    name = KINDS[kind]
    regex, key = (BASE[name], KEY[name]) if base else (WIDER[name], WIDER_KEY[name])
    shape = "array<struct<kind:int,base:boolean,i:int,gap:int,left:string,right:string,value:string>>"
    q = _quoted(regex)
    return f"""CASE WHEN {key} AND text RLIKE {q} THEN transform(
        arrays_zip(split(text, {q}, -1), regexp_extract_all(text, {q}, 0)), (x, i) -> named_struct(
        'kind', {kind}, 'base', {str(base).lower()}, 'i', i, 'gap', length(x.`0`), 'left', right(x.`0`, {CONTEXT}),
        'right', left(x.`0`, {CONTEXT}), 'value', x.`1`)) ELSE cast(array() AS {shape}) END"""


def _valid() -> str:
    """SQL: whether a base match passes its kind's check."""
    digits = "regexp_replace(value, '[^0-9]', '')"
    luhn = f"""aggregate(transform(split(reverse({digits}), ''), (c, j) -> CASE WHEN c = '' THEN 0
        WHEN j % 2 = 0 THEN cast(c AS INT) WHEN c >= '5' THEN 2 * cast(c AS INT) - 9 ELSE 2 * cast(c AS INT) END),
        0, (a, d) -> a + d) % 10 = 0"""
    parts = "forall(split(value, '[.]'), p -> length(trim(LEADING '0' FROM p)) <= 3 AND cast('0' || right(p, 3) AS INT) <= 255)"
    return f"""CASE kind WHEN 0 THEN true WHEN 1 THEN {parts}
        WHEN 2 THEN length({digits}) BETWEEN 14 AND 19 AND {luhn}
        ELSE length({digits}) BETWEEN 10 AND 15 END"""


def occurrences(rows: DataFrame) -> DataFrame:
    """Matches (row_id, kind, base, start, end, value, left, right) from the written pieces."""
    pieces = rows.select("row_id", F.explode("found").alias("x")).select("row_id", "x.*")
    of = Window.partitionBy("row_id", "kind", "base").orderBy("i")
    upto = of.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.coalesce(F.length("value"), F.lit(0))).over(upto)
    return pieces.select("row_id", "kind", "base", "value", "left", F.lead("right").over(of).alias("right"), end.alias("end")) \
        .where("value IS NOT NULL").withColumn("start", F.col("end") - F.length("value"))


def _free(found: DataFrame) -> DataFrame:
    """The wider matches that overlap no base match of their row."""
    before = Window.partitionBy("row_id").orderBy("start", F.desc("base")).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row_id").orderBy(F.desc("start"), F.desc("base")).rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("upto", F.max(F.expr("CASE WHEN base THEN end END")).over(before)) \
        .withColumn("next", F.min(F.expr("CASE WHEN base THEN start END")).over(after)) \
        .where("NOT base AND coalesce(upto, 0) <= start AND (next IS NULL OR next >= end)").drop("upto", "next")


def _edges(found: DataFrame) -> DataFrame:
    """Distinct (kind, pattern, value): the word before, the two words before, the word after."""
    word = "lower(regexp_replace({}, '[0-9]+', '0'))"
    patterns = F.expr(f"""array(
        concat('1 ', {word.format("regexp_extract(left, '([^ \\t-\\r]+)[ \\t-\\r]*$', 1)")}),
        concat('2 ', {word.format("regexp_extract(left, '([^ \\t-\\r]+[ \\t-\\r]+[^ \\t-\\r]+)[ \\t-\\r]*$', 1)")}),
        concat('3 ', {word.format("regexp_extract(right, '^[ \\t-\\r]*([^ \\t-\\r]+)', 1)")}))""")
    return found.select("kind", "value", F.explode(patterns).alias("pattern")).where("length(pattern) > 2").distinct()


def bootstrap(found: DataFrame) -> DataFrame:
    """(kind, value) of the accepted instances that are no base identifiers."""
    seeds = found.where("base").select("kind", "value").distinct().withColumn("score", F.lit(1.0))
    edges = written(_edges(found), "edges")
    scored = seeds = written(seeds, "seeds")
    fresh = None
    for _ in range(ROUNDS):
        patterns = edges.join(scored, ["kind", "value"], "left").groupBy("kind", "pattern").agg(
            F.sum("score").alias("known"), F.count("*").alias("all")).where(
            f"known >= {LEAST_SUPPORT} AND known >= {CONFIDENT} * all").select(
            "kind", "pattern", (F.col("known") / (F.col("all") + 1)).alias("confidence"))
        fresh = written(edges.join(patterns, ["kind", "pattern"]).join(seeds, ["kind", "value"], "left_anti")
                        .groupBy("kind", "value").agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"))
                        .where(f"score >= {ACCEPTED}"), "instances")
        scored = seeds.union(fresh)
    return fresh.select("kind", "value")


def personal_data(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, base and spans, each an array of (start, kind, end)."""
    all_kinds = ", ".join(_matches(k, b) for b in (True, False) for k in range(len(KINDS)))
    rows = written(docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
                               F.coalesce("text", F.lit("")).alias("text"))
                   .select("row_id", "doc_id", F.expr(f"concat({all_kinds})").alias("found")), "matches")
    found = occurrences(rows).withColumn("valid", F.expr(_valid())).where("NOT base OR valid").drop("valid")
    found = written(found, "found")
    base = found.where("base")
    wider = written(_free(found), "wider")
    accepted = bootstrap(base.union(wider.select(*base.columns)))
    more = wider.join(accepted, ["kind", "value"], "left_semi").select(*base.columns)
    spans = base.union(more).groupBy("row_id").agg(
        F.array_sort(F.collect_set(F.struct("start", "kind", "end", "base"))).alias("spans"))
    return rows.select("row_id", "doc_id").join(spans, "row_id", "left").select(
        "doc_id", F.coalesce("spans", F.expr("cast(array() AS array<struct<start:bigint,kind:int,end:bigint,base:boolean>>)")).alias("spans"))
