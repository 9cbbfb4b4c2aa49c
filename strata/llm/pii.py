"""Personal data by weak-supervision aggregation.

Candidates are the spans of the base patterns and of looser ones (long digit
runs, phone numbers without ``+``, hexadecimal secrets). Four labelers vote on
each: the exact *format*, the *shape* of its characters, a *gazetteer* (top-level
domains, private networks, issuers' first digits) and the *context* of words
before it; a vote is for, against or none. Expectation-maximisation over the
counts of vote patterns estimates each labeler's reliability for each kind, and
from its posteriors a final classifier over votes and shape is trained (log-odds
weights of a span's features). Base spans stay; other spans are added where the
classifier is for them and no base span overlaps.

Only counts of patterns reach the driver: kinds x 3^4 votes x 4 lengths at most.
One pass over the texts finds the candidates; they are written, and all else
works on them.

Defined results: null and empty texts have no spans (the digest is that of the
empty text); rows are independent, repeats get equal results, ties can't arise;
with no candidates at all nothing is trained or added; other columns are ignored.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import let, table, written

#: Base patterns, written so that no text takes more than linear time.
_LOCAL = "A-Za-z0-9._%+-"
BASE = [
    ("email", f"(?:(?<![{_LOCAL}])|\\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++", "@"),
    ("ip", "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++", "."),
    ("card", "[0-9](?:[\\x20-]?+[0-9])++", None),
    ("phone", "\\+[0-9][\\x20().0-9-]+[0-9]", "+"),
]
OTHER = [
    ("secret", "(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])", None),
    ("local-phone", "(?<![0-9+(])\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}(?![0-9])", None),
    ("long-number", "(?<![0-9])[0-9]{13,16}(?![0-9])", None),
]
KINDS = [k for k, _, _ in BASE + OTHER]
DOMAINS = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info"]
CUES = "(?i)(?:mail|phone|tel|call|fax|contact|card|credit|visa|account|ip|server|host|token|key|secret|password)[^\\n]{0,12}$"
COUNTER_CUES = "(?i)(?:version|isbn|page|chapter|commit|order|sku|id)[^\\n]{0,8}$"
LABELERS = ["format", "shape", "gazetteer", "context"]
CONTEXT, ROUNDS = 24, 30


def _found(text: Column, kind: str, pattern: str, mark: str | None) -> Column:
    """Matches of one kind as (kind, start, end, match, before), code points from 0."""
    kind_of = "array<struct<kind:int,start:int,end:int,match:string,before:string>>"

    def spans(matches):
        def places(gaps):
            # Starts as running sums of the lengths of gaps and matches.
            sums = F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1),
                               F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("starts")),
                               lambda acc, i: let(acc["end"] + F.length(F.get(gaps, i)), lambda start: F.struct(
                                   (start + F.length(F.get(matches, i))).alias("end"), F.array_append(acc["starts"], start).alias("starts"))))
            return F.transform(sums["starts"], lambda start, i: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), (start + F.length(F.get(matches, i))).alias("end"),
                F.get(matches, i).alias("match"), F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before")))
        return F.when(F.size(matches) > 0, let(F.split(text, pattern, -1), places)).otherwise(F.array().cast(kind_of))

    there = F.contains(text, F.lit(mark)) if mark else text.rlike("[0-9]")
    return F.when(there, let(F.regexp_extract_all(text, F.lit(pattern), 0), spans)).otherwise(F.array().cast(kind_of))


def _valid(x: Column) -> Column:
    """Whether a match of a base pattern is a base span."""
    digits = F.regexp_replace(x["match"], "[^0-9]", "")
    return (F.when(x["kind"] == 0, True)
            .when(x["kind"] == 1, x["match"].rlike("^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\\.|$)){4}$"))
            .when(x["kind"] == 2, F.length(digits).between(12, 19) & F.call_function("luhn_check", digits))
            .when(x["kind"] == 3, F.length(digits).between(9, 15)).otherwise(False))


def _votes(x: Column) -> Column:
    """A candidate with its votes: 1 for, 0 against, -1 none."""
    plain = F.regexp_replace(x["match"], "[^0-9A-Za-z]", "")
    kinds = F.size(F.array_distinct(F.split(plain, "")))
    domain = F.lower(F.regexp_extract(x["match"], "([A-Za-z]+)$", 1))
    known = (F.when(x["kind"] == 0, F.when(domain.isin(DOMAINS), 1).otherwise(0))
             .when(x["kind"] == 1, F.when(x["match"].rlike("^(?:0|10|127|169\\.254|192\\.168|255)\\."), 0).otherwise(1))
             .when(x["kind"].isin(2, 6), F.when(x["match"].rlike("^[3-6]"), 1).otherwise(0)).otherwise(-1))
    return F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base"),
        F.when(x["base"], 1).when(x["kind"] < len(BASE), 0)
        .when(x["kind"] == 6, F.when(F.call_function("luhn_check", plain), 1).otherwise(0)).otherwise(-1).alias("format"),
        F.when(kinds <= 2, 0).when(kinds >= 6, 1).otherwise(-1).alias("shape"),
        known.alias("gazetteer"),
        F.when(x["before"].rlike(CUES), 1).when(x["before"].rlike(COUNTER_CUES), 0).otherwise(-1).alias("context"),
        F.least(F.floor(F.length(plain) / 10), F.lit(3)).cast("int").alias("size"))


def candidates(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``spans``: all candidates with votes, no text."""
    t = F.coalesce(F.col(text), F.lit(""))
    columns = [_found(F.col("_t"), *k).alias(k[0]) for k in BASE + OTHER]
    rows = docs.select(*keep, t.alias("_t")).select(*keep, *columns)
    marked = F.transform(F.concat(*[F.col(f"`{k}`") for k in KINDS]), lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"),
        x["before"].alias("before"), _valid(x).alias("base")))
    return rows.select(*keep, F.transform(marked, _votes).alias("spans"))


def fit(patterns: list[tuple]) -> dict:
    """EM over (kind, votes, size, count) rows: weights of the final classifier.

    Reliabilities of labelers (for true and false spans) and the share of true
    ones are estimated for each kind, from the start that votes are right in 8
    of 10 cases; then each feature's log-odds under the posteriors.
    """
    weights: dict = {}
    for kind in sorted({p[0] for p in patterns}):
        rows = [(p[1:5], p[5], p[6]) for p in patterns if p[0] == kind]
        prior, rate = 0.5, {(m, c): (0.8 if c else 0.2) for m in range(4) for c in (0, 1)}
        for _ in range(ROUNDS):
            posteriors = []
            for votes, _, _ in rows:
                odds = log(prior / (1 - prior))
                for m, vote in enumerate(votes):
                    if vote >= 0:
                        odds += log((rate[m, 1] if vote else 1 - rate[m, 1]) / (rate[m, 0] if vote else 1 - rate[m, 0]))
                posteriors.append(1 / (1 + 2.718281828459045 ** -max(-30.0, min(30.0, odds))))
            true = sum(q * r[2] for q, r in zip(posteriors, rows))
            every = sum(r[2] for r in rows)
            prior = min(0.99, max(0.01, (true + 1) / (every + 2)))
            for m in range(4):
                for c in (0, 1):
                    given = [((q if c else 1 - q) * r[2], r[0][m]) for q, r in zip(posteriors, rows) if r[0][m] >= 0]
                    rate[m, c] = (sum(g for g, v in given if v) + (1.6 if c else 0.4)) / (sum(g for g, _ in given) + 2)
        table_ = {("prior", 0): log(prior / (1 - prior))}
        total = {c: sum((q if c else 1 - q) * r[2] for q, r in zip(posteriors, rows)) for c in (0, 1)}
        for f, name in enumerate([*LABELERS, "size"]):
            value = lambda r: r[0][f] if f < 4 else r[1]  # noqa: B023, E731
            seen = {value(r) for r in rows}
            for v in seen:
                share = {c: (sum((q if c else 1 - q) * r[2] for q, r in zip(posteriors, rows) if value(r) == v) + 1) / (total[c] + len(seen) + 1) for c in (0, 1)}
                table_[name, v] = log(share[1] / share[0])
        weights[kind] = table_
    return weights


def _score(x: Column, weights: dict) -> Column:
    total = F.lit(0.0)
    for kind, own in weights.items():
        score = F.lit(own["prior", 0])
        for name in [*LABELERS, "size"]:
            part = F.lit(0.0)
            for (n, v), weight in own.items():
                if n == name:
                    part = F.when(x[name] == v, weight).otherwise(part)
            score = score + part
        total = F.when(x["kind"] == kind, score).otherwise(total)
    return total


def find(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``base`` and ``all_spans``: (kind, start, end) by start, then kind."""
    rows = written(candidates(docs, keep, text), "pii_candidates")
    groups = ["kind", *LABELERS, "size"]
    patterns = rows.select(F.explode("spans").alias("s")).select(*[f"s.{c}" for c in groups]).groupBy(*groups).count().collect()
    weights = fit([tuple(r) for r in patterns])
    ordered = lambda spans: F.transform(F.sort_array(F.transform(spans, lambda x: F.struct(
        x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))), lambda x: x)
    base = rows.withColumn("_base", F.filter("spans", lambda x: x["base"]))
    added = F.filter("spans", lambda x: ~x["base"] & (x["kind"] >= len(BASE)) & (_score(x, weights) > 0)
                     & ~F.exists("_base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    return base.withColumn("_all", F.concat("_base", added)).select(
        *keep, ordered(F.col("_base")).alias("base"), ordered(F.col("_all")).alias("all_spans"))


def _text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def query(spark, sf_dir):
    rows = find(table(spark, sf_dir, "documents"), ["doc_id"])
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, (name, _, _) in enumerate(BASE)]
    return rows.select("doc_id", *counts, F.sha2(_text("base"), 256).alias("base_sha256"), _text("all_spans").alias("spans"))
