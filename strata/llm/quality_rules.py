"""Quality rules by cross-document line frequency.

Lines are normalised (lower case, runs of white space as one blank) and hashed.
For each host (``source``) the distinct documents that hold a line are counted
(equal texts of a host are one document). A line in more than ``max_docs`` of them
is boilerplate and removed; a document that keeps less than ``min_kept_share`` of
its characters is depleted and rejected, as are documents that fail the base rules.

Option ``spare_versions``: near copies of one text turn each other's lines into
boilerplate. With it a line is removed only if it is also held by as many
*families*, and a depleted document that keeps enough by that count has ``version``
true and stays, for a later search of near duplicates. Each document is a family
of its own but for versions: documents whose lines that few others hold are mostly
edits of lines that many hold (the *gist*, the least hash of a line's 3-word
windows, is the same). Versions with the same smallest common line are one family.

The texts are read once; counts, hashes and lengths of lines are written, and all
else works on them.

Defined results: a null or blank text has no words, fails the base rules and is
rejected; null hosts form one host; repeated rows get one verdict each, the
same; ties can't arise, since only counts are compared; other columns are kept
whatever their names (those named like a result give way).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import NOT_SPACE, SPACES, broadcast_if_small, let, table, words_of, written

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULT = [*COUNTS, "kept_chars", "all_chars", "base_failed", "depleted", "version", "kept"]


@dataclass(frozen=True)
class QualityRules:
    """Limits. ``max_docs``: a line in more documents of a host is boilerplate; with
    ``spare_versions`` if in as many families, at least ``min_family_share`` of the documents."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_docs: int = 20
    min_family_share: float = 0.5
    min_kept_share: float = 0.5
    spare_versions: bool = False


def repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the array.

    Each window becomes one integer: as many low bits as positions need hold
    the position, the others a hash of the words. After a sort of those, equal
    windows are neighbours (the words are compared too), and the positions of
    repeated windows, in order, cover 3 words each less what the next covers.
    """
    def over(w):
        n = F.size(w)
        bits = F.length(F.bin(n.cast("long")))

        def packed(b):
            return F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.call_function(
                "shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), b).bitwiseOR(i.cast("long"))))

        def repeated(p, b):
            at = F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1

            def same(x, y):
                i, j = x.bitwiseAND(at).cast("int"), y.bitwiseAND(at).cast("int")
                return ((F.call_function("shiftright", x, b) == F.call_function("shiftright", y, b)) & (F.get(w, i) == F.get(w, j))
                        & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2)))
            flagged = F.filter(p, lambda x, k: F.coalesce(same(x, F.get(p, k - 1)), F.lit(False))
                               | F.coalesce(same(x, F.get(p, k + 1)), F.lit(False)))
            return F.sort_array(F.transform(flagged, lambda x: x.bitwiseAND(at)))

        starts = let(bits, lambda b: let(packed(b), lambda p: repeated(p, b)))
        covered = let(starts, lambda s: F.aggregate(
            F.transform(s, lambda x, k: F.least(F.lit(3).cast("long"), F.coalesce(F.get(s, k + 1) - x, F.lit(3).cast("long")))),
            F.lit(0).cast("long"), lambda total, x: total + x))
        return F.when(n >= 3, covered).otherwise(F.lit(0).cast("long"))
    return let(words, over)


def base_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of the base rules, all over the whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    with_word = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_SPACE))
    return docs.withColumns({
        "_words": words_of(F.col(text)),
        "word_chars": F.length(F.translate(t, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }).withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_repeat_words": repeat_words(F.col("_words")),
    }).drop("_words")


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACES, " "))


def gist(line: Column) -> Column:
    """The least hash of a normal line's 3-word windows, which an edit of a few
    words mostly leaves; of the whole line if it has fewer words."""
    return let(F.split(line, " "), lambda w: F.when(F.size(w) > 2, F.array_min(F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))).otherwise(F.xxhash64(w)))


def read_once(docs: DataFrame, rules: QualityRules, text: str, host: str) -> DataFrame:
    """Written: ``row`` (the other columns), ``host`` and ``text`` (hash and length: a
    distinct text of a host), the counts and ``lines`` (hash, length and gist of each)."""
    gist_of = gist if rules.spare_versions else lambda x: F.lit(None).cast("long")
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text, *RESULT)]
    rows = docs.select(F.struct(*rest, F.lit(True).alias("_there")).alias("row"), F.coalesce(F.col(host), F.lit("\x00")).alias("host"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    lines = F.filter(F.transform(F.split("text", "\n"), normal), lambda x: x != F.lit(""))
    hashed = let(lines, lambda each: F.transform(each, lambda x: F.struct(
        F.xxhash64(x).alias("line"), F.length(x).alias("chars"), gist_of(x).alias("gist"))))
    return written(base_stats(rows).select(
        "row", "host", F.struct(F.xxhash64("text").alias("hash"), F.length("text").alias("chars")).alias("text"), *COUNTS,
        hashed.alias("lines")), "quality_rules")


def common_lines(texts: DataFrame, rules: QualityRules) -> DataFrame:
    """(host, line, gist, held): lines that more than ``max_docs`` of the distinct ``texts`` hold.

    A text counts a line once, so partial counts do, and no task gets a frequent line's rows.
    """
    return (texts.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: F.struct(x["line"].alias("line"), x["gist"].alias("gist"))))).alias("l"))
            .groupBy("host", "l.line").agg(F.count(F.lit(1)).alias("held"), F.first("l.gist").alias("gist"))
            .filter(F.col("held") > rules.max_docs))


def common_to_families(texts: DataFrame, common: DataFrame, rules: QualityRules) -> DataFrame:
    """(host, line): the common lines that as many families hold."""
    rows = texts.select("host", "text", F.explode(F.array_distinct("lines")).alias("l")).select("host", "text", "l.line", "l.gist")
    marked = (rows.join(common.select("host", "line", F.lit(True).alias("common")), ["host", "line"], "left")
              .join(common.select("host", "gist", F.lit(True).alias("near")).distinct(), ["host", "gist"], "left"))
    is_common, near = F.col("common").isNotNull(), F.col("near").isNotNull()
    held = marked.groupBy("host", "text").agg(
        F.collect_set(F.when(is_common, F.col("line"))).alias("lines"), F.count_if(~is_common & near).alias("edits"),
        F.count_if(~near).alias("own")).filter(F.size("lines") > 0)
    version = (F.col("edits") > 0) & (F.col("edits") >= F.col("own"))
    family = F.when(version, F.struct(F.array_min("lines").alias("hash"), F.lit(-1).alias("chars"))).otherwise(F.col("text"))
    return (held.select("host", family.alias("family"), F.explode("lines").alias("line"))
            .groupBy("host", "line").agg(F.countDistinct("family").alias("families"), F.count(F.lit(1)).alias("held"))
            .filter((F.col("families") > rules.max_docs) & (F.col("families") >= rules.min_family_share * F.col("held")))
            .select("host", "line"))


def verdicts(docs: DataFrame, rules: QualityRules, text: str = "text", host: str = "source") -> DataFrame:
    """``row``, ``host``, ``text`` (see :func:`read_once`), the results, and ``gone``: the
    hashes of the lines to take out. Only texts with common lines are shuffled by text."""
    stats = read_once(docs, rules, text, host)
    texts = stats.select("host", "text", "lines").dropDuplicates(["host", "text"])
    if rules.spare_versions:
        texts = written(texts, "quality_texts")
    common = written(common_lines(texts, rules), "quality_lines")
    limits = common.select("host", "line", F.lit(True).alias("families"))
    if rules.spare_versions:
        many = common_to_families(texts, common, rules).withColumn("families", F.lit(True))
        limits = written(common.select("host", "line").join(many, ["host", "line"], "left"), "quality_lines")
    among = F.coalesce("families", F.lit(False))
    left = (texts.select("host", "text", F.explode("lines").alias("l")).select("host", "text", "l.line", "l.chars")
            .join(broadcast_if_small(limits), ["host", "line"])
            .groupBy("host", "text").agg(F.sum("chars").alias("cut"), F.sum(F.when(among, F.col("chars")).otherwise(0)).alias("family_cut"),
                                         F.collect_set(F.when(among, F.col("line"))).alias("gone")))
    failed = ((F.col("n_words") < rules.min_words)
              | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    total = F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + x["chars"])
    little = lambda cut: F.col("all_chars") - F.coalesce(cut, F.lit(0)) < rules.min_kept_share * F.col("all_chars")
    return (stats.withColumn("all_chars", total).drop("lines").join(left, ["host", "text"], "left")
            .withColumns({"base_failed": failed, "depleted": little("cut"),
                          "kept_chars": (F.col("all_chars") - F.coalesce("cut", F.lit(0))).cast("long")})
            .withColumn("version", F.col("depleted") & ~little("family_cut"))
            .withColumn("kept", ~F.col("base_failed") & (~F.col("depleted") | F.col("version"))))


def judge(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text", host: str = "source") -> DataFrame:
    """All columns of ``docs`` but the text, with counts and verdicts of each row."""
    rest = [c for c in docs.columns if c not in (text, *RESULT)]
    return verdicts(docs, rules, text, host).select(*[F.col("row").getField(c).alias(c) for c in rest], *RESULT)


def kept_documents(docs: DataFrame, rules: QualityRules = QualityRules(spare_versions=True)) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns, their texts without
    boilerplate lines; ``n_chars`` of changed texts, where it exists, is counted anew.

    Only what fails (a hash each) or changes meets the documents, in a join.
    """
    touched = (verdicts(docs.select("text", "source"), rules).filter(~F.col("kept") | (F.size("gone") > 0))
               .groupBy("host", F.col("text").alias("key")).agg(F.bool_and("kept").alias("kept"), F.first("gone").alias("gone")))
    t = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("source", F.lit("\x00")).alias("host"),
                       F.struct(F.xxhash64(t).alias("hash"), F.length(t).alias("chars")).alias("key"))
    rows = rows.join(touched, ["host", "key"], "left").filter(F.coalesce("kept", F.lit(True)))
    # A blank line has no hash in the set, and null sets leave the text as it is.
    left = F.array_join(F.filter(F.split("row.text", "\n"), lambda x: ~F.array_contains("gone", F.xxhash64(normal(x)))), "\n")
    changed = F.coalesce(F.size("gone") > 0, F.lit(False))
    rows = rows.withColumn("new", F.when(changed, left).otherwise(F.col("row.text")))
    columns = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("new").cast("long")).otherwise(F.col("row.n_chars"))
    return rows.select(*[columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "depleted", "kept_chars", "all_chars")


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, chr(1)) AS host FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
windows AS (SELECT doc_id, len(w) AS n, unnest(CASE WHEN len(w) >= 3 THEN range(1, len(w) - 1) ELSE [] END) AS i, w FROM w),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM windows),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT doc_id, sum(least(3, coalesce(nxt - i, 3))) AS n FROM
  (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM repeated) GROUP BY doc_id),
dl AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
lines AS (SELECT doc_id, host, text, generate_subscripts(l, 1) AS at, unnest(l) AS line FROM
  (SELECT doc_id, host, text, list_filter(list_transform(string_split(text, chr(10)),
     lambda x: trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'))), lambda x: x <> '') AS l FROM d)),
frequent AS (SELECT host, line FROM lines GROUP BY host, line HAVING count(DISTINCT text) > 20),
shares AS (SELECT doc_id, sum(length(l.line)) AS all_chars,
  sum(CASE WHEN f.line IS NULL THEN length(l.line) ELSE 0 END) AS kept_chars
  FROM lines l LEFT JOIN frequent f ON l.host = f.host AND l.line = f.line GROUP BY doc_id),
s AS (SELECT d.doc_id, len(w.w) AS n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  len(dl.l) - len(list_distinct(dl.l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
  coalesce(kept_chars, 0) AS kept_chars, coalesce(all_chars, 0) AS all_chars
  FROM d JOIN w USING (doc_id) JOIN dl USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN shares USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, kept_chars < 0.5 * all_chars AS depleted FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT depleted AS kept, depleted, CAST(kept_chars AS BIGINT) AS kept_chars, CAST(all_chars AS BIGINT) AS all_chars FROM v
"""
