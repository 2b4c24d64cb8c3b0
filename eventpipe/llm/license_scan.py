"""License scan by ordered signature rules.

Texts become lower-case words. A word that is the keyword of a rule lets the
rules of this keyword, and no others, look at the words around it; texts without
any keyword meet no regular expression. Every match is a detection, an interval
of words. A detection that lies within another one, of a stronger rule, or of one
as strong that matched more words or stands earlier in the list, is suppressed.
Detections of the base phrases always stay.

Intervals span ``LEFT + RIGHT`` words at most, so whatever suppresses a detection
begins that few words before it: a window of that range looks for it, and a very
long text with very many detections needs no more memory than a short one.

Only DataFrame functions are used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventpipe.llm.common import Scratch, ascii_lower
from eventpipe.llm.license_rules import Rule, rules

NOT_IN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words before and from a keyword that a signature can see.
LEFT, RIGHT = 24, 32

def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_IN_WORDS, -1), "")


def _words_in(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def _literal(signature: str) -> str:
    """What a signature begins with, letter by letter, up to its first optional or alternative part."""
    plain = re.match("[a-z0-9 ]*", signature)[0]
    return plain[:-1] if signature[len(plain) : len(plain) + 1] in ("?", "*", "+", "{") else plain


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_table(spark: SparkSession, all_rules: list[Rule]) -> DataFrame:
    """A row for each rule and spelling of its keyword. ``begins`` and ``ends`` are plain text that a match must have."""
    rows = []
    for r in all_rules:
        for keyword in r.keywords:
            begins = keyword + _literal(r.right[re.match(r"(?:[a-z0-9]|\[cs\])+", r.right).end() :])
            ends = re.search("[a-z0-9 ]*$", r.left)[0]
            texts = (keyword, r.label, f" {r.left}$", f"^{r.right} ", begins, ends)
            rows.append(f"({r.number}, {r.priority}, {str(r.base).lower()}, {r.strength}D, {', '.join(map(_quoted, texts))})")
    names = "rule, priority, base, strength, word, label, before, after, begins, ends"
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS rules({names})")


def scan(docs: DataFrame, scratch: Scratch, all_rules: list[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """(texts, detections) of ``docs`` (doc_id, text, more).

    ``texts``: (row, doc_id, n_words) for every row, ``row`` being a number given
    to it here. ``detections``: (row, start, end, rule, label, base, strength),
    words from 0, ``end`` included; suppressed ones are left out.

    A null text is empty and holds nothing. Rows keep their number: repeated ones,
    and different texts under one doc_id or none, are scanned each by itself.
    Other columns are ignored. A text is scanned whole, whatever its length. An
    empty table gives empty ones.
    """
    all_rules = all_rules or rules()
    keywords = sorted({k for rule in all_rules for k in rule.keywords})
    words = F.explode(F.array(words_of(F.col("text")))).alias("words")  # a one-row generator: cut once for all uses
    spaced = lambda part: F.array_join(part, " ")
    hit = F.transform(
        "words",
        lambda w, i: F.when(
            w.isin(keywords),
            F.struct(
                i.cast("long").alias("at"),
                w.alias("word"),
                F.concat(F.lit(" "), spaced(F.slice("words", F.greatest(i - LEFT, F.lit(0)) + 1, F.least(i, F.lit(LEFT)))), F.when(i > 0, " ").otherwise("")).alias("left"),
                F.concat(spaced(F.slice("words", i + 1, F.lit(RIGHT))), F.lit(" ")).alias("right"),
            ),
        ),
    )
    texts = scratch.settle(
        docs.select("doc_id", words).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), F.array_compact(hit).alias("hits")
        ),
        "texts",
    )
    hits = texts.where(F.size("hits") > 0).select("row", F.explode("hits").alias("hit"))
    # The rules are as many as stand in the list. Plain text is compared before a regular expression is.
    tried = hits.select("row", "hit.*").join(F.broadcast(rule_table(docs.sparkSession, all_rules)), "word")
    tried = tried.where(F.startswith("right", "begins") & F.endswith("left", "ends"))
    matched = tried.select(
        "row", "at", "rule", "priority", "base", "strength", "label",
        F.expr("regexp_extract(left, before, 0)").alias("m"),
        F.expr("regexp_extract(right, after, 0)").alias("n"),
    ).where((F.col("m") != "") & (F.col("n") != ""))
    ranked = matched.select(
        "row", "rule", "priority", "base", "strength", "label",
        (F.col("at") - (_words_in(F.col("m")) - 1)).alias("start"),
        (F.col("at") + _words_in(F.col("n")) - 1).alias("end"),
    )
    # The order of rules: the least struct is the strongest.
    standing = F.struct("priority", (F.col("start") - F.col("end")).alias("shorter"), "rule")
    near = Window.partitionBy("row").orderBy("start").rangeBetween(-(LEFT + RIGHT), 0)
    around = ranked.withColumn("standing", standing).withColumn("near", F.collect_list(F.struct("start", "end", "standing")).over(near))
    holds = F.exists("near", lambda o: (o["end"] >= F.col("end")) & (o["standing"] < F.col("standing")))
    kept = around.where(F.col("base") | ~holds)
    detections = kept.select("row", "start", "end", "rule", "label", "base", "strength")
    return texts.drop("hits"), detections


def licenses(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the strength of the strongest rule left. See ``scan``.
    """
    texts, detections = scan(docs, scratch)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    base = lambda c: F.when(F.col("base"), F.col(c))
    found = detections.groupBy("row").agg(
        F.count_if("base").alias("n_base"),
        F.min(base("start")).alias("first_word"),
        F.max(base("start")).alias("last_word"),
        joined(base("label")).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("strength").alias("score"),
    )
    return texts.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses of every text of ``documents``."""
    return licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "licenses"))


def _values() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    rows = [
        f"({r.number}, {quoted(keyword)}, {quoted(r.label)}, {r.priority}, {str(r.base).lower()}, {r.strength}::DOUBLE, "
        f"{quoted(' ' + r.left + '$')}, {quoted('^' + r.right + ' ')})"
        for r in rules()
        for keyword in r.keywords
    ]
    return ",\n".join(rows)


ORACLE = rf"""
WITH rules(rule, keyword, label, priority, base, strength, before, after) AS (VALUES {_values()}),
texts AS (
  SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
),
hits AS (
  SELECT row, i, words[i + 1] AS word,
    ' ' || CASE WHEN i > 0 THEN array_to_string(words[greatest(i - {LEFT}, 0) + 1 : i], ' ') || ' ' ELSE '' END AS l,
    array_to_string(words[i + 1 : i + {RIGHT}], ' ') || ' ' AS r
  FROM (SELECT row, words, unnest(range(0, len(words))) AS i FROM texts) WHERE words[i + 1] IN (SELECT keyword FROM rules)
),
found AS (
  SELECT row, rule, label, priority, base, strength,
    i - (length(m) - length(replace(m, ' ', '')) - 1) AS first, i + length(n) - length(replace(n, ' ', '')) - 1 AS last
  FROM (SELECT hits.*, rules.*, regexp_extract(l, before) AS m, regexp_extract(r, after) AS n FROM hits JOIN rules ON keyword = word)
  WHERE m <> '' AND n <> ''
),
kept AS (
  SELECT * FROM found a WHERE base OR NOT EXISTS (
    SELECT 1 FROM found b WHERE b.row = a.row AND b.first <= a.first AND b.last >= a.last
      AND (b.priority, b.first - b.last, b.rule) < (a.priority, a.first - a.last, a.rule)
  )
)
SELECT doc_id, any_value(len(words))::BIGINT AS n_words, count(*) FILTER (WHERE base) AS n_base,
  min(first) FILTER (WHERE base)::BIGINT AS first_word, max(first) FILTER (WHERE base)::BIGINT AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(strength), 0) AS score
FROM texts LEFT JOIN kept USING (row) GROUP BY row, doc_id
"""
