"""Quality rules: plain text counts, and lines that very many documents of a host share.

Words are runs of characters other than space, tab, line feed, vertical tab,
form feed and carriage return.  The base rule fails documents with fewer than
``MIN_WORDS`` words, or with over half of their words in three-word windows
that occur twice or more in the document.

The method: lines are normalised (lower case, white space to one space, none
at the ends) and hashed to 64 bits; lines without a word don't count.  For
each host (``source``) the distinct documents (ids) of each line are counted.
A line is removed from a host's documents if more than ``MIN_DOCS`` of them
have it, however many documents the host has; a caller may ask for a share of
the host's rows besides.  A document is depleted,
and not kept, if removed lines hold more than ``MAX_REMOVED`` of its words or
leave fewer than ``MIN_WORDS``.

DataFrame operations only.  Counts are partly summed before their shuffle, so
a host or line with a third of all rows is one row a task there; the join of
lines with the removed ones has one row a line on one side and may be split on
the other.  Texts are never shuffled: the lines' hashes are.

Defined results: a null or empty text has zero counts and fails the base rule;
a null host is a host of its own; rows with equal doc_id are one document in
the counts (those without an id together, too), whatever their texts, and each
gets the result of its text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import SPACE

MIN_WORDS = 50
MIN_DOCS = 10
MAX_SHARE = 0.0
MAX_REMOVED = 0.5


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def with_repeated_words(df: DataFrame, name: str) -> DataFrame:
    """``df`` with n_repeat_words of its array of words ``name``.

    The windows' hashes are sorted with their places; equal neighbours are the
    repeated ones; each such place in order adds the words that the one before
    doesn't hold.
    """
    n, w = F.size(name), F.col(name)
    windows = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))),
        lambda i: F.struct(F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)).alias("h"), i.alias("i")),
    )
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("_sorted", F.when(n < 4, none).otherwise(F.sort_array(windows)))

    def repeated(x: Column, k: Column) -> Column:
        s = F.col("_sorted")
        return F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))

    df = df.withColumn("_places", F.sort_array(F.transform(F.filter("_sorted", repeated), lambda x: x["i"])))
    added = F.transform("_places", lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), p - F.get(F.col("_places"), k - 1))))
    return df.withColumn("n_repeat_words", F.aggregate(added, F.lit(0).cast("long"), lambda a, x: a + x)).drop("_sorted", "_places")


def base(docs: DataFrame) -> DataFrame:
    """doc_id, host, hash of the text, and the base counts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", F.col("source").alias("_host"), text.alias("_text"))
    df = df.withColumn("_words", words(F.col("_text")))
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = with_repeated_words(df, "_words")
    return df.select(
        "doc_id",
        "_host",
        F.xxhash64("_text").alias("_hash"),
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def lines(docs: DataFrame) -> DataFrame:
    """A row for each document and normalised line with a word: the line's hash and number of words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", F.col("source").alias("_host"), F.xxhash64(text).alias("_hash"), F.split(text, "\n").alias("_lines"))
    one = F.filter(F.transform("_lines", normalised), lambda x: x != "")
    df = df.select("doc_id", "_host", "_hash", one.alias("_lines"))
    hashed = F.transform("_lines", lambda x: F.struct(F.xxhash64(x).alias("h"), F.size(F.split(x, " ")).alias("n")))
    df = df.select("doc_id", "_host", "_hash", F.explode(hashed).alias("x"))
    return df.select("doc_id", "_host", "_hash", F.col("x.h").alias("_line"), F.col("x.n").alias("_n"))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, host, line hash) for each row and distinct normalised line."""
    text = F.coalesce(F.col("text"), F.lit(""))
    one = F.filter(F.transform(F.split(text, "\n"), normalised), lambda x: x != "")
    hashed = F.array_distinct(F.transform(one, lambda x: F.xxhash64(x)))
    return docs.select("doc_id", F.col("source").alias("_host"), F.explode(hashed).alias("_line"))


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(host, line hash, documents) of the lines above the limits."""
    hosts = docs.groupBy(F.col("source").alias("_h")).agg(F.count("*").alias("_in_host"))
    # The id is in the first shuffle's key, so a line of very many documents is many groups there.
    distinct = F.count_distinct(F.struct("doc_id"))
    many = distinct_lines(docs).groupBy("_host", "_line").agg(distinct.alias("n_docs")).where(F.col("n_docs") > min_docs)
    if max_share <= 0:
        return many
    many = many.join(hosts, F.col("_host").eqNullSafe(F.col("_h")))
    return many.where(F.col("n_docs") > F.lit(max_share) * F.col("_in_host")).select("_host", "_line", "n_docs")


def _removed(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Words in removed lines of each different document, and their lines' hashes."""
    bad = frequent.select(F.coalesce(F.col("_host"), F.lit("")).alias("_a"), F.col("_host").isNull().alias("_b"), F.col("_line"))
    rows = lines(docs).withColumn("_a", F.coalesce(F.col("_host"), F.lit(""))).withColumn("_b", F.col("_host").isNull())
    hit = rows.join(bad, ["_line", "_a", "_b"])
    # The words of rows that are equal add up here; the report divides by the number of such rows.
    key = ["doc_id", "_host", "_hash"]
    return hit.groupBy(*key).agg(F.sum("_n").cast("long").alias("_gone"), F.collect_set("_line").alias("_removed"))


def report(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_removed: float = MAX_REMOVED) -> DataFrame:
    """Per document: the base counts, base_failed, n_removed_words, n_removed_lines (distinct) and kept."""
    counts = base(docs)
    gone = _removed(docs, frequent_lines(docs, min_docs, max_share))
    gone = gone.select(
        F.col("doc_id").alias("_d"), F.col("_host").alias("_g"), F.col("_hash").alias("_k"), "_gone", F.size("_removed").cast("long").alias("_some")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("_host").eqNullSafe(F.col("_g")) & (F.col("_hash") == F.col("_k"))
    copies = counts.groupBy("doc_id", "_host", *[c for c in counts.columns if c not in ("doc_id", "_host")]).agg(F.count("*").alias("_copies"))
    df = copies.join(gone, same, "left")
    removed = F.coalesce((F.col("_gone") / F.col("_copies")).cast("long"), F.lit(0).cast("long"))
    df = df.withColumn("n_removed_words", removed).withColumn("n_removed_lines", F.coalesce("_some", F.lit(0).cast("long")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = (F.col("n_removed_words") > F.lit(max_removed) * F.col("n_words")) | (F.col("n_words") - F.col("n_removed_words") < MIN_WORDS)
    df = df.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
    df = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "n_removed_lines", "kept"
    )


def cleaned(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """``docs`` with the removed lines taken out of the text (all occurrences, with their line ends)."""
    gone = _removed(docs, frequent_lines(docs, min_docs, max_share)).select(
        F.col("doc_id").alias("_d"), F.col("_host").alias("_g"), F.col("_hash").alias("_k"), "_removed"
    )
    work = docs.withColumn("_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_g")) & (F.col("_hash") == F.col("_k"))
    work = work.join(gone, same, "left")
    left = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains("_removed", F.xxhash64(normalised(x))))
    text = F.when(F.col("_removed").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return work.withColumn("text", text).select(*docs.columns)


#: The report in DuckDB's SQL.
SQL = rf"""
with d as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents
), w as (
  select r, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) as n_symbols
  from d
), g as (
  select r, i, (w[i], w[i + 1], w[i + 2]) as g from (select r, w, unnest(range(1, len(w) - 1)) as i from w where len(w) > 2)
), t as (
  select distinct r, i + k as p from (
    select r, i, count(*) over (partition by r, g) as n from g
  ), (select unnest([0, 1, 2]) as k) where n > 1
), q as (
  select r, count(*) as n from t group by r
), x as (
  select r, doc_id, coalesce(cast(doc_id as varchar), '-') as i, source, trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') as line from d
), f as (
  select source, line from x where line <> '' group by source, line having count(distinct i) > {MIN_DOCS}
), z as (
  select r, sum(len(string_split(x.line, ' '))) as words, count(distinct x.line) as lines
  from x join f on x.line = f.line and x.source is not distinct from f.source group by r
), o as (
  select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, n_symbols,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(q.n, 0) as n_repeat_words,
    coalesce(z.words, 0) as n_removed_words, coalesce(z.lines, 0) as n_removed_lines
  from w join d using (r) left join q using (r) left join z using (r)
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
  n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed,
  cast(n_removed_words as bigint) as n_removed_words, cast(n_removed_lines as bigint) as n_removed_lines,
  not (n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words
       or n_removed_words > {MAX_REMOVED} * n_words or n_words - n_removed_words < {MIN_WORDS}) as kept
from o
"""
