"""Line dedup: passages of three consecutive lines that occur again, anywhere, lose their later copies.

Lines end at ``\\n``. Blank lines (only spaces, tabs, carriage returns) are kept and not part of any
window; a window is three non-blank lines in a row, identified by 128 bits of hashes. The first
occurrence of a window is the one of the smallest (doc_id, text hash, line); every other one covers its
lines, except those that it shares with that first occurrence, and all covered lines go.
Only DataFrame functions are used.

Nulls and empties: a null text stays null and has no lines, an empty text has one blank line. A null
doc_id sorts first. Rows that repeat both doc_id and text are one document: all of them keep the
same lines. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import query, table

WINDOW_LINES = 3


def _blank(line: Column) -> Column:
    return F.length(F.translate(line, " \t\r", "")) == 0


def _lines(docs: DataFrame) -> DataFrame:
    return docs.withColumn("lines", F.split("text", "\n", -1))


def _windows(docs: DataFrame) -> DataFrame:
    """(doc_id, th, w, places, k1, k2): a row per window; places: the numbers of its lines."""
    numbered = F.transform("lines", lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    solid = F.filter(numbered, lambda x: ~_blank(x["line"]))
    hashed = F.transform(solid, lambda x: F.struct(x["i"].alias("i"), F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(1), x["line"]).alias("b")))
    # inline() puts the hashes of a document in columns of their own, so that no lambda computes them again.
    at = F.col("h")
    last = F.size(at) - WINDOW_LINES
    one = lambda i, name: [at[i + j][name] for j in range(WINDOW_LINES)]
    windows = F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)),
        lambda i: F.struct(i.alias("w"), F.array(*one(i, "i")).alias("places"), F.xxhash64(*one(i, "a")).alias("k1"), F.xxhash64(F.lit(1), *one(i, "b")).alias("k2")),
    )
    each = _lines(docs).select("doc_id", "th", F.inline(F.array(F.struct(hashed.alias("h")))))
    return each.select("doc_id", "th", F.inline(windows))


def remove_repeated_windows(docs: DataFrame) -> DataFrame:
    """(row, text, n_lines, n_removed) per row of ``docs(doc_id, text, ...)``: ``row`` holds the input
    columns, ``text`` what is left of the text."""
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    windows = _windows(slim)
    place = F.struct("doc_id", "th", "w")
    # Sums per key are combined before the shuffle, so a window in a third of the documents is no large group.
    repeated = windows.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    same = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & F.col("first.th").eqNullSafe(F.col("th"))
    # Lines w, w+1, w+2 of which those up to first.w + 2 belong to the first occurrence.
    shared = F.when(same, F.greatest(F.lit(0), F.col("first.w") + WINDOW_LINES - F.col("w"))).otherwise(0)
    covered = (
        windows.join(repeated, ["k1", "k2"])
        .where(place > F.col("first"))
        .select("doc_id", "th", F.explode(F.slice("places", shared + 1, WINDOW_LINES)).alias("line"))
        .groupBy("doc_id", "th")
        .agg(F.collect_set("line").alias("gone"))  # at most the lines of one document
    )
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    joined = packed.join(covered, F.col("id").eqNullSafe(F.col("doc_id")) & F.col("hash").eqNullSafe(F.col("th")), "left")
    lines = joined.select("row", F.coalesce("gone", F.array().cast("array<int>")).alias("gone"), F.split(F.col("row.text").cast("string"), "\n", -1).alias("lines"))
    n_lines = F.coalesce(F.size("lines"), F.lit(0))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))  # a hash set difference
    return lines.select(
        "row",
        F.when(F.size("gone") == 0, F.col("row.text").cast("string")).otherwise(F.array_join(F.transform(places, lambda i: F.col("lines")[i]), "\n")).alias("text"),
        F.when(F.col("lines").isNull(), 0).otherwise(n_lines).cast("bigint").alias("n_lines"),
        F.size("gone").cast("bigint").alias("n_removed"),
    )


def emptied(text: Column, n_removed: Column) -> Column:
    """Whether the removal left nothing but blanks."""
    return (n_removed > 0) & (F.length(F.translate(text, " \t\r\n", "")) == 0)


_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents
), solid AS (
    SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS w
    FROM lines WHERE length(translate(line, chr(32) || chr(9) || chr(13), '')) > 0
), windows AS (
    SELECT s.doc_id, s.w, [s.i, t.i, u.i] AS places, [s.line, t.line, u.line] AS key
    FROM solid s JOIN solid t ON t.doc_id = s.doc_id AND t.w = s.w + 1 JOIN solid u ON u.doc_id = s.doc_id AND u.w = s.w + 2
), firsts AS (
    SELECT key, min(struct_pack(d := doc_id, w := w)) AS f FROM windows GROUP BY key HAVING count(*) > 1
), gone AS (
    SELECT DISTINCT doc_id, i FROM (
        SELECT w.doc_id, unnest(w.places) AS i, w.w + unnest([0, 1, 2]) AS spot, f.f AS f
        FROM windows w JOIN firsts f ON f.key = w.key WHERE (w.doc_id, w.w) <> (f.f.d, f.f.w)
    ) WHERE doc_id <> f.d OR spot > f.w + 2
), kept AS (
    SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
        string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS text
    FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
    CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


@query("op4_line_windows", _SQL)
def op4_line_windows(spark, sf_dir) -> DataFrame:
    return remove_repeated_windows(table(spark, sf_dir, "documents")).select("row.doc_id", "n_lines", "n_removed", "text")
