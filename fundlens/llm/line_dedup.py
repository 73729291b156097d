"""Content-defined line chunks: globally repeated multi-line chunks are removed.

DataFrame functions only.  Line hashes feed a rolling hash over ``window`` lines; a
chunk ends where that hash is 0 modulo ``divisor``, so boundaries depend on the lines
around them alone and fall alike wherever the same lines stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import materialise

WINDOW = 2
DIVISOR = 4


def line_chunks(text: Column, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """Array of chunks; a chunk is its lines, each behind one mark, joined by line feeds.

    The mark keeps a line from being empty, so that an empty line cannot be taken for
    the doubled line feed that parts two chunks.
    """
    lines = F.split(text, "\n", -1)
    hashes = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("long"))
    rolling = hashes
    for k in range(1, window):
        earlier = F.concat(F.array_repeat(F.lit(0).cast("long"), k), hashes)
        rolling = F.zip_with(rolling, F.slice(earlier, 1, F.size(lines)), _add_times(31**k))
    ends = F.transform(rolling, lambda r, i: (r % divisor == 0) & (i < F.size(lines) - 1))
    marked = F.zip_with(lines, ends, lambda x, e: F.concat(F.lit("x"), x, F.when(e, "\n").otherwise("")))
    return F.split(F.array_join(marked, "\n"), "\n\n", -1)


def _add_times(factor: int):
    return lambda a, b: a + b * factor


def _contents(chunk: Column) -> Column:
    """Lines of a chunk without their marks."""
    return F.transform(F.split(chunk, "\n", -1), lambda x: F.substr(x, F.lit(2)))


def dedup_lines(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove chunks of at least two non-blank lines that stand elsewhere before.

    The first place of a chunk, by id and position, stays; the others go.  Chunks count as
    equal when their bytes are: they are grouped by hash and content.  A hash that two
    different contents share marks neither as repeated.  Returns doc_id, text (null stays
    null), n_lines and n_removed (lines; null text has none).  Rows with a null id keep
    their text and count nowhere; rows that repeat an id count as the same places; an
    empty table gives no rows; other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    gone = repeated_chunks(docs, window, divisor)
    kept = kept_lines(F.col("text"), F.col("gone"), window, divisor)
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    return (docs.join(gone, "doc_id", "left")
            .withColumns({"n_lines": n_lines, "left": F.when(F.col("gone").isNotNull(), kept)})
            .select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join("left", "\n")).alias("text"),
                    "n_lines",
                    F.when(F.col("gone").isNull(), 0).otherwise(F.col("n_lines") - F.size("left")).alias("n_removed")))


def kept_lines(text: Column, gone: Column, window: int = WINDOW, divisor: int = DIVISOR) -> Column:
    """The lines of a text without the chunks whose numbers are in ``gone``."""
    parts = F.transform(line_chunks(text, window, divisor), lambda c, i: F.struct(i.alias("i"), c.alias("c")))
    kept = F.filter(parts, lambda p: ~F.array_contains(gone, p["i"]))
    return F.flatten(F.transform(kept, lambda p: _contents(p["c"])))


def repeated_chunks(docs: DataFrame, window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """(doc_id, gone): numbers of the chunks that stand elsewhere before, for documents with any."""
    chunks = (docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
              .select("doc_id", F.posexplode(line_chunks(F.col("text"), window, divisor)).alias("no", "chunk"))
              .where(F.col("chunk").contains("\n"))
              .where(F.size(F.filter(_contents(F.col("chunk")), lambda x: F.trim(x) != "")) > 1)
              .withColumn("hash", F.md5("chunk")))
    same = chunks.groupBy("hash", "chunk").agg(F.min(F.struct("doc_id", "no")).alias("first"),
                                               F.max(F.struct("doc_id", "no")).alias("last"))
    repeated = (same.select("hash", "first", "last").groupBy("hash")
                .agg(F.count(F.lit(1)).alias("contents"), F.min("first").alias("first"), F.max("last").alias("last"))
                .where("contents = 1 AND first <> last").select("hash", "first"))
    repeated = materialise(repeated, "chunks-repeated")
    return (chunks.select("doc_id", "no", "hash").join(repeated, "hash")
            .where(F.struct("doc_id", "no") != F.col("first"))
            .groupBy("doc_id").agg(F.collect_set("no").alias("gone")))


#: The same by DuckDB, for unique ids.
SQL = """
WITH line AS (
  SELECT doc_id, i, l, CAST('0x' || substr(md5(l), 1, 7) AS BIGINT) AS h
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
               generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL)),
cut AS (
  SELECT *, CASE WHEN (h + 31 * coalesce(lag(h) OVER w, 0)) % 4 = 0 THEN 1 ELSE 0 END AS e
  FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, coalesce(sum(e) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no
  FROM cut),
chunk AS (
  SELECT doc_id, no, string_agg(l, chr(10) ORDER BY i) AS c, count(*) AS n,
         count(*) FILTER (trim(l, ' ') <> '') AS filled
  FROM numbered GROUP BY doc_id, no),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY c, n > 1 AND filled > 1 ORDER BY doc_id, no) AS place FROM chunk),
judged AS (SELECT *, n > 1 AND filled > 1 AND place > 1 AS gone FROM ranked),
doc AS (
  SELECT doc_id, coalesce(string_agg(c, chr(10) ORDER BY no) FILTER (NOT gone), '') AS text,
         CAST(sum(n) AS INTEGER) AS n_lines, CAST(coalesce(sum(n) FILTER (gone), 0) AS INTEGER) AS n_removed
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, doc.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN doc ON d.doc_id = doc.doc_id
"""
