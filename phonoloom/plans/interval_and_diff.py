"""Queries of the interval and difference operators, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phonoloom.operators import diff, intervals
from phonoloom.session import table

#: A stretch without a timed word counts as a gap from this length on.
LEAST_GAP_MS = 250


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = intervals.word_spans(table(spark, sf_dir, "aligned_transcripts"), "rec_id")
    return intervals.gaps(words, LEAST_GAP_MS).withColumnRenamed("entity", "rec_id")


def p1_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = intervals.word_spans(table(spark, sf_dir, "aligned_transcripts"), "rec_id")
    return intervals.periods(words).select(F.col("entity").alias("rec_id"), "period_start_ms", "period_end_ms")


def p7_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff.table_differences(
        table(spark, sf_dir, "transcripts"), table(spark, sf_dir, "transcripts_mirror"),
        "transcript_id", ["path", "language"], ["segments"], "transcripts", "mirror",
    )


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_differences(spark, sf_dir).select("transcript_id", "kind", F.col("position").alias("seg_no"))


_TIMED = """
w AS (
  SELECT rec_id, CAST(round(u.start * 1000) AS BIGINT) AS s, CAST(round(u."end" * 1000) AS BIGINT) AS e
  FROM (SELECT rec_id, unnest(word_segments) AS u FROM aligned_transcripts WHERE rec_id IS NOT NULL)
  WHERE u.start >= 0 AND u."end" > u.start AND isfinite(u.start) AND isfinite(u."end")),
m AS (
  SELECT rec_id, s, e, max(e) OVER (PARTITION BY rec_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe
  FROM w)
"""
_PAIRS = """
a AS (SELECT DISTINCT transcript_id AS id, path, language, segments FROM transcripts WHERE transcript_id IS NOT NULL),
b AS (SELECT DISTINCT transcript_id AS id, path, language, segments FROM transcripts_mirror WHERE transcript_id IS NOT NULL),
j AS (SELECT a.id AS aid, b.id AS bid, a.path AS ap, b.path AS bp, a.language AS al, b.language AS bl,
             a.segments AS x, b.segments AS y FROM a FULL JOIN b ON a.id = b.id),
h AS (SELECT * FROM j WHERE aid IS NOT NULL AND bid IS NOT NULL),
p AS (SELECT aid, x, y, unnest(range(greatest(len(x), len(y)))) AS i FROM h WHERE x IS NOT NULL AND y IS NOT NULL),
d AS (
  SELECT aid AS transcript_id, 'missing_in_mirror' AS kind, -1 AS pos, CAST(NULL AS VARCHAR) AS lv, CAST(NULL AS VARCHAR) AS rv FROM j WHERE bid IS NULL
  UNION ALL SELECT bid, 'missing_in_transcripts', -1, NULL, NULL FROM j WHERE aid IS NULL
  UNION ALL SELECT aid, 'path', -1, ap, bp FROM h WHERE ap IS DISTINCT FROM bp
  UNION ALL SELECT aid, 'language', -1, al, bl FROM h WHERE al IS DISTINCT FROM bl
  UNION ALL SELECT aid, 'segments', -1, CAST(to_json(x) AS VARCHAR), CAST(to_json(y) AS VARCHAR) FROM h WHERE (x IS NULL) <> (y IS NULL)
  UNION ALL SELECT aid, 'segments', i, x[i + 1].text, y[i + 1].text FROM p
            WHERE (i < len(x)) <> (i < len(y)) OR x[i + 1].text IS DISTINCT FROM y[i + 1].text)
"""
QUERIES = {"p1_found": p1_found, "p1_periods": p1_periods, "p7_found": p7_found, "p7_differences": p7_differences}
SQL = {
    "p1_found": f"WITH {_TIMED} SELECT rec_id, pe AS gap_start_ms, s AS gap_end_ms FROM m WHERE s - pe >= {LEAST_GAP_MS}",
    "p1_periods": f"""WITH {_TIMED},
n AS (SELECT rec_id, s, e, sum(CASE WHEN pe IS NULL OR s > pe THEN 1 ELSE 0 END) OVER (PARTITION BY rec_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT rec_id, min(s) AS period_start_ms, max(e) AS period_end_ms FROM n GROUP BY rec_id, k""",
    "p7_found": f"WITH {_PAIRS} SELECT transcript_id, kind, CAST(pos AS INTEGER) AS seg_no FROM d",
    "p7_differences": f"WITH {_PAIRS} SELECT transcript_id, kind, CAST(pos AS INTEGER) AS position, lv AS left_value, rv AS right_value FROM d",
}
