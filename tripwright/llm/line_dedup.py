"""Line dedup with levelled sorted runs, in DataFrame operations only.

A run is a table of line keys, sorted by the key's hash, with the number of documents that hold the key and the
largest id among them. Documents come in batches. Each batch makes a run of its own keys on level 0; as soon as a
level has ``FAN_IN`` runs they are merged into one of the next level, so that a key lies in few runs and old runs are
rarely rewritten. A batch is then joined with the runs: ``fresh_lines`` anti-joins them and keeps the lines that no
earlier batch had; ``drop_repeated`` joins the keys that the compacted runs hold often.

A key is a line without the ASCII white space at its ends and with A-Z in lower case; it stands in runs as two
64-bit hashes with different seeds (128 bits). Hot keys are counted in part before each shuffle, and every join on a
key is a plain sort-merge join that adaptive execution splits where it is skewed.

Defined cases: a null or empty text is one empty line and stays an empty text; keys shorter than ``min_chars`` and
lines in fewer than ``min_docs`` different ids stay; rows with one id count as one document, and of an id that is the
largest all its rows keep the line, repeated rows too. A null id is the least id. Extra columns are ignored, or kept
where whole rows are returned; rows travel as one struct, so that no name of theirs can clash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.llm.common import NULL_ID, written

MIN_CHARS = 40
MIN_DOCS = 5
#: Runs of one level that are merged into one of the next, and batches of one job.
FAN_IN = 4
BATCHES = 4
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SECOND_SEED = 7_919


def line_key(line: Column) -> Column:
    """The line as it is compared. ``lower`` is the same as A-Z in lower case where all characters are ASCII."""
    bare = F.trim(line, F.lit(SPACES))
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def key_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(SECOND_SEED), key).alias("b"))


def lines_of(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(_id, _a, _b) of each line that is long enough."""
    line = F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("_line")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("_id"), line)
    keyed = rows.where(F.length("_line") >= min_chars).select("_id", line_key(F.col("_line")).alias("_key"))
    return keyed.where(F.length("_key") >= min_chars).select(
        "_id", F.xxhash64("_key").alias("_a"), F.xxhash64(F.lit(SECOND_SEED), "_key").alias("_b")
    )


def merged(run: DataFrame) -> DataFrame:
    return run.groupBy("_a", "_b").agg(F.sum("_docs").alias("_docs"), F.max("_last").alias("_last"))


@dataclass
class LevelledRuns:
    """Sorted runs by level. Batches have to hold different ids, as counts of runs are added."""

    spark: SparkSession
    levels: list[list[DataFrame]] = field(default_factory=list)

    def add(self, lines: DataFrame) -> None:
        """Add the run of one batch, given as (_id, _a, _b)."""
        once = lines.groupBy("_a", "_b", "_id").agg(F.lit(1).alias("_docs"))
        run = once.groupBy("_a", "_b").agg(F.sum("_docs").alias("_docs"), F.max("_id").alias("_last"))
        self.put(0, written(run, "lines-0", "_a", "_b"))

    def put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= FAN_IN:
            runs, self.levels[level] = self.levels[level], []
            self.put(level + 1, written(merged(union(runs)), f"lines-{level + 1}", "_a", "_b"))

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def keys(self) -> DataFrame:
        """All keys with their counts, one row for each."""
        runs = self.runs()
        return runs[0] if len(runs) == 1 else merged(union(runs))

    def fresh(self, lines: DataFrame) -> DataFrame:
        """Lines whose key is in none of the runs: a merge anti-join with each."""
        for run in self.runs():
            lines = lines.join(run.select("_a", "_b").hint("merge"), ["_a", "_b"], "left_anti")
        return lines


def union(runs: list[DataFrame]) -> DataFrame:
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run)
    return out


def batch_of(batches: int) -> Column:
    return F.pmod(F.xxhash64("_id"), F.lit(batches))


def repeated_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> tuple[DataFrame, DataFrame]:
    """The lines as a table (_id, _a, _b), and the keys (_a, _b, _last) found in enough documents."""
    lines = written(lines_of(docs, id_col, text_col, min_chars), "lines")
    runs = LevelledRuns(docs.sparkSession)
    for k in range(batches):
        runs.add(lines.where(batch_of(batches) == k))
    return lines, runs.keys().where(F.col("_docs") >= min_docs).select("_a", "_b", "_last")


def split_rows(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """(row, own, gone, every, kept): each whole row beside its lines and those that stay."""
    lines, keys = repeated_keys(docs, id_col, text_col, min_chars, min_docs, batches)
    gone = (
        lines.join(keys.hint("merge"), ["_a", "_b"])
        .where(F.col("_id") != F.col("_last"))
        .groupBy("_id")
        .agg(F.collect_set(F.struct(F.col("_a").alias("a"), F.col("_b").alias("b"))).alias("gone"))
    )
    split = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("own"), split.alias("every")
    )
    joined = rows.join(gone.hint("merge"), F.col("own") == F.col("_id"), "left").drop("_id")

    def stays(line: Column) -> Column:
        return (F.length(line) < min_chars) | ~F.array_contains(F.col("gone"), key_hash(line_key(line)))

    return joined.withColumn("kept", F.when(F.col("gone").isNull(), F.col("every")).otherwise(F.filter("every", stays)))


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """The same rows and columns, the text without its repeated lines."""
    out = split_rows(docs, id_col, text_col, min_chars, min_docs, batches)
    own = F.col("row")
    text = F.when(F.col("gone").isNull(), own.getField(text_col)).otherwise(F.array_join("kept", "\n"))
    return out.select(*((text if c == text_col else own.getField(c)).alias(c) for c in docs.columns))


def fresh_lines(batch: DataFrame, runs: LevelledRuns, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(_id, _a, _b) of the lines of a new batch that no run has; the batch's own run is added afterwards."""
    lines = written(lines_of(batch, id_col, text_col, min_chars), "lines")
    fresh = written(runs.fresh(lines), "fresh")
    runs.add(lines)
    return fresh


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of each row."""
    out = split_rows(docs.select(id_col, text_col), id_col, text_col, min_chars, min_docs, batches)
    lines, kept = F.size("every").cast("long"), F.size("kept").cast("long")
    return out.select(
        F.col("row").getField(id_col).alias(id_col), lines.alias("n_lines"), (lines - kept).alias("n_dropped"), F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256")
    )


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS i, str_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents
), l AS (
  SELECT r, doc_id, i, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), often AS (
  SELECT key, max(i) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT i) >= 5
), m AS (
  SELECT k.*, often.key IS NOT NULL AND k.i <> often.last AS gone FROM k LEFT JOIN often ON k.key = often.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
