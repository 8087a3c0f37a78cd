"""Lines that repeat across documents, by levelled sorted runs of line hashes.

A run is a sorted table of line hashes, each with the number of documents that hold the line and the largest id among
them. Each batch of documents writes one run of its own; when a level holds ``fanout`` runs they are merged into one run
of the next level, so that a batch is rewritten only a logarithmic number of times. A batch is not anti-joined with the
runs: counts and largest ids need its known lines too. Documents are then stripped by a join of their lines with the
repeated ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmart.llm.common import SPACES, ascii_lower, fingerprint, written
from rillmart.session import run_folder

MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FANOUT = 4, 3
RUN = "h1 BIGINT, h2 BIGINT, docs BIGINT, top BIGINT"


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _hashes(line: Column) -> Column:
    h1, h2 = fingerprint(ascii_lower(_stripped(line)))
    return F.struct(h1.alias("h1"), h2.alias("h2"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """The levels of runs below one folder; ``levels`` lists the folders of the live runs, newest last."""

    def __init__(self, spark: SparkSession, folder: str | None = None, fanout: int = FANOUT, min_chars: int = MIN_CHARS):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.fanout, self.min_chars = spark, fanout, min_chars
        self.folder = folder or run_folder(spark, "line_runs")
        self.levels: list[list[str]] = []
        self._made = 0

    def add(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Write the batch's own run. A document counts once for each line, however often it holds it."""
        long = F.filter(_lines(F.col(text_col)), lambda x: F.char_length(_stripped(x)) >= self.min_chars)
        held = batch.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.transform(long, _hashes))).alias("key"))
        run = held.groupBy("key.h1", "key.h2").agg(F.count("*").alias("docs"), F.max("id").cast("long").alias("top"))
        self._put(0, run)

    def _put(self, level: int, run: DataFrame) -> None:
        path = f"{self.folder}/level={level}/run={self._made:06d}"
        self._made += 1
        run.sortWithinPartitions("h1", "h2").write.parquet(path)
        self.levels += [[] for _ in range(level + 1 - len(self.levels))]
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            merged = self._merged(self.levels[level])
            self.levels[level] = []
            self._put(level + 1, merged)

    def _merged(self, paths: list[str]) -> DataFrame:
        runs = self.spark.read.schema(RUN).parquet(*paths)
        return runs.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """h1, h2, top of the lines that at least ``min_docs`` documents hold."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return self.spark.sql("SELECT 0L AS h1, 0L AS h2, 0L AS top").where("false")
        return self._merged(paths).where(F.col("docs") >= min_docs).select("h1", "h2", "top")

    def strip(self, docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``docs`` without its repeated lines, but for those of the largest id that holds them.

        All columns stay, but for names with two leading underscores, which are used here; ``text_col`` has the remaining
        lines, and ``__n_lines``, ``__n_dropped`` are added. Rows are told apart by id and text only, so repeated rows are
        stripped alike.
        """
        t1, t2 = fingerprint(F.coalesce(F.col(text_col), F.lit("")))
        keyed = docs.withColumns({"__id": F.col(id_col), "__t1": t1, "__t2": t2})
        held = keyed.select("__id", "__t1", "__t2", F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
        held = held.where(F.char_length(_stripped(F.col("line"))) >= self.min_chars)
        held = held.select("__id", "__t1", "__t2", "pos", _hashes(F.col("line")).alias("key"))
        held = held.select("__id", "__t1", "__t2", "pos", "key.h1", "key.h2")
        # written first, so that the join shuffles lines plainly, and the places of a very common one can be split
        hits = held.join(written(self.repeated(min_docs), "repeated_lines"), ["h1", "h2"]).where(~F.col("__id").eqNullSafe(F.col("top")))
        gone = hits.groupBy(F.col("__id").alias("__g_id"), F.col("__t1").alias("__g1"), F.col("__t2").alias("__g2"))
        gone = gone.agg(F.collect_set("pos").alias("__gone"))
        same = F.col("__id").eqNullSafe(F.col("__g_id"))
        same = same & (F.col("__t1") == F.col("__g1")) & (F.col("__t2") == F.col("__g2"))
        both = keyed.join(gone, same, "left").withColumn("__lines", _lines(F.col(text_col)))
        stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
        left = F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n")
        return both.withColumns(
            {
                text_col: F.when(F.col("__gone").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(left),
                "__n_lines": F.size("__lines").cast("long"),
                "__n_dropped": F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long"),
            }
        ).drop("__id", "__t1", "__t2", "__g_id", "__g1", "__g2", "__gone", "__lines")


def id_ranges(docs: DataFrame, batches: int, id_col: str = "doc_id") -> list[Column]:
    """Conditions that split ``docs`` into ranges of ids with about as many rows each; null ids go to the first.

    Where files are sorted by id, each range reads only its own row groups.
    """
    cuts = docs.approxQuantile(id_col, [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    cuts = sorted({int(x) for x in cuts})
    at = F.col(id_col)
    if not cuts:
        return [F.lit(True)]
    first, last = at.isNull() | (at < cuts[0]), at >= cuts[-1]
    return [first, *((at >= a) & (at < b) for a, b in zip(cuts, cuts[1:], strict=False)), last]


def repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` without the lines that at least ``min_docs`` rows hold, kept in the row with the largest id alone.

    A line's key is the line without white space at both ends and with A-Z lower-cased; keys under ``min_chars`` code
    points always stay. Null text is one empty line and comes out empty. Rows that share the largest id all keep the
    line; a null id is smaller than any other. Repeated rows count each. An empty table stays empty.
    """
    runs = LineRuns(docs.sparkSession, fanout=fanout, min_chars=min_chars)
    for part in id_ranges(docs, batches, id_col):
        runs.add(docs.where(part), id_col, text_col)
    return runs.strip(docs, min_docs, id_col, text_col)
