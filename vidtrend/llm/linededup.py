"""Line dedup with levelled sorted runs of line keys.

The store holds runs: tables of (line key hash, number of documents), hash
partitioned and sorted by hash, so that runs meet in sort-merge joins without a
shuffle.  Documents come in batches.  A batch counts its own line keys,
anti-joins the runs of keys already known to be frequent (these need no further
counting) and adds the rest as a new run of level 0.  When a level holds
``fanout`` runs they are compacted: counts of equal keys are added, keys that
reach ``min_docs`` move to the frequent runs, the others form one run of the next
level.  After the last batch one compaction over all levels settles every key.
Then lines with a frequent key are taken out of all documents.

Everything is DataFrame operations.  Keys are compared by two independent 64-bit
hashes.  A key with a third of all lines is one row per document after the
distinct, and one row per task after partial aggregation.

Defined results: a null or empty text is one empty line; rows with equal ids are
one document for the counts (null ids together are one document too), and each
row loses its lines; an empty table gives an empty result.  Other columns of the
documents are kept; columns named like the results are replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidtrend.llm.common import ASCII_SPACE, fresh, keep, shared_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case.

    ``lower`` does that for ASCII text; only other lines need the slower translation.
    """
    ends = F.btrim(line, F.lit(ASCII_SPACE))
    core = F.when(line.rlike(r"^[\x20\x09-\x0D]|[\x20\x09-\x0D]$"), ends).otherwise(line)
    return F.when(F.length(core) == F.octet_length(core), F.lower(core)).otherwise(F.translate(core, UPPER, LOWER))


class LineRuns:
    """The levelled runs, as bucketed tables in the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 4, buckets: int | None = None) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.frequent: list[DataFrame] = []
        self._tables: list[str] = []

    def _run(self, df: DataFrame) -> DataFrame:
        """A sorted run: bucketed by key, sorted in each bucket."""
        name = f"line_run_{uuid.uuid4().hex}"
        (df.select(*KEY, "n").repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", shared_path(self.spark, "run")).saveAsTable(name))
        self._tables.append(name)
        return self.spark.table(name)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """The runs joined key by key, counts added; a full outer join of sorted runs merges them."""
        every = runs[0]
        for run in runs[1:]:
            n = F.coalesce(F.col("a.n"), F.lit(0)) + F.coalesce(F.col("b.n"), F.lit(0))
            every = every.alias("a").join(run.alias("b"), KEY, "full_outer").select(*KEY, n.alias("n"))
        return every

    def _settle(self, runs: list[DataFrame]) -> DataFrame:
        """Merge runs: their frequent keys become a frequent run; the others are returned as one run."""
        merged = self._run(self._merged(runs)) if len(runs) > 1 else runs[0]
        self.frequent.append(self._run(merged.where(F.col("n") >= self.min_docs)))
        return merged.where(F.col("n") < self.min_docs)

    def add(self, counts: DataFrame) -> None:
        """Add a batch's (h1, h2, n): its keys that are not yet frequent."""
        for known in self.frequent:
            counts = counts.join(known, KEY, "left_anti")
        self._put(0, self._run(counts))

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._run(self._settle(runs)))

    def finish(self) -> DataFrame:
        """All frequent keys (h1, h2), each once, written; the runs' table entries are dropped."""
        if runs := [r for level in self.levels for r in level]:
            self._settle(runs)
            self.levels = []
        if self.frequent:
            found = self.frequent[0]
            for run in self.frequent[1:]:
                found = found.unionByName(run)
            found = keep(found.select(*KEY), "frequent")
        else:
            found = self.spark.createDataFrame([], "h1 long, h2 long")
        for name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        return found


def marks(places: Column) -> Column:
    """An array that is true at the given ascending places and false between them, up to the
    last one: as many steps as it is long."""
    gaps = F.transform(places, lambda at, k: at - F.when(k > 0, F.get(places, F.greatest(k - 1, F.lit(0)))).otherwise(-1) - 1)
    return F.flatten(F.transform(gaps, lambda n: F.concat(F.array_repeat(F.lit(False), n), F.array(F.lit(True)))))


def drop_frequent_lines(documents: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4,
                        fanout: int = 3) -> DataFrame:
    """``documents`` with ``text`` rid of every line whose key has at least ``min_chars``
    code points and occurs in at least ``min_docs`` documents, plus ``n_lines`` (before)
    and ``n_dropped``.  ``batches``: parts, dealt by id, in which the documents arrive.
    """
    spark = documents.sparkSession
    docs = documents.drop("n_lines", "n_dropped")
    text = F.coalesce(F.col("text"), F.lit(""))
    # a row is known by its id and its text: equal rows lose the same lines
    row = [F.col("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(2), text).alias("t2")]
    # the hashes are taken below the generator: above it they would be taken of the text for every line
    lines = (docs.select(*row, text.alias("text")).select("doc_id", "t1", "t2", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
             .withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
             .select("doc_id", "t1", "t2", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                     F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(batches)).cast("int").alias("batch")))
    path = shared_path(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)

    runs = LineRuns(spark, min_docs, fanout)
    for k in range(batches):
        own = lines.where(F.col("batch") == k).select("doc_id", *KEY).distinct()
        runs.add(own.groupBy(*KEY).agg(F.count("*").alias("n")))
    frequent = runs.finish()

    drops = (lines.join(frequent, KEY, "left_semi").groupBy("doc_id", "t1", "t2")
             .agg(F.array_sort(F.collect_set("pos")).alias("drop")))
    t1, t2 = fresh("t1", docs.columns), fresh("t2", docs.columns)
    named = docs.withColumns({t1: row[1], t2: row[2]})
    parts = F.split(text, "\n", -1)
    drop = F.col("x.drop")
    gone = marks(drop)
    keep_line = F.filter(F.arrays_zip(parts.alias("line"), gone.alias("gone")), lambda x: ~F.coalesce(x["gone"], F.lit(False)))
    on = [F.col(f"d.{mine}").eqNullSafe(F.col(f"x.{other}")) for mine, other in (("doc_id", "doc_id"), (t1, "t1"), (t2, "t2"))]
    joined = named.alias("d").join(drops.alias("x"), on[0] & on[1] & on[2], "left")
    new_text = F.when(drop.isNull(), text).otherwise(F.array_join(F.transform(keep_line, lambda x: x["line"]), "\n"))
    return joined.select(
        *[new_text.alias("text") if c == "text" else F.col(f"d.{c}") for c in docs.columns],
        F.size(parts).cast("long").alias("n_lines"), F.coalesce(F.when(drop.isNotNull(), F.size(drop)), F.lit(0)).cast("long").alias("n_dropped"))
