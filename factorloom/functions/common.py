"""Small column and planning helpers shared by all operators."""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white-space characters that keys are trimmed of.
WHITE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85                 　"


def trimmed(c: Column | str) -> Column:
    """c without white space at its ends; blank becomes null."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.btrim(c, F.lit(WHITE))
    return F.when(t != "", t)


def key_lower(c: Column | str) -> Column:
    return F.lower(trimmed(c))


def key_upper(c: Column | str) -> Column:
    return F.upper(trimmed(c))


def finite(c: Column | str) -> Column:
    """c as double with NaN and the infinities read as null."""
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(F.abs(c) < float("inf"), c)


def source_bytes(df: DataFrame) -> int:
    """The bytes of the tables that df is made of: of files and literals as the optimizer knows them, of
    checkpoints as their files measure.

    Estimates of whole plans are of no use here (a join counts as the product of its sides), nor are
    those that a checkpoint keeps of the plan that made it. Data of unknown size (handed over from
    the driver, say) is measured: its rows are counted.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRDD":
            file = leaf.rdd().getCheckpointFile()
            if file.isDefined():
                path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
                total += path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
            else:
                total += leaf.rdd().count() * ROW_BYTES * max(1, leaf.output().size())
        else:
            size = int(str(leaf.stats().sizeInBytes()))
            total += size if size < 1 << 50 else df.count() * ROW_BYTES * max(1, len(df.columns))
    return total


ROW_BYTES = 16  # of a value whose size isn't known


def group_count(*dfs: DataFrame, bytes_each: int = 4 << 20, least: int = 16, most: int = 1 << 20) -> int:
    """Into how many hash groups dfs are to be split so that each stays near bytes_each of their sources."""
    return max(least, min(most, math.ceil(sum(map(source_bytes, dfs)) / bytes_each)))


BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df marked for broadcast if it holds at most rows rows and BROADCAST_BYTES (measured), else as it is."""
    own = F.sum(F.length(F.to_json(F.struct(*df.columns))).cast("long"))
    n, size = df.limit(rows + 1).agg(F.count("*"), F.coalesce(own, F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_BYTES else df


def task_count(groups: int, *dfs: DataFrame, bytes_each: int = 64 << 20) -> int:
    """Into how many tasks hash groups are to be spread, by the size of dfs' sources."""
    return max(min(groups, 64), min(1 << 20, -(-sum(map(source_bytes, dfs)) // bytes_each)))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder, so that a lost executor costs no recomputation.

    The folder is the one in spark.checkpoint.dir. Only a session within one process (tests, a laptop)
    may leave it unset; it gets a temporary one. On a cluster that is an error, as no folder of one
    machine serves the others.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="factorloom-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()
