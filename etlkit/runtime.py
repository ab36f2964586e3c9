"""Helpers shared by all operators: argument checks, size checks, shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast by hint only when the optimizer's upper estimate of it is below this.
BROADCAST_LIMIT = 16 * 1024 * 1024


def names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def require(df: DataFrame, *columns: str) -> None:
    """Fail at call time when a named column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate for a frame. Reads plan statistics only; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# Nodes that give at most the rows of what is below them, with columns as they are.
_PLAIN_NODES = ("Relation", "LogicalRelation", "LocalRelation", "LogicalRDD", "Range", "Filter", "SubqueryAlias", "GlobalLimit", "LocalLimit", "Sample", "Distinct")


def _plain_output(node) -> bool:
    """Whether every output column is a column of the input, or a number, date or flag made from it."""
    expressions = node.output()
    known = {str(c) for child in _children(node) for c in _items(child.output())}
    fixed = ("int", "bigint", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz")
    return all(str(c) in known or c.dataType().catalogString() in fixed for c in _items(expressions))


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.length())]


def _children(node) -> list:
    return _items(node.children())


def estimate_holds(df: DataFrame) -> bool:
    """Whether the optimizer's size of a frame bounds its real size, up to compression.

    True for scans, filters, limits and projections or aggregations that build no long values. A
    plan that explodes rows, joins, or builds strings, arrays or structs can be any size.
    """
    def holds(node) -> bool:
        name = node.nodeName().split(" ")[0]
        plain = name in _PLAIN_NODES or (name in ("Project", "Aggregate") and _plain_output(node))
        return plain and all(holds(child) for child in _children(node))

    return holds(df._jdf.queryExecution().optimizedPlan())


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    return plan_bytes(df) <= limit and estimate_holds(df)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast when a size under ``limit`` is known.

    Otherwise AQE decides on measured bytes, except where Spark would trust a low estimate that does
    not hold before it has measured anything: such a frame joins by a shuffle, right at any size.
    """
    if plan_bytes(df) <= limit:
        return F.broadcast(df) if estimate_holds(df) else df.hint("merge")
    return df


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def join_groups(detail: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Attach per-group columns to detail rows. NULL keys form a group, as they do in GROUP BY.

    ``groups`` has one row per key, so a hot key is hot on the detail side alone and AQE can
    split it, which a window over the key cannot.
    """
    right = groups.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = all_of([F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return detail.join(right, on, how).drop(*[f"__{k}" for k in keys])


# Folders and tables made by this process for results that are read back.
_SCRATCH: dict[str, list[str]] = {"folders": [], "tables": []}


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="etlkit-")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH["folders"].append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back.

    The files are on storage that all executors reach, so a lost executor costs at most the tasks
    that were running. Reading back also gives joins a plain scan, whose shuffle AQE may split.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(groups: DataFrame) -> DataFrame:
    """Groups written, so that their size is known when a join with them is planned: few are broadcast."""
    return broadcast_if_small(materialize(groups, "groups"))


def scratch_table(name: str) -> str:
    """Note a catalog table for ``clear_scratch``."""
    _SCRATCH["tables"].append(name)
    return name


def clear_scratch(spark: SparkSession) -> int:
    """Drop the scratch tables and folders that this process made; frames read from them end with it."""
    tables, folders = _SCRATCH["tables"], _SCRATCH["folders"]
    done = len(tables) + len(folders)
    while tables:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": tables.pop()})
    while folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folders.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return done
