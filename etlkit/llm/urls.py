"""URL filters by a temporal list join.

Lists change: a host or path is added on one day and taken off on another. Dated entries become
validity intervals, and every capture is judged by the entries in force when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from etlkit.llm.common import materialize
from etlkit.runtime import require


def url_host(url: Column) -> Column:
    """Host in lower case without user, port and final dot; null for anything that is not a URL."""
    rest = F.regexp_extract(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)
    rest = F.regexp_replace(rest, r"\.+$", "")
    return F.when(F.length(rest) > 0, rest)


def url_path(url: Column) -> Column:
    """Path without query, fragment and slashes at its end."""
    path = F.regexp_extract(F.trim(url), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)
    return F.regexp_replace(path, r"/+$", "")


def lookup_keys(url: Column, depth: int) -> Column:
    """Keys a list may hold for a URL: its host and each parent domain, and its host with up to ``depth`` path parts.

    ``rank`` orders them: a longer path is more specific than a host, a longer host than its parent.
    """
    host, labels = url_host(url), F.split(url_host(url), r"\.")
    parts = F.split(url_path(url), "/")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.struct(F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n)).alias("key"), n.alias("rank")))
    deep = F.least(F.size(parts) - 1, F.lit(depth))
    paths = F.when(deep > 0, F.transform(
        F.sequence(F.lit(1), deep),
        lambda n: F.struct(F.concat(host, F.concat_ws("/", F.slice(parts, 1, n + 1))).alias("key"), (n + 1_000_000).alias("rank"))))
    return F.when(host.isNotNull(), F.concat(domains, F.coalesce(paths, F.slice(domains, 1, 0))))


def validity(entries: DataFrame, key: str = "key", action: str = "action", at: str = "at") -> DataFrame:
    """``(key, action, since, until)``: an entry is in force from its date up to the key's next date.

    ``until`` is null for the last. Entries with a null key, action or date say nothing. Of several
    entries of a key at one time the greatest action (by text) counts, so ``block`` beats ``allow``
    and ``remove`` beats both. The window is over one key's entries in a list, which are as many as
    its changes.
    """
    require(entries, key, action, at)
    dated = entries.select(F.col(key).alias("key"), F.col(action).alias("action"), F.col(at).cast("timestamp_ntz").alias("since")).dropna()
    dated = dated.groupBy("key", "since").agg(F.max("action").alias("action"))
    later = F.lead("since").over(Window.partitionBy("key").orderBy("since"))
    return dated.withColumn("until", later).filter(F.col("action") != "remove").select("key", "action", "since", "until")


def judged(
    captures: DataFrame, entries: DataFrame, capture_id: str = "page_id", url: str = "url", fetched: str = "fetched_at",
    key: str = "key", action: str = "action", at: str = "at",
) -> DataFrame:
    """``(capture_id, url, fetched_at, blocked, matched_key, since)``, one row for each row of ``captures``.

    The most specific key in force at fetch time decides: ``block`` blocks, ``allow`` excepts what a
    broader key blocks. Without a match, a URL or a fetch time a capture is not blocked. Rows equal in
    all three columns are judged once and come back as often as they came; null ids are kept apart
    from others. Extra columns, whatever their names, play no part.

    The as-of condition is part of an equi-join on the key, so a host that holds a third of all
    captures is hot on the capture side alone, which AQE can split. The list is never hinted.
    """
    require(captures, capture_id, url, fetched)
    rows = captures.select(F.col(capture_id).alias("capture_id"), F.col(url).alias("url"), F.col(fetched).cast("timestamp_ntz").alias("fetched_at"))
    intervals = materialize(validity(entries, key, action, at), "list-intervals")
    # No key has more path parts than the list's deepest.
    depth = intervals.agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0] or 0
    asked = rows.groupBy("url", "fetched_at").agg(F.count(F.lit(1)).alias("__n")).drop("__n")
    keyed = asked.filter(F.col("fetched_at").isNotNull()).withColumn("look", F.explode(lookup_keys(F.col("url"), depth)))
    keyed = keyed.select("url", "fetched_at", F.col("look.key").alias("key"), F.col("look.rank").alias("rank"))
    in_force = (F.col("since") <= F.col("fetched_at")) & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until")))
    met = keyed.join(intervals, "key").filter(in_force)
    best = met.groupBy("url", "fetched_at").agg(F.max_by(F.struct("action", "key", "since"), "rank").alias("hit"))
    best = materialize(best.select(F.col("url").alias("u"), F.col("fetched_at").alias("f"), "hit"), "list-hits")
    out = rows.join(best, (F.col("url") == F.col("u")) & (F.col("fetched_at") == F.col("f")), "left")
    return out.select(
        F.col("capture_id").alias(capture_id), F.col("url").alias(url), F.col("fetched_at").alias(fetched),
        F.coalesce(F.col("hit.action") == "block", F.lit(False)).alias("blocked"),
        F.col("hit.key").alias("matched_key"), F.col("hit.since").alias("since"))


ENTRY_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("action", T.StringType()), T.StructField("at", T.TimestampNTZType())])
