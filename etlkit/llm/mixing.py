"""Mixing sources to target weights by hierarchical budgeting, with DataFrame functions only.

Sources are the leaves of a domain-language-source tree. A token budget is passed down the tree by
weight. A node takes at most what its leaves can give in ``epochs`` passes; what it leaves over goes
to its siblings by their weights, and reaches other parents only when the whole family is full.
Every leaf then repeats its documents for as many full epochs as its budget holds, and a prefix of
one more epoch in an order drawn from the seed, the epoch and the document's id.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from etlkit.llm.common import materialize
from etlkit.runtime import require

LEVELS = ("__domain", "__lang", "__source")
# Leading bits of the order that cut a leaf's epoch in equal stretches, so that only the stretch where
# the prefix ends is sorted row by row.
STRETCH_BITS = 12
EPOCH_BITS = 60


def n_words(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space. Null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def budgets(leaves: DataFrame, budget: Column, epochs: int) -> DataFrame:
    """``leaves`` with ``__budget`` in whole tokens.

    ``leaves`` has the three levels, ``__tokens`` and a whole-number weight for each level
    (``__w0`` to ``__w2``). With children in order of capacity per weight, those before a point are
    full and the rest share what is left by weight; the share per weight is the largest one met
    along that order. Windows here run over the children of one node, never over documents.
    """
    able = (F.col("__w0") > 0) & (F.col("__w1") > 0) & (F.col("__w2") > 0)
    now = leaves.withColumn("__room", F.when(able, F.col("__tokens") * epochs).otherwise(F.lit(0))).withColumn("__budget", budget.cast("long"))
    for depth in range(3):
        path, parent = LEVELS[: depth + 1], LEVELS[:depth]
        nodes = now.filter("__room > 0").groupBy(*path).agg(
            F.sum("__room").alias("__cap"), F.first(f"__w{depth}").alias("__w"), F.first("__budget").alias("__b"))
        order = Window.partitionBy(*parent).orderBy(F.col("__cap") / F.col("__w"), path[-1])
        spent = F.coalesce(F.sum("__cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum("__w").over(order.rowsBetween(0, Window.unboundedFollowing))
        nodes = nodes.withColumn("__rate", (F.col("__b") - spent).cast("double") / rest.cast("double"))
        best = F.max("__rate").over(Window.partitionBy(*parent))
        share = F.least(F.col("__cap"), F.floor(best * F.col("__w") + 1e-6).cast("long"))
        given = nodes.select(*path, F.greatest(share, F.lit(0)).alias("__given"))
        now = now.join(given, list(path), "left").withColumn("__budget", F.coalesce("__given", F.lit(0)).cast("long")).drop("__given")
    return now


def _key(doc_id: Column, text: Column) -> Column:
    """What tells rows apart: the id, or the md5 of the text where there is none."""
    return F.when(doc_id.isNotNull(), doc_id.cast("string")).otherwise(F.md5(F.coalesce(text, F.lit(""))))


def _place(seed: int, epoch: Column, key: Column) -> Column:
    """A row's place in an epoch: 60 bits of an md5 of seed, epoch and key."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mixed(
    docs: DataFrame, domain: Column, lang: Column, source: Column, weights: Mapping[str, Column], share: float = 1.0,
    epochs: int = 4, seed: int = 1, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Every column of ``docs`` with ``n_tokens`` and ``copies``, how often the mixture holds the row.

    ``domain``, ``lang`` and ``source`` name a row's leaf (null counts as the empty name).
    ``weights`` has a whole-number weight for ``domain``, ``lang`` and ``source``; a leaf with a
    weight below 1 gets nothing. The budget is ``share`` of all tokens, tokens being words. A leaf's
    prefix ends before its budget is passed; rows without tokens have 0 copies. Rows of one id (without
    ids: one text) and length are taken together or not at all, so a prefix may end before them. Columns of ``docs`` named like the added ones are replaced; an empty
    table gives no rows.

    Texts are read and never shuffled: the prefix of a leaf is one cut in the order of its epoch,
    and the table of cuts has a row for each leaf. A leaf may hold any share of the rows: sums are
    pre-aggregated, and only the stretch of 1 in 4,096 in which the prefix ends is sorted.
    """
    require(docs, doc_id, text)
    named = [F.coalesce(c.cast("string"), F.lit("")).alias(name) for c, name in zip((domain, lang, source), LEVELS)]
    weighted = [F.coalesce(weights[k].cast("long"), F.lit(0)).alias(f"__w{i}") for i, k in enumerate(("domain", "lang", "source"))]
    slim = docs.select(_key(F.col(doc_id), F.col(text)).alias("__id"), n_words(F.col(text)).alias("__n"), *named, *weighted)
    slim = materialize(slim, "mix-rows")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("__n").alias("__tokens"), *[F.max(f"__w{i}").alias(f"__w{i}") for i in range(3)])
    leaves = materialize(leaves, "mix-leaves")
    total = leaves.agg(F.floor(F.sum("__tokens") * F.lit(float(share))).cast("long")).first()[0] or 0
    planned = budgets(leaves, F.lit(total), epochs)
    full = F.when(F.col("__tokens") > 0, F.expr("__budget div __tokens")).otherwise(F.lit(0)).cast("long")
    planned = planned.select(*LEVELS, full.alias("__full"), (F.col("__budget") - full * F.col("__tokens")).alias("__rest"))
    planned = materialize(planned, "mix-plan")

    rows = slim.filter("__n > 0").join(planned, list(LEVELS)).withColumn("__u", _place(seed, F.col("__full"), F.col("__id")))
    rows = rows.select(*LEVELS, "__id", "__n", "__rest", "__u", F.shiftright("__u", EPOCH_BITS - STRETCH_BITS).cast("int").alias("__stretch"))
    sums = rows.groupBy(*LEVELS, "__stretch").agg(F.sum("__n").alias("__sum"), F.first("__rest").alias("__rest"))
    running = F.sum("__sum").over(Window.partitionBy(*LEVELS).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, 0))
    ends = sums.withColumn("__past", running).filter("__past > __rest").groupBy(*LEVELS).agg(
        F.min("__stretch").alias("__end"), F.min_by(F.col("__past") - F.col("__sum"), "__stretch").alias("__before"))
    ends = materialize(ends, "mix-ends")
    last = rows.join(ends, list(LEVELS)).filter(F.col("__stretch") == F.col("__end"))
    # Equal rows are summed first, so that they share one place and one row of the window.
    same = last.groupBy(*LEVELS, "__u", "__id", "__n").agg(F.sum("__n").alias("__all"), F.first("__before").alias("__before"), F.first("__rest").alias("__rest"))
    by_row = Window.partitionBy(*LEVELS).orderBy("__u", "__id", "__n").rowsBetween(Window.unboundedPreceding, 0)
    last = same.withColumn("__past", F.col("__before") + F.sum("__all").over(by_row)).filter("__past <= __rest")
    spot = lambda u, i, n: F.struct(u.alias("u"), i.alias("i"), n.alias("n"))
    cuts = last.groupBy(*LEVELS).agg(F.max(spot(F.col("__u"), F.col("__id"), F.col("__n"))).alias("__cut"))
    plan = materialize(planned.join(ends, list(LEVELS), "left").join(cuts, list(LEVELS), "left"), "mix-cuts")

    out = docs.drop("n_tokens", "copies").withColumns({n: c for n, c in zip(LEVELS, named)}).withColumn("n_tokens", n_words(F.col(text)))
    out = out.join(plan, list(LEVELS))
    key = _key(F.col(doc_id), F.col(text))
    u = _place(seed, F.col("__full"), key)
    stretch = F.shiftright(u, EPOCH_BITS - STRETCH_BITS)
    at_end = (stretch == F.col("__end")) & F.coalesce(spot(u, key, F.col("n_tokens")) <= F.col("__cut"), F.lit(False))
    in_prefix = (stretch < F.col("__end")) | at_end
    copies = F.when(F.col("n_tokens") > 0, F.col("__full") + in_prefix.cast("long")).otherwise(F.lit(0)).cast("long")
    kept = [c for c in docs.columns if c not in ("n_tokens", "copies")]
    return out.withColumn("copies", copies).select(*kept, *LEVELS, "n_tokens", "copies")
