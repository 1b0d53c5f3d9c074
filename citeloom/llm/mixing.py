"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash and queued, pass after pass (three at most). A
document enters as packets of at most ``QUANTUM`` words; a packet's virtual finish time is the
number of words of its source up to its end, divided by the source's target. All packets are ordered
by virtual finish time and taken until the total budget is used up, so every source is served in
proportion to its target.

Running totals never bring a source, or the whole mix, into one task: rows are dealt to ranges of
the order, the ranges' totals are added up, and each range counts on from its offset. Nor do all
sources meet in one task: they may be as many as hosts.

Defined cases: a null text has size 0 and nothing of it is taken; a null source is a source of its
own, last in order; sources without words get target 0; repeated rows and null ids queue like other
rows (equal rows in either order, with the same result); an empty table gives an empty result; extra
columns are ignored. Texts of any length are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import drop_staged, row_ids, stage, word_count

WEIGHTS = (1, 2, 3)
PASSES = 3
QUANTUM = 128
#: Rows of one range of an order.
RANGE_ROWS = 10_000


def with_running_total(df: DataFrame, group: str, key: Column, order: list[str], amount: str, total: str, counts: DataFrame) -> DataFrame:
    """Add ``total``: the sum of ``amount`` over the rows before this one in its group's order.

    ``key`` runs from 0 to below 1 along the order; ``counts`` has ``group`` and its ``ranges``.
    """
    ranged = df.join(counts.select(F.col(group).alias("g__"), "ranges"), F.col(group).eqNullSafe(F.col("g__"))).drop("g__")
    ranged = ranged.withColumn("range", F.least((key * F.col("ranges")).cast("long"), F.col("ranges") - 1)).drop("ranges")
    sums = ranged.groupBy(group, "range").agg(F.sum(amount).alias("sum"))
    before = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(group).alias("g__"), F.col("range").alias("r__"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    joined = ranged.join(offsets, F.col(group).eqNullSafe(F.col("g__")) & (F.col("range") == F.col("r__"))).drop("g__", "r__")
    inside = Window.partitionBy(group, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn(total, F.col("offset") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).drop("offset", "range")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """Staged rows ``source``, ``source_size``, ``docs``, ``rank`` (from 1, by code point, null last).

    Sources may be as many as hosts: they are range-sorted, and each partition counts on from the
    number of sources before it.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    order = F.col("source").asc_nulls_last()
    placed = stage(sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("place", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("place", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = placed.join(F.broadcast(offsets), part == F.col("part"))
    rank = F.col("offset") + F.col("place") - F.shiftleft(part, 33) + 1
    out = stage(ranked.select("source", "source_size", "docs", rank.alias("rank")), "ranked")
    drop_staged(placed)
    return out


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """``source``, ``rank``, ``source_size``, ``docs`` and ``target``: one row for each source.

    The budget is the sum of all sizes, shared by weight. A source is capped at ``passes`` times its
    size; what it can't take is shared among the others by weight. The level (words for a unit of
    weight) rises as capped sources leave their share; each round is one aggregate, and the rounds
    end when no further source is capped.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked_sources(sizes).withColumn("weight", weight).withColumn("cap", passes * F.col("source_size"))
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight") if capped >= 0 else F.lit(False)
        r = ranked.agg(
            F.sum("source_size").alias("budget"), F.count(F.when(full, 1)).alias("capped"),
            F.sum(F.when(full, F.col("cap"))).alias("given"), F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if r["capped"] == capped or not r["weight"]:
            break
        capped, level = r["capped"], ((r["budget"] or 0) - (r["given"] or 0)) / r["weight"]
    share = F.lit(level) * F.col("weight")
    target = F.when(F.col("cap") <= share, F.col("cap").cast("double")).otherwise(share)
    return ranked.select("source", "rank", "source_size", "docs", target.alias("target"))


def mix_rows(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", quantum: int = QUANTUM, passes: int = PASSES, weights: tuple[int, ...] = WEIGHTS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: rid, id, ``size``, ``source``, ``source_size``, ``target``,
    ``taken`` and ``row``, a struct of the columns to carry."""
    text = F.col(text_col)
    shuffled = F.xxhash64(F.col(id_col).cast("string"), text, F.lit(17))
    carried = F.struct(*[F.col(c) for c in carry]).alias("row") if carry else F.lit(None).cast("int").alias("row")
    kept = row_ids(df, F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text).alias("size"), shuffled.alias("h"), carried)
    rows = stage(kept, "sizes")
    targets = stage(source_targets(rows, weights, passes), "targets")

    # Place of each document in its source's shuffled queue.
    place = (F.col("h") / F.lit(float(2**64))) + 0.5
    counts = targets.select("source", F.ceil(F.greatest(F.col("docs"), F.lit(1)) / RANGE_ROWS).alias("ranges"))
    words = rows.filter("size > 0").drop("row")
    queued = with_running_total(words, "source", place, ["h", "id", "rid"], "size", "start", counts)
    about = targets.select(F.col("source").alias("s__"), "rank", "source_size", "target")
    queued = queued.join(about, F.col("source").eqNullSafe(F.col("s__"))).drop("s__", "source", "h")

    # Packets of the passes that the target reaches, with some to spare for the last places.
    reach = F.col("target") + 2 * quantum
    first = F.lit(0).cast("long")
    last = F.least(F.lit(passes - 1), F.floor((reach - F.col("start")) / F.col("source_size"))).cast("long")
    turns = queued.filter(F.col("start") < reach).withColumn("turn", F.explode(F.sequence(first, last)))
    turns = turns.withColumn("begin", F.col("turn") * F.col("source_size") + F.col("start"))
    number = F.least(F.ceil(F.col("size") / quantum), F.floor((reach - F.col("begin")) / quantum) + 1)
    packets = turns.withColumn("packet", F.explode(F.sequence(first, number - 1)))
    amount = F.least(F.lit(quantum), F.col("size") - F.col("packet") * quantum)
    packets = packets.select("rid", "rank", "turn", "packet", amount.alias("words"), ((F.col("begin") + F.col("packet") * quantum + amount) / F.col("target")).alias("finish"))
    packets = stage(packets.withColumn("mix", F.lit(0)), "packets")

    # The global order by virtual finish time, cut where the budget ends.
    whole = packets.agg(F.count("*").alias("n"), F.max("finish").alias("end")).first()
    budget = targets.agg(F.sum("source_size").alias("budget")).first()["budget"] or 0
    ranges = df.sparkSession.range(1).select(F.lit(0).alias("mix"), F.lit(max(1, -(-whole["n"] // RANGE_ROWS))).cast("long").alias("ranges"))
    key = F.col("finish") / F.lit(float(whole["end"] or 1) * (1 + 1e-9))
    ordered = with_running_total(packets, "mix", key, ["finish", "rank", "turn", "rid", "packet"], "words", "before", ranges)
    took = ordered.filter(F.col("before") < budget).groupBy("rid").agg(F.sum(F.least(F.col("words"), F.lit(budget) - F.col("before"))).alias("taken"))
    about = targets.select(F.col("source").alias("s__"), "source_size", "target")
    out = rows.drop("row").join(about, F.col("source").eqNullSafe(F.col("s__"))).join(took, "rid", "left")
    out = stage(out.select("rid", "id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), "taken")
    drop_staged(packets)
    # Carried columns are stored once, and join the result where it is read; alike at every size.
    return out.hint("merge").join(rows.select("rid", "row"), "rid") if carry else out


def mix_sources(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per input row: id, ``size``, ``source_size``, ``target`` and ``taken`` words."""
    out = mix_rows(df, id_col=id_col, **options)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def mixed_rows(df: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", chars_col: str = "n_chars", **options) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them, with all columns.

    Each whole pass over a document gives its row; a pass that the mix cuts off gives the row with
    the text up to the last word taken, and ``chars_col``, if there is one, counts that text.
    """
    out = mix_rows(df, text_col, source_col, id_col, carry=tuple(df.columns), **options).filter("taken > 0")
    left = F.col("taken") - F.col("copy") * F.col("size")
    copies = out.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("taken") - 1) / F.col("size")))))
    text = F.col(f"row.`{text_col}`")
    begun = F.regexp_extract(text, r"\A[\x20\x09-\x0D]*", 0)
    # Words and the space before each, in order: the first ones of them make the cut text.
    words = F.regexp_extract_all(F.substr(text, F.char_length(begun) + 1), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.concat(begun, F.array_join(F.slice(words, F.lit(1), F.greatest(left, F.lit(1)).cast("int")), ""))
    final = copies.withColumn("said", F.when(left >= F.col("size"), text).otherwise(cut))
    columns = []
    for c in df.columns:
        if c == text_col:
            columns.append(F.col("said").alias(c))
        elif c == chars_col:
            kind = df.schema[c].dataType
            columns.append(F.when(left >= F.col("size"), F.col(f"row.`{c}`")).otherwise(F.char_length("said").cast(kind)).alias(c))
        else:
            columns.append(F.col(f"row.`{c}`").alias(c))
    return final.select(*columns)
