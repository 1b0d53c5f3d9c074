"""Exact document deduplication by deterministic block naming.

Every normalised text is cut into blocks of a fixed number of characters. The distinct blocks are
sorted and get integer names; then adjacent pairs of names are sorted and named in turn, which
halves the length of every document's name sequence, until one name is left. Two documents end on
the same level with the same name exactly when their texts are equal: names stand for sorted
distinct values, never for bare hash values.

Blocks are sorted in the order of (64-bit hash, text). Only hash and count travel after the
distinct blocks are known; the few blocks whose hashes collide are told apart by their text order.
Rows of a large group of equal texts are dealt to many tasks when they meet their group.

Defined cases: a null text is the empty text; white space runs count as one space (no trimming, so
" " and "" differ); a null id sorts after all ids; of repeated rows (same id and text) one row is
kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import drop_paths, drop_staged, join_groups, recorded, row_ids, stage

BLOCK_CHARS = 4096


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def blocks_of(text: Column, block_chars: int) -> Column:
    """The text cut into blocks of ``block_chars`` code points; the empty text is one empty block."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    return F.when(F.char_length(text) <= block_chars, F.array(text)).otherwise(cut)


def sorted_names(values: DataFrame, *keys: str) -> DataFrame:
    """Distinct rows of ``values`` with an integer ``name`` that follows their sort order."""
    distinct = values.select(*keys).distinct()
    ranked = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(ranked.withColumn("name", F.monotonically_increasing_id()), "names")


def _collision_ranks(texts: DataFrame, block_chars: int, hash_of: Callable[[Column], Column]) -> DataFrame | None:
    """(h, block, sub) of the blocks that share their hash with another block; None if no block does."""
    blocks = texts.select(F.explode(blocks_of(F.col("t"), block_chars)).alias("block"))
    distinct = blocks.select(hash_of(F.col("block")).alias("h"), "block").distinct()
    shared = stage(distinct.groupBy("h").count().filter("count > 1").select("h"), "collisions")
    if shared.isEmpty():
        drop_staged(shared)
        return None
    order = Window.partitionBy("h").orderBy("block")
    return stage(distinct.join(shared, "h", "left_semi").withColumn("sub", F.row_number().over(order)), "subranks")


def _members(numbered: DataFrame, block_chars: int, hash_of: Callable[[Column], Column]) -> DataFrame:
    """Staged rows ``rid``, ``id``, ``sha`` and the identity (``level``, ``name``) from rows (rid, id, text)."""
    texts = numbered.select("rid", "id", normalised(F.col("text")).alias("t"))
    hashes = F.transform(blocks_of(F.col("t"), block_chars), lambda b: hash_of(b))
    docs = stage(texts.select("rid", "id", F.sha2("t", 256).alias("sha"), hashes.alias("hs")), "signatures")

    subranks = _collision_ranks(texts, block_chars, hash_of)
    symbols = docs.select("rid", F.size("hs").alias("len"), F.posexplode("hs").alias("pos", "h"))
    if subranks is None:
        symbols = symbols.withColumn("sub", F.lit(0))
    else:
        # The text of a colliding block is needed once more, together with its row and place.
        again = stage(texts.select("rid", "id", "t", hashes.alias("hs")), "texts")
        docs = again.select("rid", "id", F.sha2("t", 256).alias("sha"), "hs")
        placed = again.select("rid", F.size("hs").alias("len"), F.posexplode(blocks_of(F.col("t"), block_chars)).alias("pos", "block"))
        placed = placed.withColumn("h", hash_of(F.col("block")))
        symbols = placed.join(subranks, ["h", "block"], "left").select("rid", "len", "pos", "h", F.coalesce("sub", F.lit(0)).alias("sub"))

    names = sorted_names(symbols, "h", "sub")
    level = 0
    single = symbols.filter("len = 1").join(names, ["h", "sub"]).select("rid", F.lit(level).alias("level"), "name")
    finished = [single]
    sequence = stage(symbols.filter("len > 1").join(names, ["h", "sub"]).select("rid", "len", "pos", "name"), "sequence")
    while not sequence.isEmpty():
        level += 1
        half = (F.col("pos") / 2).cast("int")
        left = F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a")
        right = F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")
        pairs = sequence.groupBy("rid", half.alias("half"), ((F.col("len") + 1) / 2).cast("int").alias("len")).agg(left, right)
        named = pairs.join(sorted_names(pairs, "a", "b"), ["a", "b"])
        shorter = stage(named.select("rid", "len", F.col("half").alias("pos"), "name"), "sequence")
        finished.append(shorter.filter("len = 1").select("rid", F.lit(level).alias("level"), "name"))
        sequence = shorter.filter("len > 1")

    identity = finished[0]
    for part in finished[1:]:
        identity = identity.unionByName(part)
    return stage(docs.select("rid", "id", "sha").join(identity, "rid"), "members")


def _grouped(numbered: DataFrame, block_chars: int = BLOCK_CHARS, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """The members with ``first`` (the row that stays) and ``group_size``."""
    with recorded() as paths:
        members = _members(numbered, block_chars, hash_of)
    drop_paths(members.sparkSession, paths[:-1])
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")).alias("first")
    groups = stage(members.groupBy("level", "name").agg(first, F.count("*").alias("group_size")), "groups")
    return join_groups(members, groups, ["level", "name"], "group_size", "rid")


def exact_dedup(
    df: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    block_chars: int = BLOCK_CHARS,
    hash_of: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep_id`` is the id of the row that stays for the row's text: the smallest one.
    """
    numbered = row_ids(df, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _grouped(numbered, block_chars, hash_of).select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def kept_rows(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that exact deduplication keeps, with all their columns."""
    rest = [c for c in df.columns if c not in (text_col, id_col)]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row") if rest else F.lit(None).cast("int").alias("row")
    rows = stage(row_ids(df, F.col(id_col).alias("id"), F.col(text_col).alias("text"), row), "rows")
    stay = stage(_grouped(rows.select("rid", "id", "text")).filter(F.col("rid") == F.col("first.rid")).select("rid"), "kept")
    kept = rows.join(stay.hint("merge"), "rid", "left_semi")  # alike at every size: whole rows, shuffled once
    return kept.select(*[F.col("id").alias(c) if c == id_col else F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in df.columns])
