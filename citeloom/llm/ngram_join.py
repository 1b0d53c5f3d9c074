"""Similarity self-join of documents on word shingles by token-combination prefixes.

The tokens of a document are its distinct word shingles. All documents sort their tokens by one
global order, rare ones first; the order comes from a sketch of token frequencies counted over all
documents. A document of n tokens that must share at least a = ceil(t * n) of them with a partner

* indexes every rare token of its prefix of n - a + 1 tokens by itself, and
* if that prefix reaches frequent tokens, extends it by G tokens and indexes the 2-token
  combinations of its frequent tokens, separately in each of G frequent token classes.

Why no link is lost: if the first token that two linked documents share is rare, it is in both
prefixes. Otherwise all the tokens they share are frequent, and the first G + 1 of them lie in both
extended prefixes, so two fall into the same class. G depends on the power of two below the number
of tokens; a document whose partner may lie below that power indexes the lower G too.

Documents with equal word sequences form one class, of which one document is compared; so do those
of one and the same shingle, be it one word repeated in different numbers. Buckets of
equal index entries are not expanded into all pairs: first each member is compared with its bucket's
most central member, and components are formed from the verified links; then only members of
different components in a bucket are compared. That keeps every link between components, so the components are exact.

Candidates come from 64-bit shingle hashes under a key that is drawn for each join; candidate pairs
are verified on the words themselves. A pair's texts are not joined into one row: a document that has
many partners is sent once to each group of ``PARTNERS`` of them, and Arrow batches are bounded in
bytes. Rows of classes, buckets and components that are large are dealt to ``SALTS`` tasks each.

Defined cases: a null or empty text has no shingles and is linked with nothing; a text with fewer
words than a shingle has its whole sequence as its one shingle; a null id takes part but is never a
component's id while another id is there; repeated rows are linked with each other; an empty table
gives an empty result; extra columns are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import SALTS, bits_of, bound_batches, drop_staged, join_groups, row_ids, stage, with_bit
from citeloom.llm.components import components
from citeloom.llm.shingles import distinct, documents_of, exact_sets, mix

WIDTH = 4
#: Two documents link when PERCENT_OF * intersection >= PERCENT * union.
PERCENT = 85
SKETCH_BITS = 20
SKETCH_CHUNK = 1 << 12
#: Bits of a document's bitmap, in 64-bit words.
BITMAP_WORDS = 8
NEED_BITS = 22
#: Partners that one copy of a document's text is compared with.
PARTNERS = 1000


def min_shared(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def classes_of(band: int, percent: int) -> int:
    """Number of frequent token classes for documents of 2**band tokens or more."""
    return max(1, (100 - percent) * (1 << band) // 200)


# --- keys, sizes, bitmaps and the sketch of token frequencies ------------------------------------


def bitmap(tokens: np.ndarray) -> list[int]:
    """Whether an odd number of tokens falls on each bit: where two bitmaps differ, so do the sets."""
    odd = np.bincount((tokens & np.uint64(64 * BITMAP_WORDS - 1)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def class_key(text: bytes, n: int, width: int) -> bytes:
    """Digest of the word sequence; of a text of one shingle, of that shingle."""
    words = text.lower().split()
    return hashlib.sha256(b" ".join(words[:width] if n == 1 else words)).digest()


def _measure(width: int, secret: bytes):
    names = ["rid", "id", "key", "n", "bits", "chunk", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, id_type = np.zeros(1 << SKETCH_BITS, np.int64), pa.null()
        for batch in batches:
            texts, id_type = batch.column(2), batch.column(1).type
            sizes, bitmaps = [], []
            for tokens in documents_of(texts, width, secret):
                sizes.append(len(tokens))
                bitmaps.append(bitmap(tokens))
                np.add.at(sketch, (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
            keys = [class_key(t.as_buffer().to_pybytes() if t.is_valid else b"", n, width) for t, n in zip(texts.cast(pa.binary()), sizes, strict=True)]
            none = pa.nulls(len(sizes))
            columns = [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(bitmaps, pa.list_(pa.int64())), none.cast(pa.int32()), none.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        parts = sketch.reshape(-1, SKETCH_CHUNK)
        full = np.flatnonzero(parts.any(axis=1))
        if len(full):
            none = pa.nulls(len(full))
            counts = [parts[i].tobytes() for i in full]
            columns = [none.cast(pa.int64()), none.cast(id_type), none.cast(pa.binary()), none.cast(pa.int32()), none.cast(pa.list_(pa.int64())), pa.array(full, pa.int32()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _merge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the partial sketches' chunks, streamed: a task holds one array for each of its chunks."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(counts.as_buffer(), np.int64)
            sums[chunk] = sums[chunk] + part if chunk in sums else part.copy()
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([a.tobytes() for a in sums.values()], pa.binary())], names=["chunk", "counts"])


def token_levels(measured: DataFrame) -> tuple[np.ndarray, int]:
    """Frequency level of each sketch cell, and the level from which tokens count as frequent.

    The sketch has a fixed number of cells, whatever the size of the corpus; so do the rows
    collected here. A token is frequent if its cell stands out from the mean cell.
    """
    parts = measured.filter("chunk IS NOT NULL").select("chunk", "counts")
    merged = parts.repartition("chunk").mapInArrow(_merge_counts, "chunk int, counts binary")
    cells = np.zeros((1 << SKETCH_BITS) // SKETCH_CHUNK * SKETCH_CHUNK, np.int64).reshape(-1, SKETCH_CHUNK)
    for row in merged.collect():
        cells[row["chunk"]] = np.frombuffer(row["counts"], np.int64)
    cells = cells.reshape(-1)
    mean = cells.mean()
    # Levels grow with the logarithm of the count, 4095 at most.
    level = lambda count: np.minimum(4095, 128 * np.log2(1 + count / max(1.0, mean / 16)))
    return level(cells).astype(np.uint16), int(level(mean + 8 * np.sqrt(mean) + 32)) + 1


# --- index entries -------------------------------------------------------------------------------


def prefix_entries(tokens: np.ndarray, levels: np.ndarray, frequent: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of a document: those of single rare tokens in order, and those of frequent combinations."""
    n = len(tokens)
    none = tokens[:0]
    if n < 2:  # a set of one token equals any set that it is linked with, and those are one class
        return none, none
    level = levels[(tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    least = min_shared(n, percent)
    base = n - least + 1
    band = n.bit_length() - 1
    bands = [band] + [band - 1] * (band > 1 and least < 1 << band)
    longest = base + max(classes_of(b, percent) for b in bands)
    order = np.argsort(level.astype(np.uint64) << np.uint64(52) | tokens >> np.uint64(12), kind="stable")[:longest]
    prefix, hot = tokens[order], level[order] >= frequent
    rare = int(np.argmax(hot[:base])) if hot[:base].any() else base
    singles = mix(prefix[:rare] ^ np.uint64(0x5BD1E9955BD1E995))
    if rare == base:
        return singles, none
    pairs = []
    for b in bands:
        number = classes_of(b, percent)
        part = np.sort(prefix[rare : base + number])
        kind = mix(part) % np.uint64(number)
        by_class = np.argsort(kind, kind="stable")
        part, kind = part[by_class], kind[by_class]
        for step in range(1, len(part)):
            same = kind[step:] == kind[:-step]
            if not same.any():
                break
            left, right = part[:-step][same], part[step:][same]
            pairs.append(mix(mix(left) * np.uint64(3) + mix(right ^ np.uint64(b + 1))))
    return singles, np.concatenate(pairs) if pairs else none


def _entries(levels, frequent: int, width: int, percent: int, secret: bytes):
    schema = pa.schema([("sig", pa.int64()), ("rid", pa.int64()), ("room", pa.int32()), ("hot", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = levels.value
        for batch in batches:
            parts, held = [], 0
            for rid, tokens in zip(batch.column(0).to_numpy(), documents_of(batch.column(1), width, secret), strict=True):
                singles, pairs = prefix_entries(tokens, cells, frequent, percent)
                n = len(tokens)
                if len(singles):
                    parts.append((singles.view(np.int64), np.full(len(singles), rid), np.arange(n, n - len(singles), -1, dtype=np.int32), np.zeros(len(singles), bool)))
                if len(pairs):
                    pairs = distinct(pairs)
                    room = np.full(len(pairs), n - len(singles), np.int32)
                    parts.append((pairs.view(np.int64), np.full(len(pairs), rid), room, np.ones(len(pairs), bool)))
                held += len(singles) + len(pairs)
                if held > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], schema=schema)
                    parts, held = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], schema=schema)

    return run


# --- verification --------------------------------------------------------------------------------


def _verify(width: int, percent: int):
    """Rows (pivot, part, member, text) in order, a pivot's own text before those of its members, to links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot_text = pa.array([""], pa.large_string())
        for batch in batches:
            texts = pa.concat_arrays([pivot_text, batch.column(3).cast(pa.large_string())])
            sets = exact_sets(texts, width)
            at, keep = 0, []
            for i, is_pivot in enumerate(batch.column(2).is_null().to_pylist(), 1):
                if is_pivot:
                    at = i
                    keep.append(False)
                else:
                    shared = len(np.intersect1d(sets[at], sets[i], assume_unique=True))
                    keep.append(100 * shared >= percent * (len(sets[at]) + len(sets[i]) - shared))
            pivot_text = pa.concat_arrays([texts.slice(at, 1)])
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the staged pairs (a, b) whose texts are similar enough.

    Of each pair the document with more partners is the pivot. Texts that no pair needs are left out
    by a bitmap of fixed size over row numbers; what its false positives let through is dropped by
    the joins. Joins that carry texts are sort-merge joins at every size.
    """
    ends = pairs.select(F.col("a").alias("rid")).union(pairs.select("b"))
    degrees = stage(ends.groupBy("rid").agg(F.count("*").alias("degree")), "degrees")
    ranked = pairs
    for x, other in (("a", "b"), ("b", "a")):
        ranked = join_groups(ranked, degrees.select(F.col("rid").alias(x), F.col("degree").alias(f"degree_{x}")), [x], f"degree_{x}", other)
    swap = (F.col("degree_a") > F.col("degree_b")) | ((F.col("degree_a") == F.col("degree_b")) & (F.col("a") > F.col("b")))
    member, pivot = F.when(swap, F.col("b")).otherwise(F.col("a")), F.when(swap, F.col("a")).otherwise(F.col("b"))
    part = F.pmod(F.xxhash64(member), F.ceil(F.greatest("degree_a", "degree_b") / PARTNERS)).cast("int")
    dealt = stage(ranked.select(pivot.alias("pivot"), part.alias("part"), member.alias("member")), "dealt-pairs")
    needed = with_bit(texts, bits_of(degrees, "rid", bits=NEED_BITS), "rid", bits=NEED_BITS, out="needed").filter("needed").select("rid", "text")
    members = dealt.join(needed.withColumnRenamed("rid", "member").hint("merge"), "member")
    pivots = dealt.select("pivot", "part").distinct().join(needed.withColumnRenamed("rid", "pivot").hint("merge"), "pivot")
    columns = ["pivot", "part", "member", "text"]
    rows = members.select(*columns).unionByName(pivots.withColumn("member", F.lit(None).cast("long")).select(*columns))
    ordered = rows.repartition("pivot", "part").sortWithinPartitions("pivot", "part", F.col("member").asc_nulls_first())
    links = stage(ordered.mapInArrow(_verify(width, percent), "a long, b long"), "links")
    drop_staged(degrees, dealt)
    return links


# --- the join ------------------------------------------------------------------------------------


def _side(x: str) -> list[Column]:
    return [F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("room").alias(f"room_{x}")]


def _can_link(percent: int) -> Column:
    """Whether enough tokens are left for a link, from an entry's ``room`` in both documents.

    A pair whose first shared token is rare has an entry for that token; none of the tokens before
    it is shared, so its room is the number of tokens from there on. Any other pair shares frequent
    tokens only, and the room of their combinations is the number of tokens that are not rare.
    """
    return (100 + percent) * F.least("room_a", "room_b").cast("long") >= percent * (F.col("n_a").cast("long") + F.col("n_b"))


def _alike(percent: int) -> Column:
    """Whether the bitmaps leave room for a link: each bit that differs stands for a token not shared."""
    word = lambda x, k: F.element_at(f"bits_{x}", k)
    differ = sum((F.bit_count(word("a", k).bitwiseXOR(word("b", k))) for k in range(2, BITMAP_WORDS + 1)), F.bit_count(word("a", 1).bitwiseXOR(word("b", 1))))
    both = F.col("n_a").cast("long") + F.col("n_b")
    return (100 + percent) * (both - differ) >= 2 * percent * both


def _members_and_labels(df: DataFrame, text_col: str, id_col: str, width: int, percent: int, carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """Staged texts (with the carried columns) and ``rid``, ``id``, ``n``, ``class_id``, ``root``, ``component``."""
    spark = df.sparkSession
    bound_batches(spark)
    secret = secrets.token_bytes(16)
    row = F.struct(*[F.col(c) for c in carried]).alias("row") if carried else F.lit(None).cast("int").alias("row")
    texts = stage(row_ids(df, F.col(id_col).alias("id"), F.col(text_col).alias("text"), row), "texts")
    kind = texts.schema["id"].dataType.simpleString()
    measured = stage(texts.select("rid", "id", "text").mapInArrow(_measure(width, secret), f"rid long, id {kind}, key binary, n int, bits array<long>, chunk int, counts binary"), "measured")
    levels, frequent = token_levels(measured)

    # Classes: documents with words by their key, those without each by itself.
    rows = measured.filter("chunk IS NULL")
    whole = stage(rows.filter("n > 0").groupBy("key").agg(F.count("*").alias("size"), F.min("rid").alias("rep"), F.min("id").alias("class_id")), "classes")
    found = join_groups(rows.filter("n > 0").select("key", "rid", "id", "n"), whole, ["key"], "size", "rid").select("rid", "id", "n", "rep", "class_id", "size")
    alone = rows.filter("n = 0").select("rid", "id", "n", F.col("rid").alias("rep"), F.col("id").alias("class_id"), F.lit(1).cast("long").alias("size"))
    members = stage(found.unionByName(alone), "members")
    drop_staged(whole)

    shared = spark.sparkContext.broadcast(levels)
    entries = texts.select("rid", "text").mapInArrow(_entries(shared, frequent, width, percent, secret), "sig long, rid long, room int, hot boolean")
    # Entries that nobody else has are dropped within their salted part of the bucket.
    salted = entries.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("rid"), F.lit(SALTS))).otherwise(F.lit(0)))
    full = salted.withColumn("size", F.count("*").over(Window.partitionBy("sig", "salt")))
    shared_entries = full.filter("hot OR size > 1").select("sig", "rid", "room")
    buckets = stage(shared_entries.join(members.select("rid", "rep", "n"), "rid").select("sig", F.col("rep").alias("id"), "n", "room").distinct(), "buckets")

    # First each member against the most central member of each of its buckets: the one that shares
    # most entries with others, which is the original of a group of near copies.
    sizes = stage(buckets.groupBy("sig").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    sized = stage(join_groups(buckets, sizes, ["sig"], "size", "id"), "sized")
    scores = sized.groupBy("id").agg(F.sum("size").alias("score"))
    scored = stage(sized.join(scores, "id").select("sig", "id", "n", "room", "score"), "scored")
    drop_staged(buckets, sizes, sized)
    pivots = stage(scored.groupBy("sig").agg(F.max(F.struct("score", "id", "n", "room")).alias("p"), F.count("*").alias("size")), "pivots")
    starred = join_groups(scored, pivots, ["sig"], "size", "id").select(*_side("a"), F.col("p.id").alias("b"), F.col("p.n").alias("n_b"), F.col("p.room").alias("room_b"))
    pairs = stage(starred.filter("a != b").filter(_can_link(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "star-pairs")
    links = verified(pairs, texts, width, percent)
    drop_staged(pivots, pairs)
    found = components(links)

    # Then members of different components that share an entry.
    roots = found.select(F.col("node").alias("id"), "root")
    placed = stage(scored.join(roots, "id", "left").select("sig", "id", "n", "room", F.coalesce("root", "id").alias("root")), "placed")
    drop_staged(scored)
    counted = placed.groupBy("sig", "root").agg(F.count("*").alias("c"))
    mixed = stage(counted.groupBy("sig").agg(F.max(F.struct("c", "root")).alias("most"), F.count("*").alias("roots"), F.sum("c").alias("size")).filter("roots > 1").select("sig", "size", F.col("most.root").alias("major")), "mixed")
    in_mixed = join_groups(placed, mixed, ["sig"], "size", "id")
    in_mixed = stage(in_mixed.join(rows.select(F.col("rid").alias("id"), "bits"), "id"), "in-mixed")
    drop_staged(placed, mixed)
    minor = in_mixed.filter("root != major").select("sig", "size", *_side("a"), F.col("root").alias("root_a"), F.col("bits").alias("bits_a"))
    other = in_mixed.select("sig", *_side("b"), F.col("root").alias("root_b"), F.col("bits").alias("bits_b"), "major")
    cross = join_groups(other, minor, ["sig"], "size", "b").filter("root_a != root_b AND (root_b = major OR root_a < root_b)").filter(_can_link(percent) & _alike(percent))
    pairs = stage(cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cross-pairs")
    drop_staged(in_mixed, measured)
    more = verified(pairs, texts, width, percent)
    joined = components(links.unionByName(more)) if not more.isEmpty() else found
    drop_staged(pairs, links, more)

    # Labels of the classes, then of their members.
    reps = stage(members.filter("rid = rep").select("rep", "class_id", "size").join(joined, F.col("rep") == F.col("node"), "left").select("rep", "class_id", "size", "root"), "reps")
    smallest = stage(reps.filter("root IS NOT NULL").groupBy("root").agg(F.min("class_id").alias("component"), F.count("*").alias("classes")), "smallest")
    linked = join_groups(reps.filter("root IS NOT NULL"), smallest, ["root"], "classes", "rep").select("rep", "size", "root", "component")
    single = reps.filter("root IS NULL").select("rep", "size", "root", F.col("class_id").alias("component"))
    labels = stage(linked.unionByName(single), "labels")
    drop_staged(reps, smallest, joined)
    return texts, join_groups(members.drop("size"), labels, ["rep"], "size", "rid")


def similar_components(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, ``n_shingles`` and ``component_id`` (the smallest id reachable by links)."""
    texts, out = _members_and_labels(df, text_col, id_col, width, percent, [])
    drop_staged(texts)
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` with one row of each component, the one with the smallest id, and all columns.

    Rows without shingles are linked with nothing and stay.
    """
    rest = [c for c in df.columns if c not in (text_col, id_col)]
    texts, out = _members_and_labels(df, text_col, id_col, width, percent, rest)
    # Rows of a component share its smallest row number and class; a row alone has its own.
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")
    first = out.filter("root IS NOT NULL OR n > 0").groupBy(F.coalesce("root", "rep").alias("c")).agg(F.min(place).alias("first")).select("first.rid")
    stay = stage(first.unionByName(out.filter("root IS NULL AND n = 0").select("rid")), "stay")
    kept = texts.join(stay.hint("merge"), "rid", "left_semi")  # alike at every size: whole rows, shuffled once
    return kept.select(*[F.col("id").alias(c) if c == id_col else F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in df.columns])
