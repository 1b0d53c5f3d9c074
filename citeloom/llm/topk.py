"""Exact top-k inner-product search by columnar branch-and-bound.

Vectors are turned to integers and packed into blocks in vertical layout: a block holds one array of
values for each dimension. Every block of queries meets every block of candidates, joined by block
number. Within a pair of blocks, dimensions are taken block by block, those with most mass first.
Each adds its part of the scores; by the Cauchy-Schwarz inequality the dimensions that remain can
add or take back the product of the remaining masses (norms) at most. A candidate whose upper bound
falls below the k-th best lower bound is left out, and the survivors are compacted for the next
block of dimensions. Each pair of blocks gives k rows a query at most; the best k of all blocks are
then chosen by score, ties to the smaller id.

Defined cases: vectors that are null, empty or hold a null or a non-finite component take no part;
only vectors of one length are compared; a component's value is floor(256 * x) and scores
are exact (a value or score beyond 64 bits fails, as it does in SQL); every row but the query's own is a candidate, a
repeated row too; a null id is no query, and as a candidate it sorts last among ties; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import row_ids, stage

SCALE = 256
DIM_BLOCK = 16
#: Vectors of a candidate block and of a query block.
CANDIDATES, QUERIES = 4096, 512
_EXACT = 2.0**52


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (block, dims, pos, rid, vec_id, values) to one row a block, dimension by dimension."""
    held: list[pd.DataFrame] = []

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.stack(rows["values"].to_numpy()).astype(np.int64)
        ids = rows["vec_id"].astype("Int64")
        return pd.DataFrame({
            "kind": [rows["kind"].iloc[0]], "dims": [values.shape[1]], "block": [rows["block"].iloc[0]],
            "rids": [rows["rid"].to_numpy()], "ids": [[None if pd.isna(i) else int(i) for i in ids]],
            "columns": [np.ascontiguousarray(values.T).tobytes()],
        })

    for batch in batches:
        if len(batch):
            held.append(batch)
            rows = pd.concat(held)
            key = rows[["kind", "dims", "block"]].astype(str).agg("|".join, axis=1)
            last = key.iloc[-1]
            done = rows[key != last]
            for _, part in done.groupby(key[key != last], sort=False):
                yield packed(part)
            held = [rows[key == last]]
    if held and len(held[0]):
        yield packed(held[0])


def best_of_block(queries: np.ndarray, columns: np.ndarray, k: int, own: np.ndarray, tie: np.ndarray, dim_block: int = DIM_BLOCK) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (row) the candidates (columns of the vertical block) of the k best scores, and the scores.

    ``own`` is the candidate that is the query's own row, or -1; ``tie`` orders candidates of equal score.
    """
    dims, n = columns.shape
    q_mass, c_mass = queries.astype(np.float64) ** 2, columns.astype(np.float64) ** 2
    order = np.argsort(-(q_mass.sum(0) * c_mass.sum(1)), kind="stable")
    queries, columns, q_mass, c_mass = queries[:, order], columns[order], q_mass[:, order], c_mass[order]
    cuts = [*range(0, dims, dim_block), dims]
    # Roots of the masses that remain after each block of dimensions, rounded up.
    q_rest = [np.sqrt(q_mass[:, c:].sum(1)) * (1 + 1e-9) for c in cuts]
    c_rest = [np.sqrt(c_mass[c:].sum(0)) * (1 + 1e-9) for c in cuts]
    exact = np.sqrt(q_mass.sum(1).max(initial=0)) * np.sqrt(c_mass.sum(0).max(initial=0)) < _EXACT
    kind = np.float64 if exact else object
    qs, cs = queries.astype(kind), columns.astype(kind)
    first = qs[:, : cuts[1]] @ cs[: cuts[1]]
    out = []
    for i in range(len(qs)):
        alive, score = np.arange(n), first[i]
        if own[i] >= 0:
            alive, score = np.delete(alive, own[i]), np.delete(score, own[i])
        for b in range(1, len(cuts)):
            if len(alive) > k:
                spread = np.asarray(q_rest[b][i] * c_rest[b][alive], np.float64)
                about = score.astype(np.float64)
                slack = 0.0 if exact else np.abs(about) * 1e-9 + 1
                bound = np.partition(about - spread - slack, len(alive) - k)[len(alive) - k]
                keep = about + spread + slack >= bound
                alive, score = alive[keep], score[keep]
            if b + 1 < len(cuts):
                score = score + qs[i, cuts[b] : cuts[b + 1]] @ cs[cuts[b] : cuts[b + 1], alive]
        whole = np.array([int(s) for s in score], object) if not exact else score.astype(np.int64)
        top = np.lexsort((tie[alive], np.array([-s for s in whole], object) if not exact else -whole))[:k]
        out.append((alive[top], whole[top]))
    return out


def _search(k: int, dim_block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                dims = row.dims
                queries = np.frombuffer(row.q_columns, np.int64).reshape(dims, -1).T
                columns = np.frombuffer(row.columns, np.int64).reshape(dims, -1)
                rids, q_rids = np.asarray(row.rids), np.asarray(row.q_rids)
                place = {r: i for i, r in enumerate(rids.tolist())}
                own = np.array([place.get(r, -1) for r in q_rids.tolist()])
                ids = [None if i is None or pd.isna(i) else int(i) for i in row.ids]
                by_id = sorted(range(len(ids)), key=lambda j: (ids[j] is None, ids[j] or 0, rids[j]))
                tie = np.empty(len(ids), np.int64)
                tie[by_id] = np.arange(len(ids))
                found = best_of_block(queries, columns, k, own, tie, dim_block)
                data = [(q, int(q_id), int(rids[j]), ids[j], int(s)) for q, q_id, (top, scores) in zip(q_rids.tolist(), row.q_ids, found, strict=True) for j, s in zip(top.tolist(), scores, strict=True)]
                out = pd.DataFrame(data, columns=["q_rid", "query_id", "rid", "vec_id", "score"])
                out["vec_id"] = out["vec_id"].astype("Int64")
                yield out

    return run


def top_k(df: DataFrame, is_query, k: int = 5, vec_col: str = "embedding", id_col: str = "vec_id", candidates: int = CANDIDATES, queries: int = QUERIES, dim_block: int = DIM_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's k best candidates.

    ``is_query`` is a condition on ``vec_id``.
    """
    spark = df.sparkSession
    fits = lambda v: F.when((v >= -(2.0**63)) & (v < 2.0**63), F.floor(v)).otherwise(F.raise_error(F.lit("a component is out of the range of 64 bits")).cast("long"))
    scaled = F.transform(F.col(vec_col), lambda x: fits(x.cast("double") * SCALE))
    finite = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    usable = df.filter(F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & finite)
    rows = stage(row_ids(usable, F.col(id_col).cast("long").alias("vec_id"), scaled.alias("values"), F.size(vec_col).alias("dims")), "vectors")

    # Rows are dealt to blocks by their hash; a block's size stays near the wanted one.
    per_length = rows.groupBy("dims").agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("nq"))
    about = stage(per_length.select("dims", F.ceil(F.col("n") / candidates).cast("int").alias("blocks"), F.ceil(F.greatest("nq", F.lit(1)) / queries).cast("int").alias("q_blocks")), "blocks")
    with_blocks = rows.join(about, "dims")
    columns = ["kind", "dims", "block", "rid", "vec_id", "values"]
    cand = with_blocks.select(F.lit("c").alias("kind"), "dims", F.pmod(F.xxhash64("rid"), "blocks").cast("int").alias("block"), "rid", "vec_id", "values")
    asks = with_blocks.filter(is_query).select(F.lit("q").alias("kind"), "dims", F.pmod(F.xxhash64("rid"), "q_blocks").cast("int").alias("block"), "rid", "vec_id", "values")
    dealt = cand.unionByName(asks).repartition("kind", "dims", "block").sortWithinPartitions("kind", "dims", "block", "rid").select(*columns)
    blocks = stage(dealt.mapInPandas(_pack, "kind string, dims int, block int, rids array<long>, ids array<long>, columns binary"), "packed")

    # Each candidate block goes to every query block of its length: a stated query set, in blocks.
    replicated = blocks.filter("kind = 'c'").join(about, "dims").withColumn("q_block", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
    asked = blocks.filter("kind = 'q'").select("dims", F.col("block").alias("q_block"), F.col("rids").alias("q_rids"), F.col("ids").alias("q_ids"), F.col("columns").alias("q_columns"))
    pairs = replicated.join(asked, ["dims", "q_block"]).select("dims", "rids", "ids", "columns", "q_rids", "q_ids", "q_columns")
    dealt_pairs = pairs.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    near = dealt_pairs.mapInPandas(_search(k, dim_block), "q_rid long, query_id long, rid long, vec_id long, score long")
    order = Window.partitionBy("q_rid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "rid")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
