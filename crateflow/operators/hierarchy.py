"""Parent-child links to roots, depths, paths and descendants; circles are found, not followed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.functions.chains import contract
from crateflow.session import cut_lineage

#: Links that one task contracts in memory, at most (about 200 bytes each) and at least; between them all shuffle partitions get a fragment.
FRAGMENT_ROWS, LEAST_FRAGMENT = 1_000_000, 2_000
_LINK = "node bigint, parent bigint, hops bigint, low bigint"
_HOP = "node bigint, exit bigint, hops bigint, low bigint, circle boolean"


def _contract_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if not parts:
        return
    t = pa.concat_tables(parts)
    node, parent, hops, low = (t.column(c).to_numpy() for c in ("node", "parent", "hops", "low"))
    out, dist, least, circle = contract(node, parent, hops, low)
    for i in range(0, len(node), 50_000):
        s = slice(i, i + 50_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[s]), pa.array(out[s].astype(np.int64)), pa.array(dist[s].astype(np.int64)), pa.array(least[s].astype(np.int64)), pa.array(circle[s])],
            names=["node", "exit", "hops", "low", "circle"],
        )


def _fragments(links: DataFrame, n: int, level: int, fragment_rows: int) -> DataFrame:
    parts = max(1, -(-n // fragment_rows))
    key = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(parts))
    spread = links.coalesce(1) if parts == 1 else links.repartition(parts, key)
    return spread.mapInArrow(_contract_partition, _HOP)


def _splice(links: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Take an independent quarter of the links out: a node whose coin shows heads while its parent's shows tails.

    Returns (the links that stay, re-tied past the removed nodes; the removed links).
    """
    coin = lambda c: F.xxhash64(c, F.lit(-1 - level)) % 2 == 0
    out = coin("node") & ~coin("parent")
    gone = links.where(out)
    past = gone.select(F.col("node").alias("_n"), F.col("parent").alias("_p"), F.col("hops").alias("_h"), F.col("low").alias("_l"))
    kept = links.where(~out).join(past, F.col("parent") == F.col("_n"), "left").select(
        "node", F.coalesce("_p", "parent").alias("parent"), (F.col("hops") + F.coalesce("_h", F.lit(0))).alias("hops"), F.least("low", "_l").alias("low")
    )
    return kept, gone


def _solve(links: DataFrame, n: int, level: int, fragment_rows: int) -> DataFrame:
    """(node, root, depth) of every node that has a parent; depth is null on chains that never end, root then the circle."""
    hop = _fragments(links, n, level, fragment_rows)
    if n <= fragment_rows:
        return hop.select("node", F.col("exit").alias("root"), F.when(~F.col("circle"), F.col("hops")).alias("depth"))
    hop = cut_lineage(hop)
    inner = hop.where(F.col("circle"))
    open_ = hop.where(~F.col("circle"))
    # The quotient keeps only the nodes at which some fragment's chain enters another fragment.
    entry = open_.select(F.col("exit").alias("node")).distinct()
    quotient = cut_lineage(hop.join(entry, "node", "left_semi"))
    rest = quotient.where(~F.col("circle")).select("node", F.col("exit").alias("parent"), "hops", "low")
    m = rest.count()
    known = quotient.where(F.col("circle")).select("node", F.col("exit").alias("root"), F.lit(None).cast("bigint").alias("depth"))
    if m > 0.75 * n:  # long chains that hashing hardly shortens
        kept, gone = _splice(rest, level)
        kept = cut_lineage(kept)
        done = _into_circles(_solve(kept, kept.count(), level + 1, fragment_rows), known)
        done = cut_lineage(done)
        done = done.unionByName(_expand(gone.select("node", F.col("parent").alias("exit"), "hops"), done.unionByName(known)))
    elif m:
        done = _into_circles(_solve(rest, m, level + 1, fragment_rows), known)
    else:
        done = known.limit(0)
    done = cut_lineage(done)
    done = done.unionByName(known)
    return _expand(open_.select("node", "exit", "hops"), done).unionByName(inner.select("node", F.col("exit").alias("root"), F.lit(None).cast("bigint").alias("depth")))


def _into_circles(done: DataFrame, known: DataFrame) -> DataFrame:
    """The deeper answer with what it couldn't see: an end that lies on or under a circle found at this level isn't a root."""
    ended = _expand(done.where("depth is not null").select("node", F.col("root").alias("exit"), F.col("depth").alias("hops")), known)
    return ended.unionByName(done.where("depth is null"))


def _expand(hop: DataFrame, done: DataFrame) -> DataFrame:
    """Put what is known of the exits under the chains that lead there; an exit without a parent is a root."""
    d = done.select(F.col("node").alias("_n"), F.col("root").alias("_r"), F.col("depth").alias("_d"))
    return hop.join(d, F.col("exit") == F.col("_n"), "left").select(
        "node",
        F.coalesce("_r", "exit").alias("root"),
        F.when(F.col("_n").isNull(), F.col("hops")).when(F.col("_d").isNotNull(), F.col("hops") + F.col("_d")).alias("depth"),
    )


def fragment_size(df: DataFrame, n: int) -> int:
    """Links a fragment for so many links in all."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(LEAST_FRAGMENT, min(FRAGMENT_ROWS, -(-n // parts)))


def parent_links(df: DataFrame, child: str, parent: str) -> DataFrame:
    """Distinct (node, parent) links. Of several parents the least counts; rows without child or parent give no link."""
    rows = df.where(F.col(child).isNotNull() & F.col(parent).isNotNull())
    return rows.groupBy(F.col(child).cast("bigint").alias("node")).agg(F.min(F.col(parent).cast("bigint")).alias("parent"))


def roots(df: DataFrame, child: str, parent: str, fragment_rows: int | None = None) -> DataFrame:
    """One row (node, root, depth) for each id in either column.

    A node without a parent is its own root at depth 0. A chain of parents that never ends gives depth -1 and as root
    the least id of the circle it runs into. Ids are integers. Null ids, repeated rows and extra columns are
    ignored; an id with several parents takes the least one; an empty table gives no rows.

    Links are hashed into fragments of about ``fragment_rows`` (by default as many as there are shuffle partitions, of bounded size); each fragment's chains are contracted to
    their exits in one Arrow pass, the quotient forest of entry nodes is solved the same way, and its answers are
    joined back. Where hashing hardly shortens the chains, a random independent set is spliced out, so each level takes
    at least about a fifth away whatever the shape.
    """
    ids = df.select(F.explode(F.array(F.col(child).cast("bigint"), F.col(parent).cast("bigint"))).alias("node")).where("node is not null").distinct()
    links = cut_lineage(parent_links(df, child, parent).select("node", "parent", F.lit(1).cast("bigint").alias("hops"), F.col("node").alias("low")))
    n = links.count()
    solved = _solve(links, n, 0, fragment_rows or fragment_size(df, n)) if n else links.select("node", F.col("parent").alias("root"), F.col("hops").alias("depth"))
    s = solved.select(F.col("node").alias("_n"), "root", "depth")
    return ids.join(s, F.col("node") == F.col("_n"), "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.when(F.col("_n").isNull(), 0).otherwise(F.coalesce("depth", F.lit(-1))).cast("int").alias("depth")
    )


def paths(df: DataFrame, child: str, parent: str, fragment_rows: int | None = None) -> DataFrame:
    """(node, root, depth, path): path runs from the root to the node; null where the chain never ends.

    Built on ``roots`` by doubling: after step k a node knows its nearest 2^k ancestors, and joins the list of the
    farthest of them. A path is as long as the depth, so this takes log2(depth) joins and writes no more than the result.
    """
    base = cut_lineage(roots(df, child, parent, fragment_rows))
    links = parent_links(df, child, parent)
    deepest = base.agg(F.max("depth")).first()[0] or 0
    up = base.where("depth >= 0").join(links, "node", "left").select("node", F.array("node").alias("path"), F.col("parent").alias("next"))
    reach = 1
    while reach <= deepest:
        up = cut_lineage(up)
        above = up.select(F.col("node").alias("_n"), F.col("path").alias("_p"), F.col("next").alias("_x"))
        going, done = up.where("next is not null"), up.where("next is null")
        up = going.join(above, F.col("next") == F.col("_n")).select("node", F.concat("_p", "path").alias("path"), F.col("_x").alias("next")).unionByName(done)
        reach *= 2
    return base.join(up.select("node", "path"), "node", "left").select("node", "root", "depth", "path")


def descendants(with_paths: DataFrame) -> DataFrame:
    """(ancestor, node, distance) for every node below another; nodes on or under circles have no finite list and no rows."""
    return (
        with_paths.select("node", "depth", F.posexplode("path").alias("_at", "ancestor"))
        .where(F.col("ancestor") != F.col("node"))
        .select("ancestor", "node", (F.col("depth") - F.col("_at")).cast("int").alias("distance"))
    )
