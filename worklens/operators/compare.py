"""Table differences, fingerprints and measure reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.schemas import VOLATILE

#: Buckets that a node of the digest tree is divided into, and levels of the tree. Their power is what
#: bounds the list of differing leaves that is broadcast.
FANOUT, DEPTH, MOST_LEAVES = 256, 2, 1 << 17


def _compared(left: DataFrame, right: DataFrame, ignore: Sequence[str]) -> list[str]:
    columns = [c for c in left.columns if c not in ignore]
    if columns != [c for c in right.columns if c not in ignore]:
        raise ValueError(f"different columns: {columns} and {right.columns}")
    return columns


def table_diff(
    left: DataFrame, right: DataFrame, ignore: Sequence[str] = tuple(VOLATILE)
) -> DataFrame:
    """Rows whose number of copies differs, with the copies on each side.

    Both directions come out of one aggregation over the union. Volatile columns are left out;
    different column lists are an error, not a difference.
    """
    columns = _compared(left, right, ignore)
    both = left.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        right.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("_a").alias("copias_a"), F.sum("_b").alias("copias_b"))
        .where("copias_a <> copias_b")
    )


def _node(digest: str, level: int, fanout: int) -> Column:
    """Bucket of a row at a level; the bucket of the level above is its remainder."""
    return F.pmod(F.col(digest), F.lit(fanout**level))


def _digests(df: DataFrame, columns: Sequence[str], sign: int) -> DataFrame:
    """Two independent hashes a row, NULL told apart from everything else, signed by its side."""
    marked = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return df.select(
        F.xxhash64(F.lit(1), *marked).alias("_h1"), F.xxhash64(F.lit(2), *marked).alias("_h2"),
        F.lit(sign).alias("_sign"), *columns)


def _under(rows: DataFrame, nodes: DataFrame, level: int, fanout: int) -> DataFrame:
    """Rows under the given nodes, each of which is there once: an inner join keeps rows as they are,
    and stays above the union of the two sides, so that the nodes are computed once."""
    return rows.join(
        F.broadcast(nodes), _node("_h1", level, fanout) == F.col("_node")).drop("_node")


def differing_nodes(
    both: DataFrame, fanout: int = FANOUT, depth: int = DEPTH
) -> DataFrame:
    """``_node``: leaves of the digest tree whose rows are not the same multiset on both sides.

    A level is one aggregation whose map side leaves a row a node and task; only rows under nodes that
    differ reach the next one. A node is summed with opposite signs, so equal sides cancel: row counts
    and the sums of two 64-bit hashes must all come to zero, else it differs.
    """
    if fanout**depth > MOST_LEAVES:
        raise ValueError(f"{fanout}^{depth} leaves are too many to broadcast")
    # sums of 22 bits at a time stay whole numbers up to 2^41 rows a node
    pieces = [F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << 22) - 1)) * F.col("_sign")
              for h in ("_h1", "_h2") for at in (0, 22, 44)]
    nodes: DataFrame | None = None
    for level in range(1, depth + 1):
        rows = both if nodes is None else _under(both, nodes, level - 1, fanout)
        nodes = (
            rows.groupBy(_node("_h1", level, fanout).alias("_node"))
            .agg(F.array(F.sum("_sign"), *[F.sum(x) for x in pieces]).alias("_sums"))
            .where(F.exists("_sums", lambda x: x != 0)).select("_node")
        )
    return nodes


def table_diff_by_digest(
    left: DataFrame, right: DataFrame, ignore: Sequence[str] = tuple(VOLATILE),
    fanout: int = FANOUT, depth: int = DEPTH,
) -> DataFrame:
    """The rows of :func:`table_diff`, for tables that are the same almost everywhere.

    Bucket digests are compared first, down a tree; only rows of leaves that differ are shuffled and
    compared column by column. Each level reads both tables once more, which costs less than shuffling
    them; where most leaves differ, :func:`table_diff` is cheaper. Two leaves that differ count as the
    same only if both sums of their hashes agree by chance (about 1 in 2^110).
    """
    columns = _compared(left, right, ignore)
    both = _digests(left, columns, 1).unionByName(_digests(right, columns, -1))
    return (
        _under(both, differing_nodes(both, fanout, depth), depth, fanout)
        .groupBy(*columns)
        .agg(F.count_if(F.col("_sign") > 0).alias("copias_a"),
             F.count_if(F.col("_sign") < 0).alias("copias_b"))
        .where("copias_a <> copias_b")
    )


def diff_summary(diff: DataFrame) -> DataFrame:
    """Rows only on one side, counted with their copies."""
    return diff.agg(
        F.coalesce(F.sum(F.greatest(F.expr("copias_a - copias_b"), F.lit(0))), F.lit(0))
        .alias("so_em_a"),
        F.coalesce(F.sum(F.greatest(F.expr("copias_b - copias_a"), F.lit(0))), F.lit(0))
        .alias("so_em_b"),
    )


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and an order-free sum of row digests.

    Each row is hashed from its columns as text, NULL told apart from empty; digests are summed, so
    repeated rows count and pairs do not cancel.
    """
    texts = [
        F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n"))
        for c in (columns or df.columns)
    ]
    digest = F.conv(F.substring(F.sha2(F.concat_ws("\u0001", *texts), 256), 1, 15), 16, 10)
    return df.select(digest.cast("bigint").alias("_digest")).agg(
        F.count(F.lit(1)).alias("linhas"),
        F.coalesce(F.sum(F.col("_digest").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")
        .alias("soma"),
    )


def reconcile(
    ours: DataFrame, independent: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """Two definitions of the same measures, side by side.

    Both hold ``medida, valor, texto``; numbers agree within max(0.006, 1e-6 of the value), texts
    exactly. A measure missing on one side, or blank where the other has a value, does not agree.
    ``keys`` are further columns that say whose values they are, such as the role; NULL is a key of
    its own (the total).
    """
    by = [*keys, "medida"]
    a = ours.select(*by, F.col("valor").alias("valor_a"), F.col("texto").alias("texto_a"))
    b = independent.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("valor").alias("valor_b"), F.col("texto").alias("texto_b"),
    )
    close = F.abs(F.col("valor_a") - F.col("valor_b")) <= F.greatest(
        F.lit(0.006), F.abs("valor_b") * 1e-6
    )
    agrees = F.when(F.col("valor_b").isNotNull(), close).otherwise(
        F.col("valor_a").isNull() & F.col("texto_a").eqNullSafe(F.col("texto_b"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    both = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), same, "full")
    present = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return both.select(
        *[F.coalesce(c, f"_{c}").alias(c) for c in by], "valor_a", "texto_a", "valor_b", "texto_b",
        (present & F.coalesce(agrees, F.lit(False))).alias("confere"))
