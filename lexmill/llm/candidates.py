"""Components of a similarity graph from tokens that linked classes share, without listing all pairs.

Every token's classes are first compared with two anchors of the token (or likely pairs are,
which the caller names), and the links found join classes into components. Then only classes
of one token that are in different components remain, and all of these are compared: those
outside a token's commonest component with every class of another component. While that
would be much more than the rows, another round of anchors comes first, unless the last one
has made it hardly less. No link between two
classes that share a token can be lost, for either the pair is compared or both are already
in one component. What the classes carry may rule pairs out before they leave their task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import released, written
from lexmill.llm.components import connected_components

#: Rounds of anchors at most, pairs a row that may be looked at instead, and the fixed values that reorder classes when anchors are chosen.
ROUNDS, LOOKED_AT = 3, 64
#: The share of the work that a round of anchors must leave at most, for another to be worth it.
LEFT = 0.9
SALTS = (0, 0x5DEECE66D1234567, 0x2545F4914F6CDD1D, 0x369DEA0F31A53F85, 0x106689D45497FDB5, 0x27BB2EE687B0B0FD, 0x61C8864680B583EB)
OWN = ("token", "cls", "comp", "main", "work")


def _side(shared: DataFrame, side: str, *more: str) -> DataFrame:
    """The rows as one side of pairs: cls, comp and what they carry under names that begin with the side's."""
    return shared.select(*more, F.col("cls").alias(f"{side}_cls"), F.col("comp").alias(f"{side}_comp"), *[F.col(c).alias(f"{side}_{c}") for c in shared.columns if c not in OWN])


def _ordered(pairs: DataFrame, close) -> DataFrame:  # noqa: ANN001
    pairs = pairs.where("x_comp <> y_comp")
    if close is not None:
        pairs = close(pairs)
    return pairs.select(F.least("x_cls", "y_cls").alias("a"), F.greatest("x_cls", "y_cls").alias("b")).distinct()


def _anchor_pairs(shared: DataFrame, turn: int, close) -> DataFrame:  # noqa: ANN001
    """Each class with two anchors of each of its tokens: the smallest and the largest under an order of the turn."""
    salt = F.lit(SALTS[turn % len(SALTS)])
    best = shared.groupBy("token").agg(*[f(F.col("cls").bitwiseXOR(salt)).alias(f.__name__) for f in (F.min, F.max)])
    anchors = best.select("token", F.explode(F.array(*[F.col(f).bitwiseXOR(salt) for f in ("min", "max")])).alias("y_cls")).distinct()
    there = _side(shared, "y", "token").join(anchors, ["token", "y_cls"])
    return _ordered(_side(shared, "x", "token").join(there, "token"), close)


def _mixed(shared: DataFrame) -> DataFrame:
    """The rows of tokens whose classes are in two components or more, with the token's commonest component as main."""
    by = shared.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = by.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"), F.sum("k").alias("all")).where("comps > 1")
    return shared.join(main.select("token", F.col("main.comp").alias("main"), (F.col("all") * (F.col("all") - F.col("main.k"))).alias("work")), "token")


def linked_components(shared: DataFrame, verify: Callable[[DataFrame, int], DataFrame], folder: str, close: Callable[[DataFrame], DataFrame] | None = None, first: DataFrame | None = None) -> DataFrame:
    """(cls, comp) of the classes that have a link; shared: written rows (token, cls, …), each once.

    verify takes pairs (a, b), a < b, and the round, and returns those linked; close may rule
    pairs out before that by the other columns of shared, which are x_… and y_….
    first: likely pairs (a, b) in place of the first round of anchors.
    """
    edges, labels, work = None, None, None
    shared = shared.withColumn("comp", F.col("cls"))
    for turn in range(ROUNDS + 1):
        last = False
        if turn:
            left = shared.drop("comp", "main", "work")
            left = left.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls")) if labels is not None else left.withColumn("comp", F.col("cls"))
            shared = written(_mixed(left), folder, f"mixed-{turn}")
            size = shared.groupBy("token").agg(F.max("work").alias("w"), F.count(F.lit(1)).alias("n")).agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
            if not size.n:
                break
            last = turn == ROUNDS or size.w <= LOOKED_AT * size.n + 10_000 or (work is not None and size.w > LEFT * work)
            work = size.w
        if last:
            pairs = _ordered(_side(shared.where("comp <> main"), "x", "token").join(_side(shared, "y", "token"), "token"), close)
        elif not turn and first is not None:
            pairs = first
        else:
            pairs = _anchor_pairs(shared, turn, close)
        pairs = written(pairs, folder, f"pairs-{turn}")
        released(shared.sparkSession)
        found = written(verify(pairs, turn), folder, f"links-{turn}")
        released(shared.sparkSession)
        if not found.isEmpty():
            edges = found if edges is None else edges.unionByName(found)
            labels = connected_components(edges, folder, f"cc-{turn}").select(F.col("node").alias("cls"), F.col("component").alias("comp"))
        if last:
            break
    if labels is None:
        return shared.select("cls", F.col("cls").alias("comp")).limit(0)
    return labels
