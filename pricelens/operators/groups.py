"""Groups of similar products: connected components over match pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.operators import compare as C
from pricelens.session import stage


def match_groups(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, grp) for every node of ``pairs`` (bigint columns): ``grp`` is the
    least node that can be reached.

    Every node takes the least group among its neighbours' and its own, then its
    group's group (so paths shorten by half a round); the rounds grow with the
    logarithm of the longest path.  A node with a third of all pairs ships one
    row a task: minima combine before the shuffle, and adaptive execution splits
    the join.  Every round is stored, so a lost executor costs one round.  Nodes
    may be millions in a small packed file, so no join broadcasts them."""
    known = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("bigint").alias("s"), F.col(b).cast("bigint").alias("d"))
    edges = stage(known.unionByName(known.select(F.col("d").alias("s"), F.col("s").alias("d"))).distinct(), "match-edges")
    labels = stage(edges.groupBy(F.col("s").alias("node")).agg(F.min("d").alias("d")).select("node", F.least("node", "d").alias("grp")), "match-groups")
    while True:
        near = edges.join(labels.hint("merge"), F.col("d") == F.col("node")).groupBy("s").agg(F.min("grp").alias("near"))
        stepped = labels.join(near.hint("merge"), F.col("node") == F.col("s")).select("node", "grp", F.least("grp", "near").alias("to"))
        ahead = labels.select(F.col("node").alias("_n"), F.col("grp").alias("_g"))
        jumped = stage(stepped.join(ahead.hint("merge"), F.col("to") == F.col("_n")).select("node", F.col("grp").alias("was"), F.least("to", "_g").alias("grp")), "match-groups")
        labels = jumped.select("node", "grp")
        if not jumped.where("grp <> was").limit(1).count():
            return labels


def similar_groups(products: DataFrame, id_col: str, name_col: str, threshold: float) -> DataFrame:
    """Every product with ``grp``, the least id of the products it is linked to by
    chains of similar or equal names; a product without a name is alone."""
    plain = products.select(F.col(id_col).cast("bigint").alias("_id"), F.col(name_col).alias("name"))
    names = stage(plain.where("name is not null").groupBy("name").agg(F.min("_id").alias("node")), "names")
    groups = match_groups(C.similar_links(names, threshold))
    named = names.join(groups.hint("merge"), "node", "left").select(F.col("name").alias("_name"), F.coalesce("grp", "node").alias("_g"))
    return products.join(named.hint("merge"), products[name_col] == F.col("_name"), "left").select(
        *[products[c] for c in products.columns], F.coalesce("_g", products[id_col].cast("bigint")).alias("grp"))
