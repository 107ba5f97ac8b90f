"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyforge.sources.paths import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for links (a, b): the label is the smallest node that can be reached.

    Each round takes the smallest label of the neighbours and then the label of that label, so chains shorten fast. Rounds are
    written to shared storage. A node with very many links is reduced before the shuffle.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("n")).select(
        "node", F.least("node", "n").alias("label")), "labels")
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("heard"))
        nearer = labels.join(heard, labels["node"] == heard["a"]).select("node", "label", F.least("label", "heard").alias("near"))
        jump = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        after = stored(nearer.join(jump, "near").select("node", F.col("label").alias("old"), "far"), "labels")
        changed = after.where(F.col("far") < F.col("old")).limit(1).count()
        labels = after.select("node", F.col("far").alias("label"))
        if not changed:
            return labels
