"""A Merkle manifest of a dataset: one tree per group, one over the groups' roots, and a proof for each row.

A row's leaf digests its columns.  Leaves are numbered inside their group (a
range shuffle on group and id, then prefix sums over the tasks, so that a
large group is spread over many tasks), and every 16 consecutive nodes become
one until a group has one node left, its subroot.  Subroots make one more tree
in the same way.  Each level is a table of parents: the digests of the
children, and a link to the parent's own parent and its place there.

Proofs come from a recursive query over these tables.  It starts with runs of
leaves (the children of one parent, which share the path to the root), and
each step joins a run with its parent's row, folds the digest of every leaf
of the run with the parent's other children, appends these as siblings and
goes on to the parent's parent, up to the root.  A parent near the root has
very many runs below it, so a parent's row is repeated once for every
``CHUNK`` runs below, and no join key has more runs than that.

Everything is SQL functions; no Python runs on rows.

Cases: a null group makes a tree of its own, before all others; a null id
comes first in its group; rows of one id are ordered by their leaf; equal rows
are leaves of their own with the same outcome; null, empty and long texts are
digested whole; extra columns play no part; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import stored
from seriesloom.llm.heavy import lookup

#: Children of a node.
FAN = 16
#: Runs of leaves that meet one row of a parent.
CHUNK = 4096
#: Name of the tree over the groups' roots; the others' names have at least one character.
TOP = ""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    return F.translate(text, _UPPER, _LOWER)


def leaf(values: list[Column]) -> Column:
    """The digest of a row's values: each as its length in bytes, a colon and itself, or as a dash."""
    text = [v.cast("string") for v in values]
    parts = [F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in text]
    return F.sha2(F.concat(*parts), 256)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place in their tree (``pos``), the tree's number of rows (``size``) and their place among all rows (``place``), both from 0."""
    # ``dealt`` only lets the range shuffle part equal rows.
    dealt = rows.withColumn("dealt", F.spark_partition_id())
    keys = ["tree", *order, "dealt"]
    spread = dealt if rows.isEmpty() else stored(dealt).repartitionByRange(*keys)
    lined = stored(spread.sortWithinPartitions(*keys).drop("dealt").withColumn("line", F.monotonically_increasing_id()).withColumn("task", F.shiftright("line", 33)))
    # A row per task and tree; trees that several tasks share are few.
    counts = lined.groupBy("tree", "task").agg(F.count(F.lit(1)).alias("own"), F.min("line").alias("from"))
    per_tree, earlier = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    in_tree = counts.select("tree", "task", "from", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"), F.sum("own").over(per_tree).alias("size"))
    # One row per task.
    tasks = counts.groupBy("task").agg(F.sum("own").alias("own")).select("task", F.coalesce(F.sum("own").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    low = F.lit((1 << 33) - 1)
    met = lined.join(in_tree, ["tree", "task"]).join(F.broadcast(tasks), "task")
    return met.select(*rows.columns, (F.col("before") + F.col("line") - F.col("from")).alias("pos"), "size", (F.col("base") + F.col("line").bitwiseAND(low)).alias("place"))


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """The next level of the trees of over one node: nodes (tree, pos, size, digest, low, high) as parents with their children's digests."""
    run = F.array_sort(F.collect_list(F.struct("pos", "digest")))
    joined = nodes.filter("size > 1").groupBy("tree", F.expr(f"pos DIV {FAN}").alias("pos"), "size").agg(run.alias("run"), F.min("low").alias("low"), F.max("high").alias("high"))
    hexes = F.array_join(F.transform("run", lambda x: x["digest"]), "")
    return joined.select(
        "tree", F.lit(level).alias("level"), "pos", F.ceil(F.col("size") / FAN).alias("size"), F.sha2(hexes, 256).alias("digest"),
        F.unhex(hexes).alias("children"), "low", "high",
    )


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """All levels of parents over ``nodes``, each a stored table; the last one of every tree is its root."""
    out: list[DataFrame] = []
    while True:
        nodes = stored(_parents(nodes, len(out) + 1))
        if nodes.isEmpty():
            return out
        out.append(nodes)


def _union(tables: list[DataFrame]) -> DataFrame:
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    return whole


def _next(tree: Column, level: Column, pos: Column, size: Column, top: Column, top_size: Column) -> list[Column]:
    """The key of the parent of a node, and the node's place under it: in its own tree, for a subroot in the top tree, for the root none."""
    inside, over = size > 1, (tree != TOP) & (top_size > 1)
    at = F.when(inside, pos).when(over, top)
    return [
        F.when(inside, tree).when(over, F.lit(TOP)).alias("up_tree"),
        F.when(inside, level + 1).when(over, F.lit(1)).alias("up_level"),
        F.floor(at / FAN).alias("up_pos"),
        F.pmod(at, F.lit(FAN)).cast("int").alias("up_slot"),
    ]


_CLIMB = """
WITH RECURSIVE climb (first, folded, siblings, chunk, up_tree, up_level, up_pos, up_slot) AS (
    SELECT first, folded, CAST('' AS BINARY), chunk, up_tree, up_level, up_pos, up_slot FROM {runs}
    UNION ALL
    SELECT c.first,
           transform(c.folded, x -> unhex(sha2(lower(hex(concat(substring(n.children, 1, 32 * c.up_slot), x, substring(n.children, 32 * c.up_slot + 33)))), 256))),
           concat(c.siblings, substring(n.children, 1, 32 * c.up_slot), substring(n.children, 32 * c.up_slot + 33)),
           c.chunk, n.up_tree, n.up_level, n.up_pos, n.up_slot
    FROM climb c JOIN {parents} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos AND c.chunk = n.chunk
)
SELECT first, folded, siblings FROM climb WHERE up_level IS NULL
"""


def _climbed(runs: DataFrame, parents: DataFrame) -> DataFrame:
    """(first, folded, siblings): what the path to the root makes of the leaves of each run."""
    spark, limit = runs.sparkSession, "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    # The rows of a step are as many as the runs; Spark's limit is meant for queries that don't end.
    spark.conf.set(limit, "-1")
    try:
        return stored(spark.sql(_CLIMB, runs=runs, parents=parents))
    finally:
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)


def proofs(docs: DataFrame, *, columns: list[str], id_col: str = "doc_id", group_col: str = "source", tampered: Column | None = None) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root, verified) of every row.

    ``columns`` are those that a leaf digests.  ``proof`` holds the siblings'
    digests, 32 bytes each, from the leaf's run to the root.  ``folded_root``
    is what they make of the row's leaf as ``tampered`` has it (by default of
    the leaf itself); ``verified``: that is the root.
    """
    group = F.col(group_col).cast("string")
    tree = F.when(group.isNull(), "-").otherwise(F.concat(F.lit("="), group))
    own = leaf([F.col(c) for c in columns])
    rows = docs.select(tree.alias("tree"), F.col(id_col).alias("id"), own.alias("digest"), (own if tampered is None else tampered).alias("given"))
    leaves = stored(_numbered(rows, ["id", "digest"]))
    run_pos, chunk = F.floor(F.col("pos") / FAN), F.floor((F.col("place") - F.col("pos") % FAN) / (FAN * CHUNK))
    nodes = leaves.select("tree", "pos", "size", "digest", chunk.alias("low"), chunk.alias("high"))
    built = _levels(nodes)
    last = [t.filter("size = 1").select("tree", "digest", "low", "high") for t in (nodes, *built)]
    subroots = stored(_numbered(_union(last).select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest", "low", "high"), ["of"]))
    above = _levels(subroots.select("tree", "pos", "size", "digest", "low", "high"))
    found = (above[-1] if above else subroots).select("digest").first()
    root = found["digest"] if found else ""
    ends = subroots.select(F.col("of").alias("tree"), F.col("pos").alias("top"), F.col("size").alias("top_size"), F.col("digest").alias("subroot"))
    c = F.col
    parents = _union([*built, *above] or [_parents(nodes.limit(0), 1)])
    inner = parents.filter((c("size") > 1) | (c("tree") == TOP)).withColumns({"top": F.lit(None).cast("long"), "top_size": F.lit(None).cast("long")})
    linked = inner.unionByName(parents.filter((c("size") == 1) & (c("tree") != TOP)).join(ends.drop("subroot"), "tree"))
    linked = linked.select("tree", "level", "pos", "children", F.explode(F.sequence("low", "high")).alias("chunk"), *_next(c("tree"), c("level"), c("pos"), c("size"), c("top"), c("top_size")))

    members = F.array_sort(F.collect_list(F.struct(c("pos").alias("at"), "id", "digest", "given")))
    runs = leaves.groupBy("tree", run_pos.alias("pos"), "size", chunk.alias("chunk")).agg(members.alias("run"), F.min("place").alias("first"))
    uses = leaves.groupBy("tree").agg(F.ceil(F.max("size") / FAN).alias("uses"))
    runs = stored(lookup(runs, ends.join(uses, "tree"), ["tree"], "uses").drop("uses"))
    hexes = F.array_join(F.transform("run", lambda x: x["digest"]), "")
    alone = c("size") == 1

    def folded(x: Column, k: Column) -> Column:
        changed = F.concat(F.substring(c("hexes"), F.lit(1), 64 * k), x["given"], F.substring(c("hexes"), 64 * k + 65, F.lit(64 * FAN)))
        return F.unhex(F.when(alone, x["given"]).otherwise(F.sha2(changed, 256)))

    above_run = _next(c("tree"), F.when(alone, 0).otherwise(1), c("pos"), F.ceil(c("size") / FAN), c("top"), c("top_size"))
    starts = runs.withColumn("hexes", hexes).select("first", F.transform("run", folded).alias("folded"), "chunk", *above_run)
    climbed = _climbed(starts, stored(linked))
    each = runs.withColumn("hexes", hexes).join(climbed, "first").select("subroot", "hexes", "folded", "siblings", F.posexplode("run").alias("k", "own"))
    beside = F.concat(F.substring(c("hexes"), F.lit(1), 64 * c("k")), F.substring(c("hexes"), 64 * c("k") + 65, F.lit(64 * FAN)))
    final = F.lower(F.hex(F.element_at("folded", c("k") + 1)))
    proof = F.concat(F.unhex(beside), c("siblings"))
    return each.select(c("own.id").alias(id_col), c("own.digest").alias("leaf"), "subroot", F.lit(root).alias("root"), proof.alias("proof"), final.alias("folded_root"), (final == root).alias("verified"))


def proof_digest(proof: Column) -> Column:
    """The digest of a proof's digests as hexadecimal text."""
    return F.sha2(F.lower(F.hex(proof)), 256)
