"""Merkle manifest of a table, checked by a recursive query.

Each row becomes a leaf digest.  The leaves of a group (a language) lie in id
order; while several nodes remain, every two consecutive ones become the digest
of their hex digests (a last single one is digested alone).  The group's last
node is its subroot; the subroots, in group order, form the top tree in the
same way.

``build`` stores the built levels as parent-linked node rows.  A node row holds
its digest, its parent and the siblings on the way to it.  A link spans
``STRIDE`` levels (1 stores every level on its own): the recursion then carries
each leaf's proof over few steps, so that what is shuffled stays below the size
of the texts.  Blocks of 2^STRIDE consecutive nodes are digested together, so
no group, however large, meets in one task.  A node row near the top is stored
in copies, one for about 2^STRIDE leaves below it (at most ``MAX_COPIES``),
and each leaf asks the copy of its own block: no join key is hot.  The node
table grows with the rows, so the steps join by sorted merge at every size.

``climb`` is one recursive query: it starts with all leaves, and each step joins
them to their node rows, appends the siblings to the proof and folds the claimed
digest with them.  A climbing row ends at the root.

Defined cases: a null column is written ``-``; null groups are a group of their
own, before the others; null ids come first; rows that repeat an id are ordered
by their digests; an empty table has no leaf and no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wiremap.llm.common import shuffle_partitions, stored

STRIDE = 9
MAX_COPIES = 1 << 16
#: Keys of the tree over the subroots and of the end; groups have '' or '=...'.
TOP, ROOT = "top", "root"
#: A proof holds 33 bytes a level: the side of the sibling (0 none, 1 left, 2 right) and its digest.
WIDTH = 33


def row_digest(columns: list[Column]) -> Column:
    """Lowercase hex SHA-256 over the columns, each ``-`` or UTF-8 byte count, ``:``, value."""
    parts = [F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c.cast("string")), F.lit(":"), c.cast("string")))
             for c in columns]
    return F.sha2(F.concat(*parts), 256)


def group_key(group: Column) -> Column:
    """A key that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def positions(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, the place within ``tree`` by ``order``, and ``n``, the size of the tree.

    One range sort over all rows, then prefix sums over the counts of each
    (tree, partition): a tree may lie in many partitions.
    """
    parts = shuffle_partitions(rows.sparkSession)
    # Rows equal in all of these are alike; the id only spreads them.
    rows = rows.withColumn("__tie", F.monotonically_increasing_id())
    keys = [tree, *order, "__tie"]
    ranged = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("__tie")
    ranged = stored(ranged.select("*", F.spark_partition_id().alias("__part"),
                                  F.monotonically_increasing_id().alias("__at")), name)
    counts = ranged.groupBy(tree, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    # At most one row per tree and partition.
    whole = Window.partitionBy(tree)
    sums = counts.select(tree, "__part", "__first", F.sum("__n").over(whole).alias("n"),
                         (F.sum("__n").over(whole.orderBy("__part")) - F.col("__n")).alias("__start"))
    return ranged.join(sums, [tree, "__part"]).withColumn(
        "idx", F.col("__at") - F.col("__first") + F.col("__start")).drop("__part", "__at", "__first", "__start")


def _depth(n: Column) -> Column:
    """Levels above n nodes."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _up(digests: Column) -> Column:
    """The level above an array of hex digests."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(digests) + 1) / 2).cast("int") - 1),
                       lambda i: F.sha2(F.concat(F.get(digests, 2 * i), F.coalesce(F.get(digests, 2 * i + 1), F.lit(""))),
                                        256))


def _entry(levels: Column, level: Column, place: Column) -> Column:
    """The proof entry of the node at ``place`` of a block's level."""
    at = F.call_function("shiftright", place, level)
    left = at.bitwiseAND(F.lit(1)) == 1
    side = F.get(F.get(levels, level), F.when(left, at - 1).otherwise(at + 1))
    return F.when(side.isNull(), F.unhex(F.lit("00" * WIDTH))).otherwise(
        F.unhex(F.concat(F.when(left, "01").otherwise("02"), side)))


def blocks_of(nodes: DataFrame, extra: list[str], stride: int, step: int, last: str, name: str) -> DataFrame:
    """One stored row per block of 2^stride consecutive nodes of a tree.

    ``nodes``: tree, idx, n, digest (hex), weight (leaves below) and ``extra``.
    ``last``: the tree that the block of a finished tree links to.
    """
    size = 1 << stride
    member = F.struct("idx", "digest", "weight", *extra)
    blocks = nodes.groupBy("tree", "n", F.floor(F.col("idx") / size).cast("long").alias("up")).agg(
        F.array_sort(F.collect_list(member), lambda a, b: F.when(a["idx"] < b["idx"], -1).otherwise(1)).alias("raw"))
    blocks = blocks.withColumn("k", F.least(F.lit(stride), _depth(F.col("n"))))
    first = F.array(F.transform("raw", lambda m: m["digest"]))
    levels = F.when(F.col("k") == 0, first).otherwise(F.aggregate(
        F.sequence(F.lit(1), F.col("k")), first, lambda got, _: F.concat(got, F.array(_up(F.element_at(got, -1))))))
    blocks = blocks.withColumn("levels", levels)

    def path(place: Column) -> Column:
        joined = F.aggregate(F.sequence(F.lit(0), F.col("k") - 1), F.lit(b""),
                             lambda got, lv: F.concat(got, _entry(F.col("levels"), lv, place)))
        return F.when(F.col("k") == 0, F.lit(b"")).otherwise(joined)

    members = F.transform("raw", lambda m, i: F.struct(
        m["idx"].alias("idx"), F.unhex(m["digest"]).alias("digest"), m["weight"].alias("weight"),
        path(i).alias("path"), *[m[c].alias(c) for c in extra]))
    weight = F.aggregate("raw", F.lit(0).cast("long"), lambda s, m: s + m["weight"])
    done = F.ceil(F.col("n") / F.pow(F.lit(2.0), F.col("k"))).cast("long")
    return stored(blocks.select(
        "tree", F.lit(step).alias("step"), "up", members.alias("members"),
        F.get(F.element_at("levels", -1), F.lit(0)).alias("top"), weight.alias("weight"), done.alias("left"),
        F.when(done > 1, F.col("tree")).otherwise(F.lit(last)).alias("parent")), name)


def _tree(leaves: DataFrame, extra: list[str], stride: int, last: str, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The block tables of all steps and the roots (tree, digest, weight) of all trees."""
    tables, roots, nodes = [], [], leaves
    while True:
        step = len(tables)
        blocks = blocks_of(nodes, extra, stride, step, last, f"{name}-{step}")
        tables.append(blocks)
        above = blocks.select("tree", F.col("up").alias("idx"), F.col("left").alias("n"), F.col("top").alias("digest"),
                              "weight")
        roots.append(above.filter("n = 1"))
        nodes, extra = above.filter("n > 1"), []
        if nodes.isEmpty():
            return tables, reduce(DataFrame.unionByName, roots).select("tree", "digest", "weight")


def _copies(weight: Column, stride: int) -> Column:
    """How many copies of a node row with ``weight`` leaves below: a power of two."""
    # log2 of the blocks of leaves below it, without rounding errors.
    bits = F.length(F.bin(F.floor((weight - 1) / (1 << stride)).cast("long")))
    some = F.when(weight > (1 << stride), F.call_function("shiftleft", F.lit(1).cast("long"), bits)).otherwise(F.lit(1).cast("long"))
    return F.least(F.lit(MAX_COPIES).cast("long"), some)


def build(leaves: DataFrame, stride: int = STRIDE) -> tuple[DataFrame, DataFrame]:
    """(leaf rows, upper node rows) of the manifest over (id, grp, leaf, claim).

    ``leaf`` and ``claim`` are hex digests; ``claim`` is what a climb folds.
    """
    leaves = stored(leaves.select("id", group_key(F.col("grp")).alias("tree"), F.unhex("leaf").alias("leaf"),
                                  F.unhex("claim").alias("claim")), "merkle-leaves")
    placed = positions(leaves, "tree", ["id", "leaf"], "merkle-order").withColumns(
        {"digest": F.lower(F.hex("leaf")), "weight": F.lit(1).cast("long")}).drop("leaf")
    low, subroots = _tree(placed, ["id", "claim"], stride, TOP, "merkle-group")
    tops = positions(subroots.withColumns({"grp": F.col("tree"), "tree": F.lit(TOP)}), "tree", ["grp"], "merkle-tops")
    high, _ = _tree(tops, ["grp"], stride, ROOT, "merkle-top")

    # The place of each group's subroot in the top tree.
    place = high[0].select(F.explode("members").alias("m")).select(
        F.col("m.grp").alias("grp"), F.col("m.idx").alias("place"), F.col("m.weight").alias("total"))

    def rows(table: DataFrame, extra: list[str]) -> DataFrame:
        out = table.select("tree", "step", "up", "top", "parent", F.col("weight").alias("parent_weight"),
                           F.explode("members").alias("m")).select(
            "tree", "step", "m.idx", "m.digest", "m.weight", "m.path", *[f"m.{c}" for c in extra],
            "parent", "up", "parent_weight", "top")
        out = out.join(place.withColumnRenamed("grp", "tree"), "tree", "left")
        to_top = (F.col("parent") == TOP) & (F.col("tree") != TOP)
        return out.select(
            "tree", "step", "idx", "digest", "weight", "path", *extra, "parent",
            F.when(F.col("parent") == F.col("tree"), F.col("step") + 1).otherwise(0).alias("parent_step"),
            F.when(to_top, F.col("place")).otherwise(F.col("up")).alias("parent_idx"),
            F.unhex("top").alias("parent_digest"),
            _copies(F.when(to_top, F.col("total")).otherwise(F.col("parent_weight")), stride).alias("parent_copies"))

    uppers = reduce(DataFrame.unionByName, [rows(t, []) for t in [*low[1:], *high]])
    uppers = uppers.withColumn("copy", F.explode(F.sequence(
        F.lit(0).cast("long"), _copies(F.col("weight"), stride) - 1)))
    return rows(low[0], ["id", "claim"]), stored(uppers, "merkle-nodes")


def _fold(digest: str, path: str) -> str:
    """SQL: the hex digest ``digest`` folded with all entries of ``path``."""
    side = f"substring({path}, {WIDTH} * l + 1, 1)"
    other = f"lower(hex(substring({path}, {WIDTH} * l + 2, {WIDTH - 1})))"
    return (f"CASE WHEN length({path}) = 0 THEN {digest} ELSE "
            f"aggregate(sequence(0, CAST(length({path}) / {WIDTH} AS INT) - 1), {digest}, (h, l) -> sha2(CASE {side} "
            f"WHEN X'01' THEN concat({other}, h) WHEN X'02' THEN concat(h, {other}) ELSE h END, 256)) END")


def climb(spark: SparkSession, leaf_rows: DataFrame, nodes: DataFrame, stride: int = STRIDE) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded) of every leaf, digests and proof as bytes."""
    # A leaf's place never changes its block, so every step asks the same copy.
    block = f"(idx div {1 << stride})"
    bits = f"coalesce(xxhash64(tree, {block}), 0)"
    fold0, fold1 = (f"unhex({_fold(f'lower(hex({d}))', p)})" for d, p in (("claim", "path"), ("c.folded", "n.path")))
    sql = f"""
        WITH RECURSIVE climb (id, leaf, spread, tree, step, idx, copies, subroot, root, proof, folded) AS (
            SELECT id, digest, {bits}, parent, parent_step, parent_idx, parent_copies,
                CAST(NULL AS BINARY), CAST(NULL AS BINARY), path, {fold0}
            FROM {{leaves}}
            UNION ALL
            SELECT /*+ MERGE(n) */ c.id, c.leaf, c.spread, n.parent, n.parent_step, n.parent_idx, n.parent_copies,
                CASE WHEN n.tree = '{TOP}' AND n.step = 0 THEN n.digest ELSE c.subroot END,
                CASE WHEN n.parent = '{ROOT}' THEN n.parent_digest ELSE c.root END,
                concat(c.proof, n.path), {fold1}
            FROM climb c JOIN {{nodes}} n
                ON c.tree = n.tree AND c.step = n.step AND c.idx = n.idx AND pmod(c.spread, c.copies) = n.copy
            WHERE c.tree <> '{ROOT}')
        SELECT id, leaf, subroot, root, proof, folded FROM climb WHERE tree = '{ROOT}'"""
    # Rows at the root climb no further, so the last step shuffles none.
    # Spark stops recursions at a number of rows unless told otherwise.
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        return stored(spark.sql(sql, leaves=leaf_rows, nodes=nodes), "merkle-climbed")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def verify(rows: DataFrame, id_col: str, group_col: str, columns: list[Column], claimed: list[Column],
           stride: int = STRIDE) -> DataFrame:
    """Manifest of ``rows`` over ``columns`` and, per row, the proof and the root folded from ``claimed``.

    Returns id, leaf, subroot, root, proof_sha256 (of the siblings, bottom up),
    folded_root (hex digests) and verified (folded_root equals root).
    """
    leaves = rows.select(F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("grp"),
                         row_digest(columns).alias("leaf"), row_digest(claimed).alias("claim"))
    out = climb(rows.sparkSession, *build(leaves, stride), stride)
    text = lambda c: F.lower(F.hex(c))
    entries = F.transform(F.sequence(F.lit(0), F.floor(F.length("proof") / WIDTH).cast("int") - 1),
                          lambda i: F.substring(F.col("proof"), i * WIDTH + 1, F.lit(WIDTH)))
    siblings = F.transform(F.filter(entries, lambda e: F.substring(e, 1, 1) != F.unhex(F.lit("00"))),
                           lambda e: text(F.substring(e, 2, WIDTH - 1)))
    siblings = F.when(F.length("proof") == 0, "").otherwise(F.array_join(siblings, ""))
    return out.select("id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
                      F.sha2(siblings, 256).alias("proof_sha256"), text("folded").alias("folded_root"),
                      (F.col("folded") == F.col("root")).alias("verified"))
