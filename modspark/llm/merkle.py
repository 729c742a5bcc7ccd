"""A Merkle manifest of a dataset: one hash tree per partition value, one over their roots.

Levels are built bottom up by grouping consecutive nodes and stored as rows that name their
parent. A recursive query then climbs from every leaf to the root: it joins the run that the
node belongs to, puts the node's own digest into its place, folds the run into the parent's
digest and hands on the siblings. A leaf whose content has changed folds to another root.

Leaves are numbered without a window over a whole partition value: rows are sorted by range,
numbered inside their range, and a table of one row per range and value holds the offsets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modspark.llm.store import saved

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Manifest:
    """A tree per value of ``by``; its leaves are rows, ascending by ``order``, hashed over ``fields``."""

    by: str = "lang"
    order: str = "doc_id"
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text")
    fan_out: int = 8


def field(column: str) -> Column:
    """``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    value = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def row_hash(fields: tuple[str, ...]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)), 256))


def digest(members: Column) -> Column:
    """The digest of a list of digests, whose text is their hexadecimal form."""
    return F.unhex(F.sha2(F.concat_ws("", F.transform(members, lambda d: F.lower(F.hex(d)))), 256))


def hexed(column: str) -> Column:
    return F.lower(F.hex(F.col(column)))


def leaves(rows: DataFrame, settings: Manifest, present: Column) -> DataFrame:
    """The columns of ``by`` and ``order``, ``leaf``, ``present``, and the leaf's place.

    ``leaf`` is the digest of the row, ``present`` the one to be checked. ``no`` is unique,
    ``tree`` numbers the values of ``by`` from 1 (null first, then bytewise), ``pos`` the
    rows of a tree from 0: by ``order``, null first, then by digest, so rows that
    repeat have a defined place. Only digests are sorted, no texts.
    """
    own = [c for c in (settings.order, settings.by) if c]
    spark = rows.sparkSession
    hashed = saved(rows.select(*own, row_hash(settings.fields).alias("leaf"), present.alias("present")))
    keys = [F.col(settings.by).asc_nulls_first(), F.col(settings.order).asc_nulls_first(), F.col("leaf")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = hashed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    numbered = saved(dealt.withColumn("no", F.monotonically_increasing_id()).withColumn("part", F.shiftright("no", 33)))
    # one row per range of the sort and value in it: their counts give the offsets
    spans = numbered.groupBy(settings.by, "part").agg(F.count("*").alias("n"), F.min("no").alias("first"))
    before = F.coalesce(
        F.sum("n").over(Window.partitionBy(settings.by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    # the list of values is ordered in one task: one row per tree, not per leaf
    values = spans.groupBy(settings.by).agg(F.sum("n").alias("leaves"))
    tree = F.row_number().over(Window.orderBy(F.col(settings.by).asc_nulls_first()))
    values = values.select(F.col(settings.by).alias("__by"), tree.alias("tree"), "leaves")
    offsets = (
        spans.select(settings.by, F.col("part").alias("__part"), (before - F.col("first")).alias("shift"))
        .join(values, F.col(settings.by).eqNullSafe(F.col("__by")))
        .select("__by", "__part", "shift", "tree", "leaves")
    )
    same = (F.col("part") == F.col("__part")) & F.col(settings.by).eqNullSafe(F.col("__by"))
    placed = numbered.join(offsets, same)
    return saved(placed.select(*own, "leaf", "present", "no", "tree", (F.col("no") + F.col("shift")).alias("pos"), "leaves"))


def runs(nodes: DataFrame, fan_out: int) -> DataFrame:
    """tree, run, members, digest, nodes: every ``fan_out`` consecutive nodes of a tree, in order.

    ``nodes`` is the number of nodes of the tree, in this level and in the next one.
    """
    run = F.expr(f"pos div {fan_out}").alias("run")
    members = F.array_sort(F.collect_list(F.struct("pos", "digest")))["digest"]
    grouped = nodes.groupBy("tree", "nodes", run).agg(members.alias("members"))
    left = F.expr(f"(nodes + {fan_out - 1}) div {fan_out}").alias("nodes")
    return grouped.select("tree", "run", "members", digest(F.col("members")).alias("digest"), left)


def built(nodes: DataFrame, settings: Manifest) -> tuple[list[DataFrame], DataFrame]:
    """(levels, tops): all runs of trees given as (tree, pos, digest, nodes), and their last nodes.

    A level's rows are (tree, level, run, members, digest, nodes), with the number of nodes in the
    tree's next level; a tree with one node left stops. Each level is an eighth of the one
    below, and the number of levels is a logarithm of the leaves.
    """
    levels, tops, level = [], nodes.filter("nodes = 1").select("tree", F.lit(0).alias("level"), "digest"), 0
    open_nodes = nodes.filter("nodes > 1")
    while not open_nodes.isEmpty():
        made = saved(runs(open_nodes, settings.fan_out).withColumn("level", F.lit(level)))
        levels.append(made)
        level += 1
        tops = tops.unionByName(made.filter("nodes = 1").select("tree", F.lit(level).alias("level"), "digest"))
        open_nodes = made.filter("nodes > 1").select("tree", F.col("run").alias("pos"), "digest", "nodes")
    return levels, tops


ROOT_TREE = 0
"""The number of the tree whose leaves are the last nodes of the others."""

CLIMB = """
WITH RECURSIVE climb(no, step, tree, level, pos, digest, siblings) AS (
  SELECT no, 0, tree, level, pos, present, CAST(array() AS array<binary>) FROM {leaves}
  UNION ALL
  SELECT c.no, c.step + 1, r.up_tree, r.up_level, r.up_pos,
         unhex(sha2(concat_ws('', transform(r.members, (d, i) -> lower(hex(IF(i = c.pos % {fan_out}, c.digest, d))))), 256)),
         filter(r.members, (d, i) -> i <> c.pos % {fan_out})
  FROM climb c JOIN {runs} r ON c.tree = r.tree AND c.level = r.level AND c.pos div {fan_out} = r.run
)
SELECT no, step, digest, siblings FROM climb
"""


@dataclass
class Tree:
    """What is stored of a manifest.

    ``leaves`` as from the function, with ``level`` and ``subroot``; ``nodes``: every run of nodes with its
    members and its parent (up_tree, up_level, up_pos), whose digest is ``digest``; ``root``.
    """

    leaves: DataFrame
    nodes: DataFrame
    root: bytes | None


def manifest(rows: DataFrame, settings: Manifest = Manifest(), present: Column | None = None) -> Tree:
    """Build and store all levels. No rows: no nodes, and the root is null."""
    row = row_hash(settings.fields)
    placed = leaves(rows, settings, row if present is None else present)
    nodes = placed.select("tree", "pos", F.col("leaf").alias("digest"), F.col("leaves").alias("nodes"))
    levels, tops = built(nodes, settings)
    tops = saved(tops)
    trees = tops.count()
    ends = tops.select(F.lit(ROOT_TREE).alias("tree"), (F.col("tree") - 1).cast("long").alias("pos"), "digest", F.lit(trees).cast("long").alias("nodes"))
    upper, top = built(ends, settings)
    found = top.first()
    # a tree's last node is a leaf of the root tree: its row there is its parent link
    last = F.col("nodes") == 1
    linked = [
        level.select(
            "tree", "level", "run", "members", "digest",
            F.when(last, F.lit(ROOT_TREE)).otherwise(F.col("tree")).alias("up_tree"),
            F.when(last, F.lit(0)).otherwise(F.col("level") + 1).alias("up_level"),
            F.when(last, F.col("tree") - 1).otherwise(F.col("run")).cast("long").alias("up_pos"),
        )
        for level in levels
    ] + [
        level.select(
            "tree", "level", "run", "members", "digest",
            F.col("tree").alias("up_tree"), (F.col("level") + 1).alias("up_level"), F.col("run").alias("up_pos"),
        )
        for level in upper
    ]
    empty = "tree int, level int, run long, members array<binary>, digest binary, up_tree int, up_level int, up_pos long"
    everything = rows.sparkSession.createDataFrame([], empty)
    for level in linked:
        everything = everything.unionByName(level)
    alone = F.col("leaves") == 1
    known = placed.join(tops.select("tree", F.col("digest").alias("subroot")), "tree").select(
        "no", settings.order, settings.by, "leaf", "present", "subroot",
        F.when(alone, F.lit(ROOT_TREE)).otherwise(F.col("tree")).alias("tree"),
        F.lit(0).alias("level"),
        F.when(alone, F.col("tree") - 1).otherwise(F.col("pos")).cast("long").alias("pos"),
    )
    return Tree(saved(known), saved(everything), bytes(found["digest"]) if found else None)


ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def climbed(tree: Tree, settings: Manifest = Manifest()) -> DataFrame:
    """no, step, digest, siblings: every step of every leaf's way from its ``present`` digest to the root.

    Step 0 is the leaf; ``siblings`` are the other members of the run that a step folds,
    left to right. Spark's limit on rows of a recursive query is lifted while it runs.
    """
    spark = tree.leaves.sparkSession
    tree.leaves.createOrReplaceTempView("merkle_leaves")
    tree.nodes.createOrReplaceTempView("merkle_nodes")
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return saved(spark.sql(CLIMB.format(leaves="merkle_leaves", runs="merkle_nodes", fan_out=settings.fan_out)))
    finally:
        spark.conf.set(ROW_LIMIT, limit)
        for view in ("merkle_leaves", "merkle_nodes"):
            spark.catalog.dropTempView(view)


def proofs(tree: Tree, settings: Manifest = Manifest()) -> DataFrame:
    """A row per leaf: the columns of ``order`` and ``by``, leaf, subroot, root, siblings, folded_root, verified.

    Digests are binary. ``siblings`` is the proof, level by level from the leaf to the root.
    """
    steps = climbed(tree, settings)
    ways = steps.groupBy("no").agg(
        F.max_by("digest", "step").alias("folded_root"),
        F.flatten(F.array_sort(F.collect_list(F.struct("step", "siblings")))["siblings"]).alias("siblings"),
    )
    root = F.lit(tree.root).cast("binary")
    return tree.leaves.join(ways, "no").select(
        settings.order, settings.by, "leaf", "subroot", root.alias("root"), "siblings", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def tampered(settings: Manifest) -> Column:
    """The digest of a row after tampering: where 3 divides the crc32 of doc_id, A-Z of the text is lower-cased."""
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    parts = [F.when(hit, _lowered()).otherwise(field("text")) if c == "text" else field(c) for c in settings.fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _lowered() -> Column:
    value = F.translate("text", LETTERS, LETTERS.lower())
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def tamper_check(docs: DataFrame, settings: Manifest = Manifest()) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of docs.

    The tree is built over the rows as they are; every row is then checked as the tampering
    left it, against the stored siblings. Nulls hash as ``-``; a null lang is a tree of its
    own, the first; a null doc_id (crc32 of an empty text) comes first in its tree. Rows that repeat are leaves
    side by side. A tampered text without A-Z is the same text and verifies. Other
    columns of docs are ignored; an empty table gives an empty result.
    """
    found = proofs(manifest(docs, settings, tampered(settings)), settings)
    proof = F.sha2(F.concat_ws("", F.transform("siblings", lambda d: F.lower(F.hex(d)))), 256)
    return found.select(
        "doc_id", hexed("leaf").alias("leaf"), hexed("subroot").alias("subroot"), hexed("root").alias("root"),
        proof.alias("proof_sha256"), hexed("folded_root").alias("folded_root"), "verified",
    )


SQL = r"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS present
  FROM (
    SELECT doc_id, lang, text,
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
      -- crc32: every byte goes in and is followed by eight shifts (marked by 256)
      xor(list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''),
          lambda c: CASE WHEN c = '' THEN []::BIGINT[] ELSE [ascii(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256] END))),
        lambda crc, x: CASE WHEN x < 256 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END
      ), 4294967295) AS crc
    FROM documents
  )
), leaves AS (
  SELECT *, row_number() OVER () AS no, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM hashed
), levels AS (
  SELECT tree, 0 AS level, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM levels WHERE n > 1 GROUP BY tree, level, pos // 8
), tops AS (
  SELECT tree, level, digest FROM levels WHERE n = 1
), upper AS (
  SELECT 0 AS tree, 0 AS level, tree - 1 AS pos, digest, (SELECT count(*) FROM tops) AS n FROM tops
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM upper WHERE n > 1 GROUP BY tree, level, pos // 8
), runs AS (
  SELECT tree, level, pos // 8 AS run, list(digest ORDER BY pos) AS members, any_value(n) AS n
  FROM (FROM levels UNION ALL FROM upper) WHERE n > 1 GROUP BY tree, level, pos // 8
), climb AS (
  SELECT no, 0 AS step, CASE WHEN n = 1 THEN 0 ELSE tree END AS tree, 0 AS level, CASE WHEN n = 1 THEN tree - 1 ELSE pos END AS pos,
    present AS folded, '' AS siblings
  FROM leaves
  UNION ALL
  SELECT c.no, c.step + 1, CASE WHEN r.n <= 8 THEN 0 ELSE c.tree END, CASE WHEN r.n <= 8 AND c.tree > 0 THEN 0 ELSE c.level + 1 END,
    CASE WHEN r.n <= 8 AND c.tree > 0 THEN c.tree - 1 ELSE r.run END,
    sha256(array_to_string(r.members[:c.pos % 8], '') || c.folded || array_to_string(r.members[c.pos % 8 + 2:], '')),
    c.siblings || array_to_string(r.members[:c.pos % 8], '') || array_to_string(r.members[c.pos % 8 + 2:], '')
  FROM climb c JOIN runs r ON c.tree = r.tree AND c.level = r.level AND c.pos // 8 = r.run
), ends AS (
  SELECT no, arg_max(folded, step) AS folded, arg_max(siblings, step) AS siblings FROM climb GROUP BY no
)
SELECT l.doc_id, l.leaf, t.digest AS subroot, u.digest AS root, sha256(e.siblings) AS proof_sha256, e.folded AS folded_root,
  e.folded = u.digest AS verified
FROM leaves l JOIN ends e USING (no) JOIN tops t USING (tree), (SELECT digest FROM upper WHERE n = 1) u
"""
