"""Merkle manifest of a dataset: built levels as parent-linked node rows, climbed by a recursive query.

Leaves are numbered per source by (key, digest) without a one-task sort, and every 16 consecutive nodes form
the next one, level by level; the sources' roots form a tree of their own in the same way. A node row holds its
children's digests and says which place it has below which parent. Proofs and checks come from one recursive SQL
query: a row per leaf moves to its parent, whose digest is folded anew from the row's own digest and the
children's other digests; these siblings are appended. Leaves of one run share all siblings above the run, so
the first of them carries those.

Every leaf below a node meets it on the climb, at the top all leaves of a source. Leaves are therefore numbered
in blocks of BLOCK, a node row stands once for every block below it, and rows meet it on (node, block): no key
has more than BLOCK rows, and node rows are few beside the leaves.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from musterline.operators.growth import number_rows
from musterline.operators.small_side import SMALL_ROWS, collect_if_small, null_safe_join
from musterline.session import written

#: Consecutive nodes that form one node of the next level.
FANOUT = 16
#: Consecutive leaves of a source that climb under one key; a power of FANOUT.
BLOCK = 4096
#: Levels of the tree over the sources are numbered from here on.
TOP = 100
_RECURSION_ROWS = "spark.sql.cteRecursionRowLimit"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value with its length in bytes in front, ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """SHA-256 of the fields of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def _text(digests: Column) -> Column:
    """Digests as one text of lower-case hex."""
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")


def numbered_leaves(leaves: DataFrame, group: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """``leaves`` with ``rank`` of the group (from 0, null first), ``n`` rows of the group, ``at`` within it
    (from 0, by ``order``) and ``number``, which is ``at`` from the group's own first block on."""
    rows = number_rows(leaves, [group, *order], "__row", partitions)
    groups = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), (F.min("__row") - 1).alias("__first"))
    groups = number_rows(groups, ["__first"], "rank", partitions).withColumn("rank", F.col("rank") - 1)
    small = collect_if_small(groups, SMALL_ROWS)
    rows = null_safe_join(rows, F.broadcast(small) if small is not None else groups, [group], "inner")
    rows = rows.withColumn("at", F.col("__row") - 1 - F.col("__first"))
    # Of rank r, blocks before the first: no fewer than all groups before it fill.
    block = F.floor(F.col("__first") / BLOCK) + F.col("rank")
    return rows.withColumn("number", (block * BLOCK + F.col("at")).cast("long")).drop("__row", "__first")


def _node_id(level: int, rank: Column, at: Column) -> Column:
    return F.concat_ws(":", F.lit(str(level)), rank.cast("string"), at.cast("long").cast("string"))


def _links(level: int, groups: int) -> tuple[Column, Column]:
    """(parent, place below it) of the nodes of a level; a group's root stands below the tree over the groups."""
    last = F.col("n") == 1
    above = _node_id(TOP + 1, F.lit(0), F.floor(F.col("rank") / FANOUT)) if level < TOP and groups > 1 else F.lit(None).cast("string")
    parent = F.when(last, above).otherwise(_node_id(level + 1, F.col("rank"), F.floor(F.col("at") / FANOUT)))
    return parent, (F.when(last, F.col("rank")).otherwise(F.col("at")) % FANOUT).cast("int")


def build_levels(base: DataFrame, groups: int, level: int = 0) -> tuple[list[DataFrame], DataFrame]:
    """(node rows level by level, roots) above ``base``: rank, n, at, digest, low, high.

    ``n`` counts the nodes of a rank on their level, ``low`` and ``high`` are the blocks below a node. A node row
    holds the digests of its children, in order.
    """
    columns = ["rank", "n", "at", "digest", "low", "high"]
    current, built, roots = base.select(*columns), [], []
    most = base.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(current.where("n = 1").select("rank", "digest", "low", "high"))
        if most <= 1:
            break
        most, level = -(-most // FANOUT), level + 1
        children = F.transform(F.sort_array(F.collect_list(F.struct("at", "digest"))), lambda c: c["digest"])
        formed = current.where("n > 1").groupBy("rank", "n", F.floor(F.col("at") / FANOUT).alias("up")).agg(
            children.alias("children"), F.min("low").alias("low"), F.max("high").alias("high")
        )
        formed = formed.select(
            "rank", F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), F.col("up").cast("long").alias("at"),
            F.unhex(F.sha2(_text(F.col("children")).cast("binary"), 256)).alias("digest"), "children", "low", "high",
        )
        current = written(formed)
        parent, place = _links(level, groups)
        node = _node_id(level, F.col("rank"), F.col("at"))
        built.append(current.select(node.alias("id"), "children", parent.alias("parent"), place.alias("place"), "low", "high"))
    return built, reduce(DataFrame.unionByName, roots)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the given columns, rank, at, number, digest, and the ``parent`` and ``place`` of each;
    ``nodes``: id, children, parent, place, block; ``subroots``: rank, digest; ``root``: hex, None without rows."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def build_manifest(leaves: DataFrame, group: str = "source", key: str = "doc_id", partitions: int | None = None) -> Manifest:
    """The stored tree over ``leaves``, which have a column ``digest`` (binary, 32 bytes).

    Leaves ascend by key within their group, null first; rows with equal keys by digest, so repeated rows are
    leaves of their own. Null is a group like others and comes first. A group of one leaf has it as its root.
    Further columns stay; names of the result's own columns may not occur.
    """
    spark = leaves.sparkSession
    placed = written(numbered_leaves(leaves, group, [key, "digest"], partitions))
    groups = (placed.agg(F.max("rank")).first()[0] or 0) + 1
    parent, place = _links(0, groups)
    block = F.floor(F.col("number") / BLOCK)
    low = placed.withColumns({"low": block, "high": block})
    built, roots = build_levels(low, groups)
    roots = written(roots)
    top = roots.select(F.lit(0).cast("long").alias("rank"), F.lit(groups).cast("long").alias("n"), F.col("rank").alias("at"), "digest", "low", "high")
    over, root = build_levels(top, groups, TOP)
    nodes = reduce(DataFrame.unionByName, [*built, *over]) if built or over else None
    if nodes is None:
        nodes = spark.createDataFrame([], "id string, children array<binary>, parent string, place int, block long")
    else:
        nodes = written(nodes.select("id", "children", "parent", "place", F.explode(F.sequence("low", "high")).alias("block")))
    found = root.select(F.lower(F.hex("digest"))).first()
    return Manifest(placed.withColumns({"parent": parent, "place": place}), nodes, roots.select("rank", "digest"), found[0] if found else None)


#: The climb. Of a run, the first leaf carries the run's digests and, above the run, the siblings.
CLIMB = """
WITH RECURSIVE climb (number, parent, place, step, folded, run, above) AS (
  SELECT number, parent, place, 0, {claimed}, cast(array() AS array<binary>), cast(array() AS array<binary>) FROM {leaves}
  UNION ALL
  SELECT c.number, n.parent, n.place, c.step + 1,
         unhex(sha2(cast(array_join(transform(n.children, (d, i) -> lower(hex(if(i = c.place, c.folded, d)))), '') AS binary), 256)),
         CASE WHEN c.step = 0 AND c.number % 16 = 0 THEN n.children ELSE c.run END,
         CASE WHEN c.step > 0 AND c.number % 16 = 0 THEN concat(c.above, filter(n.children, (d, i) -> i <> c.place)) ELSE c.above END
  FROM climb c JOIN {nodes} n ON n.id = c.parent AND n.block = c.number div 4096
)
SELECT number, folded, run, above FROM climb WHERE parent IS NULL
"""


def climb(manifest: Manifest, claimed: str = "claimed") -> DataFrame:
    """The leaves with ``folded`` (the root that the digest in ``claimed`` leads to) and ``siblings`` (all
    digests of the proof, level by level, in order), both binary."""
    spark = manifest.leaves.sparkSession
    before = spark.conf.get(_RECURSION_ROWS, None)
    spark.conf.set(_RECURSION_ROWS, "-1")  # all leaves climb, not the first million
    try:
        query = CLIMB.replace("{claimed}", f"`{claimed}`").replace("% 16", f"% {FANOUT}").replace("div 4096", f"div {BLOCK}")
        done = written(spark.sql(query, leaves=manifest.leaves, nodes=manifest.nodes))
    finally:
        spark.conf.unset(_RECURSION_ROWS) if before is None else spark.conf.set(_RECURSION_ROWS, before)
    run = F.floor(F.col("number") / FANOUT)
    heads = done.where(F.col("number") % FANOUT == 0).select(run.alias("__head"), "run", "above")
    rows = manifest.leaves.join(done.select("number", "folded"), "number").withColumn("__head", run).join(heads, "__head")
    siblings = F.concat(F.filter("run", lambda d, i: i != F.col("place")), F.col("above"))
    return rows.withColumn("siblings", siblings).drop("__head", "run", "above")


def verified_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of documents.

    Every row is a leaf, repeated rows and those with a null key too. Where 5 divides the checksum of the key,
    the climb starts from the row with A-Z of its text in lower case. Further columns take no part. An empty
    table has no root and no rows.
    """
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("text").isNotNull()
    leaves = docs.select(
        F.col("doc_id"), F.col("source"), digest(*rest, F.col("text")).alias("digest"),
        F.when(tampered, digest(*rest, F.translate("text", UPPER, LOWER))).alias("changed"),
    )
    manifest = build_manifest(written(leaves))
    leaves = manifest.leaves.withColumn("claimed", F.coalesce("changed", "digest"))
    rows = climb(replace(manifest, leaves=leaves))
    subroots = manifest.subroots.withColumnRenamed("digest", "__subroot")
    small = collect_if_small(subroots, SMALL_ROWS)
    rows = rows.join(F.broadcast(small) if small is not None else subroots, "rank")
    root = F.lit(manifest.root).cast("string")
    folded = F.lower(F.hex("folded"))
    return rows.select(
        "doc_id", F.lower(F.hex("digest")).alias("leaf"), F.lower(F.hex("__subroot")).alias("subroot"), root.alias("root"),
        F.sha2(_text(F.col("siblings")).cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"), (folded == root).alias("verified"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and check of every document; odd rows as in :func:`verified_documents`."""
    return verified_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The tree and the climb as recursive queries; the checksum bit by bit.
OP12_SQL = """
WITH RECURSIVE
crcs AS (
  SELECT *, list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END) AS crc
  FROM documents),
heads AS (
  SELECT doc_id, source, text, coalesce(xor(crc, CAST(4294967295 AS BIGINT)) % 5 = 0, false) AS tampered,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || CAST(doc_id AS VARCHAR), '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || CAST(n_chars AS VARCHAR), '-') AS head
  FROM crcs),
leaves AS (
  SELECT doc_id, source, tampered, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(octet_length(encode(text)) || ':'
           || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS changed
  FROM heads),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
levels(lvl, grp, place, n, digest) AS (
  SELECT CAST(0 AS BIGINT), grp, place, n, leaf FROM placed
  UNION ALL
  SELECT lvl + 1, grp, place // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM levels WHERE n > 1 GROUP BY lvl, grp, place // 16),
subroots AS (SELECT grp, digest, count(*) OVER () AS groups FROM levels WHERE n = 1),
tops(lvl, place, n, digest) AS (
  SELECT CAST(100 AS BIGINT), grp, groups, digest FROM subroots
  UNION ALL
  SELECT lvl + 1, place // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM tops WHERE n > 1 GROUP BY lvl, place // 16),
nodes AS (
  SELECT lvl, grp, place, n, digest FROM levels UNION ALL SELECT lvl, -1, place, n, digest FROM tops),
runs AS (
  SELECT lvl, grp, place // 16 AS up, list(digest ORDER BY place) AS kids FROM nodes WHERE n > 1 GROUP BY lvl, grp, place // 16),
sizes AS (SELECT DISTINCT lvl, grp, n FROM nodes),
starts AS (
  SELECT p.*, row_number() OVER () AS number, s.digest AS subroot, groups FROM placed p JOIN subroots s USING (grp)),
climb(number, own, groups, lvl, grp, place, n, folded, proof) AS (
  SELECT number, grp, groups, CAST(CASE WHEN n = 1 THEN 100 ELSE 0 END AS BIGINT), CASE WHEN n = 1 THEN -1 ELSE grp END,
         CASE WHEN n = 1 THEN grp ELSE place END, CASE WHEN n = 1 THEN groups ELSE n END,
         CASE WHEN tampered THEN changed ELSE leaf END, ''
  FROM starts
  UNION ALL
  SELECT c.number, c.own, c.groups,
         CASE WHEN z.n = 1 AND c.grp >= 0 THEN 100 ELSE c.lvl + 1 END,
         CASE WHEN z.n = 1 THEN -1 ELSE c.grp END,
         CASE WHEN z.n = 1 AND c.grp >= 0 THEN c.own ELSE c.place // 16 END,
         CASE WHEN z.n = 1 AND c.grp >= 0 THEN c.groups ELSE z.n END,
         sha256(array_to_string(list_concat(list_slice(r.kids, 1, c.place % 16), [c.folded], list_slice(r.kids, c.place % 16 + 2, 16)), '')),
         c.proof || array_to_string(list_concat(list_slice(r.kids, 1, c.place % 16), list_slice(r.kids, c.place % 16 + 2, 16)), '')
  FROM climb c JOIN runs r ON r.lvl = c.lvl AND r.grp = c.grp AND r.up = c.place // 16
       JOIN sizes z ON z.lvl = c.lvl + 1 AND z.grp = c.grp
  WHERE c.n > 1)
SELECT s.doc_id, s.leaf, s.subroot, t.digest AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = t.digest AS verified
FROM starts s JOIN climb c ON c.number = s.number AND c.n = 1 JOIN tops t ON t.n = 1
"""
