"""Shards by a hierarchical weighted hash tree.

A row walks down the tree region, rack, shard. At each level every child draws
``-ln(u) / weight`` with ``u`` from a hash of the row's key and the child's path; the
smallest draw wins, so a child gets rows in proportion to its weight. A draw depends
on nothing but key, path and weight: changing a weight, or adding a subtree, moves
rows into or out of that subtree only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, with_rank


@dataclass(frozen=True)
class Node:
    """A region, rack or shard. Leaves carry ``shard``; a branch weighs what its leaves weigh."""

    name: str
    shard: int | None = None
    leaf_weight: float = 1.0
    children: tuple[Node, ...] = field(default=())

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.leaf_weight


def balanced_tree(regions: int = 2, racks: int = 2, shards: int = 2) -> Node:
    """Equal weights; shards are numbered in order."""
    number = iter(range(regions * racks * shards))
    return Node("root", children=tuple(
        Node(f"region{r}", children=tuple(
            Node(f"rack{k}", children=tuple(Node(f"shard{s}", next(number)) for s in range(shards)))
            for k in range(racks)
        ))
        for r in range(regions)
    ))


def grow(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """One more shard, in a region and rack of its own: no other subtree's weight changes,

    so the only rows that move are those the new region wins."""
    leaf = Node("shard0", shard, weight)
    region = Node(f"region{len(tree.children)}", children=(Node("rack0", children=(leaf,)),))
    return Node(tree.name, children=(*tree.children, region))


def _draw(key: Column, path: str, weight: float) -> Column:
    """Exponential draw with rate ``weight``; 52 bits of md5, so SQL engines agree on it."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"|{path}"))), 1, 13)
    unit = (F.conv(digits, 16, 10).cast("bigint") + 1) / F.lit(float(2**52 + 1))
    return -F.log(unit) / F.lit(float(weight))


def shard_of(key: Column, tree: Node) -> Column:
    """The shard of a text key (null counts as the empty key).

    The expression grows with the number of nodes, a row evaluates one branch a level.
    """
    key = F.coalesce(key.cast("string"), F.lit(""))

    def descend(node: Node, path: str) -> Column:
        if not node.children:
            return F.lit(node.shard)
        live = [c for c in node.children if c.weight > 0]
        if len(live) == 1:
            return descend(live[0], f"{path}/{live[0].name}")
        draws = [F.struct(_draw(key, f"{path}/{c.name}", c.weight), F.lit(i)) for i, c in enumerate(live)]
        winner = F.least(*draws)["col2"]
        below = [descend(c, f"{path}/{c.name}") for c in live]
        return F.element_at(F.array(*below), winner + 1) if all(not c.children for c in live) else _switch(winner, below)

    return descend(tree, tree.name)


def _switch(index: Column, values: list[Column]) -> Column:
    # transform binds the winner once; a CASE on the bare expression would draw again per branch
    def pick(i: Column) -> Column:
        case = F.when(i == 0, values[0])
        for n, value in enumerate(values[1:-1], 1):
            case = case.when(i == n, value)
        return case.otherwise(values[-1])

    return F.element_at(F.transform(F.array(index), pick), 1)


def shard_rows(docs: DataFrame, tree: Node, id_col: str = "doc_id", text_col: str = "text", parts: int = 64) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` for each row; slots run gapless from 0 in a shard.

    ``size`` is the text's UTF-8 bytes plus 1. A null text has no bytes, a null id draws
    as the empty key. Repeated rows share a shard and get a slot each; other columns of
    ``docs`` are not read. Slots are given per bucket of a shard (see ``with_rank``), so a
    shard may hold any share of the rows.
    """
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
        shard_of(F.col(id_col), tree).cast("int").alias("shard"),
    )
    salt = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8), 16, 10)
    return with_rank(rows, ["shard"], [F.col("doc_id"), F.col("size"), F.col("text_crc32")], salt.cast("bigint"), "slot", parts)


def op9_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of a 2 x 2 x 2 tree, and where each goes with a ninth."""
    tree = balanced_tree()
    placed = shard_rows(load(spark, sf_dir, "documents"), tree)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        shard_of(F.col("doc_id"), grow(tree, 8)).cast("int").alias("grown_shard"),
    )


def _draw_sql(path: str, weight: float) -> str:
    return f"(-ln((('0x' || substr(md5(doc_id || '|{path}'), 1, 13))::BIGINT + 1) / 4503599627370497.0::DOUBLE) / {weight})"


def _walk_sql(node: Node, path: str) -> str:
    """A walk down the tree as nested comparisons of all draws."""
    if not node.children:
        return str(node.shard)
    below = [_walk_sql(c, f"{path}/{c.name}") for c in node.children]
    draws = [_draw_sql(f"{path}/{c.name}", c.weight) for c in node.children]
    cases = [f"WHEN {d} = least({', '.join(draws)}) THEN {b}" for d, b in zip(draws, below, strict=True)]
    return below[0] if len(below) == 1 else f"CASE {' '.join(cases)} END"


OP9_SQL = f"""
WITH steps AS (  -- the 256 steps of crc32, from its polynomial
  SELECT list(c ORDER BY i) AS s FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)
  )
),
bytes AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
  FROM documents
),
placed AS (
  SELECT doc_id, size,
    xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(c >> 8, s[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32,
    {_walk_sql(balanced_tree(), "root")} AS shard,
    {_walk_sql(grow(balanced_tree(), 8), "root")} AS grown_shard
  FROM bytes, steps
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (
    PARTITION BY shard ORDER BY ('0x' || substr(md5(doc_id || ''), 1, 8))::BIGINT % 64, doc_id, size, text_crc32
  ) - 1 AS slot,
  grown_shard::INTEGER AS grown_shard
FROM placed
"""
