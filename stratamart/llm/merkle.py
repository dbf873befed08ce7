"""A Merkle manifest of a dataset with checkpointed levels and recomputed proofs.

Every row is a leaf: the digest of its fields, each led by its length. Leaves of
a source stand in order of doc_id and every three consecutive nodes become their
digest until one node, the subroot, is left; subroots in order of source likewise
give the root. Only every ``KEPT``-th level is written (``levels``): an aligned
subtree of 3 ** KEPT nodes is one row of a group, so no task holds more of a
source than that. A proof needs the levels in between: they are computed again
from the stored nodes of the subtree, the siblings are emitted, the rest is
dropped. Proofs are made from the top down, each kept level joining the paths of
the one above by subtree, so a path is never searched for.

A path is two byte strings: ``route`` holds one byte per level, place in the run
times 4 plus length of the run, and ``siblings`` the digests of the run's others.

Defined results: a null field is ``-``, an empty one ``0:``; rows without doc_id
come first in their source, rows of one doc_id in order of their digests, equal
rows are leaves of their own; a null source is a source, the first one; one leaf
is its own subroot, and one subroot the root; an empty table has no root and
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import crc_of_id, numbered, stored, table

RUN = 3
#: Levels between two that are kept: an aligned subtree holds 729 nodes.
KEPT = 6
SUBTREE = RUN**KEPT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "tree string, pos long, route binary, siblings binary, subroot binary"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    """Digest (32 bytes) of a row's fields in the order of ``FIELDS``."""
    return F.unhex(F.sha2(F.concat(*[field(fields[name]) for name in FIELDS]), 256))


def node(run: bytes) -> bytes:
    """Digest of a run of digests, hashed as hexadecimal text."""
    return hashlib.sha256(run.hex().encode()).digest()


def interior(nodes: list[bytes], total: int) -> list[list[bytes]]:
    """The levels of one aligned subtree, from its stored nodes to its top.

    ``total`` is the number of nodes of the whole tree on the stored level: the
    top of a larger tree's subtree lies ``KEPT`` levels higher, whatever it holds.
    """
    levels = [nodes]
    while len(levels) <= KEPT if total > SUBTREE else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([node(b"".join(below[i : i + RUN])) for i in range(0, len(below), RUN)])
    return levels


def path_within(levels: list[list[bytes]], at: int) -> tuple[bytes, bytes]:
    """Route and siblings of the stored node ``at`` up to the top of its subtree."""
    route, siblings = bytearray(), []
    for level in levels[:-1]:
        first, place = at - at % RUN, at % RUN
        run = level[first : first + RUN]
        route.append(place * 4 + len(run))
        siblings += run[:place] + run[place + 1 :]
        at //= RUN
    return bytes(route), b"".join(siblings)


def fold(digest: bytes, route: bytes, siblings: bytes) -> bytes:
    """The root that a digest and a path give."""
    width, at = len(digest), 0
    for step in route:
        place, size = divmod(step, 4)
        run = siblings[at : at + width * (size - 1)]
        digest = node(run[: width * place] + digest + run[width * place :])
        at += width * (size - 1)
    return digest


def subtrees(nodes: DataFrame) -> DataFrame:
    """One row per aligned subtree of trees that are not done: tree, n, subtree,
    and its nodes in order."""
    members = F.struct("pos", *[c for c in nodes.columns if c not in ("tree", "n", "pos")])
    return (
        nodes.filter("n > 1")
        .groupBy("tree", "n", F.floor(F.col("pos") / SUBTREE).alias("subtree"))
        .agg(F.sort_array(F.collect_list(members)).alias("members"))
    )


def levels(nodes: DataFrame) -> list[DataFrame]:
    """The kept levels of all trees, from (tree, n, pos, digest, ...) upwards; the
    last node of a tree stands on the first kept level that holds no other."""

    def tops(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            top = [interior([bytes(d) for d in ds], n)[-1][0] for ds, n in zip(batch.digests, batch.n)]
            size = [-(-n // SUBTREE) for n in batch.n]
            yield pd.DataFrame({"tree": batch.tree, "n": size, "pos": batch.subtree, "digest": top})

    kept = [stored(nodes)]
    largest = kept[0].agg(F.max("n")).first()[0] or 0
    while largest > 1:
        slim = subtrees(kept[-1].select("tree", "n", "pos", "digest"))
        rows = slim.select("tree", "n", "subtree", F.col("members.digest").alias("digests"))
        kept.append(stored(rows.mapInPandas(tops, "tree string, n long, pos long, digest binary")))
        largest = -(-largest // SUBTREE)
    return kept


def roots(kept: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree's last node."""
    done = [level.filter("n = 1").select("tree", "digest") for level in kept]
    out = done[0]
    for level in done[1:]:
        out = out.unionByName(level)
    return out


def paths(kept: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths of all nodes of the lowest level: its own columns, route, siblings, subroot.

    ``above`` (tree, route, siblings, subroot) continues the path from each tree's root.
    """
    upper = None
    for at in range(len(kept) - 1, -1, -1):
        level = kept[at]
        others = [c for c in level.columns if c not in ("tree", "n", "pos")]
        last = level.filter("n = 1").join(above, "tree")
        found = last.select("tree", "pos", *others, "route", "siblings", "subroot")
        if upper is not None:
            shape = ", ".join(f"{c} {level.schema[c].dataType.simpleString()}" for c in others)

            def regenerate(batches: Iterator[pd.DataFrame], others: list[str] = others) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    for row in batch.itertuples(index=False):
                        inner = interior([bytes(m["digest"]) for m in row.members], row.n)
                        found = [path_within(inner, i) for i in range(len(row.members))]
                        out = {c: [m[c] for m in row.members] for c in ("pos", *others)}
                        out["tree"] = [row.tree] * len(found)
                        out["route"] = [r + row.route for r, _ in found]
                        out["siblings"] = [s + row.siblings for _, s in found]
                        out["subroot"] = [row.subroot] * len(found)
                        yield pd.DataFrame(out, dtype=object)

            over = upper.select("tree", F.col("pos").alias("subtree"), "route", "siblings", "subroot")
            blocks = subtrees(level).join(over, ["tree", "subtree"])
            made = blocks.mapInPandas(regenerate, f"{PATH}, {shape}")
            found = found.unionByName(made)
        upper = stored(found) if at else found
    return upper


class Manifest:
    """Kept levels of the trees of all sources and of the tree of their subroots."""

    def __init__(self, leaves: DataFrame) -> None:
        """``leaves``: tree (source), doc_id, digest and columns to carry; written once."""
        rows = stored(leaves.withColumn("rid", F.monotonically_increasing_id()))
        placed = numbered(rows, ["tree"], ["doc_id", "digest", "rid"], "pos", "n").drop("rid")
        # Ids travel as text: in tasks, numbers with a null among them become floats.
        self.kept = levels(placed.withColumn("doc_id", F.col("doc_id").cast("string")))
        subroots = roots(self.kept).select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
        self.sources = levels(numbered(stored(subroots), ["tree"], ["source"], "pos", "n"))
        root = roots(self.sources).first()
        self.root: bytes | None = None if root is None else bytes(root.digest)

    def proofs(self) -> DataFrame:
        """The leaves (doc_id as text) with route and siblings up to the root, and their subroot."""
        none = F.lit(b"")
        end = roots(self.sources).select("tree", none.alias("route"), none.alias("siblings"), none.alias("subroot"))
        over = paths(self.sources, end).select(
            F.col("source").alias("tree"), "route", "siblings", F.col("digest").alias("subroot")
        )
        return paths(self.kept, stored(over))


def tree_key(source: Column) -> Column:
    """A null source as the first key; others keep their bytewise order."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    own = {name: F.col(name) for name in FIELDS}
    cut = own | {"text": F.translate(F.col("text"), "\n", "")}
    touched = (crc_of_id() % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    leaves = docs.select(
        tree_key(F.col("source")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(own).alias("digest"),
        F.when(touched, leaf(cut)).alias("tampered"),
    )
    manifest = Manifest(leaves)
    shape = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return spark.createDataFrame([], shape)
    root = manifest.root

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            digests = [bytes(d) for d in batch.digest]
            given = [d if t is None else bytes(t) for d, t in zip(digests, batch.tampered)]
            folded = [fold(d, bytes(r), bytes(s)) for d, r, s in zip(given, batch.route, batch.siblings)]
            yield pd.DataFrame(
                {
                    "doc_id": batch.doc_id,
                    "leaf": [d.hex() for d in digests],
                    "subroot": [bytes(d).hex() for d in batch.subroot],
                    "root": root.hex(),
                    "proof_sha256": [node(bytes(s)).hex() for s in batch.siblings],
                    "folded_root": [d.hex() for d in folded],
                    "verified": [d == root for d in folded],
                }
            )

    verified = manifest.proofs().mapInPandas(verify, shape.replace("doc_id long", "doc_id string"))
    return verified.withColumn("doc_id", F.col("doc_id").cast("long"))


#: CRC-32 runs over the halves of each byte of the decimal id, as in sharding.
OP13_SQL = r"""
with recursive half as (
  select list(v order by i) as steps from (
    select i, list_reduce([i::bigint, 0, 0, 0, 0],
           lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end) as v
    from range(16) t(i))),
rows as (
  select row_number() over () as rid, doc_id, coalesce('=' || source, '') as k,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
         text, replace(text, chr(10), '') as flat,
         xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
           list_transform(string_split(regexp_replace(hex(encode(doc_id::varchar)), '(.)(.)', '\2\1', 'g'), ''),
                          lambda d: (position(d in '0123456789ABCDEF') - 1)::bigint)),
           lambda a, d: xor(a >> 4, steps[((xor(a, d) & 15) + 1)::int]))) as crc
  from documents, half),
hashed as (
  select rid, doc_id, k, crc,
         sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
         sha256(head || coalesce(strlen(flat) || ':' || flat, '-')) as cut
  from rows),
leaves as (
  select rid, doc_id, k, leaf, case when crc % 2 = 0 then cut else leaf end as given,
         row_number() over (partition by k order by doc_id nulls first, leaf) - 1 as pos,
         count(*) over (partition by k) as n
  from hashed),
nodes as (
  select k, 0 as level, pos, n, leaf as digest from leaves
  union all
  select k, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos))
  from nodes where n > 1 group by k, level, n, pos // 3),
tops as (
  select k, digest, row_number() over (order by k) - 1 as pos, count(*) over () as n from nodes where n = 1),
upper as (
  select 0 as level, pos, n, digest from tops
  union all
  select level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos))
  from upper where n > 1 group by level, n, pos // 3),
siblings as (
  select rid, 0 as part, s.level, s.pos, s.digest
  from leaves l join nodes s on s.k = l.k and s.n > 1
    and s.pos // 3 = (l.pos // pow(3, s.level)::bigint) // 3 and s.pos <> l.pos // pow(3, s.level)::bigint
  union all
  select rid, 1, s.level, s.pos, s.digest
  from leaves l join tops t using (k) join upper s on s.n > 1
    and s.pos // 3 = (t.pos // pow(3, s.level)::bigint) // 3 and s.pos <> t.pos // pow(3, s.level)::bigint),
proofs as (
  select rid, sha256(string_agg(digest, '' order by part, level, pos)) as proof from siblings group by rid),
folds as (
  select rid, k, 0 as level, pos, n, given as digest from leaves
  union all
  select f.rid, f.k, f.level + 1, f.pos // 3, (f.n + 2) // 3,
         sha256(string_agg(case when s.pos = f.pos then f.digest else s.digest end, '' order by s.pos))
  from folds f join nodes s on s.k = f.k and s.level = f.level and s.pos // 3 = f.pos // 3
  where f.n > 1 group by f.rid, f.k, f.level, f.pos, f.n),
refolds as (
  select f.rid, 0 as level, t.pos, t.n, f.digest from folds f join tops t using (k) where f.n = 1
  union all
  select f.rid, f.level + 1, f.pos // 3, (f.n + 2) // 3,
         sha256(string_agg(case when s.pos = f.pos then f.digest else s.digest end, '' order by s.pos))
  from refolds f join upper s on s.level = f.level and s.pos // 3 = f.pos // 3
  where f.n > 1 group by f.rid, f.level, f.pos, f.n)
select doc_id, leaf, t.digest as subroot, u.digest as root, coalesce(proof, sha256('')) as proof_sha256,
       r.digest as folded_root, r.digest = u.digest as verified
from leaves l join tops t using (k) join refolds r using (rid) left join proofs using (rid)
  join upper u on u.n = 1
where r.n = 1
"""
