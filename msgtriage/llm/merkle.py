"""Merkle manifest of a dataset: digests of all documents, sources and the whole, with proofs.

Every document is a leaf. Within a source (a *tree*) the leaves stand in order of ``doc_id``; of
each run of ``ARITY`` consecutive nodes the parent is the digest of their digests, until one node
is left, the source's subroot. The subroots, in order of source, are the leaves of one more
tree, whose top is the root.

**Nested-interval labels.** A node covers the leaf ranks ``[lo, hi)`` of its tree, so a node is
an ancestor of another if its interval contains the other's. Levels come in buckets of
``LEVELS``: a stored *block* holds the nodes of one bucket of levels above ``ARITY ** LEVELS``
neighbours. Blocks are made bottom up by one grouping per bucket. Proofs are attached top down by
one containment join per bucket: the nodes below a block's top get the path from there to
the root, and blocks of the next lower bucket take the path of the node whose interval contains
theirs. The siblings of a node are what its parent's interval holds beside its own; the path
keeps them as the digests left and right of it.

A block holds ``ARITY ** LEVELS`` leaves at most and every join meets one node per block, so a
source with a third of all rows has no hot key. Rows are ranked by :mod:`msgtriage.llm.order`.
A proof is as long as its tree is high; nothing grows with the table but the number of rows.

Defined results: a null field's digest input is ``-``, any other value's its UTF-8 length, ``:``
and the value, so null and empty differ; the null source is a tree of its own, first in
order; null ids come first in their source; rows of equal id stand in order of their leaf
digest, and repeated rows are leaves of their own. A tree of one leaf has that leaf as its
subroot, with an empty path; the digest of no siblings is that of the empty string. An empty
table has no nodes and no root. Texts of any length are hashed whole in the scan and not
shuffled. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.llm.order import ranged
from msgtriage.session import materialize

ARITY = 3
LEVELS = 4  # levels of a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated strings."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column | None = None) -> Column:
    """Digest of a document's fields; ``text`` replaces the column of that name."""
    return digest(*[field(text if c == "text" and text is not None else F.col(c)) for c in FIELDS])


def tree_of(source: Column) -> Column:
    """Name of a source's tree: ``-`` for null, which sorts before ``:`` and the source."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), source))


@dataclass
class Trees:
    """Stored blocks of every bucket of levels, lowest first; the last holds the tops.

    Columns: ``tree``, ``block`` (number among its tree's blocks), ``n`` (the tree's nodes at
    the bucket's lowest level), ``height`` (levels above that level), ``items`` (of level 0),
    ``row0`` ... (the digests of each level)."""

    buckets: list[DataFrame]
    arity: int
    levels: int

    @property
    def size(self) -> int:
        return self.arity**self.levels

    def tops(self) -> DataFrame:
        """``tree, top`` of every tree."""
        return self.buckets[-1].select("tree", _top(self.levels).alias("top"))

    def nodes(self) -> DataFrame:
        """The manifest: ``tree, level, lo, hi, leaves, digest`` of every node, ``leaves`` being those of its tree."""
        n_leaves = self.buckets[0].groupBy("tree").agg(F.max("n").alias("leaves"))
        out = None
        for k, blocks in enumerate(self.buckets):
            # a tree that ended lower has one node here; the top row of a block is the next bucket's lowest, or the tree's top
            blocks = blocks.where("n > 1") if k else blocks
            for level in range(self.levels + 1):
                part = blocks.where(F.col("n") <= self.size) if level == self.levels else blocks
                part = part.select("tree", "block", F.posexplode(f"row{level}").alias("i", "digest"))
                wide = self.arity ** (k * self.levels + level)
                lo = (F.col("block") * F.lit(self.arity ** (self.levels - level)) + F.col("i")) * F.lit(wide)
                part = part.select("tree", F.lit(k * self.levels + level).alias("level"), lo.alias("lo"), F.lit(wide).alias("wide"), "digest")
                out = part if out is None else out.union(part)
        hi = F.least(F.col("lo") + F.col("wide"), F.col("leaves")).alias("hi")
        return out.join(n_leaves, "tree").select("tree", "level", "lo", hi, "leaves", "digest")

    def paths(self, upper: DataFrame | None = None) -> DataFrame:
        """``tree, item, leaf, path, note`` of every leaf: the digests left and right of it and of
        its ancestors, lowest level first, followed by the path of its top, and the top's note, both
        from ``upper(tree, path, note)``."""
        above = self.buckets[-1].select("tree", "block")
        if upper is None:
            above = above.withColumns({"path": F.array().cast(NO_PATH), "note": F.lit(None).cast("string")})
        else:
            above = above.join(upper, "tree")
        for k in range(len(self.buckets) - 1, -1, -1):
            wide = self.size ** (k + 1)  # leaf ranks under a block of this bucket
            blocks = self.buckets[k].withColumns({"lo": F.col("block") * F.lit(wide), "hi": (F.col("block") + 1) * F.lit(wide)})
            node = above.select(F.col("tree").alias("node_tree"), (F.col("block") * F.lit(wide)).alias("node_lo"), ((F.col("block") + 1) * F.lit(wide)).alias("node_hi"), "path", "note")
            contained = (F.col("node_lo") <= F.col("lo")) & (F.col("hi") <= F.col("node_hi"))
            same_bucket = (F.col("node_tree") == F.col("tree")) & (F.expr(f"node_lo div {wide}") == F.col("block"))
            joined = blocks.join(node, same_bucket & contained)
            own = F.transform("row0", lambda d, j: F.struct(j.alias("j"), d.alias("leaf"), _path(j, self.arity, self.levels).alias("own")))
            joined = joined.withColumn("leaves", own)
            below = joined.select("tree", "block", "path", "note", "items", F.inline("leaves"))
            path = F.concat("own", "path").alias("path")
            if k == 0:
                return below.select("tree", F.get("items", F.col("j")).alias("item"), "leaf", path, "note")
            above = materialize(below.select("tree", (F.col("block") * F.lit(self.size) + F.col("j")).alias("block"), path, "note"), "merkle-paths")
        raise AssertionError("trees have one bucket at least")


def _top(levels: int) -> Column:
    """Digest of a block's top node: the only one of its highest row."""
    return F.coalesce(*[F.get(f"row{k}", F.lit(0)) for k in range(levels, -1, -1)])


def _path(j: Column, arity: int, levels: int) -> Column:
    """The path of leaf ``j`` of a block inside the block."""
    steps = []
    for k in range(levels):
        own = F.floor(j / arity**k).cast("int")  # the ancestor at level k; its parent's interval begins at first
        first = (F.floor(j / arity ** (k + 1)) * arity).cast("int")
        left = F.array_join(F.slice(f"row{k}", first + 1, own - first), "")
        right = F.array_join(F.slice(f"row{k}", own + 2, first + arity - own - 1), "")
        steps.append(F.when(F.col("height") > k, F.struct(left.alias("left"), right.alias("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _blocks(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """Blocks over ``tree, lo, n, digest, item`` rows, ``lo`` being the number of the node in its level."""
    size = arity**levels
    blocks = nodes.groupBy("tree", F.expr(f"lo div {size}").alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("lo", "digest", "item"))).alias("nodes")
    )
    height = sum((F.col("n") > arity**k).cast("int") for k in range(levels))
    blocks = blocks.select("tree", "block", "n", height.alias("height"), F.col("nodes.item").alias("items"), F.col("nodes.digest").alias("row0"))
    for k in range(levels):
        blocks = blocks.withColumn(f"row{k + 1}", F.when(F.col("height") > k, _parents(f"row{k}", arity)))
    return blocks


def _parents(row: str, arity: int) -> Column:
    """Digests of the parents of a block's row of nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(row) - 1) / arity).cast("int"))
    return F.transform(runs, lambda q: F.sha2(F.array_join(F.slice(row, q * arity + 1, arity), ""), 256))


def build(leaves: DataFrame, order: list[str], arity: int = ARITY, levels: int = LEVELS) -> Trees:
    """Trees over rows ``tree, digest, item``, leaves in the order of the columns or fields
    ``order`` (nulls first), then of their digests."""
    stored = ranged(leaves, [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order], F.col("digest")], "at", "merkle-leaves")
    # a tree's rows of one range partition are neighbours; the partitions before it give the rest of the rank
    parts = stored.groupBy("at.part", "tree").agg(F.min("at.position").alias("first"), F.count("*").alias("rows"))
    of_tree = Window.partitionBy("tree")
    earlier = of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.col("tree").alias("t"), (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(of_tree).alias("n"))
    parts = materialize(parts, "merkle-parts")
    most = parts.agg(F.max("n")).first()[0] or 0
    same = (F.col("at.part") == F.col("part")) & (F.col("tree") == F.col("t"))
    nodes = stored.join(parts, same).select("tree", (F.col("at.position") + F.col("shift")).alias("lo"), "n", "digest", "item")
    size, buckets = arity**levels, []
    while True:
        buckets.append(materialize(_blocks(nodes, arity, levels), "merkle-blocks"))
        if most <= size:
            return Trees(buckets, arity, levels)
        most = -(-most // size)
        item = F.lit(None).cast("string").alias("item")
        nodes = buckets[-1].select("tree", F.col("block").alias("lo"), F.ceil(F.col("n") / size).alias("n"), _top(levels).alias("digest"), item)


@dataclass
class Manifest:
    """Trees of the sources and the tree over their subroots (named ``''``)."""

    sources: Trees
    whole: Trees

    def nodes(self) -> DataFrame:
        return self.sources.nodes().union(self.whole.nodes())

    def proofs(self) -> DataFrame:
        """``tree, item, leaf, subroot, root, path`` of every leaf."""
        root = self.whole.tops().select("tree", F.col("top").alias("root"))  # one row
        above = self.whole.paths().drop("note").join(F.broadcast(root), "tree")
        note = F.struct(F.col("leaf").alias("subroot"), "root").alias("note")
        leaves = self.sources.paths(materialize(above.select("item.tree", "path", note), "merkle-subroots"))
        return leaves.select("tree", "item", "leaf", "note.subroot", "note.root", "path")


def manifest(docs: DataFrame, items: dict[str, Column], arity: int = ARITY, levels: int = LEVELS) -> Manifest:
    """The manifest of ``docs``; a leaf's ``item`` has ``doc_id`` and the given columns."""
    item = F.struct(F.col("doc_id"), *[c.alias(name) for name, c in items.items()]).alias("item")
    leaves = materialize(docs.select(tree_of(F.col("source")).alias("tree"), leaf_digest().alias("digest"), item), "merkle-rows")
    sources = build(leaves, ["item.doc_id"], arity, levels)
    tops = sources.tops().select(F.lit("").alias("tree"), F.col("top").alias("digest"), F.struct("tree").alias("item"))
    return Manifest(sources, build(tops, ["item.tree"], arity, levels))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and its path lead to."""
    return F.aggregate(path, leaf, lambda d, step: F.sha2(F.concat(step["left"], d, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of the siblings along the path, lowest level first, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def verify(docs: DataFrame, tampered: Column, changed_text: Column) -> DataFrame:
    """Manifest of ``docs`` and the check of a copy in which rows with ``tampered`` have ``changed_text``:
    ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    copy = F.when(tampered, leaf_digest(changed_text))
    rows = manifest(docs, {"copy": copy}).proofs()
    folded = fold(F.coalesce("item.copy", "leaf"), F.col("path"))
    out = rows.select("item.doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
