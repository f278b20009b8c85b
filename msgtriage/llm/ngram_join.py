"""N-gram Jaccard join by signature trees, and the groups its links form.

Two documents link when ``100 * |A n B| >= threshold * |A u B|`` for their sets
of distinct ``width``-word shingles. Every link between different sets is
respected; nothing is sampled or capped.

1. *Sets.* Each text becomes its shingle set (64-bit hashes) and a set id.
   Documents with equal sets are one node from here on. The same pass counts
   shingles that many documents share, for the order in step 2.
2. *Blocks.* With shingles in one global order (rare first), linked sets must
   share one of their first ``n - ceil(t n) + 1`` shingles, so each set goes to
   the blocks of those shingles only. Blocks of one set vanish.
3. *Near groups.* Each member of a block is compared exactly with the block's
   centre; most members of a group of near copies join here, without the
   group's pairs being formed.
4. *Signature trees.* Blocks whose members are still in different groups are brought
   together by their smallest group, and each such home gets a tree: leaves hold a set's size and token bitmap, inner nodes the size range and
   the OR of their children's bitmaps. A dual traversal from the root pair drops
   node pairs whose sizes cannot reach the threshold or whose bitmaps bound the
   overlap below it. Homes of more than ``tree_rows`` sets, or more than ``CHUNK_TOKENS``
   shingles, are split into chunks by size band, then by hash; only chunks whose bands
   can link meet, each pair with its own two trees. Out come the sets with a partner left.
5. These sets meet once more in their homes, now with all their shingles: the traversal's
   pairs are checked exactly in the task, pairs of sets that links have joined already are
   passed over, and only links that join two groups leave the task, so a home gives
   fewer links than it has sets. Links plus near groups give the components.

Defined results: null or word-less texts have an empty set and link with
nothing; texts with fewer than ``width`` words have their whole sequence as one
shingle; a null ``doc_id`` takes part but is never a component id (its component
is null if no member has an id); repeated rows stay separate rows of one node.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from msgtriage.llm.arrays import doc_slices, mix, release_memory, separator_words, shingle_hashes, short_hash, word_hashes
from msgtriage.session import materialize

HEAVY_BITS = 18  # the table of shared shingles has 2^18 one-byte entries, at any scale
HEAVY_LOCAL = 2  # copies of a shingle among HEAVY_TOKENS of a task that make it worth counting
HEAVY_TOKENS = 3_000_000
ID_BYTES = 64 << 20  # ids of candidate documents are broadcast up to this size, else joined by shuffle
BLOCK_ROW_BYTES = 64  # of a row that says which block a set goes to
CHUNK_TOKENS = 1 << 22  # shingles of a chunk, one set at least
CENTRES = 4
STAR_PART = 100
TREE_ROWS = 8192
FANOUT = 8
MAX_BITS = 1 << 17
PAIRS_AT_ONCE = 1 << 15


# -- texts to sets -------------------------------------------------------------


def shingle_sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) per slice of a batch."""
    table = separator_words()
    for lo, hi, data, starts, ends in doc_slices(batch.column("text")):
        h, off = word_hashes(data, starts, ends, table)
        sh = shingle_hashes(h, width)
        sets = []
        for a, b in zip(off[:-1], off[1:]):
            if b - a >= width:
                sets.append(np.unique(sh[a : b - width + 1]))
            elif b > a:
                sets.append(np.array([short_hash(h[a:b], width)], np.uint64))
            else:
                sets.append(np.empty(0, np.uint64))
        yield lo, sets


def set_id(tokens: np.ndarray) -> int:
    """Id of a shingle set, the same for equal sets; 0 for the empty one."""
    if not len(tokens):
        return 0
    total = np.array([mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)], np.uint64)
    return int(mix(total + np.uint64(len(tokens)))[0].view(np.int64))


def _describe(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    def rows(ids: pa.Array, text_hash: pa.Array, n: list[int], keys: np.ndarray, bits: list[bytes | None], is_doc: bool) -> pa.RecordBatch:
        columns = {"is_doc": pa.array([is_doc] * len(n)), "doc_id": ids, "text_hash": text_hash, "n_shingles": pa.array(n, pa.int64()), "set_id": pa.array(keys, pa.int64()), "bits": pa.array(bits, pa.binary())}
        return pa.record_batch(columns)

    def shared(parts: list[np.ndarray]) -> pa.RecordBatch:
        token, copies = np.unique(np.concatenate(parts), return_counts=True)
        keep = copies >= HEAVY_LOCAL
        none = pa.nulls(int(keep.sum()), pa.int64())
        return rows(none, none, copies[keep], token[keep].view(np.int64), [None] * len(none), False)

    parts: list[np.ndarray] = []
    for batch in batches:
        for lo, sets in shingle_sets(batch, width):
            ids = batch.column("doc_id").slice(lo, len(sets)).cast(pa.int64())
            text_hash = batch.column("text_hash").slice(lo, len(sets))
            yield rows(ids, text_hash, [len(s) for s in sets], np.array([set_id(s) for s in sets], np.int64), [bitmap(s).tobytes() if len(s) else None for s in sets], True)
            parts += sets
            if sum(map(len, parts)) > HEAVY_TOKENS:
                yield shared(parts)
                parts = []
    if parts:
        yield shared(parts)
    parts.clear()
    release_memory()


def _heavy_table(shared: DataFrame) -> np.ndarray:
    """Log-scale count class of shared shingles by hash bucket: 2^18 bytes at most."""
    rows = (
        shared.groupBy("set_id").agg(F.sum("n_shingles").alias("df"))
        .groupBy(F.shiftrightunsigned("set_id", 64 - HEAVY_BITS).alias("bucket"))
        .agg(F.floor(F.log2(F.max("df"))).cast("int").alias("cls"))
        .toArrow()
    )
    table = np.zeros(1 << HEAVY_BITS, np.uint8)
    table[rows["bucket"].to_numpy()] = rows["cls"].to_numpy()
    return table


def prefix(tokens: np.ndarray, heavy: np.ndarray, threshold: int) -> np.ndarray:
    """The first ``n - ceil(t n) + 1`` shingles in the global order (rare first, then by hash)."""
    n = len(tokens)
    keep = n - (threshold * n + 99) // 100 + 1
    cls = heavy[(tokens >> np.uint64(64 - HEAVY_BITS)).astype(np.int64)]
    if cls.any():
        return tokens[np.lexsort((tokens, cls))[:keep]]
    return tokens[:keep]


def _postings(batches: Iterator[pa.RecordBatch], width: int, threshold: int, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # copies within the partition add no posting
    for batch in batches:
        for _, sets in shingle_sets(batch, width):
            ids, sizes, parts = [], [], []
            for s in sets:
                if len(s) and (i := set_id(s)) not in seen:
                    seen.add(i)
                    ids.append(i)
                    sizes.append(len(s))
                    parts.append(prefix(s, heavy, threshold))
            if ids:
                flat = np.concatenate(parts).view(np.int64)
                off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(off), pa.array(flat))
                yield pa.record_batch({"set_id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int32()), "tokens": lists})
    release_memory()


def _full_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        for _, sets in shingle_sets(batch, width):
            sets = [s for s in sets if len(s) and set_id(s) not in seen and not seen.add(set_id(s))]
            if not sets:
                continue
            off = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            yield pa.record_batch(
                {
                    "set_id": pa.array([set_id(s) for s in sets], pa.int64()),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "tokens": pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(sets).view(np.int64))),
                }
            )


# -- signature trees -----------------------------------------------------------


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Token bitmap in two levels as uint64 words: buckets with a token, then buckets
    with two or more. Buckets are two to four a token (64 to ``MAX_BITS``). The bits common
    to two sets count ``min(c, d, 2)`` over buckets of c and d tokens."""
    width = min(MAX_BITS, max(64, 1 << int(2 * len(tokens) - 1).bit_length()))
    count = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits(np.concatenate([count > 0, count > 1]), bitorder="little").view(np.uint64)


def _widened(raw: bytes, words: int) -> np.ndarray:
    """A bitmap at a larger width: each level repeated, which only loosens its bound."""
    levels = np.frombuffer(raw, np.uint64).reshape(2, -1)
    return np.tile(levels, (1, words // (2 * levels.shape[1]))).ravel()


class SignatureTree:
    """Sets in order of size; each level groups ``FANOUT`` nodes of the one below.
    ``bits`` are OR-combined, ``lo``/``hi`` the size range, ``spare`` the most tokens of a
    set that its bitmap does not count, ``limit`` the largest partner of a set here."""

    def __init__(self, n: np.ndarray, bits: np.ndarray, spare: np.ndarray, limit: np.ndarray):
        self.levels = [(bits, n, n, spare, limit)]
        while len(self.levels[-1][1]) > 1:
            b, lo, hi, sp, lim = self.levels[-1]
            cut = np.arange(0, len(lo), FANOUT)
            most = [np.maximum.reduceat(x, cut) for x in (hi, sp, lim)]
            self.levels.append((np.bitwise_or.reduceat(b, cut), np.minimum.reduceat(lo, cut), *most))


def _may_link(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, threshold: int) -> np.ndarray:
    """Node pairs whose maximum possible overlap still reaches the threshold."""
    large, small = np.maximum(x[1][i], y[1][j]), np.minimum(x[2][i], y[2][j])
    near = 100 * small >= threshold * large  # some sizes in both ranges are close enough
    near &= (x[1][i] <= y[4][j]) & (y[1][j] <= x[4][i])
    i, j = i[near], j[near]
    common = np.bitwise_count(x[0][i] & y[0][j]).sum(axis=1, dtype=np.int64) + np.minimum(x[3][i], y[3][j])
    near[near] = (100 + threshold) * common >= threshold * (x[1][i] + y[1][j])
    return near


def dual_traversal(left: SignatureTree, right: SignatureTree, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs that no node pair above them excludes, in bounded portions;
    of a tree with itself each pair once."""
    top = max(len(left.levels), len(right.levels)) - 1
    level = lambda t, k: t.levels[min(k, len(t.levels) - 1)]
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        k, i, j = stack.pop()
        if left is right:
            once = i <= j if k else i < j
            i, j = i[once], j[once]
        keep = _may_link(level(left, k), level(right, k), i, j, threshold)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if k == 0:
            yield i, j
            continue
        kids = []
        for t, node in ((left, i), (right, j)):
            if k <= len(t.levels) - 1:
                size = len(t.levels[k - 1][1])
                kids.append((node * FANOUT, np.minimum(FANOUT, size - node * FANOUT)))
            else:  # the shorter tree waits at its root
                kids.append((node, np.ones_like(node)))
        step = max(1, PAIRS_AT_ONCE // (FANOUT * FANOUT))
        for a in range(0, len(i), step):
            (fi, ni), (fj, nj) = ((f[a : a + step], n[a : a + step]) for f, n in kids)
            count = ni * nj
            pair = np.repeat(np.arange(len(count)), count)
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            stack.append((k - 1, fi[pair] + inner // nj[pair], fj[pair] + inner % nj[pair]))


def _block_pairs(rows: dict[str, np.ndarray], threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of different components that the trees of a block leave over."""
    order = np.lexsort((rows["comp"], rows["n"]))
    comp, n, part, limit = (rows[c][order] for c in ("comp", "n", "part", "limit"))
    raw = rows["bits"][order]
    own = np.flatnonzero(part == part.min())  # chunk i of the pair (i, j); all rows if i = j
    other = np.flatnonzero(part == part.max())
    spare = n - np.array([np.bitwise_count(np.frombuffer(r, np.uint64)).sum(dtype=np.int64) for r in raw])
    words = max(len(r) for r in raw) // 8
    bits = np.stack([_widened(r, words) for r in raw])
    left, right = (SignatureTree(n[k], bits[k], spare[k], limit[k]) for k in (own, other))
    if part.min() == part.max():
        right = left
    for i, j in dual_traversal(left, right, threshold):
        i, j = own[i], other[j]
        apart = comp[i] != comp[j]
        yield order[i[apart]], order[j[apart]]


def _pairs_may_link(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Pairs of leaves within the bound that the traversal uses."""
    for batch in batches:
        na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        keep = np.zeros(len(batch), bool)
        for k, (x, y) in enumerate(zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            spare = min(na[k] - np.bitwise_count(a).sum(dtype=np.int64), nb[k] - np.bitwise_count(b).sum(dtype=np.int64))
            a, b = (_widened(r, max(len(a), len(b))) for r in (x, y))
            common = np.bitwise_count(a & b).sum(dtype=np.int64) + spare
            keep[k] = (100 + threshold) * common >= threshold * (na[k] + nb[k])
        yield batch.select(["a", "b", "home", "na"]).filter(pa.array(keep))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The blocks of sorted batches, runs of equal (home, ci, cj). A block is two
    chunks at most, so the open one that is kept between batches is bounded."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not len(table):
            continue
        change = np.zeros(len(table), bool)
        for c in ("home", "ci", "cj"):
            v = table[c].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change)])
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(int(cuts[-1]))
    if rest is not None and len(rest):
        yield rest


def _tree_survivors(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """Of each block the sets that have a partner in another component left."""
    for block in _blocks(batches):
        if len(block) < 2:
            continue
        rows = {c: block[c].to_numpy() for c in ("comp", "n", "part", "limit")}
        rows["bits"] = np.array([*block["bits"].to_pylist(), None], object)[:-1]
        open_ = np.zeros(len(block), bool)
        for i, j in _block_pairs(rows, threshold):
            open_[i] = open_[j] = True
        if open_.any():
            yield from block.select(["home", "set_id", "comp", "n", "limit"]).filter(pa.array(open_)).combine_chunks().to_batches()


def _exact_links(batches: Iterator[pa.RecordBatch], threshold: int, star: bool) -> Iterator[pa.RecordBatch]:
    """Of each block links that join its components as all its links do; in a star only
    links with the home itself are looked for."""
    for block in _blocks(batches):
        ids, first = np.unique(block["set_id"].to_numpy(), return_index=True)  # repeated documents give a set again
        if len(ids) < 2:
            continue
        block = block.take(pa.array(first)).combine_chunks()
        tokens = block["tokens"].combine_chunks()
        off = tokens.offsets.to_numpy().astype(np.int64)
        flat = tokens.values.to_numpy().view(np.uint64)
        rows = {c: block[c].to_numpy() for c in ("comp", "n", "part", "limit")}
        if star:
            centre = np.flatnonzero(ids == block["home"][0].as_py())
            others = np.flatnonzero(ids != block["home"][0].as_py())
            pairs = iter([(np.repeat(centre, len(others)), others)] if len(centre) else [])
        else:
            rows["bits"] = np.array([*(bitmap(flat[a:b]).tobytes() for a, b in zip(off[:-1], off[1:])), None], object)[:-1]
            pairs = _block_pairs(rows, threshold)
        links = _joining_links(pairs, flat, off, rows["comp"], threshold)
        if links:
            a, b = (ids[np.array(x)] for x in zip(*links))
            yield pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})
    release_memory()


def _joining_links(pairs: Iterator[tuple[np.ndarray, np.ndarray]], flat: np.ndarray, off: np.ndarray, comp: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Pairs that reach the threshold exactly and are of two groups when they are met."""
    _, local = np.unique(flat, return_inverse=True)
    held = np.zeros(len(flat) + 1, bool)
    size = np.diff(off)
    _, root = np.unique(comp, return_inverse=True)  # the group of each row
    members: dict[int, list[int]] = {}
    for k, r in enumerate(root.tolist()):
        members.setdefault(r, []).append(k)
    links = []
    for i, j in pairs:
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(i)) + 1, [len(i)]])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if lo == hi:
                continue
            x = int(i[lo])
            own = local[off[x] : off[x + 1]]
            held[own] = True
            near = j[lo:hi]
            near = near[root[near] != root[x]]
            for a in range(0, len(near), PAIRS_AT_ONCE >> 5):
                some = near[a : a + (PAIRS_AT_ONCE >> 5)]
                where = np.concatenate([np.arange(off[y], off[y + 1]) for y in some])
                common = np.add.reduceat(held[local[where]].astype(np.int64), np.concatenate([[0], np.cumsum(size[some])[:-1]]))
                for y in some[(100 + threshold) * common >= threshold * (size[x] + size[some])].tolist():
                    old, new = int(root[y]), int(root[x])
                    if old == new:
                        continue
                    if len(members[old]) > len(members[new]):
                        old, new = new, old
                    root[members[old]] = new
                    members[new] += members.pop(old)
                    links.append((x, y))
            held[own] = False
    return links


# -- links and components ------------------------------------------------------


def _chunk_pairs(rows: DataFrame, threshold: int, tree_rows: int) -> DataFrame:
    """``rows`` (home, set_id, n and more) once for each pair of chunks ``ci <= cj`` that they
    take part in, with ``part`` the own chunk.

    A large home is cut into size bands, these by hash; linked sets lie in one band or
    in neighbouring ones. The width has a margin, so rounding puts no linked sets further apart."""
    band = F.floor(F.log("n") / (1.000001 * math.log(100 / threshold))).cast("int") if threshold < 100 else F.lit(0)
    rows = rows.withColumn("band", band)
    cells = rows.groupBy("home", "band").agg(F.count("*").alias("sets"), F.max("n").cast("long").alias("top"))
    parts = F.ceil(F.greatest(F.col("sets") / tree_rows, F.col("sets") * F.col("top") / CHUNK_TOKENS)).cast("int")
    homes = cells.groupBy("home").agg(F.sum("sets").alias("sets"), F.max("top").alias("top"), F.map_from_entries(F.collect_list(F.struct("band", parts))).alias("chunks"))
    homes = homes.where((F.col("sets") > tree_rows) | (F.col("sets") * F.col("top") > CHUNK_TOKENS)).select("home", "chunks")
    rows = rows.join(homes, "home", "left")

    def code(band: Column, k: Column) -> Column:
        return band.cast("long") * (1 << 32) + k

    def all_of(band: Column) -> Column:
        ks = F.sequence(F.lit(0), F.try_element_at("chunks", band) - 1)
        return F.coalesce(F.transform(ks, lambda k: code(band, k)), F.expr("cast(array() as array<bigint>)"))

    own = code(F.col("band"), F.pmod(F.xxhash64("set_id"), F.try_element_at("chunks", F.col("band")).cast("long")))
    to = F.concat(*[all_of(F.col("band") + d) for d in (-1, 0, 1)])
    whole = F.col("chunks").isNull()
    rows = rows.withColumn("part", F.when(whole, F.lit(0).cast("long")).otherwise(own))
    rows = rows.withColumn("to", F.explode(F.when(whole, F.array(F.lit(0).cast("long"))).otherwise(to)))
    return rows.withColumn("ci", F.least("part", "to")).withColumn("cj", F.greatest("part", "to")).drop("band", "chunks", "to")


def _links(blocks: DataFrame, signatures: DataFrame, texts: DataFrame, width: int, threshold: int, star: bool = False) -> DataFrame:
    """Links (a, b) between the sets of blocks ``home, ci, cj, part, set_id, n, comp, limit``;
    only the sets that occur there are read again from their texts."""
    blocks = materialize(blocks.drop("n"), "link-blocks")
    wanted = blocks.select("set_id").distinct().join(signatures.select("set_id", "doc_id", "text_hash"), "set_id")
    wanted = materialize(wanted.select("doc_id", "text_hash").distinct(), "link-docs")
    same = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.xxhash64("t.text") == F.col("w.text_hash"))
    chosen = texts.alias("t").join(_bounded(wanted).alias("w"), same, "left_semi")
    sets = _arrow(chosen.select("text"), _full_sets, "set_id long, n long, tokens array<long>", width=width)
    rows = sets.join(_bounded(blocks, BLOCK_ROW_BYTES), "set_id").select("home", "ci", "cj", "part", "set_id", "n", "comp", "limit", "tokens")
    rows = rows.repartition("home", "ci", "cj").sortWithinPartitions("home", "ci", "cj")
    return _arrow(rows, _exact_links, "a long, b long", threshold=threshold, star=star)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) of every node in ``edges``, comp the component's smallest node.

    Alternating large-star and small-star rounds; minima are aggregates with
    map-side combine, every round is stored in the shared folder.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        sym = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            sym = sym.where("v < u")
        least = sym.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        near = sym.join(least, "u")
        if large:
            out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        return out.where("u != v").distinct()

    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    e = materialize(e, "cc-edges")
    while True:
        # done when every edge leads to a root: no node has two smaller neighbours or is between two
        more = e.groupBy("u").count().where("count > 1").select("u").union(e.join(e.select(F.col("u").alias("v")), "v", "left_semi").select("u"))
        if not more.limit(1).count():
            break
        e = materialize(star(star(e, True), False), "cc-round")
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _arrow(df: DataFrame, f: Callable, schema: str, **args) -> DataFrame:
    return df.mapInArrow(partial(f, **args), schema)


def near_duplicate_sets(docs: DataFrame, width: int = 5, threshold: int = 80, tree_rows: int = TREE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(documents as ``doc_id, text_hash, n_shingles, set_id``; sets in components of two or more
    as ``set_id, comp``). Both are stored in the shared folder or derive from such."""
    spark: SparkSession = docs.sparkSession
    if not 0 < threshold <= 100:
        raise ValueError("threshold is a percentage above 0")
    texts = docs.select("doc_id", "text")
    seen = _arrow(texts.withColumn("text_hash", F.xxhash64("text")), _describe, "is_doc boolean, doc_id long, text_hash long, n_shingles long, set_id long, bits binary", width=width)
    seen = materialize(seen, "shingle-sets")
    described = seen.where("is_doc").select("doc_id", "text_hash", "n_shingles", "set_id")
    heavy = _heavy_table(seen.where("not is_doc"))

    own = Window.partitionBy("token")
    posts = _arrow(texts.select("text"), _postings, "set_id long, n int, tokens array<long>", width=width, threshold=threshold, heavy=heavy)
    posts = posts.select("set_id", "n", F.posexplode("tokens").alias("pos", "token"))
    # if a pair's first common shingle is here, n - pos bounds its overlap, and that the partner's size
    posts = posts.select("token", "set_id", "n", F.expr(f"cast({100 + threshold} * (n - pos) div {threshold} - n as int)").alias("limit"))
    turn = F.struct(F.xxhash64("set_id", F.pmod("token", F.lit(CENTRES))).alias("h"), "set_id", "n", "limit")
    shared = posts.withColumn("least", F.min("n").over(own)).where("least <= limit")
    shared = shared.withColumn("lo", F.min("set_id").over(own)).withColumn("hi", F.max("set_id").over(own)).where("lo < hi")
    shared = shared.withColumn("centre", F.min(turn).over(own)).select("token", "set_id", "n", "limit", "centre").distinct()
    shared = materialize(shared, "shared-postings")

    nodes = seen.where("is_doc").where("n_shingles > 0").join(shared.select("set_id").distinct(), "set_id", "left_semi")
    nodes = nodes.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("doc"), F.first("n_shingles").alias("n"), F.first("bits").alias("bits"))
    signatures = materialize(nodes.select("set_id", "doc.*", "n", "bits"), "signatures")

    star = shared.where("set_id != centre.set_id and centre.n <= limit and n <= centre.limit")
    star = star.where(100 * F.least("n", "centre.n") >= threshold * F.greatest("n", "centre.n"))
    star = star.groupBy(F.least("set_id", "centre.set_id").alias("a"), F.greatest("set_id", "centre.set_id").alias("b"))
    # copies meet in many blocks; whoever meets its centre in a few only is left to the trees
    star = star.agg(F.count("*").alias("blocks"), F.max("n").alias("n"), F.min("centre.set_id").alias("home")).where(f"{STAR_PART} * blocks >= n").select("a", "b", "home")
    star = star.join(signatures.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("bits").alias("bits_a")), "a")
    star = star.join(signatures.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("bits_b")), "b")
    star = materialize(_arrow(star, _pairs_may_link, "a long, b long, home long, na long", threshold=threshold), "star-pairs")
    groups = connected_components(_links(_star_blocks(star, tree_rows), signatures, texts, width, threshold, star=True))

    placed = shared.select("token", "set_id", "n", "limit").join(groups.withColumnRenamed("node", "set_id"), "set_id", "left")
    placed = placed.withColumn("comp", F.coalesce("comp", "set_id"))
    # blocks with the same smallest component share most of their sets and become one home, where each set stands once
    open_ = placed.groupBy("token").agg(F.min("comp").alias("home"), F.max("comp").alias("c1")).where("home < c1").select("token", "home")
    homes = placed.join(open_, "token").groupBy("home", "set_id").agg(F.first("comp").alias("comp"), F.max("limit").alias("limit"), F.max("n").alias("n"))
    blocks = _chunk_pairs(materialize(homes, "homes"), threshold, tree_rows).join(signatures.select("set_id", "bits"), "set_id")
    blocks = blocks.select("home", "set_id", "limit", "comp", "part", "n", "bits", "ci", "cj")
    blocks = blocks.repartition("home", "ci", "cj").sortWithinPartitions("home", "ci", "cj")
    # sets with a partner left; one that has partners in several pairs of chunks stands there several times
    open_sets = materialize(_arrow(blocks, _tree_survivors, "home long, set_id long, comp long, n int, limit int", threshold=threshold), "open-sets")
    more = _links(_chunk_pairs(open_sets.distinct(), threshold, tree_rows), signatures, texts, width, threshold)
    joined = groups.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(more)
    return described, connected_components(joined).withColumnRenamed("node", "set_id")


def _star_blocks(pairs: DataFrame, tree_rows: int) -> DataFrame:
    """Blocks of a centre and some of its partners; ``pairs`` are stored (a, b, home = a or b, na)."""
    partner = F.when(F.col("a") == F.col("home"), F.col("b")).otherwise(F.col("a")).alias("set_id")
    sizes = pairs.groupBy("home").agg(F.ceil(F.greatest(F.count("*") / tree_rows, F.sum("na") / CHUNK_TOKENS)).cast("long").alias("chunks"))
    rows = pairs.select("home", partner, "na").join(sizes, "home").withColumn("ci", F.pmod(F.xxhash64("set_id"), "chunks"))
    centres = sizes.select("home", F.col("home").alias("set_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("ci"))
    rows = rows.select("home", "set_id", "ci").union(centres)
    none = F.lit(0)
    return rows.select("home", "ci", F.col("ci").alias("cj"), none.cast("long").alias("part"), "set_id", none.alias("n"), F.col("set_id").alias("comp"), none.alias("limit"))


def jaccard_components(docs: DataFrame, width: int = 5, threshold: int = 80, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id`` (smallest reachable doc_id)."""
    placed = _grouped(docs, width, threshold, tree_rows)
    least = placed.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    out = placed.join(least, "group", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("least", F.when(F.col("n_shingles") == 0, F.col("doc_id"))).alias("component_id"))


def _grouped(docs: DataFrame, width: int, threshold: int, tree_rows: int) -> DataFrame:
    """Documents with the ``group`` of their set; null for the empty set."""
    described, members = near_duplicate_sets(docs, width, threshold, tree_rows)
    placed = described.join(members, "set_id", "left")
    return placed.withColumn("group", F.when(F.col("n_shingles") > 0, F.coalesce("comp", "set_id")))


def _bounded(rows: DataFrame, row_bytes: int = 16) -> DataFrame:
    """Stored rows of a known size, marked for broadcast if it allows that."""
    return F.broadcast(rows) if rows.count() * row_bytes <= ID_BYTES else rows


def keep_one_per_group(docs: DataFrame, width: int = 5, threshold: int = 80, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest ``doc_id``
    (ids before null, then by text hash), and of its repeated rows one. Documents
    without words are nobody's copies and all stay."""
    placed = _grouped(docs, width, threshold, tree_rows).where("group is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    placed = materialize(placed.select("doc_id", "text_hash", "group"), "group-rows")
    placed = placed.join(placed.groupBy("group").agg(first), "group")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    rows = placed.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(F.max(stays).alias("__stays"), F.count("*").alias("__rows"))
    rows = materialize(rows.where("not __stays or __rows > 1"), "group-rest")
    found = (F.col("doc_id").eqNullSafe(F.col("__id"))) & (F.xxhash64("text") == F.col("__hash"))
    kept = docs.join(_bounded(rows.select("__id", "__hash")), found, "left_anti")
    again = rows.where("__stays")
    if again.limit(1).count():  # repeated rows of a document that stays: one of them
        alike = docs.join(_bounded(again.select("__id", "__hash")), found).withColumn("__nth", F.row_number().over(Window.partitionBy("__id", "__hash").orderBy("__hash")))
        kept = kept.union(alike.where("__nth = 1").select(*docs.columns))
    return kept
