"""Benchmark decontamination with a generalised suffix automaton.

Items and documents are normalised to words (A-Z lower-cased, runs of digits, a-z
and non-ASCII characters). The automaton accepts every run of consecutive words of
every item; a document's words are streamed through it, keeping the longest match
that ends at each word. Where a match holds a *window* - ``window`` consecutive words
of an item, or all words of a shorter item - its words are hit.

Stretches of a document that cannot hold a window, because their short word grams
occur in no item, are found with array operations and not streamed.

The automaton is broadcast. It is built for at most ``block_words`` words of items
at a time (plus one item); a larger benchmark is scanned in several passes, each
adding its hits, so what a task holds does not grow with the benchmark.

Defined results: null or word-less texts have no words and no hits; an item
without words has no window; repeated item ids count once; an item without an id
still hits but is listed as the empty string; repeated documents give repeated
rows. Input columns other than ``doc_id`` and ``text`` are not read by
:func:`scan`; :func:`decontaminate` keeps all columns whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.llm.arrays import alnum_words, doc_slices, find_words, release_memory, shingle_hashes, word_hashes
from msgtriage.session import materialize

BLOCK_WORDS = 500_000
GRAM = 3
TABLE_BITS = 22
SPANS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


class SuffixAutomaton:
    """Generalised suffix automaton over word hashes, with the windows its states end."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.ids = [item_id for item_id, _ in items]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.at = self._above_window()
        self.full: dict[int, set[int]] = {}  # state of a window of full length -> items
        self.short: dict[int, dict[int, set[int]]] = {}  # state -> length of a short item -> items
        for k, (_, words) in enumerate(items):
            state = 0
            for n, w in enumerate(words, 1):
                state = self.next[state][w]
                if n >= window:
                    self.full.setdefault(self.at[state], set()).add(k)
            if 0 < len(words) < window:
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(k)
        self._chains: dict[int, list[tuple[int, set[int]]]] = {}
        sizes = [min(window, len(words)) for _, words in items if words]
        self.shortest = min(sizes, default=window)
        self.gram = min(GRAM, self.shortest)
        grams = [shingle_hashes(np.array(words, np.uint64), self.gram) for _, words in items if words]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        if grams:
            self.table[(np.concatenate(grams) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def _extend(self, last: int, w: int) -> int:
        """Append a word to the current item; standard online construction."""
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.len.append(self.len[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _above_window(self) -> list[int]:
        """For each state the state of its suffix of ``window`` words (itself if shorter)."""
        at = list(range(len(self.len)))
        for s in sorted(at, key=self.len.__getitem__):
            if s and self.len[self.link[s]] >= self.window:
                at[s] = at[self.link[s]]
        return at

    def _short_ends(self, state: int) -> list[tuple[int, set[int]]]:
        """Short items that end a match in this state, longest first."""
        if (found := self._chains.get(state)) is None:
            found, s = [], state
            while s > 0:
                found += sorted(self.short.get(s, {}).items(), reverse=True)
                s = self.link[s]
            self._chains[state] = found
        return found

    def stream(self, words: list[int]) -> Iterator[tuple[int, int, int, set[int]]]:
        """(position, length of the longest match, longest window, items) at each word
        where a window ends."""
        nxt, link, length, window = self.next, self.link, self.len, self.window
        state = matched = 0
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            if matched < self.shortest:
                continue
            size, items = 0, set()
            if matched >= window:
                size, items = window, set(self.full[self.at[state]])
            if self.short:
                for n, own in self._short_ends(state):
                    if n <= matched:
                        size, items = max(size, n), items | own
            if size:
                yield i, matched, size, items

    def hits(self, h: np.ndarray) -> tuple[list[tuple[int, int]], set[int], int]:
        """(hit word spans, items, longest match) of one document's word hashes."""
        if len(h) < self.shortest:
            return [], set(), 0
        known = self.table[(shingle_hashes(h, self.gram) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
        return self._hits(h, known)

    def _hits(self, h: np.ndarray, known: np.ndarray) -> tuple[list[tuple[int, int]], set[int], int]:
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        longest = 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            b += self.gram - 1
            if b - a < self.shortest:
                continue
            for i, matched, size, own in self.stream(h[a:b].tolist()):
                spans.append((a + i + 1 - size, a + i + 1))
                items |= own
                longest = max(longest, matched)
        return spans, items, longest


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans, in order, touching ones joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, starts, ends in doc_slices(batch.column("text")):
            h, off = word_hashes(data, starts, ends, alnum_words())
            yield pa.record_batch(
                {"item_id": batch.column("item_id").slice(lo, hi - lo), "words": pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(h.view(np.int64)))}
            )


def automata(benchmark: DataFrame, window: int, block_words: int = BLOCK_WORDS) -> Iterator[SuffixAutomaton]:
    """One automaton per block of items, built on the driver from that block alone."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    items = items.mapInArrow(_item_words, "item_id string, words array<long>").where(F.size("words") > 0).distinct()
    before = F.sum(F.size("words")).over(Window.orderBy("item_id", "words").rowsBetween(Window.unboundedPreceding, -1))
    items = items.withColumn("block", F.floor(F.coalesce(before, F.lit(0)) / block_words)).cache()
    try:
        for block in range(items.agg(F.coalesce(F.max("block"), F.lit(-1)).alias("m")).first().m + 1):
            rows = items.where(F.col("block") == block).orderBy("item_id", "words").toArrow()
            words = [[w & (2**64 - 1) for w in ws] for ws in rows["words"].to_pylist()]
            if words:
                yield SuffixAutomaton(list(zip(rows["item_id"].to_pylist(), words)), window)
    finally:
        items.unpersist()


SCANNED = "doc_id long, n_words long, spans array<struct<first:int,end:int>>, items array<string>, longest int"


def _scan(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    auto: SuffixAutomaton = shared.value
    table = alnum_words()
    for batch in batches:
        for lo, hi, data, starts, ends in doc_slices(batch.column("text")):
            h, _, _, off = find_words(data, starts, ends, table)
            rows = _document_hits(auto, h, off)
            cut = batch.slice(lo, hi - lo)
            old = list(zip(*(cut.column(c).to_pylist() for c in ("spans", "items", "longest"))))
            new = []
            for (spans, items, longest), (s, it, n) in zip(rows, old):
                both = [(x["first"], x["end"]) for x in s] + spans if s else spans
                new.append(([{"first": a, "end": b} for a, b in merge_spans(both)], sorted({*it, *(auto.ids[k] for k in items)}), max(longest, n)))
            spans, items, longest = zip(*new)
            kind = {f.name: f.type for f in batch.schema}
            fresh = {
                "n_words": pa.array(np.diff(off).astype(np.int64)),
                "spans": pa.array(spans, kind["spans"]),
                "items": pa.array(items, kind["items"]),
                "longest": pa.array(longest, pa.int32()),
            }
            yield pa.record_batch({c: fresh.get(c, cut.column(c)) for c in batch.schema.names})


def _document_hits(auto: SuffixAutomaton, h: np.ndarray, off: np.ndarray) -> list[tuple[list[tuple[int, int]], set[int], int]]:
    grams = shingle_hashes(h, auto.gram)
    known = auto.table[(grams >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
    nothing: tuple = ([], set(), 0)
    out = []
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        own = known[a : b - auto.gram + 1] if b - a >= auto.shortest else known[:0]
        out.append(auto._hits(h[a:b], own) if own.any() else nothing)
    return out


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: ``doc_id, n_words, spans`` (merged hit word ranges, end exclusive),
    ``items`` (ids with occurring windows, sorted as strings), ``longest`` (longest match)."""
    out = docs.select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<first:int,end:int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"), F.lit(0).alias("longest"),
    )
    schema = out.schema
    shared = None
    for auto in automata(benchmark, window, block_words):
        if shared is not None:  # a further block: what is found so far is stored, so a task holds one automaton
            out = materialize(out, "decontaminate-scan")
            shared.destroy()
        shared = docs.sparkSession.sparkContext.broadcast(auto)
        out = out.mapInArrow(partial(_scan, shared=shared), schema)
    if shared is None:  # no windows at all: only the word counts are to be had
        nothing = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton([], window))
        out = out.mapInArrow(partial(_scan, shared=nothing), schema)
    return out.drop("text")


def report(scanned: DataFrame) -> DataFrame:
    """Digest of :func:`scan`: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.first)")
    return scanned.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), "longest",
    )


def _clean(batches: Iterator[pa.RecordBatch], shared, max_coverage: float) -> Iterator[pa.RecordBatch]:
    auto: SuffixAutomaton = shared.value
    table = alnum_words()
    for batch in batches:
        for lo, hi, data, starts, ends in doc_slices(batch.column("text")):
            part = batch.slice(lo, hi - lo)
            h, first, last, off = find_words(data, starts, ends, table)
            found = _document_hits(auto, h, off)
            if not any(spans for spans, _, _ in found):
                yield part
                continue
            texts, keep = part.column("text").to_pylist(), np.ones(hi - lo, bool)
            for d, (spans, _, _) in enumerate(found):
                if not spans:
                    continue
                spans = merge_spans(spans)
                keep[d] = sum(b - a for a, b in spans) < max_coverage * (off[d + 1] - off[d])
                texts[d] = _without(texts[d], spans, first[off[d] :] - starts[d], last[off[d] :] - starts[d])
                while keep[d]:  # what remains may meet to a new window
                    raw = np.frombuffer(texts[d].encode(), np.uint8)
                    h2, f2, l2, _ = find_words(raw, np.zeros(1, np.int64), np.array([len(raw)]), table)
                    again = merge_spans(auto.hits(h2)[0])
                    if not again:
                        break
                    texts[d] = _without(texts[d], again, f2, l2)
            out = part.set_column(part.schema.get_field_index("text"), "text", pa.array(texts, part.schema.field("text").type))
            yield out.filter(pa.array(keep))
    release_memory()


def _without(text: str, spans: list[tuple[int, int]], first: np.ndarray, last: np.ndarray) -> str:
    raw, parts, at = text.encode(), [], 0
    for a, b in spans:
        parts.append(raw[at : first[a]])
        at = int(last[b - 1])
    return b"".join([*parts, raw[at:]]).decode()


def _block_spans(batches: Iterator[pa.RecordBatch], shared, row: str) -> Iterator[pa.RecordBatch]:
    auto: SuffixAutomaton = shared.value
    table = alnum_words()
    for batch in batches:
        for lo, _, data, starts, ends in doc_slices(batch.column("text")):
            h, _, _, off = find_words(data, starts, ends, table)
            found = [(lo + d, merge_spans(spans)) for d, (spans, _, _) in enumerate(_document_hits(auto, h, off)) if spans]
            rows = batch.column(row).take(pa.array([d for d, _ in found], pa.int64()))
            spans = pa.array([[{"first": a, "end": b} for a, b in s] for _, s in found], SPANS)
            yield pa.RecordBatch.from_arrays([rows, spans], [row, "spans"])


def _cut(batches: Iterator[pa.RecordBatch], spans: str, max_coverage: float | None) -> Iterator[pa.RecordBatch]:
    table = alnum_words()
    for batch in batches:
        texts, keep = batch.column("text").to_pylist(), np.ones(len(batch), bool)
        hit = batch.column(spans).to_pylist()
        for lo, _, data, starts, ends in doc_slices(batch.column("text")):
            _, first, last, off = find_words(data, starts, ends, table)
            for d in range(len(starts)):
                own = merge_spans([(x["first"], x["end"]) for x in hit[lo + d]])
                if max_coverage is not None:
                    keep[lo + d] = sum(b - a for a, b in own) < max_coverage * (off[d + 1] - off[d])
                texts[lo + d] = _without(texts[lo + d], own, first[off[d] :] - starts[d], last[off[d] :] - starts[d])
        out = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, batch.schema.field("text").type))
        yield out.drop_columns([spans]).filter(pa.array(keep))


def unused(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def _clean_by_blocks(docs: DataFrame, shared: list, max_coverage: float) -> DataFrame:
    """:func:`decontaminate` with several automata: in each round all of them see the
    same texts, their spans are merged by row, and what was cut is scanned again.

    Rows and spans are stored between the steps, so a task holds one automaton."""
    row, spans = unused("__row", docs.columns), unused("__spans", docs.columns)
    work = materialize(docs.select(F.monotonically_increasing_id().alias(row), "*"), "decontaminate")
    out, coverage = None, max_coverage
    while True:
        hit = None
        for auto in shared:
            own = work.select(row, "text").mapInArrow(partial(_block_spans, shared=auto, row=row), f"`{row}` long, spans array<struct<first:int,end:int>>")
            own = materialize(own, "decontaminate-spans")
            hit = own if hit is None else hit.unionAll(own)
        hit = hit.groupBy(row).agg(F.flatten(F.collect_list("spans")).alias(spans))
        clean = work.join(hit, row, "left_anti")
        out = clean if out is None else out.unionAll(clean)
        cut = work.join(hit, row).mapInArrow(partial(_cut, spans=spans, max_coverage=coverage), work.schema)
        work, coverage = materialize(cut, "decontaminate-cut"), None
        if work.isEmpty():
            return out.drop(row)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents with hit spans cut out of ``text``; a document of whose words
    ``max_coverage`` or more are hit is removed. Other columns and untouched texts stay.

    The result does not depend on ``block_words``: coverage is that of all items in
    the given text, and texts are cut until no item has a window in them."""
    shared = [docs.sparkSession.sparkContext.broadcast(auto) for auto in automata(benchmark, window, block_words)]
    if not shared:
        return docs
    if len(shared) > 1:
        return _clean_by_blocks(docs, shared, max_coverage)
    return docs.mapInArrow(partial(_clean, shared=shared[0], max_coverage=max_coverage), docs.schema)
