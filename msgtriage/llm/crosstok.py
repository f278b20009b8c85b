"""Alignment of two tokenizers by pointer jumping.

Every text is cut into tokens by a byte-level vocabulary (A) and by a piece vocabulary with byte
fallback (B), both of which tile the bytes of a space and the text. Tokens of both sides that
overlap, directly or through others, make a group; groups end where a token of each side ends.

**Pointer jumping.** Every token points to the token that overlaps it and reaches farthest to the
right, itself included; where a token of each side ends at the same byte, both point to A's. All
pointers of a slice of texts are doubled at once (``next = next[next]``) until none changes,
which takes the logarithm of the longest chain; each token then points to the terminal token of
its group, and the terminal numbers are the labels of the groups.

**Links** are the pairs of an A and a B occurrence that end together: one per group. How often
an id pair is linked in the whole corpus is a grouped sum over the documents' distinct
pairs, summed up per document and per task before the shuffle.

Texts are encoded once and whole. They are handed to the tokenizers in pieces cut before a space
between two letters, where both vocabularies cut anyway (A's pattern lets no token go on over
it; :class:`Tokens` checks that no piece of B does), so a group ends there and a slice of pieces
is aligned on its own: memory is bounded by ``SLICE_CHARS``, not by the text. Only a stretch
without such a place is handed over whole, whatever its length. Both also cut before any other
single space between two characters. The parts between these places are tokenized where a task
meets them first, and their ids laid out for each occurrence; the alignment then meets every
token of every text.

Defined results: a null or empty text has no tokens, and neither has one whose tokens do not spell
the bytes of space and text (such as a text with U+2581, which B reads as a space): all its
counts are 0 and the digest column is ''. Repeated rows and null ids stay rows of their own
and their links count each time. An empty table has no rows and no counts. The strings of
special tokens are plain text. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import partial
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.llm.arrays import doc_slices
from msgtriage.session import materialize

PIECE_CHARS = 20_000
SLICE_CHARS = 1 << 20
KEPT_CHARS = 1 << 21  # distinct parts whose ids a task keeps from slice to slice; beyond it all are forgotten
BROADCAST_PAIRS = 2_000_000  # distinct id pairs; beyond this counted number they are joined by a shuffle
_LETTERS = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
_WORDS = re.compile(r" (?=[^\s▁])(?<=[^\s▁] )")  # every place where both cut; a leading literal is found faster than a lookbehind
_SEPARATORS = (",", "|", ";", "")


def byte_of_char() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable Latin-1 ones stand
    for themselves, the other bytes in turn for the characters from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


def read_vocabularies(byte_path: str, piece_path: str) -> tuple[str, bytes]:
    """Contents of the two vocabulary files; read on the driver only."""
    with open(byte_path, encoding="utf-8") as a, open(piece_path, "rb") as b:
        return a.read(), b.read()


class Tokens:
    """The bytes of both vocabularies' tokens; made once on the driver and broadcast."""

    def __init__(self, byte_level: str, piece_model: bytes):
        tokenizer, processor = _tokenizers(byte_level, piece_model)
        of_char = byte_of_char()
        special = {t["content"] for t in json.loads(byte_level).get("added_tokens", [])}
        a_bytes = [b""] * tokenizer.get_vocab_size()
        for token, i in tokenizer.get_vocab().items():
            a_bytes[i] = token.encode() if token in special else bytes(of_char[c] for c in token)
        pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
        b_bytes = [bytes([int(x[3:5], 16)]) if processor.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces)]
        self.cuttable = not any("▁" in x.lstrip("▁") for x in pieces)  # no piece goes on over a space that follows something else
        self.bytes = [pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes)]
        self.lengths = [np.array([len(t) for t in x], np.int64) for x in (a_bytes, b_bytes)]
        self.names = pa.array([f"{i}{s}" for i in range(max(map(len, (a_bytes, b_bytes)))) for s in _SEPARATORS], pa.large_string())


def _tokenizers(byte_level: str, piece_model: bytes) -> tuple:
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(byte_level)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_proto=piece_model)


class Vocabularies:
    """Both tokenizers, built in the task from the files' contents, and their tokens' bytes."""

    def __init__(self, byte_level: str, piece_model: bytes, tokens: Tokens):
        self.a, self.b = _tokenizers(byte_level, piece_model)
        self.cuttable, self.bytes, self.lengths, self.names = tokens.cuttable, tokens.bytes, tokens.lengths, tokens.names
        self.forget()

    def pieces(self, text: str) -> Iterator[str]:
        """Space and text in pieces that begin with a space and are tokenized on their own."""
        whole, at = " " + text, 0
        while self.cuttable and len(whole) - at > 2 * PIECE_CHARS and (place := _LETTERS.search(whole, at + PIECE_CHARS)):
            yield whole[at : place.start()]
            at = place.start()
        yield whole[at:]

    def encode(self, pieces: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per side the ids of all pieces and the number of tokens of each piece. The parts between
        all cuts are tokenized where they are new; their ids are then laid out in text order."""
        if self.kept_chars > KEPT_CHARS:
            self.forget()
        parts = [_WORDS.split(p[1:]) if self.cuttable else [p[1:]] for p in pieces]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        before = len(self.number)
        part = np.fromiter(map(self.number.__getitem__, chain.from_iterable(parts)), np.int64, int(sizes.sum()))
        self.learn(list(islice(self.number, before, None)))
        return [_laid_out(ids, counts, part, sizes) for ids, counts in self.kept]

    def forget(self) -> None:
        """No part is known."""
        self.number = _Numbers()
        self.kept = [(np.empty(0, np.int64), np.empty(0, np.int64))] * 2
        self.kept_chars = 0

    def learn(self, parts: list[str]) -> None:
        """Tokenize parts, joined to pieces of about ``PIECE_CHARS`` again where they may be."""
        runs = _runs(parts, PIECE_CHARS) if self.cuttable else [[x] for x in parts]
        encoders = (
            lambda texts: [e.ids for e in self.a.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)],
            lambda texts: self.b.encode(texts, num_threads=1),
        )
        for side, encode in enumerate(encoders):
            found = [self.kept[side]]
            for run, ids in zip(runs, encode([" ".join(run) for run in runs])):
                ids = np.array(ids, np.int64)
                counts = self.counts_of(run, side, ids)
                found.append(_flat(encode(run)) if counts is None else (ids, counts))
            self.kept[side] = tuple(np.concatenate(x) for x in zip(*found))
        self.kept_chars += sum(map(len, parts))

    def counts_of(self, run: list[str], side: int, ids: np.ndarray) -> np.ndarray | None:
        """Tokens of each part of a joined run; None if they do not spell it and end with its parts."""
        wanted = [(" " + x).encode() for x in run]
        ends, stops = np.cumsum(self.lengths[side][ids]), np.cumsum(np.fromiter(map(len, wanted), np.int64, len(wanted)))
        last = np.searchsorted(ends, stops)
        if len(ids) == 0 or ends[-1] != stops[-1] or not np.array_equal(ends[last], stops) or _joined(self.bytes[side], ids).tobytes() != b"".join(wanted):
            return None
        return np.diff(last, prepend=-1)


class _Numbers(dict):
    """Numbers of strings in the order they are first looked up."""

    def __missing__(self, x: str) -> int:
        self[x] = n = len(self)
        return n


def _runs(parts: list[str], chars: int) -> list[list[str]]:
    """Consecutive parts of about ``chars`` together."""
    runs, size = [], chars
    for x in parts:
        if size >= chars:
            runs.append([])
            size = 0
        runs[-1].append(x)
        size += len(x) + 1
    return runs


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts


def _laid_out(ids: np.ndarray, own: np.ndarray, part: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the parts ``part`` in their order, and how many each run of ``sizes`` parts has."""
    counts, starts = own[part], (np.cumsum(own) - own)[part]
    ends = np.append(0, np.cumsum(counts))
    at = np.repeat(starts - ends[:-1], counts) + np.arange(ends[-1])
    return ids[at], np.diff(ends[np.append(0, np.cumsum(sizes))])


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Terminal token of every token, A's first, then B's; both sides tile the same bytes and no
    token is empty."""
    n = len(a_ends)
    a_over = _owners(b_ends)[a_ends - 1]  # the B token that holds A's last byte
    b_over = _owners(a_ends)[b_ends - 1]
    ahead = b_ends[a_over] > a_ends
    follow = np.concatenate([np.where(ahead, n + a_over, np.arange(n)), b_over])
    while True:
        jumped = follow[follow]
        if np.array_equal(jumped, follow):
            return follow
        follow = jumped


def _owners(ends: np.ndarray) -> np.ndarray:
    """Number of the token that holds each byte."""
    return np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))


def _joined(values: pa.Array, ids: np.ndarray) -> np.ndarray:
    """Bytes of the entries of a binary array, one after the other."""
    data = values.take(pa.array(ids)).buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def _spelled(vocabularies: Vocabularies, pieces: list[str], sides: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Whether both sides' tokens of each piece spell its bytes."""
    wanted = [p.encode() for p in pieces]
    size = np.fromiter(map(len, wanted), np.int64, len(wanted))
    data = np.frombuffer(b"".join(wanted), np.uint8)
    right = np.ones(len(pieces), bool)
    for values, lengths, (ids, counts) in zip(vocabularies.bytes, vocabularies.lengths, sides):
        piece = np.repeat(np.arange(len(pieces)), counts)
        own = np.bincount(piece, lengths[ids], len(pieces)).astype(np.int64)
        spelled = _joined(values, ids)
        if np.array_equal(own, size) and np.array_equal(spelled, data):
            continue
        starts, at = np.cumsum(own) - own, np.cumsum(size) - size
        for k in range(len(pieces)):
            right[k] &= own[k] == size[k] and spelled[starts[k] : starts[k] + own[k]].tobytes() == wanted[k]
    return right


class _Rows:
    """Results of consecutive documents, filled by slices of their pieces."""

    def __init__(self, n: int):
        self.good = np.ones(n, bool)
        self.counts = np.zeros((3, n), np.int64)  # A tokens, B tokens, groups
        self.digests = [hashlib.sha256() for _ in range(n)]
        self.keys = [np.empty(0, np.int64)]  # document * id pairs + id pair
        self.times = [np.empty(0, np.int64)]

    def add(self, v: Vocabularies, pieces: list[str], docs: np.ndarray, last: np.ndarray) -> None:
        """``docs``: the document of each piece; ``last``: whether it is the document's last."""
        sides = v.encode(pieces)
        right = _spelled(v, pieces, sides)
        self.good[docs[~right]] = False
        keep = self.good[docs]
        (a, a_doc), (b, b_doc) = ((ids[np.repeat(keep, n)], np.repeat(np.arange(len(pieces)), n * keep)) for ids, n in sides)
        if len(a) == 0:
            return
        a_ends, b_ends = np.cumsum(v.lengths[0][a]), np.cumsum(v.lengths[1][b])
        label = terminals(a_ends, b_ends)
        ends = np.flatnonzero(label[: len(a)] == np.arange(len(a)))  # A's last token of each group
        number = np.empty(len(a), np.int64)
        number[ends] = np.arange(len(ends))
        group = number[label]
        a_group, b_group = group[: len(a)], group[len(a) :]
        b_last = np.flatnonzero(np.diff(b_group, append=len(ends)))
        b_first = np.append(0, b_last[:-1] + 1)

        # ids in the order of groups, A's before B's, each with what follows it
        a_at = np.arange(len(a)) + b_first[a_group]
        b_at = np.arange(len(b)) + (ends + 1)[b_group]
        ids, follows = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
        ids[a_at], ids[b_at] = a, b
        follows[a_at[ends]] = 1
        follows[b_at[b_last]] = 2
        stop = np.cumsum((sides[0][1] + sides[1][1]) * keep)
        follows[stop[last & keep] - 1] = 3
        names = v.names.take(pa.array(ids * len(_SEPARATORS) + follows))
        offsets = np.frombuffer(names.buffers()[1], np.int64)
        text = memoryview(names.buffers()[2])
        begin = np.append(0, stop[:-1])
        for k in np.flatnonzero(keep):
            self.digests[docs[k]].update(text[offsets[begin[k]] : offsets[stop[k]]])

        of_group = docs[a_doc[ends]]
        for k, of in enumerate((docs[a_doc], docs[b_doc], of_group)):
            self.counts[k] += np.bincount(of, minlength=self.counts.shape[1])
        pairs = len(v.lengths[0]) * len(v.lengths[1])
        keys, times = np.unique(of_group * pairs + a[ends] * len(v.lengths[1]) + b[b_last], return_counts=True)
        self.keys.append(keys)
        self.times.append(times)

    def batch(self, v: Vocabularies, row: pa.Array, doc_id: pa.Array) -> pa.RecordBatch:
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        if len(self.keys) > 2:  # documents over several slices
            keys, where = np.unique(keys, return_inverse=True)
            times = np.bincount(where, times, len(keys)).astype(np.int64)
        doc, pair = np.divmod(keys, len(v.lengths[0]) * len(v.lengths[1]))
        doc, pair, times = (x[self.good[doc]] for x in (doc, pair, times))
        offsets = pa.array(np.searchsorted(doc, np.arange(len(self.good) + 1)).astype(np.int32))
        a, b, groups = self.counts * self.good
        digests = [d.hexdigest() if n else "" for d, n in zip(self.digests, a)]
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, t)) for x, t in ((pair, pa.int64()), (times, pa.int64()))]
        return pa.record_batch([row, doc_id, pa.array(a), pa.array(b), pa.array(groups), pa.array(digests, pa.string()), *lists], ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])


def _align(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    v = Vocabularies(*shared.value)
    for batch in batches:
        texts = batch.column("text")
        for lo, hi, *_ in doc_slices(texts, SLICE_CHARS):
            out = _Rows(hi - lo)
            pieces, docs, last, chars = [], [], [], 0
            for k, text in enumerate(texts.slice(lo, hi - lo).to_pylist()):
                if not text:
                    continue
                for piece in v.pieces(text):
                    if chars > SLICE_CHARS:
                        out.add(v, pieces, np.array(docs), np.array(last))
                        pieces, docs, last, chars = [], [], [], 0
                    pieces.append(piece)
                    docs.append(k)
                    last.append(False)
                    chars += len(piece)
                last[-1] = True
            if pieces:
                out.add(v, pieces, np.array(docs), np.array(last))
            yield out.batch(v, batch.column("row").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo))


def align(docs: DataFrame, byte_level: str, piece_model: bytes) -> DataFrame:
    """The stored alignment: ``row`` (a number of the row), ``doc_id, n_a, n_b, n_groups,
    groups_sha256`` and the document's distinct linked id pairs with how often each is linked
    (``pairs``: A id times the size of B's vocabulary plus B id; ``times``)."""
    shared = docs.sparkSession.sparkContext.broadcast((byte_level, piece_model, Tokens(byte_level, piece_model)))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"
    return materialize(rows.mapInArrow(partial(_align, shared=shared), schema), "alignment")


def _links(aligned: DataFrame) -> DataFrame:
    return aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF("row", "pair", "times")


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """The stored table of all linked id pairs: ``pair, a_id, b_id, count, best``, the last telling
    whether no other pair of this B id has a higher count. A B id has no more pairs than A's
    vocabulary has ids."""
    counts = _links(aligned).groupBy("pair").agg(F.sum("times").alias("count"))
    counts = counts.select("pair", F.expr(f"pair div {b_size}").alias("a_id"), (F.col("pair") % b_size).alias("b_id"), "count")
    best = F.col("count") == F.max("count").over(Window.partitionBy("b_id"))
    return materialize(counts.withColumn("best", best), "alignment-pairs")


def report(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document the counts of its tokens, groups and links, ``n_best`` (links with a best pair),
    ``count_sum`` (the corpus-wide counts of its links' pairs) and the groups' digest."""
    counts = counts.select("pair", "count", "best")
    if counts.count() <= BROADCAST_PAIRS:
        counts = F.broadcast(counts)
    per = _links(aligned).join(counts, "pair").groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")
    )
    out = aligned.drop("pairs", "times").join(per, F.col("row") == F.col("of"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")


def piece_count(piece_model: bytes) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=piece_model).get_piece_size()
