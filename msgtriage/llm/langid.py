"""Language identification with segmentation-marginalised unigrams.

Over the pieces of a fixed public vocabulary every language has its own piece
probabilities. A word's probability under a language is the sum over all its
segmentations into pieces, by a forward algorithm; a text's is the product over its
words, times the language's share of the training rows. The posterior of the best language is
the score. It only weighs the learned languages against each other; the *fit* says whether the text
is in the best of them at all: the mean over its words of the log-likelihood above what
words of their length have in that language's training rows, in standard deviations of such
words, plus four standard errors.

Words are runs of letters, lower-cased, cut every ``MAX_WORD`` letters (so no text is
dropped and a run without spaces costs no more than its length); a word starts with
the vocabulary's word mark. A letter that no piece covers counts as one rare piece.
All distinct words of a batch go through the forward algorithm together, and each
worker keeps the words it has scored (``CACHE_WORDS`` at most, then it starts anew).

Piece probabilities come from expectation maximisation over the training rows'
words: each step is a Spark job whose result is one number per language and piece.
The rows are at most about ``max_rows`` per language, chosen by a hash of the text, so the
fit does not grow with the corpus.

Defined results: a null text, or one without a letter, is ``und`` with score 0; rows
without a language teach nothing; with no training rows at all every text is ``und``;
repeated rows count as often as they occur; ties go to the first language in code point
order. Columns other than the text (and, in training, the language) are not read;
:func:`predict` keeps all columns.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgtriage.llm.arrays import release_memory
from msgtriage.session import materialize

UNKNOWN = "und"
MARK = "▁"
MAX_WORD = 24
MAX_PIECE = 12
CACHE_WORDS = 200_000
WORDS_TIMES_LANGUAGES = 40_000  # words that go through the forward algorithm at once, times languages
MAX_ROWS = 3000
ROUNDS = 3
FLOOR = 1e-8  # probability of a letter outside the vocabulary, and of an unseen piece
_LETTERS = re.compile(r"[^\W\d_]+")
_WORD = re.compile(r"[^\W\d_]{1,%d}" % MAX_WORD)
_TABLE_BITS = 18
_BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_pieces(path: str) -> list[str]:
    """Pieces of letters (an initial word mark allowed) of a public sentencepiece model,
    as single lower-cased strings of at most ``MAX_PIECE`` characters. Read on the driver only."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in found if len(p) <= MAX_PIECE and (p == MARK or _LETTERS.fullmatch(p.removeprefix(MARK))))


def words_of(text: str | None) -> list[str]:
    """The words of a text, each at most ``MAX_WORD`` letters."""
    return _WORD.findall(text.lower()) if text else []


class PieceTable:
    """Finds pieces as substrings of many words at once, by rolling hashes."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        code, n = self._codes(pieces, self.longest)
        h = self._prefix(code)[np.arange(len(pieces)), n]
        slot = self._slots(h)
        order = np.argsort(slot, kind="stable")
        self.hash, self.id, slot = h[order], order, slot[order]
        self.first = np.searchsorted(slot, np.arange((1 << _TABLE_BITS) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.first).max(initial=0))

    @staticmethod
    def _codes(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
        n = np.fromiter(map(len, words), np.int64, len(words))
        code = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width) if len(words) else np.zeros((0, width), np.uint32)
        return code.astype(np.uint64), n

    @staticmethod
    def _prefix(code: np.ndarray) -> np.ndarray:
        h = np.zeros((len(code), code.shape[1] + 1), np.uint64)
        for k in range(code.shape[1]):
            h[:, k + 1] = h[:, k] * _BASE + code[:, k] + np.uint64(1)
        return h

    @staticmethod
    def _slots(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 where there is none."""
        slot = self._slots(h)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.full(len(h), -1, np.int64)
        for _ in range(self.deepest):
            open_ = np.flatnonzero(at < end)
            if not len(open_):
                break
            hit = open_[self.hash[at[open_]] == h[open_]]
            out[hit] = self.id[at[hit]]
            at[open_] += 1
        return out

    def spans(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(end, length, word rows, piece ids) of all pieces in marked words, by end."""
        marked = [MARK + w for w in words]
        code, n = self._codes(marked, MAX_WORD + 1)
        h = self._prefix(code)
        powers = np.cumprod(np.array([1] + [_BASE] * self.longest, np.uint64))
        for end in range(1, int(n.max(initial=0)) + 1):
            live = np.flatnonzero(n >= end)
            for size in range(1, min(self.longest, end) + 1):
                ids = self.find(h[live, end] - h[live, end - size] * powers[size])
                hit = ids >= 0
                yield end, size, live[hit], ids[hit]


def forward(table: PieceTable, prob: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray, list]:
    """Forward sums over all segmentations: (alpha [word, position, language], lengths, spans)."""
    n = np.fromiter(map(len, words), np.int64, len(words)) + 1
    alpha = np.zeros((len(words), MAX_WORD + 2, prob.shape[1]))
    alpha[:, 0] = 1.0
    used, before = [], 0
    for end, size, rows, ids in table.spans(words):
        if end != before:  # a letter without a piece is one rare piece; the mark alone is free
            alpha[:, end] += alpha[:, end - 1] * (FLOOR if end > 1 else 1.0)
            before = end
        alpha[rows, end] += alpha[rows, end - size] * prob[ids]
        used.append((end, size, rows, ids))
    return alpha, n, used


def word_scores(table: PieceTable, prob: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of each word under each language."""
    alpha, n, _ = forward(table, prob, words)
    return np.log(alpha[np.arange(len(words)), n])


def expected_counts(table: PieceTable, prob: np.ndarray, words: list[str], lang: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations, [piece, language], of words that
    occur ``count`` times in language ``lang``."""
    alpha, n, used = forward(table, prob, words)
    row = np.arange(len(words))
    a = alpha[row, :, lang]
    beta = np.zeros_like(a)
    beta[row, n] = 1.0
    total = np.zeros(prob.shape)
    scale = count / a[row, n]
    before = None
    for end, size, rows, ids in reversed(used):
        if before is not None and end != before:
            beta[:, before - 1] += beta[:, before] * (FLOOR if before > 1 else 1.0)
        before = end
        p = prob[ids, lang[rows]]
        np.add.at(total, (ids, lang[rows]), a[rows, end - size] * p * beta[rows, end] * scale[rows])
        beta[rows, end - size] += p * beta[rows, end]
    return total


class Model:
    """Languages, their log priors and piece probabilities; small and sent to all tasks."""

    def __init__(self, langs: list[str], prior: np.ndarray, pieces: list[str], prob: np.ndarray, mean: np.ndarray | None = None, spread: np.ndarray | None = None):
        self.langs, self.prior, self.pieces, self.prob = langs, prior, pieces, prob
        self.mean = np.zeros(len(langs)) if mean is None else mean  # log-likelihood of a letter
        self.spread = np.ones(len(langs)) if spread is None else spread  # of a word, about its letters' means
        self.key = uuid.uuid4().hex


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by: dict[str, Counter] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            by.setdefault(lang, Counter()).update(words_of(text))
        for lang, words in by.items():
            yield pa.record_batch({"lang": pa.array([lang] * len(words), pa.string()), "word": pa.array(words.keys(), pa.string()), "n": pa.array(words.values(), pa.int64())})


def _expect(batches: Iterator[pa.RecordBatch], langs: list[str], pieces: list[str], prob: np.ndarray) -> Iterator[pa.RecordBatch]:
    table, total = PieceTable(pieces), np.zeros(prob.shape)
    place = {lang: k for k, lang in enumerate(langs)}
    for batch in batches:
        lang = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
        total += expected_counts(table, prob, batch.column("word").to_pylist(), lang, batch.column("n").to_numpy())
    piece, lang = np.nonzero(total)
    yield pa.record_batch({"piece": pa.array(piece, pa.int32()), "lang": pa.array(lang, pa.int32()), "n": pa.array(total[piece, lang])})


def _usual(batches: Iterator[pa.RecordBatch], langs: list[str], pieces: list[str], prob: np.ndarray) -> Iterator[pa.RecordBatch]:
    table, total = PieceTable(pieces), np.zeros((len(langs), 6))
    place = {lang: k for k, lang in enumerate(langs)}
    for batch in batches:
        words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
        if not words:
            continue
        lang = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
        size = np.fromiter(map(len, words), float, len(words))
        own = word_scores(table, prob, words)[np.arange(len(words)), lang]
        np.add.at(total, lang, n[:, None] * np.stack([np.ones_like(size), size, own, size * size, size * own, own * own], axis=1))
    yield pa.record_batch({"lang": pa.array(range(len(langs)), pa.int32()), "sums": pa.array(total.tolist(), pa.list_(pa.float64()))})


def fit(rows: DataFrame, pieces: list[str], max_rows: int = MAX_ROWS, rounds: int = ROUNDS) -> Model:
    """Learn from ``(text, lang)`` rows with a language."""
    rows = rows.select("text", "lang").where("lang is not null")
    counts = rows.groupBy("lang").count().orderBy("lang").collect()  # a row per language
    langs = [r["lang"] for r in counts]
    n = np.array([r["count"] for r in counts], float)
    if not langs:
        return Model([], np.empty(0), pieces, np.empty((len(pieces), 0)))
    part = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, max_rows / r["count"]))])
    chance = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    words = rows.where(chance < part[F.col("lang")]).mapInArrow(_count_words, "lang string, word string, n long")
    words = materialize(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    # start: long pieces are rarer than the product of short ones would make them
    start = 0.2 ** np.fromiter((len(p.removeprefix(MARK)) + 1.0 for p in pieces), float, len(pieces))
    prob = np.repeat((start / start.sum())[:, None], len(langs), axis=1)
    for _ in range(rounds):
        seen = words.mapInArrow(partial(_expect, langs=langs, pieces=pieces, prob=prob), "piece int, lang int, n double")
        seen = seen.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()  # pieces x languages at most
        total = np.full(prob.shape, 0.01)
        total[seen["piece"].to_numpy(), seen["lang"].to_numpy()] += seen["n"].to_numpy()
        prob = np.maximum(total / total.sum(axis=0), FLOOR * 1e-2)
    sums = np.zeros((len(langs), 6))
    for r in words.mapInArrow(partial(_usual, langs=langs, pieces=pieces, prob=prob), "lang int, sums array<double>").toLocalIterator():  # a row per task and language
        sums[r["lang"]] += r["sums"]
    count, size, own, size2, both, own2 = sums.T
    count, size = np.maximum(count, 1.0), np.maximum(size, 1.0)
    mean = own / size
    spread = np.sqrt(np.maximum(own2 - 2 * mean * both + mean * mean * size2, 0) / count)
    return Model(langs, np.log(n / n.sum()), pieces, prob, mean, np.maximum(spread, 1.0))


class _Scorer:
    """Word scores of one model, kept between the batches and tasks of a worker."""

    kept: "dict[str, _Scorer]" = {}

    def __init__(self, model: Model):
        self.model, self.table = model, PieceTable(model.pieces)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.empty((1 << 14, len(self.model.langs)))

    @classmethod
    def of(cls, model: Model) -> "_Scorer":
        if model.key not in cls.kept:
            cls.kept = {model.key: cls(model)}
        return cls.kept[model.key]

    def places(self, words: list[list[str]]) -> list[np.ndarray]:
        fresh = {w for ws in words for w in ws}
        if len(self.place) + len(fresh) > CACHE_WORDS:
            self.clear()
        fresh = sorted(fresh.difference(self.place), key=len)
        step = max(256, WORDS_TIMES_LANGUAGES // self.rows.shape[1])
        for a in range(0, len(fresh), step):
            some, k = fresh[a : a + step], len(self.place)
            if k + len(some) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty((max(len(self.rows), len(some)), self.rows.shape[1]))])
            self.rows[k : k + len(some)] = word_scores(self.table, self.model.prob, some)
            self.place.update(zip(some, range(k, k + len(some))))
        get = self.place.__getitem__
        return [np.fromiter(map(get, ws), np.int64, len(ws)) for ws in words]


def _predict(batches: Iterator[pa.RecordBatch], shared, text: str, names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    scorer = _Scorer.of(model) if model.langs else None
    for batch in batches:
        lang, score, fits = [], [], []
        texts = batch.column(text)
        for lo in range(0, len(batch), 256):
            words = [words_of(t) for t in texts.slice(lo, 256).to_pylist()]
            for own, at in zip(words, scorer.places(words) if scorer else [()] * len(words)):
                if not len(at):
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    fits.append(0.0 if own else -np.inf)
                    continue
                likelihood = scorer.rows[at].sum(axis=0)
                total = model.prior + likelihood
                best = int(total.argmax())
                above = likelihood[best] - model.mean[best] * sum(map(len, own))
                fits.append(float(above / (len(own) * model.spread[best]) + 4 / np.sqrt(len(own))))
                lang.append(model.langs[best])
                score.append(float(1.0 / np.exp(total - total[best]).sum()))
        found = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(fits, pa.float64())][: len(names)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, *names])
    release_memory()


def predict(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the best language and its posterior probability as two more columns,
    and with a third name the fit (minus infinity without a letter, 0 where no language is known)."""
    if taken := set(names) & set(docs.columns):
        raise ValueError(f"documents have columns {sorted(taken)} already; choose other names")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*docs.columns, *[F.lit(x).alias(c) for x, c in zip(("", 0.0, 0.0), names)]).schema
    return docs.mapInArrow(partial(_predict, shared=shared, text=text, names=names), schema)
