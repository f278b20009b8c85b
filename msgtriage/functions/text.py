"""Text cleaning and tokenising as pure Column expressions (no Python UDF).

Every function takes and returns a ``Column`` so Catalyst can fuse the whole
chain into one whole-stage-codegen span next to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgtriage.schema import LABEL_KEYWORDS, URL_PATTERN, stop_words

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_urls(text: ColumnOrName) -> Column:
    """Remove every URL match (case-sensitive, before lower-casing)."""
    return F.regexp_replace(_col(text), URL_PATTERN, "")


def letters_only(text: ColumnOrName) -> Column:
    """I2 + I3: lower-case, strip, every non ``[a-zA-Z]`` character -> space."""
    return F.regexp_replace(F.lower(F.trim(_col(text))), "[^a-zA-Z]", " ")


def split_words(text: ColumnOrName) -> Column:
    """I4: split letters-only text on runs of spaces, dropping empty pieces."""
    return F.filter(F.split(_col(text), " +"), lambda t: t != "")


def drop_words(tokens: ColumnOrName, words: Sequence[str]) -> Column:
    """Remove tokens found in ``words``.

    ``NOT t IN (...)`` with a literal list is rewritten by the optimizer into a
    hash-set lookup, so the cost per token does not grow with the list.
    """
    words = list(words)
    if not words:
        return _col(tokens)
    return F.filter(_col(tokens), lambda t: ~t.isin(*words))


def tokenize(
    text: ColumnOrName,
    variant: str | None = "train",
    strip_urls: bool = True,
) -> Column:
    """I8: URL removal -> lower/strip -> letters only -> split -> stop words.

    ``variant`` picks the stop-word list (``base``, ``short``, ``app``,
    ``train``) or ``None`` to keep every token. Lemmatising (I7) needs a
    lexicon join and is applied by ``operators.lexicon.lemmatize``.
    """
    cleaned = remove_urls(text) if strip_urls else _col(text)
    tokens = split_words(letters_only(cleaned))
    if variant is None:
        return tokens
    return drop_words(tokens, stop_words(variant))


def sentences(text: ColumnOrName) -> Column:
    """Pinned sentence split on ``.``, ``!`` or ``?`` followed by blanks."""
    return F.split(_col(text), r"[.!?]\s+")


def split_note(text: ColumnOrName) -> Column:
    """Keep the text before the first occurrence of ``Note``."""
    return F.substring_index(_col(text), "Note", 1)


def display_name(label: ColumnOrName) -> Column:
    """I16: ``missing_people`` -> ``Missing People``."""
    return F.initcap(F.regexp_replace(_col(label), "_", " "))


def keyword_flags(
    tokens: ColumnOrName, keywords: Sequence[str] = tuple(LABEL_KEYWORDS)
) -> Column:
    """``array<int>`` with 1 where the keyword occurs as a token.

    The token array is first intersected (hash based) with the keyword array,
    so the per-keyword probes run over at most ``len(keywords)`` elements
    instead of over the whole text.
    """
    kw = F.array(*[F.lit(k) for k in keywords])
    hits = F.array_intersect(_col(tokens), kw)
    return F.array(*[F.array_contains(hits, k).cast("int") for k in keywords])
