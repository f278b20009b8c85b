"""Dictionary-driven text operators as joins.

The reference calls per-row NLP libraries (lemmatiser, POS tagger, NE
chunker, spell checker). Here each is a join of the exploded tokens with a
caller-supplied lexicon DataFrame, then a per-document aggregate.

Join strategy: a lexicon is broadcast only when its row count, measured
first, is within ``broadcast_rows``; otherwise it is a shuffle join, where
AQE's skew handling splits the partition of a very frequent token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgtriage.functions.text import sentences, tokenize
from msgtriage.operators.features import explode_tokens
from msgtriage.schema import ENTITY_TYPES, NOUN_TAGS, STARTING_VERB_TAGS, VERB_TAGS

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024


def _field_bytes(field) -> Column:
    """Approximate in-memory bytes of one column value."""
    from pyspark.sql import types as T

    c, t = F.col(f"`{field.name}`"), field.dataType
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(t, T.ArrayType):
        inner = 8 if not isinstance(t.elementType, T.StringType) else 24
        return F.coalesce(F.size(c), F.lit(0)) * inner + 16
    return F.lit(8)


def measured_size(df: DataFrame) -> tuple[int, int]:
    """``(rows, approximate bytes)`` of ``df`` in one aggregate job."""
    width = None
    for f in df.schema.fields:
        b = _field_bytes(f)
        width = b if width is None else width + b
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def sized_side(
    lexicon: DataFrame,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast ``lexicon`` only if its measured rows and bytes are within the bounds;
    otherwise return it unchanged for a shuffle join (AQE splits hot keys)."""
    if should_broadcast(lexicon, broadcast_rows, broadcast_bytes):
        return F.broadcast(lexicon)
    return lexicon


def should_broadcast(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    n, b = measured_size(df)
    return n <= max_rows and b <= max_bytes


# --------------------------------------------------------------------------
# I7 lemmatise
# --------------------------------------------------------------------------


def lemmatize_long(
    df: DataFrame, lexicon: DataFrame, key: str = "id", tokens: str = "tokens",
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``(key, pos, lemma)``: each token replaced by its lemma when listed."""
    long = explode_tokens(df, key, tokens, "token", pos="pos")
    lex = sized_side(lexicon.select("form", "lemma"), broadcast_rows)
    return long.join(lex, long["token"] == lex["form"], "left").select(
        key, "pos", F.coalesce(F.col("lemma"), F.col("token")).alias("lemma")
    )


def lemmatize(
    df: DataFrame, lexicon: DataFrame, key: str = "id", tokens: str = "tokens",
    out: str = "lemmas", broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``(key, out)`` with the lemma array in token order.

    The regroup is per document (bounded by one document's length), ordered
    by position; documents without tokens get an empty array.
    """
    long = lemmatize_long(df, lexicon, key, tokens, broadcast_rows)
    grouped = long.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("pos", "lemma"))).alias("_pl")
    )
    return df.select(key).join(grouped, key, "left").select(
        key,
        F.coalesce(
            F.transform("_pl", lambda s: s["lemma"]), F.array().cast("array<string>")
        ).alias(out),
    )


def suffix_lemma_lexicon(tokens_long: DataFrame, token: str = "token") -> DataFrame:
    """Synthetic lexicon for fixtures: forms longer than 3 letters ending in
    ``s`` map to the form without the ``s``."""
    forms = tokens_long.select(F.col(token).alias("form")).distinct()
    return forms.where(
        (F.length("form") > 3) & F.col("form").endswith("s")
    ).select("form", F.expr("substring(form, 1, length(form) - 1)").alias("lemma"))


# --------------------------------------------------------------------------
# I12 / I13 part-of-speech lexicon
# --------------------------------------------------------------------------


def tag_lexicon(tagged: DataFrame, token: str = "token", tag: str = "tag") -> DataFrame:
    """Most frequent tag per token from a tagged corpus ``(token, tag)``
    (ties by tag name). Partial aggregation on ``(token, tag)`` first."""
    counts = tagged.groupBy(token, tag).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(token).agg(
        F.min(F.struct(F.negative(F.col("n")).alias("nn"), F.col(tag).alias("t"))).alias("_b")
    )
    return best.select(F.col(token).alias("token"), F.col("_b.t").alias("tag"))


def verb_noun_counts(
    df: DataFrame, lexicon: DataFrame, key: str = "id", tokens: str = "tokens",
    verb_tags: Sequence[str] = VERB_TAGS, noun_tags: Sequence[str] = NOUN_TAGS,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """``(key, n_verbs, n_nouns)``; untagged tokens count as neither. A lexicon beyond the
    broadcast bounds meets each document's distinct tokens with their counts, so a frequent token
    has a row per document, not one per occurrence, in the task that joins it."""
    counts = verb_noun_hits(df, lexicon, [key], tokens, verb_tags, noun_tags, broadcast_rows, broadcast_bytes)
    return df.select(key).join(counts, key, "left").select(
        key,
        F.coalesce("n_verbs", F.lit(0)).cast("bigint").alias("n_verbs"),
        F.coalesce("n_nouns", F.lit(0)).cast("bigint").alias("n_nouns"),
    )


def verb_noun_hits(
    df: DataFrame, lexicon: DataFrame, keys: Sequence[str], tokens: str = "tokens",
    verb_tags: Sequence[str] = VERB_TAGS, noun_tags: Sequence[str] = NOUN_TAGS,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """``(*keys, n_verbs, n_nouns)`` where there is a verb or a noun; a count without any is null. Other
    tags of the lexicon change nothing and stay out of the join."""
    long = explode_tokens(df, keys, tokens, "token")
    lex = lexicon.select("token", "tag").where(F.col("tag").isin(*verb_tags, *noun_tags))
    if should_broadcast(lex, broadcast_rows, broadcast_bytes):
        long, lex = long.withColumn("_n", F.lit(1)), F.broadcast(lex)
    else:
        long = long.groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("_n"))
    return long.join(lex, "token", "inner").groupBy(*keys).agg(
        F.sum(F.when(F.col("tag").isin(*verb_tags), F.col("_n"))).alias("n_verbs"),
        F.sum(F.when(F.col("tag").isin(*noun_tags), F.col("_n"))).alias("n_nouns"),
    )


def sentence_first_tokens(text: Column | str, variant: str | None = "train") -> Column:
    """First token (after cleaning) of every sentence; empty sentences skipped."""
    firsts = F.transform(sentences(text), lambda s: F.try_element_at(tokenize(s, variant), F.lit(1)))
    return F.filter(firsts, lambda t: t.isNotNull())


def starting_verb(
    df: DataFrame, lexicon: DataFrame, key: str = "id", text: str = "message",
    variant: str | None = "train", tags: Sequence[str] = STARTING_VERB_TAGS,
    match_rt: bool = False, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``(key, starting_verb)``: does any sentence start with a verb tag
    (or, with ``match_rt``, the token ``rt``)."""
    flags = starting_verb_hits(df, lexicon, [key], text, variant, tags, match_rt, broadcast_rows)
    return df.select(key).join(flags, key, "left").select(
        key, (F.coalesce(F.col("_f"), F.lit(0)) == 1).alias("starting_verb")
    )


def starting_verb_hits(
    df: DataFrame, lexicon: DataFrame, keys: Sequence[str], text: str = "message",
    variant: str | None = "train", tags: Sequence[str] = STARTING_VERB_TAGS,
    match_rt: bool = False, broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``(*keys, _f)`` of the rows that have a sentence, ``_f`` 1 or 0. Other tags of the lexicon change
    nothing and stay out of the join."""
    firsts = df.select(*keys, sentence_first_tokens(text, variant).alias("_first"))
    long = explode_tokens(firsts, keys, "_first", "token")
    lex = sized_side(lexicon.select("token", "tag").where(F.col("tag").isin(*tags)), broadcast_rows)
    hit = F.col("tag").isNotNull()
    if match_rt:
        hit = hit | (F.col("token") == "rt")
    return long.join(lex, "token", "left").groupBy(*keys).agg(
        F.max(hit.cast("int")).alias("_f")
    )


def last_letter_tags(tokens_long: DataFrame, token: str = "token") -> DataFrame:
    """Synthetic tagged corpus for fixtures: the tag follows the last letter."""
    last = F.substring(F.col(token), -1, 1)
    tag = (
        F.when(last == "d", "VBD").when(last == "g", "VBG").when(last == "n", "VBN")
        .when(last == "z", "VBZ").when(last == "e", "VB").when(last == "p", "VBP")
        .when(last.isin("a", "o", "u"), "NN").when(last == "r", "NNP").otherwise("JJ")
    )
    return tokens_long.select(F.col(token).alias("token"), tag.alias("tag"))


# --------------------------------------------------------------------------
# I14 named entities by gazetteer
# --------------------------------------------------------------------------


def ngrams_upto(tokens: Column | str, n: int) -> Column:
    """All 1..n-grams of a token array, space joined."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    parts = [t]
    size = F.size(t)
    def gram_at(k):
        return lambda i: F.concat_ws(" ", *[F.element_at(t, i + j) for j in range(k)])

    for k in range(2, n + 1):
        grams = F.transform(F.sequence(F.lit(1), size - (k - 1)), gram_at(k))
        parts.append(F.when(size >= k, grams).otherwise(F.array().cast("array<string>")))
    return F.concat(*parts)


def entity_flags(
    df: DataFrame, gazetteer: DataFrame, key: str = "id", tokens: str = "tokens",
    max_ngram: int = 3, types: Sequence[str] = ENTITY_TYPES,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """``(key, <type>...)`` presence flags (0/1) from a ``(phrase, type)``
    gazetteer matched against 1..max_ngram token n-grams."""
    grams = df.select(key, ngrams_upto(tokens, max_ngram).alias("_g"))
    long = explode_tokens(grams, key, "_g", "phrase")
    gaz = sized_side(gazetteer.select("phrase", "type"), broadcast_rows)
    flags = long.join(gaz, "phrase", "inner").groupBy(key).agg(
        *[F.max((F.col("type") == t).cast("int")).alias(t) for t in types]
    )
    return df.select(key).join(flags, key, "left").select(
        key, *[F.coalesce(F.col(t), F.lit(0)).alias(t) for t in types]
    )


def length_gazetteer(tokens_long: DataFrame, token: str = "token") -> DataFrame:
    """Synthetic gazetteer for fixtures: the entity type follows token length."""
    n = F.length(F.col(token))
    typ = F.when(n == 11, "GPE").when(n == 12, "PERSON").when(n >= 13, "ORGANIZATION")
    return (
        tokens_long.select(F.col(token).alias("phrase"), typ.alias("type"))
        .where(F.col("type").isNotNull())
        .distinct()
    )


# --------------------------------------------------------------------------
# I15 spell check
# --------------------------------------------------------------------------


def _segment(word: Column, i: Column, length: Column, parts: int, shift: Column) -> Column:
    """Piece ``i`` (from 0) of ``parts`` pieces of a ``length``-letter word, read ``shift`` letters on."""
    start, end = F.floor(i * length / parts), F.floor((i + 1) * length / parts)
    return F.when(start + shift >= 0, F.substring(word, (start + shift + 1).cast("int"), (end - start).cast("int")))


def _segment_key(length: Column, i: Column, piece: Column) -> Column:
    return F.concat_ws(":", length.cast("string"), i.cast("string"), piece)


def own_segments(word: Column, max_edits: int = 2) -> Column:
    """Keys of a known word: its ``max_edits + 1`` pieces with their place and the word's length."""
    n, parts = F.length(word), max_edits + 1
    return F.transform(F.sequence(F.lit(0), F.lit(max_edits)), lambda i: _segment_key(n, i, _segment(word, i, n, parts, F.lit(0))))


def reachable_segments(word: Column, max_edits: int = 2) -> Column:
    """Keys of all known words that ``max_edits`` edits can reach share one of these.

    Of ``max_edits + 1`` pieces one is untouched by the edits; it stands in ``word`` at
    most ``max_edits`` letters from its place. The number of keys does not depend on the word's length."""
    n, parts = F.length(word), max_edits + 1
    lengths = F.sequence(F.greatest(n - max_edits, F.lit(1)), n + max_edits)
    keys = F.transform(
        lengths,
        lambda m: F.transform(
            F.sequence(F.lit(0), F.lit(max_edits)),
            lambda i: F.transform(
                F.sequence(F.lit(-max_edits), F.lit(max_edits)),
                lambda d: F.when(
                    F.length(_segment(word, i, m, parts, d)) == F.floor((i + 1) * m / parts) - F.floor(i * m / parts),
                    _segment_key(m, i, _segment(word, i, m, parts, d)),
                ),
            ),
        ),
    )
    return F.array_distinct(F.array_compact(F.flatten(F.flatten(keys))))


#: Words up to this length are compared by deletion keys (79 for two edits), longer ones by segments.
DELETION_LENGTH = 12


def deletions(word: Column, max_edits: int = 2) -> Column:
    """``word`` with up to ``max_edits`` letters deleted, distinct.

    Two words within ``max_edits`` edits share one: what is left of each when the letters
    replaced, added or missing are deleted."""
    level, levels = F.array(word), [F.array(word)]
    for _ in range(max_edits):
        shorter = F.transform(
            level,
            lambda w: F.transform(
                # a sequence down to 0 for the empty word: its only entry leaves it as it is
                F.sequence(F.least(F.length(w), F.lit(1)), F.length(w)),
                lambda i: F.concat(F.substring(w, F.lit(1), F.greatest(i - 1, F.lit(0))), F.substring(w, i + 1, F.length(w))),
            ),
        )
        level = F.array_distinct(F.flatten(shorter))
        levels.append(level)
    return F.array_distinct(F.concat(*levels))


def spell_suggestions(
    words: DataFrame, vocabulary: DataFrame, max_edits: int = 2
) -> DataFrame:
    """For each distinct unknown word, the most likely known correction.

    ``words``: ``(word)`` to check; ``vocabulary``: ``(word, freq)`` known
    words. Unknown = not in the vocabulary (``left_anti``). Candidates come
    from a join on hashed keys (no vocabulary x word cross product): unknown words
    up to ``DELETION_LENGTH`` letters by what is left after deleting letters on both sides,
    longer ones by shared segments; words longer than any known word + ``max_edits`` have none.
    They are verified with ``levenshtein <= max_edits`` where they meet, and the best is the smallest
    distance, then the highest frequency, then the word. Words without a
    candidate keep themselves as suggestion with a NULL distance.
    """
    vocab = vocabulary.select("word", "freq").distinct()
    unknown = words.select("word").distinct().join(vocab.select("word"), "word", "left_anti")
    longest = vocab.agg(F.coalesce(F.max(F.length("word")), F.lit(0))).first()[0]
    known = vocab.select(F.col("word").alias("cand"), "freq")
    n, m, w, c = F.length("word"), F.length("cand"), F.col("word"), F.col("cand")
    none = F.lit(None).cast("array<string>")
    # one column of keys for both kinds, so that the unknown words are one exchange, read again for the result
    word_keys = F.when(n <= DELETION_LENGTH, deletions(w, max_edits)).when(n <= longest + max_edits, reachable_segments(w, max_edits)).otherwise(none)
    deleted = F.when(m <= DELETION_LENGTH + max_edits, deletions(c, max_edits)).otherwise(F.array().cast("array<string>"))
    cut = F.when(m > DELETION_LENGTH - max_edits, own_segments(c, max_edits)).otherwise(F.array().cast("array<string>"))
    uk = explode_tokens(unknown.select("word", word_keys.alias("_keys")), "word", "_keys", "_k")
    vk = known.select("cand", "freq", F.explode_outer(F.concat(deleted, cut)).alias("_k"))
    uk, vk = (x.withColumn("_k", F.xxhash64("_k")) for x in (uk, vk))  # equal hashes only add candidates
    near = uk.join(vk, "_k").where(F.abs(n - m) <= max_edits).withColumn("dist", F.levenshtein("word", "cand", max_edits))
    best = near.where(F.col("dist") >= 0).groupBy("word").agg(F.min(F.struct("dist", F.negative(F.col("freq")).alias("nf"), "cand")).alias("_b"))
    return unknown.join(best, "word", "left").select(
        "word",
        F.coalesce(F.col("_b.cand"), F.col("word")).alias("suggestion"),
        F.col("_b.dist").alias("distance"),
        F.negative(F.col("_b.nf")).alias("freq"),
    )
