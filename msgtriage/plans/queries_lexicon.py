"""Queries: lexicon joins (I7, I12-I15) with fixture lexicons derived from the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from msgtriage.operators import features, lexicon
from msgtriage.session import by_key, ensure_parallelism, materialize
from msgtriage.plans.fixtures import table, with_fixtures
from msgtriage.plans.registry import register
from msgtriage.plans.sqltext import tokens_sql


def _doc_tokens(spark, sf_dir, variant="train", spread=ensure_parallelism):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return features.with_tokens(docs, "text", "tokens", variant)


def _toks_cte():
    return ("toks", f"SELECT doc_id, {tokens_sql('text', 'train')} AS t FROM documents")


@register(
    "lemmatized_tokens",
    ("I7", "C4"),
    with_fixtures(
        """SELECT doc_id, array_to_string(list_transform(t, lambda x:
                 CASE WHEN length(x) > 3 AND suffix(x, 's') THEN left(x, length(x) - 1) ELSE x END), ' ')
                 AS lemma_text
           FROM toks""",
        ctes=(_toks_cte(),),
    ),
)
def q_lemmatized(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir)
    lex = lexicon.suffix_lemma_lexicon(features.token_table(toks, "doc_id"))
    lem = lexicon.lemmatize(toks, lex, "doc_id", "tokens", "lemmas")
    return lem.select("doc_id", F.array_join("lemmas", " ").alias("lemma_text"))


@register(
    "verb_noun_counts",
    ("I12", "C4"),
    with_fixtures(
        """SELECT doc_id,
                  CAST(len(list_filter(t, lambda x: right(x, 1) IN ('d', 'g', 'n', 'z', 'e', 'p'))) AS BIGINT) AS n_verbs,
                  CAST(len(list_filter(t, lambda x: right(x, 1) IN ('a', 'o', 'u', 'r'))) AS BIGINT) AS n_nouns
           FROM toks""",
        ctes=(_toks_cte(),),
    ),
)
def q_verb_noun(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir, spread=lambda docs: by_key(docs, "doc_id"))
    tagged = lexicon.last_letter_tags(features.token_table(toks, "doc_id"))
    lex = materialize(lexicon.tag_lexicon(tagged), "tag-lexicon")  # measured, then joined
    return lexicon.verb_noun_counts(toks, lex, "doc_id", "tokens")


@register(
    "starting_verb",
    ("I13", "I9"),
    f"""SELECT doc_id,
               len(list_filter(
                   list_transform(regexp_split_to_array(text, '[.!?]\\s+'), lambda s: ({tokens_sql('s', 'train')})[1]),
                   lambda x: x IS NOT NULL AND (suffix(x, 'e') OR suffix(x, 'p')))) > 0 AS starting_verb
        FROM documents""",
)
def q_starting_verb(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    toks = _doc_tokens(spark, sf_dir)
    tagged = lexicon.last_letter_tags(features.token_table(toks, "doc_id"))
    lex = lexicon.tag_lexicon(tagged)
    return lexicon.starting_verb(docs, lex, "doc_id", "text", "train")


@register(
    "entity_flags",
    ("I14", "C4"),
    with_fixtures(
        """SELECT doc_id,
                  CAST(len(list_filter(t, lambda x: length(x) = 11)) > 0 AS INTEGER) AS GPE,
                  CAST(len(list_filter(t, lambda x: length(x) = 12)) > 0 AS INTEGER) AS PERSON,
                  CAST(len(list_filter(t, lambda x: length(x) >= 13)) > 0 AS INTEGER) AS ORGANIZATION
           FROM toks""",
        ctes=(_toks_cte(),),
    ),
)
def q_entity_flags(spark, sf_dir):
    toks = _doc_tokens(spark, sf_dir)
    gaz = lexicon.length_gazetteer(features.token_table(toks, "doc_id"))
    return lexicon.entity_flags(toks, gaz, "doc_id", "tokens", 3)


def _deletions_sql(words: str) -> str:
    """Words of a query with up to two letters deleted."""
    return f"""SELECT word, word AS k FROM ({words}) a
               UNION SELECT word, substr(word, 1, i - 1) || substr(word, i + 1) FROM ({words}) b, range(1, 15) r(i) WHERE i <= length(word)
               UNION SELECT word, substr(word, 1, i - 1) || substr(word, i + 1, j - i - 1) || substr(word, j + 1)
               FROM ({words}) c, range(1, 15) r(i), range(1, 15) t(j) WHERE i < j AND j <= length(word)"""


@register(
    "spell_suggestions",
    ("I15", "C3"),
    with_fixtures(
        """SELECT u.word, coalesce(b.cand, u.word) AS suggestion,
                  CAST(b.dist AS INTEGER) AS distance, b.freq
           FROM unk u LEFT JOIN (SELECT * FROM ranked WHERE rn = 1) b ON u.word = b.word""",
        ctes=(
            ("dt", f"SELECT DISTINCT unnest({tokens_sql('text', 'train')}) AS word FROM documents"),
            ("bv", f"SELECT word, count(*) AS freq FROM (SELECT unnest({tokens_sql('text', 'train')}) AS word FROM benchmark) x GROUP BY word"),
            ("unk", "SELECT word FROM dt WHERE word NOT IN (SELECT word FROM bv)"),
            # up to 12 letters: candidates share what is left after deleting up to two letters of each
            ("udel", _deletions_sql("SELECT word FROM unk WHERE length(word) <= 12")),
            ("vdel", _deletions_sql("SELECT word FROM bv WHERE length(word) <= 14")),
            # longer words: they share one of three segments of the known word, at most two letters from its place
            ("vseg", """SELECT word, length(word) AS n, i,
                               substr(word, CAST(i * length(word) // 3 + 1 AS BIGINT), CAST((i + 1) * length(word) // 3 - i * length(word) // 3 AS BIGINT)) AS seg
                        FROM bv, range(0, 3) r(i) WHERE length(word) > 10"""),
            ("useg", """SELECT word, n, i, substr(word, CAST(i * n // 3 + d + 1 AS BIGINT), CAST((i + 1) * n // 3 - i * n // 3 AS BIGINT)) AS seg
                        FROM (SELECT word, length(word) + e AS n FROM unk, range(-2, 3) x(e) WHERE length(word) > 12) u, range(0, 3) r(i), range(-2, 3) s(d)
                        WHERE i * n // 3 + d >= 0"""),
            ("met", """SELECT u.word, v.word AS cand FROM udel u JOIN vdel v ON u.k = v.k
                       UNION SELECT u.word, v.word AS cand FROM useg u JOIN vseg v ON u.n = v.n AND u.i = v.i AND u.seg = v.seg"""),
            ("cands", "SELECT met.word, met.cand, bv.freq FROM met JOIN bv ON bv.word = met.cand"),
            ("pairs", "SELECT * FROM (SELECT *, levenshtein(word, cand) AS dist FROM cands) x WHERE dist <= 2"),
            ("ranked", "SELECT *, row_number() OVER (PARTITION BY word ORDER BY dist, freq DESC, cand) AS rn FROM pairs"),
        ),
    ),
)
def q_spell(spark, sf_dir):
    docs = _doc_tokens(spark, sf_dir)
    words = features.token_table(docs, "doc_id").select(F.col("token").alias("word"))
    bench = features.with_tokens(table(spark, sf_dir, "benchmark"), "text", "tokens", "train")
    vocab = (
        features.token_table(bench, "item_id")
        .groupBy(F.col("token").alias("word"))
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    return lexicon.spell_suggestions(words, vocab, 2)
