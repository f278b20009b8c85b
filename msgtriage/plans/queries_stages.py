"""Queries: fitted stages whose output is checked value by value (U2; J3, J9, J10, I12-I14, A8).

Every stage is fitted, saved with its pipeline, loaded and applied to all documents."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from msgtriage.operators import features, models
from msgtriage.operators.lexicon import sized_side
from msgtriage.operators.table_models import (
    EntityCount, GetVerbNounCount, PopulationScaler, SentenceVectorModel, StartingVerbExtractor, TableModel, TermWeightsModel, entity_names,
    with_content_keys,
)
from msgtriage.operators.transformers import TextTokenizer
from msgtriage.plans.fixtures import table, with_fixtures
from msgtriage.plans.queries_ml import FITTED_CTES, FITTED_SQL
from msgtriage.plans.queries_vectors import DIM, _doc_tokens, _vec_ctes, _word_vectors
from msgtriage.plans.registry import r6, register
from msgtriage.plans.sqltext import tokens_sql
from msgtriage.session import discard, ensure_parallelism, materialize, scratch_path


def _reloaded(model: PipelineModel) -> PipelineModel:
    path = scratch_path(SparkSession.active(), "stage-model")
    model.write().overwrite().save(path)
    fitted = [t for s in model.stages if isinstance(s, TableModel) for t in s.tables.values()]
    discard(SparkSession.active(), *(t for t in fitted if hasattr(t, "stored_path")))  # the saved tables are read from here on
    return PipelineModel.load(path)


@register("ml_tfidf_vectors", ("J1", "J2", "J3", "J4", "U3", "A8"), with_fixtures(FITTED_SQL, ctes=FITTED_CTES))
def q_ml_tfidf_vectors(spark, sf_dir):
    """The canonical training features as sparse vectors of the fitted and reloaded ML pipeline, one
    row per stored entry; the terms of an index are the fitted stage's own vocabulary, a table."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("message"))
    stages = models.featurizer("tfidf", vocab_size=None).getStages()
    tokens = materialize(stages[0].transform(ensure_parallelism(docs)).select("id", "tokens"), "document-tokens")
    model = _reloaded(Pipeline(stages=stages[1:]).fit(tokens))
    terms = next(s for s in model.stages if isinstance(s, TermWeightsModel)).tables["vocabulary"].select("index", "term")
    entries = features.vector_entries(model.transform(tokens), "id", "features", sized_side(terms))
    return entries.select("id", "term", r6("weight").alias("weight"))


@register(
    "sentence_vector_stage",
    ("J9", "J10", "U2", "A8"),
    with_fixtures(
        """SELECT doc_id, i, round(v, 6) AS v, round(CASE WHEN sd > 0 THEN (v - m) / sd ELSE 0 END, 6) AS z
           FROM (SELECT *, avg(v) OVER (PARTITION BY i) AS m, stddev_pop(v) OVER (PARTITION BY i) AS sd FROM comps) x""",
        ctes=(
            *_vec_ctes(),
            ("ends", "SELECT doc_id, vector, row_number() OVER (PARTITION BY doc_id ORDER BY pos DESC) AS r FROM hits"),
            ("parts", f"SELECT doc_id, CAST(unnest(range(0, {DIM})) AS INTEGER) AS i, unnest(vector) * pow({DIM}.0, -r) AS x FROM ends"),
            ("sums", "SELECT doc_id, i, sum(x) AS v FROM parts GROUP BY doc_id, i"),
            ("comps", f"""SELECT d.doc_id, d.i, coalesce(s.v, 0) AS v FROM (SELECT doc_id, CAST(unnest(range(0, {DIM})) AS INTEGER) AS i FROM documents) d
                          LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.i = d.i"""),
        ),
    ),
)
def q_sentence_vector_stage(spark, sf_dir):
    """Sentence vectors and their population-standardised form as reloaded stages, a row per component."""
    tokens = materialize(_doc_tokens(spark, sf_dir), "document-tokens").select("doc_id", "tokens")
    sentence = SentenceVectorModel.of(_word_vectors(spark, sf_dir, tokens), DIM)
    scaler = PopulationScaler(inputCol="sentvec", outputCol="scaled")
    found = materialize(_reloaded(Pipeline(stages=[sentence, scaler]).fit(tokens)).transform(tokens).select("doc_id", "sentvec", "scaled"), "sentence-vectors")
    both = F.arrays_zip(vector_to_array("sentvec").alias("v"), vector_to_array("scaled").alias("z"))
    long = found.select("doc_id", F.posexplode(both).alias("i", "c"))
    return long.select("doc_id", "i", r6("c.v").alias("v"), r6(F.col("c.z") + 0.0).alias("z"))


_TAGS = ("CASE {c} WHEN 'd' THEN 'VBD' WHEN 'g' THEN 'VBG' WHEN 'n' THEN 'VBN' WHEN 'z' THEN 'VBZ' WHEN 'e' THEN 'VB' WHEN 'p' THEN 'VBP' "
         "WHEN 'a' THEN 'NN' WHEN 'o' THEN 'NN' WHEN 'u' THEN 'NN' WHEN 'r' THEN 'NNP' ELSE 'JJ' END")  # fmt: skip


def annotated_tokens(tokens):
    """Stand-in annotations of a token corpus: ``tags`` (a token's tag changes with its place, so
    most tokens have several) and ``entities`` of one to three words."""
    tag = F.expr("transform(tokens, (t, i) -> " + _TAGS.format(c="if(i % 2 = 0, right(t, 1), left(t, 1))") + ")")
    entity = F.expr(
        "filter(transform(tokens, (t, i) -> named_struct('phrase', array_join(slice(tokens, i + 1, 1 + length(t) % 3), ' '), "
        "'type', element_at(array('GPE', 'PERSON', 'ORGANIZATION'), 1 + (length(t) + i) % 3), 'long', length(t) >= 9)), e -> e.long)"
    )
    return tokens.withColumns({"tags": tag, "entities": entity})


@register(
    "lexicon_stage_features",
    ("I12", "I13", "I14", "U2", "A8"),
    with_fixtures(
        """SELECT t.doc_id, CAST(coalesce(v.n_verbs, 0) AS INTEGER) AS n_verbs, CAST(coalesce(v.n_nouns, 0) AS INTEGER) AS n_nouns,
                  coalesce(s.starts, FALSE) AS starting_verb, CAST(coalesce(list_contains(e.c.t, 'GPE'), FALSE) AS INTEGER) AS GPE,
                  CAST(coalesce(list_contains(e.c.t, 'PERSON'), FALSE) AS INTEGER) AS PERSON,
                  CAST(coalesce(list_contains(e.c.t, 'ORGANIZATION'), FALSE) AS INTEGER) AS ORGANIZATION
           FROM toks t LEFT JOIN vn v ON v.doc_id = t.doc_id LEFT JOIN sv s ON s.doc_id = t.doc_id LEFT JOIN chosen e ON e.doc_id = t.doc_id""",
        ctes=(
            ("docs", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('RT ', text) ELSE text END AS text FROM documents"),
            ("toks", f"SELECT doc_id, text, {tokens_sql('text', 'train')} AS t FROM docs"),
            ("long", "SELECT doc_id, i, t[i + 1] AS w, t FROM (SELECT doc_id, t, unnest(range(0, len(t))) AS i FROM toks) x"),
            ("tagged", "SELECT w, " + _TAGS.format(c="(CASE WHEN i % 2 = 0 THEN right(w, 1) ELSE left(w, 1) END)") + " AS tag, count(*) AS n FROM long GROUP BY ALL"),
            ("lex", "SELECT w, tag FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY n DESC, tag) AS r FROM tagged) x WHERE r = 1"),
            ("vn", """SELECT doc_id, count(*) FILTER (tag IN ('VB', 'VBN', 'VBD', 'VBP', 'VBZ', 'VBG')) AS n_verbs, count(*) FILTER (tag IN ('NNP', 'NN')) AS n_nouns
                      FROM long JOIN lex ON lex.w = long.w GROUP BY doc_id"""),
            ("firsts", f"SELECT doc_id, unnest(list_transform(regexp_split_to_array(text, '[.!?]\\s+'), lambda s: ({tokens_sql('s', 'train')})[1])) AS w FROM toks"),
            ("sv", "SELECT doc_id, bool_or(firsts.w = 'rt' OR coalesce(tag IN ('VB', 'VBP'), FALSE)) AS starts FROM firsts LEFT JOIN lex ON lex.w = firsts.w WHERE firsts.w IS NOT NULL GROUP BY doc_id"),
            ("gaz", """SELECT phrase, list(DISTINCT type ORDER BY type) AS types FROM (
                         SELECT array_to_string(t[i + 1:i + 1 + length(w) % 3], ' ') AS phrase, ['GPE', 'PERSON', 'ORGANIZATION'][1 + (length(w) + i) % 3] AS type
                         FROM long WHERE length(w) >= 9) x WHERE phrase <> '' GROUP BY phrase"""),
            ("grams", """SELECT doc_id, i, n, array_to_string(t[i + 1:i + n], ' ') AS g FROM long, (SELECT unnest([1, 2, 3]) AS n) k WHERE i + n <= len(t)"""),
            ("best", "SELECT doc_id, i, max(n) AS n, arg_max(types, n) AS types FROM grams JOIN gaz ON gaz.phrase = grams.g GROUP BY doc_id, i"),
            ("chosen", """SELECT doc_id, list_reduce(list_concat([{'s': CAST(-1 AS BIGINT), 'e': CAST(0 AS BIGINT), 't': CAST([] AS VARCHAR[])}],
                              list({'s': CAST(i AS BIGINT), 'e': CAST(i + n AS BIGINT), 't': types} ORDER BY i)),
                            lambda a, m: CASE WHEN m.s >= a.e THEN {'s': m.s, 'e': m.e, 't': list_distinct(list_concat(a.t, m.t))} ELSE a END) AS c
                          FROM best GROUP BY doc_id"""),
        ),
    ),
)
def q_lexicon_stages(spark, sf_dir):
    """Verb and noun counts, starting verbs (``rt`` counts) and entities of all documents, by lexicons
    learned in ``fit`` from an annotated corpus. Every second document is marked as forwarded (``RT``)."""
    text = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("RT "), "text")).otherwise(F.col("text"))
    docs = ensure_parallelism(table(spark, sf_dir, "documents").select("doc_id", text.alias("message")))
    tokens = materialize(TextTokenizer(inputCol="message", outputCol="tokens").transform(docs), "document-tokens", "zstd")
    annotated = annotated_tokens(tokens)  # made where it is read: longer than the tokens
    stages = [GetVerbNounCount(outputCol="verbs_nouns"), StartingVerbExtractor(matchRt=True), EntityCount()]
    # no stage learns from what another adds, so none is applied to the corpus in the fit
    model = _reloaded(PipelineModel(stages=[s.fit(annotated) for s in stages]))
    found = model.transform(with_content_keys(tokens, model.stages))
    counts = [vector_to_array("verbs_nouns")[i].cast("int").alias(n) for i, n in enumerate(("n_verbs", "n_nouns"))]
    return found.select("doc_id", *counts, "starting_verb", *entity_names(F.col("entities_found")))
