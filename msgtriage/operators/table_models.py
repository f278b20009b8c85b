"""Spark ML estimators whose fitted state is a table (U2: J1-J3, J9, I12-I14).

Each model keeps its lexicon or vectors as DataFrames, saves them as Parquet beside the usual
metadata and reads them back, so a lexicon of any size never passes through the driver or a
serialised closure. ``transform`` joins and aggregates: every *distinct content* of the input
column has one result, under 128 bits of its SHA-256 as key, which is joined to all rows that
have it. No row id is needed and the same rows give the same vectors however they are partitioned. Vectors are
computed once a content, so rows that repeat (copies drawn by resampling) cost nothing; narrow results are
computed row by row and made distinct after, so that no text moves.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgtriage.operators import lexicon, vectors
from msgtriage.operators.features import explode_tokens, idf_column, ordered_index, term_frequencies, word2vec_stage
from msgtriage.schema import ENTITY_TYPES, NOUN_TAGS, STARTING_VERB_TAGS, VERB_TAGS
from msgtriage.session import materialize


class _TableWriter(MLWriter):
    def __init__(self, model: "TableModel"):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"tables": sorted(self.model.tables)})
        for name, table in self.model.tables.items():
            table.write.parquet(os.path.join(path, "tables", name))


class _TableReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> "TableModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = {name: self.sparkSession.read.parquet(os.path.join(path, "tables", name)) for name in metadata["tables"]}
        model = self.cls(tables)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class TableModel(Model, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """A model over named tables; subclasses compute ``(key, out)`` for distinct contents."""

    #: A result of a few bytes: stored, so that rows need not move to meet it while it fits a broadcast.
    #: ``compute`` then gets a list of keys and may leave out rows whose result is ``none``.
    narrow = False

    def __init__(self, tables: dict[str, DataFrame] | None = None, **params):
        super().__init__()
        self.tables = dict(tables or {})
        self._set(**params)

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)

    def content(self) -> Column:
        """What two rows must share to have the same result, as a string; null counts as no content."""
        return F.array_join(self.getInputCol(), " ")  # tokens are letters only

    def compute(self, rows: DataFrame, key: str, out: str) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def none(self) -> Column:  # pragma: no cover - abstract
        """Result of a row without content."""
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return by_content(df, self.content(), self.getInputCol(), self.getOutputCol(), self.compute, self.none(), self.narrow, self.key_column())

    def key_column(self) -> str:
        """Where ``with_content_keys`` puts the content's key."""
        return f"_key_{self.uid}"


def content_key(content: Column) -> Column:
    """16 bytes that stand for a content, as exploded rows carry them."""
    return F.unhex(F.substring(F.sha2(content, 256), 1, 32))


def by_content(
    df: DataFrame, content: Column, column: str, out: str, compute: Callable[[DataFrame, str | list[str], str], DataFrame], none: Column, narrow: bool = False, known: str | None = None
) -> DataFrame:
    """``df`` with ``out`` = ``compute(rows, key, out)`` of one row per distinct ``content``. A ``narrow``
    result is computed where the rows are, under the key and a number of the row, so that no text moves to be
    made distinct; one result a key is stored and broadcast if its measured size is within the bounds.
    ``known``: a column that has the content's key already; texts that nothing else reads do not
    take part in the join."""
    key = "_content"
    while key in df.columns:
        key += "_"
    known = known if known in df.columns else None
    keyed = df.drop(out).withColumn(key, F.col(known) if known else content_key(content))
    rows = keyed.where(F.col(key).isNotNull()).select(key, column)
    if narrow:
        from msgtriage.session import discard

        found = compute(rows.withColumn("_row", F.monotonically_increasing_id()), [key, "_row"], out)
        found = lexicon.sized_side(materialize(found.select(key, out).dropDuplicates([key]), "found"))
        discard(df.sparkSession)  # what the result was computed from
    else:
        found = compute(rows.dropDuplicates([key]), key, out).select(key, out)
    return keyed.join(found, key, "left").withColumn(out, F.coalesce(F.col(out), none)).drop(key)


def with_content_keys(df: DataFrame, stages: Sequence) -> DataFrame:
    """``df`` with the content keys of the table models among ``stages``, a column each, so that the joins of
    all of them move keys and leave texts where they are."""
    return df.withColumns({s.key_column(): content_key(s.content()) for s in stages if isinstance(s, TableModel)})


# --------------------------------------------------------------------------
# J1-J3 term weights
# --------------------------------------------------------------------------


def sparse_vector(entries: Column, size: int) -> Column:
    """``array<struct<index, weight>>`` in order of the index -> sparse vector of ``size``."""

    def build(entries: pa.Array) -> pa.Array:
        index, weight = (entries.values.field(k) for k in range(2))
        lists = [pa.ListArray.from_arrays(entries.offsets, x) for x in (index, weight)]
        n = len(entries)
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), *lists], ["type", "size", "indices", "values"]
        )

    return F.arrow_udf(build, VectorUDT())(entries)  # a nested function: workers need not import this package


class TermWeightsModel(TableModel):
    """J1-J3 as a stage: tokens -> sparse vector of (sublinear) TF times smooth IDF by the table
    ``vocabulary(term, index, df)``, joined and never held whole by a task or the driver."""

    sublinear = Param(Params._dummy(), "sublinear", "1 + ln(count) for the count", TypeConverters.toBoolean)
    nDocs = Param(Params._dummy(), "nDocs", "rows of the fit", TypeConverters.toInt)
    nTerms = Param(Params._dummy(), "nTerms", "terms, the size of a vector", TypeConverters.toInt)

    def compute(self, rows, key, out):
        counts = term_frequencies(rows, key, self.getInputCol())
        tf = (1.0 + F.log("tf")) if self.getOrDefault(self.sublinear) else F.col("tf").cast("double")
        weight = tf * idf_column(F.col("df"), self.getOrDefault(self.nDocs))
        entries = counts.join(lexicon.sized_side(self.tables["vocabulary"]), "term").select(key, F.struct("index", weight.alias("weight")).alias("_e"))
        return entries.groupBy(key).agg(F.sort_array(F.collect_list("_e")).alias(out))

    def none(self):
        return F.array().cast("array<struct<index:int,weight:double>>")

    def _transform(self, df):
        out = self.getOutputCol()
        return super()._transform(df).withColumn(out, sparse_vector(F.col(out), self.getOrDefault(self.nTerms)))


class TermWeights(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a vocabulary of any size: all terms within the document-frequency bounds (below 1 a
    share of the rows, else a number of them), numbered by falling corpus count, then by name."""

    sublinear = TermWeightsModel.sublinear
    minDF = Param(Params._dummy(), "minDF", "least document frequency", TypeConverters.toFloat)
    maxDF = Param(Params._dummy(), "maxDF", "highest document frequency", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCol="tokens", outputCol="tfidf", minDF=5.0, maxDF=0.98, sublinear=False):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol=inputCol, outputCol=outputCol, minDF=minDF, maxDF=maxDF, sublinear=sublinear)

    def _fit(self, df: DataFrame) -> TermWeightsModel:
        tokens, n = self.getInputCol(), df.count()
        lo, hi = (x if x >= 1 else x * n for x in (self.getOrDefault(self.minDF), self.getOrDefault(self.maxDF)))
        # a token counts for cf, a row's distinct token for df; both are summed per task before the shuffle
        each = [df.select(F.lit(d).alias("d"), a.alias("t")) for d, a in enumerate((F.col(tokens), F.array_distinct(tokens)))]
        long = explode_tokens(each[0].unionAll(each[1]), "d", "t", "term")
        stats = long.groupBy("term").agg(F.sum("d").alias("df"), F.sum(1 - F.col("d")).alias("cf")).where(F.col("df").between(lo, hi))
        rank = F.concat(F.lpad((F.lit(2**63 - 1) - F.col("cf")).cast("string"), 19, "0"), "term")
        terms = ordered_index(stats.select("term", "df", rank.alias("_rank")), "_rank", "index")
        vocabulary = materialize(terms.select("term", "index", "df"), "vocabulary")
        io = {"inputCol": tokens, "outputCol": self.getOutputCol()}
        return TermWeightsModel({"vocabulary": vocabulary}, sublinear=self.getOrDefault(self.sublinear), nDocs=n, nTerms=vocabulary.count(), **io)


# --------------------------------------------------------------------------
# J9 sentence vectors
# --------------------------------------------------------------------------


class SentenceVectorModel(TableModel):
    """J9 as a stage: tokens -> the vector of the recurrence ``v <- (w + v) / size`` over the
    words of the table ``vectors(word, vector)``; no known word gives zeros."""

    vectorSize = Param(Params._dummy(), "vectorSize", "components of a vector", TypeConverters.toInt)

    @classmethod
    def of(cls, word_vectors: DataFrame, size: int, inputCol: str = "tokens", outputCol: str = "sentvec") -> "SentenceVectorModel":
        """A model over given word vectors (A7), each ``size`` long."""
        return cls({"vectors": word_vectors.select("word", "vector")}, inputCol=inputCol, outputCol=outputCol, vectorSize=size)

    def compute(self, rows, key, out):
        found = vectors.sentence_vectors(rows, self.tables["vectors"], self.getOrDefault(self.vectorSize), key, self.getInputCol(), out)
        return found.withColumn(out, array_to_vector(out))

    def none(self):
        return array_to_vector(F.array_repeat(F.lit(0.0), self.getOrDefault(self.vectorSize)))


class SentenceVector(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Trains word vectors once in ``fit`` (Q11) and looks them up in ``transform``."""

    vectorSize = Param(Params._dummy(), "vectorSize", "components of a vector", TypeConverters.toInt)
    minCount = Param(Params._dummy(), "minCount", "least occurrences of a word", TypeConverters.toInt)
    windowSize = Param(Params._dummy(), "windowSize", "words on each side", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "passes", TypeConverters.toInt)
    numPartitions = Param(Params._dummy(), "numPartitions", "partitions of the word vector fit", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="tokens", outputCol="sentvec", vectorSize=100, minCount=2, windowSize=1, maxIter=5, numPartitions=1, seed=11):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol=inputCol, outputCol=outputCol, vectorSize=vectorSize, minCount=minCount, windowSize=windowSize, maxIter=maxIter, numPartitions=numPartitions, seed=seed)

    def _fit(self, df: DataFrame) -> SentenceVectorModel:
        get = lambda p: self.getOrDefault(p)
        words = word2vec_stage(self.getInputCol(), "_w2v", get("vectorSize"), get("minCount"), get("windowSize"), get("maxIter"), get("numPartitions"), get("seed"))
        from pyspark.ml.functions import vector_to_array

        found = words.fit(df).getVectors().select("word", vector_to_array("vector").alias("vector"))
        return SentenceVectorModel.of(materialize(found, "word-vectors"), get("vectorSize"), self.getInputCol(), self.getOutputCol())


class PopulationScaler(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """J10 as a stage: zero mean and unit *population* variance (constant components become 0).

    Spark's scaler divides by the sample deviation; the fitted stage multiplies by
    ``sqrt(n / (n - 1))`` afterwards."""

    @keyword_only
    def __init__(self, inputCol="sentvec", outputCol="scaled"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        from pyspark.ml.feature import ElementwiseProduct, StandardScaler
        from pyspark.ml.linalg import Vectors

        df = materialize(df.select(self.getInputCol()), "scaler-input")  # read by the count and by the fit
        between, n = f"{self.getOutputCol()}_sample", df.count()
        scaler = StandardScaler(inputCol=self.getInputCol(), outputCol=between, withMean=True, withStd=True).fit(df)
        factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
        weights = Vectors.dense([factor] * scaler.mean.size)
        return PipelineModel(stages=[scaler, ElementwiseProduct(inputCol=between, outputCol=self.getOutputCol(), scalingVec=weights)])


# --------------------------------------------------------------------------
# I12, I13 tags
# --------------------------------------------------------------------------


class _Tagged(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a tag lexicon from token arrays and the arrays of their tags: the most frequent tag
    of a token, the first in order of name among equal ones."""

    tokensCol = Param(Params._dummy(), "tokensCol", "tokens to learn from", TypeConverters.toString)
    tagsCol = Param(Params._dummy(), "tagsCol", "their tags", TypeConverters.toString)

    def lexicon_of(self, df: DataFrame) -> DataFrame:
        tokens, tags = self.getOrDefault("tokensCol"), self.getOrDefault("tagsCol")
        pairs = df.select(F.arrays_zip(F.col(tokens).alias("token"), F.col(tags).alias("tag")).alias("_p"))
        long = pairs.select(F.explode_outer("_p").alias("_p")).select("_p.*").where("token IS NOT NULL AND tag IS NOT NULL")
        return materialize(lexicon.tag_lexicon(long), "tag-lexicon")


class VerbNounCountModel(TableModel):
    """I12 as a stage: tokens -> vector (verbs, nouns) by the table ``tags(token, tag)``."""

    narrow = True

    def compute(self, rows, key, out):
        found = lexicon.verb_noun_hits(rows, self.tables["tags"], key, self.getInputCol(), VERB_TAGS, NOUN_TAGS)
        counts = [F.coalesce(n, F.lit(0)).cast("double") for n in ("n_verbs", "n_nouns")]
        return found.select(*key, array_to_vector(F.array(*counts)).alias(out))

    def none(self):
        return array_to_vector(F.array(F.lit(0.0), F.lit(0.0)))


class GetVerbNounCount(_Tagged):
    @keyword_only
    def __init__(self, inputCol="tokens", outputCol="verbs_nouns", tokensCol="tokens", tagsCol="tags"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol=inputCol, outputCol=outputCol, tokensCol=tokensCol, tagsCol=tagsCol)

    def _fit(self, df: DataFrame) -> VerbNounCountModel:
        return VerbNounCountModel({"tags": self.lexicon_of(df)}, inputCol=self.getInputCol(), outputCol=self.getOutputCol())


class StartingVerbModel(TableModel):
    """I13 as a stage: text -> whether a sentence starts with a verb (or, with ``matchRt``, with
    the token ``rt``), by the table ``tags(token, tag)``."""

    narrow = True

    variant = Param(Params._dummy(), "variant", "stop-word variant", TypeConverters.toString)
    matchRt = Param(Params._dummy(), "matchRt", "count the token rt too", TypeConverters.toBoolean)

    def content(self):
        return F.col(self.getInputCol())

    def compute(self, rows, key, out):
        variant = self.getOrDefault(self.variant)
        found = lexicon.starting_verb_hits(
            rows, self.tables["tags"], key, self.getInputCol(), None if variant == "none" else variant, STARTING_VERB_TAGS, self.getOrDefault(self.matchRt)
        )
        return found.select(*key, (F.col("_f") == 1).alias(out))

    def none(self):
        return F.lit(False)


class StartingVerbExtractor(_Tagged):
    variant, matchRt = StartingVerbModel.variant, StartingVerbModel.matchRt

    @keyword_only
    def __init__(self, inputCol="message", outputCol="starting_verb", tokensCol="tokens", tagsCol="tags", variant="train", matchRt=False):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol=inputCol, outputCol=outputCol, tokensCol=tokensCol, tagsCol=tagsCol, variant=variant, matchRt=matchRt)

    def _fit(self, df: DataFrame) -> StartingVerbModel:
        io = {"inputCol": self.getInputCol(), "outputCol": self.getOutputCol()}
        return StartingVerbModel({"tags": self.lexicon_of(df)}, variant=self.getOrDefault(self.variant), matchRt=self.getOrDefault(self.matchRt), **io)


# --------------------------------------------------------------------------
# I14 entities
# --------------------------------------------------------------------------


def phrase_trie(gazetteer: DataFrame) -> DataFrame:
    """Trie of ``(phrase, type)`` rows over words: ``(prefix, depth, types)``, a node per distinct
    prefix; ``types`` is empty where no phrase ends. The first word's nodes have depth 1."""
    words = F.filter(F.split("phrase", " +"), lambda w: w != "")
    long = gazetteer.select(words.alias("w"), "type").where("size(w) > 0 AND type IS NOT NULL")
    nodes = long.select("w", "type", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("depth"))
    prefix = F.array_join(F.slice("w", F.lit(1), F.col("depth")), " ").alias("prefix")
    ends = F.when(F.col("depth") == F.size("w"), F.col("type"))
    return nodes.groupBy(prefix, "depth").agg(F.array_sort(F.collect_set(ends)).alias("types"))


def phrase_types(df: DataFrame, trie: DataFrame, key: str = "id", tokens: str = "tokens", out: str = "types") -> DataFrame:
    """``(key, n_matches, out)``: the leftmost-longest matches of the trie's phrases in each token
    array, counted, and the distinct types they have, in order of name.

    The walk down the trie is a join per level: a position stays only if its first word begins a
    phrase, and the deepest node with types is its longest phrase. Each document's remaining
    matches (bounded by its tokens) are then read from the left; one that begins inside the match
    before it is passed over. A trie level is broadcast only within a measured size."""
    chosen = phrase_hits(df, trie, [key], tokens, out)
    joined = df.select(key).join(chosen, key, "left")
    empty = F.array().cast("array<string>")
    return joined.select(key, F.coalesce("n_matches", F.lit(0)).alias("n_matches"), F.coalesce(out, empty).alias(out))


def phrase_hits(df: DataFrame, trie: DataFrame, keys: Sequence[str], tokens: str = "tokens", out: str = "types") -> DataFrame:
    """``phrase_types`` of the rows that have a match, ``(*keys, n_matches, out)``. A match is moved as its
    place and length in one number and its types in one string."""
    depth = trie.agg(F.max("depth")).first()[0] or 0
    at = F.transform(tokens, lambda _, i: F.slice(tokens, i + 1, max(depth, 1)))
    rows = explode_tokens(df.select(*keys, at.alias("_w")), keys, "_w", "_words", pos="pos")
    best = None
    for d in range(1, depth + 1):
        ends = F.when(F.size("types") > 0, F.to_json("types"))
        level = trie.where(F.col("depth") == d).select(F.col("prefix").alias("_p"), ends.alias(f"_t{d}"))
        joined = F.array_join(F.slice("_words", 1, d), " ") == F.col("_p")
        rows = rows.join(lexicon.sized_side(level), joined, "inner" if d == 1 else "left").drop("_p")
        found = F.when(F.col(f"_t{d}").isNotNull(), F.struct(F.lit(d).alias("n"), F.col(f"_t{d}").alias("types")))
        best = found if best is None else F.coalesce(found, best)
    if best is None:
        none = F.array().cast("array<string>")
        return df.select(*keys, F.lit(0).alias("n_matches"), none.alias(out)).limit(0)
    rows = rows.select(*keys, "pos", best.alias("m")).where("m IS NOT NULL")
    place = F.col("pos").cast("bigint") * F.lit(1 << 31) + F.col("m.n")
    rows = rows.select(*keys, F.struct(place.alias("at"), F.col("m.types").alias("types")).alias("_m"))
    rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_m")).alias("_m"))
    none = F.struct(F.lit(0).cast("bigint").alias("free"), F.lit(0).alias("k"), F.array().cast("array<string>").alias("types"))

    def take(acc: Column, m: Column) -> Column:
        pos, n = F.shiftright(m["at"], 31), m["at"].bitwiseAND(F.lit((1 << 31) - 1))
        taken = F.struct((pos + n).alias("free"), (acc["k"] + 1).alias("k"), F.array_union(acc["types"], F.array(m["types"])).alias("types"))
        return F.when(pos >= acc["free"], taken).otherwise(acc)

    chosen = rows.select(*keys, F.aggregate("_m", none, take).alias("_c"))
    # the strings of the types are read once each
    types = F.array_distinct(F.flatten(F.transform("_c.types", lambda t: F.from_json(t, "array<string>"))))
    return chosen.select(*keys, F.col("_c.k").alias("n_matches"), F.array_sort(types).alias(out))


class EntityCountModel(TableModel):
    """I14 as a stage: tokens -> 0/1 vector over ``types`` of the leftmost-longest phrases found in
    the table ``trie``."""

    narrow = True

    types = Param(Params._dummy(), "types", "entity types, in order of the vector", TypeConverters.toListString)

    def compute(self, rows, key, out):
        found = phrase_hits(rows, self.tables["trie"], key, self.getInputCol(), "_types")
        flags = [F.array_contains("_types", t).cast("double") for t in self.getOrDefault(self.types)]
        return found.select(*key, array_to_vector(F.array(*flags)).alias(out))

    def none(self):
        return array_to_vector(F.array(*[F.lit(0.0) for _ in self.getOrDefault(self.types)]))


class EntityCount(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the phrases of a corpus whose rows carry their entities as ``array<struct<phrase, type>>``."""

    entitiesCol = Param(Params._dummy(), "entitiesCol", "annotated entities to learn from", TypeConverters.toString)
    types = EntityCountModel.types

    @keyword_only
    def __init__(self, inputCol="tokens", outputCol="entities_found", entitiesCol="entities", types=None):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(inputCol=inputCol, outputCol=outputCol, entitiesCol=entitiesCol, types=list(ENTITY_TYPES))

    def _fit(self, df: DataFrame) -> EntityCountModel:
        listed = df.select(F.explode_outer(self.getOrDefault("entitiesCol")).alias("_e")).select("_e.*")
        trie = materialize(phrase_trie(listed.where("phrase IS NOT NULL").distinct()), "phrase-trie")
        return EntityCountModel({"trie": trie}, inputCol=self.getInputCol(), outputCol=self.getOutputCol(), types=self.getOrDefault(self.types))


def entity_names(flags: Column, types: Sequence[str] = ENTITY_TYPES) -> list[Column]:
    """The components of an entity vector as 0/1 integers named after their types."""
    from pyspark.ml.functions import vector_to_array

    return [vector_to_array(flags)[i].cast("int").alias(t) for i, t in enumerate(types)]
