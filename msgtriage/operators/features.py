"""Feature families (J1-J6 relational forms, J7-J13 Spark ML stages).

Relational forms work on the long ``(key, term, tf)`` table: term frequency
is a ``groupBy(key, term)`` whose map-side partial aggregation collapses the
tokens of one document inside the task that read it; document frequency is
a ``groupBy(term)`` (a hot term such as "the" is pre-aggregated per task).
The vocabulary is cut to ``vocab_size`` terms by a distributed top-k, so its
broadcast has a proven bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.functions.text import tokenize


def explode_tokens(df: DataFrame, key: str | Sequence[str], tokens: str, out: str = "term",
                   pos: str | None = None) -> DataFrame:
    """Long form of an array column without Spark's inferred ``size(x) > 0`` filter.

    For an inner ``explode`` the optimizer infers ``size(tokens) > 0`` and
    pushes it below the projection that computes ``tokens``, inlining (and so
    re-running) the whole tokenize expression. ``explode_outer`` is not subject
    to that rule; the NULL row it emits for an empty array is dropped after.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if pos is None:
        return df.select(*keys, F.explode_outer(tokens).alias(out)).where(F.col(out).isNotNull())
    return df.select(*keys, F.posexplode_outer(tokens).alias(pos, out)).where(
        F.col(out).isNotNull()
    )


def with_tokens(
    df: DataFrame, text: str = "message", out: str = "tokens", variant: str | None = "train"
) -> DataFrame:
    """I8 applied as a column (no shuffle, no Python)."""
    return df.withColumn(out, tokenize(text, variant))


def token_table(df: DataFrame, key: str = "id", tokens: str = "tokens") -> DataFrame:
    """T5 long form ``(key, pos, token)``."""
    return explode_tokens(df, key, tokens, "token", pos="pos")


def term_frequencies(df: DataFrame, key: str = "id", tokens: str = "tokens") -> DataFrame:
    """J1 counts: ``(key, term, tf)``."""
    return (
        explode_tokens(df, key, tokens, "term")
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def _doc_count_bound(value: float | int, n_docs: int) -> float:
    """sklearn semantics: an int is an absolute count, a float a proportion."""
    if isinstance(value, float):
        return value * n_docs
    return float(value)


def vocabulary(
    tf: DataFrame,
    n_docs: int,
    vocab_size: int | None = 2500,
    min_df: int | float = 1,
    max_df: int | float = 1.0,
) -> DataFrame:
    """J1 vocabulary ``(term, df, cf, term_index)``.

    Terms with ``min_df <= df <= max_df`` are kept, then the ``vocab_size``
    most frequent by corpus count (ties by term). ``term_index`` numbers the
    kept terms alphabetically, as the reference's vectorizer does.
    """
    lo = _doc_count_bound(min_df, n_docs)
    hi = _doc_count_bound(max_df, n_docs)
    stats = tf.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("cf")
    )
    kept = stats.where((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))
    if vocab_size is not None:
        kept = kept.orderBy(F.desc("cf"), F.col("term")).limit(vocab_size)
        # at most vocab_size rows: one small window is fine
        return kept.withColumn("term_index", F.row_number().over(Window.orderBy("term")) - 1)
    return ordered_index(kept, "term", "term_index")


def ordered_index(df: DataFrame, order: str, out: str) -> DataFrame:
    """Dense 0-based index in ``order`` (a string column of distinct values) without a
    global window.

    The rows are range-partitioned on ``order`` and stored with their range's number;
    counts per range (a row per partition) give offsets, and ``row_number`` runs inside
    each range only. Ranges are cut by Spark's sample of the values, so common
    prefixes do not make a range large.
    """
    from msgtriage.session import materialize

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ordered-index")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_range").orderBy(order)
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(out, (F.col("_off") + F.row_number().over(inside) - 1).cast("int"))
        .drop("_range", "_off")
    )


def idf_column(df_col: Column, n_docs: int, smooth: bool = True) -> Column:
    """``ln((1+n)/(1+df)) + 1`` (smooth) or ``ln(n/df) + 1``."""
    if smooth:
        return F.log((F.lit(n_docs + 1.0)) / (df_col + 1.0)) + 1.0
    return F.log(F.lit(float(n_docs)) / df_col) + 1.0


def tfidf(
    tf: DataFrame,
    vocab: DataFrame,
    n_docs: int,
    key: str = "id",
    sublinear: bool = True,
    smooth: bool = True,
    norm: str | None = "l2",
    vocab_size: int | None = None,
) -> DataFrame:
    """``(key, term, term_index, weight)``.

    A vocabulary capped at ``vocab_size`` terms (the cap it was built with)
    is broadcast as is; an uncapped one is broadcast only when its measured
    size is within the bound, else it is a shuffle join. The per-document
    norm is a window over ``key`` on the already narrow weight rows.
    """
    from msgtriage.operators.lexicon import DEFAULT_BROADCAST_ROWS, sized_side

    tf_term = (1.0 + F.log(F.col("tf"))) if sublinear else F.col("tf").cast("double")
    narrow = vocab.select("term", "term_index", "df")
    if vocab_size is not None and vocab_size <= DEFAULT_BROADCAST_ROWS:
        w = F.broadcast(narrow)
    else:
        w = sized_side(narrow)
    weighted = tf.join(w, "term").select(
        key, "term", "term_index", (tf_term * idf_column(F.col("df"), n_docs, smooth)).alias("w")
    )
    if norm is None:
        return weighted.withColumnRenamed("w", "weight")
    by_doc = Window.partitionBy(key)
    if norm == "l2":
        denom = F.sqrt(F.sum(F.col("w") * F.col("w")).over(by_doc))
    elif norm == "l1":
        denom = F.sum(F.abs(F.col("w"))).over(by_doc)
    else:
        raise ValueError(norm)
    return weighted.select(key, "term", "term_index", (F.col("w") / denom).alias("weight"))


def md5_bucket(term: Column, num_buckets: int) -> Column:
    """Portable hash bucket: first 8 hex digits of md5 as an integer, mod n."""
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("bigint") % num_buckets).cast(
        "int"
    )


def hashed_term_counts(
    df: DataFrame, key: str = "id", tokens: str = "tokens", num_buckets: int = 200
) -> DataFrame:
    """J5 relational form: ``(key, bucket, n)`` with md5 buckets."""
    return (
        explode_tokens(df, key, tokens, "term")
        .select(key, md5_bucket(F.col("term"), num_buckets).alias("bucket"))
        .groupBy(key, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bigrams(tokens: Column | str) -> Column:
    """Adjacent token pairs joined by a space (empty for < 2 tokens).

    Pass a materialised column (a name): the lambda indexes the array once per
    element, so an un-materialised tokenize expression would be re-run.
    """
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    n = F.size(t)
    pairs = F.transform(
        F.sequence(F.lit(1), n - 1),
        lambda i: F.concat(F.element_at(t, i), F.lit(" "), F.element_at(t, i + 1)),
    )
    return F.when(n >= 2, pairs).otherwise(F.array().cast("array<string>"))


def unigrams_and_bigrams(tokens: Column | str) -> Column:
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.concat(t, bigrams(t))


# --------------------------------------------------------------------------
# Spark ML stages
# --------------------------------------------------------------------------


ML_TERMS = 1 << 18  # longest vocabulary of an ML stage that is not told its size


def tfidf_stages(
    input_col: str = "tokens",
    output_col: str = "tfidf",
    vocab_size: int | None = 2500,
    min_df: float = 5.0,
    max_df: float = 0.98,
    norm_p: float | None = 2.0,
    sublinear: bool = False,
    tables: bool = False,
):
    """J1-J4 as ML stages: counts -> (sublinear) TF -> smooth IDF + 1 -> norm.

    With ``sublinear`` the weights of the relational ``tfidf`` above, fitted and saveable.
    Vectors stay sparse through all steps. ``vocab_size`` None keeps all terms, and fitting raises
    an error where they are more than ``ML_TERMS``. With ``tables`` all terms are kept as a table
    of any size and counts, TF and IDF are one stage; the relational form has no bound either.
    """
    from pyspark.ml.feature import CountVectorizer, Normalizer

    from msgtriage.operators.transformers import CountAllTerms, SmoothIDF, SublinearTF

    weighted = output_col if norm_p is None else f"{output_col}_idf"
    norm = [] if norm_p is None else [Normalizer(inputCol=weighted, outputCol=output_col, p=norm_p)]
    if tables:
        from msgtriage.operators.table_models import TermWeights

        if vocab_size is not None:
            raise ValueError("a vocabulary kept as a table has no size")
        return [TermWeights(inputCol=input_col, outputCol=weighted, minDF=min_df, maxDF=max_df, sublinear=sublinear), *norm]
    counts = CountAllTerms if vocab_size is None else CountVectorizer
    stages = [
        counts(
            inputCol=input_col, outputCol=f"{output_col}_counts",
            vocabSize=ML_TERMS if vocab_size is None else vocab_size, minDF=min_df, maxDF=max_df,
        )
    ]
    if sublinear:
        stages.append(SublinearTF(inputCol=f"{output_col}_counts", outputCol=f"{output_col}_log"))
    tf = f"{output_col}_log" if sublinear else f"{output_col}_counts"
    stages.append(SmoothIDF(inputCol=tf, outputCol=weighted))
    return [*stages, *norm]


def vector_entries(df: DataFrame, key: str, vector: str, terms: DataFrame) -> DataFrame:
    """``(key, term, weight)`` of the stored entries of a sparse vector column, named by the
    table ``terms(index, term)``."""
    raw = F.unwrap_udt(vector)
    long = df.select(key, F.explode_outer(F.arrays_zip(raw["indices"].alias("index"), raw["values"].alias("weight"))).alias("_e"))
    return long.select(key, "_e.*").where("index IS NOT NULL").join(terms, "index").select(key, "term", "weight")


def hashing_stage(input_col: str = "tokens", output_col: str = "hashed", num_features: int = 200):
    """J5 as an ML stage (murmur3 buckets, differs from the md5 form by design)."""
    from pyspark.ml.feature import HashingTF

    return HashingTF(inputCol=input_col, outputCol=output_col, numFeatures=num_features)


def ngram_stage(input_col: str = "tokens", output_col: str = "bigrams"):
    """J6 as an ML stage."""
    from pyspark.ml.feature import NGram

    return NGram(n=2, inputCol=input_col, outputCol=output_col)


def word2vec_stage(
    input_col: str = "tokens",
    output_col: str = "w2v",
    size: int = 100,
    min_count: int = 5,
    window: int = 5,
    max_iter: int = 1,
    num_partitions: int = 1,
    seed: int = 11,
):
    """Skip-gram word vectors (MLlib); ``transform`` gives the mean vector."""
    from pyspark.ml.feature import Word2Vec

    return Word2Vec(
        inputCol=input_col, outputCol=output_col, vectorSize=size, minCount=min_count,
        windowSize=window, maxIter=max_iter, numPartitions=num_partitions, seed=seed,
    )


def standardize_stage(input_col: str, output_col: str):
    """Zero mean, unit (sample) variance."""
    from pyspark.ml.feature import StandardScaler

    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True)


def assemble_stage(input_cols: Sequence[str], output_col: str = "features"):
    """Feature union."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col, handleInvalid="keep")


def to_dense(col: str | Column) -> Column:
    """Vector -> ``array<double>`` (dense)."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(col) if isinstance(col, str) else col)


def to_vector(col: str | Column) -> Column:
    """``array<double>`` -> dense vector."""
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(F.col(col) if isinstance(col, str) else col)


def optional_transform_stage(kind: str, input_col: str, output_col: str, **kw):
    """PCA (truncated SVD stand-in), polynomial expansion, quantile, robust scaling."""
    from pyspark.ml import feature as mf

    if kind == "pca":
        return mf.PCA(k=kw.get("k", 10), inputCol=input_col, outputCol=output_col)
    if kind == "poly":
        return mf.PolynomialExpansion(degree=kw.get("degree", 2), inputCol=input_col,
                                      outputCol=output_col)
    if kind == "quantile":
        return mf.QuantileDiscretizer(numBuckets=kw.get("buckets", 4), inputCol=input_col,
                                      outputCol=output_col)
    if kind == "robust":
        return mf.RobustScaler(inputCol=input_col, outputCol=output_col)
    raise ValueError(kind)


def n_docs_of(df: DataFrame) -> int:
    """Number of documents (a single scalar action)."""
    return int(df.count())

