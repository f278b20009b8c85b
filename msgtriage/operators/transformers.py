"""Spark ML Transformer wrappers over the column functions.

Each is a thin ``Transformer`` with ``DefaultParamsReadable/Writable`` so it
can sit inside a saved ``PipelineModel``; the work is a Column expression. Stages whose
fitted state is a table are in ``table_models``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgtriage.functions import text as T
from msgtriage.schema import LABEL_KEYWORDS


class _ColumnTransformer(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    @keyword_only
    def __init__(self, inputCol: str = "message", outputCol: str = "out"):
        super().__init__()
        self._set(**self._input_kwargs)

    def expression(self, col):  # pragma: no cover - abstract
        raise NotImplementedError

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), self.expression(F.col(self.getInputCol())))


class TextTokenizer(_ColumnTransformer):
    """I8 as a stage: text -> cleaned token array (stop-word variant param)."""

    variant = Param(Params._dummy(), "variant", "stop-word variant", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol: str = "message", outputCol: str = "tokens", variant: str = "train"):
        super(_ColumnTransformer, self).__init__()
        self._setDefault(variant="train")
        self._set(**self._input_kwargs)

    def expression(self, col):
        v = self.getOrDefault(self.variant)
        return T.tokenize(col, None if v == "none" else v)


class SplitNote(_ColumnTransformer):
    """I10 as a stage: keep the text before the first ``Note``."""

    @keyword_only
    def __init__(self, inputCol: str = "message", outputCol: str = "message"):
        super(_ColumnTransformer, self).__init__()
        self._set(**self._input_kwargs)

    def expression(self, col):
        return T.split_note(col)


class KeywordSearch(_ColumnTransformer):
    """I11 as a stage: token array -> dense 0/1 vector over the keywords."""

    keywords = Param(Params._dummy(), "keywords", "keywords", TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCol: str = "tokens", outputCol: str = "keywords", keywords=None):
        super(_ColumnTransformer, self).__init__()
        self._setDefault(keywords=list(LABEL_KEYWORDS))
        self._set(**self._input_kwargs)

    def expression(self, col):
        from pyspark.ml.functions import array_to_vector

        flags = T.keyword_flags(col, self.getOrDefault(self.keywords))
        return array_to_vector(F.transform(flags, lambda x: x.cast("double")))


class SuffixLemma(_ColumnTransformer):
    """I7 as a stage: tokens of more than three letters lose a final ``s`` (the rule of the
    fixture lexicon, see ``lexicon.suffix_lemma_lexicon``)."""

    @keyword_only
    def __init__(self, inputCol: str = "tokens", outputCol: str = "lemmas"):
        super(_ColumnTransformer, self).__init__()
        self._set(**self._input_kwargs)

    def expression(self, col):
        return F.transform(col, lambda t: F.when((F.length(t) > 3) & t.endswith("s"), F.substring(t, F.lit(1), F.length(t) - 1)).otherwise(t))


class SublinearTF(_ColumnTransformer):
    """J3 as a stage: counts ``c`` become ``1 + ln(c)``, zeros stay and sparse vectors stay
    sparse: one numpy expression over the stored values of an Arrow batch."""

    @keyword_only
    def __init__(self, inputCol: str = "counts", outputCol: str = "tf"):
        super(_ColumnTransformer, self).__init__()
        self._set(**self._input_kwargs)

    def expression(self, col):
        def sublinear(vectors: pa.Array) -> pa.Array:
            kind, size, indices, values = (vectors.field(k) for k in range(4))
            counts = values.values.to_numpy(zero_copy_only=False)
            tf = np.where(counts > 0, 1.0 + np.log(np.where(counts > 0, counts, 1.0)), 0.0)
            tf = pa.ListArray.from_arrays(values.offsets, pa.array(tf), type=values.type, mask=values.is_null())
            return pa.StructArray.from_arrays([kind, size, indices, tf], fields=list(vectors.type), mask=vectors.is_null())

        return F.arrow_udf(sublinear, VectorUDT())(col)  # a nested function: workers need not import this package


class CountAllTerms(CountVectorizer):
    """J1 as a stage that keeps every term within the document-frequency bounds: more than
    ``vocabSize`` of them are an error, none is dropped."""

    def _fit(self, df: DataFrame):
        most = self.getVocabSize()
        model = super(CountAllTerms, self.copy({self.vocabSize: most + 1}))._fit(df)
        if len(model.vocabulary) > most:
            raise ValueError(f"more than {most} terms for an ML vector; raise min_df or set vocab_size")
        return model


class SmoothIDF(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """J2 as a stage: multiply by ``ln((1 + n) / (1 + df)) + 1``.

    Spark's IDF lacks the ``+ 1``; the fitted weights plus one make an
    ``ElementwiseProduct``, which saves and loads as any Spark ML stage."""

    @keyword_only
    def __init__(self, inputCol: str = "tf", outputCol: str = "tfidf"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        from pyspark.ml.feature import IDF, ElementwiseProduct
        from pyspark.ml.linalg import Vectors

        io = {"inputCol": self.getInputCol(), "outputCol": self.getOutputCol()}
        return ElementwiseProduct(scalingVec=Vectors.dense(IDF(**io).fit(df).idf.toArray() + 1.0), **io)


class Dense(_ColumnTransformer):
    """J12 as a stage: vector -> dense vector."""

    @keyword_only
    def __init__(self, inputCol: str = "features", outputCol: str = "dense"):
        super(_ColumnTransformer, self).__init__()
        self._set(**self._input_kwargs)

    def expression(self, col):
        from pyspark.ml.functions import array_to_vector, vector_to_array

        return array_to_vector(vector_to_array(col))
