import pytest

import __spark_entry__ as entry_mod
from conftest import SF_ORACLE


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert [c for c in df.columns] == ["label", "total"]
    assert len(rows) == 4


def test_every_oracle_has_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


FAST = [
    "clean_table", "label_totals", "genre_counts", "unpacked_labels", "message_tokens",
    "tfidf_weights", "random_index", "upsampled_train", "label_metrics", "spell_suggestions",
    "sentence_vectors", "similar_words", "stream_genre_counts", "stream_dedupe",
]


@pytest.mark.parametrize("name", FAST)
def test_oracle_agreement(spark, name):
    import sys

    import os

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from check_oracles import compare, duck_connect

    from msgtriage.plans.catalog import REGISTRY

    con = duck_connect(SF_ORACLE)
    status, ns, nd, _, msg = compare(spark, con, name, REGISTRY[name], SF_ORACLE)
    assert status == "OK", msg
