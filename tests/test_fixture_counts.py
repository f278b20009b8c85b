"""The expected counts documented for the fixtures (FIXTURES.md §3), at all three scales."""

import pytest
from pyspark.sql import functions as F

from msgtriage.operators import filters, ingest, profile
from msgtriage.plans import etl
from msgtriage.plans.fixtures import categories_fx, messages_fx

EXPECTED = {
    # sf: (messages, categories, join pairs, D1, all-zero, related=2, after B4+B3,
    #      label sums related/toxic/long/multi_line/child_alone)
    "0.001": (205, 88, 90, 87, 2, 2, 83, (74, 11, 40, 75, 0)),
    "0.01": (1025, 405, 417, 399, 10, 9, 380, (334, 49, 158, 354, 0)),
    "0.1": (10250, 4068, 4244, 3980, 92, 74, 3814, (3349, 446, 1501, 3582, 0)),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_documented_counts(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    n_m, n_c, n_pairs, n_d1, n_zero, n_two, n_train, sums = EXPECTED[sf]
    m, c = messages_fx(spark, sf_dir), categories_fx(spark, sf_dir)
    assert (m.count(), c.count()) == (n_m, n_c)
    assert ingest.join_messages_categories(m, c).agg(F.sum("n_pairs")).first()[0] == n_pairs
    clean, labels = etl.clean_table(spark, sf_dir)
    assert clean.count() == n_d1
    assert filters.all_zero_rows(clean, labels).count() == n_zero
    assert clean.where("related = 2").count() == n_two
    train = filters.drop_related_two(filters.drop_all_zero(clean, labels))
    assert train.count() == n_train
    totals = {r.label: r.total for r in profile.label_totals(train, labels).collect()}
    assert totals == dict(zip(["related", "toxic", "long", "multi_line", "child_alone"], sums))
    _, kept = filters.drop_constant_labels(train, labels)
    assert kept == ["related", "toxic", "long", "multi_line"]  # only child_alone is constant


def test_genre_counts_over_d1_rows(spark):
    clean, _ = etl.clean_table(spark, "/root/testdata/sf0.01")
    genres = {r.genre: r.n for r in profile.value_counts(clean, "genre").collect()}
    assert genres == {"en": 262, "fr": 52, "de": 46, "es": 39}
