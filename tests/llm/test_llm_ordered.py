from collections import Counter

import pytest
from llm_fixtures import prose, rows, table

from tripfold.llm import ordered


@pytest.mark.parametrize("buckets", [2, 3, 8, 33])
def test_buckets_follow_the_order(spark, buckets):
    docs = ordered.placed(table(spark, rows()))
    bounds = ordered.row_bounds(docs, buckets)
    assert 0 < len(bounds) < buckets and bounds == sorted(set(bounds))
    found = ordered.kept(docs.withColumn("bucket", ordered.bucket_of(bounds))).collect()
    order = sorted(found, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.hash, r.salt))
    assert [r.bucket for r in order] == sorted(r.bucket for r in order)
    for r in found:
        assert r.bucket == ordered.bucket_of_place(bounds, r.doc_id, r.hash, r.salt)


def test_a_third_without_an_id_or_under_one_id_is_spread(spark):
    """Also where the texts are all equal."""
    text = "the same few words " * 3
    data = [(None, text, "en", "a", 0, "", "", 0)] * 200 + [(7, text, "en", "a", 0, "", "", 0)] * 200
    data += [(100 + i, prose(i, 12), "en", "a", 0, "", "", 0) for i in range(200)]
    docs = ordered.placed(table(spark, data))
    bounds = ordered.row_bounds(docs, 12)
    sizes = Counter(r.bucket for r in docs.withColumn("bucket", ordered.bucket_of(bounds)).collect())
    assert len(sizes) >= 11 and max(sizes.values()) < 3 * 600 / 12


def test_shares_are_cut_by_bytes(spark):
    data = [(i, "x" * (100_000 if i < 20 else 10), "en", "a", 0, "", "", 0) for i in range(400)]
    docs = ordered.placed(table(spark, data))
    bounds = ordered.row_bounds(docs, 5)
    long = Counter(r.bucket for r in docs.withColumn("bucket", ordered.bucket_of(bounds)).where("length(text) > 10").collect())
    assert max(long.values()) <= 7  # 20 in 5 buckets, cut by a sample
    assert ordered.row_bounds(docs, 5, least_bytes=1 << 30) == [] == ordered.row_bounds(docs.limit(0), 5)
