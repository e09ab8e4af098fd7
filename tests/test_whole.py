"""The queries over the taxonomy take every entry, those too that break a declared rule."""

import os

import pytest
from pyspark.sql import functions as F

from vidmart import proxies, queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")
REGISTERED = queries.registered()


def every_id(spark):
    """The lower id of the two spellings that each word has."""
    ids = proxies.taxonomy(spark, SF_DIR).where(F.col("hashtag_id").startswith("HT"))
    return {r.hashtag_id for r in ids.collect()}


def test_tag_categories_know_every_entry(spark):
    found = REGISTERED["tag_categories"](spark, SF_DIR).where("hashtag_id is not null")
    seen = {r.hashtag_id for r in found.select("hashtag_id").distinct().collect()}
    valid = {r.hashtag_id for r in REGISTERED["dim_hashtag"](spark, SF_DIR).collect()}
    assert valid < seen <= every_id(spark)


def test_bridge_pairs_know_every_entry(spark):
    pairs = REGISTERED["bridge_pairs"](spark, SF_DIR)
    seen = {r.hashtag_id for r in pairs.select("hashtag_id").distinct().collect()}
    valid = {r.hashtag_id for r in REGISTERED["dim_hashtag"](spark, SF_DIR).collect()}
    assert valid < seen <= every_id(spark)


def test_brand_safety_usage_counts_every_entry(spark):
    counted = REGISTERED["brand_safety_usage"](spark, SF_DIR).agg({"hashtags": "sum"}).first()[0]
    assert counted == len(every_id(spark))
