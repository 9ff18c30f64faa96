"""Registered queries against their SQL. CASEFLOW_ALL_ORACLES=1 runs every one."""

import os

import pytest

from caseflow.plans.queries import ORACLES, QUERIES
from tools.check_oracles import connect, differences

SF_DIR = "/root/testdata/sf0.001"
QUICK = [
    "reply_components", "drop_accounting", "turn_index", "resolution_pairs", "brand_profile", "clean_text",
    "tag_first_match", "golden_set", "word_tfidf", "conditioned_topk", "score_reply", "streaming_gates",
]
NAMES = list(ORACLES) if os.environ.get("CASEFLOW_ALL_ORACLES") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(found, connect(SF_DIR).execute(ORACLES[name]).df()) is None


def test_every_check_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
