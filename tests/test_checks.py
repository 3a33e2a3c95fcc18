"""Every query against its independent SQL, and the shuffled ways as well."""

import os

import pytest

from __spark_entry__ import clinical_queries, clinical_sql, entry
from casebook.compare import compare, oracle
from tests.conftest import SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")

# Queries whose joins would broadcast on small tables.
SHUFFLED = [
    "vocab_lookup", "harmonize_chain", "target_replacement", "harmonize_shared_keys", "exclude_settled",
    "secondary_backfill", "dedupe_keys", "drug_era", "participant_filter", "observation_period_death",
]


@pytest.fixture(scope="module")
def connection():
    return oracle(SMALL)


def test_every_query_has_a_check():
    assert set(clinical_queries()) == set(clinical_sql())


@pytest.mark.parametrize("name", list(clinical_queries()))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, SMALL) is None


@pytest.mark.parametrize("name", SHUFFLED)
def test_query_without_broadcast(spark, connection, no_broadcast, name):
    assert compare(spark, connection, name, SMALL) is None


def test_entry(spark):
    assert {"target_table", "row_count"} == set(entry(spark).columns)
