"""Plans keep their shape: pruned scans, pushed filters, narrow shuffles, no cross joins."""

import re

import pytest

from lexforge.plans import registry


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (\S+)", plan)


@pytest.mark.parametrize(
    ("name", "never"),
    [("v02_entry_issues", "body:"), ("j01_resolved_links", "article_body"), ("d01_accepted_states", "title"), ("t11_headword_index", "wikitext"), ("t01_title_terms", "html"), ("t08_headwords", "html"), ("t09_collisions", "html"), ("t10_single_candidates", "html"), ("proj02_redirects", "html"), ("j03_redirect_aliases", "html"), ("a02_table_counts", "text:"), ("w01_systematic_sample", "text:"), ("v01_duplicate_keys", "article_body")],
)
def test_scans_read_only_what_is_needed(spark, small, name, never):
    for s in schemas(plan_of(registry.QUERIES[name](spark, small))):
        assert never not in s


def test_filters_reach_the_scan(spark, small):
    assert "IsNotNull(page_id)" in plan_of(registry.QUERIES["d01_accepted_states"](spark, small))
    assert "IsNotNull(title)" in plan_of(registry.QUERIES["t11_headword_index"](spark, small))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_query_multiplies_its_tables(spark, small, name):
    plan = plan_of(registry.QUERIES[name](spark, small))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bodies_are_hashed_before_the_shuffle(spark, small):
    plan = plan_of(registry.QUERIES["p2_validity"](spark, small))
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "html" not in line and "article_body" not in line


@pytest.mark.parametrize("name", ["h04_block_counts", "x19_strata", "x20_content_hashes", "p3_messages"])
def test_bodies_are_read_where_they_lie(spark, small, name):
    for line in plan_of(registry.QUERIES[name](spark, small)).splitlines():
        if "Exchange hashpartitioning" in line:
            assert "html" not in line and "article_body" not in line
