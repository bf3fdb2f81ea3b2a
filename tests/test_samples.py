"""The ten examples on the 28 sample documents."""

import pytest
from pyspark.sql import functions as F

from logsieve.operators.clauses import compound, find, regex, text
from logsieve.operators.facets import facet, ordered
from logsieve.operators.search import search
from logsieve.plans import catalogue
from samples import sample_documents

ERRORS = {"server_logs.txt", "nginx_access.log", "firewall_events.txt", "k8s_events.txt", "cicd_pipeline.log",
          "critical_alerts.txt", "smtp_delivery.log", "user_management.log", "service_mesh.log",
          "rate_limiter.log", "db_replication.log"}
TROUBLE = {"server_logs.txt", "error_dump.txt", "access_log.txt", "migration_v2.sql.log", "firewall_events.txt",
           "k8s_events.txt", "slow_query.log", "cicd_pipeline.log", "critical_alerts.txt", "smtp_delivery.log",
           "user_management.log", "cron_report.txt", "service_mesh.log", "rate_limiter.log", "db_replication.log"}


@pytest.fixture(scope="module")
def docs(spark):
    return sample_documents(spark).cache()


def names(rows):
    found = [r["filename"] for r in rows.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_the_samples(docs):
    assert docs.count() == 28
    types = {r["type"]: r["n"] for r in docs.groupBy("metadata.type").agg(F.count("*").alias("n")).collect()}
    assert (types["log"], types["config"], types["metric"], len(types)) == (11, 4, 3, 10)
    filled = docs.agg(F.count("metadata.server"), F.count("metadata.endpoint"), F.count("metadata.application")).first()
    assert tuple(filled) == (25, 2, 1)


def test_example_1(docs):
    assert names(catalogue.error_dates(docs)) == ERRORS
    assert catalogue.error_dates(docs, 10).count() == 10


def test_example_2(docs):
    rows = {r["filename"]: [(m["match"], m["idx"]) for m in r["matched_emails"]] for r in catalogue.emails(docs).collect()}
    assert rows == {
        "api_response.json": [("John@Example.com", 61), ("Jane@Test.org", 101)],
        "nginx_access.log": [("alice@example.com", 15), ("bob@example.com", 195)],
        "cicd_pipeline.log": [("carol@example.com", 89)],
        "smtp_delivery.log": [("alice@example.com", 39), ("carol@Test.org", 143), ("noreply@example.com", 259),
                              ("eve@example.com", 391)],
        "user_management.log": [("frank@example.com", 44), ("henry@Test.org", 219), ("ivan@example.com", 316)],
        "rate_limiter.log": [("bot@example.com", 263)]}


def test_example_3(docs):
    assert names(catalogue.json_field(docs)) == {"config.json"}


def test_example_4(docs):
    assert names(catalogue.trouble(docs)) == TROUBLE


def test_example_5(docs):
    rows = {r["filename"]: (len(r["error_lines"]), r["error_count"]) for r in catalogue.error_lines(docs).collect()}
    assert set(rows) == ERRORS
    two = {"server_logs.txt", "db_replication.log"}
    assert all(counts == ((2, 2) if name in two else (1, 1)) for name, counts in rows.items())


def test_example_6(docs):
    rows = {r["filename"]: [m["match"] for m in r["ip_addresses"]] for r in catalogue.addresses(docs).collect()}
    assert len(rows) == 15
    assert rows["network.json"] == ["192.168.1.1", "8.8.8.8", "8.8.4.4", "192.168.1.0"]
    assert rows["nginx_access.log"] == ["192.168.1.42", "10.0.0.77", "172.16.0.9", "10.0.0.91"]
    assert rows["rate_limiter.log"] == ["203.0.113.77", "203.0.113.77"]


def test_example_7(docs):
    found = names(catalogue.without_error(docs))
    assert len(found) == 17 and not found & ERRORS


def test_example_8(docs):
    row = catalogue.text_against_regex(docs).first()
    assert (row["hits"], row["baseline_hits"], row["same"]) == (11, 11, True)
    words, patterns = catalogue.text_hits(docs), catalogue.regex_hits(docs)
    assert names(words) == names(patterns) == ERRORS
    assert words.columns == patterns.columns == ["doc_id", "filename", "metadata", "score"]
    assert {r["score"] for r in patterns.collect()} == {1.0} and min(r["score"] for r in words.collect()) > 0


def test_example_9(docs):
    rows = [(r["bucket"], r["is_total"], r["n"]) for r in ordered(catalogue.trouble_by_type(docs)).collect()]
    assert rows == [(None, True, 15), ("log", False, 9), ("security_log", False, 2), ("alert", False, 1),
                    ("audit", False, 1), ("error", False, 1), ("slow_query", False, 1)]


def test_example_10(docs):
    assert names(catalogue.warn_dates(docs)) == TROUBLE - {"error_dump.txt"}


def test_compound_is_not_the_plain_regex(docs):
    trouble = regex("content", catalogue.TROUBLE)
    both = compound(filter=[text("content", "Exception Error WARN")], must=[trouble])
    assert docs.filter(trouble.holds).count() == 15
    assert docs.filter(both.holds).count() == 14


def test_stored_lower_copy_equals_lower_at_query_time(docs):
    stored = search(docs, regex("content_lc", catalogue.EMAIL_LOWER), ("filename",))
    asked = search(docs, regex("content", catalogue.EMAIL_LOWER, on="lower"), ("filename",))
    assert names(stored) == names(asked)


def test_facet_sums_to_its_total(docs):
    rows = facet(docs, find("content", "INFO"), "metadata.type").collect()
    assert sum(r["n"] for r in rows if not r["is_total"]) == next(r["n"] for r in rows if r["is_total"])
