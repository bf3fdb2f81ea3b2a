"""Times the headline queries and prints one JSON line.

Log documents, prose and their token tables are loaded first, as a search service loads and
indexes before it answers; that time is reported but is not part of the total. Each query
is warmed up once and run RUNS times; its time is the mean. Dense queries fetch their first
rows, selective ones all hits. ``detail`` has the other statistics and the rows of each query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from logsieve.functions.extract import count_matches, find_all, find_records, matching_lines  # noqa: E402
from logsieve.operators import report  # noqa: E402
from logsieve.operators.clauses import compound, find, find_not, regex, text, wildcard  # noqa: E402
from logsieve.operators.facets import facet  # noqa: E402
from logsieve.operators.nearest import nearest  # noqa: E402
from logsieve.operators.relevance import rank  # noqa: E402
from logsieve.operators.search import search  # noqa: E402
from logsieve.operators.textindex import TokenIndex  # noqa: E402
from logsieve.plans import catalogue  # noqa: E402
from logsieve.plans.registry import Tables  # noqa: E402
from logsieve.session import local_session  # noqa: E402
from logsieve.sources.logs import matching_log_lines  # noqa: E402
from logsieve.sources.tables import library_path  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CORES = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def run(frame) -> None:
    """Compute every row and column, and keep nothing."""
    frame.write.format("noop").mode("overwrite").save()


def timed(action) -> list[float]:
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return times


DATE, DATED = "[0-9]{4}-[0-9]{2}-[0-9]{2}", "(.*)[0-9]{4}-[0-9]{2}-[0-9]{2}(.*)"
GNU = "GNU General Public License, version [0-9]"


def scenarios() -> dict:
    """``(table, words of the compound form or none, {strategy: clause})`` by kind and number."""
    found = catalogue.TROUBLE
    return {
        "dense01": ("logs", None, {"find": find("content", "ERROR"), "whole": regex("content", "(.*)ERROR(.*)"), "text": text("content", "ERROR")}),
        "dense02": ("logs", None, {"find": find("content", DATE), "whole": regex("content", DATED)}),
        "dense03": ("prose", None, {"find": find("content", "license", "i"), "whole": regex("content", "(.*)license(.*)", on="lower")}),
        "dense04": ("logs", None, {"find": find("content", "(Exception|Error|WARN)"), "whole": regex("content", found)}),
        "dense05": ("prose", None, {"find": find("content", catalogue.IP), "whole": regex("content", f"(.*){catalogue.IP}(.*)")}),
        "dense06": ("logs", None, {"find": find("content", '"k":[ ]*[0-9]+'), "whole": regex("content", r'(.*)(\"k\":[ ]*[0-9]+)(.*)')}),
        "selective07": ("logs", "69", {"find": find("content", "ERROR.*69"), "whole": regex("content", "(.*)ERROR(.*)69(.*)")}),
        "selective08": ("prose", "gnu", {"find": find("content", "GNU.*version [0-9]"), "whole": regex("content", "(.*)GNU(.*)version [0-9](.*)")}),
        "selective09": ("prose", "gnu", {"find": find("content", GNU), "whole": regex("content", f"(.*){GNU}(.*)")}),
        "negation10": ("logs", None, {"find": find_not("content", "ERROR"), "whole": compound(
            filter=[wildcard("content", "*")], must_not=[regex("content", "(.*)ERROR(.*)")])}),
    }


def scenario_frames(docs: dict, indexes: dict) -> dict:
    """Each scenario under each strategy; the compound form asks the token table first, then the pattern."""
    frames = {}
    for name, (table, words, clauses) in scenarios().items():
        limit = 0 if name.startswith("selective") else catalogue.SCENARIO_LIMIT
        for strategy, clause in clauses.items():
            frames[f"{name}_{strategy}"] = lambda t=table, c=clause, n=limit: search(docs[t], c, limit=n)
        if words:
            frames[f"{name}_compound"] = (lambda t=table, w=words, c=clauses["whole"], n=limit:
                                          search(indexes[t].matching(docs[t], w), c, limit=n))
    return frames


def winners(results: dict) -> dict:
    """The fastest strategy of each scenario."""
    best: dict[str, str] = {}
    for name in results:
        scenario = name.rsplit("_", 1)[0]
        kind = name.startswith(("dense", "selective", "negation"))
        if kind and (scenario not in best or results[name] < results[best[scenario]]):
            best[scenario] = name
    return {k: v.rsplit("_", 1)[1] for k, v in best.items()}


def action_of(name: str, build):
    """A limited query fetches its rows; any other is computed in full."""
    if name.startswith(("dense", "negation")):
        return lambda: build().collect()
    return lambda: run(build())


def main() -> None:
    spark = local_session("bench", CORES)
    tables = Tables(spark, FOLDER)
    start = time.perf_counter()
    docs = {"logs": tables.logs(), "prose": tables.loaded("prose", tables.prose)}
    prose, logs = docs["prose"], docs["logs"]
    indexes = {name: TokenIndex.ensure(rows, library_path(spark, f"bench-index-{name}")) for name, rows in docs.items()}
    index = indexes["prose"]
    load = time.perf_counter() - start

    content, ip = F.col("content"), catalogue.IP
    vector = tables.embeddings.filter("vec_id = 0").first()["embedding"]
    samples = tables.events.select(F.col("event_type").alias("method"), F.col("value").alias("ms"))
    frames = scenario_frames(docs, indexes) | {
        "logs_error_lines": lambda: catalogue.error_lines(logs),
        "logs_facet": lambda: facet(logs, regex("content", catalogue.TROUBLE), "metadata.type"),
        "logs_load_catalogue": lambda: catalogue.hit_counts(logs, catalogue.load_clauses()),
        "events_error_lines": lambda: matching_log_lines(
            tables.events, lambda x: x.contains("ERROR"), lambda x: count_matches(x, "ERROR")),
        "prose_find_literal": lambda: search(prose, find("content", "license")),
        "prose_find_any_case": lambda: search(prose, find("content", "licen[cs]e", "i")),
        "prose_lower": lambda: search(prose, regex("content", "(.*)licen[cs]e(.*)", on="lower")),
        "prose_ip_extract": lambda: search(prose, find("content", ip), ("doc_id", find_records(content, ip).alias("m"))),
        "prose_negation": lambda: search(prose, find_not("content", "the")),
        "prose_text": lambda: search(prose, text("content", "license gnu")),
        "prose_compound": lambda: search(prose, compound(filter=[text("content", "license")],
                                                 must=[find("content", "[Vv]ersion [0-9]")])),
        "prose_should": lambda: search(prose, compound(should=[text("content", "license"), find("content", ip)]), score=True),
        "prose_wildcard": lambda: search(prose, wildcard("content", "*license*")),
        "prose_count_numbers": lambda: prose.select("doc_id", count_matches(content, "[0-9]+").alias("n")),
        "prose_lines": lambda: search(prose, find("content", "licen[cs]e"),
                              ("doc_id", matching_lines(content, "licen[cs]e").alias("l"))),
        "prose_find_all": lambda: prose.select("doc_id", find_all(content, "[A-Z][a-z]+").alias("m")),
        "prose_bm25_scan": lambda: rank(prose, "license gnu", 20),
        "index_bm25": lambda: index.rank("license gnu", 20),
        "index_semi_join": lambda: index.matching(prose, "license gnu").select("doc_id"),
        "nearest_cosine": lambda: nearest(tables.embeddings, vector, 10),
        "latency_summary": lambda: report.latency_summary(samples, by=("method",)),
        "latency_percentiles": lambda: report.percentiles(samples, by=("method",)),
    }
    results, detail = {}, {}
    for name, build in frames.items():  # built anew for each run, so that planning is timed too
        times = timed(action_of(name, build))
        results[name] = round(statistics.mean(times), 4)
        detail[name] = {"median": round(statistics.median(times), 4), "min": round(min(times), 4),
                        "max": round(max(times), 4),
                        "stdev": round(statistics.stdev(times), 4) if len(times) > 1 else 0.0,
                        "rows": build().count()}
    documents = {name: rows.count() for name, rows in docs.items()}
    spark.stop()
    print(json.dumps({
        "metric": "total mean seconds of all queries", "value": round(sum(results.values()), 4), "unit": "sec",
        "queries": results, "sf": os.path.basename(FOLDER).removeprefix("sf"), "documents": documents,
        "load_sec": round(load, 2), "runs": RUNS, "winners": winners(results), "detail": detail}))


if __name__ == "__main__":
    main()
