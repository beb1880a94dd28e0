"""Time the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from corpusmill.catalog import queries as q
from corpusmill.operators import profile as pr
from corpusmill.session import build_session, clear_scratch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def profile_of(name: str):
    return lambda spark, folder: pr.validate(q.table(spark, folder, name))


HEADLINE = {
    "clean_and_gate": q.QUERIES["clean_batch"],
    "corpus_overview": q.QUERIES["corpus_overview"],
    "profile_documents": lambda spark, folder: pr.validate(q.documents(spark, folder)),
    "profile_events": profile_of("events"),
    "profile_lineitem": profile_of("lineitem"),
    "special_characters": q.QUERIES["rule_special_chars_stats"],
    "tokens": q.QUERIES["ann_tokens"],
    "entities": q.QUERIES["ann_entities"],
    "sentiment": q.QUERIES["ann_sentiment"],
    "topics": q.QUERIES["ann_topics"],
    "keywords": q.QUERIES["ann_keywords"],
    "language_id": q.QUERIES["lang_id"],
    "annotate_text": q.QUERIES["annotate_text"],
    "end_to_end": q.QUERIES["end_to_end"],
}


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        "bench",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, run in HEADLINE.items():
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
            clear_scratch(spark)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
