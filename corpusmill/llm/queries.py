"""The queries of this subpackage: (spark, folder of parquet tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    conversation,
    decontaminate,
    fingerprint,
    license_scan,
    line_dedup,
    minhash,
    packing,
    resample,
    secret_scan,
    simhash,
    toxicity,
    url_filter,
    warc,
)

TOKENIZER = "byte_bpe_50k.json"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_packing(spark, folder):
    docs = table(spark, folder, "documents")
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


@query
def op2_licenses(spark, folder):
    """A row for each notice found."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return license_scan.find_licenses(docs).select("doc_id", F.inline("licenses"))


@query
def op3_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, table(spark, folder, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op4_fingerprints(spark, folder):
    return fingerprint.edited_fingerprints(table(spark, folder, "documents"))


@query
def op5_secrets(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs)

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def only(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = [rule.kind for rule in secret_scan.BASE_RULES]
    return found.select(
        "doc_id",
        *[F.size(only(kind)).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(listed(only(*base)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op6_decontamination(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, folder, "benchmark")).drop("id_hash", "version")


URL_RULES = [
    url_filter.UrlRule("block", "net", "/"),
    url_filter.UrlRule("allow", "example.net", "/en/"),
    url_filter.UrlRule("block", "example.com", "/de/"),
    url_filter.UrlRule("allow", "org", "/fr/"),
]


@query
def op7_url_filter(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    model = url_filter.train(url_filter.labelled_by_words(pages))
    return url_filter.judge_urls(pages, model, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op8_near_duplicates(spark, folder):
    docs = table(spark, folder, "documents")
    return minhash.near_duplicates(docs, width=3, percent=85).drop("id_hash", "version")


@query
def op9_warc(spark, folder):
    return warc.archive_round_trip(spark, table(spark, folder, "pages"))


@query
def op10_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query
def op11_resampling(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return resample.resample(docs, table(spark, folder, "benchmark"))


@query
def op12_simhash(spark, folder):
    return simhash.simhash_groups(table(spark, folder, "documents"))


@query
def op13_conversations(spark, folder):
    talks = table(spark, folder, "conversations")
    return conversation.audits_of_all(talks, conversation.damaged(talks))
