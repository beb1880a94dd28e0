"""One callable per operator: (spark, folder of parquet tables) -> DataFrame.

Doubles are rounded to 6 decimals and counts are bigint, so that another engine's
results compare equal. Arrays are shown as rows or as joined text.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AnnotationConfig
from ..functions import cleaning, gates, scoring
from ..functions.instructions import command_words, instruction
from ..functions.text import named, sentences, tokens
from ..operators import batch_gate as bg
from ..operators import profile as pr
from ..operators import rules, sketches
from ..operators.annotate import annotate
from ..operators.entities import DEFAULT_GAZETTEER, entities, entity_matcher
from ..operators.integrity import integrity, orphans
from ..operators.keywords import keywords
from ..operators.language import LanguageModel
from ..operators.sentiment import model_sentiment, sentiment, train_sentiment
from ..operators.tagging import DEFAULT_TAGS, linguistic_annotation, pos_tags, sentence_annotations, token_table
from ..operators.lookups import LiteralLookup
from ..operators.topics import ranked_topics, topics
from ..plans import processing, reports
from ..session import scratch_path
from ..sources import readers, writers
from ..sources.listing import list_datasets
from ..streaming.rowwise import clean_stream, write_available
from .seeded import SEEDED_SQL

JOINER = "\u001f"
AS_OF = "2024-01-31 00:00:00"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents; their one file would keep one core busy, so they are dealt to all."""
    return readers.spread(table(spark, folder, "documents"), spark.sparkContext.defaultParallelism)


def seeded(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(SEEDED_SQL, documents=documents(spark, folder))


def seeded_texts(spark: SparkSession, folder: str) -> DataFrame:
    return seeded(spark, folder).select("doc_id", "text")


def r6(column) -> Column:
    return F.round(column, 6)


def rounded(df: DataFrame) -> DataFrame:
    """Round doubles, widen integers."""
    columns = []
    for name, kind in df.dtypes:
        column = named(name)
        if kind in ("double", "float"):
            column = F.round(column, 6).alias(name)
        elif kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint").alias(name)
        columns.append(column)
    return df.select(*columns)


def gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """(phrase, label): the regions, and the built-in organisations and persons."""
    regions = table(spark, folder, "region").select(
        F.col("r_name").alias("phrase"), F.lit("GPE").alias("label")
    )
    known = spark.createDataFrame(
        sorted((p, l) for p, l in DEFAULT_GAZETTEER.items() if l != "GPE"),
        "phrase string, label string",
    )
    return regions.unionByName(known)


def large_gazetteer(spark: SparkSession, folder: str) -> DataFrame:
    """(phrase, label): long words of the documents, and the two words they open with; far too many
    for an expression."""
    docs = table(spark, folder, "documents")
    words = docs.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{9,}"), F.lit(0))).alias("phrase"))
    openings = docs.select(F.regexp_extract("text", "^[A-Z][a-z]* [a-z]+", 0).alias("phrase"))
    return words.distinct().withColumn("label", F.lit("WORD")).union(
        openings.where(F.col("phrase") != "").distinct().withColumn("label", F.lit("OPENING"))
    )


# Sources and sinks. What is listed and read was written from the tables before.


def _as_files(spark: SparkSession, folder: str) -> str:
    root = scratch_path(spark, "datasets")
    docs = documents(spark, folder)
    writers.write_table(docs, f"{root}/csv/docs.csv", "csv")
    writers.write_table(table(spark, folder, "conversations"), f"{root}/jsonl/talks.jsonl", "jsonl")
    return root


@query
def src_list_datasets(spark, folder):
    """Name and extension of each dataset, the part files folded into it."""
    root = _as_files(spark, folder)
    return list_datasets(spark, root).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "extension", (F.col("bytes") > 0).alias("filled")
    )


@query
def src_csv_scan(spark, folder):
    path = f"{scratch_path(spark, 'csv')}/docs.csv"
    writers.write_table(documents(spark, folder), path, "csv")
    return rounded(readers.read_dataset(spark, path, "csv"))


@query
def src_csv_multi_line(spark, folder):
    """The same, cut by ranges into records, of which many hold line breaks."""
    path = f"{scratch_path(spark, 'csv')}/docs.csv"
    writers.write_table(documents(spark, folder), path, "csv")
    return rounded(readers.read_csv(spark, path, multi_line=True, split=True))


# A JSON document of several rows holds about so many, whatever the table's size.
ROWS_PER_DOCUMENT = 10_000


def _write_json_files(spark: SparkSession, folder: str, root: str) -> None:
    """The conversations as JSON of all kinds: a third as records by line, a third as one array
    over several lines in each file, a third as columns of cells."""
    talks = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    share = F.pmod(F.col("conv_id"), F.lit(3))
    writers.write_table(talks.where(share == 0), f"{root}/by_line.json", "json")
    row = F.to_json(F.struct("conv_id", "turn", "role", "text"))

    def dealt(k: int) -> tuple[DataFrame, int]:
        # By the row's number too: copies of one row would meet in one document.
        rows = talks.where(share == k)
        parts = max(8, -(-rows.count() // ROWS_PER_DOCUMENT))
        numbered = rows.withColumn("at", F.monotonically_increasing_id())
        part = F.pmod(F.xxhash64("conv_id", "turn", "at"), F.lit(parts))
        return numbered.groupBy(part.alias("part")), parts

    groups, parts = dealt(1)
    (
        groups.agg(F.collect_list(row).alias("rows"))
        .select(F.concat(F.lit("[\n"), F.array_join("rows", ",\n"), F.lit("\n]\n")))
        .repartition(parts // 2)
        .write.text(f"{root}/array.json")
    )
    cells = F.sort_array(F.collect_list(F.struct("conv_id", "turn", "role", "text")))

    def column(name: str) -> Column:
        pairs = F.transform(F.col("rows"), lambda r, i: F.struct(i.cast("string"), r[name]))
        return F.map_from_entries(pairs).alias(name)

    groups, parts = dealt(2)
    (
        groups.agg(cells.alias("rows"))
        .select(F.to_json(F.struct(*[column(c) for c in ("conv_id", "turn", "role", "text")])))
        .repartition(parts // 2)
        .write.text(f"{root}/columns.json")
    )


@query
def src_json_scan(spark, folder):
    """JSON files of all kinds, several documents in some, read with all values."""
    root = scratch_path(spark, "json")
    _write_json_files(spark, folder, root)
    found = [readers.read_dataset(spark, f"{root}/{kind}.json") for kind in ("by_line", "array", "columns")]
    columns = ["conv_id", "turn", "role", "text"]
    return found[0].select(columns).union(found[1].select(columns)).union(found[2].select(columns))


@query
def src_read_dataset(spark, folder):
    """All values of the conversations by format, each read through the dispatch; a text file has
    the roles only."""
    root = scratch_path(spark, "formats")
    talks = table(spark, folder, "conversations")
    result = None
    for fmt in ("csv", "json", "jsonl", "parquet", "txt"):
        path = f"{root}/talks.{fmt}"
        source = talks.select(F.col("role").alias("value")) if fmt == "txt" else talks
        writers.write_table(source, path, fmt)
        df = readers.read_dataset(spark, path)
        if fmt == "txt":
            row = df.select(
                *[F.lit(None).cast("bigint").alias(c) for c in ("conv_id", "turn")],
                F.col("text").alias("role"),
                F.lit(None).cast("string").alias("text"),
            )
        else:
            row = df.select("conv_id", "turn", "role", "text")
        row = row.select(F.lit(fmt).alias("format"), "*")
        result = row if result is None else result.unionByName(row)
    return result


@query
def src_text_columns(spark, folder):
    return rounded(readers.text_column_lengths(seeded(spark, folder)))


def _processed(spark, folder) -> DataFrame:
    """The documents, processed, written and read back."""
    path = scratch_path(spark, "processed")
    docs = seeded_texts(spark, folder)
    writers.write_table(processing.process_table(docs, ["text"]), path)
    return spark.read.parquet(path)


@query
def snk_processed(spark, folder):
    return _processed(spark, folder).select(
        "doc_id",
        "text_cleaned",
        F.size("text_annotations").cast("bigint").alias("n_annotations"),
        F.array_join(
            F.transform("text_annotations", lambda a: F.array_join(a["tokens"], " ")), JOINER
        ).alias("tokens"),
    )


@query
def column_metrics(spark, folder):
    return rounded(processing.column_metrics(_processed(spark, folder), ["text"]))


@query
def end_to_end(spark, folder):
    """List, read, detect, clean, gate, annotate, write: a table written as a dataset."""
    root, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    writers.write_table(seeded_texts(spark, folder), f"{root}/docs.csv", "csv")
    status = processing.process_datasets(
        spark, root, out, multi_line=True, parts=spark.sparkContext.defaultParallelism
    )
    failed = status.where("status <> 'done'").collect()
    if failed:
        raise RuntimeError(str(failed))
    return spark.read.parquet(f"{out}/docs.csv/table").select(
        "doc_id", "text_cleaned", F.size("text_annotations").cast("bigint").alias("n_annotations")
    )


@query
def snk_annotated(spark, folder):
    """JSON and JSON-lines datasets, annotated with keywords, written in their own format, read back."""
    root = scratch_path(spark, "annotate")
    docs = seeded_texts(spark, folder)
    result = None
    for fmt in ("json", "jsonl"):
        writers.write_table(docs, f"{root}/docs.{fmt}", fmt)
        processing.annotate_dataset(
            spark, f"{root}/docs.{fmt}", f"{root}/annotated.{fmt}", row_key="doc_id"
        )
        read = readers.read_dataset(spark, f"{root}/annotated.{fmt}").select(
            F.lit(fmt).alias("format"),
            "doc_id",
            F.col("text_annotations.sentiment.label").alias("sentiment"),
            F.when(
                F.col("text_annotations").isNotNull(), F.size("text_annotations.entities")
            ).cast("bigint").alias("n_entities"),
            F.col("text_annotations.instruction.is_instruction").alias("is_instruction"),
            F.coalesce(F.size("text_annotations.keywords"), F.lit(0)).cast("bigint").alias("n_keywords"),
        )
        result = read if result is None else result.union(read)
    return result


@query
def quality_report(spark, folder):
    report = reports.quality_report(seeded(spark, folder), "documents", timestamp="20240131_000000")
    return report.select(
        "dataset",
        "timestamp",
        "passed",
        F.array_join("issues", JOINER).alias("issues"),
        *[r6(F.col(f"metrics.{d}")).alias(d) for d in pr.QUALITY_DIMENSIONS],
        r6("overall_score").alias("overall_score"),
        F.col("dataset_stats.rows").alias("n_rows"),
        F.col("dataset_stats.columns").alias("n_columns"),
    )


@query
def quality_report_text(spark, folder):
    """The text report less its memory line, whose estimate is Spark's own."""
    report = reports.quality_report(seeded(spark, folder), "documents", timestamp="20240131_000000")
    lines = reports.report_lines(report).where(~F.col("line").startswith("Memory Usage: "))
    return rounded(lines.select("line_no", "line"))


@query
def dataset_stats(spark, folder):
    stats = reports.dataset_stats(documents(spark, folder))
    return stats.select(
        F.col("rows").alias("n_rows"),
        F.col("columns").alias("n_columns"),
        F.array_join(F.array_sort(F.map_keys("column_types")), ",").alias("column_names"),
    )


# Cleaning.


def _cleaned(spark, folder, step) -> DataFrame:
    return seeded_texts(spark, folder).select("doc_id", step(F.col("text")).alias("cleaned"))


@query
def clean_boilerplate(spark, folder):
    return _cleaned(spark, folder, cleaning.drop_boilerplate_words)


@query
def clean_signature(spark, folder):
    return _cleaned(spark, folder, cleaning.remove_boilerplate)


@query
def clean_blank_lines(spark, folder):
    return _cleaned(spark, folder, cleaning.collapse_blank_lines)


@query
def clean_spacing(spark, folder):
    return _cleaned(spark, folder, cleaning.standardize_format)


@query
def clean_control_chars(spark, folder):
    return _cleaned(spark, folder, cleaning.remove_control_chars)


@query
def clean_quotes(spark, folder):
    return _cleaned(spark, folder, cleaning.straighten_quotes)


@query
def clean_batch(spark, folder):
    return processing.clean_texts(seeded_texts(spark, folder), "text")


@query
def clean_aligned(spark, folder):
    return processing.clean_aligned(seeded_texts(spark, folder), "text").select(
        "doc_id", "text_cleaned"
    )


@query
def stream_clean(spark, folder):
    """The documents as a stream of files, cleaned and gated as they come, written, and read back."""
    root = scratch_path(spark, "stream")
    seeded_texts(spark, folder).write.parquet(f"{root}/in")
    arriving = spark.readStream.schema("doc_id bigint, text string").option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    done = write_available(clean_stream(arriving, "text"), f"{root}/out", f"{root}/checkpoint")
    done.awaitTermination()
    return spark.read.parquet(f"{root}/out").select("doc_id", "text", "text_instruction.is_instruction")


# Gates.


def _gated(spark, folder, predicate: Column) -> DataFrame:
    return seeded_texts(spark, folder).select(
        "doc_id", F.coalesce(predicate, F.lit(False)).alias("accepted")
    )


@query
def gate_length(spark, folder):
    return _gated(spark, folder, gates.length_ok(F.col("text")))


@query
def gate_words(spark, folder):
    return _gated(spark, folder, gates.words_ok(F.col("text")))


@query
def gate_entity_density(spark, folder):
    docs, matcher = entity_matcher(seeded_texts(spark, folder), "text")
    return _gated(
        spark, folder, gates.entity_density_ok(F.col("text"), matcher.has_entity(F.col("text")))
    )


@query
def gate_quality(spark, folder):
    docs, matcher = entity_matcher(seeded_texts(spark, folder), "text")
    return _gated(
        spark, folder, gates.quality_ok(F.col("text"), matcher.has_entity(F.col("text")))
    )


@query
def gate_quality_large(spark, folder):
    """Cleaning and gates with a gazetteer that is joined."""
    docs = seeded_texts(spark, folder)
    return processing.clean_aligned(docs, "text", gazetteer=large_gazetteer(spark, folder), row_key="doc_id").select(
        "doc_id", "text_cleaned"
    )


@query
def batch_gate(spark, folder):
    """Both outcomes: the customers pass the gate, the seeded documents do not."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    passed = bg.batch_gate(customers).agg(F.count(F.lit(1)).alias("n_rows"))
    docs = bg.batch_gate(seeded(spark, folder)).agg(F.count(F.lit(1)).alias("n_rows"))
    return passed.select(F.lit("customer").alias("dataset"), "n_rows").unionByName(
        docs.select(F.lit("seeded").alias("dataset"), "n_rows")
    )


def _gate_score(name: str) -> Query:
    def run(spark, folder):
        return rounded(bg.gate_scores(seeded(spark, folder)).select(name))

    run.__name__ = f"bg_{name}"
    return query(run)


for _name in ("completeness", "consistency", "validity", "uniqueness"):
    _gate_score(_name)


# Quality dimensions.


@query
def q_completeness(spark, folder):
    return rounded(pr.completeness(seeded(spark, folder)))


@query
def q_consistency(spark, folder):
    return rounded(pr.consistency(seeded(spark, folder)))


@query
def q_validity(spark, folder):
    return rounded(pr.validity(seeded(spark, folder)))


@query
def q_row_uniqueness(spark, folder):
    docs = documents(spark, folder).select("text", "lang", "source")
    return rounded(pr.uniqueness(docs).select("row_uniqueness"))


@query
def q_row_uniqueness_nested(spark, folder):
    """Rows of nested columns: arrays with nulls, structs with nulls, a map inside an array whose
    entries are in either order."""
    docs = documents(spark, folder)
    lang = F.when(F.col("doc_id") % 3 != 0, F.col("lang"))
    pairs = [F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")]
    turned = F.when(F.col("doc_id") % 2 == 0, F.create_map(*pairs)).otherwise(
        F.create_map(*pairs[2:], *pairs[:2])
    )
    nested = docs.select(
        F.when(F.col("doc_id") % 2 == 0, F.array(lang, F.lit("x")))
        .otherwise(F.array(F.lit("x"), lang)).alias("listed"),
        F.struct(lang.alias("lang"), F.col("source")).alias("pair"),
        F.array(turned).alias("maps"),
    )
    return rounded(pr.uniqueness(nested).select("row_uniqueness"))


@query
def q_text_uniqueness(spark, folder):
    return rounded(pr.uniqueness(seeded(spark, folder)).select("text_uniqueness"))


@query
def q_uniqueness(spark, folder):
    return rounded(pr.uniqueness(documents(spark, folder)).select("uniqueness"))


@query
def q_text_uniqueness_sketch(spark, folder):
    """Sketches of the documents of each source, kept as a table and united: whether the distinct texts
    of all and of each source come out within the error that is stated."""
    docs = documents(spark, folder).select("source", "lang", "text")
    kept = scratch_path(spark, "sketches")
    sketches.text_sketches(docs, ("source", "lang")).write.parquet(kept)
    parts = spark.read.parquet(kept).where("column = 'text'")
    whole = sketches.united(parts).withColumn("source", F.lit("all"))
    by_source = sketches.united(parts, ("source",))
    exact = docs.groupBy("source").agg(F.countDistinct("text").alias("exact")).union(
        docs.select(F.lit("all"), F.countDistinct("text"))
    )
    found = sketches.estimated_uniqueness(whole.unionByName(by_source)).join(exact, "source")
    gap = F.abs(F.col("distinct_values") - F.col("exact"))
    return found.select("source", "n_rows", (gap <= F.lit(sketches.ERROR) * F.col("exact")).alias("within_error"))


@query
def q_unreadable_times(spark, folder):
    dates = seeded(spark, folder).select("source", "end_date")
    return pr.unreadable_times(dates, "end_date", ("source",))


@query
def q_timeliness(spark, folder):
    return rounded(pr.timeliness(table(spark, folder, "events"), "ts", AS_OF))


def _integrity(spark, folder, filtered: bool) -> DataFrame:
    docs = documents(spark, folder)
    labelled = integrity(docs, {"doc_id": (table(spark, folder, "labels"), "doc_id")}, filtered)
    users = integrity(
        table(spark, folder, "events"),
        {"user_id": (table(spark, folder, "customer"), "c_custkey")},
        filtered,
    )
    return rounded(
        labelled.select(F.lit("documents").alias("child"), "column", "found_share").unionByName(
            users.select(F.lit("events").alias("child"), "column", "found_share")
        )
    )


@query
def q_integrity(spark, folder):
    """How many documents are labelled, and events whose user is a customer."""
    return _integrity(spark, folder, False)


@query
def q_integrity_filtered(spark, folder):
    """The same with a Bloom filter of each parent before the join."""
    return _integrity(spark, folder, True)


@query
def q_orphans_filtered(spark, folder):
    """Orders of customers and documents of labels, looked for where most are missing."""
    docs = orphans(documents(spark, folder), "doc_id", table(spark, folder, "labels"), "doc_id", True)
    lines = table(spark, folder, "lineitem")
    # Every order key stands on several lines; few are document ids as well.
    keys = orphans(lines, "l_orderkey", table(spark, folder, "documents"), "doc_id", True)
    return docs.select(F.lit("documents").alias("child"), "value", "n").union(
        keys.select(F.lit("lineitem").alias("child"), "value", "n")
    )


@query
def q_orphans(spark, folder):
    return orphans(documents(spark, folder), "doc_id", table(spark, folder, "labels"), "doc_id")


@query
def q_outliers(spark, folder):
    return rounded(pr.outliers(table(spark, folder, "events")))


@query
def q_text_quality(spark, folder):
    return rounded(
        seeded_texts(spark, folder).select(
            "doc_id", scoring.text_quality(F.col("text")).alias("score")
        )
    )


@query
def q_accuracy(spark, folder):
    return rounded(pr.accuracy(seeded(spark, folder)))


@query
def q_overall(spark, folder):
    return rounded(
        pr.profile(
            table(spark, folder, "events"), timestamp_column="ts", as_of=AS_OF,
            references={"user_id": (table(spark, folder, "customer"), "c_custkey")},
        )
    )


@query
def q_validate(spark, folder):
    judged = pr.validate(seeded(spark, folder))
    return rounded(judged.withColumn("issues", F.array_join("issues", JOINER)))


@query
def q_validate_by_source(spark, folder):
    docs = documents(spark, folder)
    judged = pr.validate(docs, by=("source",))
    return rounded(judged.withColumn("issues", F.array_join("issues", JOINER)))


# Rules.


@query
def rule_special_chars(spark, folder):
    issues = rules.SpecialCharacterRule().issues(seeded_texts(spark, folder), "doc_id")
    return issues.select("column", "row_key", "message")


@query
def rule_special_chars_stats(spark, folder):
    return rounded(rules.SpecialCharacterRule().stats(seeded(spark, folder)))


def _language_model(spark, folder) -> LanguageModel:
    return LanguageModel.train(documents(spark, folder), "text", "lang")


@query
def rule_language(spark, folder):
    rule = rules.LanguageConsistencyRule(_language_model(spark, folder))
    docs = documents(spark, folder).select("doc_id", "text")
    return rule.issues(docs, "doc_id").select("column", "row_key", "message")


@query
def rule_language_stats(spark, folder):
    rule = rules.LanguageConsistencyRule(_language_model(spark, folder))
    stats = rule.stats(documents(spark, folder).select("doc_id", "text"))
    return rounded(
        stats.withColumn("detected_languages", F.array_join("detected_languages", ","))
    )


@query
def rule_format(spark, folder):
    return rules.DataFormatRule().issues(seeded(spark, folder)).select("column", "message")


@query
def rule_format_examples(spark, folder):
    return rules.DataFormatRule().examples(seeded(spark, folder), "doc_id")


@query
def rule_format_custom(spark, folder):
    """Page addresses against a format of our own: no query string."""
    rule = rules.DataFormatRule({"url": r"(?d)^https?://[^?]+$"})
    return rule.stats(table(spark, folder, "pages").select("page_id", "url"))


@query
def rule_cross_field(spark, folder):
    """Shipments before their order, by predicate and by function, and a missing field."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rule = rules.CrossFieldConsistencyRule()
    rule.add_relationship(
        ["o_orderdate", "l_shipdate"],
        F.col("o_orderdate") > F.col("l_shipdate"),
        "ordered after shipping",
    )
    rule.add_relationship(
        ["l_quantity"], lambda df: df.where("l_quantity > 49"), "quantity above 49"
    )
    rule.add_relationship(["o_orderdate", "o_paydate"], F.lit(True), "never checked")

    def fails(df):
        raise ValueError("no rates today")

    rule.add_relationship(["l_quantity"], fails, "fails")
    return rule.issues(joined).select("column", "message")


@query
def rule_date_order(spark, folder):
    return rules.date_order(seeded(spark, folder))


# Annotation.


@query
def ann_tokens(spark, folder):
    docs = seeded_texts(spark, folder)
    return docs.select("doc_id", tokens(F.col("text")).alias("t")).select(
        "doc_id",
        F.size("t").cast("bigint").alias("n_tokens"),
        F.array_join("t", JOINER).alias("tokens"),
    )


@query
def ann_token_offsets(spark, folder):
    """Every token with its place in the text."""
    found = token_table(seeded_texts(spark, folder), "text")
    return rounded(
        found.select("doc_id", "position", "token", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))
    )


@query
def ann_sentences(spark, folder):
    return seeded_texts(spark, folder).select(
        "doc_id", F.posexplode(sentences(F.col("text"))).alias("position", "sentence")
    ).select("doc_id", F.col("position").cast("bigint").alias("position"), "sentence")


@query
def ann_pos_tags(spark, folder):
    tagged = pos_tags(seeded_texts(spark, folder), "text")
    # Not the bare column: Spark would infer a filter on it and compute it twice.
    listed = F.coalesce("pos_tags", F.array().cast("array<struct<token:string,pos:string>>"))
    return tagged.select("doc_id", F.inline(listed)).groupBy("doc_id", "pos").agg(
        F.count(F.lit(1)).alias("n")
    )


def _linguistic_counts(annotation: str) -> list[Column]:
    return [
        F.array_join(
            F.transform(f"{annotation}.entities", lambda e: F.concat_ws("/", e["text"], e["label"])),
            JOINER,
        ).alias("entities"),
        F.size(f"{annotation}.tokens").cast("bigint").alias("n_tokens"),
        F.size(f"{annotation}.sentences").cast("bigint").alias("n_sentences"),
        F.size(
            F.filter(f"{annotation}.pos_tags", lambda t: t["pos"] != "X")
        ).cast("bigint").alias("n_tagged"),
        F.col(f"{annotation}.sentiment").alias("sentiment"),
    ]


@query
def ann_a_text(spark, folder):
    docs, matcher = entity_matcher(seeded_texts(spark, folder), "text", gazetteer(spark, folder))
    lookup = LiteralLookup(DEFAULT_TAGS)
    return docs.select(
        "doc_id", linguistic_annotation(F.col("text"), matcher, lookup).alias("a")
    ).select("doc_id", *_linguistic_counts("a"))


@query
def ann_a_sentences(spark, folder):
    docs, matcher = entity_matcher(seeded_texts(spark, folder), "text", gazetteer(spark, folder))
    lookup = LiteralLookup(DEFAULT_TAGS)
    return docs.select(
        "doc_id",
        F.posexplode(sentence_annotations(F.col("text"), matcher, lookup)).alias("position", "a"),
    ).select("doc_id", F.col("position").cast("bigint").alias("position"), *_linguistic_counts("a"))


@query
def ann_entities(spark, folder):
    found = entities(seeded_texts(spark, folder), "text", gazetteer(spark, folder))
    return rounded(
        found.select(
            "doc_id", "text", "label", F.col("start").alias("start_pos"), F.col("end").alias("end_pos")
        )
    )


@query
def ann_entities_large(spark, folder):
    """The same with a gazetteer that is joined."""
    found = entities(seeded_texts(spark, folder), "text", large_gazetteer(spark, folder), "doc_id")
    return found.select(
        "doc_id", "text", "label", F.col("start").cast("bigint").alias("start_pos"),
        F.col("end").cast("bigint").alias("end_pos"),
    )


@query
def ann_sentiment_large(spark, folder):
    """A lexicon that is joined: long words, weighed by their length."""
    words = large_gazetteer(spark, folder).where("label = 'WORD'").select(F.lower("phrase").alias("word")).distinct()
    lexicon = words.withColumn("weight", (F.length("word") % 11 - 5).cast("double"))
    found = sentiment(seeded_texts(spark, folder), "text", lexicon, row_key="doc_id")
    return rounded(found.select("doc_id", "sentiment.*"))


@query
def ann_sentiment(spark, folder):
    return rounded(
        sentiment(seeded_texts(spark, folder), "text").select("doc_id", "sentiment.*")
    )


@query
def ann_sentiment_ml(spark, folder):
    """Trained on four fifths of the labelled documents (toxic is negative), shown for every
    document: what holds of each score, and whether the model agrees with the labels it
    has not seen in 80 % of them."""
    labels = table(spark, folder, "labels").select("doc_id", (1 - F.col("toxic")).cast("double").alias("positive"))
    docs = seeded_texts(spark, folder)
    labelled = docs.join(labels, "doc_id")
    model = train_sentiment(labelled.where(F.col("doc_id") % 5 != 0), "text", "positive")
    scored = model_sentiment(docs, model).select("doc_id", "text", "sentiment.*")
    unseen = scored.join(labels, "doc_id").where((F.col("doc_id") % 5 == 0) & F.col("score").isNotNull())
    agrees = unseen.agg(F.avg(((F.col("score") > 0) == (F.col("positive") == 1)).cast("double")) >= 0.8)
    score = F.col("score")
    return scored.select(
        "doc_id",
        score.isNull().alias("is_null"),
        F.coalesce(score.between(0.5, 1.0) | ((score >= -1.0) & (score < -0.5)), score.isNull()).alias("in_range"),
        F.coalesce(
            F.col("label") == F.when(score > 0, "positive").otherwise("negative"), score.isNull()
        ).alias("label_fits"),
        agrees.scalar().alias("model_agrees"),
    )


@query
def ann_topics(spark, folder):
    found = topics(seeded_texts(spark, folder), "text", gazetteer(spark, folder))
    # Not the bare column: Spark would infer a filter on it and compute it twice.
    listed = F.coalesce(F.col("topics"), F.array().cast("array<string>"))
    return found.select("doc_id", F.posexplode(listed).alias("position", "topic")).select(
        "doc_id", F.col("position").cast("bigint").alias("position"), "topic"
    )


@query
def ann_topics_ranked(spark, folder):
    """Candidate phrases by their score in the whole corpus, beside text order."""
    found = ranked_topics(seeded_texts(spark, folder), "text", "doc_id")
    return found.select("doc_id", F.col("position").cast("bigint"), "topic", F.col("rank").cast("bigint"), "score")


@query
def ann_keywords(spark, folder):
    docs = seeded_texts(spark, folder)
    return rounded(keywords(docs, "text", "doc_id"))


@query
def ann_keywords_tagged(spark, folder):
    """Only nouns, names and adjectives of a tag list."""
    docs = seeded_texts(spark, folder)
    return rounded(keywords(docs, "text", "doc_id", tags=DEFAULT_TAGS))


@query
def lang_id(spark, folder):
    model = _language_model(spark, folder)
    found = model.detect(documents(spark, folder).select("doc_id", "text"), "text")
    return rounded(found.select("doc_id", "language.*"))


@query
def ann_language(spark, folder):
    """The model of the documents applied to the turns of the conversations."""
    model = _language_model(spark, folder)
    talks = readers.spread(table(spark, folder, "conversations"), spark.sparkContext.defaultParallelism).select("conv_id", "turn", "text")
    return rounded(model.detect(talks, "text").select("conv_id", "turn", "language.*"))


@query
def ann_instruction(spark, folder):
    return seeded_texts(spark, folder).select(
        "doc_id", instruction(F.col("text")).alias("i")
    ).select("doc_id", "i.is_instruction", "i.has_question_mark")


@query
def ann_command_words(spark, folder):
    return seeded_texts(spark, folder).select(
        "doc_id", F.array_join(command_words(F.col("text")), " ").alias("command_words")
    )


def _annotation_summary(df: DataFrame, with_keywords: bool) -> DataFrame:
    a = "text_annotations"
    columns = [
        "doc_id",
        F.size(f"{a}.entities").cast("bigint").alias("n_entities"),
        r6(F.col(f"{a}.sentiment.score")).alias("sentiment_score"),
        F.col(f"{a}.sentiment.label").alias("sentiment_label"),
        F.size(f"{a}.topics").cast("bigint").alias("n_topics"),
        F.col(f"{a}.language.language").alias("language"),
        F.col(f"{a}.instruction.is_instruction").alias("is_instruction"),
        F.array_join(F.col(f"{a}.instruction.command_words"), " ").alias("command_words"),
    ]
    if with_keywords:
        columns.append(
            F.array_join(F.transform(f"{a}.keywords", lambda k: k["text"]), JOINER).alias("keywords")
        )
    return df.select(*columns)


@query
def annotate_text(spark, folder):
    """Everything that needs no corpus: one narrow projection."""
    docs = seeded_texts(spark, folder)
    config = AnnotationConfig(enable_keywords=False)
    return _annotation_summary(
        annotate(docs, "text", config, gazetteer=gazetteer(spark, folder)), False
    )


@query
def annotate_batch(spark, folder):
    docs = seeded_texts(spark, folder)
    annotated = annotate(
        docs, "text", AnnotationConfig(), row_key="doc_id", gazetteer=gazetteer(spark, folder),
        language_model=_language_model(spark, folder),
    )
    return _annotation_summary(annotated, True)


@query
def ann_own_annotator(spark, folder):
    """An annotator of the user's, a pandas UDF, beside a built-in one."""

    @F.pandas_udf("struct<lines bigint, upper bigint>")
    def shape(texts: pd.Series) -> pd.DataFrame:
        filled = texts.fillna("")
        return pd.DataFrame(
            {"lines": filled.str.count("\n") + 1, "upper": filled.map(lambda t: sum("A" <= c <= "Z" for c in t))}
        )

    only = AnnotationConfig(
        enable_entities=False, enable_sentiment=False, enable_topics=False, enable_keywords=False,
        enable_language=False, extra={"shape": shape},
    )
    return annotate(seeded_texts(spark, folder), "text", only).select(
        "doc_id",
        F.col("text_annotations.shape.lines").alias("n_lines"),
        F.col("text_annotations.shape.upper").alias("n_upper"),
        F.col("text_annotations.instruction.is_instruction").alias("is_instruction"),
    )


class ShoutingRule(rules.Rule):
    """A rule of the user's: texts with too large a share of capital letters."""

    name = "Shouting"

    def __init__(self, most: float):
        self.most = most

    def _share(self) -> Column:
        capitals = F.length(F.regexp_replace("text", "[^A-Z]", ""))
        return F.try_divide(capitals, F.length("text"))

    def issues(self, df, row_key=None):
        return df.where(self._share() > self.most).select(
            *self._issue(F.lit("text"), F.col(row_key), F.lit("Too many capitals"))
        )

    def stats(self, df):
        return df.agg(F.count_if(self._share() > self.most).alias("violations"))


@query
def rule_own(spark, folder):
    """Issues and statistics of a rule of the user's."""
    found = ShoutingRule(0.05).validate(seeded_texts(spark, folder), "doc_id")
    return found.issues.select("rule", "column", "row_key", "message").union(
        found.stats.select(
            F.lit("Shouting"), F.lit("text"), F.lit(None).cast("string"),
            F.concat(F.lit("violations: "), F.col("violations").cast("string")),
        )
    )


@query
def corpus_overview(spark, folder):
    """Flagship: clean and gate every document, then what came of it per source."""
    docs = documents(spark, folder).select("doc_id", "source", "text")
    aligned = processing.clean_aligned(docs, "text")
    accepted = F.col("text_cleaned") != ""
    length = F.length("text_cleaned")
    return rounded(
        aligned.groupBy("source").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(accepted).alias("n_accepted"),
            F.avg(accepted.cast("double")).alias("accepted_share"),
            F.sum(length).alias("chars"),
            F.coalesce(
                F.greatest(
                    F.lit(0.0), 1.0 - F.try_divide(F.stddev_samp(length), F.avg(length))
                ),
                F.lit(0.0),
            ).alias("length_consistency"),
        )
    )
