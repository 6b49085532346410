"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, near_dup, pieces, pii, toxicity
from millrace.llm.common import free_name, row_key
from millrace.session import collect_garbage, cut, give_back, sweep, table, written

#: Keys that are broadcast at most (16 bytes each); more are shuffled, with the documents.
BROADCAST_KEYS = 500_000


def rested(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """stage, before which the executors collect their garbage, and once more before its result is written."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        collect_garbage(spark)
        out = stage(spark, docs, sf_dir)
        collect_garbage(spark)
        return out

    return run


def keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with two more columns that tell its rows apart by id and text, and their names."""
    names = [free_name(docs, "_row_1"), free_name(docs, "_row_2")]
    return docs.withColumns(dict(zip(names, row_key(docs), strict=True))), names


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs less the rows with one of the keys (a, b); few keys leave the texts where they are."""
    rows, names = keyed(docs)
    gone = cut(keys.select("a", "b").distinct(), "keys").toDF(*names)
    few = gone.count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(gone) if few else gone, names, "left_anti").select(*docs.columns)


def with_key(docs: DataFrame) -> DataFrame:
    """The key as doc_id, and the text: what an operator sees that decides on rows."""
    return docs.select(F.struct(*[k.alias(n) for k, n in zip(row_key(docs), "ab", strict=True)]).alias("doc_id"), "text")


@rested
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows among them, scores under its cut."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    give_back(spark)  # this stage cuts nothing
    mark = free_name(docs, "_toxic")
    hidden = {c: free_name(docs, f"_own_{c}") for c in docs.columns if c.lower() in toxicity.OUTPUT}
    scored = toxicity.score(docs.withColumnsRenamed(hidden), model).withColumnRenamed("predicted", mark)
    return scored.where(F.col(mark) == 0).drop(mark, *toxicity.OUTPUT).withColumnsRenamed({v: k for k, v in hidden.items()}).select(*docs.columns)


@rested
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest doc_id; rows without words all stay.

    Of rows that repeat an id and its text one stays. A group in which no row has an id keeps one row too.
    """
    key = [k.alias(n) for k, n in zip(row_key(docs), "ab", strict=True)]
    ids = docs.select(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", *key).alias("doc_id"), "text")
    found = cut(near_dup.near_duplicates(ids).where("n_shingles > 0").select("doc_id", "group"), "groups")
    collect_garbage(spark)
    # the order of ids is that of (null or not, doc_id, key), so the first of a group is one key
    first = found.groupBy("group").agg(F.min("doc_id").alias("first"))
    lost = found.join(first, "group").where("doc_id <> first").select("doc_id.a", "doc_id.b")
    rest = without(docs, lost)
    again = cut(found.groupBy("doc_id").count().where("count > 1").select("doc_id.a", "doc_id.b"), "again")
    if again.isEmpty():
        return rest
    once, names = keyed(rest)
    once = once.join(again.toDF(*names), names, "left_semi").dropDuplicates(names).select(*docs.columns)
    return without(rest, again).unionByName(once)


@rested
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    found = decontaminate.find_contamination(with_key(docs), table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated").select("doc_id.a", "doc_id.b"))


@rested
def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs).select(*docs.columns)


@rested
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their piece ids; round_trip says that decoding gives the text back."""
    out = pieces.encode_documents(docs, pieces.load(), keep_text=False)
    return out.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "round_trip", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("sentencepiece", encode),
]
#: SQL can't express training, expectation-maximisation or the segmentation; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; the result of each is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        since = written()
        docs = cut(stage(spark, docs, sf_dir), name)
        sweep(spark, since, docs)  # what the stage wrote on its way
    return STAGES[-1][1](spark, docs, sf_dir)
