"""A pipeline over ``documents``: language, near-duplicates, personal data, mixture, sequences.

Each stage reads all that the one before it kept, as Parquet.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import language_id, minhash_dedup, mixing, packing, pii
from llm.common import held_out, hot_keys, materialize, remove, spare, spread_join, table


def set_aside(docs: DataFrame, *known: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with all columns but ``known`` called c0, c1, ..., so that they meet no name of an operator; and their own names."""
    names = {c: c if c.lower() in known else f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()]), {x: c for c, x in names.items()}


def brought_back(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of ``set_aside`` in their order, called as before."""
    return rows.select(*[F.col(x).alias(c) for x, c in names.items()])


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without letters go.  The score of a short text is low in any language, so it isn't asked.

    Null, empty and blank texts have no letters.  Texts of any length are read whole; ties don't matter, repeated rows have
    equal results, extra columns pass through.  Where no row has both a text with letters and a language, nothing can be
    learned, so nothing is rejected.  An empty table gives an empty result."""
    model = language_id.fit(docs.where(~held_out(F.col("doc_id"))))
    if model is None:
        return docs
    rows, names = set_aside(docs, "doc_id", "text")
    judged = language_id.predict(rows, model).where(F.col("lang_pred") != "und")
    return brought_back(judged, names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id; shingles of five words.

    Rows are compared as such, whatever their ids: of rows equal in id and text one stays, rows that share an id stay if their
    texts differ, rows without an id take part and stay only if no row of their group has one.  Among equal ids the first
    row as written stays.  Null, empty and blank texts have no shingles and are kept, each of them.  Texts of any length are
    read whole, extra columns pass through, and an empty table gives an empty result."""
    row = spare("row_", docs.columns)
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = minhash_dedup.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"))
    groups = materialize(found.where("n_shingles > 0").select(F.col("doc_id").alias(row), "component_id"), "groups")
    several = materialize(groups.groupBy("component_id").agg(F.count("*").alias("c")).where("c > 1"), "several")
    hot = hot_keys(several, ["component_id"], "c", groups.count())  # a large group goes to several tasks
    inside = spread_join(groups, several.select("component_id"), ["component_id"], hot)
    member = materialize(inside.join(rows.select(row, "doc_id"), row), "members")
    best = member.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("m")).select(f"m.{row}")
    gone = materialize(member.select(row).join(best, row, "left_anti"), "gone")
    remove(groups, several, member)
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; ``n_chars`` follows the new text, and is null without one.

    The key is that of ``spark.llm.pii.key``.  Null and empty texts stay as they are, texts of any length are read whole,
    repeated rows have equal results, extra columns pass through, whatever their names, a table without ``n_chars`` stays
    without, and an empty table gives an empty result."""
    key = spark.conf.get("spark.llm.pii.key", pii.TEST_KEY)
    rows, names = set_aside(docs, "doc_id", "text")
    new = brought_back(pii.replace(rows, key), names)
    counted = [c for c in docs.columns if c.lower() == "n_chars"]
    return new.withColumns({c: F.length("text").cast(docs.schema[c].dataType) for c in counted}).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as the mix takes them, each partition of one output shard and shuffled there.

    A null source is one of its own.  Null and empty texts have size 0 and follow their block; repeated rows move together;
    extra columns pass through, and an empty table gives an empty result."""
    return mixing.mix(docs, shard=None)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences.

    Null and empty texts are documents of the end id alone, texts of any length are cut, each row counts, repeated or not,
    extra columns are ignored, and an empty table gives an empty result."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Kernels, hashes, surrogates and draws aren't SQL; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; what a stage wrote goes once the next one has read it."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        remove(*([last] if last is not None else []))
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
