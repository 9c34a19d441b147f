"""The corpus pipeline: stages over the documents table, each written and read again by the next one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstream.llm import decontaminate, lang_id, line_dedup, packing, simhash
from cabstream.llm.common import null_safe, read_table, release, stored
from cabstream.llm.queries import CAPACITY, tokenizer

#: Documents whose best language pools less than this many times an even share of the probability are rejected,
#: as are those without a letter.
LEAST_SHARE = 1.2


USED = ["doc_id", "text"]


def _packed(docs: DataFrame) -> DataFrame:
    """USED columns and all others as one, so that no name of theirs clashes with an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in USED]
    return docs.select(*USED, F.struct(F.lit(0).alias("__none"), *others).alias("__doc"))


def _unpacked(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of documents again, some of them changed."""
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(c if c in USED else f"__doc.`{c}`") for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those that language identification rejects go.

    Rejected are texts without a letter, null and empty ones included, and
    texts whose predicted language scores less than LEAST_SHARE times what an
    even guess over the languages learned would; with one language none is.
    Without any label to learn from nothing can be told, and all texts with a letter stay. Columns of any name and type
    stay as they are; repeated rows and ties are judged alike; an empty table gives no rows.
    """
    model = lang_id.train(lang_id.training_words(docs))
    found = lang_id.identify(_packed(docs), model, keep=[*USED, "__doc"])
    if not model.languages:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    least = LEAST_SHARE / len(model.languages) if len(model.languages) > 1 else 0.0
    kept = found.where((F.col("lang_pred") != lang_id.UNDECIDED) & (F.col("score") >= least))
    return _unpacked(kept, docs.columns)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines found in at least 10 of them; n_chars, where there is one, follows the text."""
    kept = line_dedup.drop_repeated_lines(_packed(docs), min_docs=10, min_chars=1)
    less = F.col("n_dropped") > 0
    changed = {"text": F.when(less, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(less, F.length("kept_text").cast(kind)).otherwise(F.col("__doc.n_chars"))
    return _unpacked(kept, docs.columns, **changed)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id, then text hashes.

    Rows equal in doc_id and text are one document, the least of them by all
    columns (maps by their JSON); other texts under its doc_id are documents of their own.
    Documents without an id can't be named by a group; all of them stay.
    """
    key = F.struct("doc_id", *(F.xxhash64(F.lit(seed), "text").alias(f"hash{seed}") for seed in (0, 1)))
    keyed = _packed(docs).withColumn("__row", F.when(F.col("doc_id").isNotNull(), key))
    groups = simhash.near_duplicates(keyed, id_col="__row", shingle=4, max_bits=4)
    first = groups.where("component_id is not null").select(F.col("component_id").alias("_on")).distinct()
    order = F.struct(F.lit(0), *[F.to_json(F.struct(f"__doc.`{f.name}`")) if "map<" in f.dataType.simpleString()
                                 else F.col(f"__doc.`{f.name}`") for f in docs.schema if f.name not in USED])
    named = null_safe(keyed.where("doc_id is not null"), first, "__row", "left_semi").groupBy("__row").agg(
        F.min_by(F.struct(*USED, "__doc"), order).alias("__least"))
    return _unpacked(named.select("__least.*"), docs.columns).unionAll(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Each row goes or stays by its own text, also where rows share a doc_id or have none.
    """
    text_hashes = (F.xxhash64(F.lit(seed), "text").cast("string") for seed in (0, 1))
    keyed = _packed(docs).withColumn("__row", F.concat_ws("/", F.col("doc_id").cast("string"), *text_hashes))
    found = decontaminate.benchmark_matches(keyed, read_table(spark, sf_dir, "benchmark"), id_col="__row")
    clean = null_safe(keyed, found.select(F.col("__row").alias("_on")).distinct(), "__row", "left_anti")
    return _unpacked(clean, docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of CAPACITY: one row per piece with its place.

    Null and empty texts are the end id alone; rows stand for themselves, repeated ones and null
    ids too; equal pieces are interchangeable; other columns are not read; an empty table gives no rows.
    """
    return packing.packed_documents(docs, tokenizer("word_bpe_49k.json"), capacity=CAPACITY, end_id=1)


STAGES = [
    ("language id", language_id),
    ("line dedup", repeated_lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: No SQL: a trained network, fingerprints, a latent space and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark)
    return docs
