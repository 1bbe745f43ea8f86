"""From raw documents to packed sequences: five stages, each an operator of ``tidegate.llm``.

Every stage reads all rows that its predecessor kept; all but the last return the columns of
``documents``.  Extra columns of the input are carried along; a column named like one that an
operator adds is kept as it is, as operators only see the columns they need.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import common, decontaminate, language_id, packing, secret_scan, simhash
from tidegate.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A text must be likelier as its language than as random n-grams, on average per n-gram (natural logarithm).
MIN_FIT = 0.0
TOKENIZER = "word_bpe_49k.json"
SECRET = "[SECRET]"


def _boxed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The whole row as one column, under a name that no other has, beside the columns an operator reads."""
    box = "__row"
    while box in docs.columns:
        box += "_"
    own = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(F.struct(*own).alias(box), *own), box


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in one of the languages that the labelled rows show; null texts, texts without a letter and texts that fit
    no language go.  Nothing goes for want of labels: without any the stage only asks for a text with a letter."""
    model = language_id.train(docs)
    rows, box = _boxed(docs)
    found = language_id.predict(rows, model, keep=[box])
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return found.where((F.col("lang_pred") != "und") & (F.col("fit") > MIN_FIT)).select(f"{box}.*")


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts one row of the smallest id; rows of null id stay."""
    return simhash.keep_first(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of the benchmark."""
    rows, box = _boxed(docs)
    found = decontaminate.scan(rows, common.read_table(spark, sf_dir, "benchmark"), keep=[box])
    return found.where(~F.col("contaminated")).select(f"{box}.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with every secret in the text replaced by a mark; n_chars follows the text where it was changed."""
    rows, box = _boxed(docs)
    found = secret_scan.scan(rows, keep=[box], mark=SECRET, words=secret_scan.learned_words(docs))
    changed = F.col("spans") != ""
    out = []
    for field in docs.schema.fields:
        own = F.col(box).getField(field.name)
        if field.name == "text":
            own = F.when(changed, F.col("redacted")).otherwise(own)
        elif field.name == "n_chars":
            own = F.when(changed, F.length("redacted").cast(field.dataType)).otherwise(own)
        out.append(own.alias(field.name))
    return found.select(*out)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows in sequences of 2048 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), keep=["doc_id"])


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identify_language),
    ("SimHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_contaminated),
    ("secret scans", redact_secrets),
    ("packing", pack_sequences),
]

#: Learned languages, fingerprints and token ids have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and read again."""
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        at = scratch_path(spark, f"stage-{name.replace(' ', '-').lower()}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
