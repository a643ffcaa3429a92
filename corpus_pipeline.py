"""Five stages over documents; each calls one operator, and its result is stored and read again as the next one's input.

The stages before packing return the columns of documents. Suffix-array dedup replaces text (and n_chars, where there is
such a column); a document of which nothing is left stays, with an empty text.

Cases: a null text, or one without a letter, has no language and goes in the first stage; of rows alike in doc_id and text
one stays in the second; a null doc_id is kept like any other; extra columns pass through to packing, which leaves them;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarn.llm import decontaminate, language, packing, simhash, suffix_dedup
from tarn.llm.common import cut, table

#: The query's 400 bytes are its contract; here passages of over 50 words go, nearly all of which have as many bytes as this.
REPEATED = 240


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go."""
    return language.keep_known(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose sets of five-word shingles are alike to 0.8 or more one stays."""
    return simhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of REPEATED bytes that also start elsewhere go from the texts."""
    return suffix_dedup.rewritten(docs, REPEATED)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, "stage")
    return docs


#: Trained classifiers, fingerprints of shingles and byte spans are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
