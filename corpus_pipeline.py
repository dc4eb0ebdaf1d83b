"""The corpus pipeline: filter by quality and language, drop near copies, mix the sources, encode.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All but the last return the
columns of ``documents``. Defined cases are those of the operators; in particular null and empty texts are
scored by the quality stage and rejected by the language stage (no letter), and rows with one id and
different texts stay different documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import bpe, jaccard, langid, mixing, quality
from tallyforge.llm.queries import WEIGHTS, table, tokenizers
from tallyforge.session import scratch_path

#: Columns that every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near copies: runs of five words, similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, gives label 1."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model).where("predicted = 1").select(*COLUMNS)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text fits one of the languages that the corpus names."""
    models = langid.train(docs)
    return langid.predict(docs.select(*COLUMNS), models).where("not rejected").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id; documents without words all stay."""
    return jaccard.one_of_each(docs.select(*COLUMNS), SHINGLE, PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated as often as the mix takes them."""
    return mixing.repeated(mixing.mix(docs.select(*COLUMNS), WEIGHTS), COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests that confirm the round trip."""
    names = tokenizers()
    path = names.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path, names.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_language),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


#: Trained classifiers, a similarity join's components and a tokenizer are not SQL.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
