"""A corpus from raw documents to token ids, in stages; each stage reads what the one before wrote.

1. language ID: documents whose language cannot be told go, with no letters or with few known n-grams.
2. line dedup: lines that stand on many sites are removed from documents.
3. near duplicates: of each class, the document with the least id stays.
4. mixing: documents are repeated or dropped at random until sources have their target weights, and shuffled.
5. pieces: the texts become ids of pieces, which decode to the text.

Every stage but the last returns the columns of documents, extra columns included. Null texts have no
letters and go in the first stage; null ids, languages and sources go through all stages as the
operators' docstrings say. An empty table gives an empty result.
"""

from pyspark.sql import DataFrame, SparkSession

from tracklake.llm import language, line_dedup, mixing, near_duplicates, pieces
from tracklake.llm.queries import tokenizer_path
from tracklake.llm.tables import fold, read
from tracklake.session import stage

# Share of n-grams that the predicted language must know.
LEAST_SCORE = 0.3


def unused(docs: DataFrame, name: str) -> str:
    """A name beginning with `name` that no column of docs has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the others have taught."""
    model = language.learn(docs.where(fold("doc_id") != 0))
    name, score = (unused(docs, x) for x in ("lang_pred", "lang_score"))
    predicted = language.predict(docs, model, name=name, score=score)
    known = predicted[name] != language.UNDETERMINED
    return predicted.where(known & (predicted[score] >= LEAST_SCORE)).select(*docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand on many sites."""
    return line_dedup.remove(docs, counts=False)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for, in random order."""
    return mixing.mix(docs, counts=False)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, digest, n_bytes, same and ids of each document."""
    return pieces.encode(docs, tokenizer_path("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("language ID", identified),
    ("line dedup", without_boilerplate),
    ("near duplicates", distinct),
    ("mixing", mixed),
    ("pieces", tokenized),
]
# Learned models, sampling and best paths have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
