"""A corpus pipeline over ``documents``.

STAGES are applied in order; each calls one operator of ``tessera.llm``, works on
all that its predecessor kept, and is written as Parquet and read again. All but
the last return the columns of ``documents``:

1. language ID: documents whose language cannot be told (no text, no letter, or a
   score under MIN_SCORE) go;
2. MinHash near-dedup: the document with the smallest id of each group stays;
3. benchmark decontamination: documents with a benchmark window go;
4. secret scans: secrets are replaced by a mark in the text (``n_chars`` follows);
5. mixing: every document gets ``size, source_size, target, taken``; those of
   which the mix takes nothing go.

Stages 1, 3 and 4 judge every row by its own text, whatever its doc_id. Stage 2 names
documents by doc_id: rows that share one are versions of one document and stay or go
together; rows without one all stay. Columns of any name are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.decontaminate import contamination
from tessera.llm.langid import UNKNOWN, held_out, identify, learn
from tessera.llm.mixing import mix_sources
from tessera.llm.near_dedup import near_duplicates
from tessera.llm.secrets import redact, scan
from tessera.llm.staging import stage

#: A language with less probability than this is as good as unknown.
MIN_SCORE = 0.3


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and the other columns in one, so that no name can clash with an
    operator's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*rest).alias("document"))


def _unpacked(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    changed = {"text": F.col("text"), **changed}
    return rows.select(*(changed.get(c, F.col(f"document.`{c}`")).alias(c) for c in columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network can tell. It learns from the labelled
    documents outside the held-out third."""
    net = learn(docs.where(~held_out(F.col("doc_id"))), "doc_id", "text", "lang")
    told = identify(_packed(docs), net, "text", ("document", "text"))
    return _unpacked(told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(stage(gone, "duplicates"), "doc_id", "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark windows."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = stage(contamination(docs, benchmark).where("contaminated").select("doc_id", "text_md5").distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(hit["doc_id"]) & (F.md5(docs["text"]) == hit["text_md5"])
    return docs.join(hit, same, "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    found = scan(_packed(docs))
    found = found.withColumn("text", redact(F.col("text"), F.col("secret_spans")))
    n_chars = F.when(F.size("secret_spans") > 0, F.length("text").cast("long")).otherwise(F.col("document.n_chars"))
    return _unpacked(found, docs.columns, n_chars=n_chars)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    plan = mix_sources(docs, keep=["lang", "source"])
    return plan.where("taken > 0").select("doc_id", "lang", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("mixing", mixing),
]

#: Stage 1 is a network's verdict, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
