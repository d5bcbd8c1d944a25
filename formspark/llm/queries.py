"""Registered queries of the operators here, over whole tables, with their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from formspark.llm import decontam, embed_dedup, html_blocks, language, lines, merkle, mixing, negatives, pii, quality, secrets, simhash, sql, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query()
def op1_mixing(spark, folder):
    mixed = mixing.mixed(_table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "mix_block", "mix_slot", "mix_position")


@_query(sql.DECONTAM)
def op2_decontam(spark, folder):
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return decontam.hits(docs, _table(spark, folder, "benchmark")).drop("text")


@_query()
def op3_quality(spark, folder):
    docs = _table(spark, folder, "documents")
    return quality.scored(docs, quality.train(docs, _table(spark, folder, "labels")))


@_query()
def op4_simhash(spark, folder):
    return simhash.near_duplicates(_table(spark, folder, "documents"))


@_query()
def op5_html_blocks(spark, folder):
    return html_blocks.extracted(_table(spark, folder, "pages"))


@_query(urls.ORACLE)
def op6_url_filter(spark, folder):
    return urls.judged(_table(spark, folder, "pages"))


@_query()
def op7_pii(spark, folder):
    return pii.personal_report(_table(spark, folder, "documents"))


@_query(sql.EMBEDDINGS)
def op8_embedding_dedup(spark, folder):
    return embed_dedup.near_vectors(_table(spark, folder, "embeddings"))


@_query()
def op9_secrets(spark, folder):
    return secrets.secret_report(_table(spark, folder, "documents"))


@_query(sql.LINES)
def op10_line_dedup(spark, folder):
    return lines.line_report(_table(spark, folder, "documents"))


@_query(sql.NEGATIVES)
def op11_hard_negatives(spark, folder):
    return negatives.hard_negatives(_table(spark, folder, "embeddings"))


@_query(sql.MERKLE)
def op12_merkle(spark, folder):
    return merkle.tamper_report(_table(spark, folder, "documents"))


@_query()
def op13_language(spark, folder):
    docs = _table(spark, folder, "documents")
    return language.languages(docs, language.train(docs))


@_query()
def pipeline(spark, folder):
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
