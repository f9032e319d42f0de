"""The queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terminus.llm.bpe import round_trip
from terminus.llm.common import table
from terminus.llm.html import extract
from terminus.llm.language import identify
from terminus.llm.licenses import oracle, scan
from terminus.llm.packing import pack
from terminus.llm.quality import verdicts
from terminus.llm.repeats import deduplicate
from terminus.llm.simhash import near_duplicates
from terminus.llm.topk import search
from terminus.llm import pii, variants
from terminus.llm.warc import archive


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(table(spark, sf_dir, "documents"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents"))


QUERIES = {"op1_html": op1_html, "op2_packing": op2_packing, "op3_bpe": op3_bpe, "op4_quality": op4_quality, "op5_licenses": op5_licenses, "op6_topk": op6_topk, "op7_simhash": op7_simhash, "op8_warc": op8_warc, "op9_language": op9_language, "op10_repeats": op10_repeats, "op11_pii": op11_pii, "op12_variants": op12_variants}
ORACLE_SQL: dict[str, str] = {"op5_licenses": oracle(), "op12_variants": variants.oracle()}
