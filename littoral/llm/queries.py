"""The registered queries of this subpackage and the SQL that some can be checked with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, counts, decontaminate, licenses, quality, repeats, simhash, suffixes, tokenfiles
from .common import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex64("fp").alias("fingerprint"), "component_id")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(read_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("row", "k")


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(read_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link(read_table(spark, sf_dir, "conversations")).drop("row")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents")).drop("spans")


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove(read_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_repeated")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_token_files": op2_token_files,
        "op3_quality": op3_quality,
        "op4_token_counts": op4_token_counts,
        "op5_decontaminate": op5_decontaminate,
        "op6_repeats": op6_repeats,
        "op7_chat": op7_chat,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_licenses": op9_licenses,
        "op10_suffixes": op10_suffixes,
    }


#: Windows of 13 words, the smallest document of each, and what it leaves of the others.
_REPEATS_SQL = r"""with docs as materialized (select row_number() over () r, doc_id, coalesce(doc_id, 9223372036854775807) d, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
 windows as materialized (select r, d, i, array_to_string(w[i:i+12], ' ') g from (select r, d, w, unnest(range(1, len(w) - 11)) i from docs where len(w) >= 13)),
 least as (select g, min(d) m from windows group by g having count(*) > 1),
 gone as materialized (select distinct r, i + k j from (select r, i, unnest(range(0, 13)) k from windows join least using (g) where m < d)),
 words as (select r, j, w[j] x from (select r, w, unnest(range(1, len(w) + 1)) j from docs)),
 kept as (select r, string_agg(x, ' ' order by j) t, count(*) n from words anti join gone using (r, j) group by r)
 select doc_id, cast(len(w) as bigint) n_words, cast(len(w) - coalesce(n, 0) as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256 from docs left join kept using (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op6_repeats": _REPEATS_SQL}
