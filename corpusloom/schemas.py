"""Explicit schemas of the datasets; nothing is inferred."""

from pyspark.sql import types as T

DOCUMENT = "doc_id STRING, text STRING, source STRING, timestamp STRING, meta STRUCT<lang: STRING, license: STRING, tags: ARRAY<STRING>>"
PIECES = "piece STRING, freq BIGINT"
WORDS = "word_idx BIGINT, symbols ARRAY<INT>, freq BIGINT"
PAIRS = "a INT, b INT, cnt BIGINT"
MERGES = "rank INT, a INT, b INT, new_id INT"
VOCABULARY = "token_id INT, token STRING, token_bytes BINARY, is_special BOOLEAN"
TOKEN_INDEX = "shard INT, doc_id STRING, start BIGINT, length INT, eos_appended BOOLEAN"
PACKED = "split STRING, block_id BIGINT, tokens ARRAY<INT>"
REGISTRY = "seq BIGINT, created_at STRING, artifact_type STRING, artifact_id STRING, artifact_path STRING, manifest_path STRING, source_run_id STRING, config_hash STRING, inputs ARRAY<STRUCT<artifact_type: STRING, artifact_id: STRING, hash: STRING>>"
WAL = "kind STRING, merge_idx INT, f1 INT, f2 INT, f3 BIGINT"
INSTRUCTION = "instruction STRING, output STRING"
METRIC = "step BIGINT, loss DOUBLE"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
