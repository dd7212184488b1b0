"""The core's queries, for the driver's contract: name -> f(spark, folder) -> DataFrame, and their SQL.

Documents are put in the form of the corpus stage first: white space collapsed, ids as text.
Arrays of tokens and symbols are shown as text of fixed-width hex numbers, so that any engine
compares them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions.registered import register
from .operators import bpe, corpus, evaluation, lineage, pieces, shards
from .session import ship
from .sources.lines import json_text
from .storage import spread, written
from .streaming.counts import sessions, windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MIN_CHARS, SEQ_LEN, DOCS_PER_SHARD, MERGES, EOS = 20, 256, 100, 6, 256
SPECIALS = ["<|endoftext|>", "<|pad|>"]
PATTERN = T.resolve_pattern("gpt2_fast")
# On collapsed text this says the same without look-ahead.
RE2 = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """id, normalised text and further columns of documents."""
    df = _table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", *extra)
    return corpus.normalised(spread(df))


def _hex(c: Column, width: int) -> Column:
    return F.array_join(F.transform(c, lambda x: F.lower(F.lpad(F.hex(x), width, "0"))), "")


def _clean(column: str) -> str:
    return f"trim(regexp_replace(coalesce({column}, ''), '{T.WHITE_RE2}+', ' ', 'g'))"


DOCS = f"docs AS MATERIALIZED (SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, {_clean('text')} AS text FROM documents)"
LONG = f"kept AS MATERIALIZED (SELECT * FROM docs WHERE length(text) >= {MIN_CHARS})"
COUNTS = f"counts AS MATERIALIZED (SELECT piece, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(text, '{RE2.replace(chr(39), chr(39) * 2)}')) AS piece FROM docs) GROUP BY piece)"
WRAPPED = "w0 AS MATERIALIZED (SELECT piece, freq, regexp_replace(lower(hex(encode(piece))), '(..)', '<00\\1>', 'g') AS s FROM counts)"


def _merge_sql(k: int) -> str:
    """Common table expressions of k learnt merges: m1..mk (a, b, n) and the words w0..wk."""
    out = []
    for i in range(1, k + 1):
        new = f"<{255 + i:04x}>"
        pairs = f"SELECT regexp_extract_all(s, '<....>') AS x, freq FROM w{i - 1}"
        out.append(f"p{i} AS MATERIALIZED (SELECT x[j] AS a, x[j + 1] AS b, sum(freq) AS n FROM (SELECT x, freq, unnest(range(1, len(x))) AS j FROM ({pairs})) GROUP BY ALL)")
        out.append(f"m{i} AS MATERIALIZED (SELECT a, b, n FROM p{i} ORDER BY n DESC, a, b LIMIT 1)")
        out.append(f"w{i} AS MATERIALIZED (SELECT piece, freq, replace(s, (SELECT a || b FROM m{i}), '{new}') AS s FROM w{i - 1})")
    return ", ".join(out)


# ---- corpus


@query(f"WITH {DOCS} SELECT doc_id, text FROM docs")
def corpus_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder)


@query(f"WITH {DOCS}, {LONG} SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM kept")
def corpus_min_chars(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.long_enough(_documents(spark, folder), MIN_CHARS).select("doc_id", F.length("text").cast("bigint").alias("n_chars"))


@query(f"""WITH {DOCS} SELECT doc_id AS line_no, sha256('{{"line_no":' || doc_id || ',"source":' || to_json(coalesce(source, '')) || ',"text":' || to_json(text) || '}}') AS id FROM docs""")
def corpus_doc_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = _documents(spark, folder, "source")
    return rows.select(F.col("doc_id").alias("line_no"), T.document_id(F.coalesce("source", F.lit("")), F.col("doc_id").cast("bigint"), F.col("text")).alias("id"))


@query(f"WITH {DOCS} SELECT CAST(count(*) FILTER (length(text) >= {MIN_CHARS}) AS BIGINT) AS docs_kept, CAST(count(*) FILTER (length(text) < {MIN_CHARS}) AS BIGINT) AS dropped_short, CAST(coalesce(sum(strlen(text)) FILTER (length(text) >= {MIN_CHARS}), 0) AS BIGINT) AS total_bytes, count(DISTINCT source) AS n_sources FROM docs")
def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.stats(_documents(spark, folder, "source"), MIN_CHARS)


@query(f"WITH {DOCS}, run AS (SELECT *, length(text) >= {MIN_CHARS} AS k, coalesce(sum(CASE WHEN length(text) >= {MIN_CHARS} THEN 1 ELSE 0 END) OVER (ORDER BY CAST(doc_id AS BIGINT) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM docs) SELECT CAST(count(*) FILTER (k) AS BIGINT) AS docs_kept, CAST(count(*) FILTER (NOT k) AS BIGINT) AS dropped_short FROM run WHERE b < 300")
def corpus_max_docs(spark: SparkSession, folder: str) -> DataFrame:
    rows = _documents(spark, folder).withColumn("line", F.col("doc_id").cast("bigint"))
    return corpus.kept_prefix(rows, 300, ["line"], MIN_CHARS).agg(F.count_if("kept").alias("docs_kept"), F.count_if(~F.col("kept")).alias("dropped_short"))


@query("SELECT example_id, CASE WHEN json_valid(j) AND json_type(j, '$.text') = 'VARCHAR' THEN json_extract_string(j, '$.text') END AS text FROM (SELECT DISTINCT example_id, CASE CAST(example_id % 4 AS INT) WHEN 0 THEN CAST(json_object('text', 'no ' || example_id) AS VARCHAR) WHEN 1 THEN CAST(json_object('text', example_id) AS VARCHAR) WHEN 2 THEN 'not json' ELSE '[1, 2]' END AS j FROM instructions)")
def json_lenient(spark: SparkSession, folder: str) -> DataFrame:
    ids = _table(spark, folder, "instructions").select("example_id").distinct()
    k = F.col("example_id") % 4
    line = F.when(k == 0, F.to_json(F.struct(F.concat(F.lit("no "), F.col("example_id")).alias("text")))).when(k == 1, F.to_json(F.struct(F.col("example_id").alias("text")))).when(k == 2, "not json").otherwise("[1, 2]")
    return ids.select("example_id", json_text(line).alias("text"))


@query("SELECT corpus, split, count(*) AS files, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM raw_files GROUP BY ALL")
def raw_file_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "raw_files").groupBy("corpus", "split").agg(F.count("*").alias("files"), F.sum("n_bytes").alias("n_bytes"))


@query("SELECT sha256(string_agg(path || '|' || n_bytes, chr(10) ORDER BY path)) AS digest FROM raw_files")
def file_list_digest(spark: SparkSession, folder: str) -> DataFrame:
    # A digest in order needs its list in one place: a line a file, as the listing itself has it.
    rows = _table(spark, folder, "raw_files").agg(F.array_sort(F.collect_list(F.struct("path", "n_bytes"))).alias("l"))
    return rows.select(F.sha2(F.array_join(F.transform("l", lambda x: F.concat(x["path"], F.lit("|"), x["n_bytes"])), "\n"), 256).alias("digest"))


# ---- exact dedup


@query(f"WITH {DOCS}, {LONG} SELECT min(doc_id) AS doc_id, arg_min(text, doc_id) AS text, count(*) AS copies FROM kept GROUP BY sha256(text)")
def dedup_exact(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.exact_dedup(corpus.long_enough(_documents(spark, folder), MIN_CHARS))


@query(f"WITH {DOCS}, {LONG} SELECT count(*) AS total, count(DISTINCT text) AS kept, count(*) - count(DISTINCT text) AS dropped FROM kept")
def dedup_stats(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.dedup_stats(corpus.long_enough(_documents(spark, folder), MIN_CHARS))


@query(f"WITH {DOCS}, {LONG} SELECT copies, count(*) AS texts FROM (SELECT count(*) AS copies FROM kept GROUP BY text) GROUP BY copies")
def dedup_cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.exact_dedup(corpus.long_enough(_documents(spark, folder), MIN_CHARS)).groupBy("copies").agg(F.count("*").alias("texts"))


@query(f"WITH {DOCS}, {LONG}, one AS (SELECT min(doc_id) AS doc_id, arg_min(lower(coalesce(lang, 'none')), doc_id) AS lang, arg_min(text, doc_id) AS text, count(*) AS copies FROM kept GROUP BY sha256(text)) SELECT lang, count(*) AS kept, CAST(sum(copies) - count(*) AS BIGINT) AS dropped, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM one GROUP BY lang")
def dedup_by_language(spark: SparkSession, folder: str) -> DataFrame:
    rows = corpus.long_enough(_documents(spark, folder, F.lower(F.coalesce("lang", F.lit("none"))).alias("lang")), MIN_CHARS)
    one = corpus.exact_dedup(rows)
    return one.groupBy("lang").agg(F.count("*").alias("kept"), (F.sum("copies") - F.count("*")).alias("dropped"), F.sum(F.octet_length("text")).alias("n_bytes"))


# ---- pieces and words


@query(f"WITH {DOCS}, {COUNTS} SELECT piece, freq FROM counts")
def piece_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_counts(_documents(spark, folder), PATTERN)


@query(f"""WITH t AS (SELECT {_clean("output")} AS text FROM instructions), s AS (SELECT unnest(regexp_split_to_array(text, '<\\|endoftext\\|>|<\\|pad\\|>')) AS g FROM t) SELECT piece, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(g, '{RE2.replace(chr(39), chr(39) * 2)}')) AS piece FROM s WHERE g <> '') GROUP BY piece""")
def piece_counts_no_special(spark: SparkSession, folder: str) -> DataFrame:
    rows = corpus.normalised(_table(spark, folder, "instructions").select(F.col("output").alias("text")))
    return pieces.piece_counts(rows, PATTERN, specials=SPECIALS)


@query(f"WITH {DOCS}, {COUNTS} SELECT piece, freq FROM counts WHERE strlen(piece) <= 6")
def piece_counts_short(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_counts(_documents(spark, folder), PATTERN, max_piece_bytes=6)


@query(f"WITH {DOCS}, {COUNTS} SELECT piece, freq FROM counts ORDER BY freq DESC, encode(piece) LIMIT 200")
def piece_topk(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.top_pieces(pieces.piece_counts(_documents(spark, folder), PATTERN), 200)


@query(f"WITH {DOCS}, {COUNTS} SELECT row_number() OVER (ORDER BY freq DESC, encode(piece)) - 1 AS word_idx, lower(hex(encode(piece))) AS symbols, freq FROM counts WHERE freq >= 2")
def word_inventory(spark: SparkSession, folder: str) -> DataFrame:
    words = pieces.word_inventory(pieces.piece_counts(_documents(spark, folder), PATTERN), least=2)
    return words.select("word_idx", _hex(F.col("symbols"), 2).alias("symbols"), "freq")


@query(f"WITH {DOCS}, r AS (SELECT doc_id, text, coalesce(sum(strlen(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM docs) SELECT doc_id FROM r WHERE b < 100000")
def byte_cap_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.capped_lines(_documents(spark, folder), ["doc_id"], max_bytes=100_000).select("doc_id")


@query(f"WITH {DOCS} SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS line_no FROM docs")
def line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.numbered(_documents(spark, folder).select("doc_id"), ["doc_id"])


# ---- merges


def _words(spark: SparkSession, folder: str) -> DataFrame:
    return written(pieces.word_inventory(pieces.piece_counts(_documents(spark, folder), PATTERN)), "words")


def _id(c: str) -> str:
    return f"CAST('0x' || substr({c}, 2, 4) AS INT)"


@query(f"WITH {DOCS}, {COUNTS}, {WRAPPED}, {_merge_sql(1)} SELECT {_id('a')} AS a, {_id('b')} AS b, CAST(n AS BIGINT) AS cnt FROM p1")
def pair_counts(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.pair_counts(_words(spark, folder))


@query(f"WITH {DOCS}, {COUNTS}, {WRAPPED} SELECT {_id('a')} AS a, {_id('b')} AS b, count(DISTINCT piece) AS words FROM (SELECT piece, x[j] AS a, x[j + 1] AS b FROM (SELECT piece, x, unnest(range(1, len(x))) AS j FROM (SELECT piece, regexp_extract_all(s, '<....>') AS x FROM w0))) GROUP BY a, b")
def pair_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.pair_index(_words(spark, folder)).groupBy("a", "b").agg(F.count("*").alias("words"))


@query(f"WITH {DOCS}, {COUNTS}, {WRAPPED}, {_merge_sql(1)} SELECT {_id('a')} AS a, {_id('b')} AS b, CAST(n AS BIGINT) AS cnt FROM m1")
def best_pair(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.best_pair(bpe.pair_counts(_words(spark, folder)))


@query(f"WITH {DOCS}, {COUNTS}, {WRAPPED}, {_merge_sql(MERGES)} " + " UNION ALL ".join(f"SELECT {i - 1} AS rank, {_id('a')} AS a, {_id('b')} AS b, {255 + i} AS new_id, CAST(n AS BIGINT) AS cnt FROM m{i}" for i in range(1, MERGES + 1)))
def bpe_merges_frame(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.learn_frame(_words(spark, folder), MERGES)


@query(ORACLES["bpe_merges_frame"])
def bpe_merges(spark: SparkSession, folder: str) -> DataFrame:
    rows = bpe.learn(_words(spark, folder), MERGES)
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "rank int, a int, b int, new_id int, cnt bigint")


@query(f"WITH {DOCS}, {COUNTS}, {WRAPPED}, {_merge_sql(1)} SELECT piece, replace(replace(s, '<', ''), '>', '') AS symbols FROM w1")
def merge_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    words = _words(spark, folder)
    top = bpe.best_pair(bpe.pair_counts(words)).first()
    return bpe.rewrite(words, top["a"], top["b"], 256).select(T.bytes_text(F.flatten(F.transform("symbols", lambda x: F.when(x == 256, F.array(F.lit(top["a"]), F.lit(top["b"]))).otherwise(F.array(x))))).alias("piece"), _hex(F.col("symbols"), 4).alias("symbols"))


@query(f"WITH {DOCS}, {COUNTS}, {WRAPPED}, {_merge_sql(1)}, q AS (SELECT x[j] AS a, x[j + 1] AS b, sum(freq) AS n FROM (SELECT x, freq, unnest(range(1, len(x))) AS j FROM (SELECT regexp_extract_all(s, '<....>') AS x, freq FROM w1)) GROUP BY ALL) SELECT {_id('a')} AS a, {_id('b')} AS b, CAST(coalesce(q.n, 0) - coalesce(p1.n, 0) AS BIGINT) AS delta FROM p1 FULL OUTER JOIN q USING (a, b) WHERE coalesce(q.n, 0) <> coalesce(p1.n, 0)")
def pair_deltas(spark: SparkSession, folder: str) -> DataFrame:
    words = _words(spark, folder)
    top = bpe.best_pair(bpe.pair_counts(words)).first()
    return bpe.pair_deltas(words, bpe.rewrite(words, top["a"], top["b"], 256))


@query("SELECT b, CASE WHEN p THEN chr(b) ELSE chr(CAST(256 + sum(CASE WHEN p THEN 0 ELSE 1 END) OVER (ORDER BY b) - 1 AS INT)) END AS ch FROM (SELECT CAST(range AS INT) AS b, range BETWEEN 33 AND 126 OR range BETWEEN 161 AND 172 OR range BETWEEN 174 AND 255 AS p FROM range(256))")
def byte_unicode_map(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return spark.createDataFrame(list(enumerate(bpe.byte_chars())), "b int, ch string")


@query("SELECT CAST(range AS INT) AS token_id, lower(hex(range)).lpad(2, '0') AS h, false AS is_special FROM range(256) UNION ALL SELECT 256, lower(hex(encode('<|endoftext|>'))), true UNION ALL SELECT 257, lower(hex(encode('<|pad|>'))), true")
def vocab_ids(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return bpe.vocabulary(spark, [], SPECIALS).select("token_id", F.lower(F.hex("token_bytes")).alias("h"), "is_special")


@query("SELECT * FROM (VALUES ('bos_token', '<|endoftext|>'), ('eos_token', '<|endoftext|>'), ('unk_token', '<|endoftext|>'), ('pad_token', '<|pad|>')) t(role, token)")
def special_role_map(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return bpe.role_map(spark.createDataFrame(list(enumerate(SPECIALS)), "ord int, token string"))


@query(f"WITH {DOCS} SELECT doc_id, lower(hex(encode(text))) AS tokens FROM docs")
def encode_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(_documents(spark, folder), [], PATTERN).select("doc_id", _hex(F.col("tokens"), 2).alias("tokens"))


def _chain(expr: str) -> str:
    for i in range(1, MERGES + 1):
        expr = f"replace({expr}, (SELECT a || b FROM m{i}), '<{255 + i:04x}>')"
    return expr


@query(f"WITH {DOCS}, {COUNTS}, {WRAPPED}, {_merge_sql(MERGES)}, done AS MATERIALIZED (SELECT piece, replace(replace({_chain('s')}, '<', ''), '>', '') AS s FROM w0), x AS (SELECT doc_id, unnest(l) AS piece, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{RE2.replace(chr(39), chr(39) * 2)}') AS l FROM docs)) SELECT doc_id, coalesce(t, '') AS tokens FROM docs LEFT JOIN (SELECT doc_id, string_agg(s, '' ORDER BY i) AS t FROM x JOIN done USING (piece) GROUP BY doc_id) USING (doc_id)")
def encode_bpe(spark: SparkSession, folder: str) -> DataFrame:
    merges = [(a, b) for a, b, _, _ in bpe.learn(_words(spark, folder), MERGES)]
    return bpe.encode(_documents(spark, folder), merges, PATTERN).select("doc_id", _hex(F.col("tokens"), 4).alias("tokens"))


@query(f"WITH {DOCS} SELECT doc_id, text FROM docs")
def decode_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    merges = [(a, b) for a, b, _, _ in bpe.learn(_words(spark, folder), MERGES)]
    tokens = bpe.encode(_documents(spark, folder), merges, PATTERN).drop("text")
    return bpe.decode(tokens, bpe.vocabulary(spark, merges, SPECIALS)).select("doc_id", "text")


@query("SELECT example_id, CAST(generate_subscripts(b, 1) - 1 AS INT) AS pos, CAST('0x' || unnest(b) AS INT) AS token FROM (SELECT DISTINCT example_id, regexp_extract_all(hex(encode(coalesce(output, ''))), '..') AS b FROM instructions)")
def bpe_tokens_table(spark: SparkSession, folder: str) -> DataFrame:
    register(spark, [], T.PATTERNS["gpt2_fast"])
    rows = _table(spark, folder, "instructions").select("example_id", "output").distinct()
    return spark.sql("SELECT d.example_id, t.pos, t.token FROM {d} d, LATERAL bpe_tokens(d.output) t", d=rows)


@query(f"WITH {DOCS} SELECT doc_id, text FROM docs")
def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    register(spark, [(116, 104)], T.PATTERNS["gpt2_fast"])
    rows = _table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return spark.sql("SELECT doc_id, bpe_decode(bpe_encode(corpus_normalise(text, 'none'))) AS text FROM {d}", d=rows)


@query(f"WITH {DOCS}, o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM docs) SELECT doc_id FROM o WHERE k >= 150")
def resumed_documents(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.from_ordinal(_documents(spark, folder).select("doc_id"), 150, ["doc_id"])


# ---- shards and blocks


def _tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Byte tokens and end token of the deduplicated documents."""
    one = corpus.exact_dedup(corpus.long_enough(_documents(spark, folder), MIN_CHARS))
    return shards.with_end(one.select("doc_id", T.text_bytes(F.col("text")).alias("tokens")), EOS)


ONE = "one AS MATERIALIZED (SELECT min(doc_id) AS doc_id, arg_min(text, doc_id) AS text, strlen(any_value(text)) + 1 AS length FROM kept GROUP BY sha256(text))"
SPLIT = "CASE WHEN CAST('0x' || substr(sha256(doc_id), 1, 8) AS BIGINT) % 10 = 0 THEN 'val' ELSE 'train' END"


@query(f"WITH {DOCS}, {LONG}, {ONE}, o AS (SELECT doc_id, length, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM one), s AS (SELECT doc_id, length, k, CAST(k // {DOCS_PER_SHARD} AS INT) AS shard FROM o) SELECT shard, doc_id, CAST(coalesce(sum(length) OVER (PARTITION BY shard ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, CAST(length AS INT) AS length, true AS eos_appended FROM s")
def token_doc_index(spark: SparkSession, folder: str) -> DataFrame:
    sized = _tokens(spark, folder).select("doc_id", F.size("tokens").alias("length"), "eos_appended")
    return shards.sharded(sized, DOCS_PER_SHARD, ["doc_id"]).select("shard", "doc_id", "start", "length", "eos_appended")


@query("SELECT shard, count(*) AS num_docs, CAST(coalesce(sum(length), 0) AS BIGINT) AS num_tokens FROM (SELECT DISTINCT ON (shard, doc_id) * FROM token_index ORDER BY shard, doc_id, length NULLS LAST) GROUP BY shard")
def token_shards(spark: SparkSession, folder: str) -> DataFrame:
    index = _table(spark, folder, "token_index").groupBy("shard", "doc_id").agg(F.max("length").alias("length"))
    return shards.shard_index(index)


@query("WITH d AS (SELECT doc_id, any_value(text) AS text FROM docs_dedup GROUP BY doc_id), i AS (SELECT doc_id, max(length) AS length FROM token_index GROUP BY doc_id) SELECT doc_id, CAST(coalesce(i.length, strlen(d.text) + 1) AS INT) AS length FROM i JOIN d USING (doc_id)")
def token_lengths_filled(spark: SparkSession, folder: str) -> DataFrame:
    index = _table(spark, folder, "token_index").groupBy("doc_id").agg(F.max("length").alias("length"))
    sizes = _table(spark, folder, "docs_dedup").groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("n"))
    return index.join(sizes, "doc_id").select("doc_id", F.coalesce("length", F.col("n") + 1).alias("length"))


@query("SELECT eos_appended, count(*) AS n FROM (SELECT DISTINCT shard, doc_id, eos_appended FROM token_index) GROUP BY ALL")
def eos_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "token_index").select("shard", "doc_id", "eos_appended").distinct().groupBy("eos_appended").agg(F.count("*").alias("n"))


@query(f"WITH {DOCS} SELECT doc_id, {SPLIT} AS split FROM docs")
def split_assign(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select("doc_id", shards.split_name(F.col("doc_id"), 10, 0).alias("split"))


@query(f"WITH {DOCS}, {LONG}, {ONE}, n AS (SELECT s.split, coalesce(sum(o.length), 0) AS n FROM (VALUES ('train'), ('val')) s(split) LEFT JOIN (SELECT length, {SPLIT} AS split FROM one) o USING (split) GROUP BY s.split) SELECT split, CAST(n AS BIGINT) AS raw_tokens, CAST(n // {SEQ_LEN} AS BIGINT) AS num_blocks, CAST(n // {SEQ_LEN} * {SEQ_LEN} AS BIGINT) AS packed_tokens FROM n")
def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    sized = _tokens(spark, folder).select(shards.split_name(F.col("doc_id"), 10, 0).alias("split"), F.size("tokens").alias("length"))
    return shards.packed_counts(sized, SEQ_LEN)


@query(f"WITH {DOCS}, {LONG}, {ONE}, j AS (SELECT {SPLIT} AS split, string_agg(regexp_replace(lower(hex(encode(text))), '(..)', '0\\1', 'g') || '100', '' ORDER BY doc_id) AS s FROM one GROUP BY ALL) SELECT split, CAST(b AS BIGINT) AS block_id, substr(s, CAST(b * {SEQ_LEN * 3} + 1 AS BIGINT), {SEQ_LEN * 3}) AS tokens FROM (SELECT split, s, unnest(range(strlen(s) // {SEQ_LEN * 3})) AS b FROM j)")
def packed_blocks(spark: SparkSession, folder: str) -> DataFrame:
    docs = _tokens(spark, folder).withColumn("split", shards.split_name(F.col("doc_id"), 10, 0))
    return shards.packed_blocks(docs, SEQ_LEN, ["doc_id"]).select("split", "block_id", _hex(F.col("tokens"), 3).alias("tokens"))


@query(f"WITH {DOCS}, {LONG}, {ONE} SELECT doc_id, regexp_replace(lower(hex(encode(text))), '(..)', '0\\1', 'g') || '100' AS tokens FROM one")
def shard_document_slices(spark: SparkSession, folder: str) -> DataFrame:
    sized = _tokens(spark, folder).withColumn("length", F.size("tokens"))
    placed = written(shards.sharded(sized, DOCS_PER_SHARD, ["doc_id"]), "shards")
    arrays = placed.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("start", "tokens"))).alias("l")).select("shard", F.flatten(F.transform("l", lambda x: x["tokens"])).alias("tokens"))
    return shards.document_slices(placed.drop("tokens"), arrays).select("doc_id", _hex(F.col("tokens"), 3).alias("tokens"))


# ---- artifacts

REG = "reg AS (SELECT DISTINCT ON (seq) * FROM registry ORDER BY seq)"


@query(f"WITH {REG} SELECT artifact_type, max(seq) AS seq, arg_max(artifact_id, seq) AS artifact_id FROM reg GROUP BY artifact_type")
def registry_latest(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.latest(_table(spark, folder, "registry")).select("artifact_type", "seq", "artifact_id")


@query(f"WITH {REG} SELECT seq, artifact_id FROM reg WHERE artifact_type = 'tokens' ORDER BY seq DESC LIMIT 1")
def registry_find(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.find(_table(spark, folder, "registry"), "tokens").select("seq", "artifact_id")


@query(f"WITH {REG} SELECT artifact_type, seq, artifact_id FROM reg WHERE artifact_type IN ('corpus_dedup', 'corpus') ORDER BY artifact_type <> 'corpus_dedup', seq DESC LIMIT 1")
def registry_resolve(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.resolve(_table(spark, folder, "registry"), "corpus_dedup", "corpus").select("artifact_type", "seq", "artifact_id")


EDGES = "e AS (SELECT DISTINCT artifact_id, i.artifact_id AS up FROM (SELECT artifact_id, unnest(inputs) AS i FROM registry) WHERE i.artifact_id IS NOT NULL)"


@query(f"WITH RECURSIVE {EDGES}, c AS (SELECT artifact_id, up, 1 AS steps FROM e UNION ALL SELECT c.artifact_id, e.up, c.steps + 1 FROM c JOIN e ON c.up = e.artifact_id) SELECT artifact_id, up AS ancestor, CAST(min(steps) AS INT) AS steps FROM c GROUP BY ALL")
def lineage_closure(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.closure(_table(spark, folder, "registry"))


@query(f"WITH {EDGES} SELECT artifact_id, up AS input_id FROM e WHERE up NOT IN (SELECT artifact_id FROM registry)")
def missing_inputs(spark: SparkSession, folder: str) -> DataFrame:
    reg = _table(spark, folder, "registry")
    named = lineage.edges(reg).select("artifact_id", "input_id")
    return lineage.missing(named, reg.select(F.col("artifact_id").alias("input_id")).distinct(), "input_id").select("artifact_id", "input_id")


@query("WITH want AS (SELECT DISTINCT i.artifact_id AS id, i.hash AS hash FROM (SELECT unnest(inputs) AS i FROM registry) WHERE i.hash IS NOT NULL), have AS (SELECT artifact_id AS id, arg_max(config_hash, seq) AS hash FROM registry GROUP BY 1) SELECT want.id AS id, want.hash AS expected, have.hash AS actual FROM want JOIN have USING (id) WHERE want.hash <> have.hash")
def checksum_verify(spark: SparkSession, folder: str) -> DataFrame:
    reg = _table(spark, folder, "registry")
    want = reg.select(F.explode("inputs").alias("i")).select(F.col("i.artifact_id").alias("id"), F.col("i.hash").alias("hash")).where("hash is not null").distinct()
    have = reg.groupBy(F.col("artifact_id").alias("id")).agg(F.max_by("config_hash", "seq").alias("hash"))
    return lineage.differing(want, have, "id", "hash")


@query("WITH r AS (SELECT DISTINCT ON (seq) * FROM registry ORDER BY seq) SELECT seq, artifact_id FROM r ORDER BY seq DESC LIMIT 3")
def keep_last_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    once = _table(spark, folder, "registry").dropDuplicates(["seq"])
    return evaluation.keep_last(once, 3, "seq").select("seq", "artifact_id")


# ---- training inputs and evaluation


@query("SELECT DISTINCT example_id, '### Instruction:' || chr(10) || coalesce(instruction, '') || chr(10) || chr(10) || '### Response:' || chr(10) || coalesce(output, '') || chr(10) AS text FROM instructions")
def sft_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "instructions")
    return rows.select("example_id", T.prompt(F.coalesce("instruction", F.lit("")), F.coalesce("output", F.lit(""))).alias("text")).distinct()


@query("SELECT DISTINCT example_id, substr(lower(hex(encode(coalesce(output, '')))), 1, 128) AS tokens, CAST(least(strlen(coalesce(output, '')), 64) AS INT) AS n FROM instructions")
def sft_truncate(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "instructions").select("example_id", T.text_bytes(F.coalesce("output", F.lit(""))).alias("tokens"))
    cut = shards.labelled(shards.truncated(rows, 64))
    return cut.select("example_id", _hex(F.col("labels"), 2).alias("tokens"), F.size("tokens").alias("n")).distinct()


@query("SELECT CASE WHEN CAST('0x' || substr(sha256(CAST(example_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 10 THEN 'test' ELSE 'train' END AS split, count(*) AS n FROM (SELECT DISTINCT example_id FROM instructions) GROUP BY ALL")
def sft_holdout(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.holdout(_table(spark, folder, "instructions").select("example_id").distinct(), "example_id").groupBy("split").agg(F.count("*").alias("n"))


@query("SELECT event_type, round(avg(ln(1 + abs(value))), 6) AS eval_loss, round(exp(avg(ln(1 + abs(value)))), 4) AS perplexity, count(value) AS num_samples FROM events GROUP BY event_type")
def eval_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    losses = _table(spark, folder, "events").select("event_type", F.log(1 + F.abs("value")).alias("loss"))
    return evaluation.perplexity(losses, by=["event_type"]).select("event_type", F.round("eval_loss", 6).alias("eval_loss"), F.round("perplexity", 4).alias("perplexity"), "num_samples")


@query("SELECT CAST(range AS BIGINT) AS step, CAST(least((range + 1) / 10, 1.0) AS DOUBLE) AS factor, range % 4 = 0 AS save FROM range(25)")
def warm_up_schedule(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    steps = spark.range(25).withColumnRenamed("id", "step")
    return evaluation.scheduled(steps, 10).withColumn("save", evaluation.every(F.col("step"), 4))


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def events_windows(spark: SparkSession, folder: str) -> DataFrame:
    return windowed_counts(_table(spark, folder, "events")).withColumn("total", F.round("total", 4))


@query("WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS n FROM s GROUP BY user_id, k")
def events_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return sessions(_table(spark, folder, "events").where("user_id is not null"))


from . import catalog_of_formats  # noqa: E402, F401  (adds its queries to QUERIES and ORACLES)
