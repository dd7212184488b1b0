"""Further core queries: files written and read again, merge logs, snapshots, manifests, streams and stages.

What a query writes goes to the work folder and is read back from there; the SQL works on the tables.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog_of_queries import COUNTS, DOCS, DOCS_PER_SHARD, LONG, MERGES, MIN_CHARS, ONE, ORACLES, PATTERN, RE2, REG, SEQ_LEN, SPECIALS, SPLIT, WRAPPED, _clean, _documents, _hex, _id, _merge_sql, _table, _tokens, _words, query
from .functions import text as T
from .operators import bpe, corpus, evaluation, lineage, pieces, shards
from .operators.prefix import ordinal
from .plans import configs, pipeline
from .sources import artifacts, files, interchange, lines
from .storage import shared_folder, spread
from .streaming.counts import stream_table, streaming_piece_counts

QUOTED = RE2.replace("'", "''")


def _work(spark: SparkSession, name: str) -> str:
    """A new folder, as a path that Python and Spark both take."""
    return shared_folder(spark, name).removeprefix("file://")


def _learnt(spark: SparkSession, folder: str, n: int = MERGES, least: int = 1) -> list[tuple[int, int]]:
    return [(a, b) for a, b, _, _ in bpe.learn(_words(spark, folder), n, least)]


# ---- text and JSON lines

SPLITS = f"t AS MATERIALIZED (SELECT coalesce(split, 'none') AS split, {_clean('text')} AS text FROM documents), u AS MATERIALIZED (SELECT * FROM t WHERE text <> '')"


def _split_files(spark: SparkSession, folder: str) -> list[str]:
    """The documents' texts as lines of text files, a folder for each split."""
    rows = _documents(spark, folder, F.coalesce("split", F.lit("none")).alias("split")).where("text <> ''")
    where = _work(spark, "split-text")
    interchange.write_split_text(rows, where)
    return files.find([where], "text", strict=True)


def _split_of() -> Column:
    return F.regexp_extract("source", r"split=([^/]*)/", 1).alias("split")


@query(f"WITH {SPLITS} SELECT split, count(*) AS lines, count(*) AS numbered, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM u GROUP BY split")
def lines_numbered(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.corpus_lines(spark, _split_files(spark, folder))
    per = found.groupBy("source").agg(F.count("*").alias("lines"), F.max("line_no").alias("last"), F.sum(F.octet_length("text")).alias("n_bytes"))
    return per.groupBy(_split_of()).agg(F.sum("lines").alias("lines"), F.sum("last").alias("numbered"), F.sum("n_bytes").alias("n_bytes"))


@query(f"WITH {SPLITS} SELECT split, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes FROM u GROUP BY split")
def training_line_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return lines.training_lines(spark, _split_files(spark, folder)).groupBy(_split_of()).agg(F.sum(F.octet_length("text")).alias("n_bytes"))


ODD = "x AS (SELECT DISTINCT example_id, CAST(example_id % 6 AS INT) AS k FROM instructions)"


def _odd_lines(spark: SparkSession, folder: str) -> list[str]:
    """JSON lines of all kinds: with a text, a number, no JSON, an array, blank, with an empty text."""
    ids = _table(spark, folder, "instructions").select("example_id").distinct()
    k = F.col("example_id") % 6
    text = F.to_json(F.struct(F.concat(F.lit("no "), F.col("example_id")).alias("text")))
    line = F.when(k == 0, text).when(k == 1, F.to_json(F.struct(F.col("example_id").alias("text")))).when(k == 2, "not json").when(k == 3, "[1, 2]").when(k == 4, " ").otherwise('{"text":""}')
    where = _work(spark, "odd-lines")
    ids.select(line.alias("value")).write.text(where)
    return files.find([where], "text", strict=True)


@query(f"WITH {ODD} SELECT 'no ' || example_id AS text, CAST(1 AS BIGINT) AS n FROM x WHERE k = 0 UNION ALL SELECT '', count(*) FROM x WHERE k = 5 HAVING count(*) > 0")
def jsonl_corpus(spark: SparkSession, folder: str) -> DataFrame:
    return lines.corpus_lines(spark, _odd_lines(spark, folder), "jsonl").groupBy("text").agg(F.count("*").alias("n"))


@query(f"WITH {ODD} SELECT CASE WHEN k = 0 THEN 'no ' || example_id ELSE '' END AS text, count(*) AS n FROM x GROUP BY 1")
def jsonl_training(spark: SparkSession, folder: str) -> DataFrame:
    return lines.training_lines(spark, _odd_lines(spark, folder), "jsonl").groupBy("text").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT doc_id, text, source, meta.lang AS lang FROM docs_dedup WHERE doc_id IS NOT NULL")
def documents_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    where = _work(spark, "documents")
    interchange.write_documents(_table(spark, folder, "docs_dedup"), where)
    return interchange.read_documents(spark, where).select("doc_id", "text", "source", F.col("meta.lang").alias("lang")).distinct()


@query(f"WITH {DOCS} SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM docs")
def documents_sorted(spark: SparkSession, folder: str) -> DataFrame:
    where = _work(spark, "sorted")
    interchange.write_documents(_documents(spark, folder), where, order=["doc_id"])
    found = lines.read_lines(spark, files.find([where + "/"]) and [str(p) for p in sorted(Path(where).glob("part-*.json.gz"))])
    placed = ordinal(found.select("source", "line_no", lines.json_text(F.col("text"), "doc_id").alias("doc_id")), ["source", "line_no"], name="place")
    return placed.select("doc_id", "place")


def _path_files(spark: SparkSession, folder: str) -> str:
    """A text file for each raw file, holding its path."""
    where = _work(spark, "paths")
    _table(spark, folder, "raw_files").select(F.md5("path").alias("k"), F.col("path").alias("value")).distinct().repartition(8, "k").write.partitionBy("k").text(where)
    return where


def _name_of() -> Column:
    return F.regexp_extract("path", r"k=([0-9a-f]+)/", 1).alias("k")


@query("SELECT DISTINCT md5(path) AS k, sha256(path || chr(10)) AS sha256 FROM raw_files")
def file_checksums(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.file_checksums(spark, _path_files(spark, folder)).select(_name_of(), "sha256")


@query("SELECT DISTINCT md5(path) AS k, sha256(path || chr(10)) AS sha256 FROM raw_files")
def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.digests_of(spark, files.find([_path_files(spark, folder)], "text", strict=True)).select(_name_of(), "sha256")


@query("SELECT md5(path) AS k, row_number() OVER (ORDER BY md5(path)) - 1 AS place FROM (SELECT DISTINCT path FROM raw_files)")
def files_found(spark: SparkSession, folder: str) -> DataFrame:
    where = _path_files(spark, folder)
    found = files.find([where, where, f"{where}/none"], "text")  # each file once, in order of paths
    return spark.createDataFrame(list(enumerate(found)), "place bigint, path string").select(_name_of(), "place")


# ---- text forms


@query(f"WITH {DOCS} SELECT doc_id, nfc_normalize(text) AS text FROM docs")
def corpus_nfc(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return corpus.normalised(spread(rows), form="NFC")


@query(f"WITH {DOCS} SELECT doc_id, text FROM docs")
def bytes_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = _documents(spark, folder)
    return rows.select("doc_id", T.decode_bytes(F.encode(T.bytes_text(T.text_bytes(F.col("text"))), "UTF-8")).alias("text"))


@query(ORACLES["piece_counts"])
def piece_counts_default(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_counts(_documents(spark, folder), T.resolve_pattern("gpt2_default"))


@query(f"WITH {DOCS} SELECT piece, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(text, '(?i)the|[a-c]+')) AS piece FROM docs) GROUP BY piece")
def piece_counts_flags(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.piece_counts(_documents(spark, folder), T.resolve_pattern("custom", "the|[a-c]+", ("IGNORECASE",)))


@query(f"WITH {DOCS} SELECT doc_id FROM docs ORDER BY doc_id LIMIT 500")
def line_cap_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.capped_lines(_documents(spark, folder).select("doc_id", "text"), ["doc_id"], max_lines=500).select("doc_id")


@query(f"WITH {DOCS}, {COUNTS} SELECT row_number() OVER (ORDER BY freq DESC, encode(piece)) - 1 AS word_idx, lower(hex(encode(piece))) AS symbols, freq FROM counts ORDER BY freq DESC, encode(piece) LIMIT 1000")
def capped_inventory(spark: SparkSession, folder: str) -> DataFrame:
    words = pieces.word_inventory(pieces.piece_counts(_documents(spark, folder), PATTERN), most_words=1000)
    return words.select("word_idx", _hex(F.col("symbols"), 2).alias("symbols"), "freq")


@query("SELECT DISTINCT example_id FROM instructions ORDER BY example_id LIMIT 100")
def instructions_slice(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "instructions").select("example_id").distinct().orderBy("example_id").limit(100)


# ---- merges

_ALL = " UNION ALL ".join(f"SELECT {i - 1} AS rank, {_id('a')} AS a, {_id('b')} AS b, {255 + i} AS new_id, CAST(n AS BIGINT) AS cnt FROM m{i}" for i in range(1, MERGES + 1))
LEARNT = f"WITH {DOCS}, {COUNTS}, {WRAPPED}, {_merge_sql(MERGES)}, learnt AS MATERIALIZED ({_ALL})"
_TOKENS = "tok0 AS (SELECT '<00' || printf('%02x', range) || '>' AS code, printf('%02x', range) AS h FROM range(256)), " + ", ".join(
    f"tok{i} AS MATERIALIZED (SELECT * FROM tok{i - 1} UNION ALL SELECT '<{255 + i:04x}>', x.h || y.h FROM m{i} JOIN tok{i - 1} x ON x.code = a JOIN tok{i - 1} y ON y.code = b)" for i in range(1, MERGES + 1)
)


@query(f"{LEARNT}, {_TOKENS} SELECT {_id('code')} AS token_id, h, false AS is_special FROM tok{MERGES} UNION ALL SELECT {256 + MERGES}, lower(hex(encode('{SPECIALS[0]}'))), true UNION ALL SELECT {257 + MERGES}, lower(hex(encode('{SPECIALS[1]}'))), true")
def tokenizer_folder(spark: SparkSession, folder: str) -> DataFrame:
    where = Path(_work(spark, "tokenizer"))
    interchange.write_tokenizer(where, _learnt(spark, folder), SPECIALS, "end", {"pattern_alias": "gpt2_fast"})
    return interchange.vocabulary_table(spark, interchange.read_tokenizer(where)).select("token_id", F.lower(F.hex("token_bytes")).alias("h"), "is_special")


@query(f"{LEARNT} SELECT count(*) + 257 AS max_id, count(*) AS merges FROM learnt")
def vocabulary_size(spark: SparkSession, folder: str) -> DataFrame:
    merges = _learnt(spark, folder)
    return bpe.vocabulary(spark, merges, SPECIALS, "start").agg(F.max("token_id").cast("bigint").alias("max_id"), (F.count("*") - 256 - len(SPECIALS)).alias("merges"))


@query(f"{LEARNT} SELECT rank, a, b, new_id FROM learnt")
def merge_ranks(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.merge_ranks(spark, _learnt(spark, folder))


@query(f"{LEARNT} SELECT * FROM learnt WHERE cnt >= 400")
def bpe_merges_min_freq(spark: SparkSession, folder: str) -> DataFrame:
    rows = bpe.learn(_words(spark, folder), MERGES, 400)
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "rank int, a int, b int, new_id int, cnt bigint")


@query(f"WITH {DOCS}, {COUNTS}, {WRAPPED}, {_merge_sql(1)} SELECT count(*) AS words, CAST(sum(freq) AS BIGINT) AS freq, count(*) AS changed FROM w0 WHERE contains(s, (SELECT a || b FROM m1))")
def words_with_best(spark: SparkSession, folder: str) -> DataFrame:
    words = _words(spark, folder)
    top = bpe.best_pair(bpe.pair_counts(words)).first()
    changed = bpe.Learner((r["symbols"], r["freq"]) for r in words.select("symbols", "freq").collect()).merge((top["a"], top["b"]), 256)  # an inventory, bounded by its cap
    return bpe.words_with(words, top["a"], top["b"]).agg(F.count("*").alias("words"), F.sum("freq").alias("freq")).withColumn("changed", F.lit(changed).cast("bigint"))


@query(f"WITH {DOCS}, {COUNTS}, {WRAPPED}, {_merge_sql(1)} SELECT CAST({_id('a')} AS BIGINT) * 4294967296 + {_id('b')} AS pair, {_id('a')} AS a, {_id('b')} AS b FROM p1")
def pair_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = bpe.pair_counts(_words(spark, folder)).select(T.pair_id(F.col("a"), F.col("b")).alias("pair"))
    a, b = T.split_pair(F.col("pair"))
    return rows.select("pair", a.alias("a"), b.alias("b"))


@query(ORACLES["bpe_merges_frame"])
def bpe_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Merges learnt, logged, half of them read back from the log and replayed before the rest is learnt again."""
    words, path = _words(spark, folder), Path(_work(spark, "log")) / "merges.wal"
    path.parent.mkdir(parents=True)
    log = artifacts.MergeLog(path, "config", "pattern", sync_every=2)
    bpe.learn(words, MERGES, on_merge=log.add)
    log.close()
    done = bpe.committed(artifacts.read_merge_log(spark, str(path))).where(f"merge_idx < {MERGES // 2}").orderBy("merge_idx").collect()
    rows = bpe.learn(words, MERGES, replay=[(r["a"], r["b"], r["new_id"]) for r in done])
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "rank int, a int, b int, new_id int, cnt bigint")


@query(f"{LEARNT} SELECT rank, a, b, new_id, cnt FROM learnt WHERE rank < {MERGES - 2}")
def snapshot_resume(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots every two merges; the newest is damaged, so the one before is read."""
    where = Path(_work(spark, "snapshots"))
    rows = bpe.learn(_words(spark, folder), MERGES)
    for n in range(2, MERGES + 1, 2):
        newest = artifacts.save_snapshot(where, n, rows[:n], {"config_hash": "c"}, keep=2)
    newest.write_bytes(b"{}")
    found = artifacts.latest_snapshot(where, {"config_hash": "c"})["merges"]
    return spark.createDataFrame([(k, *r) for k, r in enumerate(found)], "rank int, a int, b int, new_id int, cnt bigint")


WAL = "c AS (SELECT DISTINCT CAST(seq AS INT) AS k FROM registry WHERE seq % 3 <> 0)"


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """A merge log from the registry's numbers, read from a file; every third merge was begun only."""
    seq = _table(spark, folder, "registry").select(F.col("seq").alias("k")).distinct()
    begin = F.format_string("BEGIN\t%d\t%d\t%d\t10", "k", F.col("k") + 1, F.col("k") + 2)
    done = F.when(F.col("k") % 3 != 0, F.format_string("COMMIT\t%d\t%d", "k", F.col("k") + 256))
    where = _work(spark, "wal")
    seq.select(F.explode(F.array_compact(F.array(begin, done, F.lit("damaged")))).alias("value")).write.text(where)
    return bpe.committed(artifacts.read_merge_log(spark, where))


@query(f"WITH {WAL} SELECT k AS merge_idx, k + 1 AS a, k + 2 AS b, k + 256 AS new_id FROM c")
def wal_commits(spark: SparkSession, folder: str) -> DataFrame:
    return _log(spark, folder)


@query(f"WITH {WAL} SELECT * FROM (SELECT k AS merge_idx, k - lag(k) OVER (ORDER BY k) AS step FROM c) WHERE step <> 1")
def wal_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.gaps(_log(spark, folder)).select("merge_idx", "step")


@query(f"WITH {DOCS} SELECT doc_id, text FROM docs")
def roundtrip_2000_merges(spark: SparkSession, folder: str) -> DataFrame:
    merges = _learnt(spark, folder, 2000, 2)
    tokens = bpe.encode(_documents(spark, folder), merges, PATTERN).drop("text")
    ended = shards.with_end(tokens, 256 + len(merges))
    return bpe.decode(ended, bpe.vocabulary(spark, merges, SPECIALS), skip_special=True).select("doc_id", "text")


@query(f"WITH {DOCS} SELECT doc_id, CAST(strlen(text) AS INT) AS n, 'uint16' AS width FROM docs")
def token_widths(spark: SparkSession, folder: str) -> DataFrame:
    tokens = bpe.encode(_documents(spark, folder), [], PATTERN)
    return tokens.select("doc_id", F.size(T.checked_ids(F.col("tokens"), "uint16")).alias("n"), F.lit(T.storage_width(0)).alias("width"))


# ---- binary token files


def _token_files(spark: SparkSession, folder: str) -> str:
    sized = _tokens(spark, folder).withColumn("length", F.size("tokens"))
    where = _work(spark, "tokens")
    interchange.write_token_shards(shards.sharded(sized, DOCS_PER_SHARD, ["doc_id"]), where).collect()  # a row a shard
    return where


@query(ORACLES["shard_document_slices"])
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    where = _token_files(spark, folder)
    found = shards.document_slices(interchange.read_token_index(spark, where), interchange.read_token_shards(spark, where))
    return found.select("doc_id", _hex(F.col("tokens"), 3).alias("tokens"))


@query(ORACLES["token_doc_index"])
def token_file_index(spark: SparkSession, folder: str) -> DataFrame:
    return interchange.read_token_index(spark, _token_files(spark, folder)).select("shard", "doc_id", "start", "length", "eos_appended")


@query("SELECT shard, count(*) AS num_docs, CAST(sum(length) AS BIGINT) AS num_tokens FROM (" + ORACLES["token_doc_index"] + ") GROUP BY shard")
def finished_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = interchange.finished_shards(Path(_token_files(spark, folder)))
    return spark.createDataFrame([(r["shard"], r["num_docs"], r["num_tokens"]) for r in rows], "shard int, num_docs bigint, num_tokens bigint")


@query("SELECT split, tokens FROM (" + ORACLES["packed_blocks"] + ")")
def packed_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _tokens(spark, folder).withColumn("split", shards.split_name(F.col("doc_id"), 10, 0))
    where = _work(spark, "packed")
    made = interchange.write_packed(shards.packed_blocks(docs, SEQ_LEN, ["doc_id"]), where).collect()  # a row a file
    out = None
    for split in sorted({r["split"] for r in made}):
        found = shards.require_blocks(interchange.read_packed(spark, f"{where}/{split}/shards/pack_*.bin", SEQ_LEN), SEQ_LEN).select(F.lit(split).alias("split"), _hex(F.col("tokens"), 3).alias("tokens"))
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "split string, tokens string")


@query("SELECT range AS step, CAST(8 AS BIGINT) AS slots FROM range(20)")
def training_batches(spark: SparkSession, folder: str) -> DataFrame:
    docs = _tokens(spark, folder).withColumn("split", shards.split_name(F.col("doc_id"), 10, 0))
    blocks = shards.packed_blocks(docs, SEQ_LEN, ["doc_id"]).where("split = 'train'")
    n = shards.packed_counts(docs.withColumn("length", F.size("tokens")), SEQ_LEN).where("split = 'train'").first()["num_blocks"]
    return evaluation.batches(blocks, n, steps=20, batch_size=8).groupBy("step").agg(F.count("tokens").alias("slots"))


@query(f"WITH {DOCS} SELECT least(100, count(*)) AS n, least(100, count(*)) AS ids FROM docs")
def sample_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = _documents(spark, folder).withColumn("text", F.concat_ws(" ", "doc_id", "text"))
    once = evaluation.sample_lines(rows, 100, seed=1)
    again = evaluation.sample_lines(rows.repartition(3), 100, seed=1).select(F.col("doc_id").alias("same"))
    return once.join(again, F.col("doc_id") == F.col("same")).agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids"))


@query(f"WITH {DOCS}, {LONG}, {ONE}, o AS (SELECT {SPLIT} AS split, length, coalesce(sum(length) OVER w, 0) AS p, sum(length) OVER (PARTITION BY {SPLIT}) AS total FROM one WINDOW w AS (PARTITION BY {SPLIT} ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT split, CAST(p // {SEQ_LEN} AS BIGINT) AS block_id, string_agg(CAST(CAST(p % {SEQ_LEN} AS INT) AS VARCHAR), ',' ORDER BY p) AS starts FROM o WHERE p // {SEQ_LEN} < total // {SEQ_LEN} GROUP BY ALL")
def packed_boundaries(spark: SparkSession, folder: str) -> DataFrame:
    docs = _tokens(spark, folder).select("doc_id", F.size("tokens").alias("length"), shards.split_name(F.col("doc_id"), 10, 0).alias("split"))
    return shards.block_boundaries(docs, SEQ_LEN, ["doc_id"]).select("split", "block_id", F.array_join("starts", ",").alias("starts"))


# ---- artifacts and stages

KINDS = "k AS (SELECT DISTINCT artifact_type AS t, sha256('{\"type\":\"' || artifact_type || '\"}') AS h FROM registry)"


@query(f"WITH {KINDS} SELECT t AS artifact_type, t || '_' || substr(h, 1, 12) AS artifact_id, h AS config_hash, t AS manifest_type FROM k")
def registry_published(spark: SparkSession, folder: str) -> DataFrame:
    root = Path(_work(spark, "artifacts"))
    for r in _table(spark, folder, "registry").select("artifact_type").distinct().orderBy("artifact_type").collect():  # a row a type
        kind, config = r["artifact_type"], {"type": r["artifact_type"]}
        name = artifacts.artifact_id(kind, artifacts.stable_hash(config))
        run = artifacts.Run.start(kind, root / "runs", config, kind)
        artifacts.publish(root, artifacts.artifact_folder(root, kind, name), artifacts.manifest(kind, name, run, [], {}, {}))
        run.end("done")
    table = artifacts.registry_table(spark, root)
    manifests = spark.read.schema("artifact_type string, artifact_id string").option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", artifacts.MANIFEST).json(str(root))
    return table.join(manifests.select("artifact_id", F.col("artifact_type").alias("manifest_type")), "artifact_id").select("artifact_type", "artifact_id", "config_hash", "manifest_type")


@query(f"WITH {REG}, last AS (SELECT * FROM reg WHERE artifact_type = 'packed' ORDER BY seq DESC LIMIT 1), i AS (SELECT unnest(inputs) AS i, generate_subscripts(inputs, 1) AS pos FROM last) SELECT i.artifact_id AS artifact_id, i.hash AS hash FROM i WHERE i.artifact_type = 'tokens' ORDER BY pos LIMIT 1")
def input_of(spark: SparkSession, folder: str) -> DataFrame:
    reg = _table(spark, folder, "registry")
    return lineage.input_of(reg, lineage.find(reg, "packed").first()["artifact_id"], "tokens")


@query("SELECT max(seq) AS seq FROM registry WHERE artifact_type = 'tokens' AND seq % 4 <> 0 HAVING count(*) > 0")
def newest_valid_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "registry").select("seq", (F.col("seq") % 4 != 0).alias("valid"), F.col("artifact_type").alias("config_hash"), F.lit("p").alias("pattern_hash"))
    return evaluation.newest_valid(rows, "tokens", "p", "seq").select("seq")


def _config(stage: str, root: str, **own) -> dict:
    return artifacts.load_config(None, pipeline.STAGES[stage][0], artifacts.merge_config({"artifacts_root": f"{root}/artifacts", "run": {"output_dir": f"{root}/runs/{stage}"}}, own))


@query(f"WITH {SPLITS}, k AS (SELECT text FROM u WHERE length(text) >= {MIN_CHARS}) SELECT (SELECT count(*) FROM k) AS docs_kept, (SELECT count(*) FROM u) - (SELECT count(*) FROM k) AS dropped_short, CAST((SELECT coalesce(sum(strlen(text)), 0) FROM k) AS BIGINT) AS total_bytes, (SELECT count(DISTINCT text) FROM k) AS kept, (SELECT count(*) - count(DISTINCT text) FROM k) AS dropped")
def stages_corpus_and_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The first two stages end to end; what they say in their manifests.  A second call resumes to the same artifact."""
    root, paths = _work(spark, "stages"), _split_files(spark, folder)
    cfg = _config("corpus", root, data={"input_paths": paths, "min_chars": MIN_CHARS})
    configs.check_corpus(cfg)
    name = pipeline.build_corpus(spark, cfg, "r")
    if pipeline.build_corpus(spark, cfg, "r", resume=True) != name:
        raise ValueError("a finished stage must resume to its artifact")
    pipeline.dedup(spark, _config("dedup", root), "r")
    stats: dict = {}
    for r in artifacts.registry_rows(Path(root) / "artifacts"):
        stats |= artifacts.read_json(Path(r["manifest_path"]))["stats"]
    return spark.createDataFrame([tuple(stats[k] for k in ("docs_kept", "dropped_short", "total_bytes", "kept", "dropped"))], "docs_kept bigint, dropped_short bigint, total_bytes bigint, kept bigint, dropped bigint")


@query(f"WITH {SPLITS}, c AS (SELECT piece, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(text || chr(10), '{QUOTED}')) AS piece FROM u) GROUP BY piece) SELECT row_number() OVER (ORDER BY freq DESC, encode(piece)) - 1 AS word_idx, lower(hex(encode(piece))) AS symbols, freq FROM c WHERE freq >= 2")
def counted_words(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the tokenizer stage, kept by a run and read again by the run that resumes it."""
    root, paths = _work(spark, "words"), _split_files(spark, folder)
    cfg = _config("tokenizer", root, data={"input_paths": paths}, special_tokens={"tokens": []})
    run = artifacts.Run.start("tokenizer", Path(root) / "runs", cfg, "r")
    pipeline.counted_words(spark, cfg, run, paths, PATTERN, {"files": "x"}, resume=False)
    kept = pipeline.counted_words(spark, cfg, run, paths, PATTERN, {"files": "x"}, resume=True)
    return kept.select("word_idx", _hex(F.col("symbols"), 2).alias("symbols"), "freq")


@query(f"""SELECT piece, count(*) AS freq FROM (SELECT unnest(regexp_extract_all({_clean("output")}, '{QUOTED}')) AS piece FROM instructions) GROUP BY piece""")
def streamed_piece_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counted as files arrive, by a stream that stops when all are read; the offset log is in the work folder."""
    table = _table(spark, folder, "instructions")
    source = f"{folder}/instructions.parquet"
    where = source if Path(source).is_dir() else folder
    stream = corpus.normalised(stream_table(spark, where, table.schema, "*.parquet" if where == source else "instructions.parquet").select(F.col("output").alias("text")))
    name = "streamed_pieces"
    running = streaming_piece_counts(stream, PATTERN, name, shared_folder(spark, "stream"))
    running.awaitTermination()
    if running.exception():
        raise running.exception()
    return spark.table(name).select("piece", "freq")


# ---- evaluation

_LOSS = "ln(1 + abs(value))"


@query(f"SELECT round(avg({_LOSS}), 6) AS eval_loss, round(exp(avg({_LOSS})), 4) AS perplexity, count(value) AS num_samples FROM events")
def evaluation_report(spark: SparkSession, folder: str) -> DataFrame:
    """The one-row report as its JSON file has it."""
    report = evaluation.perplexity(_table(spark, folder, "events").select(F.log(1 + F.abs("value")).alias("loss")))
    where = Path(_work(spark, "eval"))
    interchange.write_evaluation(where, report, ["a sample"])
    found = spark.read.schema("eval_loss double, perplexity double, num_samples bigint").option("multiLine", True).json(str(where / "eval.json"))
    return found.select(F.round("eval_loss", 6).alias("eval_loss"), F.round("perplexity", 4).alias("perplexity"), "num_samples")


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 4) AS mean FROM events")
def metric_means(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.smoothed(_table(spark, folder, "events"), 10, "event_type", "event_id", "value").select("event_id", F.round("mean", 4).alias("mean"))
