"""Byte-pair merges: counting, learning, replay, vocabulary, encoding and decoding.

Learning has two forms.  `learn_frame` runs every step as a Spark job and suits a few merges and
checks.  `learn` is the production form: Spark counts and ranks the words, at most a configured
number of them come to one process, which keeps pair counts up to date merge by merge; tens of
thousands of dependent steps would otherwise be as many jobs.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter, defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..storage import written

BASE = 256


def pair_counts(words: DataFrame) -> DataFrame:
    """a, b, cnt: neighbouring symbols weighted by word frequency; overlaps count each."""
    pairs = words.select(F.explode(T.adjacent(F.col("symbols"))).alias("p"), "freq")
    return pairs.groupBy("p.a", "p.b").agg(F.sum("freq").alias("cnt")).where("cnt > 0")


def pair_index(words: DataFrame) -> DataFrame:
    """a, b, word_idx: which words hold a pair, once each."""
    return words.select(F.explode(F.array_distinct(T.adjacent(F.col("symbols")))).alias("p"), "word_idx").select("p.a", "p.b", "word_idx")


def best_pair(pairs: DataFrame, least: int = 1) -> DataFrame:
    """The most frequent pair; ties by the smaller ids."""
    return pairs.where(F.col("cnt") >= least).orderBy(F.desc("cnt"), "a", "b").limit(1)


def words_with(words: DataFrame, a: int, b: int) -> DataFrame:
    return words.where(F.exists(T.adjacent(F.col("symbols")), lambda p: (p["a"] == a) & (p["b"] == b)))


def rewrite(words: DataFrame, a: int, b: int, new_id: int) -> DataFrame:
    """Every a b merged, left to right without overlap."""
    return words.withColumn("symbols", T.merge_pair(F.col("symbols"), a, b, new_id))


def pair_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """a, b, delta of the pair counts between two states of the words."""
    old, new = pair_counts(before).withColumnRenamed("cnt", "old"), pair_counts(after).withColumnRenamed("cnt", "new")
    both = old.join(new, ["a", "b"], "full_outer")
    return both.select("a", "b", (F.coalesce("new", F.lit(0)) - F.coalesce("old", F.lit(0))).alias("delta")).where("delta <> 0")


def learn_frame(words: DataFrame, merges: int, least: int = 1, cut_every: int = 8) -> DataFrame:
    """rank, a, b, new_id, cnt: the first merges, each step a Spark job; lineage is cut every few."""
    spark = words.sparkSession
    rows = []
    for rank in range(merges):
        best = best_pair(pair_counts(words), least).collect()  # one row
        if not best:
            break
        a, b, n = best[0]["a"], best[0]["b"], best[0]["cnt"]
        rows.append((rank, a, b, BASE + rank, n))
        words = rewrite(words, a, b, BASE + rank)
        if rank % cut_every == cut_every - 1:
            words = written(words, "bpe-words")
    return spark.createDataFrame(rows, "rank int, a int, b int, new_id int, cnt bigint")


def merged(symbols: list[int], a: int, b: int, new_id: int) -> list[int]:
    out: list[int] = []
    for x in symbols:
        # A merged pair can't join again: its new id is no part of a b.
        if out and out[-1] == a and x == b and new_id != a:
            out[-1] = new_id
        else:
            out.append(x)
    return out


class Learner:
    """Words, their pair counts and a queue of candidates, kept up to date merge by merge."""

    def __init__(self, words: Iterable[tuple[list[int], int]]):
        self.words = [(list(s), f) for s, f in words]
        self.count: Counter[tuple[int, int]] = Counter()
        self.where: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, (s, f) in enumerate(self.words):
            for p in zip(s, s[1:]):
                self.count[p] += f
                self.where[p].add(i)
        self.queue = [(-n, p) for p, n in self.count.items()]
        heapq.heapify(self.queue)

    def best(self) -> tuple[tuple[int, int], int] | None:
        """Entries whose count is no longer true are dropped when they come up."""
        while self.queue:
            n, p = self.queue[0]
            if self.count.get(p, 0) == -n and n:
                return p, -n
            heapq.heappop(self.queue)
        return None

    def merge(self, pair: tuple[int, int], new_id: int) -> int:
        """Applies a merge; the number of words it changed."""
        changed = Counter()
        touched = 0
        for i in self.where.pop(pair, ()):
            old, f = self.words[i]
            new = merged(old, *pair, new_id)
            if len(new) == len(old):
                continue
            touched += 1
            self.words[i] = (new, f)
            was, now = Counter(zip(old, old[1:])), Counter(zip(new, new[1:]))
            for p in was.keys() | now.keys():
                if d := (now[p] - was[p]) * f:
                    changed[p] += d
                if p in now and p not in was:
                    self.where[p].add(i)
        for p, d in changed.items():
            n = self.count[p] = self.count[p] + d
            if n > 0:
                heapq.heappush(self.queue, (-n, p))
            else:
                del self.count[p]
        if len(self.queue) > 6 * max(64, len(self.count)):
            self.queue = [(-n, p) for p, n in self.count.items()]
            heapq.heapify(self.queue)
        return touched


def target_merges(vocab_size: int, n_special: int, max_merges: int | None = None) -> int:
    return max_merges if max_merges is not None else max(0, vocab_size - BASE - n_special)


def learn(words: DataFrame, merges: int, least: int = 1, replay: list[tuple[int, int, int]] | None = None, on_merge=None, max_words: int = 3_000_000) -> list[tuple[int, int, int, int]]:
    """(a, b, new_id, count) of each merge.  words: an inventory of at most max_words rows.

    replay: merges (a, b, new_id) of an earlier run, applied first and checked: ids must follow one
    another and every merge must change a word.  on_merge(rank, a, b, new_id, count) is called
    after each new merge, for logs and snapshots.
    """
    rows = words.orderBy("word_idx").select("symbols", "freq").limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"more than {max_words} word types; cap the inventory")
    state = Learner((r["symbols"], r["freq"]) for r in rows)
    out: list[tuple[int, int, int, int]] = []
    for k, (a, b, new_id) in enumerate(replay or []):
        if new_id != BASE + k:
            raise ValueError(f"merge {k} has id {new_id}, expected {BASE + k}")
        n = state.count.get((a, b), 0)
        if not state.merge((a, b), new_id):
            raise ValueError(f"merge {k} of the log has no effect")
        out.append((a, b, new_id, n))
    while len(out) < merges:
        top = state.best()
        if top is None or top[1] < least:
            break
        (a, b), n = top
        new_id = BASE + len(out)
        state.merge((a, b), new_id)
        out.append((a, b, new_id, n))
        if on_merge:
            on_merge(len(out) - 1, a, b, new_id, n)
    return out


def token_bytes(merges: Iterable[tuple[int, int]]) -> list[bytes]:
    """Bytes of every token id, base bytes first; two tokens of the same bytes are an error."""
    out = [bytes([i]) for i in range(BASE)]
    for a, b in merges:
        out.append(out[a] + out[b])
    if len(set(out)) != len(out):
        raise ValueError("two tokens have the same bytes")
    return out


def byte_chars() -> list[str]:
    """A printable character for each byte: itself where it is printable, else the next from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(BASE)]


def vocabulary(spark: SparkSession, merges: list[tuple[int, int]], specials: list[str], placement: str = "end") -> DataFrame:
    """token_id, token, token_bytes, is_special with dense ids; specials before or after the rest."""
    if placement not in ("start", "end"):
        raise ValueError("special_tokens placement must be start or end")
    chars = byte_chars()
    plain = [("".join(chars[x] for x in t), t, False) for t in token_bytes(merges)]
    named = [(s, s.encode(), True) for s in specials]
    rows = named + plain if placement == "start" else plain + named
    names = [r[0] for r in rows]
    if len(set(names)) != len(names):
        raise ValueError("a special token has the name of another token")
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "token_id int, token string, token_bytes binary, is_special boolean")


# Candidates of each role, the first present one wins; else the first (pad: last) special.
ROLES = {"bos_token": ("<bos>", "<s>", "<|endoftext|>"), "eos_token": ("<eos>", "</s>", "<|endoftext|>"), "unk_token": ("<unk>", "<|endoftext|>"), "pad_token": ("<pad>", "<|pad|>")}


def role_map(specials: DataFrame) -> DataFrame:
    """role, token of a table (ord, token) of special tokens: a join on candidates, the first present wins."""
    spark = specials.sparkSession
    wanted = spark.createDataFrame([(r, i, c) for r, cs in ROLES.items() for i, c in enumerate(cs)], "role string, place int, token string")
    hits = wanted.join(specials, "token").groupBy("role").agg(F.min_by("token", "place").alias("token"))
    ends = specials.agg(F.min_by("token", "ord").alias("first"), F.max_by("token", "ord").alias("last"))
    roles = spark.createDataFrame([(r,) for r in ROLES], "role string").join(hits, "role", "left")
    return roles.join(F.broadcast(ends)).select("role", F.coalesce("token", F.when(F.col("role") == "pad_token", F.col("last")).otherwise(F.col("first"))).alias("token"))  # one row on either side


class Codec:
    """Encoder of one vocabulary; remembers the pieces it has met."""

    def __init__(self, merges: list[tuple[int, int]], ids: list[int] | None = None, unk: int | None = None):
        self.rank = {tuple(p): k for k, p in enumerate(merges)}
        self.ids, self.unk, self.seen = ids, unk, {}

    def piece(self, data: bytes) -> list[int]:
        if (known := self.seen.get(data)) is not None:
            return known
        symbols = list(data)
        while len(symbols) > 1:
            k = min((self.rank.get(p, 1 << 60) for p in zip(symbols, symbols[1:])), default=1 << 60)
            if k == 1 << 60:
                break
            a, b = next(p for p in zip(symbols, symbols[1:]) if self.rank.get(p) == k)
            symbols = merged(symbols, a, b, BASE + k)
        if self.ids is not None:
            out = []
            for s in symbols:
                t = self.ids[s] if s < len(self.ids) and self.ids[s] is not None else self.unk
                if t is None:
                    raise KeyError(f"no token for symbol {s}")
                out.append(t)
            symbols = out
        if len(self.seen) < 200_000:
            self.seen[data] = symbols
        return symbols


def encode_lists(batch: pa.Array, codec: Codec) -> pa.Array:
    """Token ids of lists of pieces; each distinct piece of the batch is encoded once."""
    offsets = np.zeros(len(batch) + 1, np.int64)
    np.cumsum(pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False), out=offsets[1:])
    kinds = batch.flatten().dictionary_encode()
    coded = [codec.piece(p.encode()) for p in kinds.dictionary.to_pylist()]
    sizes = np.array([len(c) for c in coded], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
    flat = np.array([t for c in coded for t in c], np.int32)
    at = kinds.indices.to_numpy(zero_copy_only=False)
    n = sizes[at]
    ends = np.concatenate([[0], np.cumsum(n)])
    take = np.arange(ends[-1]) - np.repeat(ends[:-1] - begin[at], n)
    lists = ends[offsets].astype(np.int32)
    out = pa.ListArray.from_arrays(pa.array(lists), pa.array(flat[take] if len(flat) else flat))
    return out if batch.null_count == 0 else pc.if_else(batch.is_valid(), out, pa.nulls(len(out), out.type))


_codecs: dict[str, Codec] = {}


def codec_of(key: str, make) -> Codec:
    """The codec of a vocabulary, made once in each worker and kept with the pieces it has met."""
    if key not in _codecs:
        _codecs.clear()  # one vocabulary at a time
        _codecs[key] = Codec(*make())
    return _codecs[key]


def encode(df: DataFrame, merges: list[tuple[int, int]], pattern: str, text: str = "text", into: str = "tokens", ids: list[int] | None = None, unk: int | None = None) -> DataFrame:
    """Token ids of every text: pieces on the JVM, merges per distinct piece in an Arrow batch function.

    No normalisation, and special tokens' names are ordinary text.  The merges are broadcast; a
    vocabulary is bounded by its configured size.
    """
    shared = df.sparkSession.sparkContext.broadcast((list(merges), ids, unk))
    key = hashlib.sha256(repr((list(merges), ids, unk)).encode()).hexdigest()

    @F.arrow_udf("array<int>")
    def run(batch: pa.Array) -> pa.Array:
        return encode_lists(batch, codec_of(key, lambda: shared.value))

    return df.withColumn(into, run(T.pieces(F.col(text), pattern)))


def joined_bytes(lists: pa.Array, starts: np.ndarray, data: np.ndarray) -> list[bytes | None]:
    """For each list of token ids the bytes of its tokens, one after another; token t is data[starts[t]:starts[t + 1]].

    A whole batch is gathered at once; an id the table doesn't have is an error.
    """
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(starts) - 1):
        raise KeyError(f"no token {int(ids.min() if ids.min() < 0 else ids.max())} in the vocabulary")
    size = starts[ids + 1] - starts[ids]
    ends = np.concatenate([[0], np.cumsum(size)])
    flat = data[np.arange(ends[-1]) - np.repeat(ends[:-1] - starts[ids], size)].tobytes()
    at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
    cut = ends[at].tolist()
    known = lists.is_valid().to_pylist()
    return [flat[a:b] if ok else None for ok, a, b in zip(known, cut[:-1], cut[1:])]


def decode(df: DataFrame, vocab: DataFrame, tokens: str = "tokens", into: str = "text", skip_special: bool = False) -> DataFrame:
    """Text of token ids: the bytes of the tokens joined, bad UTF-8 replaced.

    The vocabulary, bounded by its configured size, is broadcast as one array of bytes with offsets.
    """
    rows = vocab.select("token_id", "token_bytes", "is_special").orderBy("token_id").collect()
    known = [b""] * (rows[-1]["token_id"] + 1 if rows else 0)
    for r in rows:
        known[r["token_id"]] = b"" if skip_special and r["is_special"] else bytes(r["token_bytes"])
    starts = np.concatenate([[0], np.cumsum([len(k) for k in known])]).astype(np.int64)
    shared = df.sparkSession.sparkContext.broadcast((starts, np.frombuffer(b"".join(known), np.uint8)))

    @F.arrow_udf("string")
    def run(batch: pa.Array) -> pa.Array:
        return pa.array([None if b is None else b.decode("utf-8", "replace") for b in joined_bytes(batch, *shared.value)], pa.string())

    return df.withColumn(into, run(F.col(tokens)))


def merge_ranks(spark: SparkSession, merges: list[tuple[int, int]]) -> DataFrame:
    return spark.createDataFrame([(k, a, b, BASE + k) for k, (a, b) in enumerate(merges)], "rank int, a int, b int, new_id int")


def committed(log: DataFrame) -> DataFrame:
    """merge_idx, a, b, new_id of the merges that were begun and committed, the last begin of each."""
    begun = log.where("kind = 'BEGIN'").groupBy("merge_idx").agg(F.max_by(F.struct("f1", "f2"), "line").alias("p"))
    done = log.where("kind = 'COMMIT'").groupBy("merge_idx").agg(F.max_by("f1", "line").alias("new_id"))
    return begun.join(done, "merge_idx").select("merge_idx", F.col("p.f1").alias("a"), F.col("p.f2").alias("b"), "new_id")


def gaps(commits: DataFrame) -> DataFrame:
    """Merge indices that don't follow the one before."""
    w = Window.orderBy("merge_idx")  # a log of at most the vocabulary's size
    return commits.withColumn("step", F.col("merge_idx") - F.lag("merge_idx").over(w)).where("step <> 1")
