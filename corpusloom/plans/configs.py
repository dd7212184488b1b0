"""Default configurations of the stages, and the checks of the tokenizer's."""

from __future__ import annotations

from ..functions.text import FORMS

# The special tokens a vocabulary has by default.
SPECIALS = ["<|endoftext|>", "</s>", "<eos>", "<s>", "<bos>", "<pad>", "<unk>", "<|system|>", "<|user|>", "<|assistant|>", "<|im_start|>", "<|im_end|>", "<|endofmessage|>", "<|sep|>", "<|summarize|>", "<|translate|>", "<|code|>", "<mask>", "<fim_prefix>", "<fim_middle>", "<fim_suffix>", "<|title|>", "<|url|>", "<|date|>", "<|tool|>", "<|function_call|>"]

# The settings each stage has by default.
CORPUS = {"artifacts_root": "artifacts", "run": {"output_dir": "artifacts/runs/corpus"}, "artifact": {"id": None}, "data": {"input_paths": [], "input_format": "text", "jsonl_text_field": "text", "decode_errors": "replace", "normalize": "none", "collapse_whitespace": True, "min_chars": 20, "max_docs": None}}
DEDUP = {"artifacts_root": "artifacts", "run": {"output_dir": "artifacts/runs/dedup"}, "artifact": {"id": None}, "input": {"corpus_id": None}}
TOKENIZER = {
    "artifacts_root": "artifacts",
    "run": {"output_dir": "artifacts/runs/tokenizer"},
    "artifact": {"id": None},
    "data": {"input_paths": [], "input_format": "text", "jsonl_text_field": "text", "decode_errors": "replace", "normalize": "none", "max_bytes": None, "max_lines": None, "min_piece_freq": 2, "max_unique_pieces": 3_500_000},
    "pretokenizer": {"pattern": "gpt2_fast", "custom_pattern": None, "flags": []},
    "bpe": {"vocab_size": 64_000, "min_merge_freq": 2, "max_merges": None, "max_word_types": 3_000_000, "max_piece_bytes": 200, "tie_break": "lexicographic"},
    "special_tokens": {"tokens": SPECIALS, "placement": "end"},
    "checkpointing": {"wal_fsync_every_commits": 250, "snapshot_every_merges": 2000, "keep_last_snapshots": 3},
}
TOKENS = {"artifacts_root": "artifacts", "run": {"output_dir": "artifacts/runs/tokens"}, "input": {"corpus_id": None, "tokenizer_id": None}, "output": {"artifact_id": None, "token_dtype": "uint16", "docs_per_shard": 10_000, "append_eos": True}}
PACKED = {"artifacts_root": "artifacts", "run": {"output_dir": "artifacts/runs/packed"}, "input": {"tokens_id": None}, "output": {"artifact_id": None, "seq_len": 1024, "split_mod": 1000, "val_remainder": 0}}


def check_corpus(cfg: dict) -> None:
    data = cfg["data"]
    if data["normalize"] not in FORMS:
        raise ValueError(f"data.normalize: {data['normalize']!r} is none of {', '.join(FORMS)}")
    _common(data)


def _common(data: dict) -> None:
    if data["input_format"] not in ("text", "jsonl"):
        raise ValueError("data.input_format: only text and jsonl can be read")
    if data["decode_errors"] not in ("strict", "replace", "ignore"):
        raise ValueError("data.decode_errors: strict, replace and ignore are the ways to treat bad bytes")
    if not data["input_paths"]:
        raise ValueError("data.input_paths names no input")


def check_tokenizer(cfg: dict) -> None:
    data, bpe = cfg["data"], cfg["bpe"]
    _common(data)
    if data["normalize"] not in ("none", "NFC", "NFKC"):
        raise ValueError("data.normalize: a tokenizer takes none, NFC or NFKC")
    if cfg["special_tokens"]["placement"] not in ("start", "end"):
        raise ValueError("special_tokens.placement: ids of special tokens come at the start or at the end")
    if bpe["tie_break"] != "lexicographic":
        raise ValueError("bpe.tie_break: ties can only be broken lexicographically")
    for where, key, least, optional in ((data, "max_bytes", 0, True), (data, "max_lines", 0, True), (data, "max_unique_pieces", 1, True), (bpe, "vocab_size", 256, False), (bpe, "max_merges", 0, True), (bpe, "max_word_types", 1, False), (cfg["checkpointing"], "wal_fsync_every_commits", 0, False)):
        value = where.get(key)
        if value is None and optional:
            continue
        if value is None or int(value) < least:
            raise ValueError(f"{key} is {value!r}, the least is {least}")
