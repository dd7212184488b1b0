"""Column functions over text: white space, bytes, hashes, pre-token pieces."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that Python's str.split() knows, as a Java and RE2 character class.
WHITE = r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WHITE_RE2 = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# The two named pre-token patterns, and the forms of normalisation.
PATTERNS = {
    "gpt2_default": r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
    "gpt2_fast": r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s",
}
FORMS = ("none", "NFC", "NFD", "NFKC", "NFKD")
FLAGS = {"IGNORECASE": "i", "MULTILINE": "m"}


def collapse_white(c: Column) -> Column:
    """Runs of white space become one blank; none at the ends (null stays null)."""
    return F.btrim(F.regexp_replace(c, WHITE + "+", " "))


def normalise(c: Column, form: str = "none") -> Column:
    """Unicode normalisation; Spark has no built-in for it."""
    if form not in FORMS:
        raise ValueError(f"normalize must be one of {FORMS}, not {form!r}")
    if form == "none":
        return c

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else unicodedata.normalize(form, t))

    return run(c)


def corpus_text(c: Column, form: str = "none", collapse: bool = True) -> Column:
    """White space first, then the Unicode form, which may bring blanks back in."""
    return normalise(collapse_white(c) if collapse else c, form)


def decode_bytes(c: Column, policy: str = "replace") -> Column:
    """Binary to text: strict raises on bad bytes, replace marks them, ignore drops them."""
    if policy == "replace":
        return F.make_valid_utf8(c.cast("string"))
    if policy == "strict":
        return F.validate_utf8(c.cast("string"))
    if policy != "ignore":
        raise ValueError(f"decode_errors must be strict, replace or ignore, not {policy!r}")

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))

    return run(c)


def canonical_json(*fields: Column) -> Column:
    """Compact JSON of the fields in the order given (give them sorted), control escapes in lower case."""
    text = F.to_json(F.struct(*fields))
    for n in (0x0B, *range(0x0E, 0x20)):
        upper, lower = f"\\u{n:04X}", f"\\u{n:04x}"
        if upper != lower:
            text = F.replace(text, F.lit(upper), F.lit(lower))
    return text


def document_id(source: Column, line_no: Column, text: Column) -> Column:
    """sha256 of the canonical JSON of a document's place and text."""
    return F.sha2(canonical_json(line_no.alias("line_no"), source.alias("source"), text.alias("text")), 256)


def hash_bucket(c: Column, mod: int) -> Column:
    """First eight hex digits of sha256 as a number, modulo."""
    return F.conv(F.substring(F.sha2(c.cast("string"), 256), 1, 8), 16, 10).cast("bigint") % mod


def resolve_pattern(name: str = "gpt2_fast", custom: str | None = None, flags: tuple[str, ...] = ()) -> str:
    """The Java pattern of a named or custom pre-tokeniser, Unicode-aware."""
    unknown = [f for f in flags if f not in FLAGS]
    if unknown:
        raise ValueError(f"unknown pattern flags: {unknown}")
    if name == "custom":
        if not custom:
            raise ValueError("a custom pattern must not be empty")
        body = custom
    elif name in PATTERNS:
        body = PATTERNS[name]
    else:
        raise ValueError(f"unknown pattern {name!r}")
    return "(?Ud" + "".join(sorted({FLAGS[f] for f in flags} | ({"u"} if "IGNORECASE" in flags else set()))) + ")" + body


def pieces(c: Column, pattern: str) -> Column:
    """All matches of a resolved pattern, in order."""
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def special_alternation(specials: list[str]) -> str:
    """Pattern of the special tokens, longest first, then by text."""
    return "|".join("\\Q" + s + "\\E" for s in sorted(set(specials), key=lambda s: (-len(s), s)))


def plain_segments(c: Column, specials: list[str]) -> Column:
    """The non-empty parts between special tokens."""
    if not specials:
        return F.filter(F.array(c), lambda x: x.isNotNull() & (x != ""))
    return F.filter(F.split(c, special_alternation(specials), -1), lambda x: x != "")


def text_bytes(c: Column) -> Column:
    """UTF-8 bytes as an array of ints: the batch's buffer, widened."""

    @F.arrow_udf("array<int>")
    def run(batch: pa.Array) -> pa.Array:
        batch = pa.concat_arrays([batch.cast(pa.binary())])  # offsets from 0
        offsets = np.frombuffer(batch.buffers()[1], np.int32, len(batch) + 1) if len(batch) else np.zeros(1, np.int32)
        data = batch.buffers()[2]
        raw = np.frombuffer(data, np.uint8, int(offsets[-1])) if data and offsets[-1] else np.zeros(0, np.uint8)
        mask = batch.is_null() if batch.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(raw.astype(np.int32)), mask=mask)

    return run(c)


def bytes_text(c: Column) -> Column:
    """Text of an array of byte values, bad sequences replaced."""
    h = F.array_join(F.transform(c, lambda x: F.lpad(F.hex(x), 2, "0")), "")
    return F.make_valid_utf8(F.unhex(h).cast("string"))


def pair_id(a: Column, b: Column) -> Column:
    return F.shiftleft(a.cast("bigint"), 32).bitwiseOR(b.cast("bigint"))


def split_pair(c: Column) -> tuple[Column, Column]:
    return F.shiftright(c, 32).cast("int"), c.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


def adjacent(c: Column) -> Column:
    """Neighbouring symbols of an array as structs (a, b); overlapping ones count each."""
    n = F.size(c)
    empty = F.expr("cast(array() as array<struct<a:int,b:int>>)")
    pairs = F.zip_with(F.slice(c, 1, n - 1), F.slice(c, 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.when(n > 1, pairs).otherwise(empty)


def merge_pair(c: Column, a: int, b: int, new_id: int) -> Column:
    """Left to right, without overlap, each a b becomes new_id."""
    zero = F.struct(F.expr("cast(array() as array<int>)").alias("done"), F.lit(None).cast("int").alias("held"))

    def step(acc: Column, x: Column) -> Column:
        hit = (acc["held"] == a) & (x == b)
        flushed = F.when(acc["held"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["held"])))
        return F.when(F.coalesce(hit, F.lit(False)), F.struct(F.concat(acc["done"], F.array(F.lit(new_id))).alias("done"), F.lit(None).cast("int").alias("held"))).otherwise(F.struct(flushed.alias("done"), x.alias("held")))

    return F.aggregate(c, zero, step, lambda acc: F.when(acc["held"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["held"]))))


def checked_ids(c: Column, dtype: str) -> Column:
    """Token ids if all fit the width, else an error."""
    top = {"uint16": 0xFFFF, "uint32": 0xFFFFFFFF}.get(dtype)
    if top is None:
        raise ValueError("token_dtype must be uint16 or uint32")
    bad = F.exists(c, lambda x: (x < 0) | (x.cast("bigint") > top))
    return F.when(bad, F.raise_error(F.lit(f"token id out of {dtype}")).cast("array<int>")).otherwise(c)


def storage_width(most_merges: int) -> str:
    """Width that holds all ids of a vocabulary of 256 bytes and so many merges."""
    return "uint16" if 255 + most_merges < 65536 else "uint32"


def prompt(instruction: Column, output: Column) -> Column:
    """Instruction template of the fine-tuning stage."""
    return F.concat(F.lit("### Instruction:\n"), instruction, F.lit("\n\n### Response:\n"), output, F.lit("\n"))


def warm_up(step: Column, steps: int) -> Column:
    return F.least((step + 1) / F.greatest(F.lit(1), F.lit(steps)), F.lit(1.0))
