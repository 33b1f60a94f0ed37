"""Secrets by patterns and by token efficiency.

Base kinds, leftmost and non-overlapping per kind, failing matches dropped without a retry: assign (a credential name, a
sign and a value of 8 characters or more), access (AKIA and 16 characters or more in all), hex (32 digits or more).
Added kind, token: a run of 20 characters or more that the vocabulary of a public byte-level tokenizer cuts into unusually
short tokens. Words and names of any language that the vocabulary knows take few tokens; random strings take many.
Known digests (hexadecimal of 32, 40, 56, 64, 96 or 128 digits), UUIDs, runs without a letter and runs of parts of at most three
characters between signs are left out; for all others, of one case or of several, the ratio decides. Of random letters of one small
case it finds nine of ten at 20 characters and more of longer ones.
A null or empty text has no spans. Rows are independent: repeated rows give repeated results, a null id stays null.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, give_back, id_and_text

KINDS = ("assign", "access", "hex", "token")
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
DIGEST = "|".join(f"[0-9a-fA-F]{{{n}}}" for n in (32, 40, 56, 64, 96, 128))
KNOWN = re.compile(rf"{DIGEST}|[0-9a-fA-F]{{8}}(?:-[0-9a-fA-F]{{4}}){{3}}-[0-9a-fA-F]{{12}}|[0-9_+/=-]+|(?:[A-Za-z0-9]{{0,3}}[_+/=-])+[A-Za-z0-9]{{0,3}}")

#: Letters whose parts between signs are words by their case. A letter of them tells less, and rare words of small languages take
#: many tokens, so the ratio must be lower by this share.
WORDS, STRICTER = re.compile(r"[_+/=-]*(?:(?:[A-Z]?[a-z]+|[A-Z]+)(?:[_+/=-]+|\Z))*"), 0.925


@lru_cache(2)
def vocabulary(path: str | None = None):
    """The tiktoken encoding of a public vocabulary file."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def find(text: str, encoding, most_ratio: float) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; code points, end exclusive."""
    out = []
    folded = text.lower()
    if any(c in folded for c in CUES):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    for m in RUN.finditer(text):
        most = most_ratio * STRICTER if WORDS.fullmatch(m[0]) else most_ratio
        if not KNOWN.fullmatch(m[0]) and len(m[0]) <= most * len(encoding.encode_ordinary(m[0])):
            out.append(("token", m.start(), m.end()))
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_ratio: float = 2.0, vocabulary_path: str | None = None) -> DataFrame:
    """One row for each row of docs: counts of the base kinds, their digest, and all spans as kind:start:end."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(vocabulary_path)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                spans = find(text, encoding, most_ratio)
                base = [x for x in spans if x[0] != "token"]
                kinds = [x[0] for x in base]
                rows.append((*(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], pa.int64() if k < 3 else pa.string()) for k in range(5))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", most_ratio: float = 2.0, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every secret's span replaced by a mark; overlapping spans count as one. Null texts stay null."""

    names = docs.columns
    at = names.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary()
        for batch in batches:
            texts = []
            for text in batch.column(at).to_pylist():
                end, parts = 0, []
                for _, a, b in find(text, encoding, most_ratio) if text else ():
                    if a >= end:
                        parts += [text[end:a], mark]
                    end = max(end, b)
                texts.append("".join((*parts, text[end:])) if parts else text)
            columns = batch.columns
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)
        del encoding
        vocabulary.cache_clear()
        give_back()

    out = docs.mapInArrow(clean, docs.schema)
    return out.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType)) if chars_col in names else out


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(documents(spark, sf_dir))
