"""Hashes and identities of content. Three hashes live side by side and are never mixed: of an artifact's
bytes, of normalised content, and of text without white space."""

from __future__ import annotations

import json
import hashlib
import unicodedata
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from .canonical import canonical_json
from .text import remove_whitespace, strip

ALGORITHM, NORMALIZATION = "uuid5", "chapter-content-v1"


@F.pandas_udf(StringType())
def _nfc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def nfc(c: Column) -> Column:
    """Unicode normal form C; no SQL function has it."""
    return _nfc(c)


def sha256_text(c: Column) -> Column:
    return F.sha2(F.encode(c, "UTF-8"), 256)


def tidy_lines(c: Column) -> Column:
    """Line ends as LF, no spaces or tabs at line ends, no white space around."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"[ \t]+(?=\n|\z)", ""))


def normalize_content(c: Column) -> Column:
    return tidy_lines(nfc(c))


def content_sha256(c: Column) -> Column:
    return sha256_text(normalize_content(c))


def artifact_sha256(c: Column) -> Column:
    """Of the text as written: with a final newline."""
    return sha256_text(F.concat(c, F.lit("\n")))


def spaceless_sha256(c: Column) -> Column:
    return sha256_text(remove_whitespace(c))


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` worked out once per row, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def uuid5(namespace: str, name: Column) -> Column:
    """Name-based UUID (version 5)."""
    h = F.sha1(F.concat(F.unhex(F.lit(uuid.UUID(namespace).hex)), F.encode(name, "UTF-8")))

    def spelled(h: Column) -> Column:
        variant = F.lower(F.hex((F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F)).bitwiseOR(0x80)))
        part = lambda at, n: F.substring(h, at, n)
        return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("5"), part(14, 3)), F.concat(variant, part(19, 2)), part(21, 12))

    return once(h, spelled)


def content_key(namespace: str, category: Column, subject: Column, language: Column, checksum: Column) -> Column:
    """Null where an input is blank or the checksum is not 64 lower-case hex digits."""
    fine = (strip(category) != "") & (strip(subject) != "") & (strip(language) != "") & checksum.rlike(r"\A[a-f0-9]{64}\z")
    return F.when(fine, uuid5(namespace, F.concat_ws("|", F.lit("v1"), category, subject, language, checksum)))


def content_identity(namespace: str, category: Column, subject: Column, language: Column, text: Column, normalization: str = NORMALIZATION) -> Column:
    return once(content_sha256(text), lambda checksum: F.struct(
        F.lit(ALGORITHM).alias("algorithm"), F.lit(namespace).alias("namespace"), F.lit(1).alias("identity_contract_version"), F.lit(normalization).alias("normalization"),
        checksum.alias("normalized_content_sha256"), content_key(namespace, category, subject, language, checksum).alias("content_key"),
    ))


def identity_matches(identity: Column, expected: Column) -> Column:
    fields = ("algorithm", "namespace", "identity_contract_version", "normalization", "normalized_content_sha256", "content_key")
    same = identity.isNotNull()
    for f in fields:
        same = same & identity[f].eqNullSafe(expected[f])
    return same


def config_fingerprint(config: dict) -> str:
    """SHA-256 of the configuration as compact JSON with sorted keys."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def record_fingerprint(record: Column, kind: DataType) -> Column:
    """SHA-256 of a record (a struct of type ``kind``) as canonical JSON: ``config_fingerprint`` of the same values, for each row."""
    return sha256_text(canonical_json(record, kind))


SECRET_WORDS = ("secret", "token", "password", "credential", "access_key", "api_key", "private_key")


def redact(value: object, key: str = "", words: tuple[str, ...] = SECRET_WORDS) -> object:
    """Configuration with the values of telling keys struck out, at any depth."""
    if key and any(w in key.lower() for w in words):
        return None if value is None else "[redacted]"
    if isinstance(value, dict):
        return {k: redact(v, str(k), words) for k, v in value.items()}
    return [redact(v, "", words) for v in value] if isinstance(value, list) else value
