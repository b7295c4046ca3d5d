"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

#: A place before ASCII white space and after anything that no engine counts as white space: every match of a
#: pattern whose alternatives hold white space only at their start, or only white space, ends there at the latest.
SAFE = re.compile(r"(?<=[^\s])(?=[ \n\r\t])")
PART = 50_000  # characters after which a text is split at the next safe place; it changes no id


@lru_cache(maxsize=4)
def _encoding(path: str, pattern: str) -> tuple[tiktoken.Encoding, dict[int, bytes]]:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), {v: k for k, v in ranks.items()}


def _parts(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PART and (m := SAFE.search(text, start + PART)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


def _map(path: str, pattern: str, extra: list[str], texts: bool) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, pieces = _encoding(path, pattern)
        for batch in batches:
            n, ids_hex, bytes_hex, ids_all, whole = [], [], [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                ids = np.concatenate([encoding.encode_to_numpy(x, disallowed_special=()) for x in _parts(text)]).astype("<u4")
                back = b"".join(map(pieces.__getitem__, ids.tolist()))
                n.append(len(ids))
                if texts:
                    ids_all.append(ids.astype(np.int32))
                    whole.append(back.decode("utf-8", "strict"))
                else:
                    ids_hex.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    bytes_hex.append(hashlib.sha256(back).hexdigest())
            made = [pa.array(ids_all, pa.list_(pa.int32())), pa.array(whole, pa.string())] if texts else [pa.array(ids_hex, pa.string()), pa.array(bytes_hex, pa.string())]
            names = ["ids", "decoded"] if texts else ["ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in extra), pa.array(n, pa.int64()), *made], [*extra, "n_tokens", *names])

    return encode


def byte_bpe(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids (array of int), decoded (text) of every row of docs(doc_id, text, ...).

    Each match of the pattern is encoded by itself, without special tokens. Long texts are split first where no match
    can cross, so a part's memory is bounded wherever a text has white space. Null texts count as empty and have no
    ids. Rows are mapped one to one, repeated ones too; there is no shuffle. Other columns are not read.
    """
    return docs.select("doc_id", "text").mapInArrow(_map(path, pattern, ["doc_id"], True), "doc_id long, n_tokens long, ids array<int>, decoded string")


def byte_bpe_digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """As byte_bpe, with SHA-256 of the ids (little-endian unsigned 32 bits) and of the decoded bytes in their place."""
    return docs.select("doc_id", "text").mapInArrow(_map(path, pattern, ["doc_id"], False), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
