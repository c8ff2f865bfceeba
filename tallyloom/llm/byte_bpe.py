"""Byte-level BPE by a local rank file, with the tiktoken library: whole texts to ids, and ids to the bytes they stand for.

A long text is cut first, so that a step holds a bounded piece of it: only where the pattern ends a match anyway, which is
wherever white space follows something else. No branch of the pattern runs on from another character into white space, and
none looks back, so the pieces' matches are the text's matches. A text without such a place is one piece.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import HELD, STEP_BYTES, only, steps, strings

# The characters with Unicode's White_Space property.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where public_tokenizers.PATTERN never has a match across.
SAFE = rf"(?<=[^{WHITE_SPACE}])(?=[{WHITE_SPACE}])"
#: Characters after which a long text is cut at the next safe place.
PIECE_CHARS = 1 << 16


class Ranks:
    """The library's encoding of one rank file."""

    def __init__(self, path: str, pattern: str, safe: str | None):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.safe = re.compile(safe) if safe else None
        self.bytes = {b: a for a, b in ranks.items()}

    def pieces(self, text: str, chars: int = PIECE_CHARS) -> Iterator[str]:
        at = 0
        while self.safe and len(text) - at > chars:
            cut = self.safe.search(text, at + chars)
            if not cut:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def ids(self, text: str, chars: int = PIECE_CHARS) -> np.ndarray:
        parts = [np.array(self.encoding.encode_ordinary(p), np.int32) for p in self.pieces(text, chars)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


KNOWN: dict[tuple[str, str, str | None], Ranks] = {}
HELD["ranks"] = KNOWN.clear


def ranks_of(path: str, pattern: str, safe: str | None) -> Ranks:
    key = (path, pattern, safe)
    if key not in KNOWN:
        KNOWN[key] = Ranks(*key)
    return KNOWN[key]


def encode_documents(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = public_tokenizers.PATTERN, safe: str | None = SAFE) -> DataFrame:
    """(doc_id, ids): the ids of each whole text without special tokens, whose strings are ordinary text.

    `pattern` splits the text before the merges; `safe` matches the places where that pattern has no match across (None:
    texts aren't cut). Null text counts as empty, which has no ids. Repeated rows and null doc_ids are rows like others;
    an empty table gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("ranks")
        ranks = ranks_of(ranks_path, pattern, safe)
        for b in batches:
            texts = strings(b.column(1))
            for first, end, _, _ in steps(texts, STEP_BYTES):
                ids = [ranks.ids(t) for t in texts[first:end].to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0)[first:end], lists], names=["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(tokens: DataFrame, ranks_path: str, ids_col: str = "ids", columns: tuple[str, ...] = ("doc_id",), decoded_col: str = "decoded") -> DataFrame:
    """The given columns and `decoded`, the raw bytes of each list of ids, whether or not they are UTF-8.

    A null list counts as empty, which is no bytes; null ids within a list and ids without a rank stand for no bytes.
    Repeated rows and null values of other columns are kept as they are; an empty table gives an empty result.
    """
    source = tokens.select(*columns, F.col(ids_col).cast("array<int>").alias(ids_col))
    schema = source.drop(ids_col).schema.add(decoded_col, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("ranks")
        get = ranks_of(ranks_path, public_tokenizers.PATTERN, SAFE).bytes.get
        for b in batches:
            lists = b.column(len(columns))
            ids, at = lists.values.fill_null(-1).to_numpy(), lists.offsets.to_pylist()
            raw = [b"".join([get(x, b"") for x in ids[first:end].tolist()]) if there else b"" for first, end, there in zip(at, at[1:], lists.is_valid().to_pylist(), strict=False)]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(columns)], pa.array(raw, pa.binary())], names=[*columns, decoded_col])

    return source.mapInArrow(run, schema)
