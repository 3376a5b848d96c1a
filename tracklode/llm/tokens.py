"""Token counts from prefix tables (op 3) and byte-level BPE encoding and decoding (op 6), over DataFrames.

Narrow maps: no shuffle, nothing broadcast; each worker reads the vocabulary by its path. Null texts count as
empty; empty texts have no tokens. Other columns of the input are kept where stated and never clash, since
each operator selects what it reads by name and returns its own columns.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklode.llm.bpe import vocabulary
from tracklode.llm.common import map_rows


def _text(col: str):
    return F.coalesce(F.col(col), F.lit("")).alias("text")


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", memo: float = 1.0) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    The counts are the last entries of prefix tables: of each piece, and by sums of each text. Repeated rows
    give repeated rows; a null id stays null. ``memo`` scales the words a worker remembers: about 100 MB at 1, and faster
    beyond where workers have the memory.
    """

    def kernel():
        v = vocabulary(vocabulary_path)
        v.word_counts.share = memo

        def rows(ids, texts):
            for i, text in zip(ids, texts):
                n = v.count(text)
                yield i, len(text.encode()), n, n > limit

        return rows

    picked = docs.select(F.col(id_col).alias("doc_id"), _text(text_col))
    return map_rows(picked, ["doc_id", "text"], "doc_id long, n_bytes long, n_tokens long, over_limit boolean", kernel, "bpe")


def prefix_tables(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, counts``: exact token counts of the text's first 0, 1, 2, ... characters."""

    def kernel():
        v = vocabulary(vocabulary_path)
        return lambda ids, texts: ((i, t, v.prefix_counts(t)) for i, t in zip(ids, texts))

    picked = docs.select(F.col(id_col).alias("doc_id"), _text(text_col))
    return map_rows(picked, ["doc_id", "text"], "doc_id long, text string, counts array<int>", kernel, "bpe")


def truncate(tables: DataFrame, budget: int) -> DataFrame:
    """Adds ``fits``, the longest prefix of at most ``budget`` tokens, and its ``fit_tokens``; encodes nothing.

    Counts can fall when a character is added, so the last entry within the budget counts.
    """
    at = F.size("counts") - F.array_position(F.reverse(F.transform("counts", lambda n: n <= budget)), True)
    return tables.withColumns({"fits": F.substring("text", F.lit(1), at.cast("int")), "fit_tokens": F.element_at("counts", (at + 1).cast("int"))})


def encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every whole text as ordinary text, exactly as merging by rank would give them."""

    def kernel():
        v = vocabulary(vocabulary_path)
        return lambda ids, texts: ((i, v.encode(t)) for i, t in zip(ids, texts))

    picked = docs.select(F.col(id_col).alias("doc_id"), _text(text_col))
    return map_rows(picked, ["doc_id", "text"], "doc_id long, ids array<int>", kernel, "bpe")


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, data``: the bytes of ``ids``. Ids outside the vocabulary raise; null ids give empty bytes."""

    def kernel():
        v = vocabulary(vocabulary_path)
        return lambda ids, tokens: ((i, v.decode(t or [])) for i, t in zip(ids, tokens))

    return map_rows(encoded, ["doc_id", "ids"], "doc_id long, data binary", kernel, "bpe")


def digests(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one pass and returns digests of both: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""

    def kernel():
        v = vocabulary(vocabulary_path)

        def rows(ids, texts):
            for i, text in zip(ids, texts):
                got = v.encode(text)
                joined = " ".join(map(v.names.__getitem__, got))
                yield i, len(got), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(v.decode(got)).hexdigest()

        return rows

    picked = docs.select(F.col(id_col).alias("doc_id"), _text(text_col))
    return map_rows(picked, ["doc_id", "text"], "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", kernel, "bpe")
