"""Encoding a corpus with a public byte-level tokenizer through a table of its distinct words."""
from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the tokenizer splits text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of text per block; a block has one dictionary of its words.
BLOCK_CHARS = 6_000_000


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=_ranks(path), special_tokens={})


def _split_blocks():
    schema = pa.schema([("block", pa.int64()), ("docs", pa.binary()), ("lens", pa.binary()), ("seq", pa.binary()), ("words", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex
        import zstandard

        find = regex.compile(PATTERN).findall
        number = count(TaskContext.get().partitionId() << 32)
        pack = zstandard.ZstdCompressor(level=1).compress
        docs: list[int] = []
        lens: list[int] = []
        seqs: list[np.ndarray] = []
        table: dict[str, int] = {}
        size = 0

        def block() -> pa.RecordBatch:
            ids = np.array(docs, np.int64)
            seq = np.concatenate(seqs) if seqs else np.zeros(0, np.int32)
            # blocks are written before they are read, so a name need only be unique
            row = [[next(number)], [ids.tobytes()], [np.array(lens, np.int32).tobytes()], [pack(seq.tobytes())], [list(table)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(row, schema)], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = find(text) if text else []
                n = len(table)
                look = table.setdefault
                # an unseen word gets the next number; len(table) only moves on then
                seq = np.fromiter((look(w, len(table)) for w in words), np.int32, len(words))
                docs.append(doc)
                lens.append(len(words))
                seqs.append(seq)
                size += len(text or "") + (len(table) - n) * 8
                if size > BLOCK_CHARS:
                    yield block()
                    docs, lens, seqs, table, size = [], [], [], {}, 0
        if docs:
            yield block()

    return run


def _width(path: str) -> str:
    """Type code of the ids on their way: two bytes where the vocabulary allows it."""
    return "H" if max(_ranks(path).values()) < 1 << 16 else "I"


def _encode_words(path: str):
    schema = pa.schema([("word", pa.string()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, code = _ranks(path), _width(path)
        enc = _encoding(path)._core_bpe.encode_single_piece
        for batch in batches:
            words = batch.column(0)
            out = []
            for w in words.to_pylist():
                b = w.encode()
                r = ranks.get(b)
                out.append(array(code, (r,) if r is not None else enc(b)).tobytes())
            yield pa.RecordBatch.from_arrays([words, pa.array(out, pa.binary())], schema=schema)

    return run


def _join_back(path: str, counts_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        kind = np.dtype(np.uint16 if _width(path) == "H" else np.uint32)
        for batch in batches:
            for r in range(batch.num_rows):
                docs = np.frombuffer(batch.column(0)[r].as_py(), np.int64)
                lens = np.frombuffer(batch.column(1)[r].as_py(), np.int32)
                seq = np.frombuffer(unpack(batch.column(2)[r].as_py(), max_output_size=1 << 31), np.int32)
                pairs = batch.column(3)[r].values if batch.column(3)[r].is_valid else None
                n_words = int(seq.max()) + 1 if len(seq) else 0
                # dictionary of the block: for word k its ids are flat[starts[k] : starts[k] + sizes[k]]
                starts, sizes = np.zeros(n_words, np.int64), np.zeros(n_words, np.int64)
                flat = np.zeros(0, np.int32)
                if pairs is not None and n_words:
                    at = pairs.field("at").to_numpy(zero_copy_only=False)
                    ids = pairs.field("ids")
                    offsets = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
                    starts[at], sizes[at] = offsets[:-1] // kind.itemsize, np.diff(offsets) // kind.itemsize
                    flat = np.frombuffer(ids.buffers()[2], np.uint8)[: offsets[-1]].view(kind).astype(np.int32)
                ends = np.cumsum(lens)
                if counts_only:
                    total = np.concatenate([[0], np.cumsum(sizes[seq])])
                    n = total[ends] - total[ends - lens]
                    yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(n)], ["doc_id", "n_tokens"])
                    continue
                for a in range(0, len(docs), 256):
                    z = min(a + 256, len(docs))
                    lo, hi = ends[a] - lens[a], ends[z - 1]
                    part = seq[lo:hi]
                    k = sizes[part]
                    stop = np.cumsum(k)
                    gather = np.repeat(starts[part] - (stop - k), k) + np.arange(int(stop[-1]) if len(stop) else 0)
                    values = flat[gather] if len(gather) else np.zeros(0, np.int32)
                    stop = np.concatenate([[0], stop])
                    offs = np.concatenate([[0], stop[ends[a:z] - lo]]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[a:z]), pa.ListArray.from_arrays(pa.array(offs), pa.array(values, pa.int32()))], ["doc_id", "ids"]
                    )

    return run


def encode(df: DataFrame, doc: str = "doc_id", text: str = "text", ranks: str = DEFAULT_RANKS, counts_only: bool = False) -> DataFrame:
    """(doc_id, ids), or (doc_id, n_tokens) with counts_only: each text's token ids by a byte-level tokenizer, without special tokens.

    doc: an integer column; a row without an id gives none, a repeated id a row for each. A null or empty text has an empty list (0 tokens). Strings of special tokens are
    ordinary text. Whole texts; other columns are never read. ranks: the vocabulary file, readable on every executor.

    Texts are split into words once. Per block of texts the words are numbered, so that a text is a run of small numbers; the distinct
    words of all blocks are encoded once each; a join by word gives every block the ids of its words, and positions are filled from
    that. What shuffles is words per block, not occurrences: a word in every text is one row per block."""
    blocks = df.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null").mapInArrow(
        _split_blocks(), "block bigint, docs binary, lens binary, seq binary, words array<string>"
    )
    blocks = materialize(blocks, "blocks")
    words = blocks.select("block", F.posexplode("words").alias("at", "word"))
    table = words.select("word").distinct().mapInArrow(_encode_words(ranks), "word string, ids binary")
    # a word has at most one row per block, and a block has tens of thousands of words, so no word holds a large share of the rows
    per_block = words.join(table.hint("merge"), "word").groupBy("block").agg(F.collect_list(F.struct("at", "ids")).alias("pairs"))
    back = blocks.select("block", "docs", "lens", "seq").join(per_block, "block", "left").select("docs", "lens", "seq", "pairs")
    out = "doc_id bigint, n_tokens bigint" if counts_only else "doc_id bigint, ids array<int>"
    return back.mapInArrow(_join_back(ranks, counts_only), out)


def decode(encoded: DataFrame, ranks: str = DEFAULT_RANKS) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): a join of positions with the id-to-piece table (as many rows as the vocabulary), and the pieces'
    bytes put together in order; bytes that are no UTF-8 become U+FFFD. An empty list gives the empty text."""
    spark = encoded.sparkSession
    pieces = F.broadcast(spark.createDataFrame([(v, k.hex()) for k, v in _ranks(ranks).items()], "id int, piece string"))
    at = encoded.select("doc_id", F.posexplode("ids").alias("pos", "id")).join(pieces, "id")
    text = at.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "piece"))), lambda x: x["piece"]), "").alias("hex"))
    joined = encoded.select("doc_id").join(text, "doc_id", "left")
    return joined.select("doc_id", F.decode(F.unhex(F.coalesce("hex", F.lit(""))), "UTF-8").alias("text"))
