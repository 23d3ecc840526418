"""Token ids in compressed binary files: documents in id order, each shard with a Re-Pair grammar.

Texts are dealt by ranges of doc_id, so the files in their order hold the corpus in id order. A task
encodes its documents and writes one file of shards; a shard has its rules with their expansion
lengths, an index of its documents and the symbols, and decodes on its own. Files that count are
listed in a manifest after the job, so lost or doubled tasks leave nothing that is read.

File: shards one after the other, then a JSON footer with their places, then its length in 8 bytes.
Shard: 5 little-endian 64-bit numbers (vocabulary, rules, documents, symbols, bytes of a symbol), then
rules as pairs of 32-bit symbols, expansion lengths (32 bits), and of each document its id (64 bits),
whether it has one (8 bits), its tokens and its symbols (32 bits each), then all symbols.
"""

from __future__ import annotations

import ctypes
import json
import re
import sys
import uuid
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from waybill.llm import files
from waybill.llm.common import qualified
from waybill.llm.hashing import RUN_BYTES, hash_spans
from waybill.llm.repair import Decoder, compress, expansion_lengths, ranges

#: The tokenizer file and the id after each document.
TOKENIZER, END_ID = "byte_bpe_50k.json", 2
#: Tokens of a shard (one document at least), bytes of texts encoded at once (one text at least), chunks
#: kept with their ids, and new chunks encoded together.
SHARD_TOKENS, ENCODE_BYTES, KEPT_CHUNKS, LINES_AT_ONCE = 1 << 20, 2 << 20, 1 << 20, 512
#: Files are read in bins of about this many bytes.
READ_BYTES = 32 << 20

_byte = np.arange(256)
_LETTER = ((_byte | 0x20) >= 0x61) & ((_byte | 0x20) <= 0x7A) & (_byte < 0x80)
_CLOSING = np.isin(_byte, list(b".,;:!?)]}|*$%&#\"-"))
_BLANK = ((_byte >= 0x09) & (_byte <= 0x0D)) | ((_byte >= 0x1C) & (_byte <= 0x20))
#: White space from U+0080 on, in UTF-8.
_WIDE_BLANKS = [chr(x).encode() for x in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_SINGLE_BLANK = re.compile(r"(?<=\S) (?=\S)")


def tokenizer_path(name: str) -> str:
    """A path as it is, or the place of a public tokenizer's file."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts, as the tokenizer gives them, with the ids of recurring chunks kept.

    A byte-level pre-tokenizer always parts a text before a single space between other characters,
    around a single line feed and between an ASCII letter and closing punctuation, so chunks between
    those are encoded on their own and the results joined; new chunks go through the tokenizer together,
    as one text that parts between them, and their ids are told apart by the bytes that tokens stand for.
    Equal chunks are found by 64-bit hash. When too many are kept, those that did not come again are
    dropped. Texts with two white-space characters in a row are cut at single spaces only; texts with a
    special token's string in them, and all texts of other tokenizers, are encoded as a whole.
    """

    def __init__(self, name: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        parts = json.loads(self.tokenizer.to_str())
        splits, model = parts["pre_tokenizer"] or {}, parts["model"]
        tokens = self.tokenizer.get_vocab(with_added_tokens=False)
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.by_chunks = (
            parts["normalizer"] is None
            and splits.get("type") == "ByteLevel"
            and splits.get("use_regex", False)
            and not splits.get("add_prefix_space", True)
            and len(line) == 1
            and tokens.keys() >= set(ByteLevel.alphabet())
            and not model.get("continuing_subword_prefix")
            and not model.get("end_of_word_suffix")
        )
        self.line = line[0] if line else None
        # A byte-level token has a character for each byte that it stands for.
        self.widths = np.zeros(self.vocabulary, dtype=np.int64)
        self.widths[list(tokens.values())] = [len(token) for token in tokens]
        # Kept: hashes in order, where the ids of each chunk are in `ids`, and whether it came again.
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.places = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.again = np.zeros(0, dtype=bool)
        self.ids = np.zeros(0, dtype="<u4")

    def _drop(self) -> None:
        """Keep the chunks that came again, and see which of them still do."""
        self.ids = self.ids[ranges(self.places[self.again], self.sizes[self.again])]
        self.hashes, self.sizes = self.hashes[self.again], self.sizes[self.again]
        self.places = np.cumsum(self.sizes) - self.sizes
        self.again = np.zeros(len(self.hashes), dtype=bool)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype="<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of(self, chunks: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many) of chunks of `lengths` bytes, one after the other."""
        plain = np.zeros(len(chunks), dtype=bool)
        for k, chunk in enumerate(chunks):
            bare = chunk[1:] if chunk[:1] == " " else chunk
            plain[k] = bare.split() == [bare]
        sizes, order, parts = np.zeros(len(chunks), dtype=np.int64), [], []
        lines = np.flatnonzero(plain)
        for row in range(0, len(lines), LINES_AT_ONCE):
            part = lines[row : row + LINES_AT_ONCE]
            some = [chunks[k] for k in part.tolist()]
            ids = self._encode(["".join([chunk if chunk[0] == " " else "\n" + chunk for chunk in some])])[0]
            ids = ids[ids != self.line]
            last = np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum(lengths[part]))
            sizes[part] = np.diff(last, prepend=-1)
            parts.append(ids)
            order.append(part)
        rest = np.flatnonzero(~plain)
        for k, ids in zip(rest.tolist(), self._encode([chunks[k] for k in rest.tolist()]), strict=True):
            sizes[k] = len(ids)
            parts.append(ids)
        order = np.concatenate([*order, rest]).astype(np.int64)
        flat = np.concatenate([*parts, np.zeros(0, dtype="<u4")])
        begins = np.zeros(len(chunks), dtype=np.int64)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        return flat[ranges(begins, sizes)], sizes

    def _kept(self, hashes: np.ndarray, chunks) -> np.ndarray:
        """Places in `hashes` kept of distinct `hashes` in order; `chunks` gives texts and bytes of some of them."""
        at = np.searchsorted(self.hashes, hashes)
        old = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self.hashes)
        old[inside] = self.hashes[at[inside]] == hashes[inside]
        self.again[at[old]] = True
        if len(self.hashes) + len(hashes) - old.sum() > KEPT_CHUNKS:
            self._drop()
        new = np.flatnonzero(~old)
        if len(new):
            ids, sizes = self._ids_of(*chunks(new))
            put = np.searchsorted(self.hashes, hashes[new])
            self.places = np.insert(self.places, put, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes = np.insert(self.sizes, put, sizes)
            self.again = np.insert(self.again, put, False)
            self.hashes = np.insert(self.hashes, put, hashes[new])
            self.ids = np.concatenate([self.ids, ids])
        return np.searchsorted(self.hashes, hashes)

    def _joined(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, of_text: np.ndarray, texts: int) -> list[bytes]:
        """Ids of texts from their chunks, byte ranges of `raw` in order."""
        cuts = np.append(np.flatnonzero(np.diff(starts // RUN_BYTES, prepend=-1)), len(starts))
        hashes = [hash_spans(raw, starts[i:j], ends[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        # Numbers go by first appearance.
        which, hashes = pd.factorize(np.concatenate(hashes))
        first = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
        order = np.argsort(hashes)
        data = raw.tobytes()

        def chunks(some: np.ndarray) -> tuple[list[str], np.ndarray]:
            begin, end = starts[first[order[some]]], ends[first[order[some]]]
            return [data[i:j].decode() for i, j in zip(begin.tolist(), end.tolist(), strict=True)], end - begin

        at = np.zeros(len(hashes), dtype=np.int64)
        at[order] = self._kept(hashes[order], chunks)
        sizes = self.sizes[at][which]
        flat = self.ids[ranges(self.places[at][which], sizes)].tobytes()
        counts = np.bincount(of_text, weights=sizes, minlength=texts).astype(np.int64)
        ends_of = [0, *(4 * np.cumsum(counts)).tolist()]
        return [flat[i:j] for i, j in zip(ends_of[:-1], ends_of[1:], strict=True)]

    def _by_bytes(self, raw: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """Ids of non-empty texts without two blanks in a row."""
        opens = (raw == 0x20) | (raw == 0x0A)
        opens[1:] |= raw[:-1] == 0x0A
        opens[1:] |= _CLOSING[raw[1:]] & _LETTER[raw[:-1]]
        opens[begins[:-1]] = True
        starts = np.flatnonzero(opens)
        of_text = np.searchsorted(begins, starts, side="right") - 1
        return self._joined(raw, starts, np.append(starts[1:], len(raw)), of_text, len(begins) - 1)

    def _by_spaces(self, texts: list[str]) -> list[bytes]:
        """Ids of any non-empty texts without special tokens."""
        chunks, counts = [], []
        for text in texts:
            first, *rest = _SINGLE_BLANK.split(text)
            chunks += [first.encode(), *[b" " + chunk.encode() for chunk in rest]]
            counts.append(1 + len(rest))
        ends = np.cumsum([len(chunk) for chunk in chunks])
        raw = np.frombuffer(b"".join(chunks), dtype=np.uint8)
        starts = np.concatenate([[0], ends[:-1]])
        return self._joined(raw, starts, ends, np.repeat(np.arange(len(texts)), counts), len(texts))

    def _kinds(self, raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which texts hold a special token's string, and which two blanks in a row (or blanks beyond ASCII)."""
        special, blanks = np.zeros(len(begins) - 1, dtype=bool), np.zeros(len(begins) - 1, dtype=bool)
        of = lambda at: np.searchsorted(begins, at, side="right") - 1
        data = raw.tobytes()
        for token in self.special:
            at = data.find(token)
            while at >= 0:
                text = int(of(at))
                special[text] |= at + len(token) <= begins[text + 1]
                at = data.find(token, at + 1)
        blank = _BLANK[raw]
        double = np.flatnonzero(blank[1:] & blank[:-1])
        blanks[of(double)[of(double) == of(double + 1)]] = True
        held = {prefix for prefix in {wide[:2] for wide in _WIDE_BLANKS} if data.find(prefix) >= 0}
        for wide in (wide for wide in _WIDE_BLANKS if wide[:2] in held):
            at = data.find(wide)
            while at >= 0:
                text = int(of(at))
                blanks[text] = True
                at = data.find(wide, int(begins[text + 1]))
        return special, blanks

    def encode(self, texts: list[str]) -> list[bytes]:
        """32-bit little-endian ids of each text."""
        return [ids for part in self.encode_column(pa.array(texts, type=pa.large_string())) for ids in part]

    def encode_column(self, column: pa.Array) -> Iterator[list[bytes]]:
        """The same of a column of texts, null as empty, for ENCODE_BYTES at a time."""
        column = column.cast(pa.large_string()).fill_null("")
        if not len(column):
            return
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset :][: len(column) + 1]
        data = column.buffers()[2]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        row = 0
        while row < len(column):
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + ENCODE_BYTES, side="right")) - 1)
            end = min(end, len(column))
            yield self._group(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
            row = end

    def _group(self, raw: np.ndarray, begins: np.ndarray) -> list[bytes]:
        out: list[bytes] = [b""] * (len(begins) - 1)
        text = lambda k: raw[begins[k] : begins[k + 1]].tobytes().decode()
        full = np.diff(begins) > 0
        if self.by_chunks:
            special, blanks = self._kinds(raw, begins)
        else:
            special, blanks = full, np.zeros(len(full), dtype=bool)
        whole, spaced = np.flatnonzero(full & special).tolist(), np.flatnonzero(full & blanks & ~special).tolist()
        regular = np.flatnonzero(full & ~blanks & ~special)
        for k, ids in zip(whole, self._encode([text(k) for k in whole]), strict=True):
            out[k] = ids.tobytes()
        if spaced:
            for k, ids in zip(spaced, self._by_spaces([text(k) for k in spaced]), strict=True):
                out[k] = ids
        if len(regular):
            lengths = np.diff(begins)[regular]
            own = raw if lengths.sum() == len(raw) else raw[ranges(begins[regular], lengths)]
            edges = np.concatenate([[0], np.cumsum(lengths)])
            for k, ids in zip(regular.tolist(), self._by_bytes(own, edges), strict=True):
                out[k] = ids
        return out


def process_encoder(name: str) -> Encoder:
    """One encoder per worker process, with what it keeps; workers live on from task to task.

    Workers import this module anew for each task, so a global of it would start empty every time.
    """
    kept = sys.modules.setdefault("_waybill_encoders", ModuleType("_waybill_encoders")).__dict__
    if name not in kept:
        kept[name] = Encoder(name)
    return kept[name]


def _release() -> None:
    """Give freed memory back to the system, as workers stay for the tasks of other stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        getattr(ctypes.CDLL(None), "malloc_trim", bool)(0)


def _pack(ids: list[int | None], tokens: list[bytes], vocabulary: int) -> bytes:
    """One shard of documents with their ids, end ids included."""
    flat = np.frombuffer(b"".join(tokens), dtype="<u4")
    counts = np.array([len(t) // 4 for t in tokens], dtype=np.int64)
    firsts = np.zeros(len(flat), dtype=bool)
    firsts[np.cumsum(counts) - counts] = True
    room = 1 << 16 if vocabulary < 1 << 16 else 1 << 31
    symbols, firsts, rules = compress(flat, firsts, vocabulary, room)
    width = 2 if room == 1 << 16 else 4
    own = np.diff(np.append(np.flatnonzero(firsts), len(symbols)))
    head = np.array([vocabulary, len(rules), len(ids), len(symbols), width], dtype="<i8")
    return b"".join(
        [
            head.tobytes(),
            rules.astype("<u4").tobytes(),
            expansion_lengths(rules, vocabulary).astype("<u4").tobytes(),
            np.array([i or 0 for i in ids], dtype="<i8").tobytes(),
            np.array([i is not None for i in ids], dtype="u1").tobytes(),
            counts.astype("<u4").tobytes(),
            own.astype("<u4").tobytes(),
            symbols.astype(f"<u{width}").tobytes(),
        ]
    )


class Shard:
    """A packed shard; documents and token ranges decode without the rest of it."""

    def __init__(self, packed: bytes):
        vocabulary, n_rules, n_docs, n_symbols, width = np.frombuffer(packed, dtype="<i8", count=5)
        at = 40

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(packed, dtype=kind, count=int(count), offset=at)
            at += part.nbytes
            return part

        rules = take("<u4", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        lengths = take("<u4", n_rules).astype(np.int64)
        ids, known = take("<i8", n_docs), take("u1", n_docs)
        self.ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.tokens = take("<u4", n_docs).astype(np.int64)
        ends = np.cumsum(take("<u4", n_docs).astype(np.int64))
        self.ends, self.symbols = ends, take(f"<u{width}", n_symbols)
        self.decoder = Decoder(rules, lengths, int(vocabulary))

    def document(self, k: int) -> np.ndarray:
        return self.decoder.decode(self.symbols[self.ends[k - 1] if k else 0 : self.ends[k]])

    def part(self, k: int, start: int, stop: int) -> np.ndarray:
        """Tokens `start` to `stop` of document `k`."""
        own = self.symbols[self.ends[k - 1] if k else 0 : self.ends[k]]
        return self.decoder.part(own, start, min(stop, int(self.tokens[k])))

    def documents(self) -> np.ndarray:
        return self.decoder.decode(self.symbols)


class _File:
    """Writes shards as documents come, and the footer at the end."""

    def __init__(self, path: str, vocabulary: int):
        self.store, self.folder = files.open_store(path)
        self.store.create_dir(self.folder, recursive=True)
        self.name = f"{uuid.uuid4().hex}.tokens"
        self.out = self.store.open_output_stream(f"{self.folder}/{self.name}")
        self.vocabulary, self.bytes, self.shards = vocabulary, 0, []
        self.ids: list[int | None] = []
        self.texts: list[bytes] = []
        self.held = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.ids and self.held + len(ids) // 4 > SHARD_TOKENS:
            self.flush()
        self.ids.append(doc_id)
        self.texts.append(ids)
        self.held += len(ids) // 4

    def flush(self) -> None:
        if self.ids:
            packed = _pack(self.ids, self.texts, self.vocabulary)
            self.out.write(packed)
            self.shards.append([self.bytes, len(packed), len(self.ids), self.held])
            self.bytes += len(packed)
            self.ids, self.texts, self.held = [], [], 0

    def close(self) -> dict:
        self.flush()
        footer = json.dumps(self.shards).encode()
        self.out.write(footer + len(footer).to_bytes(8, "little"))
        self.out.close()
        return {
            "name": self.name,
            "bytes": self.bytes + len(footer) + 8,
            "docs": sum(shard[2] for shard in self.shards),
            "tokens": sum(shard[3] for shard in self.shards),
        }


def read_shards(store, path: str, size: int) -> Iterator[Shard]:
    with store.open_input_file(path) as source:
        source.seek(size - 8)
        length = int.from_bytes(source.read(8), "little")
        source.seek(size - 8 - length)
        for begin, bytes_of, _, _ in json.loads(source.read(length)):
            source.seek(begin)
            yield Shard(source.read(bytes_of))


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Encode every document and write the files and their manifest under `path`; runs a job.

    A null or empty text is the end id alone. Documents without an id come first; repeated ids are
    all written, in order of their texts' hashes. The driver gets one short row per file.
    """
    path = qualified(docs.sparkSession, path)
    order = [F.col("doc_id").asc_nulls_first(), F.col("draw")]
    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("draw"))
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    end = int(end_id).to_bytes(4, "little")

    def filled(batches: Iterator[pa.RecordBatch]) -> dict | None:
        encoder = out = None
        for batch in batches:
            if out is None:
                encoder = process_encoder(tokenizer)
                out = _File(path, encoder.vocabulary)
            ids = iter(batch.column("doc_id").to_pylist())
            for part in encoder.encode_column(batch.column("text")):
                for encoded in part:
                    out.add(next(ids), encoded + end)
        return out and out.close() | {"part": TaskContext.get().partitionId()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = filled(batches)
        _release()
        if entry is not None:
            yield pa.RecordBatch.from_pylist([entry], schema=_ENTRY)

    kind = "name string, bytes bigint, docs bigint, tokens bigint, part bigint"
    written = sorted(dealt.mapInArrow(write, kind).collect(), key=lambda row: row.part)
    start, entries = 0, []
    for row in written:
        entries.append({"name": row.name, "bytes": row.bytes, "start": start})
        start += row.tokens
    files.publish(path, entries)


_ENTRY = pa.schema([("name", pa.string()), *[(n, pa.int64()) for n in ("bytes", "docs", "tokens", "part")]])
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


class ShardFiles(InputPartition):
    def __init__(self, entries: list[dict]):
        self.entries = entries


class TokenReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        return [ShardFiles(group) for group in files.binned(files.published(self.path), READ_BYTES)]

    def read(self, partition):
        if partition is None:
            return
        store, folder = files.open_store(self.path)
        for entry in partition.entries:
            start = entry["start"]
            for shard in read_shards(store, f"{folder}/{entry['name']}", entry["bytes"]):
                ids = shard.documents().astype("<u4")
                ends = np.cumsum(shard.tokens)
                begins = ends - shard.tokens
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.ids, type=pa.int64()),
                        pa.array(start + begins),
                        pa.array(shard.tokens),
                        pa.array([ids[a:b].tobytes() for a, b in zip(begins, ends, strict=True)], type=pa.binary()),
                    ],
                    schema=_READ,
                )
                start += int(ends[-1])
        _release()


class TokenSource(DataSource):
    """`spark.read.format("token_shards").load(folder)`: a row per document, in the files' order."""

    @classmethod
    def name(cls):
        return "token_shards"

    def schema(self):
        return "doc_id bigint, start bigint, n_tokens bigint, ids binary"

    def reader(self, schema):
        return TokenReader(self.options)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids (32-bit little-endian)."""
    spark.dataSource.register(TokenSource)
    return spark.read.format("token_shards").load(qualified(spark, path))


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids of what `read_tokens` returns."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
