"""Token-ID / binary output: ids packed at the fewest bits the vocabulary needs, in blocks.

A block is self-contained bytes: a header, the block's documents as offsets, and the ids, ``bits`` bits
each, least significant bit first. Offsets and the fixed width place every id, so numpy unpacks a block
at once or any document alone. Blocks are rows of a Parquet table, which any store that Spark writes can
hold, and which a lost executor leaves whole; ``write_file`` copies blocks into one flat file.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keyed
from .textkernels import KEPT, slices

MAGIC = b"CMB1"
_HEAD = struct.Struct("<4sBxxxIQ")  # magic, bits, documents, ids
#: Ids of a block, unless one document alone has more.
BLOCK_IDS = 1 << 18
#: Text bytes of a range of doc_ids that one task sorts and encodes, on average at most.
RANGE_BYTES = 128 << 20
#: Words, and parts of words, whose ids a worker remembers: some 200 bytes each.
CACHE_WORDS, CACHE_PARTS = 1_200_000, 600_000
#: Parts that go to the tokenizer's model as one text: in longer ones each costs more.
PARTS_AT_ONCE = 100


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold the ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, count: int, first: int = 0) -> np.ndarray:
    """Ids ``first`` to ``first + count - 1`` of packed data."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, dtype=f"<u{bits // 8}", count=count, offset=first * bits // 8).astype("<u4")
    low = first * bits
    raw = np.frombuffer(data, dtype=np.uint8)[low // 8 : (low + count * bits + 7) // 8]
    flat = np.unpackbits(raw, bitorder="little")[low % 8 : low % 8 + count * bits].reshape(count, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


def make_block(documents: Iterable[np.ndarray], bits: int) -> bytes:
    documents = list(documents)
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype("<u8")
    ids = np.concatenate(documents) if documents else np.zeros(0, np.uint32)
    return _HEAD.pack(MAGIC, bits, len(documents), len(ids)) + offsets.tobytes() + pack(ids, bits)


class Block:
    """A block read in place: ``block[i]`` unpacks document i alone, ``block.ids()`` all."""

    def __init__(self, data: bytes | memoryview) -> None:
        magic, self.bits, self.documents, self.count = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token block")
        view = memoryview(data)
        self.offsets = np.frombuffer(view, dtype="<u8", count=self.documents + 1, offset=_HEAD.size).astype(np.int64)
        self.packed = view[_HEAD.size + 8 * (self.documents + 1) :]

    def __getitem__(self, i: int) -> np.ndarray:
        return unpack(self.packed, self.bits, int(self.offsets[i + 1] - self.offsets[i]), int(self.offsets[i]))

    def ids(self) -> np.ndarray:
        return unpack(self.packed, self.bits, self.count)


# The parts of a tokenizer file under which a text's ids are those of its words' parts.
_WORD_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: What words have whose lower-casing, normal form or cuts are not plain; and the parts of plain ones.
_OTHER = re.compile("[^\n!-&(-~À-ÖØ-öø-ÿ]")
_PARTS = re.compile("[a-zß-öø-ÿ]+|[0-9]|\n|[^\na-zß-öø-ÿ0-9]+")
#: Stands for the end of a word among parts; no id has this value.
_BREAK = b"\xff\xff\xff\xff"


def _byte_characters() -> dict[int, str]:
    """For À to ÿ: the characters that byte-level BPE writes for their UTF-8 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    return {c: "".join(of[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordCachedEncoder:
    """``tokenizers`` encoding of texts that remembers words.

    For a tokenizer file that lower-cases and splits as ``_WORD_SPLIT`` does, no token crosses ASCII
    white space, so the ids of a text are the ids of its words. A plain word is cut as the tokenizer
    would cut it and its parts go to the tokenizer's model; other words (apostrophes, special tokens,
    letters beyond Latin-1) go through the whole tokenizer. Other tokenizer files encode whole texts.
    """

    def __init__(self, path: str, special_as_text: bool = False) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        steps = (said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split = steps[0].get("pattern") == {"Regex": _WORD_SPLIT} and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True
        self.by_word = said.get("normalizer") == _WORD_NORMALIZER and split and [x.get("type") for x in steps] == ["Split", "ByteLevel"] and not steps[1]["add_prefix_space"] and not said.get("post_processor")
        self.by_word = self.by_word and all(set("<|") <= set(t["content"]) and not t["lstrip"] and not t["rstrip"] for t in said["added_tokens"])
        self.bytes_of = _byte_characters()
        vocabulary, suffix = self.tokenizer.get_vocab(), said["model"].get("end_of_word_suffix")
        self.by_word = self.by_word and bool(suffix)
        self.is_end = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.is_end[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.model = Tokenizer.from_file(path)  # what it gets is cut at blanks and goes to the merges as it is
        self.model.normalizer, self.model.pre_tokenizer = None, pre_tokenizers.CharDelimiterSplit(" ")
        self.parts: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _learn_parts(self, parts: list[str]) -> None:
        for at in range(0, len(parts), PARTS_AT_ONCE):
            some = parts[at : at + PARTS_AT_ONCE]
            found = self.model.encode_batch_fast([" ".join(some).translate(self.bytes_of)], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<u4")
            raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.is_end[ids]) + 4).tolist()  # the merges mark the end of each part
            self.parts.update(zip(some, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))

    def _learn(self, words: list[bytes]) -> None:
        joined = b"\n".join(words).decode()
        if _OTHER.search(joined) or "<|" in joined:
            odd = [w for w in words if _OTHER.search(t := w.decode()) or "<|" in t]
            for w in odd:
                self.words[w] = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, dtype="<u4").tobytes()
            words = list(set(words).difference(odd))
            joined = b"\n".join(words).decode()
        if not words:
            return
        cut = _PARTS.findall(joined.lower())
        parts = set(cut)
        new = parts.difference(self.parts)
        if len(self.parts) + len(new) > CACHE_PARTS:
            self.parts.clear()
            new = parts
        self._learn_parts(list(new - {"\n"}))
        self.parts["\n"] = _BREAK
        raw = b"".join(map(self.parts.__getitem__, cut))
        ends = (4 * np.flatnonzero(np.frombuffer(raw, dtype="<u4") == 0xFFFFFFFF)).tolist()
        self.words.update(zip(words, [raw[a:b] for a, b in zip([0, *[e + 4 for e in ends]], [*ends, len(raw)], strict=True)], strict=True))

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not self.by_word:
            for e in self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False):
                yield np.array(e.ids, dtype="<u4")
            return
        split = [t.split() for t in texts]
        words = set(chain.from_iterable(split))
        new = words.difference(self.words)
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
            new = words
        self._learn(list(new))
        look = self.words.__getitem__
        for found in split:
            yield np.frombuffer(b"".join(map(look, found)), dtype="<u4")


def encoder_of(path: str, special_as_text: bool) -> WordCachedEncoder:
    """One encoder, with what it remembers, for all tasks of a worker process until another operator's task."""
    key = ("encoder", path, special_as_text)
    if key not in KEPT:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        KEPT[key] = WordCachedEncoder(path, special_as_text)
    return KEPT[key]


def _encode_blocks(tokenizer: str, bits: int, end_id: int, block_ids: int, special_as_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer, special_as_text)
        end = np.array([end_id], dtype="<u4")
        part, number = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        names: list = []
        held = before = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()), pa.array([held], pa.int64()), pa.array([names], pa.list_(kind)), *[pa.array([pick((n for n in names if n is not None), default=None)], kind) for pick in (min, max)], pa.array([make_block(ids, bits)], pa.binary())],
                ["part", "block", "before", "n_ids", "doc_ids", "first_id", "last_id", "data"],
            )

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for rows in slices(batch):
                for name, encoded in zip(rows.column("doc_id").to_pylist(), encoder.encode(rows.column("text").cast(pa.binary()).to_pylist()), strict=True):
                    if ids and held + len(encoded) + 1 > block_ids:
                        yield flush()
                        ids, names, held, before, number = [], [], 0, before + held, number + 1
                    ids.append(np.append(encoded, end))
                    names.append(name)
                    held += len(encoded) + 1
        if ids:
            yield flush()

    return run


def write_token_blocks(docs: DataFrame, path: str, *, tokenizer: str, vocabulary: int, end_id: int, block_ids: int = BLOCK_IDS, special_as_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes every text's ids and an end id, in ascending doc_id order, as blocks to the table ``path``.

    Scale: texts are dealt by ranges of doc_id, one shuffle, to as many ranges as ``RANGE_BYTES`` of text need
    (``spark.sql.shuffle.partitions`` at least); each task sorts its range, encodes and packs it block by
    block, and holds one block at a time.

    Edge cases: null texts are empty and have the end id alone. Rows without doc_id come first; rows
    that repeat a doc_id are ordered by the hash of their text and all written. A very long text is a
    block of its own. Other columns are ignored; an empty table gives no blocks.
    """
    base = keyed(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    size = base.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    ordered = base.repartitionByRange(parts, "doc_id", "body").sortWithinPartitions("doc_id", "body").select("doc_id", "text")
    ordered.mapInArrow(_encode_blocks(tokenizer, bits_for(vocabulary), end_id, block_ids, special_as_text), f"part int, block int, before long, n_ids long, doc_ids array<{kind}>, first_id {kind}, last_id {kind}, data binary").write.parquet(path)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            block = Block(batch.column("data")[i].as_buffer())
            ids = memoryview(block.ids().astype("<u4").tobytes())
            at = block.offsets
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_ids")[i].values, pa.array(at[:-1] + batch.column("base")[i].as_py()), pa.array(np.diff(at)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the written blocks: doc_id, start (ids before it), n_tokens, ids_crc32.

    A part's base is the sum of the parts before it, of which there are as many as the write had tasks
    (two numbers for each 128 MB of text, some 16 MB at 100 TB, so they are broadcast);
    within its part each block knows how many ids stand before it. So blocks aren't shuffled.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("sum"))
    bases = parts.select("part", (F.sum("sum").over(Window.orderBy("part")) - F.col("sum")).alias("base"))
    placed = blocks.join(F.broadcast(bases), "part").select("doc_ids", "data", (F.col("base") + F.col("before")).alias("base"))
    return placed.mapInArrow(_digest_rows, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def read_document(spark: SparkSession, path: str, doc_id: object) -> list[np.ndarray]:
    """The ids of each row of ``doc_id``. Blocks are in ascending ids, so the limits that each states leave one or two to be read."""
    found = spark.read.parquet(path).where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).orderBy("part", "block").select("doc_ids", "data")
    return [Block(r["data"])[i] for r in found.toLocalIterator() for i, name in enumerate(r["doc_ids"]) if name == doc_id]


def write_file(blocks: DataFrame, path: str) -> None:
    """Copies blocks in order to one file of any store that Spark writes, with ``path``.idx holding each block's place (u64).

    One file has one writer: the blocks pass through the driver, a partition at a time.
    """
    spark = blocks.sparkSession
    to = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs, index, at = to.getFileSystem(spark._jsc.hadoopConfiguration()), [0], 0
    out = fs.create(to, True)
    for row in blocks.orderBy("part", "block").select("data").toLocalIterator():
        out.write(row["data"])
        at += len(row["data"])
        index.append(at)
    out.close()
    places = fs.create(to.suffix(".idx"), True)
    places.write(bytearray(np.array(index, dtype="<u8").tobytes()))
    places.close()
