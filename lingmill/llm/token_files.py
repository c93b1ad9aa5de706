"""Token ids as files: frequency-ranked, byte-aligned, with the lengths kept apart.

The commonest id of the corpus is number 0, and each number takes as few of 1 to 4
bytes as it needs. The lengths of four numbers make one control byte. A block of
documents is one row of a Parquet table: the control bytes, the number bytes, and the
documents' counts. Blocks are written by Spark, so a lost executor's attempt leaves
nothing behind and any store that Spark can reach will do. The numbering is a second,
small table beside the blocks.
"""

from __future__ import annotations

import os
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from tokenizers import Tokenizer

from lingmill.llm.common import settle_compressed, slices
from lingmill.session import settle

# Ids of one block, unless one document has more.
BLOCK_IDS = 1 << 18
# Distinct words remembered by a task, and scan partitions that share one memo.
MEMO_WORDS = 300_000
PARTS_PER_MEMO = 8
# Text bytes whose distinct words are looked up together; words sent to the library at once.
TEXT_BYTES = 1 << 23
TEXT_ROWS = 1 << 14
WORDS_AT_ONCE = 256

# ASCII punctuation except the apostrophe, which starts contractions.
TAIL_MARKS = "".join(c for c in string.punctuation if c != "'")
# Trial words and the letters that the model must take them for.
TRIALS = {"a": ["a"], "The": ["the"], string.ascii_letters: [string.ascii_lowercase * 2], "of it": ["of", "it"]}

LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, number bytes) of unsigned 32-bit integers."""
    numbers = np.ascontiguousarray(numbers, dtype="<u4")
    size = 1 + (numbers > 0xFF) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    codes = np.zeros(-(-len(numbers) // 4) * 4, dtype=np.uint8)
    codes[: len(numbers)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    used = np.arange(4) < size[:, None]
    return control.tobytes(), numbers.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers back: lengths by table lookup, then one gather of four bytes each."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count].astype(np.int64)
    starts = np.cumsum(size) - size
    padded = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    if not count:
        return np.empty(0, dtype=np.uint32)
    value = padded[starts]
    for k in (1, 2, 3):
        value = value | (padded[starts + k] << np.uint32(8 * k))
    return value & MASKS[size]


class WordCodes:
    """The library's ids of texts, computed once per distinct word.

    The tokenizer drops white space and never joins across it, so a text's ids are those
    of its words in turn. A word of letters with punctuation behind it is the letters,
    then the punctuation. Lower-case ASCII letters need no normalising and are one word
    to the model; other letters are sent many at a time and told apart by the pieces that
    end a word. A tokenizer that does not behave so on a few trial words gets every word whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.kind = "<u2" if max(vocabulary.values()) < 1 << 16 else "<u4"
        self.code = "H" if self.kind == "<u2" else "I"
        self.model = self.tokenizer.model
        suffix = getattr(self.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[n for token, n in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.splits = bool(suffix) and all(
            self.tokenizer.encode(trial, add_special_tokens=False).ids
            == [n for part in split for n in self.of_letters(part)]
            for trial, split in TRIALS.items()
        )

    def of_letters(self, letters: str) -> list[int]:
        return [token.id for token in self.model.tokenize(letters)]

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def learn(self, words: list[str]) -> None:
        known = self.words
        if len(known) + len(words) > MEMO_WORDS:
            known.clear()
        whole, spelled, parts = [], [], []
        for word in words:
            core = word.rstrip(TAIL_MARKS)
            if not self.splits or not core.isalpha():
                whole.append(word)
            elif not core.isascii():
                spelled.append(word)
                parts.append(1 + (len(core) < len(word)))
            else:
                tail = word[len(core) :]
                if tail and tail not in known:
                    known[tail] = self.packed(self.tokenizer.encode(tail, add_special_tokens=False).ids)
                code = self.packed(self.of_letters(core.lower()))
                known[word] = code + known[tail] if tail else code
        for start in range(0, len(spelled), WORDS_AT_ONCE):
            group = spelled[start : start + WORDS_AT_ONCE]
            ids = self.tokenizer.encode(" ".join(group), add_special_tokens=False).ids
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            last = np.cumsum(parts[start : start + WORDS_AT_ONCE])
            # Each part has at least one end, so equal sums mean that each has just one.
            if len(ends) != last[-1]:
                whole += group
                continue
            joined, begin = self.packed(ids), 0
            for word, end in zip(group, (ends[last - 1] * int(self.kind[-1])).tolist()):
                known[word] = joined[begin:end]
                begin = end
        # The library's results are many times as large as the words.
        for start in range(0, len(whole), WORDS_AT_ONCE):
            group = whole[start : start + WORDS_AT_ONCE]
            for word, found in zip(group, self.tokenizer.encode_batch_fast(group, add_special_tokens=False)):
                known[word] = self.packed(found.ids)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian integers of ``kind``; null is empty."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        seen = split.flatten().dictionary_encode()
        words = seen.dictionary.to_pylist()
        codes = list(map(self.words.get, words))
        missing = [word for word, code in zip(words, codes) if code is None]
        if missing:
            self.learn(missing)
            # A full memo was emptied: words known a moment ago are in ``codes`` already.
            codes = [self.words[word] if code is None else code for word, code in zip(words, codes)]
        ids = pa.array(codes, pa.large_binary()).take(seen.indices)
        if not len(ids):
            return [b""] * len(texts)
        at = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
        first = split.offsets.to_numpy()
        ends = at[first - first[0]]
        data = ids.buffers()[2]
        return [data[a:b].to_pybytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, kind: str, key: str, text: str) -> DataFrame:
    """(key, tie, ids): the ids of each whole text and ``end_id``, as integers of ``kind``.
    ``tie`` orders rows that share a key."""
    schema = T.StructType(
        [docs.schema[key]]
        + [T.StructField("tie", T.LongType()), T.StructField("ids", T.BinaryType())]
    )
    source = docs.select(key, F.xxhash64(text).alias("tie"), docs[text].alias("__text"))
    # Words repeat across partitions: longer tasks learn fewer of them anew.
    parts = source.rdd.getNumPartitions() // PARTS_PER_MEMO
    source = source.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        codes = WordCodes(tokenizer_path)
        end = np.array([end_id], dtype=kind).tobytes()
        for batch in slices(batches, TEXT_ROWS, "__text", TEXT_BYTES):
            ids = [np.frombuffer(found, codes.kind).astype(kind).tobytes() + end for found in codes.encode(batch.column("__text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("tie"), pa.array(ids, pa.binary())], [key, "tie", "ids"]
            )

    return source.mapInArrow(run, schema)


def count_ids(tokenized: DataFrame, vocabulary: int) -> DataFrame:
    """(id, n) over the whole corpus; each task hands on one row per id it saw."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for batch in slices(batches):
            joined = b"".join(batch.column("ids").to_pylist())
            total += np.bincount(np.frombuffer(joined, kind), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    counted = tokenized.select("ids").mapInArrow(run, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write(
    docs: DataFrame,
    out: str,
    tokenizer_path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Tokenize every whole text and write the files below ``out`` in ascending key order.

    ``out/numbers`` has (number, id) for the whole vocabulary, by count and then id;
    ``out/blocks`` has the blocks. Texts are tokenized once and kept, as ids are ranked by
    counts over all of them. Null texts are empty and have the end id only; null keys
    come first; rows that share a key are in order of their text's hash. An empty table
    writes the numbering and no block.
    """
    spark = docs.sparkSession
    vocabulary = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    tokenized = settle_compressed(tokenize(docs, tokenizer_path, end_id, kind, key, text), "tokens")
    counts = count_ids(tokenized, vocabulary)
    # One row per vocabulary entry, whatever the corpus.
    place = Window.orderBy(F.coalesce("n", F.lit(0)).desc(), "id")
    spark.range(vocabulary).join(counts, "id", "left").select(
        (F.row_number().over(place) - 1).cast("int").alias("number"), F.col("id").cast("int")
    ).write.parquet(f"{out}/numbers")
    number_of = spark.sparkContext.broadcast(number_table(spark, out)[1])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The row number splits a key that a third of all rows share.
    ordered = tokenized.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(
        parts, key, "tie", "row"
    ).sortWithinPartitions(key, "tie", "row")
    block_schema = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("part", "start", "n_ids")]
        + [T.StructField("keys", T.ArrayType(docs.schema[key].dataType)), T.StructField("counts", T.ArrayType(T.LongType()))]
        + [T.StructField(c, T.BinaryType()) for c in ("control", "data")]
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = number_of.value
        part, start = TaskContext.get().partitionId(), 0
        keys, parts_held, held = [], [], 0

        def row() -> pa.RecordBatch:
            counts = np.array([len(p) for p in parts_held], dtype=np.int64)
            control, data = pack(numbers[np.concatenate(parts_held)])
            lists = [
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(values, kind_of))
                for values, kind_of in ((keys, key_type), (counts, pa.int64()))
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in (part, start, held)] + lists
                + [pa.array([x], pa.binary()) for x in (control, data)],
                block_schema.names,
            )

        for batch in slices(batches):
            key_type = batch.schema.field(key).type
            for own, ids in zip(batch.column(key).to_pylist(), batch.column("ids").to_pylist()):
                keys.append(own)
                parts_held.append(np.frombuffer(ids, kind))
                held += len(parts_held[-1])
                if held >= BLOCK_IDS:
                    yield row()
                    start += held
                    keys, parts_held, held = [], [], 0
        if keys:
            yield row()

    ordered.select(key, "ids").mapInArrow(blocks, block_schema).write.option(
        "compression", "zstd"
    ).parquet(f"{out}/blocks")


def number_table(spark: SparkSession, out: str) -> tuple[np.ndarray, np.ndarray]:
    """(id by number, number by id); its length is the vocabulary's, not the corpus's."""
    rows = spark.read.parquet(f"{out}/numbers").toPandas()
    by_number = np.empty(len(rows), dtype=np.uint32)
    by_number[rows["number"].to_numpy()] = rows["id"].to_numpy()
    by_id = np.empty_like(by_number)
    by_id[by_number] = np.arange(len(rows), dtype=np.uint32)
    return by_number, by_id


def read(spark: SparkSession, out: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) of every document, decoded from the files.

    ``start`` counts the ids of all documents before it in the files, ``ids`` is binary,
    little-endian unsigned 32-bit. A block knows its start in its part; the parts' own starts
    are a running sum over one row each.
    """
    stored = spark.read.parquet(f"{out}/blocks")
    key_field = T.StructField(key, stored.schema["keys"].dataType.elementType)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    part_starts = settle(
        sums.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start")), "part-starts"
    )
    id_of = spark.sparkContext.broadcast(number_table(spark, out)[0])
    schema = T.StructType(
        [key_field] + [T.StructField(c, T.LongType()) for c in ("place", "n_tokens", "part")]
        + [T.StructField("ids", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = id_of.value
        for batch in slices(batches, 1):
            control, data, held, start, part = (
                batch.column(c)[0].as_py() for c in ("control", "data", "n_ids", "start", "part")
            )
            ids = ids_of[unpack(control, data, held)].astype("<u4")
            counts = batch.column("counts").flatten().to_numpy()
            ends = np.cumsum(counts)
            parts = [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("keys").flatten(), pa.array(start + ends - counts), pa.array(counts),
                    pa.array(np.full(len(counts), part)), pa.array(parts, pa.binary()),
                ],
                schema.names,
            )

    documents = stored.mapInArrow(run, schema)
    return documents.join(part_starts, "part").select(
        key, (F.col("part_start") + F.col("place")).alias("start"), "n_tokens", "ids"
    )
