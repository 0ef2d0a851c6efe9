"""Token-id files: concatenated id arrays with Elias-Fano encoded document boundaries.

A dataset is a Parquet folder; each row is one shard, a run of documents in ascending doc_id
order (null first), at most about SHARD_IDS ids or a single longer document:

``part, seq``   place of the shard: its task's range of doc_ids, and its number there
``doc_ids``     the documents' ids
``ids``         all token ids, little-endian, ``width`` bytes each (2 where the vocabulary allows)
``n_ids``       number of ids
``ef_bits, ef_low, ef_high``  Elias-Fano code of the documents' start offsets within the shard

Elias-Fano stores the n sorted offsets below u with about ``2 + log2(u / n)`` bits each: the low
``ef_bits`` bits packed one after another, the rest as a unary bit vector in which the i-th set
bit stands at ``high(i) + i``; ``select`` finds it and so returns the i-th offset.

Spark's committer writes and reads the shards, so lost executors are retried and any store works.
Defined results: null or empty texts are documents of only the end id; repeated rows are repeated
documents; an empty table gives an empty dataset.
"""

from __future__ import annotations

import codecs
import os
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statmart.llm.common import BATCH_BYTES, PieceTable, batches, map_batches, partitions
from statmart.session import scratch_path

END_ID = 1
SHARD_IDS = 1 << 20
SHARD = ("part int, seq int, doc_ids array<long>, n_ids long, width int, ids binary, "
         "ef_bits int, ef_low binary, ef_high binary")


def elias_fano(values: np.ndarray, universe: int) -> tuple[int, bytes, bytes]:
    """(low bits, packed low parts, unary high parts) of sorted values below ``universe``."""
    n = len(values)
    bits = max(0, int(universe // max(1, n)).bit_length() - 1)
    low = (values[:, None] >> np.arange(bits)) & 1 if bits else np.zeros((n, 0), dtype=np.int64)
    high = np.zeros(n + (int(universe) >> bits) + 1, dtype=np.uint8)
    high[(values >> bits) + np.arange(n)] = 1
    return bits, np.packbits(low.astype(np.uint8).ravel()).tobytes(), np.packbits(high).tobytes()


class EliasFano:
    """Sorted offsets in Elias-Fano code, with a sampled directory for ``select``."""

    STEP = 64

    def __init__(self, n: int, bits: int, low: bytes, high: bytes):
        self.n, self.bits, self.low = n, bits, low
        self.bytes = np.frombuffer(high, dtype=np.uint8)
        #: set bits before each block of STEP bytes
        ones = np.bitwise_count(self.bytes).astype(np.int64)
        starts = np.arange(0, max(1, len(ones)), self.STEP)
        self.before = np.concatenate([[0], np.cumsum(np.add.reduceat(ones, starts))]) if len(ones) else np.zeros(1, dtype=np.int64)

    def select(self, i: int) -> int:
        """The i-th offset."""
        block = int(np.searchsorted(self.before, i, side="right")) - 1
        bits = np.unpackbits(self.bytes[block * self.STEP:(block + 1) * self.STEP])
        place = int(np.flatnonzero(bits)[i - self.before[block]]) + block * self.STEP * 8
        return ((place - i) << self.bits) | self._low(i)

    def _low(self, i: int) -> int:
        if not self.bits:
            return 0
        first, last = i * self.bits, (i + 1) * self.bits
        packed = np.unpackbits(np.frombuffer(self.low[first // 8:(last + 7) // 8], dtype=np.uint8))
        own = packed[first % 8:first % 8 + self.bits].astype(np.int64)
        return int((own << np.arange(self.bits)).sum())

    def all(self) -> np.ndarray:
        """Every offset, in order."""
        places = np.flatnonzero(np.unpackbits(self.bytes))[:self.n] - np.arange(self.n)
        if not self.bits:
            return places
        low = np.unpackbits(np.frombuffer(self.low, dtype=np.uint8))[:self.n * self.bits].reshape(self.n, self.bits).astype(np.int64)
        return (places << self.bits) | (low << np.arange(self.bits)).sum(axis=1)


#: Letters up to U+00FF that normalisation leaves as they are or lower-cases one by one.
_LETTERS = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"

#: A comma or full stop after such a letter and before white space is a token of its own either way.
_POINT = rf"([{_LETTERS}])([,.])([ \n])"

#: Units that the pre-tokenizer cuts into runs of letters, single digits and runs of other signs (an
#: apostrophe may begin an English ending, so it is left out).
_PLAIN = rf"\A[!-&(-@\[-~{_LETTERS}]*\z"
_SIGNS = r"[0-9]|[!-/:-@\[-`{-~]+"
_PIECE = rf"{_SIGNS}|[^!-@\[-`{{-~]+"

#: Units handed to the library at once.
_UNITS = 20_000


def _byte_letters() -> str:
    """The characters by which the byte-level step writes each byte; a space stays as it is."""
    shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)} | {32: " "}
    return "".join(letter[b] for b in range(256))


@lru_cache(maxsize=2)
def _tokenizers(path: str):
    """The tokenizer, its model behind no other step than cutting at white space, and which tokens
    close a piece. A worker process reads the file once for all its tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer, pre_tokenizers

    full = Tokenizer.from_file(path)
    bare = Tokenizer(full.model)
    bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    vocabulary, suffix = full.get_vocab(), full.model.end_of_word_suffix
    closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
    closing[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
    return full, bare, closing


def word_tokenizer(path: str):
    """``encode(texts) -> [ids]`` with a lower-casing byte-level word BPE of the tokenizers library;
    ``texts`` is an Arrow array of strings without nulls.

    The tokenizer drops white space, lower-cases and never joins across white space, so texts are
    encoded word by word, each distinct word once; texts that hold a control string go whole. Arrow
    cuts the texts and finds the distinct words, and the library gets many new words in one call.
    """
    full, bare, closing = _tokenizers(path)
    letters = _byte_letters()

    def encode_plain(units: list[str]):
        """Ids and lengths of units of ``_PLAIN``, written as the steps before the model would."""
        text = pc.replace_substring_regex(pa.scalar(" ".join(units)), _SIGNS, r" \0 ").as_py()
        text, _ = codecs.charmap_decode(text.lower().encode(), "strict", letters)
        ids = np.array(bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)
        pieces = np.cumsum(pc.count_substring_regex(pa.array(units, type=pa.string()), _PIECE).to_numpy())
        ends = np.flatnonzero(closing[ids]) + 1
        if len(ends) != pieces[-1]:  # a model without closing tokens
            return encode_other(units)
        return ids, np.diff(np.append(0, ends)[pieces], prepend=0)

    def encode_other(units: list[str]):
        out = full.encode(units, is_pretokenized=True, add_special_tokens=False)
        return np.array(out.ids, dtype=np.int32), np.bincount(np.array(out.word_ids, dtype=np.int64), minlength=len(units))

    def encode_units(units: list[str]):
        plain = pc.match_substring_regex(pa.array(units, type=pa.string()), _PLAIN).to_numpy(zero_copy_only=False)
        lengths, starts, found, total = np.zeros(len(units), dtype=np.int64), np.zeros(len(units), dtype=np.int64), [], 0
        for encode_part, places in ((encode_plain, np.flatnonzero(plain)), (encode_other, np.flatnonzero(~plain))):
            for first in range(0, len(places), _UNITS):
                own = places[first:first + _UNITS]
                ids, counts = encode_part([units[i] for i in own.tolist()])
                lengths[own], starts[own] = counts, total + np.cumsum(counts) - counts
                found.append(ids)
                total += len(ids)
        ends = np.cumsum(lengths)
        return np.concatenate(found)[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)], lengths

    table = PieceTable(encode_units)

    def encode(texts: pa.Array) -> list[np.ndarray]:
        low = pc.ascii_lower(texts)
        whole = pc.match_substring(low, "<|")
        cut = pc.replace_substring_regex(pc.if_else(whole, pa.scalar("", low.type), low), _POINT, r"\1 \2\3")
        words = pc.ascii_split_whitespace(cut)
        units = words.flatten().dictionary_encode()
        codes = table.codes(units.dictionary.to_numpy(zero_copy_only=False).tolist())[units.indices.to_numpy()]
        ends = np.concatenate([[0], np.cumsum(table.lengths[codes])])
        places = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
        out = np.split(table.gather(codes), ends[places[1:-1]])
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            out[i] = np.array(full.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, dtype=np.int32)
        return out

    return encode


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int = END_ID,
                      vocabulary: int = 49_408) -> None:
    """Encode ``docs`` (doc_id, text) into shards under ``folder``."""
    path = tokenizer_path or public_tokenizers.path("word_bpe_49k.json")
    width = 2 if vocabulary <= 1 << 16 else 4

    def pack(stream):
        encode = word_tokenizer(path)
        part, seq = TaskContext.get().partitionId(), 0
        doc_ids, held, size = [], [], 0

        def shard():
            lengths = np.array([len(x) for x in held], dtype=np.int64)
            bits, low, high = elias_fano(np.cumsum(lengths) - lengths, int(lengths.sum()))
            ids = np.concatenate(held).astype(f"<u{width}").tobytes()
            row = [[part], [seq], [doc_ids], [int(lengths.sum())], [width], [ids], [bits], [low], [high]]
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(row, kinds)],
                                              [c.split()[0] for c in SHARD.split(", ")])

        for batch in stream:
            keys, texts = batch.column("doc_id").to_pylist(), pc.fill_null(batch.column("text"), "")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy())
            cuts = [0, *(np.flatnonzero(np.diff(sizes // BATCH_BYTES)) + 1).tolist(), len(keys)]
            for first, last in zip(cuts, cuts[1:]):
                for key, ids in zip(keys[first:last], encode(texts[first:last])):
                    if held and size + len(ids) >= SHARD_IDS:
                        yield shard()
                        seq, doc_ids, held, size = seq + 1, [], [], 0
                    doc_ids.append(key)
                    held.append(np.append(ids, np.int32(end_id)))
                    size += len(ids) + 1
        if held:
            yield shard()
        pa.default_memory_pool().release_unused()  # workers are used again by later stages

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text"))
    map_batches(ordered, pack, SHARD).write.parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(part, seq, base, ...): the shards with ``base``, the number of ids before each."""
    shards = spark.read.schema(SHARD).parquet(folder)
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each task that wrote, whatever the number of documents
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("part_ids").over(earlier), F.lit(0)).alias("part_base"))
    places = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("shard_base")).join(bases, "part")
    places = places.select("part", "seq", (F.col("part_base") + F.col("shard_base")).alias("base"))
    return shards.join(places, ["part", "seq"])


def documents_of(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards."""

    def work():
        def run(batch):
            out = [[], [], [], []]
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype=f"<u{row['width']}")
                n = len(row["doc_ids"])
                starts = EliasFano(n, row["ef_bits"], row["ef_low"], row["ef_high"]).all()
                ends = np.append(starts[1:], row["n_ids"])
                out[0] += row["doc_ids"]
                out[1] += (row["base"] + starts).tolist()
                out[2] += (ends - starts).tolist()
                out[3] += [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, ends)]
            return pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in out], ["doc_id", "start", "n_tokens", "ids_crc32"])

        return run

    return batches(shards, work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and return what reading them gives."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer_path)
    return documents_of(read_token_files(docs.sparkSession, folder))
