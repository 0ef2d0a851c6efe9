"""Chat formatting by assembly of token ids.

A turn is ``<|im_start|>role\\ncontent<|im_end|>\\n``. Role, content and line ends are encoded
each for itself as ordinary text and the two reserved ids are spliced in between, so no content can
become a control id. In the formatted text control strings of a content are escaped as well: ``<``,
any backslashes, ``|`` gets one more backslash, which ``unescape`` takes away again.

Offsets of turns and of their loss spans within the conversation are prefix sums of the segments'
lengths. The loss mask covers the assistants' contents. Output is one row a turn (``conv_id, seq, token_start,
ids, loss_start, loss_end``), in files; a conversation is its rows by ``seq``, so even an endless one is never held in memory.

Defined results: a null text or role is empty; turns are ordered by turn (null first), then role, then
ids; rows without conv_id form one conversation; repeated rows are repeated turns; an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statmart.llm.common import batches, map_batches, partitions, ragged
from statmart.session import scratch_path

START, END = "<|im_start|>", "<|im_end|>"
#: Reserved ids, after the vocabulary's own 50,257.
START_ID, END_ID = 50_257, 50_258
TRAINED_ROLE = "assistant"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def byte_tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def format_turns(conversations: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """(conv_id, seq, token_start, ids, loss_start, loss_end) of every row of ``conversations``
    (conv_id, turn, role, text); the loss span is null where nothing is trained on."""
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def work():
        encoding = byte_tokenizer(path)
        line_end = encoding.encode_ordinary("\n")
        heads: dict[str, list[int]] = {}

        def run(batch):
            made, starts, ends = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                role = role or ""
                head = heads.get(role)
                if head is None:
                    head = [START_ID, *encoding.encode_ordinary(escape_role(role)), *line_end]
                    if len(heads) < 1000:
                        heads[role] = head
                content = encoding.encode_ordinary(escape(text or ""))
                made.append(np.array([*head, *content, END_ID, *line_end], dtype=np.int32))
                trained = role == TRAINED_ROLE
                starts.append(len(head) if trained else None)
                ends.append(len(head) + len(content) if trained else None)
            return pa.RecordBatch.from_arrays(
                [batch.column("conv_id").cast(pa.int64()), batch.column("turn").cast(pa.int64()), batch.column("role"),
                 ragged(np.concatenate(made), np.array([len(x) for x in made]), pa.int32()),
                 pa.array(starts, type=pa.int64()), pa.array(ends, type=pa.int64())],
                ["conv_id", "turn", "role", "ids", "loss_from", "loss_to"])

        return run

    turns = batches(conversations.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")),
                    work, "conv_id long, turn long, role string, ids array<int>, loss_from long, loss_to long")
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "ids")
    start = F.coalesce(F.sum(F.size("ids")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (turns.withColumn("seq", F.row_number().over(order)).withColumn("token_start", start)
            .select("conv_id", "seq", "token_start", "ids", (F.col("token_start") + F.col("loss_from")).alias("loss_start"),
                    (F.col("token_start") + F.col("loss_to")).alias("loss_end")))


def read_digests(formatted: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Read formatted turns back: one row a conversation with digests of its turns, of the text under
    the loss mask, and the length of the formatted text. Rows stream by in order; only running digests are held."""
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(stream):
        encoding = byte_tokenizer(path)
        plain = lambda ids: encoding.decode_bytes(ids).decode("utf-8", "replace")
        held, begun = None, False

        def closed():
            conv_id, n, turns, loss_chars, loss, chars = held
            return (conv_id, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

        for batch in stream:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "token_start", "ids", "loss_start", "loss_end"))
            for conv_id, token_start, ids, loss_start, loss_end in zip(*columns):
                if not begun or held[0] != conv_id:
                    if begun:
                        done.append(closed())
                    held, begun = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0], True
                last = len(ids) - 1 - ids[::-1].index(END_ID)
                inside = plain(ids[1:last])
                role, _, content = inside.partition("\n")
                held[1] += 1
                held[2].update(f"{unescape_role(role)}\n{unescape(content)}\n".encode())
                held[5] += len(START) + len(inside) + len(END) + len(plain(ids[last + 1:]))
                if loss_start is not None:
                    text = unescape(plain(ids[loss_start - token_start:loss_end - token_start]))
                    held[3] += len(text)
                    held[4].update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*done), kinds)], names)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in zip(closed(), kinds)], names)

    ordered = formatted.repartition(partitions(formatted.sparkSession), "conv_id").sortWithinPartitions("conv_id", "seq")
    return map_batches(
        ordered.select("conv_id", "token_start", "ids", "loss_start", "loss_end"), run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def write_formatted(conversations: DataFrame, folder: str, tokenizer_path: str | None = None) -> None:
    format_turns(conversations, tokenizer_path).write.parquet(folder)


def read_formatted(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("conv_id long, seq int, token_start long, ids array<int>, loss_start long, loss_end long").parquet(folder)


def formatted_digests(conversations: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write the formatted conversations to the shared folder and return the digests of what is read back."""
    spark = conversations.sparkSession
    folder = scratch_path(spark, "chat")
    write_formatted(conversations, folder, tokenizer_path)
    return read_digests(read_formatted(spark, folder), tokenizer_path)
