"""Chat formatting by token-level assembly.

Every turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``.  The two control
strings are reserved ids beyond the vocabulary, spliced between segments that
are encoded separately, so no text can ever yield one.  In the formatted
string, control strings occurring in a role or text are escaped reversibly:
a backslash is put between ``<`` and ``|`` (one more where some stand there
already).  The loss mask covers the text of assistant turns; it is the prefix
sum of +1 where such a segment starts and -1 where it ends.

``assemble`` gives one row per turn, in parallel: its token ids and mask.  No
row holds a whole conversation; ``digest`` decodes the ids and streams each
conversation's turns, in order, through running hashes, so a conversation
with a third of all turns needs sorted rows, not memory.  (A digest over one
conversation's text is one sequential hash, hence one task.)

Defined cases: null roles and texts are empty; a null turn comes before all
others; turns with equal numbers are ordered by role, then text; repeated rows
are turns of their own; a null conv_id is one conversation; an empty table
gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ROWS = 128
TOKENIZER = "byte_bpe_50k.json"
_tokenizers: dict = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def _tokenizer(path: str):
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer
        loaded = Tokenizer.from_file(path)
        loaded.encode_special_tokens = True  # their strings in a text are ordinary text
        _tokenizers[path] = loaded
    return _tokenizers[path]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: encodings and Python lists take many times the size of their texts."""
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def escape(text: str) -> str:
    """``text`` without any ``<|``; undone by ``unescape``."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def _assemble(path: str):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        start, end = tok.get_vocab_size(), tok.get_vocab_size() + 1
        newline = tok.encode("\n", add_special_tokens=False).ids
        for batch in _slices(batches):
            ids, masks = [], []
            roles, texts = (batch.column(c).to_pylist() for c in ("role", "text"))
            heads = tok.encode_batch([escape(r or "") + "\n" for r in roles], add_special_tokens=False)
            bodies = tok.encode_batch([escape(t or "") for t in texts], add_special_tokens=False)
            for role, head, body in zip(roles, heads, bodies, strict=True):
                row = [start, *head.ids, *body.ids, end, *newline]
                step = np.zeros(len(row) + 1, dtype=np.int8)
                if role == "assistant":
                    step[1 + len(head.ids)] += 1
                    step[1 + len(head.ids) + len(body.ids)] -= 1
                ids.append(row)
                masks.append(np.cumsum(step[:-1], dtype=np.int8))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(masks, pa.list_(pa.int8()))], names=["conv_id", "turn", "token_ids", "loss_mask"])
    return assemble


def assemble(rows: DataFrame, path: str | None = None) -> DataFrame:
    """(conv_id, turn, token_ids, loss_mask) of every turn in ``rows`` (conv_id, turn, role, text)."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_assemble(path or tokenizer_path()),
                           "conv_id long, turn long, token_ids array<int>, loss_mask array<tinyint>")


def read_back(ids: list[int], mask: list[int], tok) -> tuple[str, str, str, int]:
    """(role, text, text under the mask, characters of the formatted string) of one turn's tokens."""
    size = tok.get_vocab_size()
    inner = ids[1:ids.index(size + 1)]
    if ids[0] != size or any(x >= size for x in inner):
        raise ValueError("not a turn")
    content = tok.decode(inner, skip_special_tokens=False)
    role, _, text = content.partition("\n")
    under = tok.decode([x for x, m in zip(ids, mask, strict=True) if m], skip_special_tokens=False)
    tail = tok.decode(ids[ids.index(size + 1) + 1:], skip_special_tokens=False)
    return role, text, under, len(START) + len(content) + len(END) + len(tail)


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for batch in _slices(batches):
            found = [read_back(i, m, tok) for i, m in zip(batch.column("token_ids").to_pylist(),
                                                          batch.column("loss_mask").to_pylist(), strict=True)]
            role, text, under, chars = zip(*found, strict=True) if found else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(map(unescape, role), pa.string()),
                 pa.array(map(unescape, text), pa.string()), pa.array(map(unescape, under), pa.string()),
                 pa.array(chars, pa.int64())], names=["conv_id", "turn", "role", "text", "under", "chars"])
    return decode


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from rows sorted by conversation and turn."""
    out: list[tuple] = []
    state = None

    def flush():
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        cols = list(zip(*out, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
        out.clear()
        return batch

    def close():
        conv, n, turns, loss_chars, loss, chars = state
        out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
    for batch in _slices(batches):
        for conv, role, text, under, chars in zip(*(batch.column(c).to_pylist() for c in (
                "conv_id", "role", "text", "under", "chars")), strict=True):
            if state is None or state[0] != conv:
                if state is not None:
                    close()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode())
            state[3] += len(under)
            state[4].update(under.encode())
            state[5] += chars
        if len(out) >= 10_000:
            yield flush()
    if state is not None:
        close()
    if out:
        yield flush()


def digest(assembled: DataFrame, path: str | None = None) -> DataFrame:
    """Digest columns per conversation, read back from the tokens and masks."""
    turns = assembled.mapInArrow(_decode(path or tokenizer_path()),
                                 "conv_id long, turn long, role string, text string, under string, chars long")
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(_hash, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                               "loss_sha256 string, formatted_chars long"))
