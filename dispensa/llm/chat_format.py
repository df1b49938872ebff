"""Chat formatting: conversations as token ids with a loss mask, and as text.

Method: token-level assembly.  Role, text and control marks of a turn are never
encoded together: role and text are encoded separately, and the reserved ids of
the marks are spliced between them, so no text can form a control token.  A turn
is  <|turn|> role <|text|> content <|end|>.  The loss mask follows from prefix
sums over +1 after the text mark and -1 at the end mark of assistant turns.

Control strings inside contents are escaped: a backslash goes behind the first
character of each (and of each that has backslashes there already), and
unescaping takes one away, so every content is recovered exactly.

Turns are encoded row by row, before any grouping.  A conversation's place and
offsets come from windows over its turns, and it is read back by a stream over
sorted rows that keeps digests, not texts: a conversation may be of any length.

Turns are ordered by turn, role, text (null turns first).  Null texts and roles
are empty.  Repeated rows are turns of their own.  An empty table gives an empty
result.  Extra columns are ignored."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Marks of this template and, fixed values, of other common ones: none of them may stand unescaped in a content.
CONTROL = (
    TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
    "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>",
)
_ESCAPE = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL))
_UNESCAPE = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROL))
_MARK = re.compile("|".join(map(re.escape, (TURN, TEXT, END))))
ENCODED = "conv_id long, turn long, role string, text string, ids array<int>, loss_mask array<byte>, formatted string"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"

_vocabularies: dict[str, object] = {}


def vocabulary(path: str):
    if path not in _vocabularies:
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(path)
        found.encode_special_tokens = True
        _vocabularies[path] = found
    return _vocabularies[path]


def reserved(path: str) -> tuple[int, int, int]:
    """Ids of the three marks: the first beyond the vocabulary."""
    n = vocabulary(path).get_vocab_size()
    return n, n + 1, n + 2


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][0] + m[0][2:], text)


def assemble(role_ids: list[int], text_ids: list[int], marks: tuple[int, int, int], learn: bool) -> tuple[np.ndarray, np.ndarray]:
    """(ids, loss mask) of one turn."""
    turn, text, end = marks
    ids = np.array([turn, *role_ids, text, *text_ids, end], np.int32)
    step = np.zeros(len(ids), np.int8)
    if learn:
        step[1:] += (ids == text)[:-1]
        step -= ids == end
    return ids, np.cumsum(step, dtype=np.int8)


def _encode(path: str, learn_role: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, marks = vocabulary(path), reserved(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                roles, texts = ([x or "" for x in part.column(c).to_pylist()] for c in ("role", "text"))
                role_ids = known.encode_batch([escape(r) for r in roles], add_special_tokens=False)
                text_ids = known.encode_batch([escape(t) for t in texts], add_special_tokens=False)
                rows = [assemble(r.ids, t.ids, marks, role == learn_role) for r, t, role in zip(role_ids, text_ids, roles, strict=True)]
                formatted = [f"{TURN}{escape(r)}{TEXT}{escape(t)}{END}" for r, t in zip(roles, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), part.column("turn"), pa.array(roles, pa.string()), pa.array(texts, pa.string()),
                     pa.array([i for i, _ in rows], pa.list_(pa.int32())), pa.array([m for _, m in rows], pa.list_(pa.int8())), pa.array(formatted, pa.string())],
                    names=["conv_id", "turn", "role", "text", "ids", "loss_mask", "formatted"],
                )

    return encode


def format_conversations(turns: DataFrame, tokenizer: str, learn_role: str = "assistant") -> DataFrame:
    """Every turn with its place in its conversation.

    turns: conv_id, turn, role, text.  Returns conv_id, place (from 0),
    token_start (of the turn in the conversation's ids), ids, loss_mask and
    formatted.  A conversation's ids, mask and text are its turns', joined by place."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    encoded = rows.mapInArrow(_encode(tokenizer, learn_role), ENCODED)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = encoded.withColumn("place", F.row_number().over(order).cast("long") - 1)
    placed = placed.withColumn("token_start", F.coalesce(F.sum(F.size("ids").cast("long")).over(before), F.lit(0).cast("long")))
    return placed.select("conv_id", "place", "token_start", "ids", "loss_mask", "formatted")


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn: its marks delimit them."""
    marks = list(_MARK.finditer(formatted))
    if [m[0] for m in marks] != [TURN, TEXT, END] or marks[0].start() or marks[2].end() != len(formatted):
        raise ValueError("not a formatted turn")
    return unescape(formatted[marks[0].end() : marks[1].start()]), unescape(formatted[marks[1].end() : marks[2].start()])


def _read(path: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (turn_id, text_id, end_id) = vocabulary(path), reserved(path)
        state: list | None = None
        out: list[tuple] = []

        def close() -> None:
            if state is not None:
                conv, n, turns, chars, loss, length, tokens, learnt = state
                out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), length, tokens, learnt))

        def flush() -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            names = [f.split()[0] for f in DIGESTS.split(", ")]
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)
            out.clear()
            return batch

        for batch in batches:
            convs, formatted = batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist()
            starts, n_ids, n_masks = batch.column("token_start").to_pylist(), batch.column("ids"), batch.column("loss_mask")
            for i, conv in enumerate(convs):
                if state is None or state[0] != conv:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                ids, mask = np.asarray(n_ids[i].values), np.asarray(n_masks[i].values).astype(bool)
                if starts[i] != state[6] or ids[0] != turn_id or ids[-1] != end_id or (ids == text_id).sum() != 1:
                    raise ValueError("a conversation's ids are not its turns', one after the other")
                cut = int(np.flatnonzero(ids == text_id)[0])
                role, text = (unescape(known.decode(part.tolist(), skip_special_tokens=False)) for part in (ids[1:cut], ids[cut + 1 : -1]))
                if parse_turn(formatted[i]) != (role, text):
                    raise ValueError("a turn's text and its ids differ")
                loss = unescape(known.decode(ids[mask].tolist(), skip_special_tokens=False))
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(formatted[i])
                state[6] += len(ids)
                state[7] += int(mask.sum())
            if len(out) >= 1024:
                yield flush()
        close()
        yield flush()

    return read


def read_conversations(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """Reads formatted conversations back and checks them: one row of digests each."""
    by_conv = formatted.select("conv_id", "place", "token_start", "ids", "loss_mask", "formatted").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return by_conv.mapInArrow(_read(tokenizer), DIGESTS)
