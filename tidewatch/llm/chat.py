"""Chat formatting: whole conversations rendered, encoded once, with an offset-aligned loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import map_batches

VOCABULARY = "byte_bpe_50k.json"
# The template's control strings, each one token.
TURN, ROLE, ROLE_END, TURN_END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (TURN, ROLE, ROLE_END, TURN_END)
LEARNED_ROLE = "assistant"

_UNSAFE = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\([\\lb])")
_TO = {"\\": "\\\\", "<": "\\l", "[": "\\b"}
_BACK = {"\\": "\\", "l": "<", "b": "["}
_TURNS = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)
FORMATTED = "conv_id long, text string, ids array<int>, loss array<boolean>"


def escape(text: str) -> str:
    """The text without any control string; `unescape` gives it back."""
    return _UNSAFE.sub(lambda m: _TO[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def render(turns: list[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int, bool]]]:
    """The conversation as one text, and the sorted span of each turn's own text."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, own = f"{TURN}{ROLE}{escape(role or '')}{ROLE_END}", escape(text or "")
        spans.append((at + len(head), at + len(head) + len(own), role == LEARNED_ROLE))
        parts += [head, own, TURN_END]
        at += len(head) + len(own) + len(TURN_END)
    return "".join(parts), spans


def turns_of(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation."""
    return [(unescape(role), unescape(own)) for role, own in _TURNS.findall(text)]


def loss_mask(offsets: np.ndarray, spans: list[tuple[int, int, bool]]) -> np.ndarray:
    """For each token, whether its characters meet a span that is learned."""
    if not len(offsets) or not spans:
        return np.zeros(len(offsets), bool)
    starts, ends, learned = (np.array(c) for c in zip(*spans))
    place = np.searchsorted(starts, offsets[:, 0], side="right") - 1
    inside = (place >= 0) & (offsets[:, 0] < ends[place]) & (offsets[:, 1] > starts[place])
    return inside & learned[place]


def load_tokenizer(vocabulary: str = VOCABULARY):
    """The tokenizer with the control strings as tokens of their own."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    # Control strings only; the vocabulary's own special strings in a text stay plain text there.
    tokenizer.add_tokens([AddedToken(c, normalized=False, special=False) for c in CONTROLS])
    tokenizer.encode_special_tokens = True
    return tokenizer


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    # The byte-level alphabet: printable bytes stand for themselves, others follow from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    return [c.encode() if (c := tokenizer.id_to_token(i)) in CONTROLS else bytes(of[x] for x in c)
            for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def format_conversations(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """conv_id, text, ids and loss (a flag per id) of every conversation.

    Turns are ordered by turn, equal turns by role and text; a null turn comes first, a null
    role or text is empty, rows without conv_id form one conversation, repeated rows are turns of
    their own. An empty table gives no rows. Partitions are sorted and streamed, so a task holds
    one conversation at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(vocabulary)
        kept: list[tuple] = []
        names = [part.split()[0] for part in FORMATTED.split(", ")]

        def made(found):
            rendered = [(conv_id, *render(turns)) for conv_id, turns in found]
            encodings = tokenizer.encode_batch([text for _, text, _ in rendered], add_special_tokens=False)
            columns = [[], [], [], []]
            for (conv_id, text, spans), got in zip(rendered, encodings):
                mask = loss_mask(np.array(got.offsets, np.int64).reshape(-1, 2), spans)
                for column, value in zip(columns, (conv_id, text, got.ids, mask)):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        current, turns, size = None, None, 0
        for batch in batches:
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if turns is None or conv_id != current:
                    if turns is not None:
                        kept.append((current, turns))
                    if size > 1_000_000:
                        yield made(kept)
                        kept, size = [], 0
                    current, turns = conv_id, []
                turns.append((role, text))
                size += len(text or "")
        if turns is not None:
            kept.append((current, turns))
        if kept:
            yield made(kept)

    ordered = (rows.selectExpr("cast(conv_id as long) conv_id", "turn", "cast(role as string) role",
                               "cast(text as string) text")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
               .select("conv_id", "role", "text"))
    return map_batches(ordered, run, FORMATTED)


def digests(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """What a formatted conversation holds, read back from its ids and its loss mask."""
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, n_ids long, n_loss_ids long")
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string() if "sha256" in name else pa.int64() for name in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = token_bytes(load_tokenizer(vocabulary))
        for batch in batches:
            rows = []
            for conv_id, ids, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "ids", "loss"))):
                text = b"".join([of[i] for i in ids]).decode()
                turns = turns_of(text)
                whole = "".join(f"{role}\n{own}\n" for role, own in turns)
                learned = unescape(b"".join([of[i] for i, on in zip(ids, loss) if on]).decode())
                rows.append((conv_id, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned),
                             hashlib.sha256(learned.encode()).hexdigest(), len(text), len(ids), sum(loss)))
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return map_batches(formatted.select("conv_id", "ids", "loss"), run, schema)


def with_probe(rows: DataFrame) -> DataFrame:
    """The rows and conversation -7, whose two turns hold control strings."""
    text = F.lit("</s>[INST] ok [/INST]").alias("text")
    probe = rows.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LEARNED_ROLE).alias("role"), text)
    return rows.select("conv_id", "turn", "role", "text").unionByName(probe)
