"""Chat formatting with offset-aligned loss masks.

A whole conversation is rendered to one string, which is encoded once, with the character offsets of every token. The
spans of the turns in that string and the spans of the tokens are both sorted, so a binary search for each turn finds the
run of tokens that lie in it; those of assistant turns make up the loss mask.

Template: [ROLE]role[/ROLE] and then [INST]text[/INST] or, for the assistant, <s>text</s>. The six control strings are
tokens of their own that the encoder splits off first, so no token reaches over the end of a text. Inside roles and texts a
backslash goes behind the first character of anything that reads as a control string, with or without backslashes already
there; taking one backslash away restores the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The control strings of the template.
ROLE, ROLE_END, TURN, TURN_END, REPLY, REPLY_END = CONTROLS = ["[ROLE]", "[/ROLE]", "[INST]", "[/INST]", "<s>", "</s>"]
ASSISTANT = "assistant"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Characters encoded in one call, or one conversation.
BATCH_CHARS = 1 << 20

_ESCAPE = re.compile(r"([\[<])(\\*)(?=/?(?:ROLE\]|INST\]|s>))")
_UNESCAPE = re.compile(r"([\[<])\\(\\*)(?=/?(?:ROLE\]|INST\]|s>))")
_TURN = re.compile(r"\[ROLE\](.*?)\[/ROLE\](?:\[INST\](.*?)\[/INST\]|<s>(.*?)</s>)", re.S)

FORMATTED = (
    "conv_id bigint, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, "
    "loss_tokens array<int>, n_turns bigint"
)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and the spans of the assistant's texts in it."""
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    at = 0
    for role, text in turns:
        begin, end = (REPLY, REPLY_END) if role == ASSISTANT else (TURN, TURN_END)
        head, body = ROLE + escape(role) + ROLE_END + begin, escape(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, end]
        at += len(head) + len(body) + len(end)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a rendered conversation."""
    return [(unescape(m[1]), unescape(m[2] if m[2] is not None else m[3])) for m in _TURN.finditer(formatted)]


def token_runs(starts: list[int], ends: list[int], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """For each span, the run of tokens that lie in it, as begin and end numbers; an empty span has an empty run."""
    runs = []
    for begin, end in spans:
        first = bisect_left(starts, begin)
        runs.append((first, max(first, bisect_left(starts, end, first))))
        assert begin == end or ends[runs[-1][1] - 1] <= end
    return runs


def encoder(path: str):
    """The tokenizer in `path`, with the control strings as tokens of their own and no others in texts."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    tokenizer.add_tokens([AddedToken(c, normalized=False, special=False) for c in CONTROLS])
    return tokenizer


def masked_text(formatted: str, starts: list[int], ends: list[int], loss_tokens: list[int]) -> str:
    """The text under the loss mask, unescaped: the masked tokens' characters, each run of tokens for itself."""
    out = []
    for a, b in zip(loss_tokens[::2], loss_tokens[1::2]):
        if b > a:
            out.append(unescape(formatted[starts[a] : ends[b - 1]]))
    return "".join(out)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    """Conversations out of sorted rows; one is held at a time."""
    held: list[tuple[str, str]] = []
    current: int | None = None
    begun = False
    for batch in batches:
        for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if begun and conv != current:
                yield current, held
                held = []
            current, begun = conv, True
            held.append((role or "", text or ""))
    if begun:
        yield current, held


def format_conversations(conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row a conversation: the formatted string, its tokens with offsets, and the loss mask.

    `conversations` has conv_id, turn, role, text. Turns go by `turn` (null first), ties by role and text; repeated rows are turns of
    their own. A null role or text counts as empty; rows with a null conv_id are one conversation. `loss_tokens`
    lists, for each assistant turn in order, the begin and end numbers of its run of tokens.
    A conversation is rendered whole, so it must fit into a task; nothing else is held.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        held: list[tuple] = []
        size = 0
        for conv_id, turns in _conversations(batches):
            formatted, spans = render(turns)
            held.append((conv_id, formatted, spans, len(turns)))
            size += len(formatted)
            if size >= BATCH_CHARS:
                yield encoded(coder, held)
                held, size = [], 0
        if held:
            yield encoded(coder, held)

    def encoded(coder, held: list[tuple]) -> pa.RecordBatch:
        out = []
        for (conv_id, formatted, spans, n), e in zip(held, coder.encode_batch([h[1] for h in held], add_special_tokens=False)):
            starts, ends = [a for a, _ in e.offsets], [b for _, b in e.offsets]
            runs = [x for run in token_runs(starts, ends, spans) for x in run]
            out.append((conv_id, formatted, e.ids, starts, ends, runs, n))
        kinds = [pa.int64(), pa.string(), *[pa.list_(pa.int32())] * 4, pa.int64()]
        names = ["conv_id", "formatted", "token_ids", "token_starts", "token_ends", "loss_tokens", "n_turns"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return rows.mapInArrow(work, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read from the formatted strings and masks alone."""
    import hashlib

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 64):
                for conv_id, text, starts, ends, loss in zip(*(c.slice(at, 64).to_pylist() for c in batch.columns)):
                    turns = parse(text)
                    told = "".join(f"{role}\n{said}\n" for role, said in turns)
                    masked = masked_text(text, starts, ends, loss)
                    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (told, masked)]
                    out.append((conv_id, len(turns), digests[0], len(masked), digests[1], len(text)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    read = formatted.select("conv_id", "formatted", "token_starts", "token_ends", "loss_tokens")
    return read.mapInArrow(work, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
