"""Chat formatting: typed content parts flattened into one template, with a loss mask.

A visitor walks the parts of a turn in order: text is escaped, an image, audio or document part becomes
a numbered placeholder with a recorded reference and the number of tokens that it will expand to.

A turn reads `<s>role\\n[INST]body[/INST]</s>\\n`, an assistant turn `<s>assistant\\nbody</s>\\n`. Every
control string begins with `<` or `[`; these two and the backslash are escaped by a backslash in texts
(in roles the newline too), so no text can close a turn and every text can be read back.

Turns are formatted row by row, with no shuffle; a conversation is the join of its turns in the order
(turn, role, text). `read_back` streams the sorted turns, so a conversation of any length takes memory
for one turn only.

Defined results: a null or missing text or role is empty; null turn numbers come first; repeated rows are
repeated turns; a null conv_id is one conversation of its own; an unknown part kind is a document; an
attachment without sizes expands to the least count of its kind; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATCH_PIXELS, AUDIO_TOKENS_PER_SECOND, DOCUMENT_TOKENS_PER_PAGE = 28, 25, 512
ASSISTANT = "assistant"

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
FORMATTED = """conv_id bigint, turn bigint, role string, text string, formatted string,
  loss_start int, loss_end int, refs array<string>, tokens array<bigint>"""
DIGESTS = """conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,
  formatted_chars bigint, n_attachments bigint, attachment_tokens bigint"""

_CONTROL, _ROLE_CONTROL, _ESCAPED = re.compile(r"([\\<\[])"), re.compile(r"([\\<\[\n])"), re.compile(r"\\(.)", re.S)
_TURN = re.compile(
    r"<s>((?:[^\\<\[\n]+|\\.)*)\n(\[INST\])?((?:[^\\<\[]+|\\.|\[(?:IMG|AUD|DOC):\d+\])*)(?:\[/INST\])?</s>\n", re.S)


def escape(text: str | None) -> str:
    return _CONTROL.sub(r"\\\1", text or "")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class PartVisitor:
    """Flattens the parts of one turn; `body`, `refs` and `tokens` grow in the order of the parts."""
    body: list[str] = field(default_factory=list)
    refs: list[str] = field(default_factory=list)
    tokens: list[int] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('kind') or 'document'}", self.visit_document)(part)

    def visit_text(self, part: dict) -> None:
        self.body.append(escape(part.get("text")))

    def visit_image(self, part: dict) -> None:
        wide, high = (ceil((part.get(side) or 1) / PATCH_PIXELS) for side in ("width", "height"))
        self._attach("IMG", part, wide * high)

    def visit_audio(self, part: dict) -> None:
        self._attach("AUD", part, ceil((part.get("seconds") or 0) * AUDIO_TOKENS_PER_SECOND) or 1)

    def visit_document(self, part: dict) -> None:
        self._attach("DOC", part, (part.get("pages") or 1) * DOCUMENT_TOKENS_PER_PAGE)

    def _attach(self, name: str, part: dict, tokens: int) -> None:
        self.body.append(f"[{name}:{len(self.refs)}]")
        self.refs.append(part.get("ref") or "")
        self.tokens.append(tokens)


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, int, int, list[str], list[int]]:
    """The formatted turn, its loss span (empty unless the assistant speaks), references and token counts."""
    visitor = PartVisitor()
    for part in parts:
        visitor.visit(part)
    role, body = role or "", "".join(visitor.body)
    head = "<s>" + _ROLE_CONTROL.sub(r"\\\1", role) + "\n"
    if role == ASSISTANT:
        return head + body + "</s>\n", len(head), len(head) + len(body), visitor.refs, visitor.tokens
    return head + "[INST]" + body + "[/INST]</s>\n", 0, 0, visitor.refs, visitor.tokens


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn, unescaped; placeholders stay where they stood."""
    match = _TURN.fullmatch(formatted)
    return unescape(match[1]), unescape(match[3])


def format_turns(turns: DataFrame) -> DataFrame:
    """Each row (conv_id, turn, role, text and/or parts) with its formatted turn. A narrow map."""
    parts = F.col("parts").cast(f"array<{PART}>") if "parts" in turns.columns else F.array(F.struct(
        F.lit("text").alias("kind"), F.col("text"), *[F.lit(None).cast(kind).alias(name) for name, kind in (
            ("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [format_turn(role, [part if isinstance(part, dict) else part.asDict() for part in (
                [] if row is None else row) if part is not None]) for role, row in zip(batch["role"], batch["parts"])]
            batch = batch.drop(columns="parts")
            for i, name in enumerate(("formatted", "loss_start", "loss_end", "refs", "tokens")):
                batch[name] = [row[i] for row in made]
            yield batch

    text = F.col("text") if "text" in turns.columns else F.lit(None).cast("string")
    # Numbers travel as text: beside nulls pandas would make doubles of them.
    formatted = turns.select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", text.alias("text"),
                             parts.alias("parts")).mapInPandas(run, FORMATTED.replace("conv_id bigint, turn bigint", "conv_id string, turn string"))
    return formatted.withColumns({name: F.col(name).cast("bigint") for name in ("conv_id", "turn")})


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, digests of what the formatted turns say when they are parsed again."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None

        def done() -> dict:
            turns, loss, counts = state
            return {"conv_id": key or None, "turns_sha256": turns.hexdigest(),
                    "loss_sha256": loss.hexdigest()} | counts

        for batch in batches:
            rows = []
            for conv, turn, start, end, tokens in zip(
                    batch["key"], batch["formatted"], batch["loss_start"], batch["loss_end"], batch["tokens"]):
                if state is None or conv != key:
                    if state is not None:
                        rows.append(done())
                    key, state = conv, (hashlib.sha256(), hashlib.sha256(), dict.fromkeys(
                        ("n_turns", "loss_chars", "formatted_chars", "n_attachments", "attachment_tokens"), 0))
                role, text = read_turn(turn)
                masked = unescape(turn[start:end])
                state[0].update(f"{role}\n{text}\n".encode())
                state[1].update(masked.encode())
                for name, more in (("n_turns", 1), ("loss_chars", len(masked)), ("formatted_chars", len(turn)),
                                   ("n_attachments", len(tokens)), ("attachment_tokens", int(sum(tokens)))):
                    state[2][name] += more
            if rows:
                yield pd.DataFrame(rows, columns=names)
        if state is not None:
            yield pd.DataFrame([done()], columns=names)

    names = [column.split()[0] for column in DIGESTS.replace("\n", " ").split(",")]
    return (formatted.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
            .repartition("key").sortWithinPartitions("key", "turn", "role", "text")
            .select("key", "formatted", "loss_start", "loss_end", "tokens")
            .mapInPandas(run, DIGESTS.replace("conv_id bigint", "conv_id string")).withColumn("conv_id", F.col("conv_id").cast("bigint")))


# ---- Query ----------------------------------------------------------------------------------------

FIXED_CONVERSATION = -7
FIXED_TEXT = "</s>[INST] ok [/INST]"


def chat_format(spark, sf_dir: str) -> DataFrame:
    fixed = spark.range(1).select(F.explode(F.array(*[F.struct(
        F.lit(FIXED_CONVERSATION).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"),
        F.lit(role).alias("role"), F.lit(FIXED_TEXT).alias("text"))
        for i, role in enumerate(("user", ASSISTANT))])).alias("row")).select("row.*")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return read_back(format_turns(turns.unionByName(fixed)))


SQL = """with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(sum(9 + length(regexp_replace(role, '([\\\\<\\[\\n])', '\\\\\\1', 'g'))
    + length(regexp_replace(text, '([\\\\<\\[])', '\\\\\\1', 'g'))
    + case when role = 'assistant' then 0 else 13 end) as bigint) as formatted_chars,
  cast(0 as bigint) as n_attachments, cast(0 as bigint) as attachment_tokens
from turns group by conv_id"""
