"""Chat formatting by incremental black-box rendering.

A template is only asked to render lists of turns. Each prefix of a conversation is rendered, and consecutive
outputs are compared: what turn i adds is its span. Where an output does not begin with the one before, the
template has rewritten history; the turn is reported and spans that reach past the common beginning are void. The text inside a
turn's span is found by rendering the turn with two other texts: outputs differ first where the text begins,
and what follows the text has the same length for both.

Work grows with the square of the turns rendered together. Templates are rendered whole prefix by prefix, so that a
conversation is one call. Where the caller declares a template stateless (a list of turns renders to what its parts render to, one
after the other) a conversation is cut into blocks of BLOCK turns, by count and not by turn number, which are rendered
alone and dealt to different tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]


@dataclass
class TurnTemplate:
    """``### role``, the text and ``</turn>`` on lines of their own; ``\\``, ``#`` and ``<`` in texts take a ``\\``.

    Texts thus never hold a marker, and ``read`` gives back what was rendered.
    """

    escaped: dict[str, str] = field(default_factory=dict)

    def escape(self, text: str) -> str:
        if text not in self.escaped:
            self.escaped[text] = text.replace("\\", "\\\\").replace("#", "\\#").replace("<", "\\<")
        return self.escaped[text]

    def render(self, turns: list[Turn]) -> str:
        return "".join(
            f"### {self.escape(role).replace(chr(10), chr(92) + 'n')}\n{self.escape(text)}\n</turn>\n" for role, text in turns
        )

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)

    def read(self, formatted: str) -> list[Turn]:
        turns = []
        for piece in formatted.split("\n</turn>\n")[:-1]:
            role, _, text = piece[len("### "):].partition("\n")
            turns.append((self.unescape(role), self.unescape(text)))
        return turns


@dataclass
class Located:
    """A formatted conversation: (start, end) of turns and of texts under the loss, None where void."""

    formatted: str
    spans: list[tuple[int, int] | None]
    loss: list[tuple[int, int] | None]
    rewritten: list[int]


def common(x: str, y: str) -> int:
    """Length of the common beginning."""
    if y.startswith(x):
        return len(x)
    low, high = 0, min(len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def locate(render: Render, turns: list[Turn], learned: tuple[str, ...]) -> Located:
    """Render every prefix; texts of ``learned`` roles are under the loss."""
    before = render([])
    spans: list[tuple[int, int] | None] = []
    loss: list[tuple[int, int] | None] = []
    rewritten = []
    for i, (role, _) in enumerate(turns):
        after = render(turns[:i + 1])
        start = common(before, after)
        if start < len(before):
            rewritten.append(i)
            spans = [s if s and s[1] <= start else None for s in spans]
            loss = [s if s and s[1] <= start else None for s in loss]
        spans.append((start, len(after)))
        if role in learned:
            one, two = (render([*turns[:i], (role, probe)]) for probe in ("A", "B"))
            head = common(one, two)
            loss.append((head, len(after) - (len(one) - head - 1)))
        else:
            loss.append(None)
        before = after
    return Located(before, spans, loss, rewritten)


SCHEMA = (
    "conv_id bigint, block bigint, n_turns bigint, formatted string, spans array<struct<start:bigint,end:bigint>>, "
    "loss array<struct<start:bigint,end:bigint>>, rewritten array<int>"
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _formatted(make: Callable[[], object], learned: tuple[str, ...]):
    def span(s: tuple[int, int] | None) -> dict | None:
        return None if s is None else {"start": s[0], "end": s[1]}

    def row(key: tuple, turns: list[Turn]) -> pa.RecordBatch:
        found = locate(make().render, turns, learned)
        return pa.RecordBatch.from_arrays([
            pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([len(turns)], pa.int64()),
            pa.array([found.formatted], pa.string()), pa.array([[span(s) for s in found.spans]], pa.list_(_SPAN)),
            pa.array([[span(s) for s in found.loss]], pa.list_(_SPAN)), pa.array([found.rewritten], pa.list_(pa.int32())),
        ], names=["conv_id", "block", "n_turns", "formatted", "spans", "loss", "rewritten"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "block", "role", "text")]
            for conv, block, role, text in zip(*columns):
                if turns and key != (conv, block):
                    yield row(key, turns)
                    turns = []
                key = (conv, block)
                turns.append((role, text))
        if turns:
            yield row(key, turns)

    return run


def format_conversations(
    turns: DataFrame, make: Callable[[], object] = TurnTemplate, learned: tuple[str, ...] = ("assistant",), block: int = BLOCK,
    stateless: bool = False,
) -> DataFrame:
    """One row per conversation: formatted text, turn spans, loss spans, turns that rewrote history.

    With ``stateless`` one row per conversation and block of turns; spans and turns then count from the block's beginning.

    ``turns`` has conv_id, turn, role, text; rows stand by turn, those with equal turns by role and text; all stay. Null
    role and text: empty. A null turn comes first, a null conv_id is a conversation of its own. An empty table gives no rows.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = _in_blocks(rows, block) if stateless else rows.withColumn("block", F.lit(0).cast("bigint"))
    return (
        rows.select("conv_id", "block", "turn", "role", "text").repartition("conv_id", "block")
        .sortWithinPartitions("conv_id", "block", "turn", "role", "text").mapInArrow(_formatted(make, learned), SCHEMA)
    )


def _in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Adds ``block``: the number of turns before, divided by ``block``.

    Turns are numbered inside cells of ``block`` turn numbers; those of earlier cells are summed from the cells' counts.
    """
    rows = rows.withColumn("cell", F.floor(F.col("turn") / block))
    earlier = Window.partitionBy("conv").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(F.col("conv_id").alias("conv"), F.col("cell").alias("c")).agg(F.count("*").alias("n"))
    counts = counts.select("conv", "c", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "cell").orderBy("turn", "role", "text")
    numbered = rows.withColumn("inside", F.row_number().over(inside) - 1)
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & F.col("cell").eqNullSafe(F.col("c"))
    return numbered.join(counts, same).withColumn("block", F.floor((F.col("before") + F.col("inside")) / block))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    template = TurnTemplate()
    for batch in batches:
        turns, loss = [], []
        for formatted, spans in zip(batch["formatted"].to_pylist(), batch["loss"].to_pylist()):
            turns.append("".join(f"{role}\n{text}\n" for role, text in template.read(formatted)))
            loss.append("".join(template.unescape(formatted[s["start"]:s["end"]]) for s in spans if s))
        yield pa.RecordBatch.from_arrays([
            batch["conv_id"], batch["block"], batch["n_turns"], pa.array(turns, pa.string()), pa.array(loss, pa.string()),
            pa.array([len(f) for f in batch["formatted"].to_pylist()], pa.int64()),
        ], names=["conv_id", "block", "n_turns", "turns", "loss", "chars"])


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what can be read from the formatted text, a row per conversation."""
    read = formatted.mapInArrow(_read, "conv_id bigint, block bigint, n_turns bigint, turns string, loss string, chars bigint")
    parts = F.array_sort(F.collect_list(F.struct("block", "turns", "loss")))
    whole = read.groupBy("conv_id").agg(F.sum("n_turns").alias("n_turns"), F.sum("chars").alias("formatted_chars"), parts.alias("p"))
    turns, loss = (F.array_join(F.col(f"p.{name}"), "") for name in ("turns", "loss"))
    return whole.select(
        "conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )
