"""Roles of transcript turns by a hidden Markov model, and turns in canonical form.

The hidden states are the roles. What a turn shows is a symbol made of the speaker marker
it may begin with and of features of its lines; roles follow one another by learned
transitions. Viterbi finds the most probable roles of a whole conversation. Long
conversations are cut into pieces: the best path through a piece, for every role before it
and every last role, is a small matrix, and the matrices of a conversation decide where its
path enters and leaves each piece.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from abonados.llm.common import ready

ROLES = ("system", "user", "assistant")
#: How transcripts name speakers at the begin of a turn.
MARKERS = {
    "system": ("system", "instruction", "instructions"),
    "user": ("user", "human", "q", "question"),
    "assistant": ("assistant", "ai", "bot", "a", "answer"),
}
#: Numbers of turns that one piece spans.
PIECE = 512
#: Each combination of symbols counts this much more than it was seen.
SMOOTHING = 0.5


def _marker(names: tuple[str, ...]) -> str:
    return rf"(?i)^\s*(?:#+\s*|\*\*|<\|)?(?:{'|'.join(names)})(?:\*\*)?\s*(?:\|>|:|\n)\s*(?:\*\*)?\s*"


def symbol(text: Column) -> Column:
    """What a turn shows: its marker, how long it is, how many lines it has and whether
    it asks. Null shows as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    marker = F.lit("none")
    for role, names in MARKERS.items():
        marker = F.when(text.rlike(_marker(names)), role).otherwise(marker)
    length = F.floor(F.log2(F.char_length(text) + 1)).cast("string")
    lines = F.least(F.size(F.split(text, "\n")), F.lit(6)).cast("string")
    asks = F.when(F.rtrim(text).endswith("?"), "asks").otherwise("tells")
    return F.concat_ws(" ", marker, length, lines, asks)


def unmarked(text: Column) -> Column:
    """The turn's text without its speaker marker."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for names in MARKERS.values():
        out = F.regexp_replace(out, _marker(names), "")
    return out


def piece_of(order: Column) -> Column:
    """The piece of its conversation that a turn is in; turns without a number come first."""
    return F.coalesce(F.floor(order / PIECE), F.lit(-(2**62))).cast("long")


@dataclass(frozen=True)
class Model:
    """Logarithms: of roles at the start, of roles after roles, and of symbols by role."""

    start: tuple[float, ...]
    after: tuple[tuple[float, ...], ...]
    shows: dict[str, tuple[float, ...]]
    unseen: tuple[float, ...]


def train(turns: DataFrame, conversation: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> Model:
    """Counts of labelled turns; those with null or other roles are not learned from. Of
    the corpus only the counts of symbols and of role pairs come to the driver.

    Roles that follow one another are counted within pieces of a conversation, and from
    piece to piece by the first and last turn of each, so a conversation that holds a
    large share of all turns is never ordered in one task.
    """
    rows = turns.select(
        F.col(conversation).alias("c"),
        piece_of(F.col(order)).alias("piece"),
        F.struct(F.col(order).cast("double").alias("o"), F.xxhash64(F.col(text)).alias("x")).alias("o"),
        F.col(role).alias("r"),
        symbol(F.col(text)).alias("s"),
    ).filter(F.col("r").isin(*ROLES))
    at = {name: i for i, name in enumerate(ROLES)}
    start, after = np.full(3, SMOOTHING), np.full((3, 3), SMOOTHING)
    shows: dict[str, np.ndarray] = {}
    for row in rows.groupBy("r", "s").count().collect():
        shows.setdefault(row["s"], np.full(3, SMOOTHING))[at[row["r"]]] += row["count"]
    inside = rows.withColumn("b", F.lag("r").over(Window.partitionBy("c", "piece").orderBy("o")))
    edges = rows.groupBy("c", "piece").agg(F.min_by("r", "o").alias("r"), F.max_by("r", "o").alias("end"))
    edges = edges.withColumn("b", F.lag("end").over(Window.partitionBy("c").orderBy("piece")))
    pairs = inside.filter("b IS NOT NULL").select("b", "r").unionByName(edges.select("b", "r"))
    for row in pairs.groupBy("b", "r").count().collect():
        counts = start if row["b"] is None else after[at[row["b"]]]
        counts[at[row["r"]]] += row["count"]
    # a speaker marker tells its role even if training has no markers
    for name, i in at.items():
        shows.setdefault(f"marker {name}", np.full(3, SMOOTHING))[i] += 100
    total = sum(shows.values()) + SMOOTHING
    logs = lambda x: tuple(float(v) for v in np.log(x))
    return Model(
        logs(start / start.sum()),
        tuple(logs(row / row.sum()) for row in after),
        {name: logs(n / total) for name, n in shows.items()},
        logs(SMOOTHING / total),
    )


def _emissions(model: Model, symbols: list[str]) -> np.ndarray:
    rows = []
    for s in symbols:
        marker = s.split(" ", 1)[0]
        known = model.shows.get(s, model.unseen)
        if marker != "none":
            known = tuple(a + b for a, b in zip(known, model.shows[f"marker {marker}"], strict=True))
        rows.append(known)
    return np.array(rows)


def _steps(model: Model, emissions: np.ndarray, first: bool) -> np.ndarray:
    """Best scores from every role before the rows (one row if they begin the
    conversation) to every role of the last row."""
    after = np.array(model.after)
    best = np.array(model.start)[None, :] + emissions[0] if first else after + emissions[0]
    for e in emissions[1:]:
        best = (best[:, :, None] + after[None, :, :]).max(axis=1) + e
    return best


def _path(model: Model, emissions: np.ndarray, before: int, last: int) -> list[int]:
    after, back = np.array(model.after), []
    best = (np.array(model.start) if before < 0 else after[before]) + emissions[0]
    for e in emissions[1:]:
        through = best[:, None] + after
        back.append(through.argmax(axis=0))
        best = through.max(axis=0) + e
    path = [last]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def parse(turns: DataFrame, model: Model, conversation: str = "conv_id", order: str = "turn", text: str = "text") -> DataFrame:
    """``turns`` with ``role_pred`` and ``rendered``, the turn in canonical form without
    its speaker marker. A role column of the input is not looked at.

    Turns are ordered by ``order``, nulls first, then by text; a null text is an empty
    turn and null conversations are one conversation. Repeated rows are turns each. Input
    columns of the two new names are replaced; an empty table gives an empty result. A
    task sees at most one piece, ``PIECE`` numbers of turns, or 9 numbers for each piece
    of one conversation.
    """
    ready(turns.sparkSession)
    names = [c for c in turns.columns if c not in ("role_pred", "rendered")]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    rows = turns.select(
        F.col(conversation).alias("c"),
        piece_of(F.col(order)).alias("piece"),
        F.col(order).cast("double").alias("o"),
        symbol(F.col(text)).alias("s"),
        F.xxhash64(F.col(text)).alias("x"),
        row,
    )
    kind = rows.schema["c"].dataType.simpleString()
    first = rows.groupBy("c").agg(F.min("piece").alias("first"))
    ordered = [("o", "ascending"), ("x", "ascending")]

    def matrix(table: pa.Table) -> pa.Table:
        table = table.sort_by(ordered)
        begins = table.column("piece")[0].as_py() == table.column("first")[0].as_py()
        best = _steps(model, _emissions(model, table.column("s").to_pylist()), begins)
        return pa.table({"c": table.column("c")[:1], "piece": table.column("piece")[:1], "m": pa.array([best.ravel().tolist()])})

    joined = rows.join(first, rows["c"].eqNullSafe(first["c"])).drop(first["c"])
    matrices = joined.select("c", "piece", "first", "o", "x", "s").groupBy("c", "piece").applyInArrow(
        matrix, f"c {kind}, piece long, m array<double>"
    )

    def ends(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        found = [np.array(m).reshape(-1, 3) for m in table.column("m").to_pylist()]
        best, back = found[0][0], []
        for m in found[1:]:
            through = best[:, None] + m
            back.append(through.argmax(axis=0))
            best = through.max(axis=0)
        last = [int(best.argmax())]
        for step in reversed(back):
            last.append(int(step[last[-1]]))
        last = last[::-1]
        return pa.table({"c": table.column("c"), "piece": table.column("piece"), "before": pa.array([-1, *last[:-1]], pa.int32()), "last": pa.array(last, pa.int32())})

    bounds = matrices.groupBy("c").applyInArrow(ends, f"c {kind}, piece long, before int, last int")
    bounds = bounds.select(F.col("c").alias("bc"), F.col("piece").alias("bp"), "before", "last")
    placed = rows.join(bounds, rows["c"].eqNullSafe(bounds["bc"]) & (rows["piece"] == bounds["bp"])).drop("bc", "bp")

    def roles(table: pa.Table) -> pa.Table:
        table = table.sort_by(ordered)
        path = _path(model, _emissions(model, table.column("s").to_pylist()), table.column("before")[0].as_py(), table.column("last")[0].as_py())
        return pa.table({"row": table.column("row"), "role_pred": pa.array([ROLES[i] for i in path])})

    done = placed.groupBy("c", "piece").applyInArrow(roles, f"row {rows.schema['row'].dataType.simpleString()}, role_pred string")
    rendered = F.concat(F.lit("<|"), F.col("role_pred"), F.lit("|>\n"), unmarked(F.col(f"row.{text}")), F.lit("\n<|end|>\n"))
    return done.select("row", "role_pred", rendered.alias("rendered")).select("row.*", "role_pred", "rendered")
