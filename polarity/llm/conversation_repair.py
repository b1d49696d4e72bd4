"""Repair of conversation structure (operator 11).

Rows are judged (blank, duplicate, truncated) by aggregations and joins over
narrow keys; their symbols are packed in order by a range sort, so a long
conversation is read by many tasks; one generalised LR pass per conversation
(role_grammar) then sees one character a row.  The texts are shuffled once, to
be replayed beside the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.llm.role_grammar import DELETE, GONE, INSERT, KEEP, Repairer
from polarity.llm.salting import salted_join

PIECE_ROWS = 4096
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
INSERTED = {"u": "user", "a": "assistant"}
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def damage(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the CRC-32 of
    ``conv_id:turn`` mod 20: 0 drops the row, 1 empties its text, 2 removes its
    sentence ends, 3 repeats it, 4 makes it the user's.  Null texts and roles
    are one space, as are nulls in the CRC's input."""
    space = F.lit(" ")
    said = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), space))
    rows = df.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                     (F.crc32(said.cast("binary")) % 20).alias("fault"))
    text = (F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.filter("fault <> 0")
            .select("conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(copies).alias("copy")).drop("copy"))


def _identity() -> Column:
    """Equal for rows of equal role and text."""
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))


def judged(rows: DataFrame) -> DataFrame:
    """One row for each distinct (conv_id, turn, role, text), without the text:
    initial, copies, ``blank``, ``duplicate`` (the first copy is one already)
    and ``truncated``.  Both aggregations combine map-side and the join is
    salted, so neither a repeated row nor a repeated text makes a hot task."""
    trimmed = F.rtrim("text", F.lit(SPACES))
    keys = rows.select(
        "conv_id", "turn", _identity().alias("same"), F.substring("role", 1, 1).alias("initial"),
        (trimmed == "").alias("blank"), (~F.contains(F.lit(ENDS), F.right(trimmed, F.lit(1)))).alias("truncated"))
    keys = keys.groupBy("conv_id", "turn", "same", "initial", "blank", "truncated").agg(F.count(F.lit(1)).alias("copies"))
    first = (keys.groupBy("conv_id", "same").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").drop("n"))
    joined = salted_join(keys, first, ["conv_id", "same"], F.xxhash64("turn"))
    later = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    return joined.withColumn("duplicate", later).drop("first")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted keys into pieces: runs of rows of one conversation."""
    piece = None

    def closed(p):
        return {**p, "symbols": "".join(p["symbols"])}

    for batch in batches:
        done = []
        for key in batch.to_pylist():
            conv, turn, initial = key["conv_id"], key["turn"], key["initial"]
            if piece is None or piece["conv_id"] != conv or piece["n"] >= PIECE_ROWS:
                if piece is not None:
                    done.append(closed(piece))
                piece = {"conv_id": conv, "turn": turn, "same": key["same"], "first": initial, "last": None, "n": 0,
                         "symbols": [], "least": turn, "most": turn, "turns": 0, "blank": 0, "duplicate": 0,
                         "truncated": 0, "illegal": 0}
                before = ()
            if turn is not None:
                if piece["least"] is None:
                    piece["least"] = turn
                piece["turns"] += before != (turn,)
                piece["most"], before = turn, (turn,)
            copies = key["copies"]
            if piece["last"] is not None:
                piece["illegal"] += (piece["last"], initial) not in LEGAL
            piece["illegal"] += (copies - 1) * ((initial, initial) not in LEGAL)
            piece["last"] = initial
            if key["blank"]:
                piece["blank"] += copies
                symbol = GONE
            elif key["duplicate"]:
                piece["duplicate"] += copies
                symbol = GONE
            else:
                piece["duplicate"] += copies - 1
                piece["truncated"] += key["truncated"]
                symbol = initial if initial in ("s", "u", "a") else "?"
                if key["truncated"]:
                    symbol = symbol.upper() if symbol != "?" else "!"
            piece["symbols"].append(symbol + GONE * (copies - 1))
            piece["n"] += 1
        yield _batch(done, batch.schema.field("conv_id").type, batch.schema.field("turn").type)
    if piece is not None:
        yield _batch([closed(piece)], batch.schema.field("conv_id").type, batch.schema.field("turn").type)


_PIECE = ["conv_id", "turn", "same", "first", "last", "symbols", "least", "most", "turns", "blank", "duplicate", "truncated", "illegal"]


def _batch(rows: list[dict], conv: pa.DataType, turn: pa.DataType) -> pa.RecordBatch:
    kinds = {"conv_id": conv, "turn": turn, "least": turn, "most": turn, "same": pa.string(), "first": pa.string(),
             "last": pa.string(), "symbols": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.int64())) for c in _PIECE], names=_PIECE)


def _repaired(repairer: Repairer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, kind = [], None
        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            for piece in batch.to_pylist():
                if pieces and pieces[-1]["conv_id"] != piece["conv_id"]:
                    done.append(_conversation(pieces, repairer))
                    pieces = []
                pieces.append(piece)
            yield _found(done, kind)
        if pieces:
            yield _found([_conversation(pieces, repairer)], kind)

    return run


def _conversation(pieces: list[dict], repairer: Repairer) -> tuple:
    total = {c: sum(p[c] for p in pieces) for c in ("turns", "blank", "duplicate", "truncated", "illegal")}
    least = next((p["least"] for p in pieces if p["least"] is not None), None)
    most = next((p["most"] for p in reversed(pieces) if p["most"] is not None), None)
    for a, b in zip(pieces, pieces[1:]):
        total["illegal"] += (a["last"], b["first"]) not in LEGAL
        total["turns"] -= a["most"] is not None and a["most"] == b["turn"]
    gaps = 0 if least is None else most - least + 1 - total["turns"]
    cost, audit = repairer.repair([p["symbols"] for p in pieces])
    return (pieces[0]["conv_id"], gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost, audit)


def _found(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 8
    types = [kind, *[pa.int64()] * 6, pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", *COUNTS, "audit"])


def repairs(rows: DataFrame) -> DataFrame:
    """One row for each conversation of (conv_id, turn, role, text): its fault
    counts, the cost of the cheapest repair and its audit (initials of Keep,
    Rerole, Delete and Insert in order).

    Rows are taken by turn, null turns first, then equal rows side by side
    (other rows of one turn by their digest).  Null roles and texts are taken
    as one space.  Null conversation ids are one conversation.  Blank rows and
    rows whose role and text came before must go.  Very long texts cost no
    more than their digest; an empty table gives an empty result.  What grows
    with a conversation in one task is one character a row, as the audit does.
    """
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    keys = judged(rows)
    conv, turn = (keys.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    order = ["conv_id", "turn", "same"]
    pieces = (keys.repartitionByRange(*order).sortWithinPartitions(*order)
              .select(*order, "initial", "blank", "truncated", "copies", "duplicate")
              .mapInArrow(_pieces, f"conv_id {conv}, turn {turn}, same string, first string, last string, symbols string, "
                                   f"least {turn}, most {turn}, turns long, blank long, duplicate long, truncated long, illegal long"))
    return (pieces.repartition("conv_id").sortWithinPartitions(*order)
            .mapInArrow(_repaired(Repairer()), f"conv_id {conv}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"))


class _Replay:
    """Lines of one conversation as its rows come by, in the order of the audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.spoke = audit or "", 0, ""

    def _line(self, edit: str, role: str | None, text: str):
        if edit != KEEP:
            role = INSERTED["a" if self.spoke == "u" else "u"]
        self.spoke = role[:1]
        return edit, role, text

    def inserted(self):
        while self.audit[self.at:self.at + 1] == INSERT:
            self.at += 1
            yield self._line(INSERT, None, "")

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != DELETE:
            yield self._line(edit, role, text)


class _Lines:
    """Output rows: the repaired conversation."""

    def __init__(self):
        self.place = 0

    def add(self, line):
        self.place += 1
        return [(self.place - 1, *line)]

    def end(self):
        return []


class _Digest:
    """Output rows: the SHA-256 of all lines ``role:text``, joined by newlines."""

    def __init__(self):
        self.sha, self.glue = hashlib.sha256(), b""

    def add(self, line):
        _, role, text = line
        self.sha.update(self.glue + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.glue = b"\n"
        return []

    def end(self):
        return [(self.sha.hexdigest(),)]


def _replay(sink, names: list[str], types: list[pa.DataType]):
    """One sorted pass: the head of a conversation (its audit), then its rows.
    Only the open conversation's audit and the sink's state are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, replay, out = None, None, None

        def fed(lines):
            return [(conv, *made) for line in lines for made in out.add(line)]

        def ended():
            return fed(replay.inserted()) + [(conv, *made) for made in out.end()] if replay else []

        kind = None
        for batch in batches:
            kind, done = batch.schema.field("conv_id").type, []
            for c, head, role, text, audit in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if head:
                    done += ended()
                    conv, replay, out = c, _Replay(audit), sink()
                else:
                    done += fed(replay.row(role, text))
            yield _rows(done, kind)
        if kind is not None:
            yield _rows(ended(), kind)

    def _rows(done, kind):
        columns = list(zip(*done)) or [()] * (1 + len(types))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [kind, *types])], names=["conv_id", *names])

    return run


def _beside(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows and, before those of each conversation, its audit; sorted."""
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    none = F.lit(None).cast("string")
    lines = rows.select("conv_id", F.lit(False).alias("head"), "role", "text", none.alias("audit"), "turn", _identity().alias("same"))
    heads = found.select("conv_id", F.lit(True).alias("head"), none.alias("role"), none.alias("text"), "audit",
                         F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), none.alias("same"))
    both = heads.unionByName(lines).repartition("conv_id")
    return (both.sortWithinPartitions("conv_id", F.col("head").desc(), "turn", "same")
            .select("conv_id", "head", "role", "text", "audit"))


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations, inserted
    rows with empty text; ``found`` is ``repairs(rows)``."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    return _beside(rows, found).mapInArrow(
        _replay(_Lines, ["place", "edit", "role", "text"], [pa.int64(), pa.string(), pa.string(), pa.string()]),
        f"conv_id {conv}, place long, edit string, role string, text string")


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) for each row of ``found``: the digest of the
    repaired ``role:text`` lines, joined by newlines; that of the empty string
    where none is left.

    A SHA-256 has to see a conversation's lines one after the other, so they
    pass through one task, in order and in batches; nothing of them is kept.
    """
    conv = rows.schema["conv_id"].dataType.simpleString()
    return _beside(rows, found).mapInArrow(_replay(_Digest, ["repaired_sha256"], [pa.string()]),
                                           f"conv_id {conv}, repaired_sha256 string")


def with_all(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` plus zeros and an empty audit for conversations without rows."""
    every = conversations.select(F.col("conv_id").alias("of")).distinct()
    joined = every.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(F.col("of").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in COUNTS],
                         F.coalesce("audit", F.lit("")).alias("audit"))
