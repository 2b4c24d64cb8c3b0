"""Conversation structure repair by alignment with the grammar ``(s?(ua)+)?``.

A repaired conversation alternates user and assistant, after a system turn at
most. Rows of a conversation may be kept (cost 0), given the role of user or
assistant (2) or deleted (3); user and assistant turns without text may be put
in anywhere (2). Blank and repeated rows must go, a truncated one that stays
costs 1 more. Of the cheapest edits those are taken whose initials (D, I, K, R,
in order) come first as text.

For each length the grammar string can have, Wagner and Fischer's table aligns
the rows with that one string. It holds only Ukkonen's band: the cells that a
path no dearer than the incumbent can touch. Tables are filled from the end, so
walking forward by the least letter gives the first of all cheapest audits of a
length, and audits of several lengths are compared.

A conversation may hold any number of rows. It is cut into blocks of
``BLOCK_ROWS``, each aligned by itself, from every state the grammar can be in
to every one it can leave in. Audits of a block end with a row's letter, so none
is the beginning of another, and the least audit of a conversation is made of
least audits of its blocks. Blocks are aligned by all tasks alike; only their
audits, 32 rows in one, meet in the task that puts a conversation together. The texts follow the edits by a join on the place
of a row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.llm.common import BLANKS, Scratch

USER, ASSISTANT = "user", "assistant"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLOCK_ROWS = 32
CACHED_BLOCKS = 50_000
# Marks of a row: nothing wrong, blank, seen before, cut short.
FINE, BLANK, REPEAT, SHORT = ".", "b", "d", "t"
# The grammar's states: nothing yet, after the system turn, after a user turn, after an assistant turn.
NOTHING, SYSTEM, ASKED, ANSWERED = "nsua"
# What ends a conversation, by its last state.
ENDING = {NOTHING: "", SYSTEM: "II", ASKED: "I", ANSWERED: ""}
PROBE_FATES = 20


Ways = list[tuple[str, str, int, str]]


class Repair(NamedTuple):
    """``audits``: a row for each conversation. ``turns``: (conv_id, place, role, text), repaired, places from 0."""

    audits: DataFrame
    turns: DataFrame


# -- alignment of a block -----------------------------------------------------


def align(kinds: str, marks: str, target: str, limit: int) -> tuple[int, str] | None:
    """Least cost of turning rows into ``target``, with the first of the cheapest audits; none above ``limit``.

    Nothing is inserted after the last row. A path off the straight diagonals
    pays for a deletion and an insertion each step, which bounds the band.
    """
    n, m = len(kinds), len(target)
    shift = m - n
    least = INSERT * shift if shift >= 0 else -DELETE * shift
    if least > limit:
        return None
    spare = (limit - least) // (INSERT + DELETE)
    low, high = min(0, shift) - spare, max(0, shift) + spare
    table: list[dict[int, int]] = [{} for _ in range(n)] + [{m: 0}]
    for i in range(n - 1, -1, -1):
        row, after = table[i], table[i + 1]
        for j in range(min(m, i + high), max(0, i + low) - 1, -1):
            best = min((cost for _, _, cost in _moves(kinds, marks, target, i, j, row, after)), default=math.inf)
            if best <= limit:
                row[j] = best
    if 0 not in table[0]:
        return None
    i, j, audit = 0, 0, []
    while i < n:
        letter = next(x for x, _, cost in _moves(kinds, marks, target, i, j, table[i], table[i + 1]) if cost == table[i][j])
        audit.append(letter)
        i += letter != "I"
        j += letter != "D"
    return table[0][0], "".join(audit)


def _moves(kinds: str, marks: str, target: str, i: int, j: int, row: dict, after: dict) -> Iterator[tuple[str, int, int]]:
    """(letter, target, cost to the end) of what may happen at a cell, by letter."""
    if j in after:
        yield "D", j, after[j] + DELETE
    if j == len(target):
        return
    free = target[j] != "s"
    if free and j + 1 in row:
        yield "I", j, row[j + 1] + INSERT
    if marks[i] in (BLANK, REPEAT) or j + 1 not in after:
        return
    cost = after[j + 1] + (TRUNCATED if marks[i] == SHORT else 0)
    if kinds[i] == target[j]:
        yield "K", j, cost
    elif free:
        yield "R", j, cost + REROLE


def _target(start: str, end: str, m: int) -> str | None:
    """The grammar string of ``m`` turns that leads from a state to another, if there is one."""
    if m == 0:
        return "" if start == end else None
    if start == NOTHING:
        if end == SYSTEM:
            return "s" if m == 1 else None
        if end not in (ASKED, ANSWERED):
            return None
        # Its parity tells whether the string begins with a system turn.
        with_system = (m % 2 == 1) != (end == ASKED)
        if with_system and m == 1:
            return None
        return ("s" if with_system else "") + ("ua" * m)[: m - with_system]
    if end not in (ASKED, ANSWERED):
        return None
    string = ("au" if start == ASKED else "ua") * m
    return string[:m] if string[m - 1] == end else None


@lru_cache(maxsize=CACHED_BLOCKS)
def transitions(kinds: str, marks: str) -> Ways:
    """(state before a block, state after it, cost, audit): the best for each pair of states."""
    states = (NOTHING, SYSTEM, ASKED, ANSWERED)
    return [(start, end, *best) for start in states for end in states if (best := _best(kinds, marks, start, end))]


def _best(kinds: str, marks: str, start: str, end: str) -> tuple[int, str] | None:
    n = len(kinds)
    # Straight across but for one turn, at the worst: each row deleted and put in anew.
    most = (DELETE + INSERT) * (n + 2)
    lengths = sorted(range(2 * n + 3), key=lambda m: (INSERT * (m - n) if m >= n else DELETE * (n - m), m))
    best: tuple[int, str] | None = None
    for m in lengths:
        least = INSERT * (m - n) if m >= n else DELETE * (n - m)
        if least > (best[0] if best else most):
            break
        target = _target(start, end, m)
        if target is None:
            continue
        limit = best[0] if best else max(least, INSERT)
        found = align(kinds, marks, target, limit)
        while found is None and best is None and limit < most:  # no incumbent yet: the band is widened
            limit = min(2 * limit, most)
            found = align(kinds, marks, target, limit)
        if found and (best is None or found < best):
            best = found
    return best


# -- a conversation of blocks -------------------------------------------------


class Folded:
    """Best way into each state over the blocks so far; ``rank`` orders the audits of the ways."""

    def __init__(self) -> None:
        self.ways = {NOTHING: (0, 0)}
        self.back: list[tuple[int, dict[str, tuple[str, str]]]] = []
        self.counts = {BLANK: 0, REPEAT: 0, SHORT: 0}
        self.illegal, self.last = 0, ""

    def add(self, first: int, kinds: str, marks: str, ways: Ways) -> None:
        """One more block; ``ways`` are those of ``transitions``."""
        for mark in self.counts:
            self.counts[mark] += marks.count(mark)
        joined = self.last + kinds
        self.illegal += sum(joined[i : i + 2] not in ("su", "ua", "au") for i in range(len(joined) - 1))
        self.last = kinds[-1]
        found: dict[str, tuple[int, int, str, str]] = {}
        for start, end, more, audit in ways:
            if start in self.ways:
                cost, rank = self.ways[start]
                way = (cost + more, rank, audit, start)
                if end not in found or way < found[end]:
                    found[end] = way
        # No audit begins another, so the order of beginnings is that of the whole.
        order = sorted(found, key=lambda end: found[end][1:3])
        self.ways = {end: (found[end][0], order.index(end)) for end in found}
        self.back.append((first, {end: (way[3], way[2]) for end, way in found.items()}))

    def finish(self) -> tuple[int, list[tuple[int, str]]]:
        """(cost, [(first row's place, audit) of each block])."""
        cost, _, end = min((c + INSERT * len(ENDING[s]), rank, s) for s, (c, rank) in self.ways.items())
        more, out = ENDING[end], []
        for first, block in reversed(self.back):
            end, audit = block[end]
            out.append((first, audit + more))
            more = ""
        return cost, out[::-1]


def _edits(blocks: list[tuple[int, str]]) -> Iterator[tuple[int, str | None, int | None]]:
    """(place in the repaired conversation, new role or none, row's place or none) of every turn that is there."""
    turns = sum(len(audit) - audit.count("D") for _, audit in blocks)
    at, out = -(turns % 2), 0  # a system turn stands before the pairs if their number is odd
    for row, audit in blocks:
        for letter in audit:
            if letter != "D":
                yield out, None if letter == "K" else (USER, ASSISTANT)[at % 2], None if letter == "I" else row
                at, out = at + 1, out + 1
            row += letter != "I"


_WAY = pa.struct([("before", pa.string()), ("after", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])


def _align_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks and the ways through them; every block by itself."""
    for batch in batches:
        # In pieces: a block of ways is some kilobytes.
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            pairs = zip(part.column("kinds").to_pylist(), part.column("marks").to_pylist(), strict=True)
            ways = [[dict(zip(("before", "after", "cost", "audit"), way, strict=True)) for way in transitions(*pair)] for pair in pairs]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ways, pa.list_(_WAY))], names=[*part.schema.names, "ways"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks sorted by conversation and place to audits and edits; edits leave in pieces, one for each block."""
    now, state = None, None
    rows: list[dict] = []

    def close() -> Iterator[pa.RecordBatch]:
        cost, blocks = state.finish()
        rows.append(
            {
                "conv_id": now[0], "blank": state.counts[BLANK], "duplicate": state.counts[REPEAT],
                "truncated": state.counts[SHORT], "illegal": state.illegal, "cost": cost,
                "audit": "".join(audit for _, audit in blocks), "edits": None,
            }
        )
        piece: list[dict] = []
        for place, role, pos in _edits(blocks):
            piece.append({"place": place, "role": role, "pos": pos})
            if len(piece) == BLOCK_ROWS:
                rows.append({"conv_id": now[0], "edits": piece})
                piece = []
                yield from flush(1000)
        if piece:
            rows.append({"conv_id": now[0], "edits": piece})
        yield from flush(1000)

    def flush(least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(rows) >= least:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows.clear()

    schema = None
    for batch in batches:
        if schema is None:
            edit = pa.struct([("place", pa.int64()), ("role", pa.string()), ("pos", pa.int64())])
            numbers = [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type), *numbers, ("audit", pa.string()), ("edits", pa.list_(edit))])
        for block in batch.to_pylist():
            if now != (block["conv_id"],):
                if now is not None:
                    yield from close()
                now, state = (block["conv_id"],), Folded()
            state.add(block["first"], block["kinds"], block["marks"], [tuple(way.values()) for way in block["ways"]])
    if now is not None:
        yield from close()
        yield from flush()


# -- tables -------------------------------------------------------------------


def ends_well(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1)).isin(".", "!", "?")


def repair(rows: DataFrame, scratch: Scratch) -> Repair:
    """Audits and repaired turns of ``rows`` (conv_id, turn, role, text, more), taken by turn, nulls first.

    Rows of one turn follow each other by role and text, in the order of their
    bytes. A null role or text is one space, which is blank; a role counts by its
    first letter. Rows without conv_id form one conversation. Repeated rows are
    duplicates. Turns may be negative, missing or repeated: ``gaps`` counts the
    numbers between the least and the largest that no row has. Other columns are
    ignored. An empty table gives empty tables. Texts are never cut and never
    meet in one row; a text itself may have any length.
    """
    says = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    first_letter = F.left("role", F.lit(1))
    ordered = scratch.settle(
        rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
        .orderBy("conv_id", "turn", "role", "text")
        .select(
            "*",
            # Rises over the sorted rows, by one within a file.
            F.monotonically_increasing_id().alias("pos"),
            F.when(first_letter.isin("s", "u", "a"), first_letter).otherwise("?").alias("kind"),
            F.when(~says, BLANK).when(ends_well(F.col("text")), FINE).otherwise(SHORT).alias("mark"),
        ),
        "ordered",
    )
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    firsts = ordered.where(F.col("mark") != BLANK).groupBy("conv_id", said).agg(F.min("pos").alias("pos"))
    here = ordered.select("conv_id", "pos", "kind", "mark").unionByName(
        firsts.select("conv_id", "pos", F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("mark"))
    )
    # A row meets the note that it is the first of its kind: at most twice BLOCK_ROWS in a group.
    # Rows are few bytes and much work: by a stated number of partitions, which is not lowered for lack of bytes.
    tasks = int(scratch.spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = (
        here.withColumn("block", F.expr(f"pos div {BLOCK_ROWS}"))
        .repartition(tasks, "conv_id", "block")
        .groupBy("conv_id", "block")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("pos", "kind", "mark")))).alias("rows"),
            F.collect_list(F.when(F.col("kind").isNull(), F.col("pos"))).alias("firsts"),
        )
        .select(
            "conv_id",
            F.element_at("rows", 1)["pos"].alias("first"),
            F.array_join(F.transform("rows", lambda r: r["kind"]), "").alias("kinds"),
            F.array_join(
                F.transform(
                    "rows",
                    lambda r: F.when((r["mark"] != BLANK) & ~F.array_contains("firsts", r["pos"]), REPEAT).otherwise(r["mark"]),
                ),
                "",
            ).alias("marks"),
        )
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    aligned = blocks.mapInArrow(
        _align_blocks,
        f"conv_id {kind}, first long, kinds string, marks string, "
        "ways array<struct<before: string, after: string, cost: long, audit: string>>",
    )
    folded = scratch.settle(
        aligned.repartition("conv_id")
        .sortWithinPartitions("conv_id", "first")
        .mapInArrow(
            _fold,
            f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
            "edits array<struct<place: long, role: string, pos: long>>",
        ),
        "folded",
    )
    spans = ordered.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    audits = folded.where(F.col("edits").isNull()).drop("edits").alias("f")
    audits = audits.join(spans.alias("s"), F.col("f.conv_id").eqNullSafe(F.col("s.conv_id"))).select("f.*", "s.gaps")
    edits = folded.select("conv_id", F.explode("edits").alias("e")).select("conv_id", "e.*").alias("e")
    source = ordered.select("pos", "role", "text").alias("o")
    turns = edits.join(source, F.col("e.pos") == F.col("o.pos"), "left").select(
        "e.conv_id", "e.place", F.coalesce("e.role", "o.role").alias("role"), F.coalesce("o.text", F.lit("")).alias("text")
    )
    return Repair(audits, turns)


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): hex SHA-256 of ``role:text``, joined by newlines, of each conversation.

    A digest of a whole text needs its pieces one after the other. They pass
    through a task as a sorted stream, so it holds one of them at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            names = [batch.schema.field("conv_id")] + [pa.field("repaired_sha256", pa.string())]
            ids, hashes = [], []
            for conv, role, text in zip(*[batch.column(i) for i in range(3)], strict=True):
                conv = conv.as_py()
                if now != (conv,):
                    if now is not None:
                        ids.append(now[0])
                        hashes.append(digest.hexdigest())
                    now, digest = (conv,), hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role.as_py()}:{text.as_py()}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, names[0].type), pa.array(hashes, pa.string())], schema=pa.schema(names))
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]], names[0].type), pa.array([digest.hexdigest()])], schema=pa.schema(names))

    kind = turns.schema["conv_id"].dataType.simpleString()
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text), damaged by the CRC-32 of ``conv_id:turn``, nulls being one space.

    Of 20 remainders 0 drops a row, 1 empties its text, 2 takes ``.``, ``!`` and
    ``?`` out of it, 3 repeats the row and 4 gives it to the user.
    """
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fate = F.crc32(place) % PROBE_FATES
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return rows.where(fate != 0).select(
        "conv_id",
        "turn",
        F.when(fate == 4, USER).otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of ``conversations``, damaged and repaired."""
    scratch = Scratch(spark, "turn-repair")
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repaired_digests(given, scratch)


def repaired_digests(given: DataFrame, scratch: Scratch) -> DataFrame:
    """The contract's columns; a conversation that lost all its rows has zeros, no audit and the digest of no text."""
    audits, turns = repair(damage(given), scratch)
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    joined = (
        given.select("conv_id").distinct().alias("g")
        .join(audits.alias("a"), same("g", "a"), "left")
        .join(turn_digests(turns).alias("t"), same("g", "t"), "left")
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "g.conv_id",
        *[F.coalesce(f"a.{c}", F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("a.audit", F.lit("")).alias("audit"),
        F.coalesce("t.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# The same by another way: one row at a time through the states of the grammar, all conversations at once.
ORACLE = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(c ORDER BY i) AS crcs FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)
  )
),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
  FROM conversations
),
fated AS (
  SELECT given.*, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(place) + 1), lambda p: ascii(place[p])::BIGINT)),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) % 20 AS fate
  FROM given, crc_table
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM fated, LATERAL (SELECT unnest(CASE fate WHEN 0 THEN []::INT[] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy)
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS nr,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM damaged
),
marked AS (
  SELECT conv_id, turn, role, text, nr, substr(role, 1, 1) AS kind,
    CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nr) > 1 THEN 'd' WHEN right(body, 1) IN ('.', '!', '?') THEN '.' ELSE 't' END AS mark,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY nr) AS before
  FROM numbered
),
-- What one row may do: letters, states before and after, cost, and the turns that come of it (* is the row's own).
puts(s, e, letters, cost, out) AS (
  VALUES ('n', 'n', '', 0, []::VARCHAR[]), ('s', 's', '', 0, []), ('u', 'u', '', 0, []), ('a', 'a', '', 0, []),
    ('n', 'u', 'I', 2, ['user:']), ('s', 'u', 'I', 2, ['user:']), ('a', 'u', 'I', 2, ['user:']), ('u', 'a', 'I', 2, ['assistant:']),
    ('n', 'a', 'II', 4, ['user:', 'assistant:']), ('s', 'a', 'II', 4, ['user:', 'assistant:']),
    ('u', 'u', 'II', 4, ['assistant:', 'user:']), ('a', 'a', 'II', 4, ['user:', 'assistant:'])
),
takes(s, e, wanted) AS (VALUES ('n', 's', 's'), ('n', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
folded(conv_id, nr, s, cost, audit, out) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 'n', 0, '', []::VARCHAR[] FROM marked
  UNION ALL
  SELECT conv_id, nr, e, best.cost, best.audit, best.out FROM (
    SELECT conv_id, nr, e, min({'cost': cost, 'audit': audit, 'out': out}) AS best FROM (
      SELECT f.conv_id, m.nr, p.e AS e, f.cost + p.cost + 3 AS cost, f.audit || p.letters || 'D' AS audit, f.out || p.out AS out
      FROM folded f JOIN marked m ON m.conv_id IS NOT DISTINCT FROM f.conv_id AND m.nr = f.nr + 1 JOIN puts p ON p.s = f.s
      UNION ALL
      SELECT f.conv_id, m.nr, t.e, f.cost + p.cost + (CASE WHEN m.kind = t.wanted THEN 0 ELSE 2 END) + (CASE m.mark WHEN 't' THEN 1 ELSE 0 END),
        f.audit || p.letters || CASE WHEN m.kind = t.wanted THEN 'K' ELSE 'R' END,
        f.out || p.out || [CASE WHEN m.kind = t.wanted THEN m.role WHEN t.wanted = 'u' THEN 'user' ELSE 'assistant' END || ':' || m.text]
      FROM folded f JOIN marked m ON m.conv_id IS NOT DISTINCT FROM f.conv_id AND m.nr = f.nr + 1 JOIN puts p ON p.s = f.s JOIN takes t ON t.s = p.e
      WHERE m.mark NOT IN ('b', 'd') AND (m.kind = t.wanted OR t.wanted <> 's')
    ) GROUP BY conv_id, nr, e
  )
),
ended AS (
  SELECT f.conv_id, min({'cost': f.cost + p.cost, 'audit': f.audit || p.letters, 'out': f.out || p.out}) AS best
  FROM folded f JOIN (SELECT conv_id, max(nr) AS last FROM marked GROUP BY conv_id) l
    ON l.conv_id IS NOT DISTINCT FROM f.conv_id AND f.nr = l.last
  JOIN puts p ON p.s = f.s AND p.e IN ('n', 'a') GROUP BY f.conv_id
),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE mark = 'b') AS blank, count(*) FILTER (WHERE mark = 'd') AS duplicate, count(*) FILTER (WHERE mark = 't') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || kind NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
)
SELECT c.conv_id, coalesce(n.gaps, 0)::BIGINT AS gaps, coalesce(n.blank, 0)::BIGINT AS blank, coalesce(n.duplicate, 0)::BIGINT AS duplicate,
  coalesce(n.truncated, 0)::BIGINT AS truncated, coalesce(n.illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
  coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
