"""Structure repair of conversations: the cheapest edits to ``(s?(ua)+)?``.

A conversation's rows, by turn, become an optional system row and then user and
assistant rows in turn. Keeping a row costs 0, giving it the role that is due 1,
deleting it 2, inserting an empty row 5; a row that is cut off and not deleted
adds 5; blank rows and repeated ones must go. The edits are found by a Viterbi
whose survivors' common past is emitted as it becomes certain (``survivors``).

A task takes the sorted rows of many conversations one after another. One with
more than ``block_bytes`` of rows is cut into blocks of consecutive rows, which
are worked on apart:

1. Every block tells what it costs to pass it from each state to each state.
2. From the last block back, that gives what the rest costs after each state.
3. With it, every block finds the state it is left in for each state it is
   entered in; those maps, put together, give each block's true first state.
4. Every block finds its edits.

The blocks' edits are those of the whole: with the rest's cost known, a tie is
decided by the first edit that differs, and paths that pass the same rows differ
within the block where they part.

Defined cases: rows are taken by turn, those without one first, and by role and
text where turns are equal; a null role or text is one space. Rows without a
``conv_id`` are one conversation. Equal rows are kept apart, and all but the
first are duplicates. An empty table gives an empty result. Columns other than
``conv_id``, ``turn``, ``role`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.llm.common import written
from pactline.llm.survivors import (
    ASSISTANT,
    ENDING,
    INSERT,
    KEEP,
    NEVER,
    REROLE,
    REROLE_COST,
    DELETE,
    DELETE_COST,
    INSERT_COST,
    START,
    STATES,
    TRUNCATED_COST,
    USER,
    Survivors,
    Turn,
    passage_costs,
)

# Bytes of a conversation's rows that one task takes.
BLOCK_BYTES = 64 << 20
# Bytes a row counts besides its text.
ROW_BYTES = 64
WHITE = " \t\n\x0b\x0c\r"
# Characters of a text by which rows of one turn and role are dealt to blocks.
PREFIX = 256
# Edits handed on at once, and their characters.
FLUSH_ROWS, FLUSH_CHARACTERS = 1_000, 4 << 20

_EDITS = (
    "conv_id bigint, block int, step bigint, turn bigint, was string, fault string, "
    "edit string, cost bigint, role string, text string"
)
_COSTS = "conv_id bigint, block int, " + ", ".join(
    f"c{a}{b} bigint" for a in STATES for b in STATES
)
_ENDS = "conv_id bigint, block int, " + ", ".join(f"e{s} bigint" for s in STATES)
_EXITS = "conv_id bigint, block int, " + ", ".join(f"x{s} int" for s in STATES)
_DIGESTS = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
    "illegal bigint, cost bigint, audit string, repaired_sha256 string"
)
_ORDER = ("conv_id", "block", "turn", "role", "text")


def _columns(rows: DataFrame) -> DataFrame:
    """The four columns, checked, with what can be said of a text alone."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    plain = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    )
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    return plain.select(
        "*",
        F.when(end == "", "blank").when(~F.right(end, F.lit(1)).isin(*".!?"), "truncated").alias(
            "fault"
        ),
    )


class Row(NamedTuple):
    conv_id: int | None
    block: int
    turn: int | None
    role: str
    text: str
    fault: str | None
    # Equal rows this one stands for.
    copies: int
    # Whether role and text are seen in an earlier block.
    earlier: bool


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Row, tuple]]:
    """Rows of sorted batches, and what other columns say of their block."""
    for batch in batches:
        more = [batch.column(c).to_pylist() for c in batch.schema.names if c not in Row._fields]
        rest = zip(*more, strict=True) if more else [()] * batch.num_rows
        columns = (batch.column(c).to_pylist() for c in Row._fields)
        yield from zip(map(Row, *columns), rest, strict=True)


def _turns(rows: Iterator[tuple[Row, tuple]]) -> Iterator[tuple[tuple, tuple, Iterator[Turn]]]:
    """Conversation and block, what is known of it, and its turns with their faults."""
    ahead = next(rows, None)
    while ahead is not None:
        key = ahead[0].conv_id, ahead[0].block

        def own(key=key) -> Iterator[Turn]:
            nonlocal ahead
            seen = set()
            while ahead is not None and (ahead[0].conv_id, ahead[0].block) == key:
                row = ahead[0]
                name = row.role, hashlib.blake2b(row.text.encode(), digest_size=16).digest()
                for _ in range(row.copies):
                    fault = row.fault
                    if fault != "blank" and (row.earlier or name in seen):
                        fault = "duplicate"
                    seen.add(name)
                    yield Turn(row.role[:1], fault, row)
                ahead = next(rows, None)

        turns = own()
        yield key, ahead[1], turns
        for _ in turns:  # whatever was not asked for
            pass


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [kinds[field.split()[1]] for field in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


class _Edits:
    """Edits of one block as rows, in order."""

    def __init__(self, key: tuple, state: int, out: list[tuple]):
        self.key, self.state, self.out, self.step, self.held = key, state, out, 0, 0

    def __call__(self, edit: str, turn: Turn | None) -> None:
        row, role, text, cost = turn and turn.data, None, None, 0
        if edit == KEEP:
            role, text = row.role, row.text
            self.state = {"u": USER, "a": ASSISTANT}.get(turn.initial, self.state)
        elif edit == DELETE:
            cost = DELETE_COST
        else:
            self.state = ASSISTANT if self.state == USER else USER
            role = "user" if self.state == USER else "assistant"
            text, cost = (row.text, REROLE_COST) if edit == REROLE else ("", INSERT_COST)
        if edit in (KEEP, REROLE) and turn.fault:
            cost += TRUNCATED_COST
        about = (row.turn, row.role, turn.fault) if turn else (None, None, None)
        self.out.append((*self.key, self.step, *about, edit, cost, role, text))
        self.step += 1
        self.held += len(text or "")


def _editor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of every block; columns beside the rows' are its first state and its ending."""
    out: list[tuple] = []
    held = 0
    for key, known, turns in _turns(_rows(batches)):
        state, *ending = known if known else (START,)
        emit = _Edits(key, state, out)
        survivors = Survivors(emit, state)
        for turn in turns:
            survivors.step(turn)
            if len(out) >= FLUSH_ROWS or held + emit.held > FLUSH_CHARACTERS:
                yield _batch(out, _EDITS)
                out.clear()
                held = emit.held = 0
        survivors.finish(tuple(ending) if ending and ending[0] is not None else None)
        held += emit.held
    yield _batch(out, _EDITS)


def _pricer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What it costs to pass each block."""
    for key, _, turns in _turns(_rows(batches)):
        costs = passage_costs([turn._replace(data=None) for turn in turns])
        yield _batch([(*key, *(c for row in costs for c in row))], _COSTS)


def _leaver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each block is left in, for each state it is entered in."""
    for key, ending, turns in _turns(_rows(batches)):
        known = [Survivors(lambda edit, turn: None, s) for s in STATES]
        for turn in turns:
            for survivors in known:
                survivors.step(turn._replace(data=None))
        exits = (
            [s.finish(ending)[0] for s in known]
            if ending[0] is not None
            else [None] * len(STATES)
        )
        yield _batch([(*key, *exits)], _EXITS)


def _endings(costs: pd.DataFrame) -> pd.DataFrame:
    """What the rest costs after each block of a conversation; null after the last."""
    costs = costs.sort_values("block", ascending=False)
    out, after = [], None
    for row in costs.to_dict("records"):
        out.append((row["conv_id"], row["block"], *(after or [None] * len(STATES))))
        end = after or ENDING
        after = [
            min(min(row[f"c{a}{b}"] + end[b] for b in STATES), NEVER) for a in STATES
        ]
    names = ["conv_id", "block", *(f"e{s}" for s in STATES)]
    return pd.DataFrame(out, columns=names).astype("Int64")


def _entries(exits: pd.DataFrame) -> pd.DataFrame:
    """The state each block of a conversation is entered in."""
    state, out = START, []
    for row in exits.sort_values("block").to_dict("records"):
        out.append((row["conv_id"], row["block"], state))
        left = row[f"x{state}"]
        state = START if pd.isna(left) else int(left)
    return pd.DataFrame(out, columns=["conv_id", "block", "state"]).astype("Int64")


def _same(a: DataFrame, b: DataFrame, *names: str) -> F.Column:
    condition = F.lit(True)
    for name in names:
        condition &= a[name].eqNullSafe(b[name])
    return condition


def _sorted(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition(*keys).sortWithinPartitions(*_ORDER)


def _blocks(rows: DataFrame, block_bytes: int, weight: int) -> DataFrame:
    """Rows of long conversations with their block; equal rows are counted first."""
    folded = rows.groupBy("conv_id", "turn", "role", "text", "fault").agg(
        F.count(F.lit(1)).cast("int").alias("copies")
    )
    dealt = folded.repartitionByRange(
        weight // block_bytes + 1, "conv_id", "turn", "role", F.left("text", F.lit(PREFIX))
    )
    cut = written(dealt.withColumn("block", F.spark_partition_id()), "blocks")
    name = F.md5("text").alias("_name")
    first = (
        cut.select("conv_id", "role", name, "block")
        .groupBy("conv_id", "role", "_name")
        .agg(F.min("block").alias("_first"), F.max("block").alias("_last"))
        .where("_first < _last")
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), "_name", "_first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
    found = cut.join(first, same & (F.md5("text") == F.col("_name")), "left")
    earlier = F.coalesce(F.col("_first") < F.col("block"), F.lit(False)).alias("earlier")
    return written(found.select(*cut.columns, earlier), "blocks")


class Repair(NamedTuple):
    """Edits of conversations, each of them in order within a task."""

    whole: DataFrame
    # Of conversations in blocks; None where there are none.
    cut: DataFrame | None

    @property
    def edits(self) -> DataFrame:
        return self.whole if self.cut is None else self.whole.unionByName(self.cut)


def repair(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> Repair:
    """The edits, one row each, in the order ``conv_id``, ``block``, ``step``.

    ``turn``, ``was``, ``fault`` tell of the row an edit is for (null for an
    inserted one), ``role`` and ``text`` are the repaired row (null for a deleted
    one).
    """
    rows = _columns(rows)
    size = F.sum(F.octet_length("text").cast("bigint") + ROW_BYTES).alias("_bytes")
    long = written(
        rows.groupBy("conv_id").agg(size).where(F.col("_bytes") > block_bytes), "long"
    )
    weight = long.agg(F.sum("_bytes")).first()[0]
    one = [F.lit(0).alias("block"), F.lit(1).alias("copies"), F.lit(False).alias("earlier")]
    if not weight:
        return Repair(_sorted(rows.select("*", *one), "conv_id").mapInArrow(_editor, _EDITS), None)
    short = rows.join(long, _same(rows, long, "conv_id"), "left_anti").select("*", *one)
    parts = _blocks(rows.join(long, _same(rows, long, "conv_id"), "left_semi"), block_bytes, weight)
    apart = _sorted(parts, "conv_id", "block")
    costs = apart.mapInArrow(_pricer, _COSTS)
    ends = written(costs.groupBy("conv_id").applyInPandas(_endings, _ENDS), "endings")

    def knowing(about: DataFrame, *names: str) -> DataFrame:
        joined = parts.join(about, _same(parts, about, "conv_id", "block"))
        return _sorted(
            joined.select(*(parts[c] for c in parts.columns), *(about[c] for c in names)),
            "conv_id",
            "block",
        )

    costs_after = [f"e{s}" for s in STATES]
    exits = knowing(ends, *costs_after).mapInArrow(_leaver, _EXITS)
    entries = exits.groupBy("conv_id").applyInPandas(
        _entries, "conv_id bigint, block int, state int"
    )
    known = entries.join(ends, _same(entries, ends, "conv_id", "block")).select(
        entries["conv_id"], entries["block"], "state", *costs_after
    )
    edits = knowing(written(known, "entries"), "state", *costs_after)
    return Repair(
        _sorted(short, "conv_id").mapInArrow(_editor, _EDITS),
        written(edits.mapInArrow(_editor, _EDITS), "edits"),
    )


class _Digest:
    """What is said of one conversation, from its edits in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.cost = self.turns = 0
        self.first = self.last = self.initial = None
        self.audit: list[str] = []
        self.sha, self.lines = hashlib.sha256(), 0

    def add(self, turn, was, fault, edit, cost, role, text) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != INSERT:
            if fault:
                self.count[fault] += 1
            initial = was[:1]
            if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.initial = initial
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last = turn
                self.turns += 1
        if role is not None:
            self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        found = gaps, *self.count.values(), self.illegal, self.cost
        return self.conv_id, *found, "".join(self.audit), self.sha.hexdigest()


_ABOUT = ("turn", "was", "fault", "edit", "cost", "role", "text")


def _digester(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out = None, []
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        columns = (batch.column(c).to_pylist() for c in _ABOUT)
        for conv_id, *about in zip(ids, *columns, strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    out.append(now.row())
                now = _Digest(conv_id)
            now.add(*about)
        if len(out) >= FLUSH_ROWS:
            yield _batch(out, _DIGESTS)
            out = []
    if now is not None:
        out.append(now.row())
    yield _batch(out, _DIGESTS)


def digests(found: Repair) -> DataFrame:
    """One row per conversation that has rows: its faults, cost, edits and repaired text.

    A digest of a text is made from its start to its end, so the edits of a
    conversation in blocks pass through one task once more, in order and with
    nothing held but its edits' letters.
    """
    out = found.whole.mapInArrow(_digester, _DIGESTS)
    if found.cut is not None:
        again = found.cut.repartition("conv_id").sortWithinPartitions("conv_id", "block", "step")
        out = out.union(again.mapInArrow(_digester, _DIGESTS))
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as a bad export leaves them, by a checksum of conversation and turn.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes its sentence
    ends, 3 repeats it, 4 sets its role to user. Nulls count as one space.
    """
    conv_id, turn = (F.col(c).cast("bigint") for c in ("conv_id", "turn"))
    name = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)]
    kind = F.crc32(F.encode(F.concat(name[0], F.lit(":"), name[1]), "UTF-8")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        conv_id.alias("conv_id"),
        turn.alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("_times"),
    )
    each = F.explode(F.array_repeat(F.lit(0), F.col("_times")))
    return rows.select("*", each.alias("_each")).drop("_times", "_each")


def audited(conversations: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``digests`` of the damaged rows for every ``conv_id``, zeros where no row is left."""
    found = digests(repair(damaged(conversations), block_bytes))
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return ids.join(found, _same(ids, found, "conv_id"), "left").select(
        ids["conv_id"],
        *(F.coalesce(found[c], F.lit(nothing.get(c, 0))).alias(c) for c in found.columns[1:]),
    )


def _more(path, cost, edit):
    """A path (nine digits of cost, then edits) and one more edit."""
    total = f"format('{{:09d}}', CAST(substr({path}, 1, 9) AS INT) + {cost})"
    return f"({total} || substr({path}, 10) || '{edit}')"


def _oracle() -> str:
    """The result of ``audited`` in SQL: one recursive step per row, one path per state."""
    free = "fault IS DISTINCT FROM 'blank' AND fault IS DISTINCT FROM 'duplicate'"
    late = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"

    def may(initial, *paths):
        ways = [
            f"CASE WHEN {free} AND initial = '{initial}' THEN {_more(p, late, 'K')} END"
            for p in paths
        ]
        if initial != "s":
            ways += [
                f"CASE WHEN {free} THEN {_more(p, f'1 + {late}', 'R')} END" for p in paths
            ]
        return ", ".join(ways)

    return f"""
WITH RECURSIVE bits(i, c, n) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n + 1
  FROM bits WHERE n < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE n = 8
), kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda x: ascii(x)::BIGINT)),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS time
  FROM kinds
), numbered AS (
  SELECT *, substr(role, 1, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
      WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM numbered
), walk(conv_id, n, s0, s1, s2, s3) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, '000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR
  FROM faulty
  UNION ALL
  SELECT conv_id, n, {_more('p0', 2, 'D')},
    least({_more('p1', 2, 'D')}, {may('s', 'p0')}),
    least({_more('p2', 2, 'D')}, {may('u', 'p0', 'p1', 'p3')}),
    least({_more('p3', 2, 'D')}, {may('a', 'p2')})
  FROM (
    SELECT f.conv_id, f.n, f.initial, f.fault, s0 AS p0, s1 AS p1,
      least(s2, {_more('s0', 5, 'I')}, {_more('s1', 5, 'I')}, {_more('s3', 5, 'I')}) AS p2,
      least(s3, {_more('s2', 5, 'I')}, {_more('s0', 10, 'II')}, {_more('s1', 10, 'II')}) AS p3
    FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
  )
), ends AS (
  SELECT conv_id, n, least(s0, s3, {_more('s2', 5, 'I')}, {_more('s1', 10, 'II')}) AS path
  FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1
), edits AS (
  SELECT conv_id, unnest(string_split(substr(path, 10), '')) AS edit,
    generate_subscripts(string_split(substr(path, 10), ''), 1) AS i
  FROM ends
), placed AS (
  SELECT *, sum(CASE WHEN edit = 'I' THEN 0 ELSE 1 END) OVER w AS n,
    sum(CASE WHEN edit = 'D' THEN 0 ELSE 1 END) OVER w AS place
  FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY i)
), made AS (
  SELECT p.conv_id, p.i, p.edit, p.place, f.role,
    CASE WHEN edit = 'I' THEN '' ELSE f.text END AS text,
    max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END)
      OVER (PARTITION BY p.conv_id) AS lead
  FROM placed p LEFT JOIN faulty f
    ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.n
  WHERE p.edit <> 'D'
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role
      WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY i) AS text
  FROM made GROUP BY conv_id
), facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(CAST(substr(path, 1, 9) AS BIGINT), 0) AS cost,
  coalesce(substr(path, 10), '') AS audit, sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLE = _oracle()
