"""Cheapest repair of the turns of conversations, solved on a suffix-shared automaton of their signatures.

A row counts for the repair only by its role's initial and its fault, so a block of rows is a short signature.
Signatures that end alike share their ends: a node of the automaton is a rest that is still to be read, and for
each grammar state it has the cost to go and the best next edits, found once for all conversations. Blocks of a
long conversation are joined through the grammar states at their borders.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tapeloom.llm.runtime import arrow_map, column, quoted, sized, stored

#: Turns that share a block, and rows from which such a block is cut further, by turn and digest.
BLOCK_TURNS, BLOCK_ROWS = 256, 512

#: Blocks with one signature from which it is joined apart; rows per Arrow batch of results.
HOT, ROWS_AT_ONCE = 20_000, 1_000

#: Costs of the edits; a truncated row that stays costs as much as a new one.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Grammar ``(s?(ua)+)?``: 0 nothing yet, 1 after the system row, 2 after a user's, 3 after an assistant's.
STATES = range(4)
#: The state after a user or assistant row that may come next, and that row's initial.
NEXT, TURN = (2, 2, 3, 2), "uuau"
#: What it takes to end in a state.
TAIL = ("", "II", "I", "")

#: Signature letters: initial of a sound row (x: none of the three), upper case if truncated, - if it must go.
GONE = "-"
SHARED = 8  # signatures are dealt out by their last letters, so that those which share an end meet

ROLES = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"


def steps(letter: str) -> list[list[tuple[int, str, int]]]:
    """Per grammar state: (cost, edits, next state) of each way to handle a row, inserts before it included."""
    initial, extra = letter.lower(), TRUNCATED if letter.isupper() else 0
    ways: list[list[tuple[int, str, int]]] = []
    for state in STATES:
        found, at, before = [], state, ""
        for inserted in range(3):  # two inserts come back to the same next row
            paid = inserted * INSERT
            found.append((paid + DELETE, before + "D", at))
            if letter != GONE:
                found.append((paid + REROLE + extra, before + "R", NEXT[at]))
                if initial == TURN[at]:
                    found.append((paid + extra, before + "K", NEXT[at]))
                elif initial == "s" and at == 0:
                    found.append((paid + extra, before + "K", 1))
            at, before = NEXT[at], before + "I"
        ways.append(found)
    return ways


STEPS = {letter: steps(letter) for letter in "suaxSUAX" + GONE}

#: The cost to go from a state that no edits lead out of.
UNREACHED = 1 << 62

#: Cost to go and edits per (state at the start, state at the end) of an empty rest.
END = [[(0, "") if a == b else None for b in STATES] for a in STATES]


def before(letter: str, rest: list) -> list:
    """The node of ``letter`` and a rest, from the node of the rest.

    Edits of equal cost are compared by their first difference. Two ways that begin alike go on from the same
    state, and no row's edits are the beginning of another's, so the least of whole texts is the least here.
    """
    node = []
    for ways in STEPS[letter]:
        best: list = [None] * 4
        for cost, edits, state in ways:
            for end, known in enumerate(rest[state]):
                if known:
                    total, own = cost + known[0], best[end]
                    if own is None or total < own[0] or (total == own[0] and edits + known[1] < own[1]):
                        best[end] = (total, edits + known[1])
        node.append(best)
    return node


def solve(signatures):
    """(signature, its node) for signatures in the order of their reversed letters.

    In that order a node that is left is not met again, so only the nodes of the latest signature are kept.
    """
    path, latest = [END], ""
    for signature in signatures:
        letters = signature[::-1]
        common = 0
        for common, (a, b) in enumerate(zip(letters, latest)):
            if a != b:
                break
        else:
            common = min(len(letters), len(latest))
        del path[common + 1 :]
        for letter in letters[common:]:
            path.append(before(letter, path[-1]))
        latest = letters
        yield signature, path[-1]


def cheapest(nodes: list[list]) -> list[tuple[int, str, int]]:
    """(state at the start, edits, cost to go) of each block of a conversation, from the blocks' nodes."""
    to_go = [INSERT * len(t) for t in TAIL]
    tails, ways = list(TAIL), []
    for node in reversed(nodes):
        picks = []
        for row in node:
            ends = [(w[0] + to_go[e], w[1] + tails[e], e) for e, w in enumerate(row) if w]
            picks.append(min(ends) if ends else (UNREACHED, "", 0))
        to_go, tails = [p[0] for p in picks], [""] * 4
        ways.append(picks)
    out, state = [], 0
    for picks in reversed(ways):
        cost, edits, end = picks[state]
        out.append((state, edits, cost))
        state = end
    return out


ENDS = re.compile(r"[.!?]\Z")


def faults(rows, earlier=frozenset()) -> tuple[str, str]:
    """(signature, fault per row) of a block's rows (role, text, digest, copies); b, d, t or a space for none.

    ``earlier`` holds the digests of rows in blocks before this one.
    """
    letters, marks, seen = [], [], set(earlier)
    for role, text, digest, copies in rows:
        solid = text.strip(BLANKS)
        for _ in range(copies):
            if not solid:
                mark = "b"
            elif digest in seen:
                mark = "d"
            else:
                mark = " " if ENDS.search(solid) else "t"
            seen.add(digest)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters.append(GONE if mark in "bd" else initial.upper() if mark == "t" else initial)
            marks.append(mark)
    return "".join(letters), "".join(marks)


def repaired(rows, audit: str, state: int):
    """The rows (role, text) that the edits give, from a grammar state on."""
    left = ((r["role"], r["text"]) for r in rows for _ in range(r["copies"]))
    for edit in audit:
        if edit == "I":
            yield ROLES[TURN[state]], ""
            state = NEXT[state]
            continue
        role, text = next(left)
        if edit == "R":
            role = ROLES[TURN[state]]
        if edit != "D":
            state = 1 if state == 0 and role[:1] == "s" else NEXT[state]
            yield role, text


def in_blocks(turns: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, copies) put into blocks (conv, block): row arrays in order, stored.

    A block has the turns of one stretch of ``BLOCK_TURNS``; where more than ``BLOCK_ROWS`` rows share it, it is
    cut by turn and by leading digits of the rows' digests. There equal rows of a turn become one row with a
    count first, so that not even a row that is repeated without end is gathered.
    """
    stretch = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(2**62)))
    sizes = turns.groupBy("conv", stretch.alias("stretch")).count().where(F.col("count") > BLOCK_ROWS)
    digits = F.ceil(F.log2(F.col("count") / BLOCK_ROWS) / 4).cast("int").alias("digits")
    wide = sized(stored(sizes.select(F.struct("conv").alias("conv_key"), "stretch", digits), "wide_blocks"))
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    rows = turns.withColumns({"conv_key": F.struct("conv"), "stretch": stretch, "digest": F.when(F.col("copies") > 0, digest)})
    entry = ["turn", "digest", "role", "text", "copies"]

    def block(turn: Column, part: Column) -> Column:
        return F.struct("stretch", turn.cast("long").alias("turn"), part.cast("string").alias("part")).alias("block")

    plain = rows.join(wide, ["conv_key", "stretch"], "left_anti").select("conv", block(F.lit(None), F.lit(None)), *entry)
    part = F.coalesce(F.expr("substring(digest, 1, digits)"), F.lit(""))
    repeated = rows.join(wide, ["conv_key", "stretch"]).groupBy("conv", "stretch", "digits", *entry[:-1])
    repeated = repeated.agg(F.sum("copies").alias("copies"))
    repeated = repeated.select("conv", block(F.coalesce("turn", F.lit(-(2**62))), part), *entry)
    blocks = plain.unionByName(repeated).groupBy("conv", "block").agg(F.array_sort(F.collect_list(F.struct(*entry))).alias("rows"))
    return stored(blocks, "turn_blocks")


def seen_before(blocks: DataFrame) -> DataFrame:
    """(conv, block, earlier): digests of a block's rows that an earlier block of the conversation has too."""
    several = blocks.groupBy("conv").agg(F.min("block").alias("first"), F.max("block").alias("last"))
    several = several.where(F.col("first") < F.col("last")).select(F.struct("conv").alias("key"))
    digests = F.explode(F.array_distinct(F.transform("rows", lambda r: r["digest"])))
    held = (
        blocks.withColumn("key", F.struct("conv"))
        .join(several, "key", "left_semi")
        .select("key", "block", digests.alias("digest"))
        .where(F.col("digest").isNotNull())
    )
    first = held.groupBy("key", "digest").agg(F.min("block").alias("first"), F.max("block").alias("last"))
    first = first.where(F.col("first") < F.col("last"))
    again = held.join(first, ["key", "digest"]).where(F.col("block") > F.col("first"))
    return again.groupBy("key", "block").agg(F.collect_set("digest").alias("earlier"))


def signed(blocks: DataFrame) -> DataFrame:
    """(conv, block, signature, marks) of the blocks, stored: letters and faults, without the texts."""
    kind = blocks.schema["conv"].dataType.simpleString()
    place = blocks.schema["block"].dataType.simpleString()
    rows = blocks.withColumn("key", F.struct("conv")).join(seen_before(blocks), ["key", "block"], "left")

    def sign(batches):
        for batch in batches:
            signs, marks = [], []
            for entries, earlier in zip(column(batch, "rows"), column(batch, "earlier")):
                present = [(e["role"], e["text"], e["digest"], e["copies"]) for e in entries if e["copies"]]
                one, two = faults(present, earlier or ())
                signs.append(one)
                marks.append(two)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(signs, pa.string()), pa.array(marks, pa.string())],
                ["conv", "block", "signature", "marks"],
            )

    schema = f"conv {kind}, block {place}, signature string, marks string"
    return stored(arrow_map(rows.select("conv", "block", "rows", "earlier"), sign, schema), "signed_blocks")


def solved(signatures: DataFrame) -> DataFrame:
    """(signature, n, ways) per distinct signature, with its rows counted: its node, row by row."""

    def work(batches):
        def read():
            for batch in batches:
                for signature, n in zip(column(batch, "signature"), column(batch, "n")):
                    counts.append(n)
                    yield signature

        counts, found = [], []
        for signature, node in solve(read()):
            ways = [w and {"cost": w[0], "edits": w[1]} for row in node for w in row]
            found.append({"signature": signature, "n": counts.pop(), "ways": ways})
            if len(found) == ROWS_AT_ONCE:
                yield pa.RecordBatch.from_pylist(found, schema)
                found = []
        yield pa.RecordBatch.from_pylist(found, schema)

    way = pa.struct([("cost", pa.int64()), ("edits", pa.string())])
    schema = pa.schema([("signature", pa.string()), ("n", pa.int64()), ("ways", pa.list_(way))])
    parts = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        signatures.groupBy("signature")
        .agg(F.count("*").alias("n"))
        .withColumn("reversed", F.reverse("signature"))
        .repartition(parts, F.substring("reversed", 1, SHARED))
        .sortWithinPartitions("reversed")
        .select("signature", "n")
    )
    return stored(arrow_map(dealt, work, "signature string, n long, ways array<struct<cost:long,edits:string>>"), "signatures")


def with_ways(blocks: DataFrame) -> DataFrame:
    """(conv, block, ways): each block with the node of its signature.

    Signatures of many blocks are few, so these are joined apart, without a shuffle of their blocks.
    """
    nodes = solved(blocks.select("signature"))
    rows = blocks.select("conv", "block", "signature")
    hot, rest = (nodes.where(c).select("signature", "ways") for c in (F.col("n") > HOT, F.col("n") <= HOT))
    hot = sized(hot)
    apart = rows.join(hot, "signature")
    others = rows.join(hot.select("signature"), "signature", "left_anti").join(rest, "signature")
    return apart.unionByName(others).select("conv", "block", "ways")


def by_conversation(rows: DataFrame, *then: str) -> DataFrame:
    """Partitions with whole conversations, their blocks in order; read as streams, so held block by block."""
    return rows.repartition("conv").sortWithinPartitions("conv", "block", *then)


def conversations_of(batches):
    def rows():
        for batch in batches:
            for k in range(batch.num_rows):
                yield batch.slice(k, 1).to_pylist()[0]

    return groupby(rows(), key=lambda r: r["conv"])


def in_batches(rows, schema):
    found = []
    for row in rows:
        found.append(row)
        if len(found) == ROWS_AT_ONCE:
            yield pa.RecordBatch.from_pylist(found, schema)
            found = []
    yield pa.RecordBatch.from_pylist(found, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


@dataclass(frozen=True)
class Edited:
    """``blocks`` (conv, block, rows) and ``plan`` (conv, block, marks, state, edits, cost), both stored.

    ``block`` sorts the blocks of a conversation; rows hold turn, digest, role, text and copies; marks the fault of
    each row (b, d, t or a space); state is that of the grammar at the block's start, cost what it takes from there.
    """

    blocks: DataFrame
    plan: DataFrame

    def streamed(self) -> DataFrame:
        """Each block's plan right before its rows: the texts are shuffled once, by conversation."""
        names = ("marks", "state", "edits", "cost")
        rows = self.blocks.select("*", *[F.lit(None).cast(self.plan.schema[c].dataType).alias(c) for c in names])
        plan = self.plan.select("conv", "block", F.lit(None).cast(self.blocks.schema["rows"].dataType).alias("rows"), *names)
        both = plan.unionByName(rows).withColumn("has_rows", F.col("rows").isNotNull())
        return by_conversation(both, "has_rows")


def edits(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    copies_col: str | None = None,
) -> Edited:
    """The blocks of all conversations with their cheapest edits.

    A row counts ``copies_col`` times (once without it); with 0 it only brings its conversation into the result.
    Rows are ordered by turn (null first), then by a digest of role and text. A null role or text is one space,
    rows without an id are one conversation, other columns are not looked at.
    """
    copies = F.col(quoted(copies_col)).cast("long") if copies_col else F.lit(1).cast("long")
    present = copies > 0
    turns = conversations.select(
        F.col(quoted(id_col)).alias("conv"),
        F.when(present, F.col(quoted(turn_col)).cast("long")).alias("turn"),
        F.when(present, F.coalesce(F.col(quoted(role_col)), F.lit(" "))).alias("role"),
        F.when(present, F.coalesce(F.col(quoted(text_col)), F.lit(" "))).alias("text"),
        F.when(present, copies).otherwise(F.lit(0).cast("long")).alias("copies"),
    )
    blocks = in_blocks(turns)
    signatures = signed(blocks)
    kind, place = (blocks.schema[c].dataType.simpleString() for c in ("conv", "block"))
    ddl = f"conv {kind}, block {place}, state int, edits string, cost long"
    schema = arrow_schema(ddl)

    def work(batches):
        def found():
            for conv, rows in conversations_of(batches):
                places, nodes = [], []
                for row in rows:
                    flat = [w and (w["cost"], w["edits"]) for w in row["ways"]]
                    places.append(row["block"])
                    nodes.append([flat[4 * a : 4 * a + 4] for a in STATES])
                for block, (state, own, cost) in zip(places, cheapest(nodes)):
                    yield {"conv": conv, "block": block, "state": state, "edits": own, "cost": cost}

        return in_batches(found(), schema)

    picked = arrow_map(by_conversation(with_ways(signatures)), work, ddl)
    key = F.struct("conv").alias("key")
    plan = signatures.select("*", key).join(picked.select(key, "block", "state", "edits", "cost"), ["key", "block"])
    return Edited(blocks, stored(plan.select("conv", "block", "marks", "state", "edits", "cost"), "edited_blocks"))


def whole_blocks(rows):
    """The blocks of a conversation as its stream gives them: plan and rows put together."""
    for plan, block in zip(rows, rows):
        yield {**plan, "rows": block["rows"]}


def repaired_turns(edited: Edited, id_col: str = "conv_id") -> DataFrame:
    """The repaired conversations as rows (id, block, place in the block, role, text)."""
    kind, place = (edited.plan.schema[c].dataType.simpleString() for c in ("conv", "block"))
    ddl = f"conv {kind}, block {place}, place int, role string, text string"
    schema = arrow_schema(ddl)

    def work(batches):
        def found():
            for conv, rows in conversations_of(batches):
                for b in whole_blocks(rows):
                    for k, (role, text) in enumerate(repaired(b["rows"], b["edits"], b["state"])):
                        yield {"conv": conv, "block": b["block"], "place": k, "role": role, "text": text}

        return in_batches(found(), schema)

    return arrow_map(edited.streamed(), work, ddl).withColumnRenamed("conv", id_col)


#: Pairs of role initials that may follow one another.
LEGAL = {"su", "ua", "au"}


def summary(conv, blocks) -> dict:
    """Faults, cost, edits and digest of one conversation, read block by block."""
    out = {"conv": conv, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
    audit, digest, sep, last = [], hashlib.sha256(), "", None
    first_turn = last_turn = None
    turns = 0
    for k, b in enumerate(whole_blocks(blocks)):
        for name, mark in (("blank", "b"), ("duplicate", "d"), ("truncated", "t")):
            out[name] += b["marks"].count(mark)
        for entry in b["rows"]:
            turn, initial = entry["turn"], (entry["role"] or "")[:1]
            for _ in range(entry["copies"]):
                out["illegal"] += last is not None and last + initial not in LEGAL
                last = initial
            if entry["copies"] and turn is not None and turn != last_turn:
                first_turn = turn if first_turn is None else first_turn
                last_turn = turn
                turns += 1
        if k == 0:
            out["cost"] = b["cost"]
        audit.append(b["edits"])
        for role, text in repaired(b["rows"], b["edits"], b["state"]):
            digest.update(f"{sep}{role}:{text}".encode())
            sep = "\n"
    if turns:
        out["gaps"] = last_turn - first_turn + 1 - turns
    return {**out, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def repair(conversations: DataFrame, id_col: str = "conv_id", **columns) -> DataFrame:
    """Per conversation: id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``columns`` as in ``edits``. A row's first fault counts: blank (white space only), duplicate (role and text
    seen earlier), truncated (does not end in . ! ?). Gaps are turns missing between the least and the largest,
    illegal the neighbouring rows whose roles' initials are not su, ua or au. The audit has the initial of each
    edit (Keep, Rerole, Delete, Insert) of the cheapest repair to ``(s?(ua)+)?``, ties by the least text;
    the digest is that of the repaired ``role:text`` joined by newlines. Without rows all is 0 or empty. An empty
    table has no conversations.

    The texts of a conversation pass through one task for the digest, block by block; its audit is one cell.
    """
    edited = edits(conversations, id_col, **columns)
    kind = edited.plan.schema["conv"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    ddl = f"conv {kind}, {counts}, audit string, repaired_sha256 string"
    schema = arrow_schema(ddl)

    def work(batches):
        return in_batches((summary(c, b) for c, b in conversations_of(batches)), schema)

    return arrow_map(edited.streamed(), work, ddl).withColumnRenamed("conv", id_col)
