"""Damage conversations on purpose, count their faults and repair them with the cheapest edits (parallel Viterbi).

The repaired roles must read ``(s?(ua)+)?``, a machine of four states (start, after system, after user,
after assistant). For every place of a conversation there is a cost vector: the least cost of the edits from
there on, for each state. A step of the backward recurrence adds and takes minima only, so vectors that
differ by a constant stay so: *shapes* (vectors less their minimum) are all that decides the edits.

A conversation is cut into chunks of ``CHUNK`` rows, and the chunks of all conversations, one short string each, are
dealt to partitions by range, so only the conversations at the edges of a partition span two. All partitions run
backward at once; a piece that begins inside a conversation starts from a speculative vector. Fix-up passes rerun
the pieces whose true vector has another shape, up to the first chunk at which the shapes agree (rank convergence: from
there on they differ only by a constant), until none is left. Then every chunk traces its edits from its
stitched vector for each state in which it can be entered, always the ASCII-least edit that keeps the least
cost, and the states are chained from chunk to chunk. The driver sees two rows for each partition at most.

The digest of a repaired conversation is sequential by its nature: its rows stream through one task in
order, which holds none of them. All other steps spread a conversation's rows over tasks.

Defined results: a null is one space; rows of one turn stand in order of role and text; a null conv_id is a conversation
of its own; repeated rows are rows; a role that does not begin with s, u or a can only be changed or deleted;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salesflow.llm.common import freed_shuffles, written
from salesflow.operators.blocks import null_safe_join, row_index

CHUNK = 4096
#: costs of the edits
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
_GOES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: the state after an inserted or changed turn: assistant after user, else user
_TURNS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
_INITIALS, _FAULTS = "suax", ("", "blank", "duplicate", "truncated")
#: least costs at the end, for each state: nothing; user and assistant; assistant; nothing
END = (0, 2 * INSERT, INSERT, 0)
_SPACE = r"\x20\x09-\x0D"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows dropped, emptied, cut, repeated and turned to ``user`` by crc32(conv_id:turn) % 20."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("r"))
    text = F.when(F.col("r") == 1, "").when(F.col("r") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("r") == 4, "user").otherwise(F.col("role"))
    rows = rows.where("r <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), "r")
    twice = F.when(F.col("r") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(twice)).select("conv_id", "turn", "role", "text")


def in_order(rows: DataFrame) -> DataFrame:
    """With ``pos``, the place in the conversation from 0."""
    with freed_shuffles(rows.sparkSession):
        return written(row_index(rows, ["turn", "role", "text"], ["conv_id"], "pos"), "repair-rows")


def fault_codes(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, code): one hexadecimal digit for each row, 4 * initial + first fault."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial == "s", 0).when(initial == "u", 4).when(initial == "a", 8).otherwise(12)
    blank = ~F.col("text").rlike(f"[^{_SPACE}]")
    truncated = ~F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")
    light = rows.select("conv_id", "pos", initial.alias("initial"), blank.alias("blank"), truncated.alias("truncated"),
                        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(CHUNK), "text", "role").alias("h2"))
    firsts = light.groupBy("conv_id", "h1", "h2").agg(F.min("pos").alias("pos")).select("conv_id", "pos", F.lit(True).alias("first"))
    light = null_safe_join(light, firsts, ["conv_id", "pos"], "left")
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("truncated"), 3).otherwise(0)
    return light.select("conv_id", "pos", F.lower(F.hex((F.col("initial") + fault).cast("long"))).alias("code"))


def chunk_table(codes: DataFrame, size: int = CHUNK) -> DataFrame:
    """(piece, conv_id, chunk, last, codes): a piece is what one range partition holds, chunks descending; written."""
    def chunk_of(pos: str) -> Column:
        return F.floor(F.col(pos) / size).cast("long")

    chunks = codes.groupBy("conv_id", chunk_of("pos").alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("c"))
    ends = codes.groupBy("conv_id").agg(F.max("pos").alias("end"))
    chunks = null_safe_join(chunks, ends.select("conv_id", chunk_of("end").alias("final")), ["conv_id"])
    chunks = chunks.select("conv_id", "chunk", (F.col("chunk") == F.col("final")).alias("last"), F.array_join("c.code", "").alias("codes"))
    order = [F.col("conv_id"), F.col("chunk").desc()]
    dealt = chunks.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.select(F.spark_partition_id().alias("piece"), "*"), "repair-chunks")


def _least(vector: tuple) -> tuple:
    low = min(vector)
    return tuple(v - low for v in vector)


class Steps:
    """The backward step for each (shape, code), and the edits that it takes from each state; all of them are few."""

    def __init__(self):
        self.known: dict = {}

    def __call__(self, shape: tuple, code: str) -> tuple:
        """(shape before the row, for each state: edits up to and with the row, state after it, cost)."""
        got = self.known.get((shape, code))
        if got is None:
            got = self.known[shape, code] = self._step(shape, code)
        return got

    @staticmethod
    def _step(after: tuple, code: str) -> tuple:
        initial, fault = _INITIALS[int(code, 16) >> 2], _FAULTS[int(code, 16) & 3]
        more = TRUNCATED if fault == "truncated" else 0
        ways = []  # for each state: (letter, state after, cost) of the row's own edits, in ASCII order
        for q in range(4):
            way = [("D", q, DELETE)]
            if fault not in ("blank", "duplicate"):
                if (q, initial) in _GOES:
                    way.append(("K", _GOES[q, initial], more))
                way.append(("R", _TURNS[q], REROLE + more))
            ways.append(way)
        own = [min(cost + after[to] for _, to, cost in way) for way in ways]
        best = list(own)
        for _ in range(2):  # an insertion leads to another state, two at most pay
            best = [min(own[q], INSERT + best[_TURNS[q]]) for q in range(4)]
        edits = []
        for q in range(4):
            letters, state, spent = "", q, 0
            while True:
                left = best[state]
                letter, to, cost = min((way for way in [*ways[state], ("I", _TURNS[state], INSERT)]
                                        if way[2] + (best if way[0] == "I" else after)[way[1]] == left))
                letters, state, spent = letters + letter, to, spent + cost
                if letter != "I":
                    break
            edits.append((letters, state, spent))
        return _least(tuple(best)), tuple(edits)


def _text_of(shape: tuple) -> str:
    return ",".join(map(str, shape))


def _shape_of(text: str) -> tuple:
    return tuple(map(int, text.split(",")))


_VECTORS = "piece int, conv_id {key}, chunk long, last boolean, codes string, right string, left string, spans boolean"


def _by_piece(table: DataFrame, ascending: bool) -> DataFrame:
    chunk = F.col("chunk") if ascending else F.col("chunk").desc()
    return table.repartition("piece").sortWithinPartitions("piece", "conv_id", chunk)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _packed(rows: Iterator[dict], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def _backward(chunks: DataFrame, entries: dict[int, str]) -> DataFrame:
    """Vectors at both ends of each chunk. ``entries``: vectors of pieces that begin inside a conversation, else speculative.

    With the vectors of an earlier pass (``right``, ``left``) a rerun keeps them from the first chunk on at which shapes agree.
    """
    key = chunks.schema["conv_id"].dataType
    schema = pa.schema([("piece", pa.int32()), ("conv_id", to_arrow_type(key)), ("chunk", pa.int64()), ("last", pa.bool_()),
                        ("codes", pa.string()), ("right", pa.string()), ("left", pa.string()), ("spans", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = Steps()

        def each():
            here, shape, spans, agreed = None, None, False, False
            for r in _rows(batches):
                if (r["piece"], r["conv_id"]) != here:
                    here, agreed, spans = (r["piece"], r["conv_id"]), False, not r["last"]
                    shape = _least(END) if r["last"] else _shape_of(entries.get(r["piece"], "0,0,0,0"))
                if agreed or r.get("right") == _text_of(shape):
                    agreed = True
                    yield {n: r[n] for n in schema.names}
                    continue
                right = _text_of(shape)
                for code in reversed(r["codes"]):
                    shape = step(shape, code)[0]
                yield {**{n: r[n] for n in ("piece", "conv_id", "chunk", "last", "codes")}, "right": right, "left": _text_of(shape), "spans": spans}

        yield from _packed(each(), schema)

    return _by_piece(chunks, False).mapInArrow(run, _VECTORS.format(key=key.simpleString()))


def stitched(chunks: DataFrame) -> DataFrame:
    """Backward vectors of all chunks, right up to a constant, and the number of fix-up passes (attribute ``passes``)."""
    current = base = written(_backward(chunks, {}), "repair-vectors")

    # the ends of a conversation's share of a piece that goes on in another: two shares for each piece at most
    def edges(table: DataFrame) -> dict[int, tuple]:
        group = table.where("spans or chunk > 0").groupBy("piece", "conv_id", "spans").agg(
            F.max_by("right", "chunk").alias("right"), F.min_by("left", "chunk").alias("left"), F.min("chunk").alias("low"))
        return {(r["piece"], r["spans"]): r for r in group.where("spans or low > 0").collect()}

    known, replaced, passes = edges(base), {}, 0
    while True:
        stale = {}
        for (piece, spans), r in known.items():
            if spans:
                before = [k for k in known if k[0] < piece and known[k]["low"] > 0]
                source = known[max(before)]
                if source["left"] != r["right"]:
                    stale[piece] = source["left"]
        if not stale:
            break
        passes += 1
        parts = [base.where(F.col("spans") & F.col("piece").isin([p for p in stale if p not in replaced]))]
        parts += [t.where(F.col("piece").isin([p for p in stale if replaced.get(p) is t])) for t in {id(t): t for t in replaced.values()}.values()]
        rerun = parts[0]
        for t in parts[1:]:
            rerun = rerun.unionByName(t)
        table = written(_backward(rerun, stale), "repair-vectors")
        replaced.update(dict.fromkeys(stale, table))
        known.update(edges(table))
    if replaced:
        current = base.where(~(F.col("spans") & F.col("piece").isin(list(replaced))))
        for t in {id(t): t for t in replaced.values()}.values():
            current = current.unionByName(t.where(F.col("piece").isin([p for p, x in replaced.items() if x is t])))
    current.passes = passes
    current.spanning = bool(known)
    return current


def _traces(vectors: DataFrame) -> DataFrame:
    """Each chunk's least edits, cost and last state for each state it may be entered in."""
    key = vectors.schema["conv_id"].dataType
    schema = pa.schema([("piece", pa.int32()), ("conv_id", to_arrow_type(key)), ("chunk", pa.int64()), ("last", pa.bool_()),
                        ("audits", pa.list_(pa.string())), ("exits", pa.list_(pa.int32())), ("costs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = Steps()

        def each():
            for r in _rows(batches):
                shape, moves = _shape_of(r["right"]), []
                for code in reversed(r["codes"]):
                    shape, edits = step(shape, code)
                    moves.append(edits)
                audits, exits, costs = [], [], []
                for q in range(4) if r["chunk"] else [START]:
                    out, state, spent = [], q, 0
                    for edits in reversed(moves):
                        letters, state, cost = edits[state]
                        out.append(letters)
                        spent += cost
                    if r["last"]:
                        while END[state]:
                            out.append("I")
                            state, spent = _TURNS[state], spent + INSERT
                    audits.append("".join(out)), exits.append(state), costs.append(spent)
                yield {**{n: r[n] for n in ("piece", "conv_id", "chunk", "last")}, "audits": audits, "exits": exits, "costs": costs}

        yield from _packed(each(), schema, 64)

    return vectors.mapInArrow(run, f"piece int, conv_id {key.simpleString()}, chunk long, last boolean, audits array<string>, "
                                   "exits array<int>, costs array<long>")


def edits(vectors: DataFrame) -> DataFrame:
    """(conv_id, chunk, audit, cost) of every chunk, its entry state chained from the conversation's start."""
    key = vectors.schema["conv_id"].dataType
    traces = written(_traces(vectors), "repair-traces")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(piece, exits) of a conversation's share of a piece, when it begins or ends elsewhere."""
        schema = pa.schema([("piece", pa.int32()), ("low", pa.int64()), ("whole", pa.bool_()), ("exits", pa.list_(pa.int32()))])

        def each():
            here, row = None, None
            for r in _rows(batches):
                if (r["piece"], r["conv_id"]) != here:
                    if row and (row["low"] or not row["whole"]):
                        yield row
                    here, row = (r["piece"], r["conv_id"]), {"piece": r["piece"], "low": r["chunk"], "exits": r["exits"]}
                else:
                    row["exits"] = [r["exits"][q] for q in row["exits"]]
                row["whole"] = r["last"]
            if row and (row["low"] or not row["whole"]):
                yield row

        yield from _packed(each(), schema)

    entries: dict[int, int] = {}
    if vectors.spanning:
        shares = _by_piece(traces, True).mapInArrow(chained, "piece int, low long, whole boolean, exits array<int>").collect()
        state = START  # pieces hold descending chunks: a conversation begins in its last piece
        for r in sorted(shares, key=lambda r: (-r["piece"], r["low"] == 0)):
            if r["low"]:
                entries[r["piece"]] = state
                state = r["exits"][state]
            else:
                state = r["exits"][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", to_arrow_type(key)), ("chunk", pa.int64()), ("audit", pa.string()), ("cost", pa.int64())])

        def each():
            here, state = None, START
            for r in _rows(batches):
                if (r["piece"], r["conv_id"]) != here:
                    here, state = (r["piece"], r["conv_id"]), entries.get(r["piece"], START) if r["chunk"] else START
                yield {"conv_id": r["conv_id"], "chunk": r["chunk"], "audit": r["audits"][state], "cost": r["costs"][state]}
                state = r["exits"][state]

        yield from _packed(each(), schema, 64)

    return _by_piece(traces, True).mapInArrow(run, f"conv_id {key.simpleString()}, chunk long, audit string, cost long")


def repair(conversations: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per conv_id: gaps, faults, least cost, its edits and the digest of the repaired conversation."""
    rows = in_order(damage(conversations))
    codes = written(fault_codes(rows), "repair-codes")
    vectors = stitched(chunk_table(codes, size))
    changes = edits(vectors)
    out = report(conversations, rows, codes, changes, size)
    out.passes = vectors.passes
    return out


def report(conversations: DataFrame, rows: DataFrame, codes: DataFrame, changes: DataFrame, size: int = CHUNK) -> DataFrame:
    key = conversations.schema["conv_id"].dataType
    none = {"turn": "long", "pos": "long", "code": "string", "role": "string", "text": "string", "audit": "string", "cost": "long"}

    def shaped(df: DataFrame, kind: int, chunk: Column) -> DataFrame:
        return df.select("conv_id", chunk.cast("long").alias("chunk"), F.lit(kind).alias("kind"),
                         *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in none.items()])

    texts = null_safe_join(rows, codes, ["conv_id", "pos"])
    every = shaped(conversations.select("conv_id").distinct(), 0, F.lit(-1))
    every = every.unionByName(shaped(changes, 1, F.col("chunk"))).unionByName(shaped(texts, 2, F.floor(F.col("pos") / size)))
    ordered = every.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "kind", "pos")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = pa.schema([("conv_id", to_arrow_type(key)), *((n, pa.int64()) for n in names), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each():
            out = None
            for r in _rows(batches):
                if r["kind"] == 0:
                    if out:
                        yield out.row()
                    out = _Conversation(r["conv_id"])
                elif r["kind"] == 1:
                    out.edits(r["audit"], r["cost"])
                else:
                    out.turn(r)
            if out:
                yield out.row()

        yield from _packed(each(), schema)

    return ordered.mapInArrow(run, f"conv_id {key.simpleString()}, " + ", ".join(f"{n} long" for n in names) + ", audit string, repaired_sha256 string")


class _Conversation:
    """One conversation's rows streaming by: counts, and the digest of its repaired form."""

    def __init__(self, conv_id):
        self.conv_id, self.audit, self.pending, self.state = conv_id, [], "", START
        self.faults = dict.fromkeys(_FAULTS, 0)
        self.cost = self.illegal = self.distinct = 0
        self.low = self.high = self.before = None
        self.sha, self.lines = hashlib.sha256(), 0

    def edits(self, audit: str, cost: int) -> None:
        self._inserted()
        self.audit.append(audit)
        self.pending, self.cost = audit, self.cost + cost

    def _line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def _inserted(self) -> None:
        n = len(self.pending) - len(self.pending.lstrip("I"))
        for _ in range(n):
            self.state = _TURNS[self.state]
            self._line(_NAMES[self.state], "")
        self.pending = self.pending[n:]

    def turn(self, r: dict) -> None:
        code = int(r["code"], 16)
        initial = _INITIALS[code >> 2]
        self.faults[_FAULTS[code & 3]] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if r["turn"] is not None and r["turn"] != self.high:
            self.low = r["turn"] if self.low is None else self.low
            self.high, self.distinct = r["turn"], self.distinct + 1
        self._inserted()
        letter, self.pending = self.pending[0], self.pending[1:]
        if letter == "K":
            self.state = _GOES[self.state, initial]
            self._line(r["role"], r["text"])
        elif letter == "R":
            self.state = _TURNS[self.state]
            self._line(_NAMES[self.state], r["text"])

    def row(self) -> dict:
        self._inserted()
        return {"conv_id": self.conv_id, "gaps": 0 if self.low is None else self.high - self.low + 1 - self.distinct,
                **{f: self.faults[f] for f in _FAULTS[1:]}, "illegal": self.illegal, "cost": self.cost,
                "audit": "".join(self.audit), "repaired_sha256": self.sha.hexdigest()}
