"""Repair of conversation structure by weighted interval parsing.

A repaired conversation is empty or has an optional system message and then
user and assistant in turns. The grammar is in Chomsky normal form: its
nonterminals N[p, q] are the pairs of states of that rule, its binary rules are
N[p, q] -> N[p, r] N[r, q], and its terminals are the edits of one row with all
insertions before and after them (the insertion closure). A cell holds, for each
pair, the cheapest (cost, audit) of its span; spans are combined bottom-up by
their length.

Within a block of a few rows every split of a span is tried. Because the
nonterminals name the states at both ends, all splits of a span give the same
cell, so longer spans need one split only: neighbours are combined pairwise, in
a task and then over the pieces of a conversation that the sort has cut. A
conversation of any length is thus shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from martloom.llm.common import by_batches, slices, stored

# Prices of the edits, and of a row that is left truncated.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACES = " \t\n\x0b\f\r"

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
# Role that may be put in front of a state's successor, and that successor.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}

# Rows of a span whose every split is tried; rows and characters of a piece; pieces combined at a time.
BLOCK, PIECE_ROWS, PIECE_CHARS, FAN = 8, 1024, 1 << 22, 64
# Cells of equal spans are kept in a task up to this number.
CELLS = 20_000

Cell = dict[tuple[int, int], tuple]


def _offer(cell: Cell, ends: tuple[int, int], cost: int, audit: str, path: str = "") -> None:
    known = cell.get(ends)
    if known is None or (cost, audit) < known[:2]:
        cell[ends] = (cost, audit, path)


def _join(cell: Cell, left: Cell, right: Cell, border: bool = False) -> Cell:
    """Adds to a cell what the binary rules make of two neighbours; the path notes states at borders of pieces."""
    for (p, r), (cost, audit, path) in left.items():
        for q in range(4):
            other = right.get((r, q))
            if other:
                way = f"{path}{r}{other[2]}" if border else ""
                _offer(cell, (p, q), cost + other[0], audit + other[1], way)
    return cell


def _insertions() -> Cell:
    cell: Cell = {}
    for p in range(4):
        state, cost, audit = p, 0, ""
        for _ in range(3):
            _offer(cell, (p, state), cost, audit)
            state, cost, audit = NEXT[state][1], cost + INSERT, audit + "I"
    return cell


_CLOSURE = _insertions()


def _leaf(symbol: str) -> Cell:
    """Edits of one row: x must go, s u a are roles, o is any other; capitals are truncated."""
    cell: Cell = {(p, p): (DELETE, "D", "") for p in range(4)}
    if symbol != "x":
        left = TRUNCATED if symbol.isupper() else 0
        for p, (role, q) in NEXT.items():
            _offer(cell, (p, q), left + REROLE, "R")
            if role[0] == symbol.lower():
                _offer(cell, (p, q), left, "K")
        if symbol.lower() == "s":
            _offer(cell, (START, SYSTEM), left, "K")
    return _join({}, _join({}, _CLOSURE, cell), _CLOSURE)


def _block(symbols: str, known: dict[str, Cell]) -> Cell:
    """The chart of a block: spans by length, each from all its splits. Equal spans have equal cells."""
    for length in range(1, len(symbols) + 1):
        for start in range(len(symbols) - length + 1):
            span = symbols[start : start + length]
            if span in known:
                continue
            cell: Cell = _leaf(span) if length == 1 else {}
            for cut in range(1, length):
                _join(cell, known[span[:cut]], known[span[cut:]])
            known[span] = cell
    return known[symbols]


def _pairwise(cells: list[Cell], border: bool = False) -> Cell:
    """One cell of neighbouring ones, by doubling spans."""
    while len(cells) > 1:
        pairs = [_join({}, a, b, border) for a, b in zip(cells[::2], cells[1::2])]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0]


def parse(symbols: str, known: dict[str, Cell]) -> Cell:
    """The cell of a whole span; ``known`` keeps cells of short spans between calls."""
    if len(known) > CELLS:
        known.clear()
    blocks = [_block(symbols[i : i + BLOCK], known) for i in range(0, len(symbols), BLOCK)]
    return _pairwise(blocks) if blocks else dict(_CLOSURE)


def _best(cell: Cell) -> tuple[int, tuple]:
    """The last state and the entry of the cheapest repair."""
    entries = [(cell[START, q], q) for q in ENDS if (START, q) in cell]
    entry, end = min(entries, key=lambda e: e[0][:2])
    return end, entry


def _wrapped(value: int) -> int:
    return (value + (1 << 63)) % (1 << 64) - (1 << 63)


COUNTS = ("blank", "duplicate", "truncated", "illegal")
_FAULTS = {"b": "blank", "d": "duplicate", "t": "truncated"}


class _Piece:
    """Rows of one conversation that follow each other, as they are read."""

    def __init__(self, conv: object):
        self.conv, self.rows, self.symbols, self.chars = conv, [], [], 0
        self.note = dict.fromkeys(COUNTS, 0) | {"turns": 0, "low": None, "high": None, "first": None, "last": None}

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: str) -> None:
        note, initial = self.note, role[:1]
        if self.rows:
            note["illegal"] += note["last"] + initial not in LEGAL
        else:
            note["first"] = initial
        note["illegal"] += copies - 1  # a role never follows itself
        note["last"] = initial
        if fault:
            note[_FAULTS[fault]] += 1
        note["blank" if fault == "b" else "duplicate"] += copies - 1
        if turn is not None and turn != note["high"]:
            note["turns"] += 1
            note["low"] = turn if note["low"] is None else note["low"]
            note["high"] = turn
        symbol = "x" if fault in ("b", "d") else initial if initial in ("s", "u", "a") else "o"
        self.symbols.append((symbol.upper() if fault == "t" else symbol) + "x" * (copies - 1))
        self.rows.append({"turn": turn, "role": role, "text": text, "copies": copies})
        self.chars += len(text) + copies

    def full(self, rows: int) -> bool:
        return len(self.rows) >= rows or self.chars >= PIECE_CHARS


def _merged(notes: list[dict]) -> dict:
    """Counts of neighbouring pieces as one; turns ascend, so only neighbours can share one."""
    total = dict(notes[0])
    for note in notes[1:]:
        for name in COUNTS:
            total[name] += note[name]
        total["illegal"] += total["last"] + note["first"] not in LEGAL
        total["last"] = note["last"]
        if note["turns"]:
            total["turns"] += note["turns"] - (total["high"] == note["low"])
            total["low"] = note["low"] if total["low"] is None else total["low"]
            total["high"] = note["high"]
    return total


_NOTE = StructType(
    [StructField(n, LongType()) for n in (*COUNTS, "turns", "low", "high")]
    + [StructField(n, StringType()) for n in ("first", "last")]
)
_CELL = "array<struct<p:int,q:int,cost:bigint,audit:string,path:string>>"
_ROW = "array<struct<turn:bigint,role:string,text:string,copies:bigint>>"


def _packed(cell: Cell) -> list[dict]:
    return [dict(zip(("p", "q", "cost", "audit", "path"), (*ends, *entry))) for ends, entry in cell.items()]


def _unpacked(cell: list[dict]) -> Cell:
    return {(e["p"], e["q"]): (e["cost"], e["audit"], e["path"]) for e in cell}


def _schema(like: DataFrame, rest: str) -> StructType:
    conv = StructType([StructField("conv_id", like.schema["conv_id"].dataType)])
    return StructType(conv.fields + StructType.fromDDL(rest).fields)


def _batch(rows: list[dict], schema: StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


def _pieces(rows: DataFrame, piece_rows: int) -> DataFrame:
    """Sorted rows as pieces of conversations, with the cell and the counts of each."""
    schema = _schema(rows, f"part bigint, number bigint, open boolean, rows {_ROW}, cell {_CELL}").add("note", _NOTE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known, piece, number, begun = TaskContext.get().partitionId(), {}, None, 0, 0

        def closed(piece: _Piece, cut: bool) -> dict:
            """``cut``: the conversation may go on in another piece."""
            return {
                "conv_id": piece.conv, "part": part, "number": number, "open": cut, "rows": piece.rows,
                "cell": _packed(parse("".join(piece.symbols), known)), "note": piece.note,
            }

        for batch in batches:
            for some in slices(batch):
                done = []
                for row in some.to_pylist():
                    if piece is None or row["conv_id"] != piece.conv or piece.full(piece_rows):
                        if piece is not None:
                            goes_on = row["conv_id"] == piece.conv
                            # The first conversation of a task may have begun in the task before.
                            done.append(closed(piece, goes_on or number > 0 or begun == 0))
                            number, begun = (number + 1, begun) if goes_on else (0, begun + 1)
                        piece = _Piece(row["conv_id"])
                    piece.add(row["turn"], row["role"], row["text"], row["copies"], row["fault"])
                if done:
                    yield _batch(done, schema)
        if piece is not None:
            yield _batch([closed(piece, True)], schema)

    return by_batches(rows, work, schema)


def _folded(pieces: DataFrame) -> DataFrame:
    """Neighbouring pieces of a conversation as one span, ``FAN`` at a time."""
    schema = _schema(pieces, f"place bigint, places array<bigint>, cell {_CELL}").add("note", _NOTE)
    gathered = pieces.groupBy("conv_id", F.floor(F.col("place") / FAN).alias("group")).agg(
        F.sort_array(F.collect_list(F.struct("place", "places", "cell", "note"))).alias("spans")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for some in slices(batch, 16) for r in some.to_pylist()):
                spans = row["spans"]
                whole = {
                    "conv_id": row["conv_id"],
                    "place": row["group"],
                    "places": [place for s in spans for place in s["places"]],
                    "cell": _packed(_pairwise([_unpacked(s["cell"]) for s in spans], border=True)),
                    "note": _merged([s["note"] for s in spans]),
                }
                yield _batch([whole], schema)

    return by_batches(gathered, work, schema)


def _decided(spans: DataFrame) -> DataFrame:
    """Report of whole conversations, with the states at the ends of each of their pieces."""
    counts = ", ".join(f"{name} bigint" for name in ("gaps", *COUNTS, "cost"))
    ends = "array<struct<place:bigint,p:int,q:int>>"
    schema = _schema(spans, f"{counts}, audit string, ends {ends}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                done = []
                for row in some.to_pylist():
                    note = row["note"]
                    end, (cost, audit, path) = _best(_unpacked(row["cell"]))
                    states = [START, *map(int, path), end]
                    gaps = _wrapped(note["high"] - note["low"] + 1 - note["turns"]) if note["turns"] else 0
                    done.append(
                        {n: note[n] for n in COUNTS}
                        | {"conv_id": row["conv_id"], "gaps": gaps, "cost": cost, "audit": audit}
                        | {"ends": [dict(zip(("place", "p", "q"), e)) for e in zip(row["places"], states, states[1:])]}
                    )
                yield _batch(done, schema)

    return by_batches(spans, work, schema)


def _edited(pieces: DataFrame) -> DataFrame:
    """Rows of each piece after the edits that its states at both ends stand for; q is null for a whole conversation."""
    rows = "array<struct<turn:bigint,role:string,text:string,edit:string>>"
    schema = _schema(pieces, f"place bigint, rows {rows}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 32):
                done = []
                for piece in some.to_pylist():
                    given = (r for r in piece["rows"] for _ in range(r["copies"]))
                    state, kept, cell = piece["p"], [], _unpacked(piece["cell"])
                    end = _best(cell)[0] if piece["q"] is None else piece["q"]
                    for edit in cell[state, end][1]:
                        row = {"turn": None, "text": ""} if edit == "I" else next(given)
                        if edit == "D":
                            continue
                        role, after = NEXT[state]
                        if edit == "K":
                            role, after = row["role"], SYSTEM if row["role"][0] == "s" else after
                        kept.append({"turn": row["turn"], "role": role, "text": row["text"], "edit": edit})
                        state = after
                    done.append({"conv_id": piece["conv_id"], "place": piece["place"], "rows": kept})
                yield _batch(done, schema)

    return by_batches(pieces, work, schema)


def faults(df: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text) with their number of copies and the fault of the first.

    ``fault`` is b for a blank text, d for a role and text that occurred in an
    earlier turn, t for a text that ends without a full stop, else empty.
    """
    rows = df.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
    )
    # Copies are counted before they move, so a row repeated without end takes one place.
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("said", said)
    repeated = (
        rows.groupBy(F.col("conv_id").alias("conv"), F.col("said").alias("again"))
        .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
    )
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("said") == F.col("again"))
    rows = rows.join(repeated, same, "left")
    earlier = F.col("times").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    ending = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (
        F.when(ending == "", "b")
        .when(earlier, "d")
        .when(~F.right(ending, F.lit(1)).isin(".", "!", "?"), "t")
        .otherwise("")
    )
    return rows.select("conv_id", "turn", "role", "text", "copies", "said", fault.alias("fault"))


def repair_conversations(df: DataFrame, piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Cheapest repair of each conversation: a report, and the repaired rows by piece.

    ``df`` has conv_id, turn, role and text; other columns play no part. The
    report has one row per conversation: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit. The repaired pieces have conv_id, place (their
    order in the conversation) and rows (turn, role, text, edit); a conversation
    that fits one piece of ``piece_rows`` rows, as nearly all do, has one.

    Rows are taken by turn, unknown turns first, equal turns by role and text
    (its first 64 characters, then its digest). A null role or text counts as one
    space, so such a text is blank and such a role is illegal. Of repeated rows
    the first is kept and the others are duplicates. A null conv_id is a
    conversation of its own. Equal costs go to the ASCII-least audit. An empty
    table gives empty results. Gaps beyond 64 bits wrap around.
    """
    order = ["conv_id", "turn", "role", F.left("text", F.lit(64)), "said"]
    rows = faults(df).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(_pieces(rows.drop("said"), piece_rows), "pieces")
    # Pieces of a task are numbered; together with the task that gives their order.
    least = pieces.agg(F.coalesce(F.max("number"), F.lit(0)) + 1, F.coalesce(F.max("part"), F.lit(0)) + 1)
    numbers, parts = least.first()
    pieces = pieces.withColumn("place", F.col("part") * numbers + F.col("number"))
    spans = pieces.select("conv_id", "place", F.array("place").alias("places"), "cell", "note", "open")
    cut, reach = spans.filter("open").drop("open"), parts * numbers
    while reach > 1:
        cut, reach = _folded(cut), -(-reach // FAN)
    decided = stored(_decided(spans.filter("not open").drop("open").unionByName(cut)), "decided")
    ends = decided.select(F.col("conv_id").alias("conv"), F.inline("ends")).withColumnRenamed("place", "at")
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("place") == F.col("at"))
    wanted = ["conv_id", "place", "rows", "cell", "p", "q"]
    whole = pieces.filter("not open").withColumns({"p": F.lit(START), "q": F.lit(None).cast("int")})
    parts_of = pieces.filter("open").join(ends, same)
    return decided.drop("ends"), _edited(whole.select(wanted).unionByName(parts_of.select(wanted)))
