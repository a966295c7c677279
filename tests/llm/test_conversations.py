"""Repair of conversations against every edit script, whole charts, and odd input."""

import itertools
import random
import re

import pytest

from martloom.llm import conversations as conv

SHAPE = re.compile(r"(s?(ua)+)?$")
WORDS = "conv_id long, turn long, role string, text string"


def scripts(symbols, inserts):
    """Every audit with its cost that makes the rows legal, with up to ``inserts`` insertions in each gap."""
    fills = ["".join(x) for n in range(inserts + 1) for x in itertools.product("ua", repeat=n)]
    edits = []
    for symbol in symbols:
        late = conv.TRUNCATED if symbol.isupper() else 0
        ways = [("D", 2, "")]
        if symbol != "x":
            ways += [("K", late, symbol.lower()), ("R", late + 1, "u"), ("R", late + 1, "a")]
        edits.append(ways)
    for gaps in itertools.product(fills, repeat=len(symbols) + 1):
        for chosen in itertools.product(*edits):
            roles = gaps[0] + "".join(c[2] + g for c, g in zip(chosen, gaps[1:]))
            if SHAPE.match(roles):
                audit = "I" * len(gaps[0]) + "".join(c[0] + "I" * len(g) for c, g in zip(chosen, gaps[1:]))
                yield 5 * sum(map(len, gaps)) + sum(c[1] for c in chosen), audit


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_cells_equal_every_edit_script(length):
    for symbols in itertools.product("xsuaoSUAO", repeat=length):
        if length == 3 and hash(symbols) % 7:
            continue
        cell = conv.parse("".join(symbols), {})
        assert conv._best(cell)[1][:2] == min(scripts(symbols, 2 if length < 3 else 1))


def chart(symbols):
    """The cell of a span from all splits of all its spans, however long."""
    cells = {}
    for length in range(1, len(symbols) + 1):
        for start in range(len(symbols) - length + 1):
            cell = conv._leaf(symbols[start]) if length == 1 else {}
            for cut in range(1, length):
                conv._join(cell, cells[start, cut], cells[start + cut, length - cut])
            cells[start, length] = cell
    return cells[0, len(symbols)]


def test_one_split_of_long_spans_is_enough():
    rng = random.Random(4)
    for length in (9, 17, 30):
        symbols = "".join(rng.choice("xsuuuaaaoSUAO") for _ in range(length))
        assert conv.parse(symbols, {}) == chart(symbols)


def repaired(df, **options):
    report, pieces = conv.repair_conversations(df, **options)
    lines = {}
    for piece in sorted(pieces.collect(), key=lambda p: (str(p["conv_id"]), p["place"])):
        lines.setdefault(piece["conv_id"], []).extend((r["role"], r["text"], r["edit"]) for r in piece["rows"])
    return {r["conv_id"]: r.asDict() for r in report.collect()}, lines


def test_cut_conversations_equal_whole_ones(spark):
    rng = random.Random(7)
    texts = ["Yes.", "No", "", "Why?", "Because of it!", " \n"]
    rows = [
        (c, rng.choice([None, *range(n)]), rng.choice(["system", "user", "assistant", "tool", None]), rng.choice([None, *texts]) )
        for c, n in [(1, 400), (2, 9), (3, 150), (4, 1), (None, 40)]
        for _ in range(n)
    ]
    rows += [(c, t + 1000, r, f"{x} {t}.") for c, t, r, x in rows if t is not None]
    df = spark.createDataFrame(rows, WORDS).repartition(3)
    whole, lines = repaired(df.coalesce(1), piece_rows=10_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut, cut_lines = repaired(df, piece_rows=3)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert cut == whole and cut_lines == lines and len(whole) == 5
    for key, report in whole.items():
        assert SHAPE.match("".join(role[0] for role, _, _ in lines.get(key, [])))
        assert report["audit"].replace("D", "") == "".join(edit for _, _, edit in lines.get(key, []))


def test_odd_rows(spark):
    rows = [
        (1, 5, "user", "Hi."), (1, 5, "user", "Hi."), (1, 7, "user", "Hi."), (1, 8, "assistant", "Oh!"),
        (2, None, None, None), (3, 1, "system", "Be brief."), (4, 2**62, "user", "Last ."), (4, -(2**62) - 2, "user", "x?"),
        (5, None, "assistant", "A.\n"), (5, None, "assistant", "B!"),
    ]
    df = spark.createDataFrame(rows, WORDS).withColumns({"place": lit("x"), "said": lit(1), "copies": lit(9)})
    report, lines = repaired(df)
    assert report[1] == {
        "conv_id": 1, "gaps": 1, "blank": 0, "duplicate": 2, "truncated": 0, "illegal": 2, "cost": 4, "audit": "KDDK",
    }
    assert lines[1] == [("user", "Hi.", "K"), ("assistant", "Oh!", "K")]
    assert report[2]["audit"] == "D" and report[2]["blank"] == 1 and report[2]["gaps"] == 0
    # A system message alone is no conversation: taking it out is cheaper than two insertions.
    assert report[3]["audit"] == "D" and report[3]["cost"] == 2
    assert report[4]["gaps"] == conv._wrapped(2**63 + 1) and report[4]["audit"] == "KR"
    assert report[5]["illegal"] == 1 and report[5]["gaps"] == 0 and report[5]["audit"] == "RK"
    none, nothing = repaired(df.limit(0))
    assert none == {} and nothing == {}


def test_repeats_and_long_texts(spark):
    rows = [(1, 0, "user", "a" * 3_000_000 + "."), (1, 1, "assistant", "b" * 3_000_000 + "!")] + [(2, 0, "user", "Go.")] * 3000
    report, lines = repaired(spark.createDataFrame(rows, WORDS))
    assert report[1]["audit"] == "KK" and [len(t) for _, t, _ in lines[1]] == [3_000_001] * 2
    assert report[2]["duplicate"] == 2999 and report[2]["illegal"] == 2999
    assert report[2]["audit"] == "D" * 3000 and report[2]["cost"] == 6000


def lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)
