import hashlib
import itertools
import random
import zlib

import pytest

from hazeline.llm import conversations
from hazeline.llm.alignment import align
from hazeline.llm.queries import QUERIES

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def inserted(best):
    best = dict(best)
    for _ in range(4):
        for at, (cost, audit) in list(best.items()):
            for role in "ua":
                if (at, role) in STEP:
                    new = STEP[at, role]
                    best[new] = min(best.get(new, (1 << 60, "")), (cost + 5, audit + "I"))
    return best


def cheapest(turns):
    """Cost and audit by trying every edit at every place of the form, keeping the least of each."""
    best = {"": (0, "")}
    for turn in turns:
        new = {}
        for at, (cost, audit) in inserted(best).items():
            options = [(at, cost + 2, "D")]
            if turn != "-":
                more = 5 if turn.isupper() else 0
                if (at, turn.lower()) in STEP:
                    options.append((STEP[at, turn.lower()], cost + more, "K"))
                options += [
                    (STEP[at, role], cost + 1 + more, "R")
                    for role in "ua" if (at, role) in STEP and role != turn.lower()
                ]
            for place, total, edit in options:
                new[place] = min(new.get(place, (1 << 60, "")), (total, audit + edit))
        best = new
    return min(value for place, value in inserted(best).items() if place in ("", "a"))


def damaged(rows):
    for number, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        key = f"{' ' if number is None else number}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        role = "user" if fate == 4 else role
        yield from [(number, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)


def expected(rows):
    found = []
    whole = list(damaged(rows))
    for number in {row[0] for row in rows}:
        turns = [row[1:] for row in whole if row[0] == number]
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(t[2].encode()).digest()))
        numbers = [turn for turn, _, _ in turns if turn is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        faults, letters = {"blank": 0, "duplicate": 0, "truncated": 0}, ""
        for at, (_, role, text) in enumerate(turns):
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = (
                "blank" if not bare
                else "duplicate" if (role, text) in [turn[1:] for turn in turns[:at]]
                else "truncated" if bare[-1] not in ".!?" else None
            )
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if fault:
                faults[fault] += 1
                letter = letter.upper() if fault == "truncated" else "-"
            letters += letter
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
        cost, audit = cheapest(letters)
        kept, rest, last = [], iter(turns), ""
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(rest)[1:]
            if edit == "D":
                continue
            if edit in "IR":
                role = NAMES["a" if last == "u" else "u"]
            last = role[:1]
            kept.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        illegal = sum(pair not in ("su", "ua", "au") for pair in pairs)
        found.append((number, gaps, *faults.values(), illegal, cost, audit, digest))
    return found


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda row: (row[0] is None, row[0] or 0))


def test_alignment_of_all_short_sequences():
    for n in range(4):
        for turns in itertools.product("suaxSUAX-", repeat=n):
            assert align("".join(turns)) == cheapest(turns), turns


def test_alignment_of_longer_sequences_in_segments():
    rng = random.Random(5)
    for _ in range(300):
        turns = "".join(rng.choices("suaxSUAX-", weights=[1, 8, 8, 1, 1, 2, 2, 1, 3], k=rng.randint(1, 60)))
        assert {align(turns, segment) for segment in (1, 2, 3, 7, 20, 128)} == {cheapest(turns)}, turns


def odd_turns():
    rng = random.Random(8)
    rows = []
    for number in range(150):
        roles = ["system"] * (rng.random() < 0.2) + ["user", "assistant"] * 5
        for turn, role in enumerate(roles[: rng.randint(1, 9)]):
            text = rng.choice(["Yes.", "So it is!", "Is it?\n", "and", "  \n", "", "é €.", f"turn {turn}."])
            rows.append((number, turn * rng.choice([1, 1, 1, 2]), rng.choice([role, role, role, "tool", "user"]), text))
    rows += [(None, turn, "user", f"text {turn}.") for turn in range(12)]
    rows += [(200, None, "user", "a."), (200, None, "assistant", "b."), (200, 5, None, "c."), (200, 6, "user", None)]
    rows += [(201, None, None, None), (202, 1, "", "x."), (203, 1, "user", "w " * 200_000 + "."), (203, 2, "assistant", "ok.")]
    rows += [(204, turn, "user" if turn % 2 else "assistant", f"{turn}." if turn % 7 else "same.") for turn in range(400)]
    rows += [(205, 3, "user", "twice."), (205, 3, "user", "twice."), (205, 3, "assistant", "tie."), (205, -4, "user", "z.")]
    return rows


CLASHING = "digest int, gone int, kind int, audit int, cost int, id int, fate int, copy int, blank int"


@pytest.fixture(scope="module")
def odd_conversations(spark):
    rows = [(*row, *range(9)) for row in odd_turns()]
    schema = f"conv_id long, turn long, role string, text string, {CLASHING}"
    return spark.createDataFrame(rows, schema).repartition(6)


def test_reports_of_damaged_turns(odd_conversations):
    found = conversations.reports(conversations.damage(odd_conversations), id_col="id", gone_col="gone")
    assert ordered(found.collect()) == ordered(expected(odd_turns()))


def test_the_query_on_a_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = QUERIES["op11_conversation_repair"](spark, sf_dir)
    assert found.columns[0] == "conv_id" and len(found.columns) == 9
    assert ordered(found.collect()) == ordered(expected(list(map(tuple, rows))))


def test_repaired_turns_have_the_form(spark):
    rows = [("a", 1, "assistant", "Hello."), ("a", 2, "assistant", "Good day."), ("b", 1, "system", "Be kind."), ("b", 2, "user", "cut")]
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    found = [tuple(row) for row in conversations.repaired(turns).orderBy("id", "position").collect()]
    assert found == [("a", 0, "Rerole", "user", "Hello."), ("a", 1, "Keep", "assistant", "Good day.")]
    assert [row.audit for row in conversations.audits(turns).orderBy("id").collect()] == ["RK", "DD"]


def test_no_turns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.reports(conversations.damage(none), id_col="id", gone_col="gone").count() == 0
    assert conversations.repaired(none).count() == 0
    gone = spark.createDataFrame([(1, 1, "user", "x", True)], "conv_id long, turn long, role string, text string, gone boolean")
    row = conversations.reports(gone, gone_col="gone").first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
