import hashlib
import itertools
import random
import re
import zlib

import pytest

from stratamart.llm import turn_repair as R


def brute(turns):
    """Cost and audit by all edits of all turns with up to two insertions between."""
    gaps = ["", "I", "II"]
    best = None
    for edits in itertools.product("KRD", repeat=len(turns)):
        for spaces in itertools.product(gaps, repeat=len(turns) + 1):
            letters = spaces[0] + "".join(e + s for e, s in zip(edits, spaces[1:]))
            cost, at, options, legal = 0, 0, [""], True
            for letter in letters:
                if letter == "I":
                    cost, options = cost + 2, [o + x for o in options for x in "ua"]
                    continue
                initial, fault = turns[at]
                at += 1
                if letter == "D":
                    cost += 3
                    continue
                legal = legal and fault not in "bd"
                cost += fault == "t"
                if letter == "K":
                    options = [o + initial for o in options]
                else:
                    cost, options = cost + 2, [o + x for o in options for x in "ua"]
            if legal and any(re.fullmatch("(s?(ua)+)?", o) for o in options):
                best = min(best or (cost, letters), (cost, letters))
    return best


@pytest.mark.parametrize("seed", range(40))
def test_lightest_edits_against_all_edits(seed):
    chance = random.Random(seed)
    turns = [(chance.choice("suuaax"), chance.choice("-----tbd")) for _ in range(chance.randint(0, 3))]
    assert R.repair("".join(a + b for a, b in turns)) == brute(turns)


@pytest.mark.parametrize("seed", range(30))
def test_ways_through_blocks_make_the_whole(seed):
    chance = random.Random(seed)
    turns = [chance.choice("suuuaaax") + chance.choice("------tbd") for _ in range(chance.randint(2, 40))]
    cuts = sorted(chance.sample(range(1, len(turns)), min(3, len(turns) - 1)))
    blocks = [turns[a:b] for a, b in zip([0, *cuts], [*cuts, len(turns)])]
    ways = R.through([R.through(R._steps("".join(b)), True) for b in blocks], False)
    found = min(w for (before, after), w in ways.items() if before == 0 and after in R.ACCEPTED)
    assert found == R.repair("".join(turns))


def plain(rows):
    """The contract, a conversation at a time in Python."""
    out = {}
    for conv_id, turn, role, text in rows:
        own = out.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        own.extend([(turn, role, text)] * (2 if kind == 3 else 1))
    found = []
    for conv_id, own in out.items():
        digest = {(r, t): hashlib.sha256(
            f"{'' if conv_id is None else conv_id}:{len(r)}:{r}{t}".encode()).hexdigest() for _, r, t in own}
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], digest[x[1:]]))
        seen, turns = set(), []
        for _, role, text in own:
            bare = text.rstrip(R.SPACE)
            fault = "b" if not bare else "d" if (role, text) in seen else "-" if bare[-1] in ".!?" else "t"
            seen.add((role, text))
            turns.append((role[:1] or " ") + fault)
        numbers = {t for t, _, _ in own if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = R.repair("".join(turns))
        lines, state, left = [], "", iter(zip(own, turns))
        for letter in audit:
            given = "assistant" if state == "u" else "user"
            if letter == "I":
                line = (given, "")
            else:
                (_, role, text), _ = next(left)
                if letter == "D":
                    continue
                line = (role if letter == "K" else given, text)
            lines.append(":".join(line))
            state = line[0][0]
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        faults = [sum(t[1] == f for t in turns) for f in "bdt"]
        found.append((conv_id, gaps, *faults, illegal, cost, audit, sha))
    return sorted(found, key=repr)


def repaired(spark, rows, **options):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return sorted((tuple(r) for r in R.repair_conversations(table, **options).collect()), key=repr)


def some_rows(chance, conversations, most):
    rows = []
    for conv_id in conversations:
        for turn in range(chance.randint(1, most)):
            rows.append((
                conv_id, chance.choice([turn, turn, turn, turn + 3, None]),
                chance.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
                chance.choice(["Yes.", "No", "Why?", "  ", "", None, "a\n.", "Long " * 2_000, f"t{chance.random()}!"])))
    return rows


def test_odd_conversations(spark):
    rows = some_rows(random.Random(1), [*range(60), None, -5], 9)
    rows += rows[:40]  # repeated rows
    assert repaired(spark, rows) == plain(rows)


def test_long_conversation_goes_through_many_blocks(spark):
    rows = some_rows(random.Random(2), [1], 900)
    rows = [(7, i, role, text) for i, (_, _, role, text) in enumerate(rows * 3)] + some_rows(random.Random(3), [3, 9], 5)
    assert repaired(spark, rows, block=4) == plain(rows)


def test_equal_turns_without_end(spark):
    first, second = [t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 > 4][:2]  # undamaged
    rows = [(7, first, "user", "Same.")] * 700 + [(7, second, "assistant", "Yes.")]
    found = repaired(spark, rows, block=16)
    assert found == plain(rows)
    assert found[0][3] == 699


def test_all_turns_dropped(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"4:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [(4, turn, "user", "Hi.")]) == [(4, 0, 0, 0, 0, 0, 0, "", empty)]


def test_empty_table_and_other_columns(spark):
    assert repaired(spark, []) == []
    table = spark.createDataFrame(
        [(1, 1, "user", "Hi.", 5, "x")], "conv_id string, turn int, role string, text string, n int, key string")
    assert R.repair_conversations(table).count() == 1
