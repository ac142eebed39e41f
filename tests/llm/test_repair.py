"""Conversation repair against all edits of short conversations, and over cut segments."""

import hashlib
import random
import re
from itertools import product

import pytest

from tallyline.llm import repair

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, present BOOLEAN, seg STRING"
SAYS = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, made = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        made.append(kind)
    return made


def cheapest(rows, kinds):
    """All ways to edit, legal ones by cost and audit."""
    puts = ["", "u", "a", "ua", "au"]
    keep = [("K", 0, None), ("R", 2, "user"), ("R", 2, "assistant"), ("D", 3, None)]
    best = None
    for choice in product(*(keep if k not in ("blank", "duplicate") else keep[3:] for k in kinds)):
        for more in product(puts, repeat=len(rows) + 1):
            cost, audit, lines = 0, "", []
            for (role, text), kind, (edit, price, new), put in zip(rows, kinds, choice, more[:-1], strict=True):
                lines += [f"{SAYS[p]}:" for p in put]
                audit += "I" * len(put) + edit
                cost += 2 * len(put) + price + (edit != "D" and kind == "truncated")
                if edit != "D":
                    lines.append(f"{new or role}:{text}")
            lines += [f"{SAYS[p]}:" for p in more[-1]]
            audit += "I" * len(more[-1])
            cost += 2 * len(more[-1])
            if (best is None or (cost, audit) < best[:2]) and re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines)):
                best = (cost, audit, "\n".join(lines))
    return best


def expected(conv, rows):
    """``rows``: (turn, role, text) in order."""
    said = [(r, t) for _, r, t in rows]
    kinds = faults(said)
    cost, audit, text = cheapest(said, kinds)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:]))
    return (
        conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


@pytest.fixture(scope="module")
def short():
    rng = random.Random(12)
    roles, texts = ["system", "user", "assistant", "tool", " ", "", "u"], ["Yes.", "No!", "cut", " \n", "", "Why?\t"]
    made = {}
    for conv in range(60):
        size = rng.randint(0, 3)
        made[conv] = [
            (3 * i + rng.randint(0, 1) if conv % 7 else 5 + 0 * i, rng.choice(roles[: 3 + conv % 5]), rng.choice(texts))
            for i in range(size)
        ]
    made[None] = [(None, "assistant", "First."), (2, "user", "Second")]
    # One turn: in the order of role and digest.
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1], digest(r))) for c, rows in made.items()}


@pytest.mark.parametrize("segment", [1 << 10, 2, 1])
def test_repair_matches_all_edits(spark, short, monkeypatch, segment):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    rows = [(c, t, r, x, True, "clash") for c, said in short.items() for t, r, x in said]
    rows += [(c, 9, "user", "gone.", False, "clash") for c in short]
    random.Random(1).shuffle(rows)
    got = repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(c, said) for c, said in short.items()), key=repr)


def test_long_conversation_does_not_depend_on_segments(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["Go.", f"{i}.", "cut", ""]), True, "") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    whole = repair.repair(df).collect()
    monkeypatch.setattr(repair, "SEGMENT", 16)
    assert repair.repair(df).collect() == whole
    assert len(whole) == 1 and whole[0].gaps == 0
    # The audit's edits, applied in plain Python, give the hash.
    lines = repair.edited("0", whole[0].audit, [r[2:4] for r in rows])
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == whole[0].repaired_sha256


def test_agenda_against_forward_search():
    """Lightest ways through up to four rows between all states, against trying all edits."""
    edges = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def through(symbols, start):
        ways = {start: (0, "")}
        for symbol in [*symbols, None]:
            put = dict(ways)
            for _ in range(3):
                for (p, r), q in edges.items():
                    if r != "s" and p in put:
                        put[q] = min(put.get(q, (99, "")), (put[p][0] + 2, put[p][1] + "I"))
            if symbol is None:
                return put
            ways = {}
            for p, (cost, audit) in put.items():
                tries = [(p, cost + 3, audit + "D")]
                for (x, r), q in edges.items():
                    if x == p and symbol != "-":
                        short = int(symbol.isupper())
                        tries += [(q, cost + short, audit + "K")] * (r == symbol.lower())
                        tries += [(q, cost + 2 + short, audit + "R")] * (r != "s")
                for q, *way in tries:
                    ways[q] = min(ways.get(q, (99, "")), tuple(way))

    for n in range(4):
        for symbols in map("".join, product("suaoUA-", repeat=n)):
            items = {(p, q): (cost, audit) for p, q, cost, audit in repair.items(symbols)}
            assert items == {(p, q): way for p in "0sua" for q, way in through(symbols, p).items()}


def test_damage_and_empty_table(spark):
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, copy INT"
    rows = spark.createDataFrame([(i, i % 3, None if i % 5 == 0 else "tool", None if i % 4 == 0 else "a.b!?", 1) for i in range(200)], schema)
    made = repair.damage(rows)
    assert made.columns == ["conv_id", "turn", "role", "text", "present"]
    assert 0 < made.where("NOT present").count() < 40 and made.count() > 200
    assert {r.text for r in made.select("text").distinct().collect()} == {"", " ", "ab", "a.b!?"}
    assert repair.repair(repair.damage(rows.limit(0))).count() == 0
    assert repair.repair(made).count() == 200
    lost = repair.repair(made.where("NOT present")).first()
    assert tuple(lost)[1:-1] == (0, 0, 0, 0, 0, 0, "") and lost.repaired_sha256 == hashlib.sha256(b"").hexdigest()
