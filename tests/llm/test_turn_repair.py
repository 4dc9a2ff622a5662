import hashlib
import itertools
import random
import re

import pytest

from claimloom.llm import queries, turn_repair
from claimloom.llm.turn_repair import Audits

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        bare = text.rstrip(SPACE)
        if not bare:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("truncated" if bare[-1] not in ".!?" else "none")
        seen.add((role, text))
    return found


def step(state, initial):
    return {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}[state].get(initial)


def plain_repair(rows):
    """Cost, audit and repaired turns by a program that keeps whole strings."""
    best = {"": (0, "", ())}

    def offer(ways, state, way):
        if state is not None and (state not in ways or way < ways[state]):
            ways[state] = way

    def inserted(ways):
        ways = dict(ways)
        for _ in range(3):
            for state, (cost, audit, out) in list(ways.items()):
                for role in ("user", "assistant"):
                    offer(ways, step(state, role[0]), (cost + 2, audit + "I", (*out, f"{role}:")))
        return ways

    for (role, text), fault in zip(rows, faults_of(rows)):
        after = {}
        for state, (cost, audit, out) in inserted(best).items():
            offer(after, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            offer(after, step(state, role[:1]), (cost + extra, audit + "K", (*out, f"{role}:{text}")))
            for to in ("user", "assistant"):
                offer(after, step(state, to[0]), (cost + 2 + extra, audit + "R", (*out, f"{to}:{text}")))
        best = after
    return min(way for state, way in inserted(best).items() if state in ("", "a"))


def expected(rows):
    faults = faults_of(rows)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, out = plain_repair(rows)
    numbers = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    numbers.append(sum(p not in ("su", "ua", "au") for p in pairs))
    return (*numbers, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def in_order(rows):
    """(conv, turn, role, text) as the operator takes them: by conversation."""
    space = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]

    def key(row):
        _, turn, role, text = row
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        return (turn is not None, turn or 0, role.encode(), digest)

    found = {}
    for row in sorted(space, key=key):
        found.setdefault(row[0], []).append(row[2:])
    return found


def gaps_of(turns):
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def check(spark, rows, block_rows, ids=()):
    turns = spark.createDataFrame(rows, SCHEMA).repartition(3)
    conv_ids = spark.createDataFrame([(i,) for i in ids] + [(r[0],) for r in rows], "conv_id bigint")
    found = turn_repair.audit_conversations(turns, conv_ids, block_rows).collect()
    want = {}
    for conv, own in in_order(rows).items():
        want[conv] = (gaps_of([r[1] for r in rows if r[0] == conv]), *expected(own))
    for conv in ids:
        want.setdefault(conv, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))
    assert len(found) == len(want)
    assert {r[0]: tuple(r[1:]) for r in found} == want


def random_rows(seed, convs, turns, roles=("system", "user", "assistant", "user", "assistant", "tool", "", None)):
    draw = random.Random(seed)
    texts = ["One.", "Two!", "cut", " \n", "", None, "Why?", "Three. "]
    return [
        (draw.choice([*range(convs), None]), draw.choice([*range(turns), None]), draw.choice(roles), draw.choice(texts) if draw.random() < 0.6 else f"No {draw.randrange(9**6)}.")
        for _ in range(convs * turns)
    ]


@pytest.mark.parametrize("prime", [(1 << 61) - 1, 7])
def test_audits_compare_as_strings_do_also_when_hashes_collide(prime):
    draw = random.Random(5)
    audits = Audits(base=3, prime=prime)
    nodes, texts = [0], [""]
    for _ in range(1500):
        k = draw.choice(range(max(0, len(nodes) - 40), len(nodes)))
        letter = draw.choice("DIK" if draw.random() < 0.3 else "K")
        nodes.append(audits.add(nodes[k], letter))
        texts.append(texts[k] + letter)
    assert [audits.text(n) for n in nodes] == texts
    for _ in range(6000):
        a, b = draw.randrange(len(nodes)), draw.randrange(len(nodes))
        sign = audits.compare(nodes[a], nodes[b])
        assert (sign > 0) - (sign < 0) == (texts[a] > texts[b]) - (texts[a] < texts[b])


def test_plain_version_against_all_edits():
    """The string program itself, held against every sequence of edits of short conversations."""
    texts = {"x": "cut", "y": "Fine.", "z": " "}
    for pattern in itertools.product("sua", "xz", repeat=2):
        rows = [(r, texts[t] if t == "z" else f"{k}{texts[t]}") for k, (r, t) in enumerate(zip(pattern[::2], pattern[1::2]))]
        faults, best = faults_of(rows), None
        slots = [i for n in range(4) for i in itertools.product("ua", repeat=n)]
        for deeds in itertools.product(["K", "D", "Ru", "Ra"], repeat=len(rows)):
            if any(f in ("blank", "duplicate") and d != "D" for f, d in zip(faults, deeds)):
                continue
            for added in itertools.product(slots, repeat=len(rows) + 1):
                roles, audit, cost = "", "", 0
                for k, extra in enumerate(added):
                    roles, audit, cost = roles + "".join(extra), audit + "I" * len(extra), cost + 2 * len(extra)
                    if k < len(rows):
                        deed = deeds[k]
                        roles += {"K": rows[k][0], "D": "", "Ru": "u", "Ra": "a"}[deed]
                        audit += deed[0]
                        cost += {"K": 0, "D": 3, "R": 2}[deed[0]] + (deed != "D" and faults[k] == "truncated")
                if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
        assert plain_repair(rows)[:2] == best


def test_one_block_or_chains_of_small_ones_give_the_same(spark):
    rows = random_rows(1, 12, 9)
    for block_rows in (2, 5, 4096):
        check(spark, rows, block_rows, ids=(77, 78))


def test_long_conversation_of_regular_roles_with_ties(spark):
    rows = [(1, k, ["user", "assistant", "assistant", "user"][k % 4], f"Turn {k}.") for k in range(300)]
    check(spark, rows + [(2, 0, "system", "Alone.")], 16)


def test_repeated_rows_and_equal_turns(spark):
    rows = [(1, 1, "user", "A."), (1, 1, "user", "A."), (1, 1, "assistant", "B.")] * 40 + [(None, None, None, None)] * 50
    check(spark, rows, 8)


def test_empty_table_and_clashing_names(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turn_repair.audit_conversations(none, none).collect() == []
    rows = spark.createDataFrame([(1, 0, "user", "A.")], SCHEMA).selectExpr("*", "1 AS conv", "2 AS part", "3 AS seq", "'x' AS audit")
    (row,) = turn_repair.audit_conversations(rows, rows).collect()
    assert (row.audit, row.cost) == ("KI", 2)


def test_repaired_turns_follow_the_pattern(spark):
    rows = spark.createDataFrame(random_rows(3, 8, 8), SCHEMA)
    _, pieces, repaired = turn_repair.repair(rows, 4)
    roles = {}
    for r in repaired.orderBy("conv", "part", "seq", "place").collect():
        roles.setdefault(r.conv, []).append(r.role[0])
        assert r.edit in "KRI" and (r.edit != "I" or r.text == "")
    assert all(re.fullmatch("(s?(ua)+)?", "".join(r)) for r in roles.values())
    audits = sum(p.audit.count("K") + p.audit.count("R") + p.audit.count("I") for p in pieces.collect())
    assert audits == sum(map(len, roles.values()))


def test_registered_query_against_the_plain_version(spark):
    import zlib

    folder = "/root/testdata/sf0.001"
    rows = []
    given = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    for r in given:
        hit = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", r.text) if hit == 2 else r.text
        rows += [(r.conv_id, r.turn, "user" if hit == 4 else r.role, text)] * {0: 0, 3: 2}.get(hit, 1)
    found = {r[0]: tuple(r[1:]) for r in queries.QUERIES["op11_turn_repair"](spark, folder).collect()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    own = in_order(rows)
    assert found == {
        c: (gaps_of([r[1] for r in rows if r[0] == c]), *expected(own[c])) if c in own else empty
        for c in {r.conv_id for r in given}
    }
