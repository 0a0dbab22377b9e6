import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import conversation_repair as repairs
from tidemark.llm import queries

ZERO = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def cheapest(rows):
    """Uniform-cost search over (cost, audit); rows are (initial, must go, truncated)."""
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, audit, i, role = heapq.heappop(queue)
        if (i, role) in done:
            continue
        done.add((i, role))
        if i == len(rows) and role in ("", "a"):
            return cost, audit
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[role]
        made = follows[-1]
        heapq.heappush(queue, (cost + 2, audit + "I", i, made))
        if i < len(rows):
            initial, goes, truncated = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, role))
            if not goes:
                heapq.heappush(queue, (cost + 2 + truncated, audit + "R", i + 1, made))
                if initial and initial in follows:
                    heapq.heappush(queue, (cost + truncated, audit + "K", i + 1, initial))


def brute_force(rows):
    """The contract over rows (turn, role, text) of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    if not rows:
        return ZERO
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, shown, count = set(), [], defaultdict(int)
    for _, role, text in rows:
        ends = re.findall("[^\x20\x09-\x0d]", text)
        fault = "blank" if not ends else "duplicate" if (role, text) in seen else "truncated" if ends[-1] not in ".!?" else None
        seen.add((role, text))
        count[fault] += 1
        shown.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = cheapest(shown)
    out, at, last = [], iter(rows), ""
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else next(at)
        if edit != "D":
            if edit in "IR":
                role = "assistant" if last == "u" else "user"
            out.append(f"{role}:{text}")
            last = role[:1]
    assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in out))
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv] += []
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out[conv] += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def table(spark, rows, extra="audit string, copies int, place int"):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], f"conv_id bigint, turn bigint, role string, text string, {extra}")


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_search_against_uniform_cost():
    draw = random.Random(5)
    for _ in range(3000):
        letters = draw.choice(["ua", "suax", "sx", "u", "uaaus", "x", "s"])
        rows = [(draw.choice(letters), draw.random() < 0.2, draw.random() < 0.3) for _ in range(draw.randint(0, 12))]
        given = [repairs.Row(i, g, t and not g) for i, g, t in rows]
        assert repairs.search(given, repairs.START, repairs.ENDS) == cheapest([(i, g, t and not g) for i, g, t in rows])


def test_bounds_are_below_every_way():
    rows = [repairs.Row(i, False, i == "s") for i in "ssuxaau"]
    bounds = repairs.lower_bounds(rows, repairs.ENDS)
    assert len(bounds) == 8 and bounds[0][repairs.START] == repairs.search(rows, repairs.START, repairs.ENDS)[0]


def test_long_conversations_take_linear_time():
    rows = [repairs.Row("sxua"[i * i % 4], i % 5 == 0, i % 3 == 0) for i in range(4000)]
    cost, audit = repairs.search(rows, repairs.START, repairs.ENDS)
    assert cost > 0 and sum(audit.count(x) for x in "KRD") == 4000


@pytest.mark.parametrize("segment", [256, 2, 1])
def test_odd_rows(spark, segment):
    rows = [
        (None, 1, "user", "a."), (None, 1, "user", "b."), (None, None, None, None), (None, None, "assistant", "c?"),
        (1, None, "user", "only"), (2, 5, "", "x."), (2, 9, "tool", "y!"), (2, 9, "User", " \t"), (3, 1, "user", ""),
        *[(4, 7, "user", "same.")] * 5, (4, 8, "assistant", "same."), (4, 9, "user", "same."), (4, -3, "assistant", "Ü \x0b"),
        (5, 1, "system", "s"), (5, 2, "system", "t."), (6, 1, "assistant", "a\nb."), (6, 2, "user", "x " * 50_000),
        *[(7, i, "su ua"[i % 5], f"{i * i % 7}.") for i in range(40)],
    ]
    kept = defaultdict(list)
    for conv, *row in rows:
        kept[conv].append(tuple(row))
    assert found(repairs.repair(table(spark, rows), segment=segment)) == {k: brute_force(v) for k, v in kept.items()}


def test_a_conversation_of_many_rows_over_many_tasks(spark):
    rows = [(1, i // 3, ("user", "assistant", "x")[i * 7 % 3], f"{i % 50}{'.' * (i % 2)}") for i in range(3000)]
    rows += [(i, 1, "user", "q.") for i in range(2, 200)]
    kept = defaultdict(list)
    for conv, *row in rows:
        kept[conv].append(tuple(row))
    assert found(repairs.repair(table(spark, rows).repartition(7), segment=64)) == {k: brute_force(v) for k, v in kept.items()}


def test_empty_table_and_repeated_rows(spark):
    assert repairs.repair(table(spark, [])).count() == 0
    rows = [(1, 1, "user", "q.")] * 20_000 + [(1, 2, "assistant", "a.")]
    r = found(repairs.repair(table(spark, rows)))[1]
    assert (r[2], r[5], r[6]) == (19_999, 3 * 19_999, "K" + "D" * 19_999 + "K")


def test_damage_and_the_query(spark, sf, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    expected = {k: brute_force(v) for k, v in damage(rows).items()}
    assert {v[6][:1] for v in expected.values()} >= {"K"} and len({v[5] for v in expected.values()}) > 3
    got = queries.op13_conversation_repair(spark, sf)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found(got) == expected
    rows += [(None, 1, None, None), (None, None, "user", "x"), (10**6, 0, "user", "hi."), (10**6 + 1, None, "user", "hi.")]
    rows += [(10**6 + i, i, "user", "hi.") for i in range(2, 90)]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    expected = {k: brute_force(v) for k, v in damage(rows).items()}
    assert ZERO in expected.values()
    assert found(queries.op13_conversation_repair(spark, str(tmp_path))) == expected
