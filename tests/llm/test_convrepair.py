import hashlib
import random
import re
from itertools import groupby

import pytest
from compare import oracle, rows

from flowspark.llm.convrepair import BLANKS, Node, Search, digest, fault_of, repair
from flowspark.llm.queries import convrepair as registered

GOAL = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string"


def judged(conv):
    """(role, text, fault) of ordered (turn, role, text) rows."""
    out, seen = [], set()
    for _, role, text in conv:
        last = text.rstrip(BLANKS)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else None if last in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def every_way(conv, inserts=3):
    """All edits of a short conversation: (cost, letters, repaired rows), without any search order or pruning."""
    ways = [(0, "", ())]

    def inserted(found):
        new = found
        for _ in range(inserts):
            new = [(c + 5, a + "I", r + ((role, ""),)) for c, a, r in new for role in ("user", "assistant") if a.count("I") < inserts]
            found = found + new
        return found

    for role, text, fault in judged(conv):
        after = []
        for c, a, r in inserted(ways):
            after.append((c + 2, a + "D", r))
            if fault not in ("blank", "duplicate"):
                late = 5 if fault else 0
                after.append((c + late, a + "K", (*r, (role, text))))
                after += [(c + late + 1, a + "R", (*r, (new, text))) for new in ("user", "assistant")]
        least = {}
        for c, a, r in after:  # equal initials go on alike; keep the least letters of them
            key = "".join(x[0][:1] or "?" for x in r)
            if GOAL.match(key) or GOAL.match(key + "a"):
                least[key] = min(least.get(key, (c, a, r)), (c, a, r))
            elif key == "s":
                least[key] = min(least.get(key, (c, a, r)), (c, a, r))
        ways = list(least.values())
    return min((c, a, r) for c, a, r in inserted(ways) if GOAL.match("".join(x[0][:1] or "?" for x in r)))


def by_strings(conv):
    """The same by a table of whole letters per state, for longer conversations."""
    ways = {0: (0, "", ())}

    def put(table, state, way):
        if state not in table or way < table[state]:
            table[state] = way

    def inserted(table):
        table = dict(table)
        for source, target, role in ((0, 2, "user"), (1, 2, "user"), (3, 2, "user"), (2, 3, "assistant")):
            if source in table:
                c, a, r = table[source]
                put(table, target, (c + 5, a + "I", (*r, (role, ""))))
        return table

    for role, text, fault in judged(conv):
        after = {}
        for state, (c, a, r) in inserted(ways).items():
            put(after, state, (c + 2, a + "D", r))
            if fault not in ("blank", "duplicate"):
                late, want = (5 if fault else 0), "a" if state == 2 else "u"
                made = 3 if state == 2 else 2
                if role[:1] == want or (state == 0 and role[:1] == "s"):
                    put(after, 1 if role[:1] == "s" else made, (c + late, a + "K", (*r, (role, text))))
                put(after, made, (c + late + 1, a + "R", (*r, ("assistant" if state == 2 else "user", text))))
        ways = after
    ends = inserted(ways)
    return min(ends[s] for s in (0, 3) if s in ends)


def plain(table, best):
    """Digest rows of a table by plain Python."""
    out = []
    order = sorted(table, key=lambda r: (r[0] is not None, r[0] or 0))
    for conv_id, group in groupby(order, key=lambda r: r[0]):
        conv = [(t, " " if a is None else a, " " if b is None else b) for _, t, a, b in group]
        conv.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = [f for _, _, f in judged(conv)]
        turns = [t for t, _, _ in conv if t is not None]
        pairs = [x[1][:1] + y[1][:1] for x, y in zip(conv, conv[1:])]
        cost, audit, repaired = best(conv)
        text = "\n".join(f"{a}:{b}" for a, b in repaired)
        out.append((
            conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        ))
    return out


def key(row):
    return (row[0] is not None, row[0] or 0)


def spark_rows(spark, table):
    return sorted((tuple(r) for r in digest(repair(spark.createDataFrame(table, SCHEMA).repartition(3))).collect()), key=key)


def random_table(seed, convs, size):
    pick = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "ua"]
    texts = ["Yes.", "No", "", " \n", "Why? ", None, "A!\t", "b "]
    return [
        (c if c else None, pick.choice([None, n, n, n, n // 2, n * 3]), pick.choice(roles), pick.choice(texts) if pick.random() < 0.6 else f"t{pick.random()}.")
        for c in range(convs) for n in range(pick.randrange(size + 1))
    ]


def test_query_agrees_with_sql(spark, sf):
    df, rel = registered.query(spark, sf), oracle(sf).sql(registered.SQL)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(rel.columns, rel.fetchall())


def test_against_every_way(spark):
    table = random_table(3, 150, 5)
    assert spark_rows(spark, table) == plain(table, every_way)


def test_longer_conversations(spark):
    table = random_table(4, 12, 150)
    assert spark_rows(spark, table) == plain(table, by_strings)


def test_repaired_rows(spark):
    table = [(1, 0, "user", "Hi."), (1, 1, "user", "Well."), (1, 1, "user", "Well."), (1, 2, "user", "What?"), (1, 3, "system", "Cut o")]
    got = [tuple(r) for r in repair(spark.createDataFrame(table, SCHEMA)).select("step", "edit", "role", "text", "fault").collect()]
    assert got == [
        (0, "D", "user", "Hi.", None), (1, "K", "user", "Well.", None), (2, "D", "user", "Well.", "duplicate"),
        (3, "R", "assistant", "What?", None), (4, "D", "system", "Cut o", "truncated"),
    ]


def test_clashing_columns_dropped_rows_and_empty_tables(spark):
    table = [(1, 0, "user", "Hi.", True, "x", 5), (1, 1, "assistant", "Ho.", None, "x", 5), (2, 0, "user", "gone", False, "x", 5)]
    df = spark.createDataFrame(table, SCHEMA + ", here boolean, edit string, step int")
    got = {r[0]: tuple(r)[1:] for r in digest(repair(df, present="here")).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got == {1: (0, 0, 0, 0, 0, 2, "D", nothing), 2: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert digest(repair(spark.createDataFrame([], SCHEMA))).count() == 0


def test_turns_at_the_ends_of_long(spark):
    table = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")]
    assert spark_rows(spark, table)[0][1] == (1 << 63) - 1


def test_long_conversation_holds_few_rows(spark):
    """Memory follows the unresolved rows, not the conversation."""
    pick, search, most, live, done = random.Random(1), Search(), 0, 0, 0
    for n in range(20_000):
        role = pick.choice("uaua" + "s")
        text = pick.choice(["x.", "x.", "x.", "x", ""])
        search.add((n, role, text, None, None), role, fault_of(text, False))
        live += 1
        done += sum(1 for _ in search.settled())
        most = max(most, live - done)
    rest = [n for n in search.finish() if n.row]
    assert done + len(rest) == 20_000 and most < 200


def test_released_nodes_leave_the_tree():
    root = Node(None, 0, "", None)
    a = Node(root, 0, "D", None)
    b = Node(a, 0, "D", None)
    b.refs = 1
    b.release()
    assert root.refs == 0 and not root.kids


@pytest.mark.parametrize("size", [1, 3000])
def test_one_role_throughout(spark, size):
    table = [(7, n, "user", f"t{n}.") for n in range(size)]
    ((_, _, _, _, _, illegal, cost, audit, _),) = spark_rows(spark, table)
    # two users make a pair by one new role; an odd one goes, and going first reads least
    assert (illegal, cost, audit) == (size - 1, (size // 2) + 2 * (size % 2), "D" * (size % 2) + "KR" * (size // 2))
