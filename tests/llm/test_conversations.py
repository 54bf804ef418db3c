import hashlib
import itertools
import random
import zlib

import pytest

import __spark_entry__ as entry
from stemma.llm import audit_trie, conversations
from stemma.llm.audit_trie import Node
from stemma.llm.common import read
from stemma.llm.conversations import Costs

WHITE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, digest string, kind string"


def damaged(rows):
    """Rows of the table as the contract damages them, with their number of copies."""
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        yield conv, turn, role, text, {0: 0, 3: 2}.get(kind, 1)


def follows(state, initial):
    return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))


def faults(rows):
    """Fault of each row: b, d, t or none."""
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(WHITE)
        out.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, costs):
    """The least (cost, audit) and its turns, over whole strings by state."""
    best = {"": (0, "", [])}
    kinds = faults(rows)

    def put(into, state, cost, audit, turns):
        if state is not None and (state not in into or (cost, audit) < into[state][:2]):
            into[state] = (cost, audit, turns)

    def inserted(cells):
        for _ in range(3):
            new = dict(cells)
            for state, (cost, audit, turns) in cells.items():
                role = "assistant" if state == "u" else "user"
                put(new, role[0], cost + costs.insert, audit + "I", [*turns, (role, "")])
            cells = new
        return cells

    for (_, role, text), kind in zip(rows, kinds, strict=True):
        after = {}
        for state, (cost, audit, turns) in inserted(best).items():
            put(after, state, cost + costs.delete, audit + "D", turns)
            if kind in ("b", "d"):
                continue
            more = costs.truncated if kind == "t" else 0
            put(after, follows(state, role[:1]), cost + more, audit + "K", [*turns, (role, text)])
            new = "assistant" if state == "u" else "user"
            put(after, new[0], cost + more + costs.rerole, audit + "R", [*turns, (new, text)])
        best = after
    ends = inserted(best)
    return min((ends[s] for s in ("", "a") if s in ends), key=lambda x: x[:2])


def every(rows, costs, letters):
    """The least (cost, audit) of all strings of edits with at most ``letters`` insertions."""
    kinds, best = faults(rows), None
    for n in range(letters + 1):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
            for edits in itertools.product("DKR", repeat=len(rows)):
                state, cost, audit, ok = "", 0, "", True
                for i in range(len(rows) + 1):
                    for _ in range(places.count(i)):
                        state, cost, audit = "a" if state == "u" else "u", cost + costs.insert, audit + "I"
                    if i == len(rows):
                        break
                    edit, kind = edits[i], kinds[i]
                    audit += edit
                    if edit == "D":
                        cost += costs.delete
                        continue
                    ok = ok and kind not in ("b", "d")
                    cost += (costs.truncated if kind == "t" else 0) + (costs.rerole if edit == "R" else 0)
                    state = ("a" if state == "u" else "u") if edit == "R" else follows(state, rows[i][1][:1])
                    if state is None or not ok:
                        ok = False
                        break
                if ok and state in ("", "a"):
                    best = min(best or (cost, audit), (cost, audit))
    return best


def expected(rows, costs=Costs()):
    """All columns for each conversation of rows ``conv_id, turn, role, text, copies``."""
    convs = {}
    for conv, turn, role, text, copies in rows:
        convs.setdefault(conv, []).extend([(turn, role, text)] * copies)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        turns = [t for t, _, _ in own if t is not None]
        kinds = faults(own)
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, kept = cheapest(own, costs)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def got(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def odd_rows(seed=3):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool"]
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "why? ", "a.b", "x" * 50_000 + "."]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rnd.randint(0, 9)):
            rows.append((conv, rnd.choice([turn, turn, turn, turn + 3, None]), rnd.choice(roles), rnd.choice(texts), "d", "k"))
    return rows + rows[:20] + [(77, 0, "user", "hi.", "d", "k")] * 30 + [(-5, None, None, None, None, None)]


def test_strings_are_ordered_as_strings():
    rnd = random.Random(1)
    nodes = [Node()]
    for _ in range(400):
        nodes.append(Node(rnd.choice(nodes[-40:]), rnd.choice("DIKR")))
    for a, b in itertools.product(rnd.sample(nodes, 60), repeat=2):
        assert audit_trie.less(a, b) == ("".join(a.letters()) < "".join(b.letters()))
    node = nodes[-1]
    for depth in range(node.depth + 1):
        assert audit_trie.lifted(node, depth).letters() == node.letters()[:depth]


def test_colliding_hashes_are_found(monkeypatch):
    monkeypatch.setattr(audit_trie, "_PRIME", 3)  # nearly all hashes collide
    test_strings_are_ordered_as_strings()


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 2, 1, 1), Costs(3, 4, 1, 2), Costs(2, 2, 2, 0)])
def test_against_every_string_of_edits(costs):
    rnd = random.Random(8)
    for _ in range(60):
        rows = [(i, rnd.choice(["system", "user", "assistant", "tool"]), rnd.choice(["a.", "b.", "c", "", "d!"])) for i in range(rnd.randint(0, 4))]
        assert cheapest(rows, costs)[:2] == every(rows, costs, 3), rows


@pytest.mark.parametrize("segment", [1, 2, 3, 4096])
@pytest.mark.parametrize("costs", [Costs(), Costs(3, 4, 1, 2)])
def test_odd_rows_in_segments(spark, segment, costs):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = got(conversations.repair(conversations.damage(df), costs, segment))
    assert found == expected(damaged([r[:4] for r in rows]), costs)


def test_one_conversation_over_many_tasks(spark):
    rnd = random.Random(9)
    rows = [(1, t, rnd.choice(["user", "assistant"]), rnd.choice(["yes.", "no.", f"text {t}.", f"cut {t}", ""])) for t in range(3000)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    want = expected([(*r, 1) for r in rows])
    assert got(conversations.repair(df, segment=64)) == want
    turns = conversations.repaired_turns(df, segment=64).where("conv_id = 1").orderBy("position").collect()
    text = "\n".join(f"{r['role']}:{r['text']}" for r in turns)
    assert hashlib.sha256(text.encode()).hexdigest() == want[1][-1]
    assert [r["position"] for r in turns] == list(range(len(turns)))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conversations.repair(conversations.damage(df)).count() == 0
    assert conversations.repaired_turns(conversations.damage(df)).count() == 0


def test_query(spark, sf):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in read(spark, sf, "conversations").collect()]
    found = entry.queries()["op11_conversation_repair"](spark, sf)
    assert got(found) == expected(damaged(rows))
