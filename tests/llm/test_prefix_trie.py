import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from featureflow.llm import prefix_trie
from featureflow.llm.queries import op12_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, x string, depth string, `Turns` string"


def brute(rows, family=5):
    """The contract said over lists: one tuple per node."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn or 0, role or "", digest), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(abs(c) % family) * (1 if c > 0 else -1)
        made[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)

    def under(node):
        return [node, *[m for child in children[node] for m in under(child)]]

    out = []
    for node, cs in members.items():
        ends = sorted(c for c in cs if len(made[c]) == len(node))
        sub = under(node)
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in sub if m)
        out.append(
            (
                min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(children[node]), sum(not children[m] for m in sub),
                saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def table(spark, rows):
    return spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA).repartition(3)


def built(spark, rows):
    turns = table(spark, rows)
    nodes = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.sequences(turns)))
    return sorted((tuple(r[c] for c in COLUMNS) for r in nodes.collect()), key=repr)


def conversations(seed):
    pick = random.Random(seed)
    rows = []
    for c in pick.sample(range(-40, 120), 90):
        for turn in range(pick.randrange(1, 9)):
            number = pick.choice([turn, turn, turn, None, 3])
            rows.append((c, number, pick.choice(["user", "bot", None]), pick.choice(["a", "é漢", "", None, "longer text"])))
    rows += [(None, 0, "user", "nobody's")] * 3
    for c in range(1000, 1060):  # copies of one conversation
        rows += [(c, 0, "user", "same"), (c, 1, "bot", "same too"), (c, 1, "bot", "same too")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_lists(spark, seed):
    rows = conversations(seed)
    assert built(spark, rows) == brute(rows)


def test_turnless_and_lone_conversations(spark):
    # Few turns and an absent source: the head takes all of them away.
    rows = [(c, 0, "user", "only") for c in range(1, 5)] + [(7, t, "user", f"{t}" * 300) for t in range(30)]
    got = built(spark, rows)
    assert got == brute(rows) and any(r[1] == 0 and r[3] == 5 for r in got)
    assert built(spark, [(3, None, None, None)]) == brute([(3, None, None, None)])


def test_long_conversations_that_part_late(spark):
    """Shared beginnings of 60 turns, copies, ends within another's path, and a chain of later and later ends."""
    rows = []
    for c, size in ((10, 70), (15, 70), (20, 61), (25, 60), (30, 33), (35, 100), (40, 100)):
        rows += [(c, t, "user", f"turn {t}" if t < 60 else f"own {t} {c // 10}") for t in range(size)]
    rows += [(c, t, "bot", f"turn {t}") for c in range(50, 100, 5) for t in range(c - 40)]
    assert built(spark, rows) == brute(rows)


def test_order_of_role_and_text_matters(spark):
    rows = [(5, 0, "ab", "c"), (10, 0, "a", "bc"), (15, 0, "", "abc"), (20, 0, "2:ab", ""), (25, 0, "user", "p"), (25, 1, "user", "q"), (30, 0, "user", "q"), (30, 1, "user", "p")]
    assert built(spark, rows) == brute(rows)


def test_ids_packed_into_many_runs(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN_BYTES", 10)
    rows = [(5 * c, 0, "user", "same") for c in range(300)]
    assert built(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert built(spark, []) == []


def test_query_over_a_small_table(spark, tmp_path):
    rows = conversations(5)
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op12_conversation_trie(spark, str(tmp_path))
    assert tuple(got.columns) == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
