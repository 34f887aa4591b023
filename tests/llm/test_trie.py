"""The conversation trie against a plain one that is built in memory."""

import hashlib
import os
import random
import zlib
from collections import defaultdict

import pytest

from millrace.llm import trie
from millrace.llm.queries import QUERIES, table

FOLDER = "/root/testdata/sf0.01"
TURNS = "conv_id long, turn long, role string, text string, path string, sid int, steps int"


def plain_trie(paths):
    """Sorted nodes of {conv: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, path in paths.items():
        path = tuple(path)
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
        ends[path].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        leaves = 0 if children[node] else 1
        for child in children[node]:
            saved, leaves = saved + below[child][0], leaves + below[child][1]
        below[node] = saved, leaves
    out = []
    for node, convs in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children[node]), below[node][1], below[node][0], digest))
    return sorted(out, key=repr)


def ordered(rows):
    """Own turns of each conversation: by number, null first, then by the digest of role and text."""
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[conv].append((turn is not None, turn or 0, digest, role, text))
    return {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(own):
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        out[conv] = own.get(conv - conv % 100, [])[:h] + turns[h:]
    return out


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_turns(seed, n):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        conv = r.randrange(0, 700)
        for turn in range(r.randint(0, 7)):
            text = r.choice(["hello", "é" * r.randint(0, 3), f"own {k}", None, "yes"])
            rows.append((conv, r.choice([None, turn, turn, turn]), r.choice(["user", "assistant", None]), text, "x", 1, 2))
    rows += [(None, 1, "user", "nameless", "x", 1, 2), *rows[:30]]
    return rows


@pytest.fixture(scope="module")
def turns():
    """Many conversations of which a third are copies of one, others share long openings, one is very long."""
    rows = random_turns(3, 400)
    same = [("user", "same"), ("assistant", "answer"), ("user", "thanks")] * 4
    for conv in range(1000, 1250):
        rows += [(conv, k, role, text, "x", 1, 2) for k, (role, text) in enumerate(same)]
    for conv in range(2000, 2060):
        rows += [(conv, k, "user", f"deep {min(k, 90 + conv % 7)} {'x' * (k % 5)}", "x", 1, 2) for k in range(100 + conv % 3)]
    rows += [(3001, k, "user", f"long {k}", "x", 1, 2) for k in range(3000)]
    return rows


@pytest.mark.parametrize("ranges, sample_chars", [(1, 1 << 26), (4, 1 << 26), (40, 1 << 26), (16, 1 << 14)])
def test_nodes_are_those_of_a_plain_trie(spark, turns, ranges, sample_chars):
    paths = trie.turn_paths(spark.createDataFrame(turns, TURNS).repartition(5))
    assert found(trie.prefix_trie(paths, ranges, sample_chars)) == plain_trie(ordered(turns))


def test_spliced_conversations(spark, turns):
    rows = [*turns, *[(-k, 0, "user", f"negative {k}", "x", 1, 2) for k in (1, 99, 100, 101)]]
    own = ordered(rows)
    paths = trie.spliced(trie.turn_paths(spark.createDataFrame(rows, TURNS)))
    want = rebuilt({c: t for c, t in own.items() if c >= 0})
    got = {r.conv_id: [(s.digest, s.size) for s in r.steps] for r in paths.collect()}
    digests = {c: [(hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest(), len(t)) for r, t in path] for c, path in want.items()}
    assert {c: p for c, p in got.items() if c >= 0} == digests
    assert set(got) == set(own)  # turnless ones, too


def test_rows_leave_before_the_end_of_a_range(spark, turns, monkeypatch):
    """Small batches within one range give the same rows as one batch at the end."""
    paths = ordered(turns)
    rows = []
    for conv, path in paths.items():
        steps = [(hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest(), len(t)) for r, t in path]
        rows.append(("".join(d for d, _ in steps), conv, [n for _, n in steps]))
    rows.sort(key=lambda r: (r[0], r[1]))
    skeleton = trie.Skeleton([(rows[len(rows) // 2][0][:32], trie.NO_ID)])

    def walked():
        out = []
        for shard in (0, 1):
            walk = trie._Walk(shard, skeleton)
            for path, conv, sizes in rows:
                if ((path, conv) >= skeleton.splitters[0]) == bool(shard):
                    batch = walk.add(path, conv, sizes)
                    out += batch.to_pylist() if batch else []
            walk.end()
            out += walk.batch().to_pylist()
        return sorted(map(str, out))

    whole = walked()
    monkeypatch.setattr(trie, "FLUSH", 2)
    assert walked() == whole


def test_preorder_of_the_skeleton():
    a, b, c = ("".join(x * 32 for x in path) for path in ("ab", "abc", "d"))
    skeleton = trie.Skeleton([(a, 1), (a, 5), (b, 2), (c, 3)])
    assert skeleton.ids == [[0, 1, 2], [0, 1, 2], [0, 1, 2, 3], [0, 4]]
    assert (skeleton.parent, skeleton.end, skeleton.children) == ([-1, 0, 1, 2, 0], [5, 4, 4, 4, 5], [2, 1, 1, 0, 0])


def test_empty_table(spark):
    assert trie.prefix_trie(trie.spliced(trie.turn_paths(spark.createDataFrame([], TURNS)))).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_query(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, FOLDER, "conversations").collect()]
    assert found(QUERIES["op11_conversation_trie"](spark, FOLDER)) == plain_trie(rebuilt(ordered(rows)))
