"""The conversation trie against dictionaries of prefixes, and the radix tree against a dictionary."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from plumbline.llm import conversation_trie, queries, radix_tree

SCHEMA = "conv_id long, turn long, role string, text string, conv long, depth string, `end` string"


def identity(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    digest = hashlib.sha256(str(len(role)).encode() + b":" + role + text).hexdigest()[:32]
    return digest + f"{len(text):08x}"


def brute(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            held[conv].append((turn is not None, turn or 0, identity(role, text), (role or "", text or "")))
    turns = {c: [t[3] for t in sorted(own)] for c, own in held.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, own in members.items():
        size = (len(own) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += size
    found = set()
    for path, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if rebuilt[c] == path)
        parent = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found.add((min(own), len(path), parent, len(own), children[path], leaves[path], saved[path], digest))
    return found


def trie(spark, rows, tmp_path):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = [tuple(r) for r in queries.op13_conversation_trie(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got))
    return set(got)


def conversations(count, turns, choices, seed=1):
    """Conversations over few different turns, so that many share much."""
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(rng.randint(1, turns)):
            text = "first" if turn == 0 and rng.random() < 0.5 else f"text {rng.randrange(choices)} é"
            rows.append((conv, turn, "user" if turn % 2 else "assistant", text))
    return rows


@pytest.mark.parametrize("first", [1, 2, 64])
def test_matches_dictionaries_over_segments_and_ranges(spark, tmp_path, monkeypatch, first):
    monkeypatch.setattr(conversation_trie, "FIRST", first)
    monkeypatch.setattr(conversation_trie, "GROWTH", 2)
    monkeypatch.setattr(conversation_trie, "LOT", 3)
    rows = conversations(150, 14, 2)
    # Copies of whole conversations, also long ones.
    rows += [(1000 + c, *r[1:]) for c in range(0, 60, 5) for r in rows if r[0] == 7]
    rows += [(5000 + 5 * c, t, "user", f"long {t}") for c in range(3) for t in range(70 + c)]
    assert trie(spark, rows, tmp_path) == brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = conversations(30, 6, 2, 3)
    rows += [(40, None, None, None), (40, None, "user", ""), (40, 3, "", None), (40, 3, "", None), (40, 3, "x", "tie")]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (2**62 + 1, 0, "a", "b"), (2**62 + 3, 0, "a", "b")]
    rows += [(-3, t, "a", f"minus {t}") for t in range(12)] + [(-12, 0, "ab", "c"), (-14, 0, "a", "bc")]
    rows += [(60 + c, t, "user", "same" * 2000) for c in range(6) for t in range(9)] + rows[:4]
    assert trie(spark, rows, tmp_path) == brute(rows)


def test_turnless_conversations_and_empty_table(spark, tmp_path):
    silent = next(c for c in range(1, 1000) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1)
    rows = [(silent, 0, "user", "dropped, for its base is absent")]
    assert trie(spark, rows, tmp_path / "silent") == brute(rows) == {
        (silent, 0, None, 1, 0, 1, 0, hashlib.sha256(str(silent).encode()).hexdigest())
    }
    assert trie(spark, [], tmp_path / "none") == set()


@pytest.mark.parametrize("count", [3, 12, 40, 200, 256])
def test_node_layouts_grow_with_their_children(count):
    rng = random.Random(count)
    keys = {bytes([b]) + bytes(rng.randrange(3) for _ in range(rng.randrange(6))) for b in range(count) for _ in range(5)}
    held = {key: place for place, key in enumerate(sorted(keys))}
    root = radix_tree.Node(b"")
    for key in rng.sample(sorted(keys), len(keys)):
        radix_tree.insert(root, key, held[key])
    kind = type(root.children)
    room = getattr(root.children, "room", None)
    assert (kind, room) == {
        3: (radix_tree.Sorted, 4), 12: (radix_tree.Sorted, 16), 40: (radix_tree.Indexed, None),
        200: (radix_tree.Direct, None), 256: (radix_tree.Direct, None),
    }[count]
    paths, found = [], {}
    order = radix_tree.preorder(root)
    # A node's bytes: its parent's, the branch, its own prefix.
    branch = {id(child): byte for node, *_ in order if node.children for byte, child in node.children.items()}
    for node, parent, _, end in order:
        path = node.prefix if parent < 0 else paths[parent] + bytes([branch[id(node)]]) + node.prefix
        paths.append(path)
        assert len(path) == end
        if node.value is not None:
            found[path] = node.value
    assert found == held


def test_open_parts_of_ranges_add_up_to_the_whole():
    rng = random.Random(4)
    ids = [bytes.fromhex(identity("user", f"turn {i}")) for i in range(3)]
    keys = sorted({b"".join(rng.choice(ids) for _ in range(rng.randint(1, 5))) for _ in range(60)})
    strings = [
        {"key": k, "n": 1, "low": 100 - i, "end": 100 - i, "root_low": 0, "below_children": 0, "below_leaves": 0, "below_saved": 0}
        for i, k in enumerate(keys)
    ]

    def nodes(cuts):
        parts = [strings[a:b] for a, b in zip([0, *cuts], [*cuts, len(strings)], strict=True)]
        made = []
        for i, part in enumerate(parts):
            sides = [(parts[i - 1][-1], part[0]) if i else None, (part[-1], parts[i + 1][0]) if i + 1 < len(parts) else None]
            before, after = (
                conversation_trie._agreed({"grp": 0, "key": s[0]["key"]}, {"grp": 0, "key": s[1]["key"]}) if s else -1 for s in sides
            )
            made += conversation_trie.group_nodes(0, part, before, after, 0)
        table = conversation_trie.pa.Table.from_pylist([r for r in made if r["open"]], schema=conversation_trie.NODE_ARROW)
        opened = conversation_trie.merge_open(table).to_pylist()
        low = {r["node"]: r["low"] for r in opened}
        closed = [r | {"parent_low": low[r["parent"]] if r["parent"] else r["parent_low"]} for r in made if not r["open"]]
        names = ("depth", "low", "parent_low", "n", "children", "leaves", "saved", "end")
        return sorted((tuple(r[name] for name in names) for r in [*closed, *opened]), key=repr)

    whole = nodes([])
    assert len(whole) > 50
    for cuts in ([1], [20, 40], list(range(1, len(strings)))):
        assert nodes(cuts) == whole
