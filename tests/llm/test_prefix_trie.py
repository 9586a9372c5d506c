import hashlib
import random
import zlib

import pyarrow as pa
import pytest

from ebbtide.llm import prefix_trie, queries
from tests.conftest import DATA
from tests.llm.cases import CLASHING

SCHEMA = "conv_id long, turn long, role string, text string"


def _lists(data):
    """The turns of each conversation in order, as (role, text)."""
    out = {}
    for conv, turn, role, text in data:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [t[2:] for t in sorted(turns)] for conv, turns in out.items()}


def _rebuilt(lists):
    out = {}
    for conv, turns in lists.items():
        h = zlib.crc32(str(conv).encode()) % 9
        out[conv] = lists.get(conv - conv % 5, [])[:h] + turns[h:]
    return out


def _nodes(lists):
    """The contract's columns in plain loops."""
    members, ends = {}, {}
    for conv, turns in lists.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
        ends.setdefault(tuple(turns), []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, own in members.items():
        gain = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += gain
    return sorted(
        (
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children.get(node, [])), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, own in members.items()
    )


def _gathered(df):
    return prefix_trie.gathered(df, df["conv_id"], df["turn"], df["role"], df["text"])


def _found(df):
    return sorted(tuple(r) for r in prefix_trie.trie(_gathered(df)).select(*prefix_trie.RESULT).collect())


def _random(seed, convs, deepest, words):
    """Conversations that share beginnings of any depth, end inside others, and are equal to others."""
    source, data, known = random.Random(seed), [], [[]]
    ids = random.Random(seed + 1).sample(range(10 * convs), convs)
    for conv in ids:
        base = source.choice(known)
        turns = base[: source.randint(0, len(base))] if source.random() < 0.8 else list(base)
        turns = turns + [(source.choice("ab"), f"é{source.randrange(words)}") for _ in range(source.randint(0, max(0, deepest - len(turns))) if source.random() < 0.7 else 0)]
        known.append(turns)
        data += [(conv, i, *t) for i, t in enumerate(turns)]
    source.shuffle(data)
    return data


@pytest.mark.parametrize(("seed", "convs", "deepest", "words", "turns"), [(1, 300, 6, 2, 1 << 20), (2, 400, 5, 2, 100), (3, 200, 40, 3, 200), (4, 60, 3, 1, 20), (5, 3, 2, 2, 2)])
def test_nodes_are_those_of_plain_loops(spark, monkeypatch, seed, convs, deepest, words, turns):
    """Also where many tasks share nodes."""
    monkeypatch.setattr(prefix_trie, "TASK_TURNS", turns)
    data = _random(seed, convs, deepest, words)
    assert _found(spark.createDataFrame(data, SCHEMA).repartition(3)) == _nodes(_lists(data))


def test_many_tasks(spark, monkeypatch):
    """Nearly every sequence is the first or the last of its task."""
    monkeypatch.setattr(prefix_trie, "TASK_TURNS", 10)
    data = _random(6, 120, 12, 2)
    assert _found(spark.createDataFrame(data, SCHEMA)) == _nodes(_lists(data))


def test_one_first_turn_and_one_conversation_everywhere(spark):
    data = [(i, t, "user", ["hello", "same", "end"][t]) for i in range(2000) for t in range(3)]
    data += [(10_000 + i, t, "user", "hello" if t == 0 else f"{i}") for i in range(500) for t in range(2)]
    assert _found(spark.createDataFrame(data, SCHEMA)) == _nodes(_lists(data))


def test_very_deep_conversations(spark):
    """Thousands of turns, shared almost to the end."""
    data = [(c, t, "user", f"{t}" if t < 2990 + c else f"{c}.{t}") for c in range(4) for t in range(3000)]
    data += [(9, t, "user", f"{t}") for t in range(1500)]
    found = _found(spark.createDataFrame(data, SCHEMA))
    lists = _lists(data)
    assert len(found) == len({tuple(turns[: d + 1]) for turns in lists.values() for d in range(2985, len(turns))}) + 2986
    root = next(r for r in found if r[1] == 0)
    gain = sum((sum(len(x) >= d and x[:d] == lists[0][:d] for x in lists.values()) - 1) * len(str(d - 1)) for d in range(1, 2991))
    gain += sum((sum(x[:d] == lists[3][:d] for x in lists.values()) - 1) * len(str(d - 1)) for d in range(2991, 2994) if lists[3][:d] != lists[0][:d])
    assert root[3:6] == (5, 1, 4) and root[6] == gain


def test_awkward_rows(spark):
    data = [
        (1, None, "user", "a"), (1, 0, None, "b"), (1, 0, None, "b"), (1, 1, "user", None), (2, None, "user", "a"), (2, 0, "", "b"),
        (2, 0, None, ""), (None, 0, "user", "lost"), (None, None, None, None), (3, 0, None, None), (4, 0, "", ""), (-7, 0, "us", "era"), (-8, 0, "user", "a"),
        (5, 0, "user", "word " * 100_000), (6, 0, "user", "word " * 100_000), (6, 1, "é", "日本"),
    ]
    df = spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in data], f"{SCHEMA}, " + ", ".join(f"`{c}` string" for c in CLASHING))
    assert _found(df) == _nodes(_lists(data))
    assert _found(df.where("false")) == []


def test_ids_are_digested_piece_by_piece(monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 3)
    data = sorted((f"s{i % 4 if i < 20 else 0}", i) for i in range(-3, 40))
    batches = [pa.RecordBatch.from_pylist([{"sequence": s, "conv_id": i} for s, i in data[at : at + 5]]) for at in range(0, len(data), 5)]
    pieces = pa.Table.from_batches(list(prefix_trie._pieces(batches))).sort_by([("sequence", "ascending"), ("first_id", "ascending")])
    assert max(p.count(",") for p in pieces.column("piece").to_pylist()) == 2
    got = {r["sequence"]: r["ends_sha256"] for b in prefix_trie._digests(pieces.to_batches(max_chunksize=2)) for r in b.to_pylist()}
    assert got == {s: hashlib.sha256(",".join(str(i) for t, i in data if t == s).encode()).hexdigest() for s in {s for s, _ in data}}


def test_query(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.QUERIES["op12_conversation_prefix_trie"](spark, DATA)
    assert found.columns == list(prefix_trie.RESULT)
    assert sorted(tuple(r) for r in found.collect()) == _nodes(_rebuilt(_lists(data)))


def test_query_with_absent_donors_and_few_turns(spark, tmp_path):
    data = [(c, t, "user", f"{c if t > 2 else 0}.{t}") for c in (1, 2, 3, 5, 6, 9, 21, 22, 23, 24, 30, 33) for t in range(c % 4 + 1)]
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    rebuilt = _rebuilt(_lists(data))
    assert [] in rebuilt.values()
    found = queries.QUERIES["op12_conversation_prefix_trie"](spark, str(tmp_path))
    assert sorted(tuple(r) for r in found.collect()) == _nodes(rebuilt)
