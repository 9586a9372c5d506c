"""The trie of conversation prefixes: what conversations share, and what each node saves.

A node of depth d is a distinct sequence of d turns (role and text) with which at least one conversation starts; the
root has depth 0. The trie is built by truncation peeling: from the deepest level up, the conversations that end at a
level merge with the nodes that survive from the level below, the last turn of each is stripped, and what is left is
regrouped by its remaining turns. One regrouping finds the nodes of a level and adds up their members, children,
leaves and savings at once, so nothing is read twice.

On the cluster:

* Turns travel as digests and byte counts. Conversations that are equal as a whole become one sequence with a count
  before anything else, so that a conversation that is found everywhere is one row.
* Sequences are range-partitioned and sorted by their turns, not grouped by their first ones: a first turn that every
  conversation has spreads over all tasks. Each task peels its own sequences, whatever their depth.
* Only the prefixes of a task's first and last sequence can reach into other tasks. These two are not peeled there: what
  hangs off their nodes is added up, and all such border sequences, two per task, are peeled in one last step of the
  same kind. Its input grows with the number of tasks and the length of a conversation, not with the number of rows.
* Ids of the conversations that end at a node are joined and digested in ascending order as a stream: ids are sorted in
  ranges, each range gives a node one piece of text at most, and the pieces of a node are read one after the other.

A task holds the digests of some ``TASK_TURNS`` turns, or of one conversation that is longer (40 bytes a turn); texts are never held.

Order and nulls: turns are ordered by turn number (null first), and by role and text where numbers are equal. A null role or
text is empty. Rows without a conversation id belong to none and are left out. A conversation without turns is a member of the
root alone. An empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm import hashing
from ebbtide.llm.frames import mapped, sized, stored

#: Turns that a task peels: at most so many (a longer conversation aside), and at least so many if they fill all tasks.
TASK_TURNS, LEAST_TURNS = 1 << 20, 1 << 15
#: Rows of a result batch, and ids that are joined to one piece of text.
BATCH, PIECE_IDS = 1 << 16, 1 << 16
DIGEST_BYTES = 16
TURN = "struct<digest:binary,bytes:long>"


def gathered(conversations: DataFrame, conv_id: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """One row per conversation: ``conv_id`` and its ``turns`` in order, each as a digest and the bytes of its text."""
    empty = F.lit("")
    rows = conversations.select(
        conv_id.cast("long").alias("conv_id"), turn.alias("turn"), F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text")
    ).where("conv_id IS NOT NULL")
    ordered = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length("role"), F.lit(":"), "role", "text"), 256)), 1, DIGEST_BYTES)
    one = F.struct(F.col("place"), digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes"))
    turns = rows.withColumn("place", F.row_number().over(ordered)).select("conv_id", one.alias("turn"))
    lists = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return lists.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["bytes"])).alias("turns"))


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (sequence, id) rows as one row per sequence and at most ``PIECE_IDS`` ids: the first id, and all joined."""
    sequence, ids = None, []
    out: list[tuple[str, int, str]] = []

    def close() -> None:
        if ids:
            out.append((sequence, ids[0], ",".join(map(str, ids))))
            ids.clear()

    for batch in batches:
        for own, key in zip(batch.column("sequence").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if own != sequence or len(ids) >= PIECE_IDS:
                close()
                sequence = own
            ids.append(key)
        yield _piece_batch(out)
        out.clear()
    close()
    yield _piece_batch(out)


def _piece_batch(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.string()))]
    return pa.RecordBatch.from_arrays(columns, ["sequence", "first_id", "piece"])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each sequence's pieces, which come one after the other."""
    sequence, state = None, hashlib.sha256()
    for batch in batches:
        done = []
        for own, piece in zip(batch.column("sequence"), batch.column("piece"), strict=True):
            if own.as_py() != sequence:
                if sequence is not None:
                    done.append((sequence, state.hexdigest()))
                sequence, state = own.as_py(), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_buffer())
        yield _ends_batch(done)
    yield _ends_batch([(sequence, state.hexdigest())] if sequence is not None else [])


def _ends_batch(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], ["sequence", "ends_sha256"])


def sequences(lists: DataFrame) -> DataFrame:
    """One row per distinct sequence of turns: its ``turns``, the smallest ``conv_id``, ``n`` conversations and
    ``ends_sha256``, the digest of their ids in ascending order."""
    whole = F.concat_ws("", F.transform("turns", lambda t: F.hex(t["digest"])))
    keyed = stored(lists.withColumn("sequence", F.sha2(whole, 256)), "trie-conversations")
    distinct = keyed.groupBy("sequence").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("turns").alias("turns"))
    ids = keyed.select("sequence", "conv_id").repartitionByRange("conv_id").sortWithinPartitions("sequence", "conv_id")
    pieces = mapped(ids, _pieces, "sequence string, first_id long, piece string")
    placed = stored(pieces, "trie-pieces").repartition("sequence").sortWithinPartitions("sequence", "first_id")
    ends = mapped(placed, _digests, "sequence string, ends_sha256 string")
    return stored(distinct.join(ends, "sequence"), "trie-sequences")


class _Paths:
    """Sorted sequences as flat arrays, with two numbers that tell each of their prefixes."""

    def __init__(self, conv: np.ndarray, n: np.ndarray, ends: list[str], digests: np.ndarray, sizes: np.ndarray, offsets: np.ndarray) -> None:
        self.conv, self.n, self.ends, self.digests, self.bytes, self.offsets = conv, n, ends, digests, sizes, offsets
        self.depth = np.diff(offsets)
        place = np.arange(len(digests)) - np.repeat(offsets[:-1], self.depth)
        lanes = []
        for lane in range(2):
            own = hashing.mix(digests[:, lane] ^ hashing.mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(lane)))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(own, dtype=np.uint64)))
            lanes.append(total)
        self._lanes = lanes  # running sums: a prefix is the difference of two

    def key(self, row: np.ndarray, depth: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Of the prefixes with ``depth`` turns of the given sequences."""
        at = self.offsets[row]
        return tuple((lane[at + depth] - lane[at]) for lane in self._lanes)

    def last_bytes(self, row: np.ndarray, depth: int) -> np.ndarray:
        return self.bytes[self.offsets[row] + depth - 1] if depth else np.zeros(len(row), np.int64)


#: What is added up over members and children of a node; of ``conv`` the least is taken.
SUMS = ("n", "children", "leaves", "saved")


def _peel(paths: _Paths, rows: np.ndarray, extra: dict[int, dict[str, np.ndarray]], border: list[int]) -> Iterator[tuple[str, int, dict[str, np.ndarray]]]:
    """The levels of the trie of the sequences ``rows`` from the deepest up, as ("node", depth, nodes): each node's first
    sequence ``row``, its ``SUMS`` and ``conv``, the sequence that ``ends`` there (or -1), and its ``parent``.

    ``extra`` has, by depth, sums to be added to nodes, by a sequence below each. Nodes that are prefixes of the sequences ``border``
    are not peeled any further: what their other children add up to is given as ("sum", depth, sums), with the border's ``row``;
    these children get no ``parent`` (-1) but are ``pending``."""
    by_depth = rows[np.argsort(paths.depth[rows], kind="stable")]
    depths = paths.depth[by_depth]
    deepest = max([int(depths[-1]) if len(depths) else -1, *extra])
    nothing = np.zeros(0, np.int64)
    alive = {k: nothing for k in (*SUMS, "row", "conv", "ends")}
    for depth in range(deepest, -1, -1):
        ended = np.sort(by_depth[np.searchsorted(depths, depth) : np.searchsorted(depths, depth, side="right")])
        none = np.zeros(len(ended), np.int64)
        survivors = len(alive["row"])
        parts = [
            {"row": ended, "n": paths.n[ended], "conv": paths.conv[ended], "children": none, "leaves": none, "saved": none, "ends": ended},
            {**alive, "children": np.ones(survivors, np.int64), "ends": np.full(survivors, -1)},  # stripped of their last turn
        ]
        if depth in extra:
            parts.append({**extra[depth], "ends": np.full(len(extra[depth]["row"]), -1)})
        entries = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
        if not len(entries["row"]):
            continue
        came = np.concatenate([np.full(len(p["row"]), i == 1) for i, p in enumerate(parts)])
        order = np.argsort(entries["row"], kind="stable")
        entries, came = {k: v[order] for k, v in entries.items()}, came[order]
        one, other = paths.key(entries["row"], depth)
        new = np.concatenate(([True], (one[1:] != one[:-1]) | (other[1:] != other[:-1])))
        begins = np.flatnonzero(new)
        nodes = {k: np.add.reduceat(entries[k], begins) for k in SUMS}
        nodes["row"] = entries["row"][begins]
        nodes["conv"] = np.minimum.reduceat(entries["conv"], begins)
        nodes["ends"] = np.maximum.reduceat(entries["ends"], begins)
        held = np.full(len(begins), -1)
        keys = paths.key(nodes["row"], depth)
        for b in border:
            if depth <= paths.depth[b]:
                theirs = paths.key(np.array([b]), depth)
                held[(keys[0] == theirs[0]) & (keys[1] == theirs[1])] = b
        if survivors:
            parent = (np.cumsum(new) - 1)[came]
            pending = held[parent] >= 0
            yield "node", depth + 1, {**alive, "parent": np.where(pending, -1, nodes["conv"][parent]), "pending": pending}
        if (on := held >= 0).any():
            yield "sum", depth, {**{k: nodes[k][on] for k in (*SUMS, "conv")}, "row": held[on]}
            nodes = {k: v[~on] for k, v in nodes.items()}
        nodes["leaves"] = np.where(nodes["children"] == 0, 1, nodes["leaves"])
        nodes["saved"] = nodes["saved"] + (nodes["n"] - 1) * paths.last_bytes(nodes["row"], depth)
        alive = nodes
    if len(alive["row"]):  # the root
        yield "node", 0, {**alive, "parent": np.full(1, -1), "pending": np.zeros(1, bool)}


_TURNS = pa.list_(pa.struct([("digest", pa.binary()), ("bytes", pa.int64())]))
#: A task's rows: nodes (``one`` and ``other`` tell the parent whose ``conv`` is not known there, or the node itself if it lies on
#: a border), border sequences, and sums for border nodes (``parent_conv_id`` is the border sequence's).
_PARTS = pa.schema(
    [
        ("kind", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
        ("one", pa.int64()), ("other", pa.int64()), ("turns", _TURNS),
    ]
)
_PARTS_DDL = (
    "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    f"ends_sha256 string, one long, other long, turns array<{TURN}>"
)
RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _batch(columns: dict[str, object], size: int) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _PARTS]
    return pa.RecordBatch.from_arrays(arrays, schema=_PARTS)


def _masked(values: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64(), mask=~known)


def _level(paths: _Paths, kind: str, depth: int, own: dict[str, np.ndarray], border: bool) -> pa.RecordBatch:
    size = len(own["row"])
    columns = {
        "kind": [kind] * size, "conv_id": own["conv"], "depth": np.full(size, depth), "n_convs": own["n"],
        "n_children": own["children"], "n_leaves": own["leaves"], "saved_tokens": own["saved"],
    }
    if kind == "sum":
        return _batch({**columns, "parent_conv_id": paths.conv[own["row"]]}, size)
    columns["ends_sha256"] = [paths.ends[e] if e >= 0 else NO_ENDS for e in own["ends"].tolist()]
    columns["parent_conv_id"] = _masked(own["parent"], ~own["pending"] & (depth > 0))
    told = np.ones(size, bool) if border else own["pending"]
    keys = paths.key(own["row"], depth if border else max(depth - 1, 0))
    return _batch({**columns, "one": _masked(keys[0], told), "other": _masked(keys[1], told)}, size)


def _together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels of a few nodes in common batches, and large ones in several."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BATCH:
            yield from pa.Table.from_batches(held, _PARTS).combine_chunks().to_batches(BATCH)
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held, _PARTS).combine_chunks().to_batches(BATCH)


def _read(batches: list[pa.RecordBatch]) -> _Paths:
    """Sequences in the order of their turns, as arrays."""
    table = pa.Table.from_batches(batches).combine_chunks()
    turns = table.column("turns").combine_chunks()
    turns = turns.chunk(0) if isinstance(turns, pa.ChunkedArray) else turns
    flat = turns.flatten()
    digests = np.frombuffer(b"".join(flat.field("digest").to_pylist()), np.uint64).reshape(-1, 2)
    lengths = turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    conv, n = (table.column(c).to_numpy().astype(np.int64) for c in ("conv_id", "n_convs"))
    sizes = flat.field("bytes").to_numpy(zero_copy_only=False).astype(np.int64)
    return _Paths(conv, n, table.column("ends_sha256").to_pylist(), digests, sizes, np.concatenate(([0], np.cumsum(lengths))))


def _peel_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sequences: the nodes that lie within it, and its border."""
    given = [b for b in batches if b.num_rows]
    if not given:
        return
    paths = _read(given)
    rows, last = np.arange(len(paths.conv)), len(paths.conv) - 1
    # Sequences that are prefixes of the last one end on its border, and go with it.
    fits = paths.depth <= paths.depth[last]
    ours, theirs = paths.key(rows, np.where(fits, paths.depth, 0)), paths.key(np.full(len(rows), last), np.where(fits, paths.depth, 0))
    on = fits & (ours[0] == theirs[0]) & (ours[1] == theirs[1])
    on[[0, last]] = True
    peeled = _peel(paths, rows[~on], {}, [0, last])
    yield from _together(_level(paths, kind, depth, own, border=False) for kind, depth, own in peeled)
    table = pa.Table.from_batches(given).combine_chunks().filter(pa.array(on)).select(["conv_id", "n_convs", "ends_sha256", "turns"])
    for batch in table.to_batches():
        turns = batch.column("turns").cast(_TURNS)
        own = {c: batch.column(c) for c in ("conv_id", "n_convs", "ends_sha256")}
        yield _batch({**own, "kind": ["sequence"] * batch.num_rows, "turns": turns}, batch.num_rows)


def _peel_border(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The border sequences of all tasks, in order and then the sums for their nodes: the nodes on them."""
    given = [b for b in batches if b.num_rows]
    if not given:
        return
    table = pa.Table.from_batches(given)
    kinds = table.column("kind").to_numpy(zero_copy_only=False)
    own = table.filter(pa.array(kinds == "sequence"))
    paths = _read(own.combine_chunks().to_batches())
    sums = table.filter(pa.array(kinds == "sum"))
    by_conv = np.argsort(paths.conv)
    names = {"n": "n_convs", "conv": "conv_id", "children": "n_children", "leaves": "n_leaves", "saved": "saved_tokens"}
    columns = {k: sums.column(c).to_numpy().astype(np.int64) for k, c in names.items()}
    columns["row"] = by_conv[np.searchsorted(paths.conv, sums.column("parent_conv_id").to_numpy(), sorter=by_conv)]
    depth = sums.column("depth").to_numpy()
    extra = {int(d): {k: v[depth == d] for k, v in columns.items()} for d in np.unique(depth)}
    peeled = _peel(paths, np.arange(len(paths.conv)), extra, [])
    yield from _together(_level(paths, kind, depth, own, border=True) for kind, depth, own in peeled)


def trie(lists: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations (``conv_id``, ``turns`` as ``gathered`` gives them): the smallest
    member ``conv_id``, ``depth``, ``parent_conv_id`` (the parent's; null for the root), members ``n_convs``, ``n_children``, childless nodes
    ``n_leaves`` and bytes ``saved_tokens`` of its subtree, and ``ends_sha256`` of the members that end there.

    A node's turns are the first ``depth`` turns of conversation ``conv_id``."""
    distinct = sequences(lists)
    session = lists.sparkSession
    turns = distinct.agg(F.sum(F.size("turns").cast("long"))).first()[0] or 0
    wide = int(session.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(-(-turns // TASK_TURNS), min(wide, -(-turns // LEAST_TURNS)), 1)
    slim = distinct.select("conv_id", F.col("n").alias("n_convs"), "ends_sha256", "turns")
    sorted_ = slim.repartitionByRange(tasks, "turns").sortWithinPartitions("turns")
    parts = stored(mapped(sorted_, _peel_task, _PARTS_DDL), "trie-parts")
    # Two sequences a task and their prefixes' sums: one task sorts and peels them.
    edge = parts.where("kind <> 'node'").repartition(1).sortWithinPartitions("kind", "turns")
    border = stored(mapped(edge, _peel_border, _PARTS_DDL), "trie-border")
    keys = border.select(
        F.col("one").alias("_one"), F.col("other").alias("_other"), (F.col("depth") + 1).alias("_depth"), F.col("conv_id").alias("_conv")
    )
    inner = parts.where("kind = 'node'")
    known = (F.col("one") == F.col("_one")) & (F.col("other") == F.col("_other")) & (F.col("depth") == F.col("_depth"))
    mended = inner.join(sized(keys), known, "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_conv"))
    return mended.select(*RESULT).unionByName(border.select(*RESULT))
