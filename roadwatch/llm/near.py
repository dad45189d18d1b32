"""Near duplicates by a chosen-path similarity join.

Documents are sets of word shingles, sketched by minwise tokens. In each of several
independent trees a node selects a few coordinates at random, and documents go down to one child per
selected coordinate, that of their token there. So similar documents meet in many nodes and
others in few. Small nodes compare their members exhaustively and propose the best pairs that tie together
all who may be linked; a root node with more such pairs stays open. Large nodes are cut into parts; a part
ties its members to its most central ones,
compares those that are far from these with all others but proposes only the best of them, fewer pairs than it
has members; if there are other parts it sends those that are far further down, and its most central member meets
those of the other parts.
Candidates are confirmed on the full sets. What is then still unconnected inside a large or open root node is
settled exhaustively: nodes whose members all belong to one component are done, the
others send every member on to the children of their selected coordinates until BOUND members are left
or the levels are used up; a node still larger is cut into blocks, and its pairs of blocks are tasks of their
own. There all pairs of members in different components are compared by sketch and, with the full
sets at hand, confirmed in the same task, which gives back one link for each two components
that it joins. So no step writes more rows than a few times the members that stand in its nodes.

Recall. Two documents of similarity s share a selected coordinate with chance s. With the
default 12 trees and their root coordinates, a pair at 0.75 misses all root nodes with a
chance below 1e-8, and is held back by its sketch with a chance of about 3e-5. A level below a
large root node keeps such a pair together with a chance of 0.83 or more on each of the paths; if all
its root nodes are so large, all paths of three levels miss it with a chance of about 3e-5. No other
pair is left out unless its ends are connected without it.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from roadwatch.llm import shingles
from roadwatch.llm.components import components
from roadwatch.llm.line_chunks import row_keys
from roadwatch.llm.tables import shuffled, slices, stored, texts

# Links: 100 * intersection >= 75 * union.
SIMILARITY = 0.75
TREES = 12
COORDINATES = 256
# Of the coordinates' tokens agree at least so many in a candidate pair.
LEAST_AGREEING = 164
# Nodes up to this size compare all their members.
SMALL = 64
# Members of a large node that one task holds.
PART = 1024
DEPTH = 3
CENTRAL = 1
# A member with so many tokens in common with a central one goes no further.
NEAR = 212
# Candidates that a member of a large node's part has at first besides the central ones: its best.
PARTNERS = 2
# Members of a node that one task compares with each other, or with as many of another block.
BOUND = 2048
# Levels below a root node before a node that is still larger is cut into blocks.
LEVELS = 3
# Shingle hashes that one task holds for each side of a comparison.
HELD = 2_000_000

# Rounds of contraction that tell which ends the best candidates connect, before the others are confirmed.
FIRST_ROUNDS = 2

KEYS = ["doc_id", "key_1", "key_2"]
# What a row of a tree's level is: a candidate pair, a member of a node below, a large node's part's member that
# meets the other parts', or a small node with more pairs than it proposed.
PAIR, CHILD, MEETING, OPEN = range(4)


def _chosen(node, seed=0):
    """Coordinates that a node selects: each with chance 1 / (similarity * coordinates), one at least."""
    steps = np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    drawn = shingles.mix(np.uint64(node) + steps)
    most = np.uint64(int((1 << 64) / (SIMILARITY * COORDINATES)))
    return np.flatnonzero((drawn < most) | (drawn == drawn.min()))


def _child(node, coordinate, tokens):
    """Keys of the children below a node by the members' tokens at a coordinate."""
    with np.errstate(over="ignore"):
        base = shingles.mix(np.uint64(node) ^ (np.uint64(coordinate + 1) << np.uint64(48)))
        return shingles.mix(base + tokens.astype(np.uint64))


def _roots():
    """Root key and coordinate of each path that starts a tree."""
    with np.errstate(over="ignore"):
        keys = shingles.mix(np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0x165667B19E3779F9))
    return [(int(key), int(c)) for key in keys for c in _chosen(key)]


ROOTS = _roots()


def _binary_texts(batch):
    """Concatenated UTF-8 bytes of a text column and their bounds."""
    raw = batch.column("text").cast(pa.large_binary())
    parts = raw.to_pylist()
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
    return np.frombuffer(b"".join(parts), np.uint8), bounds


def _fixed(rows):
    """Rows of bytes as an Arrow binary column."""
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _sketch(batches):
    for batch in slices(batches, "text", 2_000_000):
        flat, ends = shingles.shingle_sets(*_binary_texts(batch))
        tokens = shingles.signatures(flat, ends, COORDINATES)
        counts = np.diff(ends)
        starts = ends[:-1][counts > 0]
        digests = np.zeros((2, len(counts)), np.uint64)
        if len(starts):
            # Two sums of differently mixed hashes tell sets apart: 128 bits.
            with np.errstate(over="ignore"):
                digests[0, counts > 0] = np.add.reduceat(shingles.mix(flat), starts)
                digests[1, counts > 0] = np.add.reduceat(shingles.mix(flat ^ np.uint64(0xA0761D6478BD642F)), starts)
        nodes = np.stack([_child(key, c, tokens[:, c]) for key, c in ROOTS], axis=1).view(np.int64)
        ends_of_nodes = np.arange(len(counts) + 1) * len(ROOTS)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(name) for name in KEYS],
                pa.array(counts, pa.int64()),
                pa.array(digests[0].view(np.int64)),
                pa.array(digests[1].view(np.int64)),
                pa.ListArray.from_arrays(pa.array(ends_of_nodes, pa.int32()), pa.array(nodes.ravel())),
                _fixed(shingles.mix(tokens).astype(np.uint8)),
            ],
            names=[*KEYS, "n_shingles", "set_1", "set_2", "nodes", "sketch"],
        )


def _groups(batches, names):
    """Columns of each run of rows with one (node, part); rows arrive sorted by them."""
    held = []
    for batch in batches:
        table = pa.Table.from_batches([*held, batch]) if held else pa.Table.from_batches([batch])
        keys = np.stack([table.column("node").to_numpy(), table.column("part").to_numpy()])
        ends = np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1
        starts = np.concatenate([[0], ends])
        for start, end in zip(starts[:-1], ends, strict=True):
            yield table.slice(start, end - start)
        held = table.slice(starts[-1]).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _agreeing(sketch, other):
    return (sketch == other).sum(axis=1)


def _like_sizes(n, other):
    """Whether sets of these sizes can be similar enough: the intersection is at most the smaller one."""
    return 100 * np.minimum(n, other) >= round(100 * SIMILARITY) * np.maximum(n, other)


def _open_pairs(group, left, right):
    """Places of a member at `left` and one at `right` that agree enough and have different roots."""
    sketch, roots, sizes = group.sketch, group.roots, group.sizes
    # Of the first half of the coordinates so many must agree.
    half = COORDINATES // 2
    least = LEAST_AGREEING - (COORDINATES - half)
    columns = np.ascontiguousarray(sketch[right, :half].T)
    for begin in range(0, len(left), 128):
        some = left[begin : begin + 128]
        possible = roots[some][:, None] != roots[right][None, :]
        possible &= _like_sizes(sizes[some][:, None], sizes[right][None, :])
        if not possible.any():
            continue
        counts = np.zeros((len(some), len(right)), np.uint8)
        for j in range(half):
            counts += sketch[some, j][:, None] == columns[j][None, :]
        x, y = np.nonzero((counts >= least) & possible)
        for at in range(0, len(x), 20_000):
            i, j = some[x[at : at + 20_000]], right[y[at : at + 20_000]]
            enough = _agreeing(sketch[i], sketch[j]) >= LEAST_AGREEING
            yield i[enough], j[enough]


def _tying(pairs):
    """Of pairs (x, y, agreeing) the best that tie together all that the pairs do: less than their members."""
    above, kept = {}, []

    def top(x):
        while above.get(x, x) != x:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    for x, y, agreeing in sorted(pairs, key=lambda pair: -int(pair[2])):
        one, other = top(x), top(y)
        if one != other:
            above[one] = other
            kept.append((x, y, agreeing))
    return kept


def _tying_pairs(ids, sketch):
    """Best pairs that tie together all members that agree enough, of a node of bounded size; whether more pairs do."""
    left, right = np.triu_indices(len(ids), 1)
    agreeing = _agreeing(sketch[left], sketch[right])
    enough = np.flatnonzero(agreeing >= LEAST_AGREEING)
    pairs = _tying(list(zip(ids[left[enough]], ids[right[enough]], agreeing[enough], strict=True)))
    return pairs, len(enough) > len(pairs)


def _central(sketch):
    """The members that agree most with the most frequent token of each coordinate."""
    tally = np.zeros((COORDINATES, 256), np.int32)
    for j in range(COORDINATES):
        tally[j] = np.bincount(sketch[:, j], minlength=256)
    agreeing = _agreeing(sketch, tally.argmax(axis=1).astype(np.uint8))
    return np.argsort(-agreeing, kind="stable")[:CENTRAL]


def _large_node(node, ids, sketch, whole, last):
    """Pairs of a part of a large node, and (child, member, kind) rows to go on with. `whole`: it has no other part.

    Members of a whole node go no further: what its pairs leave unconnected, unconnected_links compares.
    """
    pairs, onward = [], []
    central = _central(sketch)
    best = np.zeros(len(ids), np.int64)
    for c in central:
        agreeing = _agreeing(sketch, sketch[c])
        pairs += [(ids[c], ids[j], agreeing[j]) for j in np.flatnonzero(agreeing >= LEAST_AGREEING) if j != c]
        best = np.maximum(best, agreeing)
    far = np.flatnonzero(best < NEAR)
    for f in far:
        agreeing = _agreeing(sketch, sketch[f])
        agreeing[f] = 0
        for j in np.argsort(-agreeing, kind="stable")[:PARTNERS]:
            if agreeing[j] >= LEAST_AGREEING:
                pairs.append((ids[f], ids[j], agreeing[j]))
    pairs = _tying(pairs)
    if last or whole:
        return pairs, onward
    meeting = shingles.mix(np.array([node], np.uint64) + np.uint64(1))[0]
    onward.append((meeting, ids[central[0]], MEETING))
    for c in _chosen(node):
        onward += [(child, member, CHILD) for child, member in zip(_child(node, c, sketch[far, c]), ids[far], strict=True)]
    return pairs, onward


def _compare(last):
    """Work on nodes in sorted rows: candidate pairs, open nodes and rows of the next level."""

    def run(batches):
        a, b, agreeing, kind = [], [], [], []

        def out():
            columns = [
                pa.array(np.array(a, np.uint64).view(np.int64)),
                pa.array(np.array(b, np.int64)),
                pa.array(agreeing, pa.int32()),
                pa.array(kind, pa.int32()),
            ]
            for column in (a, b, agreeing, kind):
                column.clear()
            return pa.RecordBatch.from_arrays(columns, names=["a", "b", "agreeing", "kind"])

        for group in _groups(batches, ("node", "part")):
            ids = group.column("set_id").to_numpy()
            sketch = _sketches(group)
            size = group.column("size")[0].as_py()
            node = np.int64(group.column("node")[0].as_py()).view(np.uint64)
            if size <= SMALL:
                pairs, more = _tying_pairs(ids, sketch)
                rows = [(node, ids[0], OPEN)] if more else []
            else:
                pairs, rows = _large_node(node, ids, sketch, size <= PART, last)
            for x, y, n in pairs:
                a.append(np.uint64(min(x, y)))
                b.append(max(x, y))
                agreeing.append(n)
                kind.append(PAIR)
            for below, member, what in rows:
                a.append(below)
                b.append(member)
                agreeing.append(0)
                kind.append(what)
            if len(a) > 50_000:
                yield out()
        if a:
            yield out()

    return run


def _sketches(table):
    return np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, COORDINATES)


class _Meeting:
    """Members of one node that meet in a task: all with each other, or side 0 with side 1 if there is one."""

    def __init__(self, table):
        self.ids, self.roots, self.sizes, side = (
            table.column(c).to_numpy() for c in ("set_id", "root", "n_shingles", "side")
        )
        self.sketch = _sketches(table)
        self.first, self.second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        self.inner = not len(self.second)


def _stretches(sizes):
    """Number of the stretch that each member falls in: members by size, cut whenever HELD hashes are full."""
    out = np.zeros(len(sizes), np.int64)
    order = np.argsort(sizes, kind="stable")
    out[order] = (np.cumsum(sizes[order]) - sizes[order]) // HELD
    return out


def _open_members(batches):
    """Members with an open pair, once for each two stretches of HELD hashes that have one between them."""
    for table in _groups(batches, ("node", "part")):
        group = _Meeting(table)
        stretch = np.zeros(len(group.ids), np.int64)
        for places in (group.first, group.second):
            stretch[places] = _stretches(group.sizes[places])
        seen = {}
        for x, y in _open_pairs(group, group.first, group.first if group.inner else group.second):
            if group.inner:
                once = (stretch[x] < stretch[y]) | ((stretch[x] == stretch[y]) & (x < y))
                x, y = x[once], y[once]
            for one, other in np.unique(np.stack([stretch[x], stretch[y]]), axis=1).T.tolist():
                here = (stretch[x] == one) & (stretch[y] == other)
                sides = seen.setdefault((one, other), np.zeros((2, len(group.ids)), bool))
                sides[0, x[here]] = True
                sides[1, y[here]] = True
        node, part = table.column("node")[0].as_py(), table.column("part")[0].as_py()
        for (one, other), sides in seen.items():
            if group.inner and one == other:
                sides = np.stack([sides.any(axis=0), np.zeros(len(group.ids), bool)])
            side, places = np.nonzero(sides)
            with np.errstate(over="ignore"):
                key = shingles.mix(np.array([part], np.int64).view(np.uint64) + np.uint64(one << 32 | other))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(places), node, np.int64)),
                    pa.array(np.full(len(places), key.view(np.int64)[0], np.int64)),
                    pa.array(group.ids[places]),
                    pa.array(group.roots[places]),
                    pa.array(side.astype(np.int32)),
                ],
                names=["node", "part", "set_id", "root", "side"],
            )


def _joining_links(batches):
    """Confirmed links between members of different components, one for each two components that become one."""
    for table in _groups(batches, ("node", "part")):
        group = _Meeting(table)
        hashes = [np.frombuffer(raw, np.uint64) for raw in table.column("hashes").to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
        names = np.unique(np.concatenate(hashes), return_inverse=True)[1]
        held = np.zeros(names.max() + 1, bool)
        component = np.unique(group.roots, return_inverse=True)[1]
        u, v = [], []
        for place, i in enumerate(group.first):
            others = group.first[place + 1 :] if group.inner else group.second
            others = others[component[others] != component[i]]
            others = others[_like_sizes(group.sizes[others], group.sizes[i])]
            others = others[_agreeing(group.sketch[others], group.sketch[i]) >= LEAST_AGREEING]
            own = names[ends[i] : ends[i + 1]]
            held[own] = True
            for j in others.tolist():
                if component[j] == component[i]:
                    continue
                both = np.count_nonzero(held[names[ends[j] : ends[j + 1]]])
                union = group.sizes[i] + group.sizes[j] - both
                if 100 * both >= round(100 * SIMILARITY) * union:
                    u.append(group.ids[i])
                    v.append(group.ids[j])
                    component[component == component[j]] = component[i]
            held[own] = False
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _descend(batches):
    """Rows (node, set_id, root) of the children that each row's node sends its members to."""
    for batch in batches:
        node = batch.column("node").to_numpy().view(np.uint64)
        ids, roots = batch.column("set_id").to_numpy(), batch.column("root").to_numpy()
        sketch = _sketches(batch)
        order = np.argsort(node, kind="stable")
        for places in np.split(order, np.flatnonzero(np.diff(node[order])) + 1) if len(order) else []:
            key = node[places[0]]
            for c in _chosen(key):
                child = _child(key, c, sketch[places, c]).view(np.int64)
                columns = [pa.array(child), pa.array(ids[places]), pa.array(roots[places])]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "set_id", "root"])


def _mixed(rows):
    """Nodes whose members are of several components: node, size."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.min("root").alias("a"), F.max("root").alias("b"))
    return stored(sizes.filter("a <> b").select("node", "size"), "mixed-nodes")


def _blocks(rooted):
    """Members of nodes above BOUND, in blocks: node, set_id, root, part, side; a part is a pair of blocks.

    The members of a node's largest component, in blocks, meet the blocks of all others; these
    meet each other as well.
    """
    counts = rooted.groupBy("node", "root").agg(F.count("*").alias("n"))
    shape = counts.groupBy("node").agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("main"))
    main_blocks = F.ceil(F.col("main.n") / BOUND).cast("int").alias("main_blocks")
    others = F.ceil((F.col("size") - F.col("main.n")) / BOUND).cast("int").alias("other_blocks")
    shape = shape.select("node", F.col("main.root").alias("main"), main_blocks, others)
    placed = rooted.join(stored(shape, "open-nodes"), "node")
    is_main = F.col("root") == F.col("main")
    draw = F.xxhash64("set_id", "node")
    block = F.when(is_main, F.pmod(draw, "main_blocks")).otherwise(F.pmod(draw, "other_blocks")).cast("int")
    last, last_main = F.col("other_blocks") - 1, F.col("main_blocks") - 1

    def meeting(first, second, side):
        return F.struct(first.alias("first"), second.alias("second"), side.cast("int").alias("side"))

    # Blocks of the main component count from 0, others from -1 down.
    with_others = F.transform(F.sequence(F.lit(0), last), lambda o: meeting(F.col("block"), -1 - o, F.lit(0)))
    with_main = F.transform(F.sequence(F.lit(0), last_main), lambda m: meeting(m, -1 - F.col("block"), F.lit(1)))
    among = F.transform(
        F.sequence(F.lit(0), last),
        lambda o: meeting(-1 - F.least(o, "block"), -1 - F.greatest(o, "block"), F.col("block") > o),
    )
    meetings = F.when(is_main, with_others).otherwise(F.concat(with_main, among))
    rows = placed.withColumn("block", block).select("node", "set_id", "root", F.explode(meetings).alias("meeting"))
    part = F.xxhash64("meeting.first", "meeting.second").alias("part")
    return rows.select("node", "set_id", "root", part, "meeting.side")


def unconnected_links(keyed, sets, members, labels):
    """Confirmed links (u, v) that join what `labels` does not connect, among members of one node.

    `members` has node and set_id, `labels` what components() returns.
    """
    layout = "node long, set_id long, root long"
    aside = "node long, part long, set_id long, root long, side int"
    rows = members.join(labels.select(F.col("u").alias("set_id"), F.col("v").alias("root")), "set_id", "left")
    rows = stored(rows.select("node", "set_id", F.coalesce("root", "set_id").alias("root")), "open-members")
    meetings = []
    for level in range(LEVELS + 1):
        sized = rows.join(_mixed(rows), "node")
        bounded = sized.filter(F.col("size") <= BOUND)
        alone = F.lit(0).cast("long").alias("part"), F.lit(0).cast("int").alias("side")
        meetings.append(bounded.select("node", "set_id", "root", *alone))
        beyond = stored(sized.filter(F.col("size") > BOUND).select("node", "set_id", "root"), "beyond")
        if beyond.isEmpty():
            break
        if level == LEVELS:
            meetings.append(_blocks(beyond))
        else:
            down = beyond.join(sets.select("set_id", "sketch"), "set_id")
            rows = stored(down.mapInArrow(_descend, layout).distinct(), "open-members")
    together = meetings[0]
    for more in meetings[1:]:
        together = together.unionByName(more)

    def grouped(frame):
        return frame.repartition("node", "part").sortWithinPartitions("node", "part", "set_id")

    sketches = sets.select("set_id", "n_shingles", "sketch")
    found = stored(grouped(together.join(sketches, "set_id")).mapInArrow(_open_members, aside), "open-found")
    full = _full_sets(keyed, sets, found.select("set_id").distinct())
    whole = grouped(found.join(sketches, "set_id").join(shuffled(full), "set_id"))
    return stored(whole.mapInArrow(_joining_links, "u long, v long"), "joining-links")


def candidate_pairs(sets):
    """Pairs of sets whose sketches agree: a, b (a < b) and the agreeing coordinates; and the members of unsettled nodes.

    `sets` has set_id, nodes and sketch. Each level counts the members of its nodes first;
    sketches go only to nodes of two or more. A large node proposes its members' best pairs, a small one those
    that tie its members together; the members (node, set_id) of large root nodes, and of small ones with more
    pairs, are returned for unconnected_links. What meets below a large root node meets there too, or in
    the same nodes below it; only the meetings of its parts are nodes of their own.
    """
    found = unsettled = None
    rows = held = stored(sets.select("set_id", F.explode("nodes").alias("node")), "tree-rows")
    for level in range(DEPTH):
        sizes = rows.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        part = F.pmod(F.xxhash64("set_id", "node"), F.ceil(F.col("size") / PART)).cast("int")
        sizes = stored(sizes, "tree-nodes")
        meeting = rows.join(sizes, "node").select("node", "set_id", "size", part.alias("part"))
        meeting = meeting.join(sets.select("set_id", "sketch"), "set_id")
        placed = meeting.repartition("node", "part").sortWithinPartitions("node", "part", "set_id")
        work = placed.mapInArrow(_compare(level == DEPTH - 1), "a long, b long, agreeing int, kind int")
        work = stored(work, "tree-level")
        pairs = work.filter(F.col("kind") == PAIR).select("a", "b", "agreeing")
        nodes = work.filter(F.col("kind") == OPEN).select(F.col("a").alias("node"))
        if not level:
            nodes = nodes.union(sizes.filter(F.col("size") > SMALL).select("node"))
        members = held.join(nodes, "node").select("node", "set_id")
        found = pairs if found is None else found.union(pairs)
        unsettled = members if unsettled is None else unsettled.union(members)
        below = work.select(F.col("b").alias("set_id"), F.col("a").alias("node"), "kind")
        rows = below.filter(F.col("kind").isin(CHILD, MEETING)).drop("kind")
        held = below.filter(F.col("kind") == MEETING).drop("kind")
        if rows.isEmpty():
            break
    return stored(found.groupBy("a", "b").agg(F.max("agreeing").alias("agreeing")), "candidates"), unsettled


def _hash_sets(batches):
    for batch in slices(batches, "text", 2_000_000):
        flat, ends = shingles.shingle_sets(*_binary_texts(batch))
        whole = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("set_id"), pa.array(whole, pa.binary())], names=["set_id", "hashes"])


def _confirm(batches):
    for batch in batches:
        linked = []
        for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
            x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * both >= round(100 * SIMILARITY) * (len(x) + len(y) - both))
        kept = pa.array(linked, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(kept) for c in ("a", "b")], names=["u", "v"])


def _confirmed(pairs, full):
    """The pairs whose full sets are similar enough: u, v."""
    left = full.select(F.col("set_id").alias("a"), F.col("hashes").alias("left"))
    right = full.select(F.col("set_id").alias("b"), F.col("hashes").alias("right"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return stored(both.mapInArrow(_confirm, "u long, v long"), "confirmed")


def _links(candidates, full):
    """Enough confirmed links to connect all that any candidate would connect.

    First each set's best candidate, which settles most; then all other candidates whose ends are
    not known to be connected yet. Links inside a component change nothing; most are not confirmed.
    """
    ends = candidates.select(F.col("a").alias("x"), F.struct("agreeing", "a", "b").alias("best")).union(
        candidates.select(F.col("b"), F.struct("agreeing", "a", "b"))
    )
    best = stored(ends.groupBy("x").agg(F.max("best").alias("best")).select("best.a", "best.b").distinct(), "best-pairs")
    first = _confirmed(best, full)
    labels = components(first, rounds=FIRST_ROUNDS)
    rest = (
        candidates.join(best, ["a", "b"], "left_anti")
        .join(labels.select(F.col("u").alias("a"), F.col("v").alias("root_a")), "a", "left")
        .join(labels.select(F.col("u").alias("b"), F.col("v").alias("root_b")), "b", "left")
        .filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
    )
    return first.union(_confirmed(stored(rest.select("a", "b"), "open-pairs"), full))


def sketched(rows):
    """Stored rows of doc_id, key_1, key_2, n_shingles, the set's digest and sketch, for `rows` of doc_id, text."""
    keyed = rows.select("doc_id", *row_keys(F.col("text")), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    layout = (
        f"doc_id {id_type}, key_1 long, key_2 long, n_shingles long, set_1 long, set_2 long, "
        "nodes array<long>, sketch binary"
    )
    return keyed, stored(keyed.mapInArrow(_sketch, layout), "sketches")


def _full_sets(keyed, sets, involved):
    """The full sets of the involved ones (set_id, distinct): set_id, hashes."""
    wanted = sets.join(involved, "set_id").select("set_id", *[F.col(f"one.{c}").alias(f"of_{c}") for c in KEYS])
    same = F.col("doc_id").eqNullSafe(F.col("of_doc_id"))
    same &= (F.col("key_1") == F.col("of_key_1")) & (F.col("key_2") == F.col("of_key_2"))
    members = keyed.join(shuffled(stored(wanted, "wanted")), same).select("set_id", "text")
    return stored(members.mapInArrow(_hash_sets, "set_id long, hashes binary").dropDuplicates(["set_id"]), "full-sets")


def near_duplicates(documents, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, n_shingles, component_id, kept, group, key_1, key_2.

    component_id is the smallest id among the documents that links reach; kept says that it is the
    document's own. NULL and empty texts, and texts without words, have no shingles and
    are linked with nothing. Equal sets are one vertex from the start, so groups of copies cost one
    member. NULL ids are larger than any other; if a group has no other, component_id is
    NULL and all of it is kept. Repeated rows have the same result; key_1 and key_2, hashes of the text,
    tell rows with one id and different texts apart, and `group` numbers the groups even so (NULL without
    shingles). An empty table gives no rows.
    """
    keyed, sketches = sketched(texts(documents, id_col, text_col))
    by_set = sketches.filter("n_shingles > 0").groupBy("set_1", "set_2").agg(
        F.min("doc_id").alias("least_id"),
        F.min(F.struct(*KEYS)).alias("one"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("nodes").alias("nodes"),
        F.first("sketch").alias("sketch"),
    )
    sets = stored(by_set.withColumn("set_id", F.monotonically_increasing_id()), "sets")

    candidates, unsettled = candidate_pairs(sets)
    involved = candidates.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    labels = components(_links(candidates, _full_sets(keyed, sets, involved)))
    joining = unconnected_links(keyed, sets, unsettled, labels)
    if not joining.isEmpty():
        labels = components(joining.union(labels.select("u", "v")))
    rooted = stored(
        sets.select("set_id", "set_1", "set_2", "least_id")
        .join(labels.select(F.col("u").alias("set_id"), F.col("v").alias("root")), "set_id", "left")
        .select("set_1", "set_2", "least_id", F.coalesce("root", "set_id").alias("root")),
        "rooted",
    )
    least = stored(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "component-ids")
    component = rooted.join(least, "root").select("set_1", "set_2", "component_id", F.col("root").alias("group"))
    # Texts without shingles have no set and stay alone.
    alone = sketches.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group"), *KEYS[1:]
    )
    linked = sketches.filter("n_shingles > 0").join(component, ["set_1", "set_2"])
    every = linked.select("doc_id", "n_shingles", "component_id", "group", *KEYS[1:]).unionByName(alone)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return every.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "group", *KEYS[1:])


def representatives(documents, id_col="doc_id", text_col="text"):
    """The rows of `documents` that stay, with their own columns: one of each group of near duplicates.

    Of repeated rows (same id and text) one stays. Documents without shingles all stay.
    """
    marks = stored(near_duplicates(documents, id_col, text_col).filter("n_shingles > 0"), "near-marks")
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashes = [h.alias(f"__{c}") for h, c in zip(row_keys(text), KEYS[1:], strict=True)]
    same = F.col(id_col).eqNullSafe(F.col("__of_doc_id"))
    same &= (F.col("__key_1") == F.col("__of_key_1")) & (F.col("__key_2") == F.col("__of_key_2"))

    def aside(frame):
        of = [F.col(c).alias(f"__of_{c}") for c in KEYS]
        return shuffled(frame.select(*of, F.col("group").alias("__group")).distinct())

    left = documents.select("*", *hashes).join(aside(marks.filter("NOT kept")), same, "left_anti")
    # Several rows of a group are kept if they share its smallest id, as repeated rows do, or have none.
    shared = marks.filter("kept").groupBy("group").agg(F.count("*").alias("n")).filter("n > 1")
    if shared.isEmpty():
        return left.select(*documents.columns)
    again = stored(aside(marks.filter("kept").join(shared, "group", "left_semi")), "shared-ids")
    once = left.join(again, same).dropDuplicates(["__group"]).select(*documents.columns)
    return left.join(again, same, "left_anti").select(*documents.columns).unionByName(once)
